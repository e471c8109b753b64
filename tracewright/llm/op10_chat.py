"""Chat formatting in budgeted windows with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A turn is its mark, the role, a colon and a line end, the text, and the end mark.
NEW, AGAIN, END = "### ", "##~ ", "</turn>\n"
WINDOW = ("window int, formatted string, turns int, tokens long, "
          "loss array<struct<start:long,stop:long>>")


def escaped(text):
    """Backslashes and number signs get a backslash, and the end mark one inside."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\#])", r"\\$1")
    return F.replace(marked, F.lit("</turn>"), F.lit("<\\/turn>"))


def escaped_role(role):
    return F.regexp_replace(escaped(role), "([:\n])", r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_windows(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", budget: int = 2048, history: int = 512, overhead: int = 4,
) -> DataFrame:
    """Each conversation as turn-aligned windows of about ``budget`` tokens.

    Columns: ``conv_id``, ``window`` (from 0), ``formatted``, ``turns`` (the new ones),
    ``tokens``, and ``loss``: the spans of ``formatted``, in code points, that are targets. A
    token is a run of other than white space; a turn has ``overhead`` more. Every window but the
    first begins with the system turn, if the conversation has one first, and the last turns
    before it that fit ``history``; these are marked as repeated and are no targets. Then come as
    many new turns as the prefix sums of their tokens allow, one at least: a turn above the
    budget stands alone and whole. Each assistant text is a target once.

    Turns come in order of ``turn``, then role and text; nulls first, null texts are empty.
    Null conversation ids form one conversation, null roles are empty. Repeated rows are turns
    of their own. Texts are escaped and counted row by row before they are dealt; a conversation
    is then one sorted stream, of which a task holds a window and its history only.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.col(text).alias("text"))
    rows = rows.select(
        "conv_id", "turn", "role", "text", escaped_role(F.col("role")).alias("role_text"),
        escaped(F.col("text")).alias("body"),
        (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")) + overhead).cast("long")
        .alias("tokens"))
    kind = dict(turns.dtypes)[conv_id]
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text").select(
        "conv_id", F.col("role").isin("assistant").alias("target"),
        F.col("role").isin("system").alias("system"), "role_text", "body", "tokens")
    names = ["conv_id", "window", "formatted", "turns", "tokens", "loss"]
    loss_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            out = []
            columns = [batch[i].to_pylist() for i in range(1, 6)]
            id_column = batch["conv_id"]
            id_type = id_column.type
            for key, *values in zip(id_column.to_pylist(), *columns, strict=True):
                if state is None or key != state.key:
                    out += state.close() if state else []
                    state = _Conversation(key, budget, history)
                out += state.add(*values)
            yield _table(out, id_type)
        if state:
            yield _table(state.close(), id_type)

    def _table(out: list, id_type: pa.DataType) -> pa.RecordBatch:
        parts = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [id_type, pa.int32(), pa.string(), pa.int32(), pa.int64(), loss_type]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(p), k) for p, k in zip(parts, kinds, strict=True)], names=names)

    return ordered.mapInArrow(stream, f"conv_id {kind}, {WINDOW}")


class _Conversation:
    """The open window of a conversation, and what later windows repeat."""

    def __init__(self, key, budget: int, history: int):
        self.key, self.budget, self.history = key, budget, history
        self.system = None
        self.first, self.window = True, 0
        self.recent: deque = deque()
        self.recent_tokens = 0
        self._open()

    def _open(self) -> None:
        repeated = ([self.system] if self.system else []) + list(self.recent)
        self.parts, self.at, self.tokens, self.turns, self.loss = [], 0, 0, 0, []
        for role, body, tokens in repeated:
            self._put(AGAIN, role, body, tokens)

    def _put(self, mark: str, role: str, body: str, tokens: int) -> int:
        head = f"{mark}{role}:\n"
        self.parts += (head, body, END)
        start = self.at + len(head)
        self.at = start + len(body) + len(END)
        self.tokens += tokens
        return start

    def _flush(self) -> tuple:
        out = (self.key, self.window, "".join(self.parts), self.turns, self.tokens, self.loss)
        self.window += 1
        return out

    def add(self, target: bool, system: bool, role: str, body: str, tokens: int) -> list[tuple]:
        out = []
        if self.turns and self.tokens + tokens > self.budget:
            out.append(self._flush())
            self._open()
        start = self._put(NEW, role, body, tokens)
        self.turns += 1
        if target:
            self.loss.append({"start": start, "stop": start + len(body)})
        if self.first and system:
            self.system = (role, body, tokens)
        else:
            self.recent.append((role, body, tokens))
            self.recent_tokens += tokens
        while self.recent and self.recent_tokens > self.history:
            self.recent_tokens -= self.recent.popleft()[2]
        self.first = False
        return out

    def close(self) -> list[tuple]:
        return [self._flush()]


_TURN = re.compile(r"(### |##~ )((?:[^\\:]|\\.)*):\n(.*?)</turn>\n", re.DOTALL)


def read_window(formatted: str) -> list[tuple[bool, str, str, int]]:
    """Turns of a window: whether repeated, role, text, and where the escaped text starts."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        out.append((found[1] == AGAIN, unescaped(found[2]), unescaped(found[3]), found.start(3)))
        at = found.end()
    return out


def read_back(windows: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """What the formatted windows say of each conversation: turns, targets and their digests.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. A SHA-256 is
    one stream, so each conversation's windows are read in order by one task, one at a time.
    """
    kind = dict(windows.dtypes)[conv_id]
    ordered = windows.select(conv_id, "window", "formatted", "loss").repartition(
        conv_id).sortWithinPartitions(conv_id, "window")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, id_type = None, None
        for batch in batches:
            done = []
            id_type = batch[conv_id].type
            for key, text, loss in zip(
                    batch[conv_id].to_pylist(), batch["formatted"].to_pylist(),
                    batch["loss"].to_pylist(), strict=True):
                if state is None or key != state[0]:
                    done += [state] if state else []
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for again, role, body, _ in read_window(text):
                    if not again:
                        state[1] += 1
                        state[2].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    target = unescaped(text[span["start"]:span["stop"]])
                    state[3] += len(target)
                    state[4].update(target.encode())
                state[5] += len(text)
            yield rows(done, id_type)
        if state:
            yield rows([state], id_type)

    def rows(done: list, id_type: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([x[0] for x in done], id_type), pa.array([x[1] for x in done], pa.int64()),
            pa.array([x[2].hexdigest() for x in done], pa.string()),
            pa.array([x[3] for x in done], pa.int64()),
            pa.array([x[4].hexdigest() for x in done], pa.string()),
            pa.array([x[5] for x in done], pa.int64()),
        ], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                  "formatted_chars"])

    return ordered.mapInArrow(
        stream, f"{conv_id} {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                "loss_sha256 string, formatted_chars long")
