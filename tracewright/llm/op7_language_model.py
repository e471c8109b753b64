"""Language-model scoring with a probabilistic suffix tree over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm import blocks as B
from tracewright.llm.words import blobs, find_words
from tracewright.session import durable, release

#: After a text's last word, and before its first.
EDGE = b"\n"


def spelled(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text as ``depth`` edges, its lower-cased words with a space behind each, and an
    edge; all in one array. Also where each text's predicted bytes begin, and the end."""
    words = find_words(texts, lower=True)
    lengths = words.ends - words.starts + 1
    sizes = np.zeros(words.texts, dtype=np.int64)
    np.add.at(sizes, words.text, lengths)
    begin = np.cumsum(sizes + depth + 1) - (sizes + depth + 1)
    out = np.full(int((sizes + depth + 1).sum()), EDGE[0], dtype=np.uint8)
    buffer = words.buffer.copy()
    buffer[words.ends] = 32
    edges = np.zeros(len(buffer) + 1, dtype=np.int8)
    edges[words.starts] = 1
    edges[words.ends + 1] -= 1
    place = np.zeros(len(out) + 1, dtype=np.int8)
    some = sizes > 0
    place[begin[some] + depth] = 1
    place[(begin + depth + sizes)[some]] = -1
    out[np.cumsum(place[:-1], dtype=np.int8).astype(bool)] = \
        buffer[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)]
    return out, np.append(begin + depth, len(out) + depth)


def _grams(stream: np.ndarray, begins: np.ndarray, depth: int) -> np.ndarray:
    """For each predicted byte the ``depth`` bytes before it and itself, packed."""
    n = len(stream) - depth
    code = np.zeros(max(n, 0), dtype=np.uint64)
    for shift in range(depth + 1):
        code = (code << np.uint64(8)) | stream[shift:shift + n].astype(np.uint64)
    inside = np.zeros(n, dtype=bool)
    edges = np.zeros(n + 1, dtype=np.int8)
    edges[begins[:-1] - depth] += 1
    edges[begins[1:] - 2 * depth] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8) > 0
    return code[inside]


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, value = B.joined(keys), B.joined(values, np.int64)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else []
    return key[first], np.add.reduceat(value, first) if len(key) else value


@dataclass
class SuffixTree:
    """States of the tree as an automaton: the longest suffix that begins a kept context."""

    symbol: np.ndarray
    follow: np.ndarray
    cost: np.ndarray
    depth: int
    contexts: int

    words: int
    texts: int
    word_share: float = 0.25

    def spelling(self, texts: list[bytes], segment: int = 512) -> np.ndarray:
        """Log10 probability of the bytes of each word with its space, and of each text's edge,
        in order. A state depends on the last ``depth`` bytes only, so all segments of the
        stream are walked side by side."""
        if not texts:
            return np.zeros(0)
        stream, begins = spelled(texts, self.depth)
        rows = -(-len(stream) // segment)
        coded = np.zeros(self.depth + rows * segment, dtype=np.int64)
        coded[self.depth:self.depth + len(stream)] = self.symbol[stream]
        width = self.cost.shape[1]
        at = np.arange(rows) * segment
        state = np.zeros(rows, dtype=np.int64)
        out = np.empty((segment, rows), dtype=np.float32)
        follow, cost = self.follow.ravel(), self.cost.ravel()
        for step in range(self.depth + segment):
            place = state * width + coded[at + step]
            if step >= self.depth:
                out[step - self.depth] = cost[place]
            state = follow[place].astype(np.int64)
        total = np.concatenate(([0.0], np.cumsum(out.T.ravel()[:len(stream)], dtype=np.float64)))
        inside = np.zeros(len(stream) + 1, dtype=np.int8)
        inside[begins[:-1]] += 1
        inside[begins[1:] - self.depth] -= 1
        last = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        last &= (stream == 32) | (stream == EDGE[0])
        ends = np.flatnonzero(last) + 1
        starts = np.concatenate(([0], ends[:-1]))
        new_text = np.concatenate(([True], stream[ends[:-1] - 1] == EDGE[0]))
        starts[new_text] = begins[:-1]
        return total[ends] - total[starts]

    def log10(self, spelled: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """Log10 probability of each token: the tree's spelling, mixed with the token's share of
        the training tokens, so the whole is one distribution over token sequences."""
        share = np.log(np.maximum(uses, 1e-300) / max(1, self.words + self.texts))
        spelled = spelled * np.log(10) + (np.log(1 - self.word_share) if self.words else 0)
        known = np.where(uses > 0, share + np.log(self.word_share), -np.inf)
        return np.logaddexp(spelled, known) / np.log(10)


#: Counts of the bytes behind a context: which bytes, and how often each.
Next = tuple[np.ndarray, np.ndarray]


def build_tree(
    counts: list[dict[int, Next]], depth: int, gain: float, weight: float,
) -> SuffixTree:
    """``counts[d]`` has, for each context of ``d`` bytes, how often each byte follows.

    A context stays if the bytes behind it diverge from those behind its suffix: the log
    likelihood won, its count times the divergence, reaches ``gain`` nats. Suffixes of a context
    that stays are kept with it. Next-byte distributions are smoothed by ``weight`` counts of the suffix's.
    A distribution is spelled out only while its own branch is walked.
    """
    root = np.zeros(256)
    if 0 in counts[0]:
        root[counts[0][0][0]] = counts[0][0][1]
    longer: dict[tuple[int, int], list[int]] = {}
    for d in range(1, depth + 1):
        for context in counts[d]:
            longer.setdefault((d - 1, context & ((1 << (8 * (d - 1))) - 1)), []).append(context)

    def share_of(d: int, context: int, parent: np.ndarray) -> np.ndarray:
        letters, n = counts[d][context]
        share = parent * (weight / (n.sum() + weight))
        share[letters] += n / (n.sum() + weight)
        return share

    def walk(d: int, context: int, share: np.ndarray) -> bool:
        """Whether a context that this one is the suffix of stays."""
        any_stays = False
        for other in longer.get((d, context), ()):
            letters, n = counts[d + 1][other]
            own = share_of(d + 1, other, share)
            stays = walk(d + 1, other, own) if (d + 1, other) in longer else False
            if stays or (n * np.log(own[letters] / share[letters])).sum() >= gain:
                kept.add((d + 1, other))
                any_stays = True
        return any_stays

    kept = {(0, 0)}
    whole = (root + 0.5) / (root.sum() + 128)
    walk(0, 0, whole)
    used = np.zeros(256, dtype=bool)
    for d, context in kept:
        used[list(int(context).to_bytes(d, "big"))] = True
    used |= root > 0
    symbol = np.zeros(256, dtype=np.int64)  # 0: bytes that training texts do not have
    symbol[used] = np.arange(1, int(used.sum()) + 1)
    number = {(0, 0): 0}
    for d, context in sorted(kept):  # prefixes are states too: they remember what came before
        for i in range(1, d + 1):
            number.setdefault((i, context >> (8 * (d - i))), len(number))
    width = int(used.sum()) + 1
    follow = np.zeros((len(number), width), dtype=np.int32)
    cost = np.empty((len(number), width), dtype=np.float32)
    letters = np.flatnonzero(used)

    def fill(d: int, context: int, share: np.ndarray) -> None:
        state, rest = number[d, context], share[~used]
        cost[state, 1:] = np.log10(share[letters])
        cost[state, 0] = np.log10(rest.mean()) if len(rest) else 0
        for other in longer.get((d, context), ()):
            if (d + 1, other) in kept:
                fill(d + 1, other, share_of(d + 1, other, share))

    fill(0, 0, whole)
    children: dict[int, list[tuple[int, int]]] = {}
    for (d, context), state in number.items():
        if d:
            children.setdefault(number[(d - 1, context >> 8)], []).append((context & 255, state))
    for (d, context), state in sorted(number.items()):
        size, shorter = d, context
        while size:  # the longest shorter suffix that is a state, filled before this one
            size -= 1
            shorter &= (1 << (8 * size)) - 1
            if (size, shorter) in number:
                follow[state] = follow[number[(size, shorter)]]
                if (d, context) not in kept:  # its longest suffix that stays is that one's
                    cost[state] = cost[number[(size, shorter)]]
                break
        for letter, child in children.get(state, ()):
            follow[state, symbol[letter]] = child
    return SuffixTree(symbol, follow, cost, depth, len(kept), int(root[32]), int(root[EDGE[0]]))


def _may_stay(steps: DataFrame, gain: float, weight: float) -> DataFrame:
    """``d, context`` of the contexts that can pass the divergence test, and of their suffixes.

    A context wins at most what its own shares win over its suffix's counts spread thinnest, since
    smoothing only adds to those. What stays below ``gain`` by this bound cannot pass, and
    does not travel.
    """
    mask = F.expr("shiftleft(1L, (d - 1) * 8) - 1L")
    sums = steps.groupBy("d", "context").agg(F.sum("n").alias("all"))
    behind = steps.join(sums, ["d", "context"])
    suffix = behind.select((F.col("d") + 1).alias("d"), F.col("context").alias("suffix"), "byte",
                           F.col("n").alias("n_suffix"), F.col("all").alias("all_suffix"))
    own = behind.where("d > 0").withColumn("suffix", F.col("context").bitwiseAND(mask)).join(
        suffix, ["d", "suffix", "byte"])
    spread = F.when(F.col("d") == 1, 128.0).otherwise(weight)
    most = F.sum(F.col("n") * F.ln(
        F.col("n") / F.col("all") * (F.col("all_suffix") + spread) / F.col("n_suffix")))
    able = own.groupBy("d", "context").agg(most.alias("most")).where(F.col("most") >= gain - 1e-6)
    return able.select(F.explode(F.sequence(F.lit(0), F.col("d"))).alias("i"), "context").select(
        F.col("i").alias("d"),
        F.col("context").bitwiseAND(F.expr("shiftleft(1L, i * 8) - 1L")).alias("context")).distinct()


def fit_tree(
    documents: DataFrame, text: str = "text", depth: int = 5, least_share: float = 2e-6,
    gain: float = 8.0, weight: float = 4.0, parts: int = 64,
) -> SuffixTree:
    """Counts every byte of all texts behind its ``depth`` bytes, and keeps a suffix tree.

    Counting is spread over tasks, and so is the first part of the divergence test. Only contexts
    with at least ``least_share`` of all predicted bytes are tested, so at most ``depth /
    least_share`` contexts reach the driver, at any size; rarer ones are lost, whatever they would win.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, held = [], [], 0
        for batch in batches:
            for part in B.slices(pa.Table.from_batches([batch]), text, 4 << 20):
                key, value = np.unique(_grams(*spelled(blobs(part[text]), depth), depth),
                                       return_counts=True)
                keys.append(key)
                values.append(value.astype(np.int64))
                held += len(key)
                if held > 4_000_000:
                    key, value = _summed(keys, values)
                    keys, values, held = [key], [value], 0
                    if len(key) > 2_000_000:
                        yield B.ask(0, parts, key, value)
                        keys, values = [], []
        if keys:
            yield B.ask(0, parts, *_summed(keys, values))

    def add(table: pa.Table) -> pa.Table:
        key, value = _summed(B.unpack(table["keys"]), B.unpack(table["more"], np.int64))
        return pa.table({"gram": pa.array(key.astype(np.int64)), "n": pa.array(value)})

    grams = documents.select(text).mapInArrow(count, B.ASKED).groupBy("part").applyInArrow(
        add, "gram long, n long")
    mask = F.expr("shiftleft(1L, d * 8) - 1L")
    steps = (
        grams.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(depth))))
        .withColumn("context", F.shiftrightunsigned("gram", 8).bitwiseAND(mask))
        .withColumn("byte", F.col("gram").bitwiseAND(F.lit(255)))
        .groupBy("d", "context", "byte").agg(F.sum("n").alias("n")))
    nodes = steps.groupBy("d", "context").agg(
        F.sum("n").alias("all"), F.collect_list(F.struct("byte", "n")).alias("next"))
    total = nodes.where("d = 0").select(F.max("all").alias("_total"), F.lit(0).alias("_one"))
    nodes = nodes.withColumn("_one", F.lit(0)).join(F.broadcast(total), "_one").where(
        F.col("all") >= F.col("_total") * least_share)
    often = durable(nodes.select("d", "context", "next"))
    steps = often.select("d", "context", F.inline("next"))
    able = _may_stay(steps, gain, weight)
    sent = often.join(able, ["d", "context"], "left_semi").unionByName(often.where("d = 0")).select(
        "d", "context", F.transform("next", lambda x: x["byte"]).alias("bytes"),
        F.transform("next", lambda x: x["n"]).alias("counts"))
    counts: list[dict[int, Next]] = [{} for _ in range(depth + 1)]
    for row in sent.toLocalIterator():
        counts[row.d][row.context] = (
            np.array(row.bytes, dtype=np.uint8), np.array(row.counts, dtype=np.int64))
    release(often)
    return build_tree(counts, depth, gain, weight)


OUTPUT = "n_tokens long, n_known long, part_score double, score double"


def score(
    documents: DataFrame, training: str, tree: SuffixTree, text: str = "text",
    keep: tuple[str, ...] = ("doc_id",), block_bytes: int = 8 << 20,
) -> DataFrame:
    """Scores every text by the tree and by the smoothed word counts of the training rows.

    ``training`` names a boolean column: the rows whose words are counted. Columns: ``keep``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``. Tokens are the
    lower-cased words and one end; nulls and empty texts have the end alone. Each block asks for
    the counts of its different words, so a word that all texts hold is asked for once a block.
    Repeated rows count as often as they stand there. Without training rows the base is 0.
    """
    n = B.block_count(documents, text, block_bytes)
    texts = B.dealt(documents, n, *keep, training, text)
    shared = documents.sparkSession.sparkContext.broadcast(tree)

    def different(table: pa.Table):
        words = find_words(blobs(table[text]), lower=True)
        key, inverse = np.unique(words.hashes, return_inverse=True)
        return words, key, inverse

    def count(table: pa.Table) -> pa.Table:
        words, key, inverse = different(table)
        learn = np.array([bool(x) for x in table[training].to_pylist()], dtype=bool)
        own = np.bincount(inverse[learn[words.text]], minlength=len(key)).astype(np.int64)
        return pa.Table.from_batches([B.ask(table["block"][0].as_py(), n, key, own)])

    def totals(table: pa.Table):
        keys, values = B.unpack(table["keys"]), B.unpack(table["more"], np.int64)
        key, value = _summed(keys, values)
        return keys, key, value

    def answer(table: pa.Table) -> pa.Table:
        keys, key, value = totals(table)
        found = [value[np.searchsorted(key, x)].tobytes() for x in keys]
        return pa.table({"block": table["block"], "part": table["part"],
                         "counts": pa.array(found, pa.binary())})

    def size(table: pa.Table) -> pa.Table:
        _, _, value = totals(table)
        return pa.table({"words": pa.array([int((value > 0).sum())]),
                         "uses": pa.array([int(value.sum())])})

    def scored(table: pa.Table, answers: pa.Table) -> pa.Table:
        words, key, inverse = different(table)
        answers = answers.sort_by("part")
        known = np.empty(len(key), dtype=np.int64)
        known[np.argsort(B.parts_of(key, n), kind="stable")] = B.joined(
            B.unpack(answers["counts"], np.int64), np.int64)
        use = known[inverse]
        part = np.zeros(words.texts)
        np.add.at(part, words.text, np.log10(use + 0.5))
        tree = shared.value
        spelled = [tree.spelling(blobs(t[text])) for t in B.slices(table, text, 2 << 20)]
        spelled = np.concatenate(spelled) if spelled else np.zeros(0)
        uses = np.full(len(spelled), float(tree.texts))  # ends, where no word stands
        uses[np.arange(len(use)) + words.text] = use
        owner = np.repeat(np.arange(words.texts), words.counts() + 1)
        value = np.bincount(owner, tree.log10(spelled, uses), minlength=words.texts)
        return pa.table({
            **{f"c{i}": table[name] for i, name in enumerate(keep)},
            "n_tokens": pa.array(words.counts() + 1, pa.int64()),
            "n_known": pa.array(np.bincount(words.text[use > 0], minlength=words.texts), pa.int64()),
            "part_score": pa.array(part, pa.float64()),
            "score": pa.array(value, pa.float64())})

    asked = B.by_block(texts, count, B.ASKED)
    answers = asked.groupBy("part").applyInArrow(answer, "block int, part int, counts binary")
    words = asked.groupBy("part").applyInArrow(size, "words long, uses long").agg(
        F.coalesce(F.sum("words"), F.lit(0)).alias("_words"),
        F.coalesce(F.sum("uses"), F.lit(0)).alias("_uses"), F.lit(0).alias("_one"))
    ends = documents.where(training).agg(F.count("*").alias("_ends"), F.lit(0).alias("_one"))
    sizes = words.join(F.broadcast(ends), "_one")  # one row each
    kinds = dict(documents.dtypes)
    schema = ", ".join([*(f"c{i} {kinds[name]}" for i, name in enumerate(keep)), OUTPUT])
    # The end is a token like the words: as many uses as training texts.
    end = F.col("_ends")
    every = F.col("_uses") + end
    different_tokens = F.col("_words") + (end > 0).cast("long")
    return (
        B.with_answers(texts, answers, scored, schema).withColumn("_one", F.lit(0))
        .join(F.broadcast(sizes), "_one")
        .select(
            *(F.col(f"c{i}").alias(name) for i, name in enumerate(keep)), "n_tokens",
            (F.col("n_known") + (end > 0).cast("long")).alias("n_known"),
            every.alias("train_tokens"),
            F.when(every > 0, F.col("part_score") + F.log10(end + 0.5) - F.col("n_tokens") * F.log10(
                every + 0.5 * (different_tokens + 1))).otherwise(0.0).alias("base_score"),
            "score"))
