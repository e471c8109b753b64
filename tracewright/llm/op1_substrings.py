"""Exact substring dedup with difference-cover anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm import blocks as B
from tracewright.llm.words import GRAM_STEPS, Words, blobs, find_words, grams, whole_grams

OUTPUT = "n_words long, n_removed long, kept string"


def difference_cover(period: int) -> tuple[int, ...]:
    """Residues whose pairwise differences give every residue; a greedy choice.

    For 7, 13, 21 and 31 a perfect difference set exists and the search finds it.
    """
    best: tuple[int, ...] = tuple(range(period))

    def extend(chosen: tuple[int, ...], covered: frozenset[int], limit: int):
        if len(covered) == period:
            return chosen
        if len(chosen) == limit or len(covered) + sum(
                2 * (len(chosen) + i) for i in range(limit - len(chosen))) < period:
            return None
        for nxt in range(chosen[-1] + 1, period):
            more = covered | {(nxt - c) % period for c in chosen} | {
                (c - nxt) % period for c in chosen}
            if found := extend((*chosen, nxt), frozenset(more), limit):
                return found
        return None

    for size in range(1, period):
        if found := extend((0,), frozenset((0,)), size):
            return found
    return best


def _anchors(words: Words, size: int, period: int, cover: np.ndarray):
    """Anchor hashes and the words they start at: only places of the cover, counted in the text."""
    hashes = grams(words.hashes, size)
    at = whole_grams(words, size)
    place = (at - words.firsts()[words.text[at]]) % period
    at = at[cover[place]]
    return hashes[at], at


def _windows(words: Words, size: int):
    at = whole_grams(words, size)
    first = grams(words.hashes, size)[at]
    return first, grams(words.hashes, size, GRAM_STEPS[1])[at], at


def _at_most_twice(first: np.ndarray, second: np.ndarray | None = None):
    """The keys sorted, none more than twice: a pair of equal keys tells of a repeat."""
    order = np.argsort(first, kind="stable") if second is None else np.lexsort((second, first))
    first = first[order]
    second = None if second is None else second[order]
    stay = np.ones(len(first), dtype=bool)
    third = first[2:] == first[:-2]
    if second is not None:
        third &= second[2:] == second[:-2]
    stay[2:] = ~third
    return first[stay], None if second is None else second[stay]


def _member(first, second, of_first, of_second) -> np.ndarray:
    """Which 128-bit keys are among the others."""
    if not len(of_first) or not len(first):
        return np.zeros(len(first), dtype=bool)
    order = np.lexsort((of_second, of_first))
    of_first, of_second = of_first[order], of_second[order]
    low = np.searchsorted(of_first, first, side="left")
    found = np.zeros(len(first), dtype=bool)
    todo = np.flatnonzero((low < len(of_first)) & (of_first[np.minimum(low, len(of_first) - 1)] == first))
    at = low[todo]
    while len(todo):  # one step, but for keys that share their first half
        hit = of_second[at] == second[todo]
        found[todo[hit]] = True
        todo, at = todo[~hit], at[~hit] + 1
        live = at < len(of_first)
        todo, at = todo[live], at[live]
        live = of_first[at] == first[todo]
        todo, at = todo[live], at[live]
    return found


def _kept(words: Words, removed: np.ndarray) -> list[bytes]:
    """Each text's words that stay, with one space between."""
    buffer = words.buffer.copy()
    buffer[words.ends] = 32
    edges = np.zeros(len(buffer) + 1, dtype=np.int8)
    edges[words.starts[~removed]] = 1
    edges[words.ends[~removed] + 1] -= 1
    keep = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    out = buffer[keep].tobytes()
    sizes = np.zeros(words.texts, dtype=np.int64)
    np.add.at(sizes, words.text[~removed], (words.ends - words.starts + 1)[~removed])
    ends = np.cumsum(sizes)
    return [out[e - n:max(e - 1, e - n)] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def remove_repeats(
    documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    window: int = 35, period: int = 21, block_bytes: int = 4 << 20,
) -> DataFrame:
    """Removes words in windows whose word sequence starts at another place too.

    One row per input row: the ``keep`` columns, ``n_words``, ``n_removed`` and ``kept``, the
    words that stay with one space between. Words are runs of characters other than space and
    0x09-0x0D; windows are judged on the input.

    Two equal windows of ``window`` words share an anchor of ``window - period + 1`` words that
    starts, in both texts, at a place of the difference cover modulo ``period``: only there
    anchors are hashed. Windows around an anchor that stands elsewhere too are then compared
    whole, by 128 bits. No list of partners is built, so a passage in every document costs one
    key per block of documents. Texts are read from one exchange, three times.

    Nulls and empty texts have no words; null ids are ids like others. Repeated rows are
    documents of their own, so their windows repeat. Further columns are ignored.
    """
    anchor = window - period + 1
    if anchor < 1:
        raise ValueError("the period must not exceed the window")
    cover = np.zeros(period, dtype=bool)
    cover[list(difference_cover(period))] = True
    n = B.block_count(documents, text, block_bytes)
    texts = B.dealt(documents, n, *keep, text)

    def anchors(table: pa.Table) -> pa.Table:
        words = find_words(blobs(table[text]))
        keys, _ = _anchors(words, anchor, period, cover)
        return pa.Table.from_batches(
            [B.ask(table["block"][0].as_py(), n, _at_most_twice(keys)[0])])

    def candidates(words: Words, known: np.ndarray):
        """Windows that hold an anchor which stands elsewhere, here or in another block."""
        keys, at = _anchors(words, anchor, period, cover)
        hit = np.isin(keys, known)
        reach = np.zeros(len(words.text) + 1, dtype=np.int32)
        np.add.at(reach, np.maximum(at[hit] - (window - anchor), 0), 1)
        np.add.at(reach, at[hit] + 1, -1)
        first, second, start = _windows(words, window)
        some = np.cumsum(reach)[start] > 0
        return first[some], second[some], start[some]

    def windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        known = B.joined(B.unpack(answers["keys"]))
        first, second, _ = candidates(find_words(blobs(table[text])), known)
        return pa.Table.from_batches(
            [B.ask(table["block"][0].as_py(), n, *_at_most_twice(first, second))])

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        words = find_words(blobs(table[text]))
        known = B.joined(B.unpack(answers["keys"])), B.joined(B.unpack(answers["more"]))
        first, second, start = _windows(words, window)
        again = _member(first, second, *known)
        edges = np.zeros(len(words.text) + 1, dtype=np.int32)
        edges[start[again]] += 1
        edges[start[again] + window] -= 1
        removed = np.cumsum(edges[:-1]) > 0
        gone = np.bincount(words.text[removed], minlength=words.texts)
        return pa.table({
            **{f"c{i}": table[name] for i, name in enumerate(keep)},
            "n_words": pa.array(words.counts(), pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "kept": pa.array(_kept(words, removed), pa.binary()).cast(pa.string()),
        })

    shared = B.shared_keys(B.by_block(texts, anchors, B.ASKED))
    repeated = B.shared_keys(B.with_answers(texts, shared, windows, B.ASKED))
    kinds = dict(documents.dtypes)
    schema = ", ".join([*(f"c{i} {kinds[name]}" for i, name in enumerate(keep)), OUTPUT])
    out = B.with_answers(texts, repeated, cut, schema)
    return out.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(keep)),
                      "n_words", "n_removed", "kept")


def digest(result: DataFrame) -> DataFrame:
    """The result with a SHA-256 of each kept text in its place."""
    return result.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


def brute_force(texts: list[str | None], window: int = 35) -> list[tuple[int, int, str]]:
    """The same, window by window, for tests."""
    import re

    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen: dict[tuple[str, ...], int] = {}
    for words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
