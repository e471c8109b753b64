"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm import blocks as B
from tracewright.llm.words import Words, blobs, find_words, prefix_hashes

PREFIXES = (4, 5, 7)
#: Places without a word after each text, so that the widest filter fits into an empty one.
PADS = 3


@dataclass
class ToxicityModel:
    """Filters over summed embeddings of each word and of its first bytes; max pooling."""

    embeddings: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    dense: np.ndarray
    intercept: float
    thresholds: dict[str, float] = field(default_factory=dict)
    default_threshold: float = 0.7

    def features(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Words]:
        """Bucket ids of each different word, and for each place its word (-1 a pad)."""
        words = find_words(texts, lower=True, letters=True)
        _, sample, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        buckets = len(self.embeddings)
        ids = np.stack([words.hashes[sample] % np.uint64(buckets)] + [
            prefix_hashes(words, sample, size) % np.uint64(buckets) for size in PREFIXES])
        counts = words.counts()
        places = np.full(len(inverse) + PADS * len(texts), -1, dtype=np.int64)
        places[np.arange(len(inverse)) + PADS * words.text.astype(np.int64)] = inverse
        return ids.astype(np.int64), places, counts + PADS

    def pooled(self, vectors: np.ndarray, places: np.ndarray, counts: np.ndarray):
        """Largest value of each filter in each text, and the place it stands at."""
        ends = np.cumsum(counts)
        starts = ends - counts
        best, where = [], []
        for width, weights in self.filters.items():
            n = len(places) - width + 1
            out = np.zeros((n, weights.shape[2]), dtype=np.float32)
            for shift in range(width):
                out += (vectors @ weights[shift])[places[shift:n + shift]]
            owner_end = np.repeat(ends, counts)[:n]
            out[np.arange(n) + width > owner_end] = -np.inf
            top = np.maximum.reduceat(out, starts)
            best.append(top)
            where.append((out, top))
        return best, where, starts

    def logits(self, texts: list[bytes]) -> np.ndarray:
        ids, places, counts = self.features(texts)
        vectors = np.vstack([self.embeddings[ids].sum(axis=0),
                             np.zeros((1, self.embeddings.shape[1]), dtype=np.float32)])
        best, _, _ = self.pooled(vectors, places, counts)
        hidden = np.concatenate(
            [np.maximum(b + self.biases[w], 0) for w, b in zip(self.filters, best, strict=True)], 1)
        return hidden @ self.dense + self.intercept

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.logits(texts).astype(np.float64), -30, 30)))

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang, self.default_threshold)


def train(
    texts: list[bytes], labels: np.ndarray, langs: list[str | None], buckets: int = 1 << 15,
    size: int = 16, widths: tuple[int, ...] = (1, 2, 3), filters: int = 8, epochs: int = 6,
    batch: int = 32, rate: float = 0.05, default_threshold: float = 0.7,
) -> ToxicityModel:
    """Adagrad on the log loss; a fifth of the rows sets the thresholds by language.

    Without both labels the score is the share of toxic rows (0.5 without rows).
    """
    random = np.random.default_rng(7)
    labels = np.asarray(labels, dtype=np.float32)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    model = ToxicityModel(
        random.normal(0, 0.1, (buckets, size)).astype(np.float32),
        {w: random.normal(0, (1 / (w * size)) ** 0.5, (w, size, filters)).astype(np.float32)
         for w in widths},
        {w: np.zeros(filters, dtype=np.float32) for w in widths},
        random.normal(0, 0.1, filters * len(widths)).astype(np.float32),
        float(np.log(share / (1 - share))), {}, default_threshold)
    if len(set(labels.tolist())) < 2:
        model.dense[:] = 0
        return model
    order = random.permutation(len(texts))
    fit, held = order[len(order) // 5:], order[:len(order) // 5]
    _start(model, [texts[i] for i in fit], labels[fit], share)
    square = {"e": np.full(model.embeddings.shape, 1e-3, np.float32),
              "d": np.full(model.dense.shape, 1e-3, np.float32), "i": 1e-3}
    square |= {("w", w): np.full(model.filters[w].shape, 1e-3, np.float32) for w in widths}
    square |= {("b", w): np.full(filters, 1e-3, np.float32) for w in widths}

    def step(name, grad):
        square[name] += grad * grad
        return rate * grad / np.sqrt(square[name])

    for _ in range(epochs):
        for at in range(0, len(fit), batch):
            rows = fit[at:at + batch]
            ids, places, counts = model.features([texts[i] for i in rows])
            vectors = np.vstack([model.embeddings[ids].sum(axis=0), np.zeros((1, size), np.float32)])
            best, where, starts = model.pooled(vectors, places, counts)
            hidden = np.concatenate([np.maximum(b + model.biases[w], 0)
                                     for w, b in zip(widths, best, strict=True)], 1)
            logit = hidden @ model.dense + model.intercept
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[rows]) / len(rows)
            back = np.outer(error, model.dense) * (hidden > 0)
            model.dense -= step("d", hidden.T @ error)
            model.intercept -= float(step("i", float(error.sum())))
            grad = np.zeros_like(vectors)
            owner = np.repeat(np.arange(len(rows)), counts)
            for k, (w, (out, top)) in enumerate(zip(widths, where, strict=True)):
                part = back[:, k * filters:(k + 1) * filters]
                place, f = np.nonzero(out == top[owner[:len(out)]])
                text = owner[place]
                _, first = np.unique(text * filters + f, return_index=True)  # ties: the leftmost
                place, f, text = place[first], f[first], text[first]
                g = part[text, f][:, None]
                change = np.zeros_like(model.filters[w])
                for shift in range(w):
                    word = places[place + shift]
                    np.add.at(grad, word, g * model.filters[w][shift][:, f].T)
                    np.add.at(change[shift].T, f, g * vectors[word])
                model.filters[w] -= step(("w", w), change)
                model.biases[w] -= step(("b", w), part.sum(axis=0))
            grad = grad[:-1]  # a pad has no embedding
            used = np.flatnonzero(np.any(grad, axis=1))
            for level in ids:
                whole = np.zeros((len(used), size), np.float32)
                bucket, inverse = np.unique(level[used], return_inverse=True)
                whole = np.zeros((len(bucket), size), np.float32)
                np.add.at(whole, inverse, grad[used])
                square["e"][bucket] += whole * whole
                model.embeddings[bucket] -= rate * whole / np.sqrt(square["e"][bucket])
    scores = np.concatenate([model.scores([texts[i] for i in held[a:a + batch]])
                             for a in range(0, len(held), batch)]) if len(held) else np.zeros(0)
    for lang in {langs[i] for i in held} - {None}:
        own = np.array([langs[i] == lang for i in held])
        if labels[held][own].sum() >= 5:
            model.thresholds[lang] = _threshold(scores[own], labels[held][own], default_threshold)
    return model


def _start(model: ToxicityModel, texts: list[bytes], labels: np.ndarray, share: float) -> None:
    """First embedding value: shrunk log odds of the texts that hold the bucket. The first
    filter of each width reads it at its first word, and training goes on from there."""
    seen = np.zeros((2, len(model.embeddings)))
    for at in range(0, len(texts), 64):
        part = texts[at:at + 64]
        ids, places, counts = model.features(part)
        owner = np.repeat(np.arange(len(part)), counts)
        for level in ids:
            own = places >= 0
            pairs = np.unique(owner[own] * len(model.embeddings) + level[places[own]])
            np.add.at(seen, (labels[at + pairs // len(model.embeddings)].astype(int),
                             pairs % len(model.embeddings)), 1)
    odds = (seen[1] + 4 * share) / (seen[0] + 4 * (1 - share)) * (1 - share) / share
    model.embeddings[:, 0] = np.log(odds)
    for weights in model.filters.values():
        weights[:, 0, :] = 0
        weights[0, :, 0] = 0
        weights[0, 0, 0] = 1
        model.biases[weights.shape[0]][0] = -3
    model.dense[::weights.shape[2]] = 0.5


def _threshold(scores: np.ndarray, labels: np.ndarray, default: float) -> float:
    """The cut with the best F1; of equal ones, that nearest to ``default``."""
    cuts = np.linspace(0.3, 0.95, 66)
    hits = scores[None, :] >= cuts[:, None]
    f1 = 2 * (hits & (labels == 1)).sum(1) / (hits.sum(1) + labels.sum())
    good = cuts[f1 >= f1.max() - 1e-12]
    return float(good[np.argmin(np.abs(good - default))])


def fit(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
    label: str = "toxic", lang: str = "lang", max_rows: int = 5_000, max_bytes: int = 16_384,
    **options,
) -> ToxicityModel:
    """Learns from at most ``max_rows`` labelled texts of up to ``max_bytes`` bytes.

    The ids are chosen by their hash from ``labels`` alone, so nothing but this bounded sample,
    80 MB at most, is broadcast or seen by the driver, and no text is shuffled to find it.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(id_column).agg(F.max(label).cast("double").alias("_label"))
        .orderBy(F.xxhash64(id_column), id_column).limit(max_rows))
    rows = (
        documents.select(id_column, text, lang).join(F.broadcast(chosen), id_column)
        .where(F.octet_length(F.coalesce(F.col(text), F.lit(""))) <= max_bytes)
        .limit(max_rows).orderBy(F.xxhash64(id_column, text), lang).toArrow())
    return train(blobs(rows[text]), rows["_label"].to_numpy(), rows[lang].to_pylist(), **options)


def score(
    documents: DataFrame, model: ToxicityModel, text: str = "text", lang: str = "lang",
    slice_bytes: int = 1 << 20,
) -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``flagged``, whether it reaches the threshold
    of the row's language. The text alone makes the score; a null text is an empty one. Columns
    of these names are replaced; all others stay, and so do repeated rows."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = documents.drop("score", "flagged")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part in B.slices(pa.Table.from_batches([batch]), text, slice_bytes):
                values = net.scores(blobs(part[text]))
                cuts = np.array([net.threshold(x) for x in part[lang].to_pylist()])
                part = part.append_column("score", pa.array(values, pa.float64()))
                part = part.append_column("flagged", pa.array(values >= cuts, pa.bool_()))
                yield from part.combine_chunks().to_batches()

    more = [T.StructField("score", T.DoubleType()), T.StructField("flagged", T.BooleanType())]
    return rows.mapInArrow(scored, T.StructType([*rows.schema.fields, *more]))
