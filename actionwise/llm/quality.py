"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are numbers of a text alone (shares of kinds of characters, word lengths, repetition, ...). Trees are grown level by level on
binned statistics and flattened into arrays; scoring walks all rows of a batch down one level at a time in numpy.

The model is fitted on at most `max_train` labelled rows, drawn by the hash of their doc_id (a documented bound: the statistics
of 20,000 rows are 4 MB). Everything else covers all rows. NULL and empty texts have statistics too (all 0) and get a score. Repeated
doc_ids keep their rows; extra columns take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunked, has_columns, hex_hash, words_of

MAX_TRAIN = 20_000

# Kind of each byte of UTF-8: 0 other ASCII sign, 1 space, 2 lower, 3 upper, 4 digit, 5 sentence sign, 6 line feed, 7 start of a longer
# character, 8 its other bytes
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 11, 12, 13, 32]] = 1
_KIND[97:123] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_KIND[[44, 46, 58, 59, 33, 63]] = 5
_KIND[10] = 6
_KIND[192:] = 7
_KIND[128:192] = 8
KINDS = 9
FEATURES = KINDS + 13


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES numbers per text."""
    n = len(texts)
    words, at, starts, ends = words_of(texts)
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    kind = _KIND[data]
    of_byte = np.repeat(np.arange(n), size + 1)[: len(data)]
    per = np.bincount(of_byte * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS).astype(float)
    per[: n - 1, 6] -= 1  # the line feed between texts
    count = np.diff(at).astype(float)
    of_word = np.repeat(np.arange(n), np.diff(at))
    length = (ends - starts).astype(float)
    total = np.bincount(of_word, length, n)
    square = np.bincount(of_word, length**2, n)
    longest = np.zeros(n)
    np.maximum.at(longest, of_word, length)
    order = np.lexsort((words, of_word))
    w, o = words[order], of_word[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[new], minlength=n)
    runs = np.diff(np.append(np.flatnonzero(new), len(w)))
    top = np.zeros(n)
    np.maximum.at(top, o[new], runs)
    again = np.zeros(len(words))
    if len(words) > 1:
        again[1:] = (words[1:] == words[:-1]) & (of_word[1:] == of_word[:-1])
    last = kind[ends - 1] if len(ends) else np.empty(0, np.uint8)
    odd_end = np.bincount(of_word, (last == 0) | (last == 4), n) if len(ends) else np.zeros(n)
    sentence = np.bincount(of_word, last == 5, n) if len(ends) else np.zeros(n)
    lines = np.zeros((n, 3))
    for i, t in enumerate(texts):
        seen = Counter(t.split(b"\n"))
        m = sum(seen.values())
        lines[i] = (m, len(seen) / m, max(seen.values()) / m)
    out = np.column_stack([
        _ratio(per, size[:, None]), np.log1p(size), np.log1p(count), _ratio(total, count), np.sqrt(np.maximum(_ratio(square, count) - _ratio(total, count) ** 2, 0)),
        longest, _ratio(distinct, count), _ratio(top, count), _ratio(np.bincount(of_word, again, n), count),
        _ratio(odd_end, count), _ratio(sentence, count), np.log1p(lines[:, 0]), lines[:, 1], lines[:, 2],
    ])
    out[size == 0] = 0
    return out.astype(np.float32)


@dataclass
class Trees:
    """Trees as arrays: node k of a tree has the children 2k + 1 and 2k + 2; leaves stand on the last level."""

    edges: np.ndarray     # (features, bins - 1) upper edges of the bins
    feature: np.ndarray   # (trees, inner nodes)
    split: np.ndarray     # (trees, inner nodes) bins up to this one go left
    value: np.ndarray     # (trees, leaves)
    base: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        bins, inner = self.binned(rows), self.feature.shape[1]
        margin, lines, depth = np.full(len(rows), self.base), np.arange(len(rows)), inner.bit_length()
        for feature, split, value in zip(self.feature, self.split, self.value):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (bins[lines, feature[node]] > split[node])
            margin += value[node - inner]
        return 1 / (1 + np.exp(-margin))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2, least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Boost on the logistic loss. Without rows of both labels, every score is the share of label 1 (one half without rows)."""
    inner, nf = 2**depth - 1, rows.shape[1]
    positive = (labels.sum() + 0.5) / (len(labels) + 1)
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    edges = np.quantile(rows, cuts, axis=0).T.astype(np.float32) if len(rows) else np.zeros((nf, bins - 1), np.float32)
    model = Trees(edges, np.zeros((trees, inner), np.int64), np.full((trees, inner), bins, np.int64), np.zeros((trees, inner + 1)), float(np.log(positive / (1 - positive))))
    if not 0 < labels.sum() < len(labels):
        return model
    binned = model.binned(rows).astype(np.int64)
    margin = np.full(len(labels), model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = labels - p, p * (1 - p)
        node = np.zeros(len(labels), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first) * nf)[:, None] * bins + np.arange(nf) * bins + binned
            g, h, c = (np.bincount(cell.ravel(), np.repeat(w, nf), width * nf * bins).reshape(width, nf, bins).cumsum(axis=2) for w in (grad, hess, np.ones(len(labels))))
            gain = g**2 / (h + ridge) + (g[..., -1:] - g) ** 2 / (h[..., -1:] - h + ridge) - g[..., -1:] ** 2 / (h[..., -1:] + ridge)
            gain[(c < least) | (c[..., -1:] - c < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            model.feature[t, first : first + width] = np.where(good, best // bins, 0)
            model.split[t, first : first + width] = np.where(good, best % bins, bins)
            node = 2 * node + 1 + (binned[np.arange(len(node)), model.feature[t, node]] > model.split[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        model.value[t] = rate * g / (h + ridge)
        margin += model.value[t, leaf]
    return model


def with_statistics(docs: DataFrame, keys: list[str]) -> DataFrame:
    """The key columns and `stats`, the statistics of the text."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = np.concatenate([statistics(part) for _, part in chunked(batch["text"])] or [np.empty((0, FEATURES), np.float32)])
            yield batch[keys].assign(stats=list(rows))

    return docs.select(*keys, "text").mapInPandas(describe, f"{kinds}, stats array<float>")


def train(docs: DataFrame, labels: DataFrame, label: str, max_train: int = MAX_TRAIN, **options) -> Trees:
    """Fit on at most `max_train` rows of labels (doc_id, label), drawn by hash. Only this bounded draw is broadcast."""
    drawn = labels.filter(F.col(label).isin(0, 1)).orderBy(hex_hash("doc_id", "|draw"), label).limit(max_train)
    known = docs.join(F.broadcast(drawn), "doc_id")
    rows = with_statistics(known, ["doc_id", label]).toPandas().sort_values(["doc_id", label], kind="stable")
    stats = np.stack(rows["stats"]) if len(rows) else np.empty((0, FEATURES), np.float32)
    return fit(stats, rows[label].to_numpy(float), **options)


def scored(docs: DataFrame, model: Trees, inside: str | None = None) -> DataFrame:
    """All columns of the documents and `score`, the chance of label 1. The text is a column, or a field of the struct `inside`."""
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(inside or "text"))
            texts = column.field("text") if inside else column
            parts = [model.scores(statistics(part)) for _, part in chunked(texts.to_pylist())]
            score = pa.array(np.concatenate(parts) if parts else np.empty(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(score, schema)


def held_out() -> Column:
    """Rows never learned from: crc32 of the doc_id as text has the remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Trees:
    known = has_columns(labels, ["doc_id", "quality"]).filter(~held_out())
    return train(has_columns(docs, ["doc_id", "text"]), known, "quality", max_train)


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = quality_model(docs, labels, max_train)
    rated = scored(has_columns(docs, ["doc_id", "text"]), model)
    return rated.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_train: int = MAX_TRAIN) -> DataFrame:
    """Documents whose score reaches the threshold, with their own columns."""
    rows = docs.select(F.struct("*").alias("_doc"))  # the text goes to Python once, with its row
    return scored(rows, quality_model(docs, labels, max_train), "_doc").filter(F.col("score") >= threshold).select("_doc.*")
