"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is turned by one random rotation and kept as the signs of its components: one bit each, packed, with two correction
scalars (length, and inner product of the unit vector with its code). From a code, the inner product with a query can be estimated without bias,
within an error bound that holds but with a very small chance. Queries meet codes block by block: a vector is looked at exactly
only if the upper end of its estimate reaches the k-th best lower end. What is left is ranked by exact inner products in double precision.

The rotation comes from a seed; nothing is fitted, and every row is coded. Queries are a stated part of the rows and go block against block, so the
work is (queries x rows), spread over tasks of bounded size.

Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do those of another dimension than most.
Copies of a vector are candidates of their own; ties go to the smaller vec_id. Rows without vec_id take no part. Repeated ids are rows of their own.
Extra columns take no part. With fewer than k candidates, all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import has_columns

BLOCK = 4096        # vectors in a block
QUERY_BLOCK = 1024  # queries in a block
SPREAD = 4.0        # standard deviations inside the error bound
SEED = 5


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, components as doubles."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = vectors.filter("vec_id IS NOT NULL").select("vec_id", v.alias("vector")).filter(finite & F.exists("vector", lambda x: x != 0))
    sizes = kept.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.agg(F.max_by("size", F.struct("n", "size")))
    return kept.filter(F.size("vector") == common.scalar())


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def coded(vectors: DataFrame, block: Column) -> DataFrame:
    """(block, vec_id, code, length, inner, vector): packed signs, length, and inner product of unit vector and code."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["vector"])
            length = np.linalg.norm(x, axis=1)
            turned = (x / length[:, None]) @ rotation(x.shape[1])
            inner = np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])
            yield pd.DataFrame({
                "block": batch["block"], "vec_id": batch["vec_id"], "code": [c.tobytes() for c in np.packbits(turned > 0, axis=1)],
                "length": length, "inner": inner, "vector": [v.tobytes() for v in x],
            })

    rows = vectors.withColumn("block", block)
    return rows.mapInPandas(code, "block int, vec_id bigint, code binary, length double, inner double, vector binary")


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int, spread: float = SPREAD) -> pd.DataFrame:
    """The k nearest rows of one block for each query: bounds from codes, then exact inner products."""
    x = np.stack([np.frombuffer(v) for v in rows["vector"]])
    q = np.stack([np.frombuffer(v) for v in queries["vector"]])
    ids, dim = rows["vec_id"].to_numpy(), x.shape[1]
    signs = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in rows["code"]]), axis=1, count=dim).astype(np.float32) * 2 - 1
    length, inner = rows["length"].to_numpy(), rows["inner"].to_numpy()
    q_length = np.linalg.norm(q, axis=1)
    turned = ((q / q_length[:, None]) @ rotation(dim)).astype(np.float32)
    estimate = (turned @ signs.T) / np.sqrt(dim) / inner * length          # times the query's length: the same for all
    error = spread * np.sqrt(np.maximum(1 - inner**2, 0) / max(dim - 1, 1)) / inner * length
    lower, upper = estimate - error, estimate + error
    out = []
    for i, own in enumerate(queries["vec_id"].to_numpy()):
        other = ids != own
        if other.sum() > k:
            bar = np.partition(np.where(other, lower[i], -np.inf), -k)[-k]
            near = np.flatnonzero(other & (upper[i] >= bar))
        else:
            near = np.flatnonzero(other)
        exact = np.sum(x[near] * q[i], axis=1)
        order = np.lexsort((ids[near], -exact))[:k]
        out.append(pd.DataFrame({"query_id": own, "vec_id": ids[near[order]], "score": exact[order]}))
    return pd.concat(out, ignore_index=True)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row whose vec_id is divisible by `every`."""
    kept = stage(usable(has_columns(vectors, ["vec_id", "embedding"])), "vectors")
    n = kept.count()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-n // (every * QUERY_BLOCK)))
    spot = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    index = stage(coded(kept, spot(blocks)), "vector_codes")
    asked = index.filter(F.col("vec_id") % every == 0).select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int").alias("part"))
    # every block of codes meets every block of queries
    left = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def meet(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return search_block(queries, rows, k)

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
