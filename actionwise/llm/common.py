"""Helpers of the training-data operators: word hashes in numpy, connected components, staged tables."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import stage

BATCH_ROWS = 1000  # rows handed to Python at once: texts and bitmaps are large
BATCH_BYTES = 8 << 20  # and their bytes
CHUNK_BYTES = 1 << 20  # text handled at once inside a Python task
PART_BYTES = 1 << 18  # the same where arrays of it are made, which take a hundred times as much
COUNTED = 1 << 18  # keys that a Python task sends to be counted at once

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def small_batches(spark: SparkSession) -> None:
    """Hand fewer rows and bytes at once to Python in this session, unless it already asks for as few."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = int(re.sub(r"\D", "", spark.conf.get(name)) or 0)
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def given_back(*staged: DataFrame) -> None:
    """Empty the files of staged tables that nothing reads any more, so that they don't fill the shared folder."""
    for df in staged:
        files = df.inputFiles()
        if files:
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
            df.sparkSession.range(0).select(*none).write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


def memory_back() -> None:
    """Give freed memory back to the system: idle Python workers stay, with all that a step once took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of bytes: entry i covers the first i bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(_PRIME, len(data)), dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end), independent of where they stand."""
    raw = (prefix[ends] - prefix[starts]) * powers(_INVERSE, len(prefix))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_PRIME))


def chunked(texts: Sequence[str | bytes | None], limit: int = PART_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) of consecutive rows, of about `limit` bytes together; NULL counts as empty."""
    part: list[bytes] = []
    first = size = 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text if isinstance(text, bytes) else b""
        if part and size + len(raw) > limit:
            yield first, part
            part, first, size = [], i, 0
        part.append(raw)
        size += len(raw)
    if part:
        yield first, part


def words_of(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of several texts, the first word of each text (with an end), and byte bounds of the words.

    Words are runs of bytes other than space and \\t..\\r; A-Z count as a-z when `lower`.
    Bounds refer to the texts joined by one line feed.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if lower:
        data = _LOWER[data]
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return span_hash(prefix_hash(data), starts, ends), np.searchsorted(starts, at), starts, ends


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` words in a row; of all words together if there are fewer; none without words."""
    size = min(size, len(words))
    if not size:
        return np.empty(0, np.uint64)
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(_PRIME) + words[k : k + n])
    return out


def hex_hash(key: str | Column, seed: str = "") -> Column:
    """md5 of a value as text: the same in every engine."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(col.cast("string"), F.lit(seed)))


def has_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns: extra ones, whatever their names, take no part."""
    return df.select(*[F.col(f"`{n}`") for n in names])


SIEVE_BITS = 1 << 23  # 1 MB, however many keys


def likely_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be among `keys`: fewer rows to shuffle for the join that follows."""
    return sieved(df, keys, key).filter("_in").drop("_in")


def sieved(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows with `_in`: whether their key may be among `keys`, by a bit table of fixed size.

    The table is made by Spark's bitmap aggregate. With more keys it lets more rows pass, and never loses one.
    """
    slot = F.xxhash64(F.col(key)).bitwiseAND(F.lit(SIEVE_BITS - 1))
    # Spark counts the bits of a bitmap from value 1
    parts = keys.select((slot + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part"))
    rows = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    table = np.zeros(SIEVE_BITS // 8, np.uint8)
    for row in rows:  # at most SIEVE_BITS / 32768 rows of 4 KB
        table[(row["part"] - 1) * 4096 :][:4096] = np.frombuffer(row["bits"], np.uint8)
    bits = df.sparkSession.sparkContext.broadcast(table)

    def sift(batches):
        for batch in batches:
            number = batch.column(batch.schema.get_field_index("_slot")).to_numpy(zero_copy_only=False)
            hit = (bits.value[number >> 3] >> (number & 7).astype(np.uint8)) & 1
            columns = batch.drop_columns(["_slot"])
            yield pa.RecordBatch.from_arrays([*columns.columns, pa.array(hit.astype(bool))], names=[*columns.schema.names, "_in"])
        memory_back()

    schema = T.StructType([*df.schema.fields, T.StructField("_in", T.BooleanType())])
    return df.withColumn("_slot", slot).mapInArrow(sift, schema)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component bears its smallest node.

    Alternating large-star and small-star steps: every step replaces neighbours by the smallest one of a node, with
    map-side combine, so that a node with very many neighbours is no hot group. Each round is written and reread.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stage(pairs, name)
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        step = large.join(small, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("p"))
        last, now = now, stage(step.select(F.col("p.b").alias("a"), F.col("p.m").alias("b")).filter("a <> b").distinct(), name)
        given_back(last)
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def numbered(df: DataFrame, group: Sequence[str], coarse: Sequence[str], fine: Sequence[str], out: str) -> DataFrame:
    """Place (from 1) of each row inside its group in the order (coarse, fine), without one task for a group.

    Rows are counted per (group, coarse) with map-side combine; a running sum over these counts gives where each coarse
    place starts, and only its own rows are then numbered together. `coarse` must therefore have many values.
    """
    key = [*group, *coarse]
    run = Window.partitionBy(*group).orderBy(*coarse).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(*[F.col(c).alias(f"_{c}") for c in key], F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*key).orderBy(*fine))
    left = df.withColumn("_in", inside)
    match = F.lit(True)
    for c in key:
        match &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(starts, match).withColumn(out, F.col("_start") + F.col("_in")).drop("_in", "_start", *[f"_{c}" for c in key])


def recurring(docs: DataFrame, buckets: int, keys_of: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], width: int = 8) -> DataFrame:
    """(d, h, ordinals) of documents (d, h, text): their keys, by number in the document (4 bytes each), that occur again anywhere.

    Of a key, its bucket and `width` bytes of the rest are compared; with fewer than 8, a few keys more may come.

    keys_of gives (text number, key) of all keys of several texts, in order. Keys meet in buckets by their value. What a bucket knows of documents goes
    to these documents' own bucket in one row for all of them, so there are as many rows as pairs of buckets, however many documents.
    """

    def narrow(value: np.ndarray) -> bytes:
        return value.tobytes() if width == 8 else (value // np.uint64(buckets)).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()

    def widened(raw: bytes) -> np.ndarray:
        value = np.zeros((len(raw) // width, 8), np.uint8)
        value[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
        return value.reshape(-1).view(np.uint64)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[np.ndarray] = []
        found: list[tuple] = []
        size = rows = 0

        def packed() -> pd.DataFrame:
            every = np.concatenate(ids)
            doc, number, value = (np.concatenate([f[k] for f in found]) for k in range(3))
            to = (value % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            out = []
            for mine in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                used, at = np.unique(doc[mine], return_inverse=True)
                out.append((int(to[mine[0]]), every[used].tobytes(), at.astype("<u4").tobytes(), number[mine].astype("<u4").tobytes(), narrow(value[mine])))
            return pd.DataFrame(out, columns=["bucket", "docs", "doc", "number", "hash"])

        for batch in batches:
            both = batch[["d", "h"]].to_numpy(np.int64)
            for start, part in chunked(batch["text"]):
                of, value = keys_of(part)
                if not len(of):
                    continue
                ids.append(both[start : start + len(part)])
                found.append((of + rows, np.arange(len(of)) - np.searchsorted(of, of), value))
                rows += len(part)
                size += len(of)
                if size >= COUNTED:
                    yield packed()
                    ids, found, size, rows = [], [], 0, 0
        if found:
            yield packed()
        memory_back()

    def again(part: pd.DataFrame) -> pd.DataFrame:
        ids, doc, number, value, rows = [], [], [], [], 0
        for r in part.itertuples():
            ids.append(np.frombuffer(r.docs, np.int64).reshape(-1, 2))
            doc.append(np.frombuffer(r.doc, "<u4").astype(np.int64) + rows)
            number.append(np.frombuffer(r.number, "<u4"))
            value.append(widened(r.hash))
            rows += len(ids[-1])
        ids, doc, number, value = map(np.concatenate, (ids, doc, number, value))
        order = np.argsort(value, kind="stable")
        v = value[order]
        same = np.zeros(len(v) + 1, bool)
        same[1:-1] = v[1:] == v[:-1]
        kept = np.sort(order[same[1:] | same[:-1]])
        home = (mix(ids[:, 0].view(np.uint64) ^ mix(ids[:, 1].view(np.uint64))) % np.uint64(buckets)).astype(np.int64)
        kept = kept[np.lexsort((doc[kept], home[doc[kept]]))]
        out = []
        for mine in np.split(kept, np.flatnonzero(np.diff(home[doc[kept]])) + 1) if len(kept) else []:
            used, n = np.unique(doc[mine], return_counts=True)
            out.append((int(home[used[0]]), ids[used].tobytes(), n.astype("<u4").tobytes(), number[mine].tobytes()))
        memory_back()
        return pd.DataFrame(out, columns=["home", "docs", "n", "numbers"])

    def gathered(part: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in part["docs"]])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in part["n"]]).astype(np.int64)
        number = np.concatenate([np.frombuffer(x, "<u4") for x in part["numbers"]])
        used, of = np.unique(ids, axis=0, return_inverse=True)
        of = np.repeat(of.reshape(-1), n)
        order = np.argsort(of, kind="stable")
        parts = np.split(number[order], np.searchsorted(of[order], np.arange(1, len(used))))
        return pd.DataFrame({"d": used[:, 0], "h": used[:, 1], "ordinals": [p.astype("<u4").tobytes() for p in parts]})

    rows = docs.select("d", "h", "text").mapInPandas(send, "bucket int, docs binary, doc binary, number binary, hash binary")
    homes = rows.groupBy("bucket").applyInPandas(again, "home int, docs binary, n binary, numbers binary")
    return homes.groupBy("home").applyInPandas(gathered, "d bigint, h bigint, ordinals binary")
