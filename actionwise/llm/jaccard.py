"""N-gram Jaccard join: every link between documents whose word-shingle sets have a Jaccard similarity of t or more.

1. Documents with the same set count as one (`set_key`); links are searched between different sets only.
2. Candidate groups come from prefixes: in one global order of shingles, two sets that are similar enough share one of their
   first n - ceil(t n) + 1 shingles. Common shingles come last in that order, by a count sketch of fixed size, so that a
   passage that many documents share doesn't bring them together.
3. Inside a group, each set is first held against the smallest one of its size band and the next smaller one. This finds most links
   with as many pairs as there are rows. Linked sets are joined to components.
4. Groups that still hold several components are cut into size-banded tiles. First each set of a tile is held against the nearest one of
   another component, then all pairs of a tile that still cross components are looked at: no link is lost, and no group of
   copies is expanded into pairs.

Every pair first meets its bitmaps: bit i holds the parity of the shingles hashed to i, so the number of bits in which
two bitmaps differ is at most the size of the symmetric difference, which bounds the overlap from above. What passes is decided
by the exact intersection of the sorted sets.

NULL and empty texts, or texts without words, have no shingle and no link. A text of fewer words than a shingle is
one shingle. Rows with a repeated doc_id keep their rows. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import chunked, components, given_back, has_columns, likely_in, mix, shingles, words_of

SKETCH = 1 << 17   # counters of the shingle sketch
HEAVY = 4          # deviations above the mean count from which a counter makes its shingles common
TILE = 512         # sets in a side of a tile
LEAST_BITS, MOST_BITS = 512, 1 << 15


def _runs(texts: pd.Series, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, shingles of each text) of consecutive texts."""
    for first, part in chunked(texts):
        words, at, _, _ = words_of(part)
        every = shingles(words, size)
        yield first, [every[b : e - size + 1] if e - b >= size else shingles(words[b:e], size) for b, e in zip(at[:-1], at[1:])]


def _sets(texts: pd.Series, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, runs in _runs(texts, size):
        for i, run in enumerate(runs):
            yield first + i, np.unique(run)


def bitmap(values: np.ndarray) -> bytes:
    """Parity bits of a set; the width is a power of two from the size of the set."""
    width = min(max(LEAST_BITS, 1 << int(max(len(values), 1) - 1).bit_length()), MOST_BITS)
    bits = np.bincount((mix(values) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, width: int) -> np.ndarray:
    """A bitmap brought down to `width` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, width), axis=0)


def differing(a: bytes, b: bytes) -> int:
    """At most the size of the symmetric difference of two sets."""
    width = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, width) ^ folded(b, width)).sum())


def set_key(values: np.ndarray) -> int:
    """A signed 64-bit key of a set."""
    both = np.array([np.bitwise_xor.reduce(mix(values)), np.sum(mix(~values), dtype=np.uint64)])
    return int((mix(both) * np.array([1, len(values) | 1], np.uint64)).sum(keepdims=True).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _sketch(docs: DataFrame, size: int) -> np.ndarray:
    """Shingle counts by hash: SKETCH numbers, however large the input."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for _, runs in _runs(batch["text"], size):
                total += np.bincount((np.concatenate(runs) >> np.uint64(47)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at.astype(np.int32), "n": total[at]})

    rows = docs.select("text").mapInPandas(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(SKETCH, np.int64)
    total[rows["slot"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return total


def _described(docs: DataFrame, size: int, percent: int, level: np.ndarray) -> DataFrame:
    """(doc_id, n, set_key, bits, prefix) of each document."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, values in _sets(batch["text"], size):
                n = len(values)
                if not n:
                    rows.append((0, None, None, None))
                    continue
                key = set_key(values)
                common = level[(values >> np.uint64(47)).astype(np.int64)]
                first = np.lexsort((values, common))[: prefix_length(n, percent)]
                rows.append((n, key, bitmap(values), values[first].view(np.int64)))
            out = pd.DataFrame(rows, columns=["n", "set_key", "bits", "prefix"])
            out["set_key"] = pd.array(out["set_key"], "Int64")
            yield out.assign(doc_id=batch["doc_id"].array)[["doc_id", "n", "set_key", "bits", "prefix"]]

    return docs.mapInPandas(describe, "doc_id bigint, n bigint, set_key bigint, bits binary, prefix array<bigint>")


def _passing(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of set keys that their bitmaps don't rule out."""
    side = lambda x: reps.select(F.col("set_key").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                (100 + percent) * differing(x, y) <= (100 - percent) * (n + m)
                for x, y, n, m in zip(batch["bits_a"], batch["bits_b"], batch["n_a"], batch["n_b"])
            ]
            yield batch.loc[keep, ["a", "b"]]

    return both.mapInPandas(look, "a bigint, b bigint")


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b, linked): exact intersections of the sorted sets, made again from the texts of the sets concerned."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_key")).distinct().join(reps, "set_key").select("set_key", "doc_id")

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [v.tobytes() for _, v in _sets(batch["text"], size)]
            yield pd.DataFrame({"set_key": batch["set_key"].array, "values": values})

    wanted = stage(wanted, "jaccard_wanted")
    texts = likely_in(docs, wanted, "doc_id").join(wanted, "doc_id").select("set_key", "text")
    sets = stage(texts.mapInPandas(arrays, "set_key bigint, values binary").dropDuplicates(["set_key"]), "jaccard_sets")

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["x"], batch["y"]):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * same >= percent * (len(a) + len(b) - same))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": linked})

    both = pairs.join(sets.select(F.col("set_key").alias("a"), F.col("values").alias("x")), "a")
    both = both.join(sets.select(F.col("set_key").alias("b"), F.col("values").alias("y")), "b")
    links = stage(both.mapInPandas(decide, "a bigint, b bigint, linked boolean"), "jaccard_links")
    given_back(wanted, sets)  # whole sets: much more than the links they decide
    return links


def _tiles(rows: DataFrame, reps: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs (a, b) of different components whose bitmaps pass, from groups (token, set_key, n, component).

    With `nearest`, only the pair of fewest differing bits is given for each set of a tile.
    Groups of the same sets are looked at once. A group is cut into blocks of TILE sets by size; a tile holds two blocks.
    """
    same = rows.groupBy("token").agg(F.sum(F.xxhash64("set_key") % (1 << 40)).alias("x"), F.expr("bit_xor(set_key)").alias("y"), F.count(F.lit(1)).alias("m"))
    once = same.groupBy("x", "y", "m").agg(F.min("token").alias("token"))
    placed = rows.join(once.select("token", "m"), "token")
    placed = placed.withColumn("block", F.expr(f"(row_number() OVER (PARTITION BY token ORDER BY n, set_key) - 1) div {TILE}"))
    other = F.explode(F.expr(f"sequence(0, (m - 1) div {TILE})")).alias("other")
    tiles = placed.select("token", "set_key", "n", "component", "block", other)
    tiles = tiles.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    tiles = tiles.join(reps.select("set_key", "bits"), "set_key")  # last: bitmaps are the most of a row, and go to their tiles alone

    def cross(one_block: bool, n: np.ndarray, key: np.ndarray, comp: np.ndarray, block: np.ndarray, raw: np.ndarray) -> np.ndarray:
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        out = []
        for width in np.unique(length):  # sets of similar size have bitmaps of the same width, or of twice that
            band = np.flatnonzero((length == width) | (length == 2 * width))
            bits = np.stack([folded(raw[k], width) for k in band])
            for at in np.flatnonzero(length[band] == width):
                x = band[at]
                near = (comp[band] != comp[x]) & (100 * np.minimum(n[x], n[band]) >= percent * np.maximum(n[x], n[band]))
                near &= ((length[band] > width) | (band > x)) & (one_block | (block[band] != block[x]))
                y = np.flatnonzero(near)
                if not len(y):
                    continue
                differ = np.bitwise_count(bits[y] ^ bits[at]).sum(axis=1, dtype=np.int64)
                fit = (100 + percent) * differ <= (100 - percent) * (n[band[y]] + n[x])
                y = band[y[fit]]
                if nearest and len(y):
                    y = y[[differ[fit].argmin()]]
                if len(y):
                    out.append(np.column_stack((np.minimum(key[x], key[y]), np.maximum(key[x], key[y]))))
        return np.concatenate(out) if out else np.empty((0, 2), np.int64)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            *tile, n, key, comp, block, raw = (batch[c].to_numpy() for c in ("token", "i", "j", "n", "set_key", "component", "block", "bits"))
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in tile], axis=0)) + 1
            ends = [0, *cuts.tolist()]
            one_block = tile[1] == tile[2]
            # most tiles hold a few sets: they are cut from the arrays of the batch
            found = [cross(bool(one_block[b]), *(c[b:e] for c in (n, key, comp, block, raw))) for b, e in zip(ends, ends[1:])]
            if found:
                yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])
            rest = batch.iloc[ends[-1] :]  # a tile that may go on in the next batch: 2 TILE rows at most
        if rest is not None and len(rest):
            last = (rest[c].to_numpy() for c in ("n", "set_key", "component", "block", "bits"))
            yield pd.DataFrame(cross(rest["i"].iat[0] == rest["j"].iat[0], *last), columns=["a", "b"])

    sorted_tiles = tiles.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "block", "n", "set_key")
    return sorted_tiles.mapInPandas(look, "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id reachable by links, itself included."""
    docs = has_columns(docs, ["doc_id", "text"])
    counts = _sketch(docs, size)
    mean = max(counts.mean(), 1.0)
    above = (counts - mean) / np.sqrt(mean)
    level = np.where(above >= HEAVY, np.floor(np.log2(np.maximum(above, 1.0))), 0).astype(np.int8)
    described = stage(_described(docs, size, percent, level), "jaccard_documents")
    some = described.filter("n > 0")
    reps = some.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    reps = stage(reps, "jaccard_sets")

    rows = some.select("set_key", "n", F.explode("prefix").alias("token")).repartition("token").dropDuplicates(["token", "set_key"])
    band = F.floor(F.log(F.col("n")) / float(-np.log(percent / 100))).cast("int")
    place = Window.partitionBy("token").orderBy("n", "set_key")
    rows = rows.withColumns({"band": band, "last": F.lag("set_key").over(place), "next": F.lead("set_key").over(place)})
    grouped = stage(rows.filter("last IS NOT NULL OR next IS NOT NULL").drop("next"), "jaccard_groups")
    head = F.first("set_key").over(Window.partitionBy("token", "band").orderBy("n", "set_key"))
    star = grouped.withColumn("head", head).select("n", F.col("set_key").alias("x"), F.explode(F.array("head", "last")).alias("y"))
    # here only pairs that meet in a tenth of their prefixes: this step need not find all
    pairs = star.filter("x <> y").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("met"), F.max("n").alias("n"))
    pairs = pairs.filter(F.col("met") * 1000 >= F.col("n") * (100 - percent)).select("a", "b")
    links = _verified(stage(_passing(pairs, reps, percent), "jaccard_pairs"), docs, reps, size, percent)
    for nearest in (True, False):
        near = stage(components(links.filter("linked").select("a", "b"), "jaccard_near"), "jaccard_near")
        known = grouped.select("token", "set_key", "n").join(near.withColumnRenamed("node", "set_key"), "set_key", "left")
        known = known.withColumn("component", F.coalesce("component", "set_key"))
        whole = Window.partitionBy("token")
        mixed = known.withColumns({"low": F.min("component").over(whole), "high": F.max("component").over(whole)}).filter("low < high")
        rest = _tiles(mixed.drop("low", "high"), reps, percent, nearest).join(links.select("a", "b"), ["a", "b"], "left_anti")
        rest = stage(rest, "jaccard_pairs")
        if rest.isEmpty():
            continue  # the round over all pairs comes also where no nearest pair is new
        links = links.unionByName(_verified(rest, docs, reps, size, percent))
    links = links.filter("linked").select("a", "b")
    comps = components(links).withColumnRenamed("node", "set_key")
    found = described.select("doc_id", F.col("n").alias("n_shingles"), "set_key").join(comps, "set_key", "left")
    found = found.withColumn("component", F.coalesce("component", "set_key"))
    least = found.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    return found.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Documents with the smallest doc_id of their component; rows without doc_id have no partner and stay."""
    found = jaccard_components(docs, size, percent).select("doc_id", "component_id").distinct()
    gone = found.filter("component_id < doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
