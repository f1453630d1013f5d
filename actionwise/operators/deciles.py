"""Exact score deciles without sorting or shuffling the scored users.

A decile is decided by at most nine cut rows: the last user of each tile in the order (score, hash of the key, key).
The cuts are found by narrowing down. Each step counts users with map-side combine, and keeps the places that hold a cut:

1. buckets of the score, a histogram of bounded size for scores of any scale and sign;
2. equal parts of the score range found in such a bucket, so that scores crowded into a narrow range spread out;
3. exact score and hash range inside such a part, so that users with one and the same score, however many, spread out;
4. the users of such a cell, numbered, give the cut rows.

Every user then gets 1 + the number of cuts below, a narrow expression: the scored table keeps its partitioning.
The result equals ``ntile(tiles) OVER (ORDER BY score NULLS FIRST, hash, key)``.

The first two steps read their input, so it should be a stored table rather than a long computation. What they leave, the users near a cut, is
written once for the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import finite, score_bucket
from ..functions.hashing import HASH_RANGE, hash32, hash32_sql
from ..sources.tables import stage
from ..specs import KEY, ActionSpec

PARTS = 16384        # equal parts a bucket is cut into
HASH_RANGES = 4096   # hash ranges that split users with the same score
NULL_SCORE = float("-inf")

_group = "action"


def _before(counts: DataFrame, group: Sequence[str], place: Sequence[str]) -> DataFrame:
    """Add the number of users ahead of each counted place inside its group."""
    window = Window.partitionBy(*group).orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("before", F.sum("n").over(window) - F.col("n"))


def _holding(places: DataFrame, needs: str) -> DataFrame:
    """Keep the places that hold wanted positions; `needs` becomes their positions inside the place."""
    inside = f"filter(transform({needs}, x -> x - before), x -> x BETWEEN 1 AND n)"
    return places.withColumn("needs", F.expr(inside)).filter(F.size("needs") > 0).drop("before", "n")


def _locate(rows: DataFrame, wanted: DataFrame, group: Sequence[str], place: Sequence[str]) -> DataFrame:
    """Count users per place and find the places that hold the wanted positions (group..., needs)."""
    counts = rows.groupBy(*group, *place).agg(F.count(F.lit(1)).alias("n"))
    return _holding(_before(counts, group, place).join(F.broadcast(wanted), list(group)), "needs")


def tile_cuts(scores: DataFrame, actions: Sequence[str], tiles: int = 10) -> DataFrame:
    """Cut rows: one row with a column per action, an ascending array of at most tiles - 1 structs (p, h, id).

    scores: (action, id, p), one row per scored user and action.
    The places with a cut number at most actions x (tiles - 1), which bounds every broadcast below.
    """
    rows = scores.select(
        _group, KEY, F.coalesce(F.col("p").cast("double"), F.lit(NULL_SCORE)).alias("p")
    ).withColumns({"bucket": score_bucket(F.col("p")), "c": finite(F.col("p")) / 2})

    bucket = [_group, "bucket"]
    counts = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
    counted = _before(counts.withColumn("total", F.sum("n").over(Window.partitionBy(_group))), [_group], ["bucket"])
    ends = f"transform(sequence(1, {tiles - 1}), k -> k * (total div {tiles}) + least(k, total % {tiles}))"
    in_bucket = _holding(counted, f"array_distinct({ends})").drop("total")

    part = [*bucket, "part"]
    share = F.try_divide(F.col("c") - F.col("low"), F.col("high") - F.col("low"))
    near = rows.join(F.broadcast(in_bucket.drop("needs")), bucket).withColumn(
        "part", F.coalesce(F.floor(share * PARTS), F.lit(0))
    )
    in_part = _locate(near, in_bucket.select(*bucket, "needs"), bucket, ["part"])

    # coalesce: the hash is never NULL, and saying so keeps it from being computed for a null filter on all users
    cell = [*part, "p", "hash_range"]
    nearer = near.join(F.broadcast(in_part.select(*part)), part, "left_semi")
    nearer = nearer.withColumn("h", F.coalesce(hash32(KEY), F.lit(0)))
    nearer = nearer.withColumn("hash_range", F.expr(f"coalesce(h div {HASH_RANGE // HASH_RANGES}, 0)"))
    nearer = stage(nearer.drop("c", "low", "high"), "near_cuts")
    in_cell = _locate(nearer, in_part, part, ["p", "hash_range"])

    place = F.row_number().over(Window.partitionBy(*cell).orderBy("h", KEY)).cast("bigint")
    numbered = nearer.join(F.broadcast(in_cell), cell).withColumn("place", place)
    cuts = [
        F.expr(f"array_sort(collect_list(struct(p, h, {KEY})) FILTER (WHERE {_group} = '{a}'))").alias(a) for a in actions
    ]
    return numbered.filter(F.array_contains("needs", F.col("place"))).agg(*cuts)


def tile_of(score: str, cuts: str, tiles: int) -> Column:
    """1 + number of cuts below (score, hash of the key, key).

    Only users whose score equals a cut score are hashed and fully compared; the one-element array holds such a user's
    values, so that they are built once and not per cut.
    """
    p = f"coalesce({score}, double('-Infinity'))"
    plain = " + ".join(f"CASE WHEN {p} > get({cuts}.p, {i}) THEN 1 ELSE 0 END" for i in range(tiles - 1))
    me = f"array(named_struct('p', {p}, 'h', {hash32_sql(KEY)}, '{KEY}', {KEY}))"
    exact = f"transform({me}, me -> size(filter({cuts}, c -> c < me)))[0]"
    return F.expr(f"1 + CASE WHEN array_contains({cuts}.p, {p}) THEN {exact} ELSE {plain} END")


def cut_deciles(df: DataFrame, actions: Sequence[ActionSpec], tiles: int = 10) -> DataFrame:
    """Deciles by cut rows: for any number of users. All actions share the same passes."""
    long = df.select(
        KEY,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a.name).alias(_group),
                        F.col(a.probability).cast("double").alias("p"),
                        F.col(a.scored).alias("scored"),
                    )
                    for a in actions
                ]
            )
        ),
    ).filter("scored")
    names = [a.name for a in actions]
    lookup = tile_cuts(long, names, tiles).select(F.struct(*names)).scalar()
    tile = {a.decile: tile_of(a.probability, f"_cuts_{a.name}", tiles) for a in actions}
    return (
        df.withColumn("_cuts", lookup)
        .withColumns({f"_cuts_{name}": F.col("_cuts")[name] for name in names})
        .withColumns({a.decile: F.when(F.col(a.scored), tile[a.decile]).otherwise(0).cast("int") for a in actions})
        .drop("_cuts", *[f"_cuts_{name}" for name in names])
    )


def with_deciles(df: DataFrame, actions: Sequence[ActionSpec], tiles: int = 10) -> DataFrame:
    """Add the decile column of every action to a wide score table (id, probabilities, scored markers).

    Users without a real score (`scored` is false) take no part and get 0.
    """
    return cut_deciles(df, actions, tiles)


def score_deciles(df: DataFrame, action: ActionSpec, tiles: int = 10) -> DataFrame:
    """Deciles of one action over all rows, 10 = most likely."""
    return with_deciles(df.withColumn(action.scored, F.lit(True)), [action], tiles).drop(action.scored)


def approx_deciles(df: DataFrame, action: ActionSpec, tiles: int = 10, accuracy: int = 1000) -> DataFrame:
    """Deciles from approximate score quantiles: one pass, equal scores always share a decile."""
    shares = [i / tiles for i in range(1, tiles)]
    edges = df.agg(F.percentile_approx(action.probability, shares, accuracy)).scalar()
    above = " + ".join(f"CASE WHEN {action.probability} > get(_edges, {i}) THEN 1 ELSE 0 END" for i in range(tiles - 1))
    return df.withColumn("_edges", edges).withColumn(action.decile, F.expr(f"1 + {above}")).drop("_edges")
