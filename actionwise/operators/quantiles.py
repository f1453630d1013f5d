"""Exact quantiles of many columns at once, without sorting or shuffling the rows.

A quantile is the value at a rank. For each wanted rank of each column a range that holds it is narrowed down, for all of them in the same pass:
rows inside a range are counted by parts of it, with map-side combine, and the part that holds the rank is the next range, from the least to the
greatest value seen there. It is done when these are equal. The first parts are the signs and the infinities; a range over more than a
factor of two is cut into parts of equal relative width, a narrower one into equal parts. So each pass makes a range PARTS times narrower, on one scale
or the other, and seven passes are enough for any doubles; whole numbers and tied values need two or three.

What is kept between passes is one row per column and rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 4096

RANGES = "column string, rank bigint, low double, high double, before bigint"


def cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) of the numbers that are there; NULL and NaN are left out."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("double"))]
    return df.select(F.stack(F.lit(len(columns)), *pairs).alias("column", "value")).filter("value IS NOT NULL AND NOT isnan(value)")


def _parts(rows: DataFrame, by: Sequence[str], part: str) -> DataFrame:
    """Rows per part, and how many come before it."""
    counts = rows.groupBy(*by, part).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    ahead = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))


def exact_quantiles(df: DataFrame, columns: Sequence[str], parts: int = 4) -> DataFrame:
    """(column, n, k, value): for k = 1 .. parts - 1 the least value that at least k / parts of a column's n values don't exceed.

    Columns without any value have no row. The input is read a few times, so it should be a stored table.
    """
    spark = df.sparkSession
    rows = cells(df, columns)
    sign = F.expr("sign(value) + CASE WHEN abs(value) = double('Infinity') THEN sign(value) ELSE 0 END")
    first = _parts(rows.withColumn("part", sign), ["column"], "part")
    total = first.withColumn("total", F.sum("n").over(Window.partitionBy("column")))
    ranks = f"transform(sequence(1, {parts - 1}), k -> struct(k, (k * total + {parts - 1}) div {parts} AS rank))"
    wanted = total.select("*", F.explode(F.expr(ranks)).alias("w")).filter("w.rank > ahead AND w.rank <= ahead + n")
    found = wanted.select("column", "total", "w.k", F.col("w.rank").alias("rank"), "low", "high", F.col("ahead").alias("before")).collect()
    # at most columns x (parts - 1) rows from here on
    numbers = {(r["column"], r["k"]): (r["total"], r["rank"]) for r in found}
    ranges = {(r["column"], r["rank"]): (r["low"], r["high"], r["before"]) for r in found}
    while open_ := [(c, rank, *r) for (c, rank), r in ranges.items() if r[0] < r[1]]:
        frame = spark.createDataFrame(open_, RANGES).withColumnsRenamed({"low": "from", "high": "to", "column": "_column"})
        inside = rows.join(F.broadcast(frame), F.expr("column = _column AND value >= from AND value <= to"))
        scales = "log2(abs(value)) AS v, log2(abs(from)) AS a, log2(abs(to)) AS b"
        inside = inside.selectExpr("column", "rank", "before", "value", "from", "to", *scales.split(", "))
        share = F.expr("CASE WHEN abs(b - a) > 1 THEN (v - a) / (b - a) ELSE (value / 2 - from / 2) / (to / 2 - from / 2) END")
        own = ["column", "rank", "before"]
        places = _parts(inside.withColumn("part", F.least(F.floor(share * PARTS), F.lit(PARTS - 1))), own, "part")
        for r in places.filter("rank > before + ahead AND rank <= before + ahead + n").collect():
            ranges[r["column"], r["rank"]] = (r["low"], r["high"], r["before"] + r["ahead"])
    out = [(c, n, k, ranges[c, rank][0]) for (c, k), (n, rank) in numbers.items()]
    return spark.createDataFrame(out, "column string, n bigint, k int, value double")
