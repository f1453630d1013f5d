"""Value distributions of populations and how far two of them differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from .cumulative import running_totals
from .quantiles import cells, exact_quantiles

BINS = 20


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) per cell, values as text. Counting them combines on the map side."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return df.select(F.stack(F.lit(len(columns)), *pairs).alias("column", "value"))


def value_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, share) for all columns from one scan; NULL counts as a value."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    counts = _cells(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), rows))


def distribution_drift(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total-variation distance per column between two populations, 0 = same, 1 = disjoint.

    Both sides are counted in one aggregation instead of joining two distributions.
    """
    sides = _cells(a, columns).withColumn("side", F.lit("a")).unionByName(_cells(b, columns).withColumn("side", F.lit("b")))
    counts = sides.groupBy("column", "value").agg(
        F.count_if(F.col("side") == "a").alias("n_a"), F.count_if(F.col("side") == "b").alias("n_b")
    )
    total_a, total_b = a.agg(F.count(F.lit(1))).scalar(), b.agg(F.count(F.lit(1))).scalar()
    gap = F.abs(
        F.coalesce(ratio(F.col("n_a"), total_a), F.lit(0.0)) - F.coalesce(ratio(F.col("n_b"), total_b), F.lit(0.0))
    )
    return counts.groupBy("column").agg((F.sum(gap) / 2).alias("distance"))


def common_edges(reference: DataFrame, columns: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Inner edges of about equally full bins per column: exact quantiles of a reference population, equal ones once."""
    edges: dict[str, list[float]] = {c: [] for c in columns}
    for r in exact_quantiles(reference, columns, bins).orderBy("column", "k").collect():  # at most columns x (bins - 1) rows
        if r["value"] not in edges[r["column"]]:
            edges[r["column"]].append(r["value"])
    return edges


def _bin(column: str, edges: Sequence[float]) -> Column:
    """Number of the bin of a value: how many edges are below it; -1 for NULL."""
    value = F.col(column).cast("double")
    below = [F.when(value > e, 1).otherwise(0) for e in edges]
    return F.when(value.isNull(), F.lit(-1)).otherwise(reduce(add, below, F.lit(0))).cast("string")


def binned_distribution(populations: Mapping[str, DataFrame], edges: Mapping[str, Sequence[float]], categorical: Sequence[str] = ()) -> DataFrame:
    """(population, column, bin, n, share) of all columns of several populations, one aggregation for all.

    Bins of a number are numbered from 0 along the edges, a value on an edge belongs below it; bin -1 holds NULL. A categorical's
    bins are its values.
    """
    rows = None
    for name, df in populations.items():
        pairs = [x for c, own in edges.items() for x in (F.lit(c), _bin(c, own))]
        pairs += [x for c in categorical for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("-1")))]
        own = df.select(F.lit(name).alias("population"), F.stack(F.lit(len(pairs) // 2), *pairs).alias("column", "bin"))
        rows = own if rows is None else rows.unionByName(own)
    counts = rows.groupBy("population", "column", "bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("population", "column")))


def stability(binned: DataFrame, names: Sequence[str], reference: str) -> DataFrame:
    """(population, column, psi): population-stability index against a reference population, over the bins of either.

    Half a row is added to each bin, so that an empty one counts as rare rather than impossible.
    """
    others = [n for n in names if n != reference]
    wide = binned.groupBy("column", "bin").pivot("population", list(names)).agg(F.sum("n")).fillna(0, subset=list(names))
    own = Window.partitionBy("column")
    smooth = {f"_{n}": (F.col(f"`{n}`") + 0.5) / (F.sum(f"`{n}`").over(own) + 0.5 * F.count(F.lit(1)).over(own)) for n in names}
    shares = wide.withColumns(smooth)
    pairs = [x for n in others for x in (F.lit(n), (F.col(f"_{n}") - F.col(f"_{reference}")) * F.log(F.col(f"_{n}") / F.col(f"_{reference}")))]
    long = shares.select("column", F.stack(F.lit(len(others)), *pairs).alias("population", "part"))
    return long.groupBy("population", "column").agg(F.sum("part").alias("psi"))


def kolmogorov_smirnov(populations: Mapping[str, DataFrame], reference: str, columns: Sequence[str]) -> DataFrame:
    """(population, column, ks): the largest gap between the distribution functions of a population and of the reference, exact.

    Values are counted per column for all populations together; running totals need no task that holds a whole column.
    """
    rows = None
    for k, (name, df) in enumerate(populations.items()):
        own = cells(df, columns).withColumn("side", F.lit(k))
        rows = own if rows is None else rows.unionByName(own)
    names = list(populations)
    counts = [F.count_if(F.col("side") == k).alias(f"n{k}") for k in range(len(names))]
    points = rows.groupBy("column", "value").agg(*counts)
    totals = running_totals(points, [f"n{k}" for k in range(len(names))], ["column"], score="value")
    base = names.index(reference)

    def above(k: int) -> Column:
        return ratio(F.col(f"n{k}_to"), F.col(f"n{k}_all"))

    pairs = [x for k, n in enumerate(names) if k != base for x in (F.lit(n), F.abs(above(k) - above(base)))]
    gaps = totals.select("column", F.stack(F.lit(len(names) - 1), *pairs).alias("population", "gap"))
    return gaps.groupBy("population", "column").agg(F.max("gap").alias("ks"))


def drift(populations: Mapping[str, DataFrame], reference: str, numeric: Sequence[str], categorical: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """(population, column, psi, ks) of all columns and populations against the reference; ks is NULL for categoricals."""
    edges = common_edges(populations[reference], numeric, bins)
    psi = stability(binned_distribution(populations, edges, categorical), list(populations), reference)
    return psi.join(kolmogorov_smirnov(populations, reference, numeric), ["population", "column"], "left")


def profile(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = (), accuracy: int = 1000) -> DataFrame:
    """(column, n, mean, stddev, min, max[, quantiles]) per numeric column, typed, from one pass.

    Quantiles are approximate, within 1 / accuracy of the rank.
    """
    more = f", 'quantiles', percentile_approx(v, array({', '.join(map(str, quantiles))}), {accuracy})" if quantiles else ""
    fields = "'column', '{c}', 'n', count(v), 'mean', avg(v), 'stddev', stddev(v), 'min', min(v), 'max', max(v)" + more
    stats = [f"named_struct({fields})".replace("{c}", c).replace("(v", f"(double({c})") for c in columns]
    return df.selectExpr(f"array({', '.join(stats)}) AS stats").select(F.inline("stats"))


def exact_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`profile` with exact quartiles (p25, p50, p75): the least values that so much of the column doesn't exceed."""
    quartiles = exact_quantiles(df, columns, 4).groupBy("column").pivot("k", [1, 2, 3]).agg(F.first("value"))
    return profile(df, columns).join(quartiles.withColumnsRenamed({"1": "p25", "2": "p50", "3": "p75"}), "column", "left")
