"""Mergeable state per user and day: features and targets for any cutoff without another pass over the facts.

A day's facts are reduced once to one row per user. Counts, sums, first and last days can be merged over any days, so a profile for a
cutoff is an aggregation of these rows; a new day appends its rows, and rows of one user and day that arrive in parts merge likewise. The
state is much smaller than the facts, and stored by month, so that a short window reads few files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import KEY
from .starschema import PRIORITIES, Period, profile_of

SUMS = ["n", "amt", "items", "returned", "status_p", *[short for _, short in PRIORITIES.values()]]


def daily_state(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """(id, day, sums): one row per user and day with orders. Items are reduced per order before they meet the orders."""
    items = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("l_returnflag") == "R").alias("returned")
    )
    facts = orders.join(items, orders["o_orderkey"] == items["l_orderkey"], "left")
    sums = {
        "n": "count(1)", "amt": "sum(o_totalprice)", "items": "sum(items)", "returned": "sum(returned)",
        "status_p": "count_if(o_orderstatus = 'P')",
        **{short: f"count_if(o_orderpriority = '{priority}')" for priority, short in PRIORITIES.values()},
    }
    by = [F.col("o_custkey").alias(KEY), F.to_date("o_orderdate").alias("day")]
    return facts.groupBy(*by).agg(*[F.expr(e).alias(c) for c, e in sums.items()])


def merged(*states: DataFrame) -> DataFrame:
    """One state of several: of other days, or of parts of the same days."""
    rows = states[0]
    for state in states[1:]:
        rows = rows.unionByName(state)
    return rows.groupBy(KEY, "day").agg(*[F.sum(c).alias(c) for c in SUMS])


def write_state(state: DataFrame, path: str, mode: str = "append") -> None:
    state.withColumn("month", F.date_format("day", "yyyy-MM")).write.mode(mode).partitionBy("month").parquet(path)


def read_state(spark: SparkSession, path: str, until: str | None = None) -> DataFrame:
    """The stored state, of months up to a day's if one is given; parts of a day are merged by whoever sums them."""
    rows = spark.read.parquet(path)
    rows = rows if until is None else rows.filter(F.col("month").cast("string") <= until[:7])
    return rows.drop("month")


def activity_at(state: DataFrame, period: Period, eligible: DataFrame | None = None) -> DataFrame:
    """What `starschema.user_activity` counts from the facts, for a period, from the state.

    With `eligible` (a frame with the user key) only these users' rows are read on: a semi-join on the key, for which Spark puts a
    Bloom filter of the keys on the scan where the state is large.
    """
    rows = state.filter(F.col("day") < F.lit(period.as_of))
    if eligible is not None:
        rows = rows.join(eligible.select(KEY), KEY, "left_semi")
    past, recent = (f"FILTER (WHERE day {op} DATE'{period.cutoff}')" for op in ("<", ">="))
    aggregates = {
        "n_orders": f"sum(n) {past}",
        "amt_sum": f"round(sum(amt) {past}, 2)",
        "first_at": f"min(day) {past}",
        "last_at": f"max(day) {past}",
        "n_items": f"sum(items) {past}",
        "n_returned": f"sum(returned) {past}",
        "w_returned": f"sum(returned) {recent}",
        "w_status_p": f"coalesce(sum(status_p) {recent}, 0)",
    }
    for _, short in PRIORITIES.values():
        aggregates[f"n_{short}"] = f"coalesce(sum({short}) {past}, 0)"
        aggregates[f"w_{short}"] = f"coalesce(sum({short}) {recent}, 0)"
    return rows.groupBy(KEY).agg(*[F.expr(e).alias(c) for c, e in aggregates.items()])


def profile_at(customer: DataFrame, state: DataFrame, period: Period, eligible: DataFrame | None = None) -> DataFrame:
    """All features and flags for a period, of all customers or of the eligible ones."""
    if eligible is not None:
        customer = customer.join(eligible.select(F.col(KEY).alias("c_custkey")), "c_custkey", "left_semi")
    return profile_of(customer, activity_at(state, period, eligible), period)
