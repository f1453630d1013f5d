"""Users, features and action flags derived from a customer / orders / lineitem star schema.

One pass over the facts gives everything known about a user: history strictly before the cutoff feeds the features, the
window [cutoff, as_of) feeds the flags. The pieces below are projections of that one frame; columns nobody asks for are
pruned, together with the join to lineitem when no return column is used.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import Scorer, expression_scorer, table_scorer
from ..specs import ACTIONS as BASE_ACTIONS
from ..specs import KEY, NULL_SENTINEL, ActionSpec, FeatureSpec
from ..sources.tables import scan


@dataclass(frozen=True)
class Period:
    """History ends at the cutoff, targets lie in [cutoff, as_of)."""

    cutoff: date = date(2001, 1, 1)
    as_of: date = date(2001, 7, 1)


# Order priority that stands for each trained action.
PRIORITIES = {
    "recurring_action": ("1-URGENT", "urgent"),
    "auto_transport": ("2-HIGH", "high"),
    "next_positive": ("3-MEDIUM", "medium"),
    "small_action": ("4-NOT SPECIFIED", "unspec"),
    "long_term": ("5-LOW", "low"),
}
SENTINEL_SEGMENT = "FURNITURE"
SHARE_THRESHOLD = 0.2
RETURN_THRESHOLD = 1.0 / 3.0
COUNTS = ["n_orders", "n_items", "n_returned", *[f"n_{short}" for _, short in PRIORITIES.values()]]


def _features(short: str) -> FeatureSpec:
    return FeatureSpec(("segment",), ("acctbal", "n_orders", "amt_avg", "recency_days", "tenure_days", f"share_{short}"))


FEATURE_SETS = {name: _features(short) for name, (_, short) in PRIORITIES.items()}
ACTIONS: tuple[ActionSpec, ...] = tuple(replace(a, features=FEATURE_SETS.get(a.name, FeatureSpec())) for a in BASE_ACTIONS)
BY_NAME = {a.name: a for a in ACTIONS}

# Vendor codes of readable feature names.
VENDOR_CODES = {
    "acctbal": "vx0001",
    "n_orders": "vx0002",
    "amt_avg": "vx0003",
    "recency_days": "vx0004",
    "tenure_days": "vx0005",
}


def raw_users(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """(id, verified_at, closed_at): verified with the first order; an overdrawn account closes with its last one."""
    seen = orders.groupBy(F.col("o_custkey").alias(KEY)).agg(
        F.min("o_orderdate").alias("verified_at"), F.max("o_orderdate").alias("last_at")
    )
    accounts = customer.select(F.col("c_custkey").alias(KEY), "c_acctbal")
    return accounts.join(seen, KEY, "left").select(
        KEY, "verified_at", F.when(F.col("c_acctbal") < 0, F.col("last_at")).alias("closed_at")
    )


def user_activity(orders: DataFrame, lineitem: DataFrame, period: Period = Period()) -> DataFrame:
    """Per-user counts before the cutoff (`n_`) and in the target window (`w_`).

    Items are reduced to one row per order before they meet the orders, so an order with very many items costs no more
    in the join than any other; the sums per user combine on the map side, so a user with very many orders is
    no hot spot either.
    """
    items = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("l_returnflag") == "R").alias("returned")
    )
    facts = orders.filter(F.col("o_orderdate") < F.lit(period.as_of)).join(
        items, orders["o_orderkey"] == items["l_orderkey"], "left"
    )
    past, recent = (f"o_orderdate {op} DATE'{period.cutoff}'" for op in ("<", ">="))
    aggregates = {
        "n_orders": f"count_if({past})",
        "amt_sum": f"round(sum(o_totalprice) FILTER (WHERE {past}), 2)",
        "first_at": f"min(o_orderdate) FILTER (WHERE {past})",
        "last_at": f"max(o_orderdate) FILTER (WHERE {past})",
        "n_items": f"sum(items) FILTER (WHERE {past})",
        "n_returned": f"sum(returned) FILTER (WHERE {past})",
        "w_returned": f"sum(returned) FILTER (WHERE {recent})",
        "w_status_p": f"count_if({recent} AND o_orderstatus = 'P')",
    }
    for priority, short in PRIORITIES.values():
        aggregates[f"n_{short}"] = f"count_if({past} AND o_orderpriority = '{priority}')"
        aggregates[f"w_{short}"] = f"count_if({recent} AND o_orderpriority = '{priority}')"
    return facts.groupBy(F.col("o_custkey").alias(KEY)).agg(*[F.expr(e).alias(c) for c, e in aggregates.items()])


def user_profile(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    period: Period = Period(),
    eligible: DataFrame | None = None,
) -> DataFrame:
    """All features and flags, one row per customer.

    Users without history have zero counts and NULL averages, shares and ages. With `eligible` (a frame with the user
    key) only those users are kept, and their orders are picked before anything is aggregated.
    """
    if eligible is not None:
        customer = customer.join(eligible.select(F.col(KEY).alias("c_custkey")), "c_custkey", "left_semi")
        orders = orders.join(eligible.select(F.col(KEY).alias("o_custkey")), "o_custkey", "left_semi")
    return profile_of(customer, user_activity(orders, lineitem, period), period)


def profile_of(customer: DataFrame, activity: DataFrame, period: Period) -> DataFrame:
    """Features and flags of the customers from what is counted per user."""
    accounts = customer.select(
        F.col("c_custkey").alias(KEY), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal")
    )
    wide = accounts.join(activity, KEY, "left").fillna(0, subset=COUNTS)
    cutoff = f"DATE'{period.cutoff}'"
    features = {
        "segment": "segment",
        "acctbal": "acctbal",
        "n_orders": "n_orders",
        "amt_sum": "coalesce(amt_sum, 0D)",
        "amt_avg": "try_divide(amt_sum, n_orders)",
        "recency_days": f"bigint(datediff({cutoff}, date(last_at)))",
        "tenure_days": f"bigint(datediff({cutoff}, date(first_at)))",
        **{f"share_{s}": f"try_divide(double(n_{s}), n_orders)" for _, s in PRIORITIES.values()},
        "return_share": "try_divide(double(n_returned), n_items)",
    }
    taken = {name: f"w_{short} > 0" for name, (_, short) in PRIORITIES.items()} | {
        "transport_action": "w_returned > 0",
        "business_requirement_1": "acctbal >= 0",
        "business_requirement_2": "w_status_p > 0",
    }
    flags = {a.flag: f"int(coalesce({taken[a.name]}, false))" for a in ACTIONS}
    return wide.selectExpr(KEY, *[f"{e} AS {c}" for c, e in (features | flags).items()])


FEATURE_COLUMNS = [
    "segment", "acctbal", "n_orders", "amt_sum", "amt_avg", "recency_days", "tenure_days",
    *[f"share_{s}" for _, s in PRIORITIES.values()], "return_share",
]


def mark_sentinel(users: DataFrame) -> DataFrame:
    """Turn one segment into the literal sentinel string, as delivered by a source that writes NULL as text."""
    return users.withColumn(
        "segment", F.when(F.col("segment") == SENTINEL_SEGMENT, F.lit(NULL_SENTINEL)).otherwise(F.col("segment"))
    )


def outside_table(users: DataFrame) -> DataFrame:
    """Score table of the outside transport model: the share of returned items, users without items are absent."""
    p = F.col("return_share")
    return users.filter(p.isNotNull()).select(
        F.col(KEY).alias("user_id"),
        F.when(p >= RETURN_THRESHOLD, F.lit(1.0)).otherwise(F.lit(0.0)).alias("transport_adoption_prediction"),
        p.alias("transport_adoption_probability"),
    )


def frozen_scorers() -> dict[str, Scorer]:
    """Fixed formula scorers: the share of past orders of the action's priority, and of returned items."""
    scorers = {
        name: expression_scorer(F.col(f"share_{short}"), SHARE_THRESHOLD) for name, (_, short) in PRIORITIES.items()
    }
    return {**scorers, "transport_action": expression_scorer(F.col("return_share"), RETURN_THRESHOLD)}


def table_scorers(outside: DataFrame) -> dict[str, Scorer]:
    """As `frozen_scorers`, with the transport scores read from an outside table."""
    return {**frozen_scorers(), "transport_action": table_scorer(outside)}


def load_profile(spark: SparkSession, sf_dir: str, period: Period = Period()) -> DataFrame:
    """The profile of all customers below a directory of parquet tables, with the sentinel marked."""
    customer, orders, lineitem = (scan(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))
    return mark_sentinel(user_profile(customer, orders, lineitem, period))
