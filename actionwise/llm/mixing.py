"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words: its weight's share of all words asked for, but never more than `most` times what it has; what
a source can't take is shared out again among the others by weight. A document of a source is expected target / size
of source times. Its expected copies are summed along the source, one random offset per source is added, and the document
is given out once per whole number that its stretch of the sum crosses. Documents stand in the order of their size, so that large
and small ones are taken in proportion and the words taken come near the target.

Everything is a DataFrame operation. The sum along a source is a place times a constant, and places come from counts per
size class and hash range, so that no source, however large, is one task. The draw depends on the seed and the rows alone.

NULL and empty texts have size 0; they take part in the draw and take no words. NULL is a source of its own, the last one. A
source without words has target 0. Repeated doc_ids are rows of their own. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import hex_hash, numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources are taken by rising limit per weight. A source is full if the words left for it and all later ones, shared by
    weight, exceed its limit; full sources come first in this order, so one pass over the sources decides. One row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("bigint")).withColumn("cap", most * F.col("source_size"))
    place = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    until = place.rowsBetween(Window.unboundedPreceding, -1)
    onward = place.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # in hundredths of words: whole numbers, so that every engine gets the same quotient
    per = per.withColumn("asked", percent * F.sum("source_size").over(Window.partitionBy()))
    left = F.col("asked") - 100 * F.coalesce(F.sum("cap").over(until), F.lit(0))
    per = per.withColumns({"left": left, "shares": F.sum("weight").over(onward)})
    per = per.withColumn("full", F.col("left") * F.col("weight") > 100 * F.col("cap") * F.col("shares"))
    # level: words per weight of the sources that are not full
    level = F.max(F.when(~F.col("full"), F.struct(F.col("shares"), F.col("left")))).over(Window.partitionBy())
    fair = level["left"] * F.col("weight") / (100.0 * level["shares"])
    target = F.when(F.col("full") | level.isNull(), F.col("cap").cast("double")).otherwise(fair)
    return per.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents with size, source_size, target and copies (how often the mix holds the document, 0 or more)."""
    return drawn(docs.withColumn("size", words_in("text")), **options)


def drawn(sized: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = 150, most: int = 2, seed: int = 11) -> DataFrame:
    """Rows (doc_id, source, size) with source_size, target and copies."""
    targets = source_targets(sized.select("source", "size"), weights, percent, most)
    long = F.length(F.bin("size"))
    shown = sized.withColumns({
        "_class": (long * 32 + F.expr("shiftright(size, greatest(length(bin(size)) - 5, 0))")).cast("int"),
        "_hash": hex_hash("doc_id", f"|{seed}"),
    }).withColumn("_range", F.substring("_hash", 1, 2))
    places = numbered(shown, ["source"], ["_class", "_range"], ["_hash", "doc_id", "size"], "_place")
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    rated = places.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_class", "_range", "_hash")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(hex_hash(F.coalesce("source", F.lit("")), f"|{seed}"), 1, 8), 16, 10).cast("double") / 2.0**32
    upto = lambda k: F.floor(rate * (F.col("_place") - k) + offset)
    return rated.withColumn("copies", (upto(0) - upto(1)).cast("bigint")).drop("_place")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per document. Texts are read once: sizes are staged."""
    found = drawn(stage(docs.select("doc_id", "source", words_in("text").alias("size")), "mix_sizes"), **options)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it was drawn, with its own columns."""
    found = mixed(docs.select(F.struct("*").alias("_doc"), "doc_id", "text", "source"), **options)
    again = found.filter("copies > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select("_doc.*")


def mix_sql(weights: Sequence[int] = WEIGHTS, percent: int = 150, most: int = 2, seed: int = 11, docs: str = "documents") -> str:
    """The report as DuckDB SQL; the places of a source are numbered by one window there."""
    cases = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
    WITH sized AS (
      SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {docs}),
    per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (
      SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {cases} END)::BIGINT AS weight,
             {most} * source_size AS cap FROM per),
    shared AS (
      SELECT *, ({percent} * sum(source_size) OVER () - 100 * coalesce(sum(cap) OVER (
                  ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS remaining,
             (sum(weight) OVER (
                  ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS shares
      FROM weighed),
    filled AS (SELECT *, remaining * weight > 100 * cap * shares AS is_full FROM shared),
    level AS (SELECT max(shares) FILTER (WHERE NOT is_full) AS shares, max_by(remaining, shares) FILTER (WHERE NOT is_full) AS remaining FROM filled),
    targets AS (
      SELECT f.source, f.source_size,
             CASE WHEN f.is_full OR l.shares IS NULL THEN f.cap::DOUBLE
                  ELSE (l.remaining * f.weight)::DOUBLE / (100.0::DOUBLE * l.shares::DOUBLE) END AS target
      FROM filled f, level l),
    placed AS (
      SELECT s.*, t.source_size, t.target, row_number() OVER (
               PARTITION BY s.source
               ORDER BY length(bin(size)) * 32 + (size >> greatest(length(bin(size)) - 5, 0)), md5(s.doc_id::VARCHAR || '|{seed}'), doc_id, size) AS place,
             ('0x' || substr(md5(coalesce(s.source, '') || '|{seed}'), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS shift,
             CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (floor(rate * place::DOUBLE + shift) - floor(rate * (place - 1)::DOUBLE + shift))::BIGINT * size AS taken
    FROM placed"""
