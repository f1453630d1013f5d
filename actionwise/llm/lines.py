"""Line dedup by a deletion-neighbourhood join: a line goes if an earlier line is the same or one edit away.

An edit inserts, deletes or replaces one character. Lines one edit apart become equal when each loses at most one
character, so every line is known by the hashes of all its variants with one character less, and of itself. Equal variants meet:

- lines that lose a character at the same place of the same variant differ in this character alone;
- a line that is the variant of a longer one is one deletion away from it.

So the earliest line of each meeting decides, and no pairs are formed however many lines meet. Distances to it are then verified.
A variant's hash combines the hashes of neighbouring words, so one variant costs the same in long and in short lines. It is the same for words
in another order, though: where a line's earliest partner turns out to be no true one, the lines of that meeting meet once more, by the
hash of the variant's whole text. Variants are only made of lines whose left or right half another line shares: of two lines one edit apart, the
halves can't both differ.

Lines are parts between line feeds; the order is (doc_id, hash of the document's text, place of the line). Equal lines of any length
count as repeats, lines of fewer than `least` characters are not compared further, and empty lines stay. Decisions are made on the
input, not on what is left. NULL and empty texts have no line. Rows without doc_id come first. Rows of one doc_id with different texts
are documents of their own; rows that agree in doc_id and text are one document, shown as often as it stands there. Extra columns take no
part. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import has_columns

LEAST = 20


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, t, place, line) of every line that is not empty; t tells texts of one doc_id apart."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return lines.filter("line <> ''")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """(k1, k2, first, line): each different line by two hashes, and where it first stands."""
    at = F.struct("doc_id", "t", "place").alias("at")
    keyed = lines.select(F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"), at, "line")
    return keyed.groupBy("k1", "k2").agg(F.min("at").alias("first"), F.first("line").alias("line"))


def half_keys(lines: DataFrame) -> DataFrame:
    """Rows of lines with `half`: hashes of the halves, as cut for partners of the same length and of one character less or more."""
    # written out: a lambda is not compiled
    cuts = F.array(*(
        F.expr(f"xxhash64({side}, {m}, {part}(line, cast({length} as int)))")
        for m in ("n - 1", "n")
        for side, part, length in ((0, "left", f"({m}) div 2"), (1, "right", f"({m}) - ({m}) div 2"))
    ))
    return lines.withColumn("half", F.explode(F.array_distinct(cuts)))


def neighbourhood(lines: DataFrame) -> DataFrame:
    """(k1, k2, first, x, length, word, offset) per variant: hash, length, and the place where a character is missing.

    x of a text is the exclusive or of the hashes of neighbouring words, its ends included; the line itself has no place.
    """
    words = lines.withColumn("words", F.split("line", " "))
    # what a word's variants need: the words around it
    around = F.expr(
        """transform(words, (w, i) -> named_struct('w', w, 'p', if(i = 0, '\n', words[i - 1]), 'i', i,
             'q', coalesce(get(words, i + 1), '\n'), 'r', if(i + 1 < size(words), coalesce(get(words, i + 2), '\n'), NULL)))"""
    )
    whole = F.expr("aggregate(sequence(0, size(words)), 0L, (a, i) -> a ^ xxhash64(if(i = 0, '\n', words[i - 1]), coalesce(get(words, i), '\n')))")
    base = words.select("k1", "k2", "first", "n", whole.alias("x"), around.alias("around"))
    itself = base.select("k1", "k2", "first", "x", F.col("n").alias("length"), F.lit(-1).alias("word"), F.lit(-1).alias("offset"))
    each = base.select("k1", "k2", "first", "x", "n", F.explode("around").alias("a")).select("k1", "k2", "first", "n", "x", "a.*")
    rest = F.expr("x ^ xxhash64(p, w) ^ xxhash64(w, q)").alias("rest")
    each = each.select("k1", "k2", "first", "n", "p", "w", "q", "r", "i", rest)
    letters = each.filter("w <> ''").select("k1", "k2", "first", "n", "p", "w", "q", "i", "rest", F.explode(F.expr("sequence(0, length(w) - 1)")).alias("k"))
    letters = letters.withColumn("v", F.expr("concat(left(w, k), substring(w, k + 2))")).select(
        "k1", "k2", "first", F.expr("rest ^ xxhash64(p, v) ^ xxhash64(v, q)").alias("x"), (F.col("n") - 1).alias("length"),
        F.col("i").alias("word"), F.col("k").alias("offset"),
    )
    gaps = each.filter("r IS NOT NULL").select(
        "k1", "k2", "first", F.expr("rest ^ xxhash64(q, r) ^ xxhash64(p, concat(w, q)) ^ xxhash64(concat(w, q), r)").alias("x"),
        (F.col("n") - 1).alias("length"), F.col("i").alias("word"), F.length("w").alias("offset"),
    )
    return itself.unionByName(letters).unionByName(gaps)


def pairs_met(variants: DataFrame, by: list[str]) -> DataFrame:
    """(k1, k2, partner, met...) where an earlier line has an equal variant: only the earliest of each meeting."""
    met = Window.partitionBy(*by)
    own = F.col("word") < 0
    found = variants.repartition(*by).withColumns({  # one exchange for both windows
        "shorter": F.min(F.when(own, F.col("first"))).over(met),
        "longer": F.min(F.when(~own, F.col("first"))).over(met),
        "same_place": F.min("first").over(Window.partitionBy(*by, "word", "offset")),
    })
    partner = F.explode(F.when(own, F.array("longer")).otherwise(F.array("same_place", "shorter"))).alias("partner")
    return found.select("k1", "k2", "first", partner, *by).filter("partner < first").distinct()


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs with `near`: whether the lines are one edit apart."""
    ours = lines.select("k1", "k2", F.col("line").alias("a"))
    theirs = lines.select(F.col("first").alias("partner"), F.col("line").alias("b"))
    return pairs.join(ours, ["k1", "k2"]).join(theirs, "partner").withColumn("near", F.levenshtein("a", "b", 1) >= 0).drop("a", "b")


def exact_variants(lines: DataFrame, meetings: DataFrame) -> DataFrame:
    """Variants that take part in the given meetings (x, length), with the hash y of the variant's text."""
    # a variant has the length of its line, or one less
    sizes = meetings.select(F.explode(F.array("length", F.col("length") + 1)).alias("n")).distinct()
    rows = neighbourhood(lines.join(sizes, "n", "left_semi")).join(meetings, ["x", "length"], "left_semi")
    text = rows.join(lines.select("k1", "k2", "line"), ["k1", "k2"])
    begin = F.expr("if(word < 1, 0, length(array_join(slice(split(line, ' '), 1, word), ' ')) + 1) + offset")
    left = F.expr("if(word < 0, line, concat(left(line, begin), substring(line, begin + 2)))")
    return text.withColumn("begin", begin).withColumn("y", F.xxhash64(left)).drop("line", "begin")


def sharing_lines(lines: DataFrame) -> DataFrame:
    """(k1, k2) of the lines that share a half with another line. Halves are made and exchanged once; a half tells the line's length too."""
    halves = half_keys(lines).select("k1", "k2", "half")
    met = halves.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("half")))
    return met.filter("m > 1").select("k1", "k2").distinct()


def near_repeats(lines: DataFrame, least: int = LEAST) -> DataFrame:
    """(k1, k2) of different lines (k1, k2, first, line) that have an earlier line one edit away."""
    long = lines.withColumn("n", F.length("line")).filter(F.col("n") >= least)
    likely = stage(long.join(sharing_lines(long), ["k1", "k2"], "left_semi"), "likely_lines")
    pairs = stage(verified(pairs_met(neighbourhood(likely), ["x", "length"]), likely), "line_pairs")
    meetings = stage(pairs.filter("NOT near").select("x", "length").distinct(), "line_meetings")
    near = pairs.filter("near").select("k1", "k2")
    if not meetings.isEmpty():
        again = verified(pairs_met(exact_variants(likely, meetings), ["x", "length", "y"]), likely)
        near = near.unionByName(again.filter("near").select("k1", "k2"))
    return near.distinct()


def repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, t, place) of lines that go."""
    lines = lines_of(has_columns(docs, ["doc_id", "text"]))
    firsts = stage(distinct_lines(lines), "line_firsts")
    near = near_repeats(firsts, least).withColumn("near", F.lit(True))
    known = firsts.drop("line").join(near, ["k1", "k2"], "left")
    all_lines = lines.select("doc_id", "t", "place", F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"))
    gone = F.col("near").isNotNull() | (F.struct("doc_id", "t", "place") > F.col("first"))
    return all_lines.join(known, ["k1", "k2"]).filter(gone).select("doc_id", "t", "place")


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The documents with `n_lines` and `n_removed`, and `text` without the lines that go."""
    gone = repeated_lines(docs, least).groupBy("doc_id", "t").agg(F.collect_set("place").alias("_gone"))
    gone = gone.withColumnsRenamed({"doc_id": "_id", "t": "_t"})
    lines = F.split("text", "\n")
    kept = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("_gone", i)), "\n")
    )
    counted = F.coalesce(F.size(F.filter(lines, lambda line: line != "")), F.lit(0)).cast("bigint")
    out = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_t")), "left")
    removed = F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0)).cast("bigint")
    columns = [kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, counted.alias("n_lines"), removed.alias("n_removed"))
