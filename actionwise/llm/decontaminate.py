"""Benchmark decontamination by templates: finds benchmark items in documents, re-parameterised ones too.

Numbers, names and units of measure become typed placeholders; `size` words of such a template in a row are a window, and an item of fewer words is one
window as a whole. Windows of documents are joined with those of the benchmark by hash (Spark broadcasts the benchmark's while they are small, and
shuffles beyond). A window of placeholders alone is no template, as any list of names or numbers would match it: its key holds its values too. Where a
document holds enough of an item, its slots are checked: along one alignment, the same value of the item must always stand for the same value in the
document, and the other way round. Windows of alignments that break this rule don't count. An item is found when the remaining windows cover
`percent` of its words.

Everything is a DataFrame operation. A token with a digit is a number; a capitalised token that doesn't follow the end of a sentence
is a name; a word of UNITS after a number is a unit. Case and punctuation don't matter otherwise.

NULL and empty texts, and texts of signs alone, hold nothing and are never found. Repeated items are each found. Rows
of `documents` without doc_id can't be reported and are left alone. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import has_columns

# fixed values: words that count as units of measure after a number
UNITS = (
    "mm cm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers inch inches foot feet g kg mg lb lbs oz gram grams "
    "kilogram kilograms pound pounds l ml liter liters litre litres s sec min h hr hour hours minute minutes second seconds day days week "
    "weeks month months year years usd eur dollar dollars euro euros cent cents percent"
).split()

GAP, INK = r"[\x09-\x0D\x20]", r"[^\x09-\x0D\x20]"
NAME = (rf"({INK[:-1]}.!?:;]{GAP})\p{{Lu}}{INK}*", "0n")
NUMBER = (rf"(^|{GAP}){INK[:-1]}0-9]*[0-9]{INK}*", "0")
NUMBER_AHEAD = rf"(?<!{INK})(?={INK}*[0-9]){INK}*+"  # the same words: four times as fast, but not every engine looks around
SIGNS = rf"[^\p{{L}}\p{{N}}{GAP[1:-1]}]+"
SLOTS = ("0", "0n", "0u")
UNIT = (rf"((?:^|{GAP})0{GAP})(?:{'|'.join(UNITS)})({GAP}|$)", "0u")


def canonical(text: Column) -> Column:
    """The text as a template, with its white space as it was. Numbers first: the other placeholders hold a digit.

    Names are replaced twice, as neighbouring names share the character that is looked at.
    """
    out = F.regexp_replace(text, F.lit(NUMBER_AHEAD), F.lit(NUMBER[1]))
    for _ in range(2):
        out = F.regexp_replace(out, F.lit(NAME[0]), F.lit("$1" + NAME[1]))
    out = F.regexp_replace(F.lower(out), F.lit(SIGNS), F.lit(""))
    return F.regexp_replace(out, F.lit(UNIT[0]), F.lit("$1" + UNIT[1] + "$2"))


def template_words(text: str) -> Column:
    """Array of (raw, form): the words as they stand and in the template."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.filter(F.arrays_zip(F.split(whole, GAP).alias("raw"), F.split(canonical(whole), GAP).alias("form")), lambda x: x["form"] != "")


def value(raw: Column) -> Column:
    return F.regexp_replace(F.lower(raw), F.lit(rf"^{SIGNS}|{SIGNS}$"), F.lit(""))


def windows(df: DataFrame, key: str, sizes: Sequence[int], place: str) -> DataFrame:
    """(key, place, hash) of every window of these sizes.

    The generator is an outer one: for an inner one Spark infers a filter on its array, and pushes it to the scan, where the template is made once more.
    """
    words = df.select(key, template_words("text").alias("both")).select(key, F.col("both.form").alias("form"), F.col("both.raw").alias("raw"))
    slot = lambda w: w.isin(*SLOTS)

    def window(n: int):
        def one(i: Column) -> Column:
            part = F.slice("form", i, F.lit(n))
            bare = slot(F.element_at("form", i)) & F.forall(part, slot)  # the first word decides nearly always
            own = F.xxhash64(part, F.transform(F.slice("raw", i, F.lit(n)), value))
            return F.struct((i - 1).alias(place), F.when(bare, own).otherwise(F.xxhash64(part)).alias("hash"))

        return one

    none = F.array().cast("array<int>")
    each = [F.transform(F.when(F.size("form") >= n, F.sequence(F.lit(1), F.size("form") - (n - 1))).otherwise(none), window(n)) for n in sizes]
    shown = words.select(key, F.explode_outer(F.concat(*each) if len(each) > 1 else each[0]).alias("w"))
    return shown.select(key, f"w.{place}", "w.hash").filter("hash IS NOT NULL")


def slots(df: DataFrame, key: str, place: str, word: str, kind: str) -> DataFrame:
    """(key, place, word, kind) of each placeholder: the text that stands there and its type."""
    shown = df.select(key, F.posexplode_outer(template_words("text")).alias(place, "x")).filter(F.col("x.form").isin(*SLOTS))
    return shown.select(key, place, value(F.col("x.raw")).alias(word), F.col("x.form").alias(kind))


def covered(places: Column, size: Column) -> Column:
    """Words under windows at these places (an ascending array)."""
    step = F.transform(places, lambda x, i: F.when(i == 0, size).otherwise(F.least(size, x - F.try_element_at(places, i))))
    return F.aggregate(step, F.lit(0), lambda a, x: a + x)


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_words, n_covered, n_slots, n_changed): one row per document and item found in it.

    n_slots and n_changed count the item's placeholders under counted windows, and those of them whose value differs.
    """
    docs = has_columns(docs, ["doc_id", "text"]).filter("doc_id IS NOT NULL")
    items = has_columns(benchmark, ["item_id", "text"]).filter("item_id IS NOT NULL").distinct()
    lengths = items.select("item_id", F.size(template_words("text")).alias("n_words"))
    lengths = stage(lengths.filter("n_words > 0"), "template_lengths")
    short = [r[0] for r in lengths.filter(F.col("n_words") < size).select("n_words").distinct().collect()]  # fewer than `size` numbers
    cut = windows(items, "item_id", [size], "at")
    for n in short:  # an item of fewer words is one window
        cut = cut.unionByName(windows(items.join(lengths.filter(F.col("n_words") == n), "item_id", "left_semi"), "item_id", [n], "at"))
    item_windows = stage(cut, "template_windows")
    hits = windows(docs, "doc_id", [size, *short], "place").join(item_windows, "hash").select("doc_id", "item_id", "at", (F.col("place") - F.col("at")).alias("shift"))
    hits = stage(hits.distinct(), "template_hits")

    def enough(found: DataFrame) -> DataFrame:
        """Pairs with enough words under their windows; the places are bounded by the length of an item."""
        per = found.groupBy("doc_id", "item_id").agg(F.array_sort(F.collect_set("at")).alias("places")).join(lengths, "item_id")
        per = per.select("doc_id", "item_id", "n_words", covered(F.col("places"), F.least(F.lit(size), F.col("n_words"))).alias("n_covered"))
        return per.filter(F.col("n_covered") * 100 >= percent * F.col("n_words"))

    likely = stage(enough(hits).select("doc_id", "item_id"), "template_pairs")
    near = hits.join(likely, ["doc_id", "item_id"])
    wanted = likely.select("doc_id").distinct()
    ours = slots(docs.join(wanted, "doc_id"), "doc_id", "place", "doc_word", "kind")
    theirs = slots(items.join(likely.select("item_id").distinct(), "item_id"), "item_id", "item_at", "item_word", "item_kind")
    under = near.select("doc_id", "item_id", "shift", F.explode(F.expr(f"sequence(at, at + {size - 1})")).alias("item_at")).distinct()
    aligned = under.join(theirs, ["item_id", "item_at"]).withColumn("place", F.col("item_at") + F.col("shift")).join(ours, ["doc_id", "place"])
    aligned = aligned.filter("kind = item_kind")

    def two_fold(one: str, other: str) -> DataFrame:
        """Alignments where a value of one side stands for several of the other."""
        meant = aligned.groupBy("doc_id", "item_id", "shift", "kind", one).agg((F.min(other) < F.max(other)).alias("differ"))
        return meant.filter("differ").select("doc_id", "item_id", "shift")

    broken = two_fold("item_word", "doc_word").unionByName(two_fold("doc_word", "item_word")).distinct()
    sound = near.join(broken, ["doc_id", "item_id", "shift"], "left_anti")
    told = aligned.join(broken, ["doc_id", "item_id", "shift"], "left_anti").groupBy("doc_id", "item_id").agg(
        F.count_distinct("item_at").alias("n_slots"),
        F.count_distinct(F.when(F.col("doc_word") != F.col("item_word"), F.col("item_at"))).alias("n_changed"),
    )
    out = enough(sound).join(told, ["doc_id", "item_id"], "left")
    return out.select(
        "doc_id", "item_id", F.col("n_words").cast("bigint"), F.col("n_covered").cast("bigint"),
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Documents in which no item is found."""
    return docs.join(matches(docs, benchmark, size, percent).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def matches_sql(size: int = 5, percent: int = 80, docs: str = "documents", benchmark: str = "benchmark") -> str:
    """The same as DuckDB SQL; windows are compared as text."""
    q = lambda s: s.replace("'", "''")

    def canon(col: str) -> str:
        out = f"regexp_replace({col}, '{q(NUMBER[0])}', '\\1{NUMBER[1]}', 'g')"
        for _ in range(2):
            out = f"regexp_replace({out}, '{q(NAME[0])}', '\\1{NAME[1]}', 'g')"
        out = f"regexp_replace(lower({out}), '{q(SIGNS)}', '', 'g')"
        return f"regexp_replace({out}, '{q(UNIT[0])}', '\\1{UNIT[1]}\\2', 'g')"

    def tokens(table: str, key: str) -> str:
        c = "coalesce(text, '')"
        return f"""SELECT {key}, [x for x in list_zip(string_split_regex({c}, '{GAP}'), string_split_regex({canon(c)}, '{GAP}')) if x[2] <> ''] AS words
                   FROM {table} WHERE {key} IS NOT NULL"""

    def shown(table: str, key: str) -> str:
        return f"SELECT {key}, unnest(range(len(words))) AS place, unnest(words) AS word FROM {table}"

    bare = "list_bool_and([x[2] IN ('0', '0n', '0u') for x in w])"
    value = lambda c: f"regexp_replace(lower({c}[1]), '^{q(SIGNS)}|{q(SIGNS)}$', '', 'g')"
    template = f"CASE WHEN {bare} THEN ['='] || [x[2] for x in w] || [{value('x')} for x in w] ELSE [x[2] for x in w] END"

    def wins(table: str, key: str, n: str) -> str:
        return f"""SELECT {key}, place, {template} AS win FROM (
                     SELECT {key}, unnest(range(len(words) - {n} + 1)) AS place, unnest([words[i + 1:i + {n}] for i in range(len(words) - {n} + 1)]) AS w
                     FROM {table} WHERE len(words) >= {n})"""

    parts = " UNION ALL ".join(wins(f"(SELECT * FROM d WHERE {n} IN (SELECT least({size}, len(words)) FROM b))", "doc_id", str(n)) for n in range(1, size + 1))
    cover = f"""SELECT doc_id, item_id, count(DISTINCT spot + k) AS n_covered FROM %s JOIN b USING (item_id), range({size}) r(k)
                WHERE k < least({size}, len(words)) GROUP BY ALL"""
    return f"""
    WITH d AS MATERIALIZED ({tokens(docs, "doc_id")}), b AS MATERIALIZED ({tokens(f"(SELECT DISTINCT item_id, text FROM {benchmark})", "item_id")}),
    hits AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, bw.place AS spot, dw.place - bw.place AS shift
             FROM ({parts}) dw JOIN ({wins("(SELECT * FROM b WHERE len(words) > 0)", "item_id", f"least({size}, len(words))")}) bw USING (win)),
    likely AS (SELECT doc_id, item_id FROM ({cover % "hits"}) JOIN b USING (item_id) WHERE n_covered * 100 >= {percent} * len(words)),
    near AS (SELECT hits.* FROM hits JOIN likely USING (doc_id, item_id)),
    under AS (SELECT DISTINCT doc_id, item_id, shift, spot + k AS spot FROM near, range({size}) r(k)),
    aligned AS (SELECT u.*, dw.word[2] AS kind, {value("dw.word")} AS doc_word, {value("bw.word")} AS item_word
                FROM under u JOIN ({shown("b", "item_id")}) bw ON bw.item_id = u.item_id AND bw.place = u.spot
                JOIN ({shown("d", "doc_id")}) dw ON dw.doc_id = u.doc_id AND dw.place = u.spot + u.shift
                WHERE dw.word[2] = bw.word[2] AND dw.word[2] IN ('0', '0n', '0u')),
    broken AS (SELECT DISTINCT doc_id, item_id, shift FROM (
                 SELECT doc_id, item_id, shift, kind, item_word AS word FROM aligned GROUP BY ALL HAVING count(DISTINCT doc_word) > 1
                 UNION ALL SELECT doc_id, item_id, shift, kind, doc_word FROM aligned GROUP BY ALL HAVING count(DISTINCT item_word) > 1)),
    sound AS (SELECT * FROM near ANTI JOIN broken USING (doc_id, item_id, shift)),
    told AS (SELECT doc_id, item_id, count(DISTINCT spot) AS n_slots, count(DISTINCT spot) FILTER (WHERE doc_word <> item_word) AS n_changed
             FROM aligned ANTI JOIN broken USING (doc_id, item_id, shift) GROUP BY ALL)
    SELECT c.doc_id, c.item_id, len(words)::BIGINT AS n_words, n_covered::BIGINT AS n_covered,
           coalesce(n_slots, 0)::BIGINT AS n_slots, coalesce(n_changed, 0)::BIGINT AS n_changed
    FROM ({cover % "sound"}) c JOIN b USING (item_id) LEFT JOIN told t ON t.doc_id = c.doc_id AND t.item_id = c.item_id
    WHERE n_covered * 100 >= {percent} * len(words)"""
