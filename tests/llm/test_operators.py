"""Training-data operators against brute force on small tables, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from actionwise.llm import catalog, chains, common, decontaminate, jaccard, lines, mixing, neighbours, pages, quality, suffixes, tokens

BASE = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(BASE).exists(), reason="test tables not available")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, key string, n string, _n string"


def word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))


def passage(rng, n):
    return " ".join(word(rng) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "a", "b", "c", "d") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """NULL and empty texts, NULL ids, a long text, ties and repeated rows, columns with clashing names."""
    rng = random.Random(3)
    shared, long = passage(rng, 80), passage(rng, 30_000)
    near = shared.split()
    near[40] = "changed"
    rows = [
        (1, shared, "a"), (2, shared, "a"), (3, None, None), (4, "", "b"), (5, " \n\t ", "b"), (6, long, "a"), (6, long, "a"), (None, "some text", "c"),
        (None, None, None), (7, " ".join(near), "b"), (8, passage(rng, 60) + "\n" + shared + "\n" + passage(rng, 60), "a"), (9, "two words", "a"), (10, "two words", None),
        (11, "ü" * 150 + passage(rng, 30), "é"), (12, passage(rng, 5) + "ü" * 150, "é"),
    ]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def docs(spark):
    common.small_batches(spark)
    return spark.read.parquet(f"{BASE}/documents.parquet")


def table(df):
    return [tuple(r) for r in df.collect()]


def nodes(plan):
    """A plan of the JVM and all below it."""
    children = plan.children()
    return [plan, *(node for k in range(children.size()) for node in nodes(children.apply(k)))]


# --- n-gram Jaccard join


def plain_components(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, len(sets[i]), find(i)) for i in ids}


def test_jaccard_is_exact(spark):
    rng = random.Random(1)
    rows = []
    for g in range(12):
        base = passage(rng, rng.choice([3, 10, 40, 120])).split()
        for _ in range(8):
            copy = base[:]
            for _ in range(rng.randint(0, max(1, len(copy) // 20))):
                copy[rng.randrange(len(copy))] = word(rng)
            rows.append((len(rows), " ".join(copy), f"s{g}"))
    want = plain_components([(i, t) for i, t, _ in rows], 4, 85)
    assert set(table(jaccard.jaccard_components(frame(spark, rows), 4, 85))) == want
    assert len({c for _, _, c in want}) < len(rows)


def test_jaccard_looks_at_all_pairs_where_no_nearest_is_left(spark, monkeypatch):
    """The first phase and the nearest pairs give nothing new: the round over all pairs still finds every link."""
    rng, tiles = random.Random(1), jaccard._tiles
    base = passage(rng, 100)
    rows = [(0, base, "s"), (1, base + " one", "s"), (2, passage(rng, 100), "s"), (3, base + " two", "s")]
    monkeypatch.setattr(jaccard, "_passing", lambda pairs, reps, percent: pairs.limit(0))
    monkeypatch.setattr(jaccard, "_tiles", lambda rows, reps, percent, nearest: tiles(rows, reps, percent, nearest).filter(F.lit(not nearest)))
    want = plain_components([(i, t) for i, t, _ in rows], 4, 85)
    assert len({c for _, _, c in want}) == 2
    assert set(table(jaccard.jaccard_components(frame(spark, rows), 4, 85))) == want


def test_jaccard_edges(spark, odd):
    got = table(jaccard.jaccard_components(odd, 4, 85))
    assert len(got) == odd.count()
    found = {(i, c) for i, _, c in got}
    assert {(1, 1), (2, 1), (7, 1), (3, 3), (4, 4), (5, 5), (6, 6), (9, 9), (10, 9), (None, None)} <= found
    kept = jaccard.keep_one_of_each(odd, 5, 80)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {None, 1, 3, 4, 5, 6, 8, 9}
    assert table(jaccard.jaccard_components(odd.limit(0))) == []


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(0)
    for n, m in ((5, 9), (300, 280), (3000, 1400)):
        a, b = (np.unique(rng.integers(0, 4000, k).astype(np.uint64)) for k in (n, m))
        assert jaccard.differing(jaccard.bitmap(a), jaccard.bitmap(b)) <= len(np.setxor1d(a, b))


def test_tiles_get_their_bitmaps_last(spark):
    """Blocks are numbered without bitmaps, which have about as many bits as the set has shingles."""
    assert len(jaccard.bitmap(np.arange(1000, dtype=np.uint64))) == 128
    rows = spark.createDataFrame([(1, 2, 3, 4)], "token bigint, set_key bigint, n bigint, component bigint")
    reps = spark.createDataFrame([(2, 3, bytearray(64))], "set_key bigint, n bigint, bits binary")
    plan = jaccard._tiles(rows, reps, 85, True)._jdf.queryExecution().optimizedPlan()
    windows = [node for node in nodes(plan) if node.nodeName() == "Window"]
    assert windows and not any("bits" in w.output().mkString(" ") for w in windows)


def test_python_tasks_hold_few_arrays():
    """A large batch is taken in small parts, which bounds the arrays of a worker; a text is never cut."""
    import tracemalloc

    texts = [passage(random.Random(i), 4000) for i in range(150)] + ["x" * 300_000]
    parts = list(common.chunked(texts))
    assert [t.decode() for _, part in parts for t in part] == texts and all(sum(map(len, p)) <= 1 << 18 or len(p) == 1 for _, p in parts)
    tracemalloc.start()
    for _, part in parts:
        suffixes.anchors(part)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 << 20


# --- mixing


@needs_data
def test_mix_matches_sql(spark, docs):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{BASE}/documents.parquet'")
    got = mixing.mix_report(docs)
    want = con.sql(mixing.mix_sql()).project(", ".join(got.columns)).fetchall()
    assert sorted(table(got)) == sorted(want)


def test_mix_reads_texts_once(spark, odd):
    plan = mixing.mix_report(odd)._jdf.queryExecution().optimizedPlan()
    assert not any("text" in node.output().mkString(" ") for node in nodes(plan))


def test_mix_targets_and_edges(spark, odd):
    rows = [(i, passage(random.Random(i), 1 + i % 50), ("big", "small", None)[min(i % 10, 2)]) for i in range(400)]
    got = mixing.mix_report(frame(spark, rows)).collect()
    total = sum(r["size"] for r in got)
    per = {}
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        s = per.setdefault((r.source_size, r.target), [0])
        s[0] += r.taken
    assert abs(sum(t for _, t in per) - 1.5 * total) < 1e-6 * total
    assert all(t <= 2 * s + 1e-9 and abs(taken[0] - t) <= 0.03 * t + 100 for (s, t), taken in per.items())
    edge = mixing.mix_report(odd)
    assert edge.count() == odd.count() and sorted(map(str, table(edge))) == sorted(map(str, table(mixing.mix_report(odd.repartition(5)))))
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert table(mixing.mix_report(odd.limit(0))) == []


# --- quality


@needs_data
def test_quality_on_held_out_rows(spark):
    base = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{base}/labels.parquet")
    got = catalog.op2_quality(spark, base).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93


def test_quality_edges(spark, odd):
    labels = spark.createDataFrame([(1, 1, "x"), (7, 0, "y"), (4, None, "z"), (None, 1, "z")], "doc_id bigint, quality int, text string")
    got = quality.quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert table(quality.quality_scores(odd.limit(0), labels.limit(0))) == []
    assert quality.keep_good(odd, labels, 0.0).columns == odd.columns


def test_flat_trees_learn():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    assert np.mean((quality.fit(x[:1500], y[:1500]).scores(x[1500:]) > 0.5) == y[1500:]) > 0.95


# --- token files


def plain_tokens(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(catalog.tokenizer_path())
    start, out = 0, []
    for i, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@needs_data
def test_token_files(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sorted(table(catalog.op7_tokens(spark, BASE))) == plain_tokens(rows)


def test_token_edges(spark):
    rows = [(1, "Σίγμα'S  don't  x<|endoftext|> é İ"), (2, None), (3, ""), (4, "a\x1cb\x85c\td\r\ne " * 3000), (5, "naïve 12345 ﬁ ½ ́x")]
    df = frame(spark, [(i, t, "s") for i, t in rows])
    assert sorted(table(tokens.written_report(df, catalog.tokenizer_path()))) == plain_tokens(rows)
    assert table(tokens.written_report(df.limit(0), catalog.tokenizer_path())) == []


def test_blocks_decode_from_any_checkpoint():
    import pandas as pd

    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 70_000).clip(0, 900).astype(np.uint64)
    symbol, n = np.unique(ids, return_counts=True)
    t = tokens.Table.of(tokens.frequency_table(pd.DataFrame({"symbol": symbol, "n": n})))
    payload, words, states = tokens.encode_block(ids, t)
    for k in range(len(words)):
        got = tokens.decode_block(payload, words, states, len(ids), t, t.slots(), k)
        assert (got == ids[k * tokens.CHECK_STEPS * tokens.LANES :]).all()
    assert len(payload) * 8 < 1.02 * -np.sum(n * np.log2(n / n.sum())) + 64 * tokens.LANES


# --- decontamination


@needs_data
def test_decontamination_matches_sql(spark, docs):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{BASE}/{name}.parquet'")
    got = decontaminate.matches(docs, spark.read.parquet(f"{BASE}/benchmark.parquet"))
    want = con.sql(decontaminate.matches_sql()).project(", ".join(got.columns)).fetchall()
    assert sorted(table(got)) == sorted(want)


def test_slots_must_agree(spark, odd):
    item = "A train leaves with 5 wagons and meets Anna after 20 km so how many of the 5 wagons does Anna see now"
    items = spark.createDataFrame([(1, item, 9), (2, "too short", 9), (3, None, 9), (4, "", 9)], "item_id bigint, text string, doc_id int")
    rng = random.Random(5)
    around = lambda t: f"{passage(rng, 30)} {t} {passage(rng, 30)}"
    texts = {
        1: around(item), 2: around(item.replace("5", "7").replace("Anna", "Otto").replace("20 km", "31 miles")), 3: around(item.replace("5", "7", 1)),
        4: around(" ".join(rng.sample(item.split(), 22))), 5: around(""), 6: None,
    }
    got = {r.doc_id: r for r in decontaminate.matches(frame(spark, [(i, t, "s") for i, t in texts.items()]), items).collect()}
    assert set(got) == {1, 2}
    assert (got[1].n_changed, got[1].n_slots) == (0, got[2].n_slots) and got[2].n_changed == got[2].n_slots > 0
    assert decontaminate.keep_clean(odd, items).count() == odd.count()
    assert table(decontaminate.matches(odd.limit(0), items.limit(0))) == []


def found(spark, texts, items):
    """(doc_id, item_id) by the operator, which must equal those by SQL."""
    d = frame(spark, [(i, t, "s") for i, t in texts.items()])
    b = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = decontaminate.matches(d, b)
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.register("benchmark", b.toPandas())
    rows = sorted(table(got))
    assert rows == sorted(con.sql(decontaminate.matches_sql()).project(", ".join(got.columns)).fetchall())
    return {r[:2] for r in rows}


def test_slots_must_agree_both_ways(spark):
    items = {1: "tell us how Anna has 5 red apples while Otto has 7 of them", 2: "tell us how Maria has 9 red pears while Maria has 9 of them"}
    texts = {
        1: "so tell us how Maria has 9 red apples while Maria has 9 of them", 2: "so tell us how Maria has 9 red apples while Ida has 3 of them",
        3: "so tell us how Anna has 5 red pears while Otto has 7 of them", 4: "so tell us how Otto has 4 red pears while Otto has 4 of them",
    }
    assert found(spark, texts, items) == {(2, 1), (4, 2), (1, 2), (3, 1)}  # the last two are copies but for one word


def test_short_items_are_one_window(spark):
    items = {1: "Blue moons rise", 2: "of 5", 3: "12 Otto", 4: "- !", 5: None, 6: "one two three four"}
    texts = {1: "then blue moons rise again", 2: "a part of 77", 3: "number 12 Otto", 4: "number 13 Otto", 5: "one two three", 6: "one, two; three - four", 7: "- !", 8: ""}
    assert found(spark, texts, items) == {(1, 1), (2, 2), (3, 3), (6, 6)}


def test_placeholders_alone_are_no_template(spark):
    rng = random.Random(9)
    names = lambda n: " ".join(word(rng).capitalize() for _ in range(n))
    items = {i: f"list {names(12)}" for i in range(300)}
    texts = {i: f"list {names(60)}" for i in range(300)} | {300: f"a {items[7]} and", 301: items[8].replace("list", "x").lower()}
    docs = frame(spark, [(i, t, "s") for i, t in texts.items()])
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    hits = decontaminate.windows(docs, "doc_id", [5], "place").join(decontaminate.windows(bench, "item_id", [5], "at"), "hash")
    assert hits.count() < 200_000  # 300 x 300 for the window with `list`; 40 million if names alone were a template
    assert found(spark, {i: texts[i] for i in (0, 1, 300, 301)}, {i: items[i] for i in (7, 8)}) == {(300, 7)}


# --- pages


def test_lcs_rows():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        shared = [x for x, s in zip(a, pages.shared_lines(a, b)) if s]
        assert len(shared) == t[-1][-1]
        it = iter(b)
        assert all(x in it for x in shared)


def test_pages(spark):
    plain = lambda body: f"<html><head><title>T</title></head><body><div>Site of news</div>{body}<div>Call us now</div></body></html>"
    html = {
        1: plain("<p>One  &amp; two.<p>Three<br>four"), 2: plain("<p>Other words here, all of them.</p>"), 3: None, 4: "",
        5: "<nav>menu</nav><article><header><h1>Head</h1></header><p>x <b>y</b></p><div class='comments'><p>nice</p></div><aside>z</aside></article><footer>f</footer>",
        6: "<main><p>a<script>var p = '</p>';</script><!-- c --> b</p><form><p>send</p></form><ul><li>l1<li>l2</ul></main><p>after",
    }
    rows = [(i, f"http://h.example/a/{100 + i}" if i < 3 else None if i == 6 else f"http://g{i}.example/", h, 1, "k") for i, h in html.items()]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, key int, host string")
    got = {r.page_id: (r.text, r.n_chars) for r in pages.main_texts(df.unionByName(df.filter("page_id = 5"))).collect()}
    want = {1: "One & two.\nThree\nfour", 2: "Other words here, all of them.", 3: "", 4: "", 5: "Head\nx y", 6: "a b\nl1\nl2"}
    assert got == {i: (t, len(t)) for i, t in want.items()}
    assert table(pages.main_texts(df.limit(0))) == []


def test_markup_is_not_joined(spark):
    """Pages go to their neighbours as packed lines, not as markup."""
    lines = [("One & two.", False, True), ("ü menu", True, False), ("send", True, True), ("12", False, False)]
    packed = pages.packed_lines(lines)
    assert pages.unpacked_lines(packed) == [(t if not noise else "", noise, marked) for t, noise, marked in lines]
    assert pages.unpacked_lines(pages.packed_lines([])) == []
    df = spark.createDataFrame([(1, "http://h.example/a", "<p>x</p>"), (1, "http://h.example/a", "<p>x</p>"), (None, None, None)], "page_id bigint, url string, html string")
    got = pages.main_texts(df)
    joins = [node for node in nodes(got._jdf.queryExecution().optimizedPlan()) if node.nodeName() == "Join"]
    assert joins and not any("html" in node.output().mkString(" ") for node in joins)
    assert sorted(table(got), key=str) == [(1, "http://h.example/a", "x", 1)] * 2 + [(None, None, "", 0)]


def test_marked_pages_are_differenced(spark):
    page = lambda i: f"<p>Site of news</p><article><p>Teaser {i} of it</p><p>Tell your friends</p>{'<p>A quote of two</p>' if i < 3 else ''}</article><p>The long story {i} goes on here</p>"
    df = spark.createDataFrame([(i, f"http://h.example/a/{100 + i}", page(i)) for i in range(1, 5)], "page_id bigint, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in pages.main_texts(df).collect()}
    assert got[2] == ["Teaser 2 of it", "A quote of two", "The long story 2 goes on here"]
    assert got[3] == ["Teaser 3 of it", "The long story 3 goes on here"]


def test_quotes_open_values_only_behind_an_equals_sign():
    text = lambda html: [t for t, noise, _ in pages.page_lines(html) if not noise]
    assert text("<article><p data-a=it's>First paragraph.</p><p>Second one.</p><p>It's third.</p></article>") == ["First paragraph.", "Second one.", "It's third."]
    assert text("<article><p title=\"5\" tall\">First</p><p title='a > b' class = \"x > y\">Second</p></article>") == ["First", "Second"]
    assert text("<p a==\"b>one</p><p a='>two</p><p =>three</p><p a=>four</p>") == ["one", "two", "three", "four"]
    assert text("<p a=/b/>one</p><img alt=\"x>y\"/>two<br/>three") == ["one", "two", "three"]
    open_tag = "<p " + "a=\"b\" " * 50_000
    assert text(f"<p>one</p>{open_tag}") and text("<i a='" * 2_000) is not None  # no closing sign: still quick
    assert text("<div>" * 30_000 + "deep" + "</div>" * 30_000) == ["deep"]


def test_unsure_names_keep_the_article():
    text = lambda html: [t for t, noise, _ in pages.page_lines(html) if not noise]
    body = "A long body of the article, which goes on and on."
    for names in ("entry comments-open", "share-price-report", "cookie-recipes"):
        assert text(f"<article><h1>Head</h1><div class='{names}'><p>{body}</p></div></article><nav>menu</nav>") == ["Head", body]
    for names in ("comments", "comment-list", "share", "post-comments", "related"):
        assert text(f"<article><h1>Head</h1><p>Short</p><div class='{names}'><p>{body}</p></div></article>") == ["Head", "Short"]


def test_names_of_wrappers():
    text = lambda html: [t for t, noise, _ in pages.page_lines(html) if not noise]
    for names in ("class='content no-sidebar'", "id='page' class='header-fixed'", "class='long-form'", "class='legal-analysis'", "class='widget'", "class='sidebar'"):
        for tag in ("article", "div"):
            assert text(f"<div {names}><{tag}><p>One long story</p></{tag}></div><nav>menu</nav>") == ["One long story"]
    assert text("<article><p>One</p></article><div class='comment-list'><article>a very long comment by a reader</article></div><div class='site-header'>x</div>") == ["One"]


# --- neighbours


@needs_data
def test_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    x, ids = np.stack([r.embedding for r in rows]).astype(float), np.array([r.vec_id for r in rows])
    found = {}
    for r in catalog.op5_neighbours(spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits += len({v for _, v, _ in found[q]} & set(ids[np.lexsort((ids, -s))[:20]]))
        assert all(abs(s[ids == v][0] - score) < 1e-9 for _, v, score in found[q])
    assert hits >= 0.97 * 20 * sum(ids % 20 == 0)


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (20, [-1.0, 1.0]), (None, [1.0, 1.0]), (8, [1.0])]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id bigint, embedding array<float>, block string")
    got = sorted(table(neighbours.nearest(df, 20)))
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -2.0), (20, 3, 2, -2.0)]
    assert table(neighbours.nearest(df.limit(0))) == [] and table(neighbours.nearest(df.filter("vec_id = 0"))) == []


# --- suffixes


def plain_cut(rows):
    seen, out = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for q in range(len(raw) - 99):
            if raw[q : q + 100] in seen:
                gone[q : q + 100] = b"\1" * 100
            seen.add(raw[q : q + 100])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((i, kept, len(raw), sum(gone), len(re.findall(b"\1+", gone))))
    return out


def test_recurring_keys_are_one_row_per_document(spark):
    """However many buckets a document's keys meet in; before, each of them made a row of its own."""
    rng = random.Random(17)
    texts = [" ".join(str(rng.randrange(400)) for _ in range(50)) for _ in range(30)]
    keys = lambda raw: (np.repeat(np.arange(len(raw)), [len(t.split()) for t in raw]), np.array([int(x) for t in raw for x in t.split()], np.uint64))
    frame = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)] + [(99, 0, "1000"), (100, 0, "")], "d bigint, h bigint, text string")
    counts = {}
    for x in " ".join(texts).split():
        counts[x] = counts.get(x, 0) + 1
    got = [(r.d, sorted(np.frombuffer(r.ordinals, "<u4").tolist())) for r in common.recurring(frame.repartition(3), 16, keys).collect()]
    assert sorted(got) == [(i, [k for k, x in enumerate(t.split()) if counts[x] > 1]) for i, t in enumerate(texts)]


@needs_data
def test_suffix_cut(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.without_repeats(docs).collect()]
    assert sorted(got) == plain_cut(rows)


def test_suffix_edges(spark, odd):
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.without_repeats(odd).collect()]
    once = {(r.doc_id, r.text) for r in odd.collect()}
    want = plain_cut(sorted(once, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")))
    assert set(got) == set(want) and len(got) == odd.count()
    run = frame(spark, [(1, "x" * 5000, "s"), (2, "ab" * 400, "s"), (3, "b" + "ab" * 300, "s")])
    assert sorted((r.doc_id, bytes(r.kept)) for r in suffixes.without_repeats(run).collect()) == [(i, k) for i, k, *_ in plain_cut([(r.doc_id, r.text) for r in run.collect()])]
    assert table(suffixes.without_repeats(odd.limit(0))) == []


def test_loser_tree():
    rng = random.Random(6)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 20))) for _ in range(5)]
    coded = [(r, suffixes.front_coded(r)[0].tolist()) for r in runs]
    run, place, shared = suffixes.merged(coded)
    got = [runs[r][p] for r, p in zip(run, place)]
    assert got == sorted(x for r in runs for x in r)
    common_length = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert shared[1:] == [common_length(a, b) for a, b in zip(got, got[1:])]


# --- lines


def distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) <= 1 and (a[k:] == b[k + 1 :] or len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def test_lines(spark, odd):
    rng = random.Random(8)
    pool = [passage(rng, 6) for _ in range(12)]
    rows = []
    for i in range(60):
        some = []
        for _ in range(4):
            line = rng.choice(pool)
            k = rng.randrange(len(line))
            some.append(rng.choice([line, line[:k] + line[k + 1 :], line[:k] + rng.choice(" xé") + line[k:], line[:k] + rng.choice(" y") + line[k + 1 :], "short", ""]))
        rows.append((i, "\n".join(some), "s"))
    seen, want = [], set()
    for i, text, _ in rows:
        for j, line in enumerate(text.split("\n")):
            if line and any(x == line or min(len(x), len(line)) >= 20 and distance_one(x, line) for x in seen):
                want.add((i, j))
            if line:
                seen.append(line)
    assert {(i, j) for i, _, j in table(lines.repeated_lines(frame(spark, rows)))} == want
    left = lines.without_repeats(odd)
    assert left.count() == odd.count() and left.columns[: len(odd.columns)] == odd.columns
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in left.filter("doc_id in (1, 2, 3, 4, 8)").collect()} == {1: (1, 0), 2: (1, 1), 3: (0, 0), 4: (0, 0), 8: (3, 1)}
    assert table(lines.without_repeats(odd.limit(0))) == []


def plain_lines(rows):
    """(doc_id, text, n_removed) per row: documents are (doc_id, text), in any order for equal doc_ids."""
    docs = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    seen, gone = [], {}
    for *doc, text in docs:
        for j, line in enumerate(text.split("\n")):
            if line and any(x == line or min(len(x), len(line)) >= 20 and distance_one(x, line) for x in seen):
                gone.setdefault((*doc, text), set()).add(j)
            if line:
                seen.append(line)
    out = []
    for i, t in rows:
        g = gone.get((i is not None, i or 0, t), set())
        out.append((i, t and "\n".join(x for j, x in enumerate(t.split("\n")) if j not in g), len(g)))
    return out


@pytest.mark.parametrize("rows", [
    # lines of one doc_id in several rows, and of rows without one: a place decides for its own row only
    [(4, "repeated line number one is here"), (5, "repeated line number one is here\nsecond of the first row"), (5, "unique line number one is here\nsecond of the other row")],
    [(None, "first of a row without id\nsecond of a row without id"), (None, "something else in the other row")],
    [(1, "some text of a row that stands twice"), (1, "some text of a row that stands twice"), (2, "some text of a row that stands twice")],
    # the same words in another order don't hide a true neighbour
    [(1, "the dog and the cat and the fox"), (2, "the cat and the dog and the fox"), (3, "the cat and the dog and the fix"), (4, "the dog and the cat and the fob")],
    [(1, "a b a c a d a e a f a g a h"), (2, "a c a b a d a e a f a g a h"), (3, "a c a ba d a e a f a g a h"), (4, "a c a b a d a e a f a g a hh"), (5, "a b a c a d a e a f a g ah")],
])
def test_lines_of_shared_ids_and_hidden_neighbours(spark, rows):
    got = lines.without_repeats(frame(spark, [(i, t, "s") for i, t in rows])).select("doc_id", "text", "n_removed")
    assert sorted(table(got), key=repr) == sorted(plain_lines(rows), key=repr)


def test_halves_are_made_once(spark):
    """Lines that share a half with another line, from one exchange of halves."""
    texts = ["a line of some length here", "a line of some length gone", "nothing like any other one", "b line of some length gone"]
    rows = spark.createDataFrame([(k, -k, t) for k, t in enumerate(texts)], "k1 bigint, k2 bigint, line string").withColumn("n", F.length("line"))
    found = lines.sharing_lines(rows)
    assert sorted(table(found)) == [(0, 0), (1, -1), (3, -3)]
    assert "lambda" not in lines.half_keys(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(node.nodeName() == "Generate" for node in nodes(found._jdf.queryExecution().optimizedPlan())) == 1


def test_lines_of_few_words_in_any_order(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.sample(["ab", "ac", "ab", "ad", "ac", "ae", "b", "ab"], 8)) for _ in range(25)]
    rows = []
    for i in range(120):
        line = rng.choice(pool)
        k = rng.randrange(len(line))
        rows.append((i, rng.choice([line[:k] + line[k + 1 :], line[:k] + rng.choice("abx ") + line[k + 1 :], line[:k] + rng.choice("abx") + line[k:]])))
    got = lines.without_repeats(frame(spark, [(i, t, "s") for i, t in rows])).select("doc_id", "text", "n_removed")
    want = plain_lines(rows)
    assert sorted(table(got)) == sorted(want) and 0 < sum(n for _, _, n in want) < 120


# --- chains


def test_passages(spark, odd):
    rng = random.Random(9)
    base = passage(rng, 90).split()
    fuzzy = base[:30] + base[31:50] + ["new", "words"] + base[50:70] + ["other"] + base[71:]
    rows = [(1, " ".join([passage(rng, 50), *base, passage(rng, 50)]), "s"), (2, " ".join([passage(rng, 20), *fuzzy, passage(rng, 20)]), "s"), (3, passage(rng, 300), "s")]
    got = table(chains.repeated_passages(frame(spark, rows)))
    assert len(got) == 1
    doc, start, end, other, o_start, o_end, matched = got[0]
    assert (doc, start, end, other, o_start, o_end) == (2, 20, 20 + len(fuzzy), 1, 50, 140) and matched == 88
    found = {(r[0], r[3]) for r in table(chains.repeated_passages(odd))}
    assert {(2, 1), (7, 1), (8, 1)} <= found and all(a in (2, 7, 8) for a, _ in found)
    assert table(chains.repeated_passages(odd.limit(0))) == []


def test_passages_with_spread_edits(spark):
    """One pair of documents per case: words replaced at even distances, or at random places, down to the allowed share."""
    rng = random.Random(12)
    rows, want = [], set()
    for size in (40, 60, 100):
        for k, percent in enumerate([80, 85, 90, 95] * 12):
            base = passage(rng, size).split()
            n = size - -(-percent * size // 100)
            gone = [(2 * x + 1) * size // (2 * n) for x in range(n)] if k < 4 else rng.sample(range(1, size - 1), n)
            copy = [f"new{rng.random()}" if i in gone else w for i, w in enumerate(base)]
            first = len(rows)
            rows += [(first, f"{passage(rng, 30)} {' '.join(base)} {passage(rng, 30)}", "s"), (first + 1, f"{passage(rng, 50)} {' '.join(copy)} {passage(rng, 50)}", "s")]
            want.add((first + 1, first))
    got = table(chains.repeated_passages(frame(spark, rows)))
    assert {(r[0], r[3]) for r in got} == want
    assert all(min(r[2] - r[1], r[5] - r[4]) >= 40 and 100 * r[6] >= 80 * max(r[2] - r[1], r[5] - r[4]) for r in got)


def test_passages_of_halves_from_different_documents(spark):
    rng = random.Random(13)
    a, b = passage(rng, 30), passage(rng, 30)
    texts = {1: a, 7: a, 2: b, 8: b, 5: f"{a} {b}", 9: f"{a} {b}"}
    got = table(chains.repeated_passages(frame(spark, [(i, f"{passage(rng, 20)} {t} {passage(rng, 20)}", "s") for i, t in texts.items()])))
    assert got == [(9, 20, 80, 5, 20, 80, 60)]


def test_passages_whose_seeds_stand_in_other_documents_too(spark):
    """Documents 2 and 6 share a passage, but every seed of it stands first in document 1 and last in document 5, in pieces."""
    rng = random.Random(14)
    base = passage(rng, 60).split()
    pieces = lambda: " ".join(f"{' '.join(base[k : k + 4])} {passage(rng, 4)}" for k in range(57))
    texts = {1: pieces(), 2: f"{passage(rng, 20)} {' '.join(base)} {passage(rng, 20)}", 5: pieces(), 6: f"{passage(rng, 30)} {' '.join(base)} {passage(rng, 30)}"}
    got = table(chains.repeated_passages(frame(spark, [(i, t, "s") for i, t in texts.items()])))
    assert [r for r in got if r[0] == 6] == [(6, 30, 90, 2, 20, 80, 60)]


def test_all_pairs_of_different_texts(spark, monkeypatch):
    """Near copies are linked all with all, also where places of a seed fill several tiles; copies are rows of the first one."""
    rng = random.Random(15)
    base = passage(rng, 70).split()
    texts = {i: " ".join(w if k != 4 * i else f"new{i}" for k, w in enumerate(base)) for i in range(1, 13)}
    rows = [(i, t, "s") for i, t in texts.items()] + [(20, texts[3], "s"), (21, texts[3], "s"), (21, texts[3], "s"), (22, "a b c", "s"), (23, "a b c", "s")]
    want = {(a, b) for a in texts for b in texts if a > b} | {(20, 3), (21, 3)}
    for tile in (chains.TILE, 3):
        monkeypatch.setattr(chains, "TILE", tile)
        got = table(chains.repeated_passages(frame(spark, rows)))
        whole = [r for r in got if (*r[1:3], *r[4:6]) == (0, 70, 0, 70)]
        assert {(r[0], r[3]) for r in got} == want and sorted((r[0], r[3]) for r in whole) == sorted(want)
        assert all(r[6] == (70 if r[0] > 12 else 68) for r in whole)


def test_words_around_a_seed_rule_out_no_passage():
    rng = random.Random(16)
    for _ in range(200):
        base = passage(rng, 40).split()
        gone = rng.sample(range(40), 8)
        copy = [f"new{rng.random()}" if i in gone else w for i, w in enumerate(base)]
        texts = [f"{passage(rng, a)} {' '.join(t)} {passage(rng, b)}".strip().encode() for t, a, b in ((base, rng.randint(0, 50), rng.randint(0, 50)), (copy, rng.randint(0, 50), 5))]
        side = chains.around(40, 80)[1]
        of, pos, seed, *_, near = chains.places_of(texts, np.arange(2).astype(np.uint64), [np.arange(len(t.split()) - 3) for t in texts], side)
        x, y = np.nonzero((seed[:, None] == seed) & (of[:, None] == 1) & (of == 0))
        inside = (pos[y] - pos[y].min() < 37) & (pos[x] - pos[x].min() < 37)
        assert inside.any() and chains.possible(x[inside], y[inside], near, 40, 80).any()
        assert chains.possible(x, y, near, 40, 80).sum() >= 1


def test_meetings_of_tiles_against_all_pairs(monkeypatch):
    """Tiles of one and two blocks, looked at pair by pair and as panels; what is found stays the same when it is packed."""
    rng = np.random.default_rng(17)
    side = chains.around(40, 80)[1]
    rows, want, sizes = [], set(), []
    for seed, (i, j) in enumerate([(0, 0), (0, 1), (2, 2), (1, 1), (0, 2), (1, 2)]):
        n = 3 if seed == 3 else 60
        block = np.repeat([i, j], [n // 2, n - n // 2]) if seed != 5 else np.full(n, 1)
        near = np.where(rng.random((n, 2 * side)) < 0.8, np.arange(2 * side) % 90, rng.integers(0, 256, (n, 2 * side))).astype(np.uint8)
        longer = rng.integers(0, 2, (n, chains.LONGER)).astype(np.uint64)
        doc, pos, before, chosen = rng.integers(0, 25, n), rng.permutation(n), np.sort(rng.integers(0, 6, n)), rng.random(n) < 0.4
        rows += [
            {"seed": seed, "doc": doc[x], "pos": pos[x], "before": before[x], "chosen": chosen[x], "reach": 0, "near": longer[x].tobytes() + near[x].tobytes(), "block": block[x], "i": i, "j": j} for x in range(n)
        ]
        for x in range(n):
            for y in range(x + 1, n):
                if (i == j or block[x] != block[y]) and (before[x] != before[y] or (chosen[x] and chosen[y])):
                    b, a = sorted((x, y), key=lambda k: (doc[k], pos[k]))
                    if chains.possible(np.array([a]), np.array([b]), near, 40, 80)[0]:
                        equal = np.logical_and.accumulate((longer[a] == longer[b]) & (longer[a] != 0)).sum()
                        want.add((doc[a], doc[b], pos[a], pos[b], 4 * (1 + equal), seed))
        sizes.append(n)
    cuts = np.cumsum([0, *sizes[:-1]])
    for dense, panel in ((512, (256, 1024)), (1, (7, 11))):
        monkeypatch.setattr(chains, "DENSE", dense)
        monkeypatch.setattr(chains, "PANEL", panel)
        found = list(chains.fitting(pd.DataFrame(rows), cuts, 40, 80))
        got = sorted(tuple(r) for f in found for r in np.column_stack(f).tolist())
        assert got == sorted(tuple(int(v) for v in r[:5]) for r in want) and 100 < len(got) < 7000
        packed = chains.packed_links(found, 5)
        assert len({b for b, _ in packed}) == len(packed) <= 5
        assert sorted(tuple(r) for _, raw in packed for r in chains.unpacked_links(raw).tolist()) == got


def test_places_are_exchanged_once_and_shuffles_are_given_back(spark, monkeypatch):
    """What the steps of seed_links leave on disk when they are staged: tables alone, and places of rare seeds went through one exchange each."""
    rng = random.Random(18)
    shared = passage(rng, 60)
    rows = [(i, f"{passage(rng, 20)} {shared} {passage(rng, 20)}", "s") for i in range(12)]
    plans = []
    real = chains.stage

    def spied(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
        return real(df, name)

    monkeypatch.setattr(chains, "stage", spied)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    links = chains.seed_links(frame(spark, rows).select("doc_id", "text"), 40, 80)
    assert spark.conf.get(key, None) == old
    met = [p for name, p in plans if name == "meetings"]
    assert len(met) == chains.ROUNDS and all(p.count("find") + p.count("<lambda>") == 1 and "Union" not in p for p in met)
    pairs = {(d, o) for r in links.collect() for d, o, *_ in chains.unpacked_links(r["links"]).tolist()}
    assert pairs == {(a, b) for a in range(12) for b in range(a)}


def test_chains_against_all_predecessors():
    rng = random.Random(11)
    for _ in range(30):
        parts = sorted({(rng.randrange(200), rng.randrange(200), rng.randint(8, 20)) for _ in range(25)})
        score = []
        for p, o, k in parts:
            before = [s - chains.GAP_COST * (p - pj - kj + o - oj - kj) / 2 for s, (pj, oj, kj) in zip(score, parts) if pj + kj <= p and oj + kj <= o]
            score.append(k + max([0.0, *before]))
        first = chains.chained(parts)[0]
        total = sum(parts[i][2] for i in first) - chains.GAP_COST / 2 * sum(parts[j][c] - parts[i][c] - parts[i][2] for i, j in zip(first, first[1:]) for c in (0, 1))
        assert abs(total - max(score)) < 1e-9


def linked_texts(rng, n, alternatives=0):
    """({(doc, text): words}, links of all equal seeds of two documents or places) of documents with stretches of one repeated word, near copies and odd words."""
    base, texts = [f"w{rng.randrange(60)}" for _ in range(160)], {}
    for doc in range(n):
        out = []
        while len(out) < rng.choice([30, 90, 200]):
            kind, start = rng.random(), rng.randrange(100)
            part = [rng.choice("xy")] * rng.randint(5, 70) if kind < 0.4 else base[start : start + rng.randint(8, 60)] if kind < 0.9 else [f"own{rng.random()}"]
            out += [w if rng.random() < 0.93 or kind < 0.2 else f"w{rng.randrange(60)}" for w in part]
        texts[doc, 0] = out
        if doc < alternatives:
            texts[doc, 1] = [w if rng.random() < 0.9 else "other" for w in out][: rng.randint(20, len(out))]
    words = {k: common.words_of([" ".join(t).encode()])[0].astype("<u4") for k, t in texts.items()}
    places = {}
    for doc in range(n):
        for p in range(len(texts[doc, 0]) - 3):
            places.setdefault(tuple(texts[doc, 0][p : p + 4]), []).append((doc, p))
    links = [(d, o, p, q, 4) for same in places.values() for d, p in same for o, q in same if (d, p) > (o, q) and rng.random() < 0.9]
    return words, np.array(links)


def packed_tile(words, links, parts, extend):
    """links in several packed rows, and the words around them."""
    packed = [raw for x in np.array_split(links[np.random.default_rng(1).permutation(len(links))], parts) for _, raw in chains.packed_links([tuple(x.T)], 1)]
    place = np.concatenate((links[:, 2], links[:, 3]))
    doc, begin, end = chains.merged([np.concatenate((links[:, 0], links[:, 1]))], np.maximum(place - extend, 0), place + 4 + extend)
    regions = []
    for (d, t), w in words.items():
        mine = doc == d
        cut = [w[b:e] for b, e in zip(begin[mine], end[mine])]
        regions.append(chains.packed_regions(doc[mine], np.full(mine.sum(), t), begin[mine], np.array([len(c) for c in cut], np.int64), np.concatenate([w[:0], *cut])))
    return packed, regions


def test_all_chains_at_once_against_one_by_one(monkeypatch):
    """Passages of a tile are those of each pair's chains, aligned one by one; of a document's texts the one with the greatest words counts."""
    rng, total = random.Random(19), 0
    for case, (least, percent) in enumerate([(40, 80), (40, 80), (12, 70), (50, 90), (8, 100)]):
        monkeypatch.setattr(chains, "LINKS", 1 << 20 if case % 2 else 5000)
        monkeypatch.setattr(chains.alignment, "SOME", 12 if case % 2 else 2)
        monkeypatch.setattr(chains.alignment, "CELLS", 1 << 22 if case % 2 else 9000)
        words, links = linked_texts(rng, 10, alternatives=2 if case else 0)
        want = set()
        for d, o in sorted({(d, o) for d, o, *_ in links.tolist()}):
            mine, found = links[(links[:, 0] == d) & (links[:, 1] == o)], []
            for rows in chains.passages(*mine[:, 2:].T):
                sides = []
                for s, doc in enumerate((d, o)):
                    ways = [[words[doc, t][b:e] for b, e in chains.boxes(rows, s, least).tolist()] for t in (0, 1) if (doc, t) in words]
                    sides.append(max(ways, key=lambda w: np.concatenate(([len(x) for x in w], *w)).astype("<u4").tobytes()))
                found += chains.aligned(rows, *sides, least, percent)
            want |= {(d, p, e, o, op, oe, m) for p, e, op, oe, m in chains.not_inside(found) if found}
        got = chains.tile_passages(*packed_tile(words, links, 3, max(least, chains.MOST_GAP)), least, percent).tolist()
        assert sorted(map(tuple, got)) == sorted(want) and want
        total += len(want)
    assert total > 200


def test_shifts_of_repeated_words_are_aligned_together(spark, monkeypatch):
    """Two stretches of one word have a chain for every shift: no step is taken for each, and they don't leave the task."""
    rng = random.Random(20)
    n, m = 700, 1500
    texts = {k: [*passage(rng, 30).split(), *["same"] * size, *passage(rng, 30).split()] for k, size in ((1, m), (2, n))}
    words = {(k, 0): common.words_of([" ".join(t).encode()])[0].astype("<u4") for k, t in texts.items()}
    p, q = np.arange(30, 30 + n - 3), np.arange(30, 30 + m - 3)
    links = np.array([(2, 1, x, y, 4) for x in p for y in q if x == p[0] or y == q[0] or (x - y) % 97 == 0])
    links[:, 4] = np.minimum(30 + n - links[:, 2], 30 + m - links[:, 3])
    steps = dict.fromkeys(("common_words", "aligned", "common_tables"), 0)
    for name in steps:
        real = getattr(chains.alignment, name)

        def counted(*args, name=name, real=real):
            steps[name] += 1
            return real(*args)

        monkeypatch.setattr(chains.alignment, name, counted)
    got = chains.tile_passages(*packed_tile(words, links, 2, chains.MOST_GAP), 40, 80).tolist()
    want = [[2, 30, 30 + n, 1, 30 + x, 30 + x + n, n] for x in range(m - n + 1)]
    assert sorted(got) == want and sum(steps.values()) < 5
    rows = [(k, " ".join(t), "s") for k, t in texts.items()]
    whole = chains.repeated_passages(frame(spark, rows))
    assert {tuple(r) for r in want} <= set(table(whole))
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "Aggregate" not in plan.split("FlatMapCoGroupsInPandas")[1].split("Union")[0]


# --- pipeline


@needs_data
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.stage(step(spark, docs, BASE), name)
        assert docs.columns == columns
        had, has = ({r.doc_id for r in d.select("doc_id").collect()} for d in (before, docs))
        assert has <= had and len(has) > 0.5 * len(had)
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = sorted(table(corpus_pipeline.run(spark, BASE)), key=lambda r: r[1])
    assert got == plain_tokens(rows)
    assert hashlib.sha256(repr(got).encode()).hexdigest() == hashlib.sha256(repr(sorted(table(corpus_pipeline.run(spark, BASE)), key=lambda r: r[1])).encode()).hexdigest()


@needs_data
def test_queries_are_complete(spark):
    names = list(catalog.queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert set(catalog.oracles()) <= set(names)
    assert F is not None


def test_word_ids_equal_the_tokenizer():
    """Words put together from pieces have the ids that the tokenizer gives the whole text."""
    import random

    from actionwise.llm.catalog import tokenizer_path

    known = tokens.WordIds(tokenizer_path())
    assert known.by_pieces
    draw = random.Random(1)
    signs = "aSstTdD'''!?09 \t\n\r\x1c<|>éÉ́×÷ßÿÞªº¹ñ中²_-Llve"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) for _ in range(2000)]
    texts += ["", "<|endoftext|>x", "a<|STARTOFTEXT|>", "it'S don'T I'LL 'ts ''s !'s", "".join(map(chr, range(0xC0, 0x180)))]
    for text in texts:
        assert tokens.numbers(known.text(text), known.kind == "<u4").tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids
