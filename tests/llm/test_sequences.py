"""Fill-in-the-middle, packing and periodic runs against brute force on small tables, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from actionwise.llm import catalog, middle, packing, periods

BASE = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(BASE).exists(), reason="test tables not available")
SCHEMA = "doc_id bigint, text string, ids string, length string, code string, n string, start string, number string, _number string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e", "f", "g") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_rows():
    """NULL, empty, blank, very long and repeated texts, repeated and NULL ids, sentinels, other white space."""
    rng = random.Random(5)
    long = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, "some text\nof two lines"), (None, None), (4, long), (5, "x y " * 5000), (5, "x y " * 5000), (6, "a <S> b"),
        (7, "one line"), (8, "ends\n"), (9, "\n\n\n"), (10, "é\nü𝄞\nß"), (11, "a  b c\x0bd"), (12, "don't 's\n'll 12 3"), (13, "x <|endoftext|> y"),
        (14, "日本 語 a\n ё"), (15, "ab " * 8 + "tail"), (16, "ab " * 24), (17, "ab " * 23 + "cd"), (20, "last\x85word\x1c end"),
    ]
    return rows + [(100 + k, " ".join(rng.choice(["a", "b", "ab"]) for _ in range(rng.randint(0, 90)))) for k in range(120)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


# --- fill in the middle


def test_middle_against_plain_slices(spark, odd, odd_rows):
    def plain(i, text):
        text = text or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        digest = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
            return i, len(units), "plain", None, None, sha(text), sha(text)
        spm = h[3] % 100 < 50
        return i, len(units), "spm" if spm else "psm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"), sha(text)

    got = [tuple(r) for r in middle.report(odd).collect()]
    assert sorted(got, key=repr) == sorted((plain(*r) for r in odd_rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert middle.report(odd.limit(0)).collect() == []


def test_middle_restores_any_text():
    rng = random.Random(1)
    for i in range(3000):
        raw = "".join(rng.choice("ab\nü<P>SM𝄞 ") for _ in range(rng.randint(0, 30))).encode()
        n, form, prefix, inner, output = middle.transform(raw, i, 7, 100, 50)
        assert middle.restore(output, form) == raw
    assert middle.transform(b"a\nb", 1, 7, 0, 50)[1] == "plain"


def test_exchange_moves_blocks_of_any_size(monkeypatch):
    monkeypatch.setattr(middle, "PIECE", 3)
    for cut in range(12):
        data = np.arange(12, dtype=np.uint8)
        middle.exchange(data, 0, cut, 12)
        assert list(data) == [*range(cut, 12), *range(cut)]


# --- packing


def unfolded(plan):
    """sequence -> [(offset, length), ...] of a plan, and the pieces of each length placed."""
    sequences, placed = defaultdict(list), Counter()
    for length, first, items, sequence, each, offset in plan.runs:
        assert first == placed[length]
        placed[length] += items
        for k in range(items):
            sequences[sequence + k // each].append((offset + k % each * length, length))
    return sequences, placed


@pytest.mark.parametrize("seed", range(60))
def test_plan_places_every_piece_without_gaps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 16, 64, 100])
    counts = {rng.randint(1, capacity): rng.randint(1, rng.choice([1, 5, 60])) for _ in range(rng.randint(0, 20))}
    plan = packing.planned(counts, capacity)
    sequences, placed = unfolded(plan)
    assert placed == Counter(counts) and len(sequences) == plan.sequences
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_plan_is_near_the_least_possible():
    """Triplets that fill sequences exactly: best fit by falling length alone needs about a tenth more than the least."""
    rng = random.Random(3)
    counts = Counter()
    for _ in range(400):
        a, b = rng.randint(540, 800), rng.randint(540, 700)
        counts.update([a, b, 2048 - a - b])
    plain, rooms = 0, Counter()
    for length in sorted(counts.elements(), reverse=True):
        room = min((r for r in rooms if r >= length and rooms[r] > 0), default=2048)
        plain += not rooms[2048] and room == 2048
        rooms[room] -= room < 2048
        rooms[room - length] += 1
    assert 400 <= packing.planned(counts).sequences <= min(plain, 440)


def test_configurations_solve_the_linear_programme():
    # sizes 3, 4 and 5 in 10: ten times 3 + 3 + 4 and four times 5 + 5
    found = packing.configurations(np.array([3, 4, 5]), np.array([20.0, 10.0, 8.0]), 10)
    assert all(c @ [3, 4, 5] <= 10 for c, _ in found)
    assert np.allclose(sum(c * t for c, t in found), [20, 10, 8])
    assert sum(t for _, t in found) == pytest.approx(14)


def test_word_table_equals_the_tokenizer(odd_rows):
    known = packing.Words(catalog.tokenizer_path("byte_bpe_50k.json"))
    assert known.merge is not None
    texts = [t or "" for _, t in odd_rows] + ["", " ", "\n", " a", "a ", "a\n\nb", "a \n b", "\na", "\r\nfoo bar", "ª º", "a b", "1 2\n3"]
    for _ in range(2):  # new words, then known ones
        assert [list(x) for x in known.texts(texts)] == [known.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    # another kind of tokenizer gets whole texts
    other = packing.Words(catalog.tokenizer_path("word_bpe_49k.json"))
    assert other.merge is None
    assert [list(x) for x in other.texts(texts)] == [other.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_packed_documents(spark, odd, odd_rows):
    path = catalog.tokenizer_path("byte_bpe_50k.json")
    tokenizer = packing.Words(path).tokenizer
    want = Counter()
    for i, t in odd_rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        cut = len(ids) % 2048 or 2048
        for k, (a, b) in enumerate([(0, len(ids))] if len(ids) <= 2048 else [(0, cut), *((x, x + 2048) for x in range(cut, len(ids), 2048))]):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    rows = packing.packed(odd, path)
    got = packing.report(odd, path).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-sum(r.length for r in got) // 2048) + 2
    together = packing.sequences(rows)
    assert together.filter(F.length("ids") != 4 * F.col("n_tokens")).count() == 0
    assert together.agg(F.sum("n_tokens")).first()[0] == sum(r.length for r in got)
    assert packing.report(odd.limit(0), path).collect() == []


# --- periodic runs


def plain_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        x = 0
        while x + q < len(words):
            begin = x
            while x + q < len(words) and words[x] == words[x + q]:
                x += 1
            if x - begin + q >= max(least, times * q):
                found.setdefault((begin, x - begin + q), q)
            x += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_report(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str("" if i is None else i).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    milli = best and 1000 * best[1] // best[2]
    return (
        i, len(runs), *(best or (None, None, None)), milli,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in dropped)),
    )


@pytest.mark.parametrize("seed", range(40))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(rng.randint(1, 6)):
        words = []
        for _ in range(rng.randint(0, 5)):
            k = rng.choice([1, 2, 3, 30])
            unit = [rng.randint(1, k) for _ in range(rng.randint(1, 14))] * rng.randint(1, 40)
            words += unit[: rng.randint(1, 200)] if rng.random() < 0.6 else [rng.randint(1, k) for _ in range(rng.randint(0, 80))]
        texts.append(np.array(words, np.int64))
    for least, times in ((24, 3), (4, 2)):
        got = list(zip(*(x.tolist() for x in periods.find_runs(texts, least, times))))
        assert got == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t.tolist(), least, times)]


@pytest.mark.parametrize("seed", range(20))
def test_extensions_against_comparing_words(seed):
    rng = np.random.default_rng(seed)
    words = rng.integers(1, [2, 3, 40][seed % 3], rng.integers(2, 300))
    words[: len(words) // 2] = np.resize(words[:7], len(words) // 2)
    a, b = rng.integers(0, len(words), (2, 400))
    a, b = a[a != b], b[a != b]

    def plain(i, j):
        k = 0
        while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
            k += 1
        return k

    assert periods.Extensions(words).common(a, b).tolist() == [plain(i, j) for i, j in zip(a, b)]


def test_candidates_in_many_pieces(monkeypatch):
    monkeypatch.setattr(periods, "PAIRS", 5)
    texts = [np.array([1, 2, 3] * 30), np.array([1] * 50), np.arange(1, 40), np.array([4, 5] * 40)]
    got = list(zip(*(x.tolist() for x in periods.find_runs(texts))))
    assert got == [(0, 0, 90, 3), (1, 0, 50, 1), (3, 0, 80, 2)]


def test_periods_of_documents(spark, odd, odd_rows):
    got = [tuple(r) for r in periods.report(odd).collect()]
    small = [r for r in odd_rows if r[0] != 4]  # brute force is too slow for the long one
    assert sorted((g for g in got if g[0] != 4), key=repr) == sorted((plain_report(*r) for r in small), key=repr)
    assert len(got) == len(odd_rows) and any(g[1] for g in got)
    assert periods.report(odd.limit(0)).collect() == []


@needs_data
def test_periods_of_the_test_table(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").filter("n_chars < 3000")
    want = [plain_report(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, periods.report(docs).collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 3
