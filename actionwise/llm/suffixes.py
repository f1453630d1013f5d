"""Suffix-array dedup: removes every byte under a string of SPAN bytes that also starts earlier.

Sorting all suffixes would move a hundred times the text. It is enough to sort those at anchors: of the GRAM-byte strings inside
a window of SPAN bytes, the one with the smallest hash is the window's anchor, so equal windows have equal anchors at the same place.

1. Anchors are counted by hash; those that occur once, most of them, are done with.
2. The suffixes at the other anchors (the bytes under the anchor's windows) are sorted inside each task. Equal ones are decided there but for
   the earliest, so that a group of copies sends one suffix per task. Runs are front-coded (length shared with the suffix before, and the rest)
   and exchanged by the hash of their anchor.
3. Each receiver merges its runs with a loser tree that remembers how much each head shares with the last winner and never compares these bytes
   again. The shared lengths of the merged order tell which suffixes agree to any depth; together with the bytes left of the anchor,
   each window is found equal to others or not, and the earliest stays.
4. Windows of a document are joined to spans and cut out.

Texts are UTF-8 bytes, NULL is empty; matches never cross documents. Earlier means a smaller doc_id (NULL first), then the text's hash for
rows of the same doc_id, then the start. The very same (doc_id, text) in several rows is one document with that many result rows.
Strings are judged on the input; overlaps count. Texts under SPAN bytes lose nothing. Extra columns take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import chunked, likely_in, prefix_hash, recurring, sieved, span_hash

SPAN = 100
GRAM = 32
PLACES = SPAN - GRAM + 1   # places of an anchor in a window
RUN = 50_000               # suffixes sorted at once
NONE = -(1 << 63)          # stands for a NULL doc_id


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, first window, last window, hash) per anchor, and where the texts begin; all in the joined texts."""
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if len(data) < SPAN:
        e = np.empty(0, np.int64)
        return e, e, e, e, e.astype(np.uint64), begin
    grams = np.arange(len(data) - GRAM + 1)
    value = hashes = span_hash(prefix_hash(data), grams, grams + GRAM)
    place = grams
    step = 1
    while step < PLACES:  # smallest of 2, 4, ... places, the left one of equals
        shift = min(step, PLACES - step)
        left = value[:-shift] <= value[shift:]
        value = np.where(left, value[:-shift], value[shift:])
        place = np.where(left, place[:-shift], place[shift:])
        step += shift
    window = np.arange(len(place))
    of = np.searchsorted(begin, window, side="right") - 1
    inside = window + SPAN < begin[of + 1]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    good = inside[first]
    first, last = first[good], last[good]
    return of[first], place[first], first, last, hashes[place[first]], begin


def front_coded(rights: Sequence[bytes]) -> tuple[np.ndarray, bytes]:
    """(length shared with the one before, all the rests) of sorted strings."""
    size = max(map(len, rights), default=0)
    table = np.frombuffer(b"".join(r.ljust(size, b"\0") for r in rights), np.uint8).reshape(-1, size)
    length = np.fromiter(map(len, rights), np.int64, len(rights))
    shared = np.zeros(len(rights), np.int64)
    if len(rights) > 1:
        differ = table[1:] != table[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
        shared[1:] = np.minimum(shared[1:], np.minimum(length[1:], length[:-1]))
    return shared, b"".join(r[k:] for r, k in zip(rights, shared))


def decoded(shared: np.ndarray, lengths: np.ndarray, rests: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for k, n in zip(shared.tolist(), lengths.tolist()):
        last = last[:k] + rests[at : at + n - k]
        at += n - k
        out.append(last)
    return out


def merged(runs: Sequence[tuple[Sequence[bytes], Sequence[int]]]) -> tuple[list[int], list[int], list[int]]:
    """(run, place in it, length shared with the one before) of all strings in order, from sorted runs with their shared lengths.

    A loser tree. `known` holds how much each head shares with the last winner: the head that shares more is smaller, and
    of two that share the same, only bytes behind are compared.
    """
    width = 1 << max(len(runs) - 1, 0).bit_length()
    strings = [r[0] for r in runs] + [()] * (width - len(runs))
    lcps = [r[1] for r in runs]
    at, known = [0] * width, [0] * width
    heads = [s[0] if len(s) else None for s in strings]

    def beats(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        if y is None or x is None:
            return x is not None or (y is None and a < b)
        if known[a] != known[b]:
            return known[a] > known[b]
        k, end = known[a], min(len(x), len(y))
        while k < end and x[k] == y[k]:
            k += 1
        win = len(x) <= len(y) if k == end else x[k] < y[k]
        known[b if win else a] = k
        return win

    losers = [0] * width
    level = list(range(width))
    base = width
    while len(level) > 1:
        base //= 2
        up = []
        for i in range(0, len(level), 2):
            a, b = level[i], level[i + 1]
            won, lost = (a, b) if beats(a, b) else (b, a)
            losers[base + i // 2] = lost
            up.append(won)
        level = up
    winner = level[0]
    run, place, shared = [], [], []
    while heads[winner] is not None:
        run.append(winner)
        place.append(at[winner])
        shared.append(known[winner])
        at[winner] += 1
        k = at[winner]
        if k < len(strings[winner]):
            heads[winner], known[winner] = strings[winner][k], lcps[winner][k]
        else:
            heads[winner] = None
        node = (winner + width) // 2
        while node:
            other = losers[node]
            if beats(other, winner):
                losers[node], winner = winner, other
            node //= 2
    return run, place, shared


def repeated_windows(shared: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, offset) of windows that start earlier too.

    Suffixes are in order. A window lies `offset` bytes left of its anchor, low <= offset <= high; left[:, j] is the byte j + 1 left of it;
    where is the order of the anchors in the documents.
    """
    out_s, out_o = [], []
    hashes = np.zeros(len(shared), np.uint64)
    for offset in range(int(high.max(initial=-1)) + 1):
        if offset:
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + left[:, offset - 1] + np.uint64(1)
        mine = np.flatnonzero((low <= offset) & (offset <= high))
        if len(mine) < 2:
            continue
        block = np.cumsum(shared < SPAN - offset)[mine]
        order = np.lexsort((where[mine], hashes[mine], block))
        s = mine[order]
        start = np.ones(len(s), bool)
        start[1:] = (block[order][1:] != block[order][:-1]) | (hashes[s][1:] != hashes[s][:-1])
        earliest = where[s][np.maximum.accumulate(np.where(start, np.arange(len(s)), 0))]
        later = s[where[s] > earliest]
        out_s.append(later)
        out_o.append(np.full(len(later), offset))
    none = np.empty(0, np.int64)
    return np.concatenate(out_s or [none]), np.concatenate(out_o or [none])


RUNS = "bucket int, n int, lengths binary, shared binary, rests binary, low binary, high binary, lefts binary, d binary, h binary, p binary, done binary"


def _runs(docs: DataFrame, buckets: int) -> DataFrame:
    """Front-coded sorted runs from (d, h, text, ordinals). `done` holds (d, h, first, end) of windows decided inside the task."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def packed() -> pd.DataFrame:
            out = []
            held.sort()
            begin = 0
            for k in range(1, len(held) + 1):
                if k < len(held) and held[k][0] == held[begin][0]:
                    continue
                rows, done = [], []
                for item in held[begin:k]:
                    if rows and item[1:5] == rows[-1][1:5]:
                        if item[5:] > rows[-1][5:]:
                            done.append((item[5], item[6], item[7] - item[4], item[7] - item[3] + SPAN))
                    else:
                        rows.append(item)
                rights = [r[1] for r in rows]
                shared, rests = front_coded(rights)
                pack = lambda j, kind: np.array([r[j] for r in rows], kind).tobytes()
                lefts = b"".join(r[2][::-1].ljust(PLACES, b"\0") for r in rows)
                out.append((held[begin][0], len(rows), np.array(list(map(len, rights)), np.uint8).tobytes(), shared.astype(np.uint8).tobytes(), zlib.compress(rests, 1), pack(3, np.uint8), pack(4, np.uint8),
                            zlib.compress(lefts, 1), pack(5, np.int64), pack(6, np.int64), pack(7, np.int64), np.array(done, np.int64).tobytes()))
                begin = k
            return pd.DataFrame(out, columns=[c.split()[0] for c in RUNS.split(", ")])

        for batch in batches:
            ids = batch[["d", "h"]].to_numpy(np.int64)
            wanted = batch["ordinals"]
            for start, part in chunked(batch["text"]):
                of, place, first, last, value, begin = anchors(part)
                joined = b"\n".join(part)
                bucket = (value % np.uint64(buckets)).astype(np.int64)
                head = np.searchsorted(of, np.arange(len(part)))
                for i in range(len(part)):
                    numbers = np.unique(np.frombuffer(wanted.iat[start + i], "<u4"))
                    d, h = ids[start + i].tolist()
                    for a in (head[i] + numbers).tolist():
                        p, lo, hi = int(place[a]), int(first[a]), int(last[a])
                        held.append((int(bucket[a]), joined[p : hi + SPAN], joined[lo:p], p - hi, p - lo, d, h, p - int(begin[i])))
                if len(held) >= RUN:
                    yield packed()
                    held = []
        if held:
            yield packed()

    return docs.mapInPandas(send, RUNS)


def _decide(part: pd.DataFrame) -> pd.DataFrame:
    """(d, h, first, end) from the runs of a bucket: spans of joined windows."""
    runs = []
    for r in part.itertuples():
        lengths, shared = np.frombuffer(r.lengths, np.uint8), np.frombuffer(r.shared, np.uint8)
        runs.append((decoded(shared, lengths, zlib.decompress(r.rests)), shared.tolist()))
    run, place, shared = (np.array(x, np.int64) for x in merged(runs))
    base = np.concatenate(([0], np.cumsum(part["n"])))[:-1]
    at = base[run] + place
    fetch = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in part[c]])[at]
    d, h, p = (fetch(c, np.int64) for c in ("d", "h", "p"))
    low, high = fetch("low", np.uint8).astype(np.int64), fetch("high", np.uint8).astype(np.int64)
    left = np.concatenate([np.frombuffer(zlib.decompress(x), np.uint8).reshape(-1, PLACES) for x in part["lefts"]])[at]
    where = np.empty(len(at), np.int64)
    order = np.lexsort((p, h, d))
    new = np.ones(len(at), bool)
    new[1:] = (d[order][1:] != d[order][:-1]) | (h[order][1:] != h[order][:-1]) | (p[order][1:] != p[order][:-1])
    where[order] = np.cumsum(new)
    s, offset = repeated_windows(shared, left, low, high, where)
    done = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for x in part["done"]])
    rows = np.concatenate((np.column_stack((d[s], h[s], p[s] - offset, p[s] - offset + SPAN)), done))
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # windows that meet become one span
    same = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
    cut = np.flatnonzero(~(same & (rows[1:, 2] <= rows[:-1, 3]))) + 1
    begin = np.concatenate(([0], cut)) if len(rows) else np.empty(0, np.int64)
    end = np.maximum.reduceat(rows[:, 3], begin) if len(rows) else np.empty(0, np.int64)
    return pd.DataFrame({"d": rows[begin, 0], "h": rows[begin, 1], "first": rows[begin, 2], "end": end})


def joined_spans(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans (first, end) with those that meet or overlap joined."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    begin = np.concatenate(([0], np.flatnonzero(first[1:] > end[:-1]) + 1))
    return np.column_stack((first[begin], np.append(end[begin[1:] - 1], end[-1])))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(d, h, firsts, ends) of documents (d, h, text) that lose bytes: the spans, in any order."""
    buckets = max(docs.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    again = stage(recurring(docs, buckets, lambda texts: anchors(texts)[0:5:4]), "suffix_anchors")
    sources = likely_in(docs, again, "d").join(again, ["d", "h"])
    spans = _runs(sources.dropDuplicates(["d", "h"]), buckets).groupBy("bucket").applyInPandas(_decide, "d bigint, h bigint, first bigint, end bigint")
    spans = spans.groupBy("d", "h").agg(F.collect_list("first").alias("firsts"), F.collect_list("end").alias("ends"))
    return stage(spans, "suffix_spans")


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans): `kept` are the bytes that stay, which need not be whole characters."""
    base = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(NONE)).alias("d"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"))
    spans = repeated_spans(base.select("d", "h", "text"))
    split = sieved(base, spans, "d")
    touched = split.filter("_in").join(spans, ["d", "h"], "left").select("doc_id", "text", "firsts", "ends")
    none = F.lit(None).cast("array<bigint>")
    whole = split.filter("NOT _in").select("doc_id", "text", none.alias("firsts"), none.alias("ends"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, first, end in zip(batch["text"], batch["firsts"], batch["ends"]):
                raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
                gone = joined_spans(np.asarray(first), np.asarray(end)).tolist() if first is not None else []
                edges = [0, *(x for span in gone for x in span), len(raw)]
                kept = b"".join(raw[b:e] for b, e in zip(edges[::2], edges[1::2]))
                out.append((kept, len(raw), len(raw) - len(kept), len(gone)))
            frame = pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "n_spans"])
            yield frame.assign(doc_id=batch["doc_id"].astype("Int64"))[["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]]

    return touched.unionByName(whole).mapInPandas(cut, "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
