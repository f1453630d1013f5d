"""Periodic runs of words: stretches that repeat themselves at least three times, found and collapsed to one period.

A run is a stretch of words with smallest period q, at least max(24, 3 q) words long, that no neighbouring word extends. Words q apart are
equal in length - q places in a row, so every run of period q holds a place of the grid with half that spacing. The grids of all
periods together have about n log n places (a harmonic sum). Where words q apart are equal at a grid place, longest common extensions
(LCE) to both sides give the ends of the stretch.

`Extensions` answers LCE queries for many pairs at once. Only suffixes that start at places of a difference cover modulo COVER are
sorted: by the rank of their next COVER words, then by prefix doubling along each residue class. For any two places there is an
offset below COVER that brings both into the cover: that many words are compared, and the rest of the answer is a range minimum over
the common prefixes of neighbours in sorted order, from a sparse table. Extensions to the left use the same on the reversed words.

Texts are split at bytes 9 to 13 and 32, words compared exactly. Documents are handled in chunks of bounded size inside a task, so that numpy works on
many short ones at once; there is no shuffle. NULL texts count as empty: no words, no run. Repeated rows and NULL doc_ids are
documents of their own; extra columns take no part; an empty table gives an empty one. Very long documents are a chunk of their own,
and their pairs are looked at in pieces of bounded size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked

COVER = 13
RESIDUES = (0, 1, 3, 9)  # each difference modulo 13 is one of two of these
LEAST, TIMES = 24, 3     # a run has at least so many words, and so many periods
LOOK = 4                 # words compared at a grid place before it counts
PAIRS = 1 << 18          # pairs of places extended at once

RUNS = "doc_id bigint, words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed binary"

#: offset that brings residues a and b into the cover together
_OFFSET = np.array(
    [[next(d for d in range(COVER) if (a + d) % COVER in RESIDUES and (b + d) % COVER in RESIDUES) for b in range(COVER)] for a in range(COVER)]
)


def needed(period: int, least: int = LEAST, times: int = TIMES) -> int:
    """Places in a row where words one period apart are equal, in the shortest run."""
    return max(least, times * period) - period


class Extensions:
    """Longest common extensions to the right over words 1, 2, ...; beyond the end nothing is equal."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate((words, np.zeros(2 * COVER, words.dtype)))
        rows = [np.arange(r, n, COVER) for r in RESIDUES]
        at = np.concatenate(rows)
        self.place = np.full(n + COVER, -1)
        self.place[at] = np.arange(len(at))
        # the sample COVER words on, or one past the last sample at the end of a residue class
        follow = np.arange(1, len(at) + 1)
        follow[np.cumsum([len(r) for r in rows])[[len(r) > 0 for r in rows]] - 1] = len(at)
        levels = [self._blocks(at)]
        while len(at) and levels[-1].max() < len(at):
            rank = np.append(levels[-1], 0)
            levels.append(np.unique(rank[:-1] * (len(at) + 1) + rank[follow], return_inverse=True)[1] + 1)
            follow = np.append(follow, len(at))[follow]
        self.rank = levels[-1] - 1 if len(at) else np.empty(0, np.int64)
        order = at[np.argsort(self.rank)]
        self.table = [self._neighbours(order, levels)]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            low, width = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(low[:-width], low[width:]))

    def _blocks(self, at: np.ndarray) -> np.ndarray:
        """Rank, from 1, of the COVER words from each place on."""
        columns = [self.words[at + d] for d in range(COVER)]
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(at), bool)
        for column in columns:
            new[1:] |= column[order][1:] != column[order][:-1]
        out = np.empty(len(at), np.int64)
        out[order] = np.cumsum(new) + 1
        return out

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that suffixes next to one another in sorted order have in common, by the ranks of each doubling."""
        a, b = order[:-1], order[1:]
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            rank = np.append(levels[k], 0)
            x, y = (np.where(p + common < len(self.place), self.place[np.minimum(p + common, len(self.place) - 1)], -1) for p in (a, b))
            same = (x >= 0) & (y >= 0) & (rank[x] == rank[y])
            common += np.where(same, COVER << k, 0)
        return common + self._compared(a + common, b + common, np.full(len(a), COVER))

    def _compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from a and b on, at most `most` (COVER or less) of them."""
        equal = np.zeros(len(a), np.int64)
        alive = np.arange(len(a))
        for d in range(COVER):
            x, y = self.words[a[alive] + d], self.words[b[alive] + d]
            alive = alive[(x == y) & (x > 0) & (d < most[alive])]
            if not len(alive):
                break
            equal[alive] += 1
        return equal

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from places a and b on (a != b, neither beyond the end)."""
        offset = _OFFSET[a % COVER, b % COVER]
        out = self._compared(a, b, offset)
        on = np.flatnonzero(out == offset)
        x, y = a[on] + offset[on], b[on] + offset[on]
        inside = np.maximum(x, y) < len(self.words) - 2 * COVER
        on, x, y = on[inside], x[inside], y[inside]
        x, y = self.rank[self.place[x]], self.rank[self.place[y]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.log2(high - low).astype(np.int64)
        for k in np.unique(level):
            here = level == k
            out[on[here]] += np.minimum(self.table[k][low[here]], self.table[k][high[here] - (1 << k)])
        return out


def _candidates(words: np.ndarray, doc: np.ndarray, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) where LOOK words from a grid place on equal those one period on, some thousands at a time.

    Texts stand by falling size, so that those long enough for a period come first.
    """
    held: list[np.ndarray] = []
    periods: list[int] = []
    pairs = 0
    ends = np.cumsum(sizes + 1)
    longest = int(sizes.max(initial=0)) // times
    enough = np.searchsorted(-sizes, -np.maximum(least, times * np.arange(longest + 1)), "right")
    steps = [max(1, needed(p, least, times) // 2) for p in range(longest + 1)]
    look = min(LOOK, *steps[1:]) if longest else LOOK

    def looked_at() -> tuple[np.ndarray, np.ndarray]:
        at, period = np.concatenate(held), np.repeat(periods, [len(h) for h in held])
        alive = doc[at] == doc[at + period]
        for d in range(look):
            at, period = at[alive], period[alive]
            alive = words[at + d] == words[np.minimum(at + d + period, len(words) - 1)]
        return at[alive], period[alive]

    for period in range(1, longest + 1):
        step = steps[period]
        end = int(ends[enough[period] - 1])
        held.append(np.flatnonzero(words[: end - period : step] == words[period:end:step]) * step)
        periods.append(period)
        pairs += len(held[-1])
        if pairs >= PAIRS or period == longest:
            yield looked_at()
            held, periods, pairs = [], [], 0


def find_runs(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, in that order. texts: the words of each text as numbers from 1."""
    none = np.empty(0, np.int64)
    keep = sorted((i for i, t in enumerate(texts) if len(t) >= least), key=lambda i: -len(texts[i]))
    if not keep:
        return none, none, none, none
    # behind each text stands a word of its own that is found nowhere else
    top = max(int(texts[i].max()) for i in keep)
    parts = [part for k, i in enumerate(keep) for part in (texts[i], [top + 1 + k])]
    words = np.concatenate(parts).astype(np.int32)
    sizes = np.array([len(texts[i]) for i in keep])
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    doc = np.repeat(np.arange(len(keep)), sizes + 1)
    found = np.empty((0, 3), np.int64)
    sides: tuple[Extensions, Extensions] | None = None
    moved = first
    for at, period in _candidates(words, doc, sizes, least, times):
        if not len(at):
            continue
        if sides is None or not np.all(used[doc[at]]):
            # extensions are prepared for texts with candidates only
            used = np.zeros(len(keep), bool) if sides is None else used
            used[doc[at]] = True
            mine = words[used[doc]]
            moved = np.concatenate(([0], np.cumsum(np.where(used, sizes + 1, 0))))
            sides = Extensions(mine), Extensions(mine[::-1])
        here = at - first[doc[at]] + moved[doc[at]]
        last = moved[-1] - 1
        right = sides[0].common(here, here + period)
        left = sides[1].common(last - here, last - here - period) - 1  # the place itself counts on the right
        long = left + right >= np.array([needed(p, least, times) for p in range(int(period.max()) + 1)])[period]
        start = (at - left)[long]
        more = np.column_stack((start, (left + right + period)[long], period[long]))
        found = np.unique(np.concatenate((found, more)), axis=0)
        # a stretch found with several periods counts with the smallest, which comes first
        found = found[np.concatenate(([True], np.any(found[1:, :2] != found[:-1, :2], axis=1)))] if len(found) else found
    of = doc[found[:, 0]]
    text, start = np.array(keep)[of], found[:, 0] - first[of]
    order = np.lexsort((found[:, 2], start, text))
    return text[order], start[order], found[order, 1], found[order, 2]


def kept_words(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Marks of the words that stay: all but those that a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) == 0


def periodic_words(n: int, code: int) -> np.ndarray | None:
    """Which word stands at each place once the tail of a text repeats itself, as `code` says; None where it doesn't."""
    if code % 10 or not n:
        return None
    rest = code // 10
    begin = rest % n
    period = 1 + (n - begin) // (3 + rest % 8)
    place = np.arange(n)
    return np.where(place < begin, place, begin + (place - begin) % period)


def collapsed_runs(docs: DataFrame, code: str | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, words, starts, lengths, periods, collapsed) of documents (doc_id, text): all runs and the text without their repeats.

    `code`: SQL for a number per document; those it is given for are made periodic first, as `periodic_words` says.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin, raws in chunked(batch["text"]):
                part = batch.iloc[begin : begin + len(raws)]
                known = defaultdict(count(1).__next__)
                split, numbers = [], []
                for raw, value in zip(raws, part["code"]):
                    words = raw.split()
                    number = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                    order = None if pd.isna(value) else periodic_words(len(words), int(value))
                    if order is not None:
                        words, number = [words[i] for i in order], number[order]
                    split.append(words)
                    numbers.append(number)
                text, start, length, period = find_runs(numbers, least, times)
                edge = np.searchsorted(text, np.arange(len(raws) + 1))
                rows = []
                for i, (doc, words) in enumerate(zip(part["doc_id"], split)):
                    own = slice(edge[i], edge[i + 1])
                    if edge[i] < edge[i + 1]:
                        words = [words[k] for k in np.flatnonzero(kept_words(len(words), start[own], length[own], period[own]))]
                    rows.append((doc, len(split[i]), start[own], length[own], period[own], b" ".join(words)))
                out = pd.DataFrame(rows, columns=["doc_id", "words", "starts", "lengths", "periods", "collapsed"])
                yield out.astype({"doc_id": "Int64"})

    number = F.expr(code).cast("bigint") if code else F.lit(None).cast("bigint")
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), number.alias("code")).mapInPandas(run, RUNS)


def report(docs: DataFrame) -> DataFrame:
    """Digests of all runs per document, and the run that repeats itself most often."""
    rows = collapsed_runs(docs, "crc32(coalesce(string(doc_id), ''))")
    runs = rows.withColumn("runs", F.expr("arrays_zip(starts, lengths, periods)"))
    # length / period is exact enough: different quotients of numbers below 2**26 are different doubles
    order = "transform(runs, r -> struct(-(r.lengths / r.periods) AS o, r.starts AS start, r.periods AS period, r.lengths AS length))"
    best = runs.withColumn("best", F.expr(f"array_min({order})"))
    lines = "transform(runs, r -> concat(r.starts, ',', r.lengths, ',', r.periods, '\\n'))"
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join({lines}, '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
