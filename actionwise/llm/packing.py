"""Best-fit packing of tokenised documents into sequences of fixed capacity, by linear grouping.

How documents are packed depends on their lengths alone, and there are no more lengths than tokens in a sequence. So the packing is planned
on the driver from one count per length, whatever the size of the corpus, and written down as runs: `items` pieces of one length,
in the order of their numbers, go into consecutive sequences, `each` to a sequence, at a given offset. Runs are few (bounded by
lengths and configurations); Spark numbers the pieces of each length and looks their run up.

The plan:

1. Pieces that fill a sequence take one each. Pieces over capacity / LARGE are large.
2. Large pieces, by falling length, are cut into GROUPS groups of equally many pieces; a group's lengths are rounded up to its largest.
3. Few sizes are left, and their best configurations (how many of each size share a sequence) come from a linear programme with one
   column per useful configuration, found as they are needed by a knapsack over the dual prices. Its solution is rounded down, the
   pieces over are placed like small ones.
4. The places of a configuration are filled with real pieces, the longest of each size; the last place takes the longest piece that fits.
5. Small pieces, longest first, go where the least room is left that takes them; new sequences are opened when none does.

NULL texts count as empty: a piece with the end id alone. Repeated rows and NULL doc_ids are documents of their own; extra columns
take no part; an empty table gives an empty one. Only documents longer than a sequence are cut, the first piece being the shorter one.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pandas as pd
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import CHUNK_BYTES

CAPACITY = 2048
END = 0
LARGE = 4           # large pieces are longer than capacity / LARGE
GROUPS = 64
WORDS_KEPT = 800_000  # words a Python worker remembers the ids of
ROUNDS = 2000       # configurations looked for at most; fewer are only a worse start for the small pieces

PIECES = "task int, doc_id bigint, piece int, start bigint, length int, nth bigint, ids_crc32 bigint, ids binary"
RUNS = "length int, first bigint, items bigint, sequence bigint, each bigint, offset bigint"


# --- tokens


# fixed values: how byte-level tokenizers cut texts, and what may stand in texts of ASCII and Latin letters with accents
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")


class Words:
    """Token ids of texts, with a table of the words seen.

    A byte-level tokenizer that cuts its texts by its usual pattern always cuts before a blank, and around a line feed, between two
    other characters. So words are tokenised one by one, with the blank or line feed before them, and each only once. Texts with other
    white space, and those of other tokenizers, are tokenised whole.

    New plain words are merged by rank, all of a chunk of texts at once, which is much faster than the tokenizer and the same for a
    vocabulary as `by_rank` asks for. All others go to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        cut = rules["pre_tokenizer"] or {}
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        by_words = self.tokenizer.normalizer is None and all(cut.get(k) == v for k, v in usual.items())
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None
        self.merge, self.bytes_of = by_rank(rules["model"], self.tokenizer.model) if by_words else (None, None)
        self.forget()

    def forget(self) -> None:
        # number of a word -> where its ids stand, and how many: -1 for what can't stand alone, as no word between two blanks
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.number[""], self.number["\n"]
        self.first, self.many = np.zeros(2, np.int64), np.array([-1, -1])
        self.ids = np.empty(0, np.uint32)

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.merge:
            return list(map(self.whole, texts))
        if len(self.number) > WORDS_KEPT:
            self.forget()
        # a line feed stays with the word behind it, the others have a blank before them; a text begins as if behind a line feed
        split = [("\n" + t.replace("\n", " \n")).split(" ") for t in texts]
        place = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        if new := len(self.number) - len(self.many):
            self.learn(list(islice(reversed(self.number), new))[::-1])
        many = self.many[place]
        ends = np.cumsum(np.maximum(many, 0))
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.first[place] - ends + many, np.maximum(many, 0))]
        words = np.cumsum([len(w) for w in split])
        odd = np.logical_or.reduceat(many < 0, np.concatenate(([0], words[:-1])))
        edges = np.concatenate(([0], ends[words - 1]))
        # the line feed at the beginning is a token of its own
        return [self.whole(t) if o else ids[a + 1 : b] for t, o, a, b in zip(texts, odd, edges, edges[1:])]

    def learn(self, new: list[str]) -> None:
        """Tokenise new words, those after the numbers known."""
        at = np.arange(len(new))
        odd = [] if self.is_plain("".join(new)) else [k for k, w in enumerate(new) if not self.is_plain(w)]
        plain = np.delete(at, odd)
        # each word begins with its blank or line feed, and holds no other
        text = (" " + " ".join([new[k] for k in plain] if odd else new)).replace(" \n", "\n") if len(plain) else ""
        raw = np.frombuffer(text.encode(), np.uint8)
        starts = np.flatnonzero((raw == 32) | (raw == 10))
        ids = self.merge(text)
        begins = np.cumsum(self.bytes_of[ids]) - self.bytes_of[ids]
        first = np.searchsorted(begins, np.append(starts, len(raw)))
        many, where = np.full(len(new), -1), np.zeros(len(new), np.int64)
        many[plain], where[plain] = np.diff(first), first[:-1] + len(self.ids)
        self.ids = np.concatenate((self.ids, ids))
        for k in odd:
            word = new[k]
            bare = word[word[:1] == "\n" :]
            if bare.split() == [bare]:
                ids = self.whole(word if len(bare) < len(word) else " " + word)
                many[k], where[k] = len(ids), len(self.ids)
                self.ids = np.concatenate((self.ids, ids))
        self.first, self.many = np.concatenate((self.first, where)), np.concatenate((self.many, many))

    def is_plain(self, text: str) -> bool:
        return bool(PLAIN.fullmatch(text)) and not (self.special and self.special.search(text))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def by_rank(rules: dict, model) -> tuple[Callable[[str], np.ndarray] | None, np.ndarray | None]:
    """(ids of a text by merging the two neighbours first whose token is oldest, bytes of each token); None where that may differ from the rules.

    It can't differ if each rule makes a token of its own, younger than those before, and each token, tokenised alone, comes out whole: as
    long as nothing is merged across its borders, a token's text goes through the same states as alone, and the last of them is its rule's pair.
    """
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    if rules.get("type") != "BPE" or rules.get("dropout") or rules.get("continuing_subword_prefix") or rules.get("end_of_word_suffix"):
        return None, None
    letters = sorted(ByteLevel.alphabet(), key=lambda c: (not c.isascii(), c))
    codes = {c: ord(c) for c in letters if 33 <= ord(c) <= 126 or 0xA1 <= ord(c) <= 0xFF}
    rest = iter(b for b in range(256) if b not in codes.values())
    codes |= {c: next(rest) for c in sorted(set(letters) - set(codes))}  # bytes without a letter of their own have the next free ones
    vocabulary, merges = rules["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in rules["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in merges]
    single = {c: i for c, i in vocabulary.items() if len(c) == 1}
    whole = len(single) == 256 and len(single) + len(made) == len(vocabulary) and max(single.values()) < min(made, default=256)
    if not whole or any(x >= y for x, y in zip(made, made[1:])) or any(len(model.tokenize(a + b)) != 1 for a, b in merges):
        return None, None
    ranks = {bytes(codes[c] for c in token): i for token, i in vocabulary.items()}
    bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        bytes_of[i] = len(token)
    ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ranked.encode_to_numpy, bytes_of


def parted(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about CHUNK_BYTES characters together."""
    begin = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK_BYTES:
            yield texts[begin : k + 1]
            begin, size = k + 1, 0
    if begin < len(texts):
        yield texts[begin:]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    """The table of this Python worker: later tasks find what earlier ones learned."""
    return Words(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Tokenised pieces of documents (doc_id, text); nth: number of the piece among those of its length in its task."""
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer)
    name = tokenizer.rsplit("/", 1)[-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, task = words_of(SparkFiles.get(name)), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch["text"]]
            for doc, ids in zip(batch["doc_id"], chain.from_iterable(map(known.texts, parted(texts)))):
                ids = np.append(ids, end).astype("<u4")
                edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    raw = ids[a:b].tobytes()
                    rows.append((task, doc, k, a, b - a, seen[b - a], zlib.crc32(raw), raw))
                    seen[b - a] += 1
            yield pd.DataFrame(rows, columns=["task", "doc_id", "piece", "start", "length", "nth", "ids_crc32", "ids"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, PIECES)


# --- the plan


def groups_of(counts: dict[int, int], groups: int = GROUPS) -> list[tuple[int, list[tuple[int, int]]]]:
    """(rounded size, [(length, pieces), ...]) of groups with equally many pieces, longest first."""
    total = sum(counts.values())
    size = -(-total // groups)
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                room = size
                out.append((length, []))
            take = min(left, room)
            out[-1][1].append((length, take))
            left, room = left - take, room - take
    return out


def _best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size to take for the highest sum of prices: a knapsack with one more piece in each step."""
    rooms = np.arange(capacity + 1)
    without = rooms - sizes[:, None]  # room left by a piece of each size
    value, chosen = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        gain = np.where(without >= 0, value[np.maximum(without, 0)] + prices[:, None], -1)
        best = gain.argmax(axis=0)
        better = gain[best, rooms] > value + 1e-12
        if not better.any():
            break
        chosen.append(np.where(better, best, -1))
        value = np.where(better, gain[best, rooms], value)
    out = np.zeros(len(sizes), np.int64)
    room = capacity
    for best in reversed(chosen):
        if best[room] >= 0:
            out[best[room]] += 1
            room -= sizes[best[room]]
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each, for the fewest sequences that hold `demand` pieces of each size.

    The basis starts with the configurations of one size. A round prices the sizes, looks for the configuration that is worth most, and
    exchanges it for the one that runs out first; it ends when none is worth more than a sequence.
    """
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    use = demand / np.diag(basis)
    inverse = np.diag(1 / np.diag(basis))
    for turn in range(ROUNDS):
        prices = np.maximum(inverse.sum(axis=0), 0)
        column = _best_configuration(sizes, prices, capacity)
        if prices @ column <= 1 + 1e-7:
            break
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        pivot = inverse[out] / step[out]
        use = use - ratio[out] * step
        use[out] = ratio[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
        basis[:, out] = column
        use = np.maximum(use, 0)
        if turn % 50 == 49:  # rounding errors don't pile up
            inverse = np.linalg.inv(basis)
            use = np.maximum(inverse @ demand, 0)
    return [(basis[:, k].round().astype(np.int64), float(use[k])) for k in range(n)]


class Plan:
    """Runs of pieces, and how much room is left in which sequences."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.used: dict[int, int] = defaultdict(int)  # pieces of a length that have a place
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, sequences)
        self.rooms: list[int] = []

    def new(self, many: int) -> int:
        self.sequences += many
        return self.sequences - many

    def put(self, length: int, many: int, sequence: int, each: int, offset: int) -> None:
        self.runs.append((length, self.used[length], many, sequence, each, offset))
        self.used[length] += many

    def leave(self, room: int, first: int, many: int) -> None:
        if room and many:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append((first, many))

    def fill(self, length: int, many: int) -> None:
        """Best fit: each piece goes where the least room is left that takes it, so one sequence is filled up before the next."""
        while many:
            at = bisect_left(self.rooms, length)
            if at < len(self.rooms):
                room = self.rooms[at]
                first, count = self.open[room].pop()
                if not self.open[room]:
                    del self.rooms[at]
            else:
                room, count = self.capacity, -(-many // (self.capacity // length))
                first = self.new(count)
            each = room // length
            full = min(count, many // each)
            if full:
                self.put(length, full * each, first, each, self.capacity - room)
                self.leave(room - each * length, first, full)
                many -= full * each
            if full < count:
                if many:  # fewer than `each` are left: one sequence takes them all
                    self.put(length, many, first + full, many, self.capacity - room)
                    self.leave(room - many * length, first + full, 1)
                    full, many = full + 1, 0
                self.leave(room, first + full, count - full)


def planned(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The packing of so many pieces of each length."""
    plan = Plan(capacity)
    counts = {int(k): int(v) for k, v in counts.items() if v}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError("a piece must have between one token and the capacity")
    if many := counts.pop(capacity, 0):
        plan.put(capacity, many, plan.new(many), 1, 0)
    large = {k: v for k, v in counts.items() if k > capacity // LARGE}
    if large:
        _place_large(plan, groups_of(large))
    for length in sorted((k for k in counts if k not in large), reverse=True):
        plan.fill(length, counts[length])
    return plan


def _place_large(plan: Plan, groups: list[tuple[int, list[tuple[int, int]]]]) -> None:
    """Configurations of rounded sizes with real pieces put in their places: the longest of each size.

    The last place of a configuration takes the longest piece of all that fits, so that rounding up leaves no room behind.
    """
    sizes = np.unique([size for size, _ in groups])
    left = np.zeros(plan.capacity + 1, np.int64)
    for _, members in groups:
        for length, n in members:
            left[length] += n
    row = np.searchsorted(sizes, np.arange(plan.capacity + 1))
    demand = np.bincount(row, left, minlength=len(sizes))[: len(sizes)]
    low = np.concatenate(([0], sizes[:-1]))

    def longest(above: int, upto: int) -> int:
        """The longest length in (above, upto] that has pieces left, or 0."""
        found = np.flatnonzero(left[above + 1 : upto + 1])
        return above + 1 + int(found[-1]) if len(found) else 0

    def use(config: np.ndarray, many: int) -> None:
        slots = [r for r in np.flatnonzero(config)[::-1] for _ in range(config[r])]
        while many:
            taken: list[int] = []
            for k, r in enumerate(slots):
                room = plan.capacity - sum(taken)
                length = longest(0, room) if 0 < k == len(slots) - 1 else longest(int(low[r]), int(sizes[r]))
                if not length:
                    break
                taken.append(length)
                left[length] -= 1
            for length in taken:  # taken one by one only to see which they are
                left[length] += 1
            if len(taken) < len(slots):
                return  # its pieces went to other configurations
            batch = int(min(many, *(left[length] // taken.count(length) for length in taken)))
            first, offset = plan.new(batch), 0
            for length in taken:
                plan.put(length, batch, first, 1, offset)
                left[length] -= batch
                offset += length
            plan.leave(plan.capacity - offset, first, batch)
            many -= batch

    found = configurations(sizes, demand.astype(float), plan.capacity)
    for config, times in sorted(found, key=lambda c: tuple(np.flatnonzero(c[0])[::-1]), reverse=True):
        use(config, int(times + 1e-6))
    for length in np.flatnonzero(left)[::-1]:  # what is left over, longest first
        plan.fill(int(length), int(left[length]))


# --- the operator


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of documents (doc_id, text); ids of 4 bytes each."""
    rows = stage(pieces(docs, tokenizer, capacity, end), "pieces")
    # one row per task and length: the numbers of a task's pieces follow those of the tasks before it
    counts = stage(rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("_before"))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    runs = docs.sparkSession.createDataFrame(planned({r["length"]: r["n"] for r in lengths}, capacity).runs, RUNS)
    numbered = rows.join(starts, ["task", "length"]).withColumn("_number", F.col("_before") + F.col("nth"))
    place = "_number >= first AND _number < first + items"
    found = numbered.join(F.broadcast(runs.withColumnRenamed("length", "_length")), F.expr(f"length = _length AND {place}"))
    return found.select(
        "doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "ids",
        F.expr("sequence + (_number - first) div each").alias("sequence_id"),
        F.expr("offset + (_number - first) % each * length").alias("offset"),
    )


def sequences(rows: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of packed pieces: the tokens of a sequence behind one another."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = rows.groupBy("sequence_id").agg(inside.alias("parts"), F.sum("length").alias("n_tokens"))
    return joined.select("sequence_id", "n_tokens", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    return packed(docs, tokenizer).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
