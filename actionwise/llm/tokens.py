"""Token-ID output: documents as token ids in a file format with range asymmetric numeral coding.

Writing: documents are cut into shards by rising doc_id and tokenised. One pass counts all ids; the counts give one static
frequency table, shared by all blocks (its size is bounded by the vocabulary). Blocks of whole documents are then coded on their
own, by many interleaved states that numpy moves together. A file set is a folder of Parquet files that Spark writes and
commits, so lost executors are no matter:

    <path>/table    symbol, frequency (out of 2**SCALE), start: the shared table
    <path>/blocks   seq (rises with doc_id over all blocks), doc_ids, tokens (per document), payload, words (of the payload
                    before each checkpoint), states (of the lanes at each checkpoint), crc (of payload, words and states)

Reading: blocks are independent, and inside a block decoding may start at any checkpoint. Each block's checksum is compared first.

NULL texts count as empty: such a document holds just the end id. Repeated doc_ids and NULL doc_ids (which come first) are documents of
their own. Extra columns take no part. Of an empty table, the file set holds no block.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import stage, staging_dir

END = 2
SCALE = 20             # frequencies add up to 2**SCALE
LOW = 1 << 31          # states stay in [LOW, LOW << 32)
LANES = 512            # interleaved states of a block
BLOCK_TOKENS = 1 << 16
CHECK_STEPS = 64       # steps of all lanes between checkpoints
WORDS_KEPT = 400_000   # words a Python worker remembers the ids of, and as many older ones

BLOCKS = "seq bigint, doc_ids array<bigint>, tokens array<bigint>, payload binary, words array<int>, states binary, crc bigint"


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


# fixed values: how the tokenizer file cuts words, and the same for PLAIN texts in lower case
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
CUTTING = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]+")
PLAIN = re.compile(r"[\t\n\r -~À-ÿ]*")


class WordIds(dict):
    """Ids of a word as little-endian text of 2 or 4 bytes each. Texts are cut at blanks and line feeds, where this tokenizer's tokens end too.

    Where the tokenizer cuts by PATTERN, texts of printable ASCII and Latin letters with accents are cut into pieces here, and only
    new pieces go to the tokenizer's model (`pieces`); other texts are cut into words, and new words go through the whole tokenizer. A
    full table becomes `older`, from which what is still in use comes back.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind, self.code = id_type(size), "H" if id_type(size) == "<u2" else "I"
        rules = json.loads(self.tokenizer.to_str())
        self.by_pieces = (rules["normalizer"], rules["pre_tokenizer"], rules.get("post_processor")) == (NORMALIZER, CUTTING, None)
        self.special = [t["content"] for t in rules["added_tokens"]]
        self.older: dict[str, bytes] = {}
        self.pieces = PieceIds(self.tokenizer.model, self.code) if self.by_pieces else None

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = packed(self.tokenizer.encode(word, add_special_tokens=False).ids, self.code) if word else b""
        return remembered(self, word, ids)

    def text(self, text: str) -> bytes:
        if self.by_pieces and PLAIN.fullmatch(text) and not any(t in text for t in self.special):
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


class PieceIds(dict):
    """Ids of a piece, from the tokenizer's model alone: it takes bytes as letters, as the tokenizer's last step before it does."""

    def __init__(self, model, code: str):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.model, self.code = model, code
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            found = self.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))
            ids = packed([t.id for t in found], self.code)
        return remembered(self, piece, ids)


def packed(ids: list[int], code: str) -> bytes:
    return struct.pack(f"<{len(ids)}{code}", *ids)


def remembered(table: WordIds | PieceIds, word: str, ids: bytes) -> bytes:
    if len(table) >= WORDS_KEPT:
        table.older = dict(table)
        table.clear()
    if len(word) <= 64:
        table[word] = ids
    return ids


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The table of this Python worker: later tasks find what earlier ones learned."""
    return WordIds(path)


def tokenised(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """(doc_id, ids, wide): ids with the end id as little-endian numbers, of 4 bytes if `wide`, else of 2."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = word_ids(tokenizer)
        last = np.array([end], known.kind).tobytes()
        for batch in batches:
            ids = [known.text(t if isinstance(t, str) else "") + last for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids, "wide": known.kind == "<u4"})

    return docs.select("doc_id", "text").mapInPandas(encode, "doc_id bigint, ids binary, wide boolean")


def numbers(raw: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if wide else "<u2")


@dataclass
class Table:
    """The shared frequency table, by rising symbol."""

    symbol: np.ndarray
    frequency: np.ndarray
    start: np.ndarray
    place: np.ndarray  # of each id up to the largest

    @classmethod
    def of(cls, rows: pd.DataFrame) -> Table:
        rows = rows.sort_values("symbol")
        symbol, frequency, start = (rows[c].to_numpy(np.uint64) for c in ("symbol", "frequency", "start"))
        place = np.zeros(int(symbol.max(initial=0)) + 1, np.int32)
        place[symbol.astype(np.int64)] = np.arange(len(symbol))
        return cls(symbol, frequency, start, place)

    def slots(self) -> np.ndarray:
        """Place in the table of each of the 2**SCALE slots."""
        return np.repeat(np.arange(len(self.symbol), dtype=np.int32), self.frequency.astype(np.int64))


def frequency_table(counts: pd.DataFrame) -> pd.DataFrame:
    """Counts (symbol, n) scaled to 2**SCALE with at least 1 each."""
    counts = counts.sort_values("symbol").reset_index(drop=True)
    n = counts["n"].to_numpy(float)
    room = (1 << SCALE) - len(n)
    if room < 0:
        raise ValueError("more symbols than slots")
    share = np.floor(n / max(n.sum(), 1) * room).astype(np.int64) + 1
    if len(n):
        share[n.argmax()] += (1 << SCALE) - share.sum()
    return pd.DataFrame({"symbol": counts["symbol"], "frequency": share, "start": np.cumsum(share) - share})


def encode_block(ids: np.ndarray, table: Table) -> tuple[bytes, list[int], bytes]:
    """(payload, words, states). Lane k codes ids k, k + LANES, ...; the payload is read forwards when decoding.

    Coding runs from the last step to the first, as the states form a stack. `words` holds how many words come before each checkpoint.
    """
    at = table.place[ids]
    freq, start = table.frequency[at], table.start[at]
    steps = -(-len(ids) // LANES)
    state = np.full(LANES, LOW, np.uint64)
    out: list[np.ndarray] = []
    marks, states, written = [], [], 0
    for step in range(steps - 1, -1, -1):
        f, s = freq[step * LANES : (step + 1) * LANES], start[step * LANES : (step + 1) * LANES]
        x = state[: len(f)]
        full = x >= np.uint64((LOW >> SCALE) << 32) * f
        if full.any():
            out.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            written += len(out[-1])
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(f)] = (q << np.uint64(SCALE)) + (x - q * f) + s
        if step % CHECK_STEPS == 0:
            marks.append(written)
            states.append(state.copy())
    payload = np.concatenate(out[::-1]).tobytes() if out else b""
    return payload, [written - m for m in marks[::-1]], np.concatenate([s.astype("<u8") for s in states[::-1]]).tobytes()


def decode_block(payload: bytes, words: Sequence[int], states: bytes, count: int, table: Table, slots: np.ndarray, first: int = 0) -> np.ndarray:
    """Ids of a block from its checkpoint `first` on; the first checkpoint is the block's beginning."""
    data = np.frombuffer(payload, "<u4").astype(np.uint64)
    state = np.frombuffer(states, "<u8").reshape(-1, LANES)[first].copy()
    at = int(words[first])
    begin = first * CHECK_STEPS * LANES
    out = np.empty(count - begin, np.int64)
    mask = np.uint64((1 << SCALE) - 1)
    for i in range(0, count - begin, LANES):
        x = state[: min(LANES, count - begin - i)]
        low = x & mask
        entry = slots[low.astype(np.int64)]
        out[i : i + len(x)] = entry
        x = table.frequency[entry] * (x >> np.uint64(SCALE)) + low - table.start[entry]
        few = np.flatnonzero(x < np.uint64(LOW))
        x[few] = (x[few] << np.uint64(32)) | data[at : at + len(few)]
        at += len(few)
        state[: len(x)] = x
    return table.symbol[out].astype("<u4")


def checksum(payload: bytes, words: Sequence[int], states: bytes) -> int:
    return zlib.crc32(states, zlib.crc32(np.asarray(words, "<u4").tobytes(), zlib.crc32(payload)))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Write documents (doc_id, text) in rising doc_id order as a file set below `path`."""
    placed = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    placed = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ids = stage(tokenised(placed, tokenizer, end).withColumn("seq", F.monotonically_increasing_id()), "token_ids")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for raw, wide in zip(batch["ids"], batch["wide"]):
                part = np.bincount(numbers(raw, wide))
                if len(part) > len(total):
                    total = np.append(total, np.zeros(len(part) - len(total), np.int64))
                total[: len(part)] += part
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"symbol": seen, "n": total[seen]})

    counted = ids.select("ids", "wide").mapInPandas(count, "symbol bigint, n bigint").groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    rows = frequency_table(counted)
    spark = docs.sparkSession
    spark.createDataFrame(rows, "symbol bigint, frequency bigint, start bigint").coalesce(1).write.parquet(f"{path}/table")
    table = Table.of(rows)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size, last = 0, -1

        def packed() -> pd.DataFrame:
            coded = encode_block(np.concatenate([r[2] for r in held]), table)
            row = {"seq": held[0][0], "doc_ids": [r[1] for r in held], "tokens": [len(r[2]) for r in held]}
            return pd.DataFrame([row | dict(zip(("payload", "words", "states"), coded)) | {"crc": checksum(*coded)}])

        for batch in batches:
            for seq, doc, raw, wide in zip(batch["seq"], batch["doc_id"], batch["ids"], batch["wide"]):
                ids = numbers(raw, wide)
                if held and (seq != last + 1 or size + len(ids) > BLOCK_TOKENS):
                    yield packed()
                    held, size = [], 0
                held.append((seq, None if pd.isna(doc) else int(doc), ids))
                size, last = size + len(ids), seq
        if held:
            yield packed()

    # a task may read any part of a staged file: a block ends where the numbers of its documents don't go on
    ids.mapInPandas(encode, BLOCKS).write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(seq, place, doc_id, ids) of a file set, ids with 4 bytes each; a wrong checksum is an error."""
    table = Table.of(spark.read.parquet(f"{path}/table").toPandas())

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = table.slots()
        for batch in batches:
            for row in batch.itertuples():
                if checksum(row.payload, row.words, row.states) != row.crc:
                    raise ValueError(f"block {row.seq}: wrong checksum")
                ends = np.cumsum(row.tokens)
                ids = decode_block(row.payload, row.words, row.states, int(ends[-1]), table, slots)
                docs = pd.array([None if d is None or d != d else int(d) for d in row.doc_ids], "Int64")
                parts = [ids[b:e].tobytes() for b, e in zip(ends - row.tokens, ends)]
                yield pd.DataFrame({"seq": row.seq, "place": np.arange(len(ends)), "doc_id": docs, "ids": parts})

    return spark.read.parquet(f"{path}/blocks").mapInPandas(decode, "seq bigint, place int, doc_id bigint, ids binary")


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, read back from the files.

    Starts are summed up per shard (a range of doc_ids, one row each), then per block of a shard, then inside a block.
    """
    digests = read_token_files(spark, path).select(
        "seq", "place", "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    blocks = spark.read.parquet(f"{path}/blocks").select("seq", F.expr("shiftright(seq, 33)").alias("shard"), F.expr("aggregate(tokens, 0L, (a, x) -> a + x)").alias("n"))
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    total = lambda *by, over, n: F.coalesce(F.sum(n).over(Window.partitionBy(*by).orderBy(over).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", total(over="shard", n="n").alias("shard_start"))
    starts = blocks.withColumn("block_start", total("shard", over="seq", n="n")).join(shards, "shard")
    starts = starts.select("seq", (F.col("shard_start") + F.col("block_start")).alias("at"))
    inside = digests.withColumn("inner", total("seq", over="place", n="n_tokens"))
    return inside.join(starts, "seq").select("doc_id", (F.col("at") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def written_report(docs: DataFrame, tokenizer: str, name: str = "token_files") -> DataFrame:
    """Write documents to a new file set in the shared folder and report on what is read back."""
    import uuid

    path = f"{staging_dir(docs.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer)
    return token_report(docs.sparkSession, path)
