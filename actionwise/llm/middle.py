"""Fill-in-the-middle: documents cut into prefix, middle and suffix at line ends, and the parts put into the order a model learns.

A text becomes one bytearray: prefix, middle and suffix behind one another, a sentinel in front of each. An order is reached by
exchanging neighbouring blocks in place, by three reversals: of the first block, of the second, of both together. Reversals swap pieces
of fixed size, so that a text needs no second copy. The same exchange with the sizes swapped undoes it, and the text is there again.

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text itself: empty texts, texts that hold a sentinel, and those that the rate leaves out

Cuts and form depend on the doc_id alone (sha256 of ``seed:doc_id``). Texts are handled as UTF-8 bytes; a sentinel can't stand in
pieces of text and sentinel together, as only its first letter is '<'. NULL texts count as empty, a NULL doc_id as no digits; repeated rows are
transformed each on its own, alike; extra columns take no part; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"  # fixed values: the sentinels
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
MARK = len(PREFIX)
PIECE = 1 << 16  # bytes swapped at once

TRANSFORMED = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"


def reverse(buffer: np.ndarray, begin: int, end: int) -> None:
    """Reverse bytes [begin, end) in place, from both ends inwards."""
    while end - begin > 1:
        size = min(PIECE, (end - begin) // 2)
        left = buffer[begin : begin + size].copy()
        buffer[begin : begin + size] = buffer[end - size : end][::-1]
        buffer[end - size : end] = left[::-1]
        begin, end = begin + size, end - size


def exchange(buffer: np.ndarray, begin: int, cut: int, end: int) -> None:
    """Exchange the neighbouring blocks [begin, cut) and [cut, end)."""
    reverse(buffer, begin, cut)
    reverse(buffer, cut, end)
    reverse(buffer, begin, end)


def chars(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: all but the continuation bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def line_ends(raw: bytes) -> np.ndarray:
    """Where the lines of a text end; each line holds its line feed, the last one may have none."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return ends if not raw or raw[-1] == 10 else np.append(ends, len(raw))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def transform(raw: bytes, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, code points of the prefix, of the middle, output) of one text."""
    ends = line_ends(raw)
    n = len(ends)
    first, second, chance, kind = draws(doc_id, seed)
    if not raw or any(s in raw for s in SENTINELS) or chance % 100 >= rate:
        return n, "plain", None, None, raw
    low, high = sorted((first % (n + 1), second % (n + 1)))
    cut, stop = (int(ends[k - 1]) if k else 0 for k in (low, high))
    buffer = bytearray(raw)
    for at, mark in ((stop, SUFFIX), (cut, MIDDLE), (0, PREFIX)):  # from behind: earlier cuts keep their places
        buffer[at:at] = mark
    cut, stop = cut + MARK, stop + 2 * MARK
    view = np.frombuffer(buffer, np.uint8)
    sizes = chars(view[MARK:cut]), chars(view[cut + MARK : stop])
    form = "spm" if kind % 100 < spm else "psm"
    exchange(view, 0 if form == "spm" else cut, stop, len(view))
    return n, form, *sizes, bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made from."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    prefix, suffix, middle = (buffer.index(s) for s in SENTINELS)
    view = np.frombuffer(buffer, np.uint8)
    if form == "psm":
        size = middle - suffix
        exchange(view, suffix, middle, len(view))
        marks = (len(view) - size, suffix, 0)
    else:
        size = prefix - suffix
        exchange(view, 0, size, len(view))
        marks = (len(view) - size, middle - size, 0)
    del view  # a bytearray in use can't shrink
    for at in marks:
        del buffer[at : at + MARK]
    return bytes(buffer)


def filled_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of documents (doc_id, text): output as UTF-8 bytes.

    `rate` percent of the documents are transformed, `spm` percent of these with the suffix first.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            rows = [(i, *transform(t or b"", i, seed, rate, spm)) for i, t in zip(ids, batch["text"])]
            made = pd.DataFrame(rows, columns=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
            yield made.astype({"doc_id": "Int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInPandas(run, TRANSFORMED)


def restored(outputs: DataFrame) -> DataFrame:
    """The same rows with `text`, rebuilt from output and form alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [restore(o, f) for o, f in zip(batch["output"], batch["form"])]
            yield batch.assign(text=texts).astype({"doc_id": "Int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return outputs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").mapInPandas(run, f"{TRANSFORMED}, text binary")


def report(docs: DataFrame) -> DataFrame:
    """What the transformation made of each document, and that it can be undone: digests of output and rebuilt text."""
    rows = restored(filled_in_middle(docs))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )


def report_sql() -> str:
    """DuckDB SQL for `report`, from substrings."""
    draw = ", ".join(f"CAST('0x' || substr(digest, {1 + 8 * k}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
drawn AS (
  SELECT doc_id, text, {draw}, string_split(text, chr(10)) AS pieces,
    CASE WHEN text = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), '')) + CASE WHEN right(text, 1) = chr(10) THEN 0 ELSE 1 END END AS n
  FROM texts),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
sizes AS (
  SELECT *, least(length(array_to_string(pieces[1:low], chr(10))) + CASE WHEN low > 0 THEN 1 ELSE 0 END, length(text)) AS cut,
    least(length(array_to_string(pieces[1:high], chr(10))) + CASE WHEN high > 0 THEN 1 ELSE 0 END, length(text)) AS stop FROM cuts),
parts AS (
  SELECT *, substr(text, 1, cut) AS p, substr(text, cut + 1, stop - cut) AS m, substr(text, stop + 1) AS s FROM sizes)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(cut AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(stop - cut AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""
