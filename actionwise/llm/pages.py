"""Main text of web pages by nearest-URL page differencing.

A page becomes lines, one per block of its markup. Pages of a host are put in the order of their URL paths, and each is paired with the next
page before and behind it. Lines of a pair are aligned by their longest common subsequence; lines that both share belong to
the site rather than the article, and go. So do blocks that the markup itself names as no part of an article: navigation, headers and
footers, asides, forms, adverts, notices, comments, scripts and styles.

If a page marks its article (article, main, or a role or property that says so), the mark breaks ties: a line inside it goes only if both neighbours
share it, as an article may well quote a passage that its neighbour quotes too, and lines outside it stay only if a neighbour was there to compare. Where
a neighbour shares most of the article, the pair are versions of one and no line of the article goes for it. Class and id names never drop the only article
of a page or nearly all of its text.

NULL and empty pages have an empty text. Pages without a URL are a host of their own. Repeated rows are pages of their own. Extra columns take no part.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import has_columns

MOST_SHARED = 0.8   # share of unmarked text from which a pair counts as versions of one article

# fixed values: elements by their meaning in HTML
DROPPED = frozenset("script style template noscript svg math iframe object embed canvas audio video map select datalist textarea button head title".split())
ASIDE = frozenset("nav footer aside form header dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend", "summary"}
# fixed values: class and id names of what is no article. Some words tell as any part of a name, some as its end, some only alone
ANY_PART = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion breadcrumb breadcrumbs widget cookie cookies consent gdpr popup "
    "newsletter subscribe signup comment comments disqus reply replies respond share sharing related recommended recommendations pagination pager "
    "copyright masthead topbar".split()
)
LAST_PART = frozenset("nav navbar navigation menu sidebar aside footer foot header banner toolbar notice notices alert modal overlay login social".split())
ALONE = frozenset("form legal side more meta tags skip search hidden".split())
NEGATING = frozenset("no not non without has with hide is open closed enabled disabled".split())
SURE = frozenset("comment comments disqus reply replies respond".split())  # those of ANY_PART that mean the same in any name
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)|=)*+)>", re.DOTALL
)  # a quote opens a value only right after =
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
GAPS = re.compile(r"\s+")


def noise_name(names: str) -> int:
    """Whether class or id names mark what is no article: 2 if they do, 1 if only a part before the last does (share-price), 0 if not."""
    sure = 0
    for name in names.lower().split():
        parts = re.split("[_-]+", name)
        if name in ALONE or not NEGATING & set(parts) and (SURE & set(parts) or parts[-1] in ANY_PART | LAST_PART):
            return 2
        if not NEGATING & set(parts) and ANY_PART & set(parts):
            sure = 1
    return sure


def released(lines: Sequence[tuple[str, bool, bool, tuple[int, ...]]]) -> list[tuple[str, bool, bool]]:
    """Lines with (noise, marked), where names alone drop neither the article nor nearly all of the page or of the article.

    Named elements have numbers, negative ones where the name is not sure.
    """
    size: dict[int, int] = {}
    marked_size: dict[int, int] = {}
    holds_mark = set()
    total = in_mark = 0
    for text, hard, marked, named in lines:
        if not hard:
            total += len(text)
            for k in named:
                size[k] = size.get(k, 0) + len(text)
            if marked:
                holds_mark.update(named)
                in_mark += len(text)
                for k in named:
                    marked_size[k] = marked_size.get(k, 0) + len(text)
    if any(marked and not hard and not named for _, hard, marked, named in lines):
        # the article stands outside: a large block of comments is still no part of it, but one of an unsure name may be the article
        free = {k for k, n in marked_size.items() if k < 0 and n > MOST_SHARED * in_mark}
    else:
        free = {k for k, n in size.items() if n > (0.5 if k in holds_mark else MOST_SHARED) * total}
    if all(hard or set(named) - free for _, hard, _, named in lines):
        free = set(size)
    return [(text, hard or bool(set(named) - free), marked) for text, hard, marked, named in lines]


def page_lines(page: str) -> list[tuple[str, bool, bool]]:
    """(text, noise, marked) of each block, in page order: noise is no article by its markup, marked lies inside a marked article."""
    out: list[tuple[str, bool, bool, tuple[int, ...]]] = []
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = []
    parts: list[str] = []
    noise = marked = False
    named: tuple[int, ...] = ()  # numbers of the open elements that are noise by their name
    n_named = 0

    def close_line() -> None:
        if parts:
            text = GAPS.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append((text, noise, marked, named))
            parts.clear()

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            parts.append(page[at:])
            break
        parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                parts.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS:
                close_line()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    _, noise, marked, named = stack[k]
                    del stack[k:]
                    break
            continue
        if tag in RAW:
            end = RAW[tag].search(page, at)
            at = end.end() if end else size
            continue
        if tag in BLOCKS:
            close_line()
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):  # an open paragraph ends where a block begins
                if stack[k][0] == "p":
                    _, noise, marked, named = stack[k]
                    del stack[k:]
                    break
                if stack[k][0] in BLOCKS:
                    break
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    _, noise, marked, named = stack[k]
                    del stack[k:]
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "select", "tbody", "tr"):
                    break
        stack.append((tag, noise, marked, named))
        values = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in ATTRIBUTE.finditer(m[3])}
        role = values.get("role", "").lower()
        if tag in ("article", "main") or role in ("main", "article") or "articlebody" in values.get("itemprop", "").lower():
            marked = marked or not noise
        inner = tag == "header" and marked  # the heading of an article
        names = f"{values.get('class', '')} {values.get('id', '')}"
        if tag in DROPPED or tag in ASIDE and not inner or role in ROLES or "hidden" in values or values.get("aria-hidden") == "true":
            noise = True
        elif tag not in ("html", "body", "article", "main") and names != " " and (sure := noise_name(names)):
            n_named += 1
            named += (n_named if sure > 1 else -n_named,)
    close_line()
    return released(out)


def shared_lines(mine: Sequence, theirs: Sequence) -> list[bool]:
    """Which of my lines lie on the longest common subsequence with theirs (kept rows of bits, as many as lines)."""
    places: dict = {}
    for j, line in enumerate(theirs):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(theirs)) - 1
    row, rows = full, [full]
    for line in mine:  # the zero bits of a row are where its length of common subsequence steps up
        hit = places.get(line, 0) & row
        row = ((row + hit) | (row - hit)) & full if hit else row
        rows.append(row)
    out = [False] * len(mine)
    length = lambda r, j: j - (r & ((1 << j) - 1)).bit_count()
    i, j = len(mine), len(theirs)
    while i and j:
        here = length(rows[i], j)
        if not here:
            break
        if length(rows[i - 1], j) == here:
            i -= 1
        elif length(rows[i], j - 1) == here:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out[i] = True
    return out


def line_keys(lines: Sequence[tuple[str, bool, bool]]) -> list[int]:
    """A hash per line: what is differenced."""
    return [int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) for text, _, _ in lines]


def packed_lines(lines: Sequence[tuple[str, bool, bool]]) -> bytes:
    """Lines in few bytes, without the texts of those that are noise: a line holds no line feed."""
    marks = "".join(str(noise + 2 * marked) for _, noise, marked in lines)
    return zlib.compress("\n".join([marks, *("" if noise else text for text, noise, _ in lines)]).encode("utf-8", "surrogatepass"))


def unpacked_lines(packed: bytes) -> list[tuple[str, bool, bool]]:
    marks, *texts = zlib.decompress(packed).decode("utf-8", "surrogatepass").split("\n")
    return [(text, mark in "13", mark in "23") for mark, text in zip(marks, texts)]


def own_lines(lines: Sequence[tuple[str, bool, bool]], others: Sequence[Sequence[int] | None], mine: Sequence[int] | None = None) -> list[int]:
    """Places of the lines that are no noise and belong to the page rather than the site. `mine` are the lines' keys, where they are known."""
    mine, others = line_keys(lines) if mine is None else list(mine), [other for other in others if other is not None and len(other)]
    inside = {k for k, (_, noise, marked) in enumerate(lines) if marked and not noise}
    outside = {k for k, (_, noise, marked) in enumerate(lines) if not marked and not noise}
    size = lambda some: sum(len(lines[k][0]) for k in some)
    met: list[set[int]] = []
    for other in others:
        hit = {k for k, shared in enumerate(shared_lines(mine, list(other))) if shared}
        if inside or size(hit & outside) <= MOST_SHARED * size(outside):
            outside -= hit
        if size(hit & inside) <= MOST_SHARED * size(inside):
            met.append(hit & inside)
    if len(met) > 1:  # a line of the article goes if both neighbours have it: one of them may well quote it
        inside -= set.intersection(*met)
    return sorted(inside | outside if others or not inside else inside)


def article(lines: Sequence[tuple[str, bool, bool]], own: Sequence[int]) -> str:
    """Main text: the page's own lines."""
    return "\n".join(lines[k][0] for k in own)


def with_neighbours(pages: DataFrame) -> DataFrame:
    """(key, before, behind) from (key, url): the nearest pages of the host by URL path.

    A host is cut into folders (paths without their last three characters), so that a large host is no single task; pages at the ends of a
    folder get the nearest page of the folder before or behind, from one row per folder.
    """
    parts = pages.select(
        "key", "url",
        F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
    )
    parts = parts.withColumn("folder", F.regexp_replace("path", r"[^/]{0,3}(?:\.html?|/)?$", ""))
    place = ["path", "url", "key"]
    near = Window.partitionBy("host", "folder").orderBy(*place)
    folders = parts.groupBy("host", "folder").agg(F.min(F.struct(*place)).alias("low"), F.max(F.struct(*place)).alias("high"))
    along = Window.partitionBy("host").orderBy("folder")
    ends = folders.select("host", "folder", F.lag("high.key").over(along).alias("left"), F.lead("low.key").over(along).alias("right"))
    inner = parts.withColumns({"before": F.lag("key").over(near), "behind": F.lead("key").over(near)})
    return inner.join(ends, ["host", "folder"]).select("key", F.coalesce("before", "left").alias("before"), F.coalesce("behind", "right").alias("behind"))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page. The same page in several rows is differenced once.

    Markup is read where it is scanned; a page goes to its neighbours' lines as packed lines and their keys.
    """
    base = has_columns(pages, ["page_id", "url", "html"]).withColumn("key", F.xxhash64("page_id", "url", "html"))

    def outer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = [line_keys(page_lines(h or "")) for h in batch["html"]]
            yield pd.DataFrame({"key": batch["key"], "url": batch["url"], "lines": lines})

    sites = base.select("key", "url", "html").mapInPandas(outer, "key bigint, url string, lines array<bigint>")
    sites = stage(sites.dropDuplicates(["key"]), "site_lines")
    linked = with_neighbours(sites)
    side = lambda n: sites.select(F.col("key").alias(n), F.col("lines").alias(f"{n}_lines"))
    linked = stage(linked.join(side("before"), "before", "left").join(side("behind"), "behind", "left").select("key", "before_lines", "behind_lines"), "page_pairs")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = [page_lines(h or "") for h in batch["html"]]
            columns = {"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "key": batch["key"]}
            yield pd.DataFrame(columns | {"lines": [line_keys(page) for page in lines], "body": [packed_lines(page) for page in lines]})

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for body, mine, *others in zip(batch["body"], batch["lines"], batch["before_lines"], batch["behind_lines"]):
                lines = unpacked_lines(body)
                texts.append(article(lines, own_lines(lines, others, mine)))
            n = np.array([len(t) for t in texts], np.int64)
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": n})

    packed = base.mapInPandas(pack, "page_id bigint, url string, key bigint, lines array<bigint>, body binary")
    columns = packed.join(linked, "key").select("page_id", "url", "lines", "body", "before_lines", "behind_lines")
    return columns.mapInPandas(extract, "page_id bigint, url string, text string, n_chars bigint")
