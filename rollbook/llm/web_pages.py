"""Main text of web pages, with boilerplate found by suffix arrays over hosts.

A page is cut into blocks, each in one of three zones: the article, chrome
(menus, headers, footers, sidebars, notices, adverts, forms, comments), or
open, where the page has no article element.  The token streams of a host's
chrome and open blocks are concatenated, in slices of bounded size, and their
suffixes sorted; runs of ``least`` tokens or more that distinct pages share are
boilerplate.  Runs are merged across the slices of a host, so a large host is
treated like a small one.  Open blocks lose what such runs cover and keep their
unique runs; chrome goes; the article stays whole, since passages that articles
share are part of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.groups import map_groups

ARTICLE, CHROME, OPEN = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<",
    re.S,
)
_MARK = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_PART = re.compile(r"[a-z]+")

# Fixed element and mark names.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
_CHROME = frozenset(
    "nav footer aside form menu dialog button select template noscript svg math object head canvas audio video map".split()
)
_CHROME_MARKS = frozenset(
    "nav navbar navigation menu sidebar aside footer masthead breadcrumb breadcrumbs ad ads advert advertisement adverts advertising "
    "sponsor sponsored banner promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended comment comments disqus respond reply replies pagination "
    "pager toolbar widget search complementary contentinfo".split()
)
_END_OF_P = _BLOCK - {"br", "button"}


def _marks(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id and role; whether they name the article body."""
    words: set[str] = set()
    body = False
    for name, value in _MARK.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() == "itemprop" or value == "main":
            body |= value in ("articlebody", "main")
        else:
            words.update(_PART.findall(value))
    return words, body


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of each block in page order; references decoded, white space made one blank, empty blocks left out."""
    out: list[tuple[int, str]] = []
    buffer: list[str] = []
    stack: list[list] = []  # tracked elements: name, depth, what they are
    at, end = 0, len(page)
    article = body = chrome = 0

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                # inside an article element, inside a main element, chrome or neither
                out.append((CHROME if chrome else ARTICLE if article else 3 if body else OPEN, text))

    def leave(upto: int) -> None:
        nonlocal article, body, chrome
        while len(stack) > upto:
            kind = stack.pop()[2]
            article -= kind == "article"
            body -= kind == "body"
            chrome -= kind == "chrome"

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            token = m.group()
            if token[0] != "<" or token == "<":
                buffer.append(token)
            continue
        name = name.lower()
        closing = m.group(1) or m.group(4)
        if name in _BLOCK:
            flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    stack[i][1] -= 1
                    if stack[i][1] == 0:
                        flush()
                        leave(i)
                    break
            continue
        if name in _RAW:
            flush()
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        attributes = m.group(3) or m.group(6) or ""
        if name in _VOID:
            continue
        # elements whose end tag is often left out
        for i in range(len(stack) - 1, -1, -1):
            held = stack[i][0]
            if (held == "p" and name in _END_OF_P) or (held == name and held in ("li", "td", "tr", "dd", "dt", "option")):
                leave(i)
                break
            if held == "head" and name in ("body", "article", "main", "div", "p"):
                leave(i)
                break
        if attributes.endswith("/") and name in ("svg", "math"):
            continue
        words, is_body = _marks(attributes) if attributes and "=" in attributes else (set(), False)
        inside = article or body
        kind = None
        if name in _CHROME or not _CHROME_MARKS.isdisjoint(words) or (not inside and (name == "header" or "header" in words)):
            kind = "chrome"
        if name == "article" and _CHROME_MARKS.isdisjoint(words):
            kind = "article"
            if chrome and not inside:  # chrome that was never closed
                leave(0)
        elif (name == "main" or is_body) and kind is None:
            kind = "body"
        if name in ("html", "body"):
            kind = None
        if kind:
            flush()
            stack.append([name, 1, kind])
            article += kind == "article"
            body += kind == "body"
            chrome += kind == "chrome"
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    stack[i][1] += 1
                    break
    flush()
    zones = {z for z, _ in out}
    # the article is its element, else the main element; without either, all that is not chrome is open
    best = ARTICLE if ARTICLE in zones else 3 if 3 in zones else None
    return [(z if z == CHROME else ARTICLE if z == best else OPEN if best is None else CHROME, t) for z, t in out]


#: Tokens that stand for the end of a block.
_END = "\x00"


def _stream(found: list[tuple[int, str]]) -> tuple[list[str], list[int]]:
    """Tokens of chrome and open blocks with an end mark after each, and the block each belongs to."""
    tokens: list[str] = []
    block: list[int] = []
    for b, (zone, text) in enumerate(found):
        if zone != ARTICLE:
            words = text.split(" ")
            tokens += words
            tokens.append(_END)
            block += [b] * (len(words) + 1)
    return tokens, block


def _hashes(tokens: list[str], least: int) -> np.ndarray:
    """A number for each run of ``least`` tokens."""
    n = len(tokens) - least + 1
    if n <= 0:
        return np.empty(0, np.int64)
    one = np.fromiter((xxhash.xxh64_intdigest(t) for t in tokens), np.uint64, len(tokens))
    out = np.zeros(n, np.uint64)
    for j in range(least):
        out = (out ^ one[j : j + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * j)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        zones, texts, classes, streams = [], [], [], []
        for page in batch.column("html").to_pylist():
            found = blocks(page)
            zones.append([z for z, _ in found])
            texts.append([t for _, t in found])
            main = "\x01".join(t for z, t in found if z != CHROME)
            classes.append(xxhash.xxh64_intdigest(main) - (1 << 63))
            streams.append(sum(len(t) + 1 for z, t in found if z != ARTICLE))
        yield pa.RecordBatch.from_pydict(
            {
                "row": batch.column("row"),
                "id": batch.column("id"),
                "url": batch.column("url"),
                "host": batch.column("host"),
                "zones": pa.array(zones, pa.list_(pa.int32())),
                "texts": pa.array(texts, pa.list_(pa.string())),
                "class": pa.array(classes, pa.int64()),
                "stream": pa.array(streams, pa.int64()),
            }
        )


def suffix_runs(pages: list[list[str]], classes: list[int], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry for each distinct run of ``least`` tokens: where it first starts, lowest and highest class of its pages.

    The suffixes of the concatenated streams are sorted by prefix doubling up
    to ``least`` tokens, which is the depth that tells which neighbours in the
    suffix array share a run that long.  No run goes over the end of a page.
    """
    ids: dict[str, int] = {}
    whole: list[int] = []
    owner: list[int] = []
    for p, tokens in enumerate(pages):
        whole += [ids.setdefault(t, len(ids)) for t in tokens]
        whole.append(-1 - p)
        owner += [p] * (len(tokens) + 1)
    if not whole:
        none = np.empty(0, np.int64)
        return none, none, none
    rank = np.unique(np.array(whole, np.int64), return_inverse=True)[1].astype(np.int64)
    length, n = 1, len(rank)
    while length < least:
        step = min(length, least - length)
        after = np.full(n, -1, np.int64)
        if step < n:
            after[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        length += step
    order = np.argsort(rank, kind="stable")  # the suffix array
    page = np.array(owner)
    ends = np.cumsum(np.bincount(page))[page] - 1  # of each page, where its end mark stands
    inside = np.arange(n) + least <= ends
    order = order[inside[order]]
    if not len(order):
        none = np.empty(0, np.int64)
        return none, none, none
    starts = np.flatnonzero(np.append(True, rank[order][1:] != rank[order][:-1]))
    of = np.array(classes, np.int64)[page[order]]
    return order[starts], np.minimum.reduceat(of, starts), np.maximum.reduceat(of, starts)


def _runs(least: int) -> object:
    """Distinct runs of one slice of a host; of a host with one slice, only those that distinct pages share."""

    def work(group: pd.DataFrame) -> pd.DataFrame | None:
        pages = [_stream(list(zip(z, t, strict=True)))[0] for z, t in zip(group["zones"], group["texts"], strict=True)]
        at, low, high = suffix_runs(pages, group["class"].tolist(), least)
        if int(group["slices"].iloc[0]) == 1:
            shared = low != high
            at, low, high = at[shared], low[shared], high[shared]
        if not len(at):
            return None
        sizes = np.array([len(p) + 1 for p in pages])
        firsts = np.cumsum(sizes) - sizes
        page = np.searchsorted(firsts, at, "right") - 1
        run = [_hashes(pages[p][a : a + least], least)[0] for p, a in zip(page, at - firsts[page], strict=True)]
        return pd.DataFrame({"host": group["host"].iloc[0], "run": run, "low": low, "high": high})

    return work


def _open_runs(least: int) -> object:
    """Each run of the pages that have open blocks, and where it starts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                found = _hashes(_stream(list(zip(r.zones, r.texts, strict=True)))[0], least)
                yield pd.DataFrame({"host": r.host, "row": r.row, "run": found, "at": np.arange(len(found))})

    return run


def _kept(least: int) -> object:
    """Main text of each page with open blocks, given where boilerplate runs start in its stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                found = list(zip(r.zones, r.texts, strict=True))
                tokens, block = _stream(found)
                covered = np.zeros(len(tokens) + 1, np.int64)
                if r.starts is not None:
                    for a in r.starts:
                        covered[a] += 1
                        covered[min(a + least, len(tokens))] -= 1
                covered = np.cumsum(covered)
                kept: dict[int, list[str]] = {}
                for k, (t, b) in enumerate(zip(tokens, block, strict=True)):
                    if not covered[k] and t != _END:
                        kept.setdefault(b, []).append(t)
                texts = [t if z == ARTICLE else " ".join(kept.get(b, [])) for b, (z, t) in enumerate(found) if z != CHROME]
                out.append((r.row, " ".join(t for t in texts if t)))
            yield pd.DataFrame(out, columns=["row", "text"])

    return run


def repeated_runs(parsed: DataFrame, least: int, slice_bytes: int) -> DataFrame:
    """(host, run) of the runs that distinct pages of a host share; pages with the same main text count as one."""
    hosts = stage(
        parsed.filter("stream > 0")
        .groupBy("host")
        .agg(F.ceil(F.sum("stream") / F.lit(slice_bytes)).cast("int").alias("slices"))
    )
    streams = parsed.filter("stream > 0").select("host", "row", "class", "zones", "texts")
    chrome = F.arrays_zip("zones", "texts")
    streams = streams.withColumn("_kept", F.filter(chrome, lambda b: b["zones"] != ARTICLE)).select(
        "host", "row", "class", F.col("_kept.zones").alias("zones"), F.col("_kept.texts").alias("texts")
    )
    dealt = streams.join(hosts, "host").withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices").cast("long")))
    runs = map_groups(dealt, ["host", "slice"], _runs(least), "host string, run long, low long, high long")
    merged = runs.groupBy("host", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return merged.filter("low != high").select("host", "run")


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = 8,
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per page: id, url, text, n_chars.

    Character references are decoded, white space inside a block is one blank,
    blocks are joined in page order by one blank.  A NULL or empty page has an
    empty text; pages with a NULL url are one host; NULL ids and repeated rows
    are pages like others, pages with the same main text never make each
    other's text boilerplate; an empty table gives no rows.  Columns other than
    the three named ones are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    id_type = pages.schema[id_col].dataType.simpleString()
    given = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        host.alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    parsed = stage(
        given.mapInArrow(
            _parsed,
            f"row long, id {id_type}, url string, host string, zones array<int>, texts array<string>, class long, stream long",
        )
    )
    has_open = F.array_contains("zones", OPEN)
    whole = F.array_join(F.col("_article.texts"), " ")
    done = (
        parsed.filter(~has_open)
        .withColumn("_article", F.filter(F.arrays_zip("zones", "texts"), lambda b: b["zones"] == ARTICLE))
        .select("id", "url", whole.alias("text"))
    )
    undecided = parsed.filter(has_open).select("row", "id", "url", "host", "zones", "texts")
    runs = stage(repeated_runs(parsed, least, slice_bytes))
    places = undecided.select("host", "row", "zones", "texts").mapInPandas(
        _open_runs(least), "host string, row long, run long, at int"
    )
    starts = stage(places.join(runs, ["host", "run"], "left_semi").groupBy("row").agg(F.collect_list("at").alias("starts")))
    texts = undecided.select("row", "zones", "texts").join(starts, "row", "left")
    kept = texts.mapInPandas(_kept(least), "row long, text string")
    kept = undecided.select("row", "id", "url").join(kept, "row").select("id", "url", "text")
    out = done.unionAll(kept)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
