"""Main text of web pages, with suffix arrays over a host's pages.

A page becomes a stream of blocks in three zones: text inside a declared
article, text inside a part that its markup names as something else (menu,
header, footer, sidebar, notice, advert, form, comments ...), and undeclared
text. A run of `RUN` tokens that occurs on `LEAST` of a host's distinct pages,
and on one of every `SHARE` of them, is the host's boilerplate, wherever it
stands in undeclared text. The pages are dealt by a hash of their html to shards
of about `SHARD_PAGES`. A shard's token streams are put one after another and
sorted by suffix, which counts the runs that repeat in it. Where these counts
leave a run open, as it may also stand once in other shards, it is counted on
all pages of the host. What is left of a page are its runs that
no such window covers. A declared article goes by the same windows where its markup
says no more than that: text that stands straight in it, or in a list or plain
container. Its paragraphs, headings, quotations and tables are declared as its
own and stay, passages that articles share included. A page that nearly consists
of repeats (`COPY_SHARE`), or an article that mostly does (`ARTICLE_COPY_SHARE`),
is a copy of others, not boilerplate, and keeps its text.

Exact copies of a page are one page. What is held per host are its windows,
counted or open: a few times what one shard's pages can repeat, however many
they are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, scratch_table

RUN = 8
SHARD_PAGES = 256
#: A window is boilerplate on so many distinct pages of a host, and on one in so many of them.
LEAST = 3
SHARE = 200
#: A page with more of its text in boilerplate windows keeps it all.
COPY_SHARE = 0.9
#: So does a declared article.
ARTICLE_COPY_SHARE = 0.5

#: The hosts' windows are broadcast up to this size, measured before the join.
BROADCAST_BYTES = 64 << 20
BROADCAST_HOSTS = 200_000

ARTICLE, OTHER, OUT = 0, 1, 2

RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
OUT_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "noscript", "template", "svg", "math",
            "iframe", "object", "select", "button", "datalist", "canvas", "audio", "video", "map"}
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert",
             "form", "menu", "menubar", "tablist", "toolbar", "status"}
# A class or id names such a part if every word of it is in one of these
# lists and one is in the first: "cookie-notice", "site-header", not "share-price".
OUT_WORDS = {
    "ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion",
    "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related",
    "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "toolbar", "topbar", "widget"}
FILLERS = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "form", "global", "item",
    "items", "layer", "left", "link", "links", "list", "main", "page", "pages", "panel", "post", "posts", "primary",
    "right", "secondary", "section", "site", "slot", "text", "top", "unit", "user", "wrap", "wrapper"}
#: Of the first list, what may also be a part of an article's own text.
ARTICLE_PARTS = {"banner", "copyright", "disclaimer", "discussion", "header", "search", "skip", "widget"}
COMMENT_WORDS = {"ad", "advert", "comment", "comments", "promo", "related", "replies", "reply", "sponsored"}
ARTICLE_NAMES = {"article", "article-body", "article-content", "article-text", "articlebody", "entry-content",
                 "main-content", "post-body", "post-content", "story-body"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr"}
#: What stands in these inside an article is declared as its own text.
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dt", "dd", "caption", "td", "th", "figcaption"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: A start tag of one of these ends an open element of its own group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}}

_TAG = re.compile(r"""<(?:(?P<comment>!--.*?(?:-->|\Z))|[!?][^>]*(?:>|\Z)"""
                  r"""|(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"""
                  r"""(?:(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|(?P<loose>[^>]*)(?:>|\Z)))""", re.S)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|["'=/]""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def attributes(attrs: str) -> dict[str, str]:
    """A start tag's attributes by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTR.findall(attrs):
        if name:
            found.setdefault(name.lower(), next(filter(None, values), ""))
    return found


def names_part(label: str, words: set[str]) -> bool:
    """Whether a class or id consists of part names, one of `words` at least."""
    parts = {w.lower() for w in _WORD.findall(label)}
    return bool(parts & words) and parts <= OUT_WORDS | FILLERS


@lru_cache(maxsize=20_000)
def named(name: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """(out, article): what a start tag's name and attributes declare it to be."""
    found = attributes(attrs)
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return True, False
    role = found.get("role", "").lower()
    labels = f"{found.get('class', '')} {found.get('id', '')}".split()
    article = (name in ("article", "main") or role in ("main", "article")
               or found.get("itemprop", "").lower() == "articlebody" or any(x.lower() in ARTICLE_NAMES for x in labels))
    if name in ("html", "body", "main"):
        return False, article
    if article:
        return any(names_part(x, COMMENT_WORDS) for x in labels), True
    words = OUT_WORDS - ARTICLE_PARTS if in_article else OUT_WORDS
    return name in OUT_TAGS or role in OUT_ROLES or any(names_part(x, words) for x in labels), False


class Open:
    """The open elements, with their zones; every step is paid for by a tag."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.times: Counter[str] = Counter()
        self.blocks: list[int] = []  # places of those that are not inline
        self.prose = 0  # how many of them, in an article, declare its own text

    @property
    def zone(self) -> int:
        return self.stack[-1][1] if self.stack else OTHER

    def push(self, name: str, zone: int) -> None:
        if name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((name, zone))
        self.times[name] += 1
        self.prose += zone == ARTICLE and name in PROSE

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            name, zone = self.stack.pop()
            self.times[name] -= 1
            self.prose -= zone == ARTICLE and name in PROSE
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()

    def close(self, name: str) -> None:
        """End the innermost element of a name, and all inside it; a stray end tag does nothing."""
        if self.times[name]:
            depth = len(self.stack) - 1
            while self.stack[depth][0] != name:
                depth -= 1
            self.cut(depth)

    def before_block(self, name: str) -> None:
        """A block start ends an open paragraph, a list item the item before it."""
        if self.blocks and self.stack[self.blocks[-1]][0] in CLOSES.get(name, set()) | {"p"}:
            self.cut(self.blocks[-1])


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(zone, text) of the page's blocks, in page order, character references
    decoded and white space folded; empty blocks are left out."""
    return [(zone, text) for zone, _, text in marked_blocks(page)]


def marked_blocks(page: str | None) -> list[tuple[int, bool, str]]:
    """(zone, prose, text) of the page's blocks; prose is text in a paragraph or the like."""
    out: list[tuple[int, bool, str]] = []
    open_ = Open()
    pieces: list[str] = []
    zone, prose = OTHER, False

    def flush() -> None:
        nonlocal prose
        if pieces:
            text = "".join(pieces)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append((zone, prose, text))
            pieces.clear()
            prose = False

    page = page or ""
    at = 0
    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None or tag.start() > at:
            pieces.append(page[at:tag.start() if tag else len(page)])
            prose |= open_.prose > 0
        if tag is None:
            break
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        if tag["end"]:
            open_.close(name)
        elif name in RAW:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
        elif name not in VOID:
            if name not in INLINE:
                open_.before_block(name)
            attrs = tag["attrs"] if tag["attrs"] is not None else tag["loose"] or ""
            inside = open_.zone
            is_out, is_article = named(name, attrs if "=" in attrs or "hidden" in attrs.lower() else "",
                                       inside == ARTICLE)
            if name == "header" and inside != ARTICLE:
                is_out = True
            open_.push(name, OUT if inside == OUT or is_out
                       else ARTICLE if inside == ARTICLE or is_article else OTHER)
        if open_.zone != zone:
            flush()
            zone = open_.zone
    flush()
    return out


# --- repeats ---------------------------------------------------------------


class WordHashes(dict[str, bytes]):
    """A word's hash as eight little-endian bytes, remembered by the worker."""

    def __missing__(self, word: str) -> bytes:
        found = self[word] = xxhash.xxh64_intdigest(word).to_bytes(8, "little")
        return found


_WORD_HASH = WordHashes()
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(RUN)], np.uint64)


def word_hashes(words: list[str]) -> np.ndarray:
    if len(_WORD_HASH) > 400_000:
        _WORD_HASH.clear()
    return np.frombuffer(b"".join(map(_WORD_HASH.__getitem__, words)), "<u8")


def window_hashes(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the RUN tokens from each position."""
    found = codes[at]
    for k in range(1, RUN):
        found += codes[at + k] * _POWERS[k]
    return found


def all_windows(codes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of RUN tokens, in their order, as signed numbers."""
    n = max(0, len(codes) - RUN + 1)
    found = codes[:n].copy()
    for k in range(1, RUN):
        found += codes[k:k + n] * _POWERS[k]
    return found.view(np.int64)


def repeats(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(window hash, distinct pages) of the windows of RUN tokens that occur on
    two distinct pages or more.

    The pages' tokens are concatenated, a token of its own after each page,
    and suffixes are ranked by prefix doubling up to RUN tokens; suffixes of
    one rank share a prefix of RUN tokens.
    """
    codes = np.concatenate([np.append(p, np.uint64(0)) for p in pages])
    page = np.repeat(np.arange(len(pages)), [len(p) + 1 for p in pages])
    ends = np.flatnonzero(np.diff(page, append=len(pages)))
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    rank[ends] = rank.max() + 1 + np.arange(len(ends))
    width = 1
    while width < RUN:
        later = np.zeros(len(rank), np.int64)
        later[:max(0, len(rank) - width)] = rank[width:] + 1
        rank = np.unique(rank * (len(rank) + len(pages) + 2) + later, return_inverse=True)[1].astype(np.int64)
        width *= 2
    whole = np.arange(len(rank)) + RUN <= np.repeat(ends, np.diff(ends, prepend=-1))
    seen = np.bincount(rank, weights=whole).astype(np.int64)
    at = np.flatnonzero(whole & (seen[rank] > 1))
    # one entry per window and page
    pairs = np.unique(rank[at] * len(pages) + page[at])
    n_pages = np.bincount(pairs // len(pages), minlength=len(seen))
    first = np.full(len(seen), -1)
    first[rank[at[::-1]]] = at[::-1]
    kept = np.flatnonzero(n_pages > 1)
    return window_hashes(codes, first[kept]), n_pages[kept]


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; a URL without one is its own empty host."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)),
                      F.lit(""))


def joined_windows(pages: DataFrame, windows: DataFrame, how: str) -> DataFrame:
    """`pages` with their hosts' windows, an array, from (host, windows)."""
    size = windows.agg(F.sum(F.size("windows") + 8)).first()[0] or 0
    windows = windows.withColumnRenamed("host", "_host")
    if 8 * size <= BROADCAST_BYTES:  # else the pages meet their hosts' windows in a shuffle
        windows = F.broadcast(windows)
    return pages.join(windows, F.col("host") == F.col("_host"), how).drop("_host")


def by_host(windows: DataFrame, name: str) -> DataFrame:
    """(host, windows) from (host, window), in rising order and written."""
    return scratch_table(windows.groupBy("host").agg(F.sort_array(F.collect_list("window")).alias("windows")), name)


def pages_with(pages: DataFrame, windows: DataFrame) -> DataFrame:
    """(host, window, n): the distinct pages of the host, from (host, html, h),
    on which each of its windows stands, from (host, windows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, wanted, rows, found = None, None, [], []
            for row, page in enumerate(batch.column(1).to_pylist()):
                host = batch.column(0)[row].as_py()
                if host != last:
                    last, wanted = host, batch.column(3)[row].values.to_numpy()
                codes = word_hashes([w for _, text in blocks(page) for w in text.split()])
                if len(codes) >= RUN:
                    own = all_windows(codes)
                    at = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                    found.append(np.unique(own[wanted[at] == own]))
                    rows.append(np.full(len(found[-1]), row))
            if found:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(np.concatenate(found)), batch.column(2).take(at)],
                    ["host", "window", "h"])

    joined = joined_windows(pages, windows, "inner").select("host", "html", "h", "windows")
    return map_arrow(joined, run, "host string, window long, h long").groupBy("host", "window").agg(
        F.count_distinct("h").alias("n"))


def host_repeats(pages: DataFrame) -> DataFrame:
    """(host, windows): per host the hashes of its boilerplate windows; from (host, html, h).

    A window's pages are at least those of the shards in which it repeats, and
    at most one more for each other shard. Where the needed number lies between
    the two, all pages of the host are counted. There are fewer shards than
    pages needed, so that no boilerplate stands but once in each.
    """
    counts = scratch_table(pages.select("host", "h").distinct().groupBy("host").agg(F.count("*").alias("n")), "hosts")
    least = F.greatest(F.lit(LEAST), F.ceil(F.col("n") / SHARE))
    large = counts.where(F.col("n") > SHARD_PAGES).select(
        F.col("host").alias("_host"), least.alias("least"), F.least(F.ceil(F.col("n") / SHARD_PAGES), least - 1).alias("shards"))
    if large.count() <= BROADCAST_HOSTS:  # else the pages meet their hosts' counts in a shuffle
        large = F.broadcast(large)
    dealt = pages.join(large, F.col("host") == F.col("_host"), "left").select(
        "host", F.pmod("h", F.coalesce("shards", F.lit(1))).alias("shard"), F.col("shards").isNull().alias("alone"),
        "h", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, streams, last = None, [], None

        def found() -> pa.RecordBatch:
            hashes, n = repeats(streams)
            if key[2]:  # no other shard adds to the counts
                hashes, n = hashes[n >= LEAST], n[n >= LEAST]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(hashes), pa.string()), pa.array(hashes.view(np.int64)), pa.array(n, pa.int64())],
                ["host", "window", "n"])

        for batch in batches:
            for host, shard, alone, h, page in zip(*(c.to_pylist() for c in batch.columns)):
                if (host, shard, h) == last:  # an exact copy is no other page; copies are neighbours
                    continue
                last = host, shard, h
                if (host, shard, alone) != key:
                    if len(streams) > 1:
                        yield found()
                    key, streams = (host, shard, alone), []
                streams.append(word_hashes([w for _, text in blocks(page) for w in text.split()]))
        if len(streams) > 1:
            yield found()

    windows = map_arrow(dealt.repartition("host", "shard").sortWithinPartitions("host", "shard", "h"), run,
                        "host string, window long, n long")
    seen = windows.groupBy("host", "window").agg(F.sum("n").alias("n"), F.count("*").alias("in_shards"))
    needed, shards = F.coalesce("least", F.lit(LEAST)), F.coalesce("shards", F.lit(1))
    judged = scratch_table(
        seen.join(large, F.col("host") == F.col("_host"), "left")
        .where(F.col("n") + shards - F.col("in_shards") >= needed)
        .select("host", "window", (F.col("n") >= needed).alias("sure")), "judged")
    counted = pages_with(pages, by_host(judged.where("not sure"), "open-windows"))
    more = counted.join(large, F.col("host") == F.col("_host")).where("n >= least")
    return by_host(judged.where("sure").select("host", "window").unionAll(more.select("host", "window")), "host-windows")


def covered(codes: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the windows, hashes in rising order."""
    inside = np.zeros(len(codes), bool)
    if len(codes) >= RUN:
        own = all_windows(codes)
        at = np.flatnonzero(windows[np.minimum(np.searchsorted(windows, own), len(windows) - 1)] == own)
        for k in range(RUN):
            inside[at + k] = True
    return inside


def main_text(page: str | None, windows: np.ndarray) -> str:
    """The page's article: its declared article blocks, or else its undeclared
    blocks, without the tokens that the host's windows cover; prose of a
    declared article stays whole."""
    found = marked_blocks(page)
    declared = any(zone == ARTICLE for zone, *_ in found)
    main = ARTICLE if declared else OTHER
    kept = [text for zone, _, text in found if zone == main]
    # whether the windows decide a block, else its zone does
    open_ = [zone == main and not (declared and prose) for zone, prose, _ in found]
    if not len(windows) or not any(open_):
        return " ".join(kept)
    words = " ".join([text for *_, text in found]).split()
    sizes = [text.count(" ") + 1 for *_, text in found]
    repeated = covered(word_hashes(words), windows) & np.repeat(open_, sizes)
    wanted = np.repeat([zone == main for zone, *_ in found], sizes)
    share = ARTICLE_COPY_SHARE if declared else COPY_SHARE
    if not 0 < np.count_nonzero(repeated) <= share * np.count_nonzero(wanted):
        return " ".join(kept)
    return " ".join([words[i] for i in np.flatnonzero(wanted & ~repeated).tolist()])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row of `pages`.

    text is empty for a null or empty page and for one without main text.
    Rows with a null URL share the empty host. Repeated rows are extracted one
    by one and count as one page among their host's. An empty table gives no
    rows. Other columns are not read.
    """
    c = {"page_id": F.col(f"`{id_col}`"), "url": F.col(f"`{url_col}`"), "html": F.col(f"`{html_col}`")}
    rows = pages.select(c["page_id"].cast("long").alias("page_id"), c["url"].alias("url"), c["html"].alias("html"),
                        host_of(c["url"]).alias("host"))
    boilerplate = host_repeats(rows.select("host", "html", F.xxhash64("html").alias("h")))
    joined = joined_windows(rows, boilerplate, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            last, windows = None, none
            texts = []
            for row, page in enumerate(batch.column(2).to_pylist()):
                host = batch.column(3)[row].as_py()
                if host != last:
                    own = batch.column(4)[row].values
                    last = host
                    windows = none if own is None else own.to_numpy()
                texts.append(main_text(page, windows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_arrow(joined.select("page_id", "url", "html", "host", "windows"), run,
                     "page_id long, url string, text string, n_chars long")
