"""Main text of web pages: markup roles and a suffix array per host.

A page is cut into blocks, the text between block-level tags. Markup says of each
block whether it is page furniture (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments) and whether it stands inside an article. Scripts,
styles and comments in the markup are no text at all. An end tag closes all that is open inside its
element. Class names count as whole names, inside an article on elements that hold others only; what
holds an article is not furniture by class names, nor are the elements inside one that is never closed.

Furniture without markup is found by repetition. The blocks outside articles
of all pages of a host are concatenated, with a separator of its own after
each page, and their suffixes are sorted by prefix doubling up to ``RUN`` tokens.
Pages of a host with the same words are one page here, so a page stored twice does
not repeat itself. Suffixes that share so many tokens and come from ``PAGES`` distinct
pages or more, and from at least ``MIN_SHARE`` of the host's, are repeated runs. A block outside articles that repeated runs cover is
boilerplate on every page, with an article or without; what neither repeats nor markup call furniture
is main text. An article is main text whatever it repeats: sites print the same
title or passage in many articles and in their menus too.

Scale: a host is dealt out over blocks of about ``BLOCK_PAGES`` pages by a hash, so
one with a third of all pages is spread. Copies are merged before, with a map-side
step. Pages are in one block each, so the
distinct pages of a run, counted per block by its suffix array, add up to those of
the host: nothing is lost by the split. Sums meet in an aggregation with a
map-side step. Only text outside articles is shuffled token by token.

Null and empty pages give an empty text. Pages without a valid address share an
empty host. Null ids, repeated rows and ties are kept: one result per row. An
empty table gives an empty result. Extra columns are ignored. Time is linear
in the length of a page, but for the sorting of its suffixes.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ROW, small, texts, with_row_number
from clickloom.session import stage

#: tokens of a repeated run, distinct pages that it must stand on, pages whose suffixes are sorted together
RUN = 8
PAGES = 2
#: and share of the host's distinct pages
MIN_SHARE = 0.001
BLOCK_PAGES = 500

# fixed values: element and attribute names of HTML. A quote opens a value only right after an equals sign.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/><]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "noembed", "noframes", "xmp"}
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = set("nav header footer aside form menu button select option dialog template svg canvas object video audio head fieldset datalist".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_NEVER = {"html", "body", "main", "article"}
_HOLDERS = set("div section ul ol dl table tbody tr td center figure details".split())
#: whole class names and ids that mark furniture, and those of reader comments
_NAMES = set(
    "ad ads advert adverts advertisement advertising ad-container sponsor sponsored promo banner cookie cookies cookie-banner cookie-notice consent gdpr notice notices newsletter subscribe "
    "sidebar side-bar menu nav navbar navigation site-nav main-nav breadcrumb breadcrumbs footer site-footer page-footer header site-header page-header masthead share share-buttons "
    "sharing social social-links related related-posts popup modal".split()
)
_COMMENTS = set("comment comments comment-list commentlist comments-area disqus disqus_thread replies responses".split())
#: an element that a start tag closes when it is the innermost open one
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

Block = tuple[str, bool, bool]  # text, inside an article, furniture by its markup


class _Element:
    """An open element, and what makes it furniture: its kind (name or role), its class names, or nothing."""

    def __init__(self, name: str, why: str | None):
        self.name, self.why = name, why
        #: blocks of elements inside it that nothing but its class names hides
        self.blocks: list[list] = []


def _why(name: str, attributes: str, in_article: bool) -> str | None:
    """What makes an element furniture: ``kind``, ``comments``, ``names``, or None.

    Class names count as whole names only, and inside an article only on elements that hold others.
    """
    if name in _FURNITURE:
        return "kind"
    if name in _NEVER or "=" not in attributes:
        return None
    for key, *values in _ATTRIBUTE.findall(attributes):
        names = "".join(values).lower().split()
        if key.lower() == "role":
            if _ROLES.intersection(names):
                return "kind"
        elif not in_article or name in _HOLDERS:
            if _COMMENTS.intersection(names):
                return "comments"
            if _NAMES.intersection(names):
                return "names"
    return None


class _Parser:
    """Blocks of a page from its tags in order, with the open elements as HTML's rules have them."""

    def __init__(self):
        self.out: list[list] = []  # text, inside an article, furniture
        self.parts: list[str] = []
        self.open: list[_Element] = []
        self.hidden: list[_Element] = []  # those of the open elements that are furniture
        self.count: Counter[str] = Counter()  # open elements by name

    def _push(self, e: _Element) -> None:
        self.open.append(e)
        self.count[e.name] += 1
        if e.why:
            self.hidden.append(e)

    def _pop(self) -> _Element:
        e = self.open.pop()
        self.count[e.name] -= 1
        if e.why:
            self.hidden.pop()
        return e

    def _in_article(self) -> bool:
        return self.count["article"] + self.count["main"] > 0

    def close_block(self) -> None:
        text = " ".join(entities.unescape("".join(self.parts)).split())
        self.parts.clear()
        if text:
            block = [text, self._in_article(), bool(self.hidden)]
            self.out.append(block)
            if len(self.hidden) == 1 and self.hidden[0].why == "names" and self.open[-1] is not self.hidden[0]:
                self.hidden[0].blocks.append(block)

    def start(self, name: str, attributes: str) -> None:
        self.close_block()
        if name in _VOID:
            return
        if name == "body":
            while self.open:
                self._pop()
        while self.open and (self.open[-1].name == "p" or self.open[-1].name in _ENDED_BY.get(name, ())):
            self._pop()
        if name in ("article", "main") and not self._in_article():
            for e in self.hidden:  # what holds the article is no furniture, whatever its class names say
                e.why = None if e.why == "names" else e.why
            self.hidden = [e for e in self.hidden if e.why]
        if not (attributes.endswith("/") and name in _FURNITURE):
            self._push(_Element(name, _why(name, attributes, self._in_article())))

    def end(self, name: str) -> None:
        self.close_block()
        if not self.count[name]:
            return
        while (e := self._pop()).name != name:
            if e.why == "names":  # never closed: of its text only what stands in it directly is furniture
                for block in e.blocks:
                    block[2] = False


def blocks_of(page: str) -> list[Block]:
    """The non-empty blocks of a page in order, with white space and character references resolved."""
    parser, at, size = _Parser(), 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if not m:
            parser.parts.append(page[at:])
            break
        parser.parts.append(page[at : m.start()])
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if name in _INLINE:
            if name == "br":
                parser.parts.append(" ")
        elif m.group(1):
            parser.end(name)
        elif name in _RAW:
            parser.close_block()
            end = re.compile(rf"</{name}", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
        else:
            parser.start(name, m.group(3))
    parser.close_block()
    return [(text, article, furniture) for text, article, furniture in parser.out]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _run_hashes(words: list[str]) -> list[int]:
    return [_signed(xxhash.xxh64_intdigest(" ".join(words[k : k + RUN]))) for k in range(len(words) - RUN + 1)]


def repeated_prefixes(pages: list[list[str]], run: int = RUN) -> list[tuple[int, int, int]]:
    """(page, position, number of distinct pages) for one place of every distinct run of ``run`` tokens in the pages.

    Suffixes of the concatenated pages are ranked by prefix doubling; ``run`` is a power of two.
    """
    number: dict[str, int] = {}
    sizes = [len(p) + 1 for p in pages]
    stream = np.fromiter((w for k, p in enumerate(pages) for w in (*(number.setdefault(x, len(number)) for x in p), -1 - k)), np.int64, sum(sizes))
    owner = np.repeat(np.arange(len(pages)), sizes)
    position = np.arange(len(stream)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < run:
        following = np.concatenate([rank[width:], np.full(min(width, len(rank)), -1)])[: len(rank)] + 1
        rank = np.unique(rank * (len(rank) + 2) + following, return_inverse=True)[1].astype(np.int64)
        width *= 2
    inside = position + run <= np.repeat(np.array(sizes) - 1, sizes)  # the run ends before the page does
    suffixes = np.flatnonzero(inside)
    suffixes = suffixes[np.argsort(rank[suffixes], kind="stable")]
    if not len(suffixes):
        return []
    first = np.flatnonzero(np.append(True, np.diff(rank[suffixes]) != 0))
    new_page = np.append(True, (np.diff(rank[suffixes]) != 0) | (np.diff(owner[suffixes]) != 0))
    distinct = np.add.reduceat(new_page.astype(np.int64), first)
    return list(zip(owner[suffixes[first]].tolist(), position[suffixes[first]].tolist(), distinct.tolist()))


def parsed_pages(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Row number, columns to keep, host and blocks of each page in a written table."""
    keep = ["page_id", url] if keep is None else keep
    kind = pa.list_(pa.struct([("text", pa.string()), ("article", pa.bool_()), ("furniture", pa.bool_())]))
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in small(batches):
            found = [[dict(zip(("text", "article", "furniture"), b)) for b in blocks_of(p)] for p in texts(batch.column(len(keep)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, kind)], [*keep, "blocks"])

    parsed = pages.select(*keep, F.col(html).alias("__html")).mapInArrow(run, f"{fields}, blocks array<struct<text: string, article: boolean, furniture: boolean>>")
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    return stage(with_row_number(parsed.withColumn("host", host)), "parsed")


def _words_outside(blocks: list[dict]) -> list[str]:
    return [w for b in blocks if not b["article"] for w in b["text"].split()]


def repeated_runs(parsed: DataFrame, pages: int = PAGES, block_pages: int = BLOCK_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, run) of the runs outside articles that stand on so many distinct pages of a host, and on that share of them."""
    # pages with the same words, inside articles and outside, are one
    words = F.xxhash64(F.array_join(F.col("blocks.text"), " "))
    each = parsed.select("host", words.alias("content"), F.expr("filter(blocks, b -> not b.article)").alias("blocks"))
    distinct = stage(each.groupBy("host", "content").agg(F.max("blocks").alias("blocks")), "distinct-pages")
    sizes = distinct.groupBy("host").agg(F.count("*").alias("n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / block_pages)).cast("int")
    least = F.greatest(F.lit(pages), F.ceil(F.col("n") * min_share)).cast("long")
    dealt = distinct.where("size(blocks) > 0").join(sizes.select("host", parts.alias("parts"), least.alias("least")), "host")
    dealt = dealt.select("host", F.expr("pmod(content, parts)").alias("part"), "blocks", "least")
    dealt = dealt.repartition("host", "part").sortWithinPartitions("host", "part")

    def count(batches):
        key, held = None, []
        for batch in small(batches):
            for host, part, blocks, least in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if key != (host, part, least) and held:
                    yield counted(key[0], key[2], held)
                    held = []
                key = (host, part, least)
                held.append(_words_outside(blocks))
        if held:
            yield counted(key[0], key[2], held)

    def counted(host: str, least: int, held: list[list[str]]) -> pa.RecordBatch:
        found = repeated_prefixes(held)
        hashes = [_signed(xxhash.xxh64_intdigest(" ".join(held[p][at : at + RUN]))) for p, at, _ in found]
        columns = [pa.array([host] * len(found), pa.string()), pa.array(hashes, pa.int64()), pa.array([f[2] for f in found], pa.int64()), pa.array([least] * len(found), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["host", "run", "n", "least"])

    runs = dealt.mapInArrow(count, "host string, run bigint, n bigint, least bigint")
    return runs.groupBy("host", "run").agg(F.sum("n").alias("n"), F.max("least").alias("least")).where("n >= least").select("host", "run")


def boilerplate_blocks(parsed: DataFrame, runs: DataFrame) -> DataFrame:
    """(row, block) of the blocks outside articles that repeated runs cover."""

    def places(batches):
        for batch in small(batches):
            rows, hosts, starts, hashes = [], [], [], []
            for row, host, blocks in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = _run_hashes(_words_outside(blocks))
                rows += [row] * len(found)
                hosts += [host] * len(found)
                starts += range(len(found))
                hashes += found
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((rows, hosts, starts, hashes), types)], ["row", "host", "at", "run"])

    outside = parsed.select(ROW, "host", F.expr("filter(blocks, b -> not b.article)").alias("blocks")).where("size(blocks) > 0")
    each = outside.mapInArrow(places, "row bigint, host string, at bigint, run bigint")
    hits = each.join(runs, ["host", "run"], "left_semi").groupBy("row").agg(F.collect_list("at").alias("at"))
    narrow = parsed.select(F.col(ROW).alias("row"), "blocks").join(hits, "row")

    def covered(batches):
        for batch in small(batches):
            out: list[tuple] = []
            for row, blocks, at in zip(*(batch.column(k).to_pylist() for k in range(3))):
                marked = np.zeros(len(_words_outside(blocks)) + 1, np.int64)
                starts = np.array(at, np.int64)
                np.add.at(marked, starts, 1)
                np.add.at(marked, starts + RUN, -1)
                marked = np.cumsum(marked) > 0
                begin = 0
                for k, b in enumerate(blocks):
                    if b["article"]:
                        continue
                    n = len(b["text"].split())
                    if marked[begin : begin + n].all():
                        out.append((row, k))
                    begin += n
            types = [pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(types)], ["row", "block"])

    return narrow.mapInArrow(covered, "row bigint, block int")


def main_text(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """The kept columns of each page, its main text and the number of code points in it."""
    keep = keep or ["page_id", url]
    parsed = parsed_pages(pages, url, html, keep)
    runs = stage(repeated_runs(parsed, block_pages=block_pages), "runs")
    # repeats decide about every block outside articles that markup leaves open; pages without one take no part in the joins
    is_open = F.expr("exists(blocks, b -> not b.article and not b.furniture)")
    undecided = parsed.where(is_open)
    gone = boilerplate_blocks(undecided, runs).groupBy("row").agg(F.collect_set("block").alias("gone"))
    judged = undecided.join(gone, undecided[ROW] == gone["row"], "left")
    numbered = "transform(blocks, (b, k) -> struct(b.text as text, b.article or not array_contains(coalesce(gone, array()), k) as unique, b.furniture as furniture))"
    rest = F.expr(f"filter({numbered}, b -> b.unique and not b.furniture).text")
    article = F.expr("filter(blocks, b -> not b.furniture).text")
    texts_of = [parsed.where(~is_open).select(*keep, article.alias("text")), judged.select(*keep, rest.alias("text"))]
    both = texts_of[0].unionByName(texts_of[1]).withColumn("text", F.array_join("text", "\n"))
    return both.withColumn("n_chars", F.length("text").cast("long"))
