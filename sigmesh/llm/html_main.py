"""Main text of web pages by site template removal.

One parse per page yields its text blocks and, for every block-level element
with text, a hash of its subtree (tag and texts) with the range of blocks it
covers. Spark counts the pages of a host on which each hash stands; subtrees
that recur across many pages of their host are deleted from their pages.
Only hashes and ranges move for that, never through the driver; the blocks
move once, to meet their deletions: neighbouring pages in one compressed bundle.

A light subtree (few words, or mostly links) is a template from
``LIGHT_PAGES`` pages of its host on. Running prose may stand on several
pages by right (copies, quotations), so it needs a large share of the host's
pages, and any subtree inside an ``article`` or ``main`` a larger one.
What the counts leave is cleaned by the page's own marks: elements whose tag,
role or class says menu, header, footer, sidebar, notice, advert, form or
comment are dropped (a menu of its own page never recurs). Where the page
names its article, text beside it is dropped only on a host of under
``INNER_PAGES`` pages, too few to show a template; on others the counts decide.

Defined cases: null html is empty and gives the empty text; a null url is a
host of its own name; pages of a host with the same text (their marked parts
aside) count as one, but each is cleaned; cut-off markup ends where the text
ends; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

LIGHT_PAGES = 3
LIGHT_WORDS = 40
PROSE_PAGES, PROSE_SHARE = 5, 0.2
INNER_PAGES, INNER_SHARE = 10, 0.5

# Element names of HTML by their part in a page.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td
tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea svg math object canvas audio video title".split())
DROPPED = frozenset("nav footer aside form menu dialog select button fieldset".split())
DROPPED_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alertdialog alert menu menubar toolbar".split())
# Words of class and id that name what is not the article.
DROPPED_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar
sidebar sidebars aside widget widgets related recommended
footer copyright colophon
cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer paywall
comment comments commentlist respond disqus replies
newsletter subscribe subscription signup login search searchform share sharing social
skip""".split())
HEADER_NAMES = frozenset("header masthead topbar site-header".split())
MAIN_NAMES = frozenset("articlebody".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<(/)(?=[a-zA-Z]?\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
_NAME = re.compile(r"[^a-z0-9]+")
_CLOSERS: dict[str, re.Pattern] = {}
_SCOPE = frozenset("table td th button object html body".split())
_CLOSED_BY = {"li": (frozenset(["li"]), frozenset("ul ol menu dir".split())), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
              "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])), "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
              "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
              "option": (frozenset(["option"]), frozenset(["select"]))}
_NO_MARK = (False, False)


def _marks(tag: str, attrs: str) -> tuple[bool, bool]:
    """Do the attributes name something that is not the article; do they name the article?"""
    drop = main = False
    for name, a, b, c in _ATTR.findall(attrs):
        value = (a or b or c).lower()
        name = name.lower()
        if name in ("class", "id"):
            words = set(_NAME.split(value))
            drop = drop or bool(words & DROPPED_NAMES) or bool(words & HEADER_NAMES) and tag not in ("h1", "h2")
        elif name == "role":
            drop, main = drop or value in DROPPED_ROLES, main or value == "main"
        elif name == "itemprop":
            main = main or value.replace("-", "") in MAIN_NAMES
        elif name == "aria-hidden":
            drop = drop or value == "true"
        elif name == "style":
            drop = drop or "display:none" in value.replace(" ", "")
    return drop or bool(re.search(r"(?:^|\s)hidden(?:\s|$)", _ATTR.sub(" ", attrs))), main


def parse(page: str) -> tuple[list[str], list[int], list[tuple[int, int, int, int]]]:
    """Text blocks of a page, the mark of each, and subtrees as (hash, kind, first block, end block).

    Mark 1 is dropped by the page's own marks, 2 beside its article. Kind 0 is light, 1 prose outside the article, 2 inside it.
    """
    blocks: list[str] = []
    words: list[int] = []
    linked: list[int] = []
    run: list[str] = []
    link_run = [0]
    # open elements: tag, first block, dropped by marks, names the article, holds an article
    stack: list[list] = []
    dropped: list[tuple[int, int]] = []
    mains: list[tuple[str, int, int]] = []
    trees: list[tuple[str, int, int]] = []
    in_link = 0

    def flush():
        if run:
            text = html_lib.unescape("".join(run)) if any("&" in r for r in run) else "".join(run)
            w = text.split()
            if w:
                blocks.append(" ".join(w))
                words.append(len(w))
                linked.append(link_run[0])
            run.clear()
        link_run[0] = 0

    def close(depth: int):
        flush()
        while len(stack) > depth:
            tag, first, drop, main, holds = stack.pop()
            end = len(blocks)
            if main and stack:
                stack[-1][4] = True
            if holds and stack:
                stack[-1][4] = True
            if end > first:
                if drop and not holds and not main:
                    dropped.append((first, end))
                if main:
                    mains.append((tag, first, end))
                elif tag in BLOCK and tag not in ("html", "body") and not holds:
                    trees.append((tag, first, end))

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            run.append(page[at:])
            break
        if m.start() > at:
            text = page[at:m.start()]
            run.append(text)
            if in_link:
                link_run[0] += len(text.split())
        at = m.end()
        slash, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if tag == "a":
                in_link = 0
            elif tag in BLOCK:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                else:
                    flush()
            continue
        if tag in RAW:
            if not attrs.endswith("/") or tag not in ("svg", "math", "object", "canvas"):
                if tag not in _CLOSERS:
                    _CLOSERS[tag] = re.compile(f"</{tag}[\\s/>]", re.I)
                end = _CLOSERS[tag].search(page, at)
                gt = page.find(">", end.start()) if end else -1
                at = gt + 1 if gt >= 0 else n
            if tag == "title":
                flush()
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag == "a":
            in_link = 1
            continue
        if tag not in BLOCK:
            if tag in DROPPED and not attrs.endswith("/"):  # button
                close_at = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
                at = page.find(">", close_at.start()) + 1 or n if close_at else at
            continue
        if tag == "hr":
            flush()
            continue
        flush()
        for i in range(len(stack) - 1, -1, -1):  # a new block ends an open paragraph
            if stack[i][0] == "p":
                close(i)
                break
            if stack[i][0] in _SCOPE or stack[i][0] in ("article", "main", "section", "div"):
                break
        if tag in _CLOSED_BY:
            ends, limit = _CLOSED_BY[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in limit:
                    break
                if stack[i][0] in ends:
                    close(i)
                    break
        drop, main = _marks(tag, attrs) if attrs.strip() else _NO_MARK
        main = main or tag in ("article", "main")
        if tag == "header":
            drop = drop or not any(s[3] for s in stack)
        stack.append([tag, len(blocks), (drop or tag in DROPPED) and tag not in ("html", "body"), main and not drop, False])
    close(0)

    total = len(blocks)
    marks = [0] * total
    for a, b in dropped:
        marks[a:b] = [1] * (b - a)
    live = sum(w for w, k in zip(words, marks) if not k)
    inside = [False] * total
    for names in (("article",), None):  # the articles if they hold enough of the text, else any main part
        chosen = [False] * total
        for tag, a, b in mains:
            if names is None or tag in names:
                chosen[a:b] = [True] * (b - a)
        held = sum(w for w, k, c in zip(words, marks, chosen) if not k and c)
        if held and 5 * held >= live:
            inside = chosen
            marks = [k or (0 if c else 2) for k, c in zip(marks, chosen)]
            break
    hashes = [xxhash.xxh3_64_digest(b) for b in blocks]
    out = []
    for tag, a, b in trees:
        count, links = sum(words[a:b]), sum(linked[a:b])
        light = (count < LIGHT_WORDS and tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "td", "dd")) or 2 * links > count
        h = xxhash.xxh3_64_intdigest(tag.encode() + b"".join(hashes[a:b]))
        out.append((h - (1 << 64) if h >> 63 else h, 2 if inside[a] else 0 if light else 1, a, b))
    return blocks, marks, out


_TREES = pa.list_(pa.struct([("hash", pa.int64()), ("kind", pa.int32()), ("first", pa.int32()), ("end", pa.int32())]))
_SCHEMA = ("row long, page_id long, url string, host string, content long, blocks array<string>, marks array<int>, "
           "trees array<struct<hash:long,kind:int,first:int,end:int>>")


def _content(blocks: list[str], marks: list[int]) -> int:
    """A hash of the text of a page without its marked parts, or of all where nothing is left."""
    h = xxhash.xxh3_64()
    for b in [b for b, m in zip(blocks, marks) if not m] or blocks:
        h.update(xxhash.xxh3_64_digest(b))
    return h.intdigest() - (1 << 63)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    row = TaskContext.get().partitionId() << 33
    host = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", re.I)
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            b = batch.slice(lo, 256)
            urls = b.column("url").to_pylist()
            parsed = [parse(x or "") for x in b.column("html").to_pylist()]
            hosts = [(m[1].lower() if (m := host.match(u or "")) else u or "") for u in urls]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + b.num_rows), pa.int64()), b.column("page_id"), b.column("url"), pa.array(hosts, pa.string()),
                 pa.array([_content(*p[:2]) for p in parsed], pa.int64()),
                 pa.array([p[0] for p in parsed], pa.list_(pa.string())), pa.array([p[1] for p in parsed], pa.list_(pa.int32())),
                 pa.array([[dict(zip(("hash", "kind", "first", "end"), t)) for t in p[2]] for p in parsed], _TREES)],
                names=["row", "page_id", "url", "host", "content", "blocks", "marks", "trees"])
            row += b.num_rows


def judged(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, blocks, marks, the recurring ranges (gone), and whether text beside the article counts (open)."""
    scratch = Scratch(spark, "html")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.col("html").cast("string").alias("html"))
    parsed = scratch.table(p.mapInArrow(_parse_batches, _SCHEMA), "parsed")
    trees = parsed.select("row", "host", "content", F.explode("trees").alias("t")).select("row", "host", "content", "t.*")
    # pages of a host with a subtree, and pages of a host, each text once
    seen = (trees.groupBy("host", "hash", "content").agg(F.lit(1).alias("one")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages"))
            .filter(F.col("pages") >= LIGHT_PAGES))
    hosts = scratch.table(parsed.groupBy("host", "content").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")), "hosts")
    many = scratch.table(seen.join(hosts.hint("merge"), "host"), "recurring")
    # no broadcast: stored tables count as their compressed files; a hot host or subtree is split by AQE's skew join
    hit = trees.join(many.hint("merge"), ["host", "hash"])
    need = (F.when(F.col("kind") == 0, F.lit(float(LIGHT_PAGES)))
            .when(F.col("kind") == 1, F.greatest(F.lit(float(PROSE_PAGES)), F.col("host_pages") * PROSE_SHARE))
            .otherwise(F.greatest(F.lit(float(INNER_PAGES)), F.col("host_pages") * INNER_SHARE)))
    gone = hit.filter(F.col("pages") >= need).select("row", F.struct("first", "end").alias("range"), F.lit(False).alias("open"))
    beside = parsed.filter(F.array_contains("marks", 2)).select("row", "host")
    beside = beside.join(hosts.filter(F.col("host_pages") >= INNER_PAGES).hint("merge"), "host")
    known = gone.unionByName(beside.select("row", F.lit(None).cast("struct<first:int,end:int>").alias("range"), F.lit(True).alias("open")))
    known = scratch.table(known, "known")  # the subtrees' shuffle ends before the blocks move
    known = (known.withColumn("bundle", F.shiftright("row", BUNDLE_BITS))
             .groupBy("bundle").agg(F.collect_list(F.struct("row", "range.first", "range.end", "open")).alias("known")))
    bundles = parsed.select("row", "page_id", "url", "blocks", "marks").mapInArrow(_bundled, "bundle long, pages binary")
    return bundles.join(known.hint("merge"), "bundle", "left").mapInArrow(_opened, _JUDGED)


#: Pages of neighbouring rows travel together, up to 2**BUNDLE_BITS of them, compressed.
BUNDLE_BITS = 6
_RANGES = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
_JUDGED = "page_id long, url string, blocks array<string>, marks array<int>, gone array<struct<first:int,end:int>>, open boolean"


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of pages of one bundle, each as a compressed Arrow stream; a bundle may be in several rows."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        of = batch.column("row").to_numpy() >> BUNDLE_BITS
        starts = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
        pages = []
        for lo, hi in zip(starts, [*starts[1:], len(of)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                out.write_batch(batch.slice(lo, hi - lo))
            pages.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(of[starts]), pa.array(pages, pa.binary())], names=["bundle", "pages"])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages of each bundle beside what is known of them."""
    for batch in batches:
        for pages, known in zip(batch.column("pages"), batch.column("known").to_pylist()):
            gone, beside = {}, set()
            for k in known or ():
                if k["first"] is not None:
                    gone.setdefault(k["row"], []).append({"first": k["first"], "end": k["end"]})
                if k["open"]:
                    beside.add(k["row"])
            for b in pa.ipc.open_stream(pages.as_buffer()):
                rows = b.column("row").to_pylist()
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "url", "blocks", "marks")), pa.array([gone.get(r, []) for r in rows], _RANGES),
                                                  pa.array([r in beside for r in rows])], names=["page_id", "url", "blocks", "marks", "gone", "open"])


def _recurs(i):
    return F.coalesce(F.exists("gone", lambda g: (g["first"] <= i) & (g["end"] > i)), F.lit(False))


def _marked(i):
    mark = F.element_at("marks", i + 1)
    return (mark == 1) | (mark == 2) & ~F.coalesce("open", F.lit(False))


def main_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text."""
    stays = F.filter("blocks", lambda b, i: ~_recurs(i) & ~_marked(i))
    return judged(spark, pages).select("page_id", "url", F.array_join(stays, "\n").alias("text"))


def removals(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row: the blocks of all pages, and how many go by recurrence alone, by marks alone, and by both."""
    n = lambda test: F.sum(F.size(F.filter("blocks", lambda b, i: test(i))))
    return judged(spark, pages).agg(F.sum(F.size("blocks")).alias("blocks"), n(lambda i: _recurs(i) & ~_marked(i)).alias("recurring"),
                                    n(lambda i: _marked(i) & ~_recurs(i)).alias("marked"), n(lambda i: _marked(i) & _recurs(i)).alias("both"))
