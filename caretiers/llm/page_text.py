"""HTML extraction: the article of a page, by the template that the pages of its host share.

A token is a tag in its place (the tags, classes and ids around it). Its occurrence vector says how
often it stands on each page of the host. Tokens with equal vectors that stand on most pages form an
equivalence class, the tags of one piece of the template. A class is valid if its tokens keep their
order and nesting on all those pages; valid classes nest into the template of the host, and what lies between their
tags are its slots. The slot of the article is that of the innermost class that still spans the main
content; its blocks are the text, without the slots that belong to the page's frame.

Occurrence vectors are never gathered: a vector is fingerprinted as a sum of page hashes, which Spark
adds up before and after the shuffle. A host with a third of all pages is a few rows per task.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp noframes noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Elements that end an open one of the same kind below the given containers.
ENDS_SAME = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
    "th": ("tr", "table"), "option": ("select",), "thead": ("table",), "tbody": ("table",), "tfoot": ("table",),
}
#: Elements and names of the page's frame (fixed values).
FRAME = frozenset(
    "nav aside footer form button select fieldset menu dialog head script style template noscript iframe svg canvas object "
    "textarea title input datalist audio video map".split()
)
FRAME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar side aside footer header masthead topbar comment comments disqus reply replies respond discussion "
    "notice notices cookie cookies consent gdpr newsletter subscribe signup login share sharing social related recommended "
    "popup modal overlay widget pagination pager toolbar skip legal copyright disclaimer alert".split()
)
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
MAIN_NAMES = frozenset("article articlebody content main post entry story body text".split())
_DIGIT = re.compile(r"[0-9/]")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_DECLARED_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

ARTICLE, MAIN, FRAMED, PLAIN = "article", "main", "frame", "plain"


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), a or b or c)
    return found


def _role(tag: str, attributes: dict[str, str]) -> str:
    """What an element says about itself."""
    role = attributes.get("role", "").lower()
    names = {p.lower() for a in ("class", "id") for p in _NAME_PARTS.findall(attributes.get(a, ""))}
    if tag in ("html", "body"):
        return PLAIN
    if tag == "article" or attributes.get("itemprop", "").lower() == "articlebody" or role == "article":
        # Comments are often articles of their own.
        return FRAMED if names & {"comment", "comments", "reply", "related", "teaser", "promo", "ad"} else ARTICLE
    if tag in FRAME or role in FRAME_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "") == "true":
        return FRAMED
    if _DECLARED_HIDDEN.search(attributes.get("style", "")):
        return FRAMED
    if tag == "main" or role == "main":
        return MAIN
    if tag in INLINE or tag in ("p", "li", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"):
        return FRAMED if names & {"ad", "ads", "advert", "comment", "comments", "share", "cookie", "notice"} else PLAIN
    if names & FRAME_NAMES or tag == "header":
        return FRAMED
    if names & MAIN_NAMES:
        return MAIN
    return PLAIN


class Block:
    """A stretch of text between block tags: the element it stands in, its depth-first place, its text."""

    __slots__ = ("node", "text", "linked")

    def __init__(self, node: int, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked


class Page:
    """Elements of a page as a tree of places, and its blocks in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.role, self.path = [-1], [""], [PLAIN], [""]
        self.blocks: list[Block] = []
        stack, text, linked = [0], [], 0
        links = 0

        def flush() -> None:
            nonlocal text, linked
            if text:
                # References are decoded once per run of text; white space becomes one space.
                joined = " ".join("".join(text).split())
                if joined:
                    top = len(stack) - 1
                    while top and self.tag[stack[top]] in INLINE:
                        top -= 1
                    self.blocks.append(Block(stack[top], joined, linked))
            text, linked = [], 0

        def close(to: int) -> None:
            nonlocal links
            while len(stack) > to:
                tag = self.tag[stack.pop()]
                links -= tag == "a"

        at = 0
        while at < len(source):
            m = _TOKEN.search(source, at)
            upto = m.start() if m else len(source)
            if upto > at:
                run = html.unescape(source[at:upto])
                text.append(run)
                if links:
                    linked += len(run)
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag not in INLINE:
                    flush()
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == tag:
                        close(k)
                        break
                    # An inline end tag does not close the blocks around it.
                    if tag in INLINE and self.tag[stack[k]] not in INLINE:
                        break
                continue
            if tag == "br":
                text.append(" ")
                continue
            attributes = _attributes(m[3]) if m[3] and m[3] != "/" else {}
            if tag in RAW:
                flush()
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                if m[3].endswith("/") and tag in ("svg", "iframe"):
                    continue
                at = end.end() if end else len(source)
                continue
            if tag not in INLINE:
                flush()
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    name = self.tag[stack[k]]
                    if name == "p":
                        close(k)
                        break
                    if name not in INLINE:
                        break
            if tag in ENDS_SAME:
                for k in range(len(stack) - 1, 0, -1):
                    name = self.tag[stack[k]]
                    if name == tag or tag in ("dt", "dd") and name in ("dt", "dd") or tag in ("td", "th") and name in ("td", "th"):
                        close(k)
                        break
                    if name in ENDS_SAME[tag]:
                        break
            if tag in VOID:
                continue
            node = len(self.tag)
            self.parent.append(stack[-1])
            self.tag.append(tag)
            own = _role(tag, attributes)
            self.role.append(own)
            # Names with digits are often those of one page.
            names = [f".{c}" for c in sorted(set(attributes.get("class", "").split()))] + [f"#{attributes.get('id', '')}"]
            self.path.append(f"{self.path[stack[-1]]}/{tag}" + "".join(n for n in names if len(n) > 1 and not _DIGIT.search(n)))
            stack.append(node)
            links += tag == "a"
        flush()

    def owners(self, node: int) -> Iterator[int]:
        while node > 0:
            yield node
            node = self.parent[node]


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


#: Template tags stand on so many of 100 pages of the host.
SUPPORT = 60


def tokens(pages: DataFrame) -> DataFrame:
    """(host, path, pages, times, vector, place, chars, linked, role): sums over the pages of a host.

    vector is the fingerprint of the occurrence vector: a sum of hashes of page and number of times.
    place sums where on the page the tag stands first, so that classes can be ordered.
    """
    fields = "host string, path string, role string, pages long, times long, vector long, place double, chars long, linked long, total long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sums: dict[tuple[str, str, str], list] = {}
            for url, source, row in zip(*(batch.column(c).to_pylist() for c in ("url", "html", "row")), strict=True):
                page = Page(source or "")
                host = host_of(url)
                seen: dict[tuple[str, str], list] = {("", PLAIN): [1, 0.0, 0, 0]}
                for k in range(1, len(page.tag)):
                    path = page.path[k]
                    if page.tag[k] in INLINE:
                        continue
                    entry = seen.setdefault((path, page.role[k]), [0, k / len(page.tag), 0, 0])
                    entry[0] += 1
                for block in page.blocks:
                    for k in page.owners(block.node):
                        entry = seen.get((page.path[k], page.role[k]))
                        if entry:
                            entry[2] += len(block.text)
                            entry[3] += block.linked
                identity = xxhash.xxh3_64_intdigest(str(row))
                for (path, role), (times, place, chars, linked) in seen.items():
                    total = sums.setdefault((host, path, role), [0, 0, 0, 0.0, 0, 0])
                    total[0] += 1
                    total[1] += times
                    total[2] = (total[2] + identity * (2 * times + 1)) & 0xFFFFFFFFFFFFFFFF
                    total[3] += place
                    total[4] += chars
                    total[5] += linked
            rows = [(*k, *v) for k, v in sums.items()]
            if rows:
                host, path, role, n, times, vector, place, chars, linked = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(host), pa.array(path), pa.array(role), pa.array(n, pa.int64()), pa.array(times, pa.int64()),
                        pa.array(np.array(vector, np.uint64).view(np.int64)), pa.array(place), pa.array(chars, pa.int64()),
                        pa.array(linked, pa.int64()), pa.array([c * (p == "") for c, p in zip(n, path, strict=True)], pa.int64()),
                    ],
                    ["host", "path", "role", "pages", "times", "vector", "place", "chars", "linked", "total"],
                )

    named = pages.select("url", "html", F.monotonically_increasing_id().alias("row")).mapInArrow(run, fields)
    # Sums of hashes wrap around: they are added as two halves, which cannot overflow.
    half = named.withColumn("low", F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF))).withColumn("high", F.shiftright("vector", 32))
    names = ("pages", "times", "place", "chars", "linked", "total")
    return half.groupBy("host", "path", "role").agg(*[F.sum(c).alias(c) for c in names], F.sum("low").alias("low"), F.sum("high").alias("high"))


def _template(rows: list[dict]) -> str:
    """The path of the article slot in the template that a host's valid classes make up."""
    total = max((r["total"] for r in rows if r["path"] == ""), default=0)
    if not total:
        total = max((r["pages"] for r in rows), default=1)
    often = [r for r in rows if r["path"] and 100 * r["pages"] >= SUPPORT * total]
    classes: dict[tuple, list[dict]] = {}
    for r in often:
        classes.setdefault((r["low"], r["high"], r["times"]), []).append(r)
    valid: set[str] = {""}
    # Classes nest: a tag holds if the tag around it is template too, in whatever class that is, so
    # classes are gone through until none of them takes in another tag.
    waiting = sorted(classes.values(), key=lambda c: (-c[0]["pages"], min(m["place"] for m in c)))
    grown = True
    while grown:
        grown = False
        for members in waiting:
            for r in sorted(members, key=lambda m: m["path"].count("/")):
                if r["path"] not in valid and r["path"].rpartition("/")[0] in valid:
                    valid.add(r["path"])
                    grown = True
    inside = [r for r in often if r["path"] in valid]
    # A frame slot is a path and a role: other tags on its path are none. What is below is, unless
    # tags with the role and without it share the path.
    plain = {r["path"] for r in inside if r["role"] != FRAMED}
    framed = {r["path"] for r in inside if r["role"] == FRAMED} - plain
    outside_frame = [
        r for r in inside
        if r["role"] != FRAMED and not any(r["path"] == f or r["path"].startswith(f + "/") for f in framed)
    ]
    article = ""
    for wanted in (ARTICLE, MAIN):
        fit = [r for r in outside_frame if r["role"] == wanted and r["chars"] > 0]
        if fit:
            # The slot with the most text that is not linked; the outermost of equals.
            article = max(fit, key=lambda r: (r["chars"] - r["linked"], -r["path"].count("/")))["path"]
            break
    if not article:
        # No element says so: go down from the whole page while one tag keeps most of the plain text.
        plain = {r["path"]: r["chars"] - r["linked"] for r in outside_frame if r["times"] == r["pages"]}
        article, held = "", max([r["chars"] - r["linked"] for r in outside_frame], default=0)
        while True:
            below = [(c, p) for p, c in plain.items() if p.rpartition("/")[0] == article and 10 * c >= 8 * held > 0]
            if not below or max(below)[1].rpartition("/")[2].split(".")[0] in ("p", "h1", "ul", "li"):
                break
            held, article = max(below)
    return article


def templates(pages: DataFrame) -> DataFrame:
    """(host, article) of each host. A host has a bounded number of template tags, not of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows[0]["host"]]), pa.array([_template(rows)])], ["host", "article"])

    counted = tokens(pages)
    total = counted.filter("path = ''").select("host", F.col("total").alias("all"))
    # Only tags that stand on most pages can be template; the others never reach the grouping.
    common = counted.join(materialize(total, "hosts"), "host").filter(100 * F.col("pages") >= SUPPORT * F.col("all")).drop("all")
    return materialize(common.groupBy("host").applyInArrow(run, "host string, article string"), "templates")


def article_text(source: str | None, article: str) -> str:
    """Blocks of a page inside its host's article slot and outside elements that belong to the frame."""
    page = Page(source or "")
    state = [0] * len(page.tag)  # 1: in the article slot, 2: in a frame slot
    slots = {k for k in range(1, len(page.tag)) if page.path[k] == article and page.role[k] != FRAMED}
    # A page that does not follow the template, or whose template has no slot within the page, says
    # itself where its article is.
    if all(page.tag[k] in ("html", "body") for k in slots):
        own = {k for k in range(1, len(page.tag)) if page.role[k] == ARTICLE}
        slots = own or {k for k in range(1, len(page.tag)) if page.role[k] == MAIN} or slots
    everywhere = not slots
    for k in range(1, len(page.tag)):
        up = state[page.parent[k]]
        inside = up in (1, 3) or k in slots
        frame = page.role[k] == FRAMED
        # A header inside the article is the article's own, that of the page is not.
        if page.tag[k] == "header" and inside and any(page.role[o] in (ARTICLE, MAIN) for o in page.owners(page.parent[k])):
            frame = False
        if k in slots:
            state[k] = 1
        elif up == 2 or frame:
            state[k] = 2
        else:
            state[k] = 1 if inside else 0
    keep = (lambda s: s != 2) if everywhere else (lambda s: s == 1)
    return " ".join(b.text for b in page.blocks if keep(state[b.node]))


#: Templates of more hosts than this are joined by shuffle.
BROADCAST_HOSTS = 50_000


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), a row per row of pages.

    Null or empty html has an empty text; pages with a null or odd url share one host without a
    name; repeated rows count as pages of their own and get equal texts; a host with one page has
    that page's own structure as template. Columns other than page_id, url and html are not read.
    """
    found = templates(pages).withColumnRenamed("host", "h")
    if found.count() <= BROADCAST_HOSTS:
        found = F.broadcast(found)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("html", "article"))
            texts = [article_text(h, a or "") for h, a in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return (
        pages.select("page_id", "url", "html")
        .join(found, host == F.col("h"), "left")
        .select("page_id", "url", "html", "article")
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
    )
