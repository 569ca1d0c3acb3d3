"""Main text of pages by wrappers inferred for each host.

A wrapper is a regular expression without unions over tags and texts, written as a tree: each node says
whether it is optional, whether it repeats, and whether its own text is fixed or a slot. Within a page equal
neighbours fold into a repeated group, and what only some of them hold is optional. The wrapper of a host starts
as the folded token stream that most of its pages have. Each page's stream is aligned with it in order: what
a page lacks or has besides is optional, what repeats in a page is repeated, what has unlike texts is a slot.
Pages are aligned one by one and summed up in Spark, so no task holds a whole host.

The region of a host's content is what holds the most text: its ``article`` elements, the ``main`` one, or,
where neither does, the smallest region around all its slots and optional parts. All text of the region is
read, whether or not other pages have it too, but for what is boilerplate by kind of element, class or role.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.ship import ship
from tallyloom.llm.written import written

HELD = 100_000  # places that a task holds before it tells them
SPREAD = 16  # parts of a host's pages that meet its rule in different tasks
MOST_DEPTH = 64  # of wrapper nodes; deeper elements belong to the node at this depth

# Element kinds and names of page parts as HTML and common practice define them.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol",
    "p", "pre", "section", "table", "ul",
}
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
GROUPS = {"aside", "div", "footer", "header", "nav", "ol", "section", "ul"}
SCOPES = {"article", "body", "div", "html", "main", "ol", "section", "table", "ul", "dl", "aside", "nav", "td"}
FLOWING = INLINE | RAW | VOID - {"hr"}  # what doesn't end a block
DROPPED = RAW | {
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "svg", "menu",
    "dialog", "object", "canvas", "audio", "video",
}
DROPPED_NAMES = {
    "ad", "ads", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "contentinfo", "consent", "cookie", "cookies", "disqus", "dialog",
    "disclaimer", "footer", "form", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "popup", "promo", "promoted", "related", "replies", "respond", "search", "share",
    "sharing", "sidebar", "sidenav", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}

# What may stand before or after such a name in a class: cookie-notice, site-footer, share-buttons.
NAME_PARTS = {
    "area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "container", "content", "fixed",
    "global", "group", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "overlay", "page",
    "panel", "post", "primary", "right", "secondary", "section", "site", "slot", "sticky", "thread", "top", "unit",
    "wrap", "wrapper",
}
HEADER_NAMES = {"header", "masthead"}
COMMENT_NAMES = {"comment", "comments", "disqus", "replies", "reply", "respond"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_NAME = re.compile(r"[a-z]+")


def host_of(url: str = "url"):
    """Host of a URL column in lower case without a port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#:]*)", 1))


def _says(names: list[str], known: set[str]) -> bool:
    """Whether a class or role is one of the names, alone or with parts that go with them."""
    for name in names:
        parts = _NAME.findall(name)
        if any(p in known for p in parts) and all(p in DROPPED_NAMES or p in NAME_PARTS for p in parts):
            return True
    return False


def _kind(tag: str, attributes: str) -> tuple[str, str]:
    """The node's key, tag and classes, and what it is: "" for content, "hidden", "header", "comment" for reader
    comments, or "part" for other boilerplate, by its kind, its class or role, or its whole id."""
    names: list[str] = []
    ids: list[str] = []
    hidden = False
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = hidden or (tag not in ("html", "body") and value != "false")
            elif name in ("class", "role"):
                names += value.split()
            elif name == "id":
                ids.append(value)
    key = tag + "".join(f".{n}" for n in sorted(set(names)) if not any(c.isdigit() for c in n))
    if hidden or tag in RAW:
        return key, "hidden"
    if tag in ("html", "body"):
        return key, ""
    ids = ids if tag in GROUPS else []  # of a heading or paragraph an id is a slug of its text
    if _says(names, COMMENT_NAMES) or any(i in COMMENT_NAMES for i in ids):
        return key, "comment"
    if tag == "header" or _says(names, HEADER_NAMES):
        return key, "header"
    if tag in DROPPED:
        return key, "part"
    if tag not in ("article", "main") and (_says(names, DROPPED_NAMES) or any(i in DROPPED_NAMES for i in ids)):
        return key, "part"
    return key, ""


ARTICLE, MAIN, ELSEWHERE = range(3)


def place_of(tag: str, around: int) -> int:
    """Where an element's text stands, given where the element does."""
    return ARTICLE if tag == "article" else min(around, MAIN) if tag == "main" else around


def goes(what: str, tag: str, around: int) -> bool:
    """Whether a node of a kind is left out. The header of an article or main stays, and so does an article that
    is in no other, whatever its class says."""
    if what == "header":
        return around == ELSEWHERE and tag not in ("article", "main")
    if what == "comment":
        return around == ARTICLE or tag not in ("article", "main")
    return bool(what)


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("open", key, kind), ("close", tag, _) and ("text", raw text, _) with implied closes.

    Elements without an end close with their parent or where HTML implies it; stray ends are ignored. The
    content of scripts, styles and the like is not looked into. A tag cut off at the end is dropped.
    """
    stack: list[str] = []
    at = 0

    def close(place: int) -> Iterator[tuple[str, str, str]]:
        while len(stack) > place:
            yield "close", stack.pop(), ""

    def last(tags: set[str], scopes: set[str]) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in tags:
                return i
            if stack[i] in scopes:
                return -1
        return -1

    while True:
        found = _TOKEN.search(page, at)
        if not found:
            yield "text", page[at:], ""
            break
        if found.start() > at:
            yield "text", page[at : found.start()], ""
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            place = last({tag}, SCOPES - {tag} if tag in INLINE or tag == "p" else set())
            if place >= 0:
                yield from close(place)
            continue
        if tag in CLOSES_P and (place := last({"p"}, SCOPES)) >= 0:
            yield from close(place)
        if tag in SIBLINGS and (place := last(SIBLINGS[tag], {"table", "ul", "ol", "dl", "select"})) >= 0:
            yield from close(place)
        key, what = _kind(tag, found[3])
        yield "open", key, what
        if tag in VOID or found[3].endswith("/"):
            yield "close", tag, ""
            continue
        stack.append(tag)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end.start() if end else len(page)
            yield from close(len(stack) - 1)
    yield from close(0)


def read_page(page: str, roots: frozenset[str] | set[str]) -> str | None:
    """The text of the content regions, a line for each block; None if the page has no such region.

    Regions are paths, or tags for all elements of a kind; without one it is the whole page.
    """
    blocks: list[str] = []
    block: list[str] = []
    stack: list[tuple[str, bool, bool, int, str]] = []  # path, inside a region, left out, place, tag
    seen = not roots

    def flush() -> None:
        if block:
            whole = " ".join("".join(block).split())
            block.clear()
            if whole:
                blocks.append(whole)

    for what, value, kind in events(page):
        if what == "open":
            path, inside, gone, place, _ = stack[-1] if stack else ("", not roots, False, ELSEWHERE, "")
            path = f"{path}/{value}" if len(stack) < MOST_DEPTH else path
            tag = value.split(".", 1)[0]
            gone = gone or goes(kind, tag, place)
            inside = inside or (not gone and (path in roots or tag in roots))
            seen = seen or inside
            if tag == "br":
                block.append(" ")
            elif tag not in FLOWING:
                flush()
            stack.append((path, inside, gone, place_of(tag, place), tag))
        elif what == "close":
            *_, tag = stack.pop()
            if tag not in FLOWING:
                flush()
        else:
            _, inside, gone, *_ = stack[-1] if stack else ("", not roots, False, ELSEWHERE, "")
            if inside and not gone:
                block.append(html.unescape(value))
    flush()
    return "\n".join(blocks) if seen else None


REPEATED, OPTIONAL = 1, 2  # flags of a token: [path, hash of its texts, flags]


def places(wrapper: Sequence[str], stream: Sequence[str]) -> list[tuple[int, bool]]:
    """For each path of a stream, its place in the wrapper and whether it is inserted after that place.

    The k-th occurrences of a path may match; of these, the longest run that is in order in both does.
    """
    seen: Counter[str] = Counter()
    known = {}
    for i, path in enumerate(wrapper):
        known[path, seen[path]] = i
        seen[path] += 1
    seen.clear()
    ends: list[int] = []  # the least place that ends an ordered run of each length, and where in the stream it is
    holders: list[int] = []
    before = [-1] * len(stream)
    found = []
    for i, path in enumerate(stream):
        found.append(known.get((path, seen[path]), -1))
        seen[path] += 1
        if found[i] >= 0:
            k = bisect_left(ends, found[i])
            before[i] = holders[k - 1] if k else -1
            ends[k:k + 1], holders[k:k + 1] = [found[i]], [i]
    matched = set()
    i = holders[-1] if holders else -1
    while i >= 0:
        matched.add(i)
        i = before[i]
    last, out = -1, []
    for i, at in enumerate(found):
        last = at if i in matched else last
        out.append((last, i not in matched))
    return out


def fold(one: list[list], two: list[list]) -> list[list] | None:
    """The repeated group of two neighbours' tokens if one has all of the other's; what it has besides is optional."""
    at = places([x[0] for x in one], [x[0] for x in two])
    if sum(not inserted for _, inserted in at) < min(len(one), len(two)):
        return None
    met = {i: token for (i, inserted), token in zip(at, two, strict=True) if not inserted}
    after: dict[int, list[list]] = {}
    for (i, inserted), (path, text, flags) in zip(at, two, strict=True):
        if inserted:
            after.setdefault(i, []).append([path, text, flags | REPEATED | OPTIONAL])
    out = after.get(-1, [])
    for i, (path, text, flags) in enumerate(one):
        if i in met:
            text, flags = xxhash.xxh3_64_hexdigest(text + met[i][1]), flags | met[i][2] | REPEATED
        else:
            flags |= REPEATED | OPTIONAL
        out.append([path, text, flags])
        out += after.get(i, [])
    return out


def page_stream(page: str) -> tuple[list[list], list[int]]:
    """The tokens [path, hash of texts, flags] of a page's texts in order, equal neighbours folded, and the length
    of text in articles, in main outside them, and elsewhere. What is boilerplate by its kind is in neither."""
    sizes = [0, 0, 0]
    # path, left out, place, (key, tokens) of each child
    stack: list[tuple[str, bool, int, list[tuple[str, list[list]]]]] = [("", False, ELSEWHERE, [])]
    for what, value, kind in events(page):
        path, gone, place, items = stack[-1]
        if what == "open":
            tag = value.split(".", 1)[0]
            gone = gone or goes(kind, tag, place)
            path = f"{path}/{value}" if len(stack) <= MOST_DEPTH else path
            stack.append((path, gone, place_of(tag, place), []))
        elif what == "close":
            stack.pop()
            tokens = items[0][1] if len(items) == 1 else [x for _, held in items for x in held]
            around = stack[-1][3]
            if tokens and around and around[-1][0] == path and (group := fold(around[-1][1], tokens)):
                around[-1] = (path, group)
            elif tokens:
                around.append((path, tokens))
        elif text := "" if gone else " ".join(value.split()):
            sizes[place] += len(text)
            digest = xxhash.xxh3_64_hexdigest(text)
            if items and not items[-1][0]:  # one text that a comment or a line end cuts
                token = items[-1][1][0]
                token[1] = xxhash.xxh3_64_hexdigest(token[1] + digest)
            else:
                items.append(("", [[path, digest, 0]]))
    return [x for _, held in stack[0][3] for x in held], sizes


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens, sizes = page_stream(page)
            rows.append((host, *([x[i] for x in tokens] for i in range(3)), *sizes))
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
        text, flags, n = pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64()
        kinds = (pa.string(), text, text, flags, n, n, n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["host", "paths", "texts", "flags", "article", "main", "other"],
        )


_NODES = pa.schema(
    [
        ("host", pa.string()), ("place", pa.int64()), ("inserted", pa.bool_()), ("path", pa.string()),
        ("low", pa.string()), ("high", pa.string()), ("n", pa.int64()), ("flags", pa.int64()),
    ]
)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each place of a host's wrapper, or inserted after it, that a page of the task has."""
    nodes: dict[tuple[str, int, bool, str], list] = {}
    met: dict[tuple, list[tuple[int, bool]]] = {}

    def told() -> pa.RecordBatch:
        rows = [(*key, *have) for key, have in nodes.items()]
        nodes.clear()
        met.clear()
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _NODES]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _NODES, strict=True)], schema=_NODES
        )

    for batch in batches:
        for host, paths, texts, flags, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = (host, tuple(paths))
            if key not in met:
                met[key] = places(wrapper, paths)
            own: dict[tuple[str, int, bool, str], list] = {}
            for (place, inserted), path, text, flag in zip(met[key], paths, texts, flags, strict=True):
                known = own.get((host, place, inserted, path))
                if known:  # inserted more than once at a place
                    text, flag = xxhash.xxh3_64_hexdigest(known[0] + text), known[1] | flag | REPEATED
                own[host, place, inserted, path] = [text, flag]
            for node, (text, flag) in own.items():
                have = nodes.setdefault(node, [text, text, 0, 0])
                have[0], have[1] = min(have[0], text), max(have[1], text)
                have[2] += 1
                have[3] |= flag
            if len(nodes) + len(met) > HELD:  # what is told early is summed up later
                yield told()
    yield told()


def aligned(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The wrapper of each host as rows in order of ``place``: host, path, ``n`` pages that have it, ``optional``,
    ``repeated``, ``slot``, and ``inserted`` for what stands after the place on some pages; and a row without a
    path with the host's pages with text and its lengths of text in ``article``, ``main``, ``other``."""
    ship(spark)
    streams = pages.select(host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html")).mapInArrow(
        _streams,
        "host string, paths array<string>, texts array<string>, flags array<int>, article long, main long, other long",
    )
    streams = written(spark, streams, "streams")
    some = streams.where("size(paths) > 0")
    usual = some.groupBy("host", "paths").count().groupBy("host")
    usual = usual.agg(F.max(F.struct("count", F.size("paths"), "paths")).alias("u")).select("host", "u.paths")
    usual = written(spark, usual, "usual-streams").withColumnRenamed("paths", "wrapper")
    usual = usual.withColumn("part", F.expr(f"explode(sequence(0, {SPREAD - 1}))"))
    parted = some.withColumn("part", F.pmod(F.xxhash64("texts"), F.lit(SPREAD)).cast("int"))
    nodes = (
        parted.join(usual, ["host", "part"])
        .select("host", "paths", "texts", "flags", "wrapper")
        .mapInArrow(
            _align, "host string, place long, inserted boolean, path string, low string, high string, n long, flags long"
        )
        .groupBy("host", "place", "inserted", "path")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.bit_or("flags").alias("flags"))
    )
    totals = streams.groupBy("host").agg(
        F.expr("count_if(size(paths) > 0)").alias("pages"), *[F.sum(c).alias(c) for c in ("article", "main", "other")]
    )
    totals = written(spark, totals, "hosts")
    shape = nodes.join(totals, "host").selectExpr(
        "host", "place", "inserted", "path", "n", "pages", f"n < pages or flags & {OPTIONAL} > 0 as optional",
        f"flags & {REPEATED} > 0 as repeated", "low < high as slot", "article", "main", "other",
    )
    whole = totals.selectExpr("host", "pages as n", "pages", "article", "main", "other")
    return written(spark, shape.unionByName(whole, allowMissingColumns=True), "wrappers")


def wrappers(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per host: host, the number of its pages with text, and its rule, the content regions as JSON.

    Articles are the content if they hold as much text as the rest of the pages; else main elements, if they
    hold more than what is outside both; else the smallest region around the host's slots and optional
    parts. Pages that all show the same text have neither, and their rule is the whole page.
    """
    shape = aligned(spark, pages)
    hosts = shape.where("path is null").select("host", "n", "article", "main", "other")
    varying = shape.where("path is not null and (slot or n < pages)").groupBy("host")
    varying = varying.agg(F.min("path").alias("first"), F.max("path").alias("last"))
    # what the first and the last path in order share, all others do; the last part is a text's own element
    a, b = F.split("first", "/"), F.split("last", "/")
    shorter = F.least(F.size(a), F.size(b)) - 1
    differs = F.filter(F.sequence(F.lit(1), shorter), lambda i: F.element_at(a, i) != F.element_at(b, i))
    length = F.when(shorter < 1, 0).otherwise(F.coalesce(F.get(differs, F.lit(0)) - 1, shorter))
    region = F.array_join(F.slice(a, F.lit(1), length), "/")
    varying = varying.select("host", region.alias("region"))
    rule = (
        F.when(F.expr("article > 0 and article >= main + other"), F.array(F.lit("article")))
        .when(F.expr("main + article > 0 and main > 0 and main + article >= other"), F.array(F.lit("main")))
        .when(F.col("region") != "", F.array("region"))
        .otherwise(F.array().cast("array<string>"))
    )
    return hosts.join(varying, "host", "left").select("host", F.col("n").alias("pages"), F.to_json(rule).alias("rule"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for rule, page in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            text = read_page(page, frozenset(json.loads(rule)))
            texts.append(read_page(page, frozenset()) if text is None else text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if there is none) and n_chars, its code points.

    Null or empty html gives an empty text; pages without a URL or host form one group; repeated rows give
    equal texts each. A page that has none of its host's content regions is read as a whole, without
    boilerplate. An empty table gives no rows; further columns are ignored.
    """
    rules = wrappers(spark, pages).select("host", "rule")
    rules = written(spark, rules, "rules")
    usual = rules.groupBy("rule").count().orderBy(F.desc("count"), "rule").head()
    usual = usual.rule if usual else "[]"
    # Hosts share few rules; only those with another than the usual one have to meet their pages.
    other = written(spark, rules.where(F.col("rule") != usual), "other-rules")
    other = other.withColumn("part", F.expr(f"explode(sequence(0, {SPREAD - 1}))"))
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        host_of().alias("host"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)).cast("int").alias("part"),
    )
    return (
        rows.join(other, ["host", "part"], "left")
        .select("page_id", "url", F.coalesce("rule", F.lit(usual)).alias("rule"), "html")
        .mapInArrow(_read, f"page_id {kind}, url string, text string, n_chars long")
    )
