"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged into one tree: a node is a path of tags with their classes.
For each node the tree counts the presentation styles (child sequences) and the contents (block
texts) that pages show there. Presentation importance is the entropy of the styles to the base of
the number of pages; content importance is one minus the mean, over contents, of the logarithm of
the pages that repeat it, to that base. A node's importance mixes its own presentation with the
contents of all leaves below it; a block's importance is that of its node or, where that is less, of
its own text there. Blocks that repeat from page to page come out low and are removed.

Every block enters the tree. What markup says is a prior that the block's importance is added to
(PRIOR): blocks inside an article or main element must repeat more to be removed, blocks outside it,
in a page that has one, must vary from page to page to be kept. One rule stands alone: scripts, menus, footers,
forms and branches with a class or id that is the name of such a part never count as text, for ads and
comments vary as text does; those whose class or id only contains such a name (site-header,
with-sidebar) count from an article or main element on. The tree has a verdict where the host has
MIN_PAGES pages with that node; elsewhere the prior decides. A page that would lose all its blocks keeps
those of its prior.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetmill.llm import common

MIN_PAGES, LEAST, OWN_SHARE, DEEPEST = 8, 0.3, 0.25, 40
#: What markup says of a block, and what that adds to its importance.
NEVER, OUTSIDE, OPEN, ARTICLE = range(4)
PRIOR = {OUTSIDE: -0.5, OPEN: 0.0, ARTICLE: 0.15}
#: Rows of statistics a task holds before it hands them on.
FLUSH = 100_000

#: Element kinds.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "noframes", "select", "object"}
NOISE = {"nav", "footer", "aside", "form", "menu", "head", "button", "dialog", "label", "fieldset"}
NOISE_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "notice",
    "alert", "popup", "modal", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "footer",
    "comment", "comments", "disqus", "respond", "replies", "share", "sharing", "social", "related", "recommended", "newsletter",
    "subscribe", "signup", "login", "search", "pagination", "pager", "widget", "toolbar", "copyright",
}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
#: What a start tag ends when it stands open just above.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# an attempt ends at the next tag, so that tags that are never closed cost no more than their length
_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>|[!?/][^<>]*+>)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", re.I)
_WORD = re.compile(r"[a-z]+")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def parse(page: str | None) -> tuple[list[tuple[str, str, bool]], dict[str, str]]:
    """What the rules alone keep: blocks (path, text, open) in page order, and the child sequence of
    each element's path. `open` blocks are those of pages without an article."""
    blocks, styles = walk(page)
    least = max((x[2] for x in blocks), default=NEVER)
    return [(p, t, least == OPEN) for p, t, level in blocks if level and level == least], styles


def walk(page: str | None) -> tuple[list[tuple[str, str, int]], dict[str, str]]:
    """All blocks (path, text, what markup says) in page order, and the child sequence of each
    element's path."""
    page = page or ""
    blocks: list[tuple[str, str, int]] = []
    styles: dict[str, list[str]] = {}
    # tag, path, dropped (2; 1: up to the next article), in the article, dropped within a line of text
    stack: list[tuple[str, str, int, bool, bool]] = [("", "", 0, False, False)]
    text: list[str] = []
    pos, last = 0, page.rfind(">")  # behind it no tag ends
    standing: Counter = Counter()  # open elements by tag

    def end_block() -> None:
        if text:
            said = " ".join("".join(text).split())
            text.clear()
            if said:
                blocks.append((stack[-1][1], said, NEVER if stack[-1][2] else ARTICLE if stack[-1][3] else OPEN))

    def close() -> None:
        standing[stack.pop()[0]] -= 1

    while pos <= last and (m := _TAG.search(page, pos)):
        if m.start() > pos and not stack[-1][4]:
            text.append(entities.unescape(page[pos : m.start()]))
        pos, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCK:
                end_block()
            if standing[tag]:
                found = False
                while not found:
                    found = stack[-1][0] == tag
                    if stack[-1][0] in BLOCK:
                        end_block()
                    close()
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, pos)
                pos = end.end() if end else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            end_block()
            while stack[-1][0] not in BLOCK and standing["p"]:
                close()  # an open paragraph ends here, and what is open in it
            if stack[-1][0] == "p":
                close()
            if stack[-1][0] in ENDS.get(tag, ()):
                close()
        if tag in VOID:
            continue
        attrs = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTR.findall(m[3])} if "=" in m[3] else {}
        marks = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()
        names = [w for t in marks for w in _WORD.findall(t)]
        _, path, above, inside, mute = stack[-1]
        dropped = above
        own = tag + ("." + ".".join(names[:4]) if names else "")
        styles.setdefault(path, []).append(own)
        role = attrs.get("role", "").lower()
        starts = tag in ("article", "main") or role == "main"
        inside = inside or starts
        if tag in NOISE or tag == "header" and not inside or role in NOISE_ROLES or tag not in ("html", "body") and not NOISE_WORDS.isdisjoint(marks):
            dropped = 2
        elif starts and dropped < 2:
            dropped = 0
        elif tag not in ("html", "body") and not NOISE_WORDS.isdisjoint(names):
            dropped = max(dropped, 1)
        if above and not dropped:
            end_block()
        mute = tag not in BLOCK and (mute or bool(dropped) and not above)
        # branches below DEEPEST share their node
        standing[tag] += 1
        stack.append((tag, f"{path}/{own}" if len(stack) <= DEEPEST else path, dropped, inside, mute))
    if not stack[-1][4]:
        text.append(entities.unescape(page[pos:]))
    end_block()
    if any(x[2] == ARTICLE for x in blocks):
        blocks = [(p, t, OUTSIDE if level == OPEN else level) for p, t, level in blocks]
    return blocks, {k: " ".join(dict.fromkeys(v)) for k, v in styles.items()}


def _parsed(pages: DataFrame) -> DataFrame:
    """One row for each page (blocks), and rows of statistics (host, path, kind, value, n)."""
    from xxhash import xxh3_64_intdigest

    ddl = ("row string, page_id long, url string, host string, blocks array<struct<path:string,text:string,level:int,value:long>>, "
           "path string, kind string, value long, n long")
    schema = common.arrow_schema(ddl)

    def run(batches):
        import uuid

        own, seen = uuid.uuid4().hex[:12], 0
        counts: Counter = Counter()

        def stats():
            out = [(None, None, None, h, None, p, k, v, n) for (h, p, k, v), n in counts.items()]
            counts.clear()
            return common.batch(out, schema)

        for b in batches:
            rows: list[tuple] = []
            for i, url, page in zip(*(b[c].to_pylist() for c in ("page_id", "url", "html")), strict=True):
                blocks, styles = walk(page)
                values = [xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 for _, t, _ in blocks]
                host = host_of(url)
                seen += 1
                rows.append((f"{own}-{seen}", i, url, host, [{"path": p, "text": t, "level": k, "value": v} for (p, t, k), v in zip(blocks, values, strict=True) if k], None, None, None, None))
                for path, style in styles.items():
                    counts[host, path, "style", xxh3_64_intdigest(style.encode()) >> 1] += 1
                for path, value in {(b[0], v) for b, v in zip(blocks, values, strict=True)}:
                    counts[host, path, "text", value] += 1
                for path in {p for p, _, _ in blocks}:
                    counts[host, path, "leaf", 0] += 1
                for path in {p for p, _, k in blocks if k == OUTSIDE}:
                    counts[host, path, "outside", 0] += 1
                if len(rows) >= 500:
                    yield common.batch(rows, schema)
                    rows = []
                if len(counts) > FLUSH:
                    yield stats()
            yield common.batch(rows, schema)
        yield stats()

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, ddl)


def style_tree(stats: DataFrame) -> DataFrame:
    """host, path, pages, importance of every node of the site style trees."""
    counts = stats.groupBy("host", "path", "kind", "value").agg(F.sum("n").alias("n"))
    nodes = counts.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("m"), F.count("*").alias("l"), F.sum(F.col("n") * F.log("n")).alias("nlogn"), F.sum(F.log("n")).alias("logn"))
    m, base = F.col("m"), F.log("m")
    own = nodes.where("kind = 'style'").select("host", "path", "m", F.when(m > 1, (base - F.col("nlogn") / m) / base).otherwise(1.0).alias("style"))
    pages = nodes.where("kind = 'leaf'").select("host", "path", "m")
    leaf = nodes.where("kind = 'text'").select("host", "path", "l", "logn").join(pages, ["host", "path"]).select(
        "host", "path", "m", F.when(m > 1, 1 - F.col("logn") / F.col("l") / base).otherwise(1.0).alias("content"))
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    below = leaf.select("host", F.explode(above).alias("path"), "m", "content").groupBy("host", "path").agg(
        F.max("m").alias("leaf_pages"), (F.sum(F.col("content") * F.col("m")) / F.sum("m")).alias("content"))
    both = below.join(own, ["host", "path"], "left")
    mixed = F.when(F.col("style").isNull(), F.col("content")).otherwise(OWN_SHARE * F.col("style") + (1 - OWN_SHARE) * F.col("content"))
    return both.select("host", "path", F.greatest("leaf_pages", F.coalesce("m", F.lit(0))).alias("pages"), mixed.alias("importance"))


def verdicts(stats: DataFrame) -> DataFrame:
    """key, importance: the nodes and the texts at a node that come out too low for a page to keep
    them, and the nodes that have blocks outside an article, which need a verdict to be kept.

    A key is the hash of host and path, with the text's own hash where it speaks of one text."""
    nodes = style_tree(stats).where(F.col("pages") >= MIN_PAGES)
    outside = stats.where("kind = 'outside'").select("host", "path").distinct().withColumn("outside", F.lit(True))
    nodes = nodes.join(outside, ["host", "path"], "left").where((F.col("importance") < LEAST) | F.col("outside"))
    pages = stats.where("kind = 'leaf'").groupBy("host", "path").agg(F.sum("n").alias("pages")).where(F.col("pages") >= MIN_PAGES)
    texts = stats.where("kind = 'text'").groupBy("host", "path", "value").agg(F.sum("n").alias("n")).where("n > 1")
    texts = texts.join(pages, ["host", "path"]).withColumn("importance", 1 - F.log("n") / F.log("pages"))
    texts = texts.join(outside, ["host", "path"], "left")
    bound = F.when(F.col("outside"), LEAST - PRIOR[OUTSIDE]).otherwise(LEAST)
    return nodes.select(F.xxhash64("host", "path").alias("key"), "importance").unionByName(
        texts.where(F.col("importance") < bound).select(F.xxhash64("host", "path", "value").alias("key"), "importance"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, one row for each row of pages.

    A null or empty html has an empty text; equal or null page_id stay apart; a url without a host
    joins the tree of the empty host."""
    parsed = common.table(_parsed(pages), "parsed")
    rows = parsed.where("row is not null").select("row", "page_id", "url", "host", "blocks")
    said = common.table(verdicts(parsed.where("row is null").select("host", "path", "kind", "value", "n")), "verdicts")
    node = lambda b: F.xxhash64("host", b["path"])
    own = lambda b: F.xxhash64("host", b["path"], b["value"])
    keys = F.array_distinct(F.flatten(F.transform("blocks", lambda b: F.array(node(b), own(b)))))
    asked = rows.select("row", F.explode(keys).alias("key")).join(said, "key")
    # only verdicts meet the pages: the table is small where little repeats, and then no text is shuffled
    met = common.table(asked.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("key", "importance"))).alias("said")), "met")
    out = rows.join(met, "row", "left")

    def keep(b):
        at, text = F.try_element_at("said", node(b)), F.try_element_at("said", own(b))
        least = F.least(F.coalesce(at, F.lit(1.0)), F.coalesce(text, F.lit(1.0)))
        prior = F.when(b["level"] == ARTICLE, F.lit(PRIOR[ARTICLE])).when(b["level"] == OPEN, F.lit(PRIOR[OPEN])).otherwise(F.lit(PRIOR[OUTSIDE]))
        return F.when((b["level"] == OUTSIDE) & at.isNull(), False).otherwise(least + prior >= LEAST)

    plain = F.filter("blocks", lambda b: b["level"] != OUTSIDE)
    kept = F.filter("blocks", keep)
    kept = F.when(F.col("said").isNull() | (F.size(kept) == 0), plain).otherwise(kept)
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return out.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
