"""Main text of web pages by a site style tree.

The DOMs of one host are merged into a style tree whose nodes are whole paths of elements, an element being its tag and the
words of its classes. Of every node the tree holds on how many different pages it stands, its layouts (the sequence of its
children's styles, repeats as one) and the texts of the blocks below it. Presentation importance is the entropy of its layouts
over the pages, to the base of their number; content importance is 1 less the mean entropy of its texts, log c / log m for a
text that stands on c of the node's m pages, weighted by occurrence. Both are combined as (1 - 0.9^l) presentation + 0.9^l
content for l kinds of children. A branch goes from every page if MIN_PAGES different pages show it and its own importance and
that of every block below it are less than LOW_IMPORTANCE.

Names are what the tree starts from: elements that are no text or are called menu, header, footer, sidebar, notice, advert,
form or comment by their tag, role or class (ids count on containers only) are presentation of importance 0, as reader comments
differ from page to page like articles do. Where `article` or `main` hold a third of what is left or more, the page's text is
what they hold. There a weak branch goes only if the main part around it is not weak as a whole, as it is where a host has
near copies of one page; and a page that would lose all its text keeps what names leave.

Blocks are trimmed, white space inside a block becomes one space, blocks are joined by a newline in page order. Null html
gives an empty text, a null or odd url the host ''; repeated rows give repeated rows; other columns are ignored. Equal html of
one host is one page to the tree, so copies never make a page a template; each row still gets its text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.llm.common import join_small, release, stored

LOW_IMPORTANCE = 0.3
MIN_PAGES = 5
FADE = 0.9
MAIN_SHARE = 3
#: Deeper elements belong to the node of their ancestor at this depth, as browsers do from 512 on.
MAX_DEPTH = 256
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_SKIP = set("script style noscript template iframe object svg canvas math head title select option textarea button input audio video datalist".split())
#: What may stand in a head; anything else ends it, as its end tag may be left out.
_IN_HEAD = set("base basefont bgsound link meta title style script noscript noframes template".split())
_BOILER = set("nav aside footer form menu dialog search".split())
_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NAMES = set(
    """ad ads adv advert adverts advertisement advertisements advertising adbox adsense sponsor sponsored sponsors promo promos promotion
    sidebar side rail menu menus nav navbar navigation topnav breadcrumb breadcrumbs footer foot header masthead topbar cookie cookies consent gdpr
    notice notices alert banner popup modal overlay newsletter subscribe subscription signup login search comment comments disqus respond replies
    share sharing social related recommended recommendations pager pagination widget widgets toc skip hidden""".split()
)
#: Words that stand beside such a word in the name of a box of that kind.
_BOXES = set("box bar list wrap wrapper links link buttons button section area container block inner outer content panel left right top bottom main primary secondary site page global form item items post posts article articles icons row col group unit slot thread".split())
_NEGATED = {"has", "with", "no", "without", "is"}
_TITLES = {"header", "masthead"}
_CONTAINERS = set("div section aside ul ol dl table nav header footer form fieldset".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_WORD = re.compile(r"[a-z]+")
_COMMENT_END = re.compile(r"--!?>|</(?:script|style)", re.I)


def _digest(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little", signed=True)


def _boilerplate_name(tag: str, names: list[str], in_main: bool) -> bool:
    """Whether a class or id marks boilerplate: outside the main part by its first or last word, inside on containers and by every word."""
    if tag in ("html", "body", "main") or in_main and tag not in _CONTAINERS and tag != "article":
        return False
    known = _NAMES - _TITLES if in_main else _NAMES
    for name in names:
        words = _WORD.findall(name)
        if not words or words[0] in _NEGATED:
            continue
        if name in known or tag != "article" and (words[0] in known or words[-1] in known) and (not in_main or all(w in known or w in _BOXES for w in words)):
            return True
    return False


class _Page(HTMLParser):
    """Text blocks of a page with their nodes from the root and kind: 0 boilerplate by name, 1 plain, 2 in the main part."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int, list[str]]] = []  # tag, node, kind or -1 for content that is no text, children's styles
        self.text: list[str] = []
        self.blocks: list[tuple[list[int], int, str]] = []
        self.layouts: set[tuple[int, int, int]] = set()

    def flush_block(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text.clear()
            if text and not (self.stack and self.stack[-1][2] < 0):
                kind = self.stack[-1][2] if self.stack else 1
                self.blocks.append((list(dict.fromkeys(node for tag, node, _, _ in self.stack if tag not in _INLINE)), kind, text))

    def close_from(self, start: int) -> None:
        """The elements from place `start` on end; each had a layout."""
        for k, (tag, node, kind, children) in enumerate(self.stack[start:], start):
            if tag not in _INLINE and kind >= 0 and k < MAX_DEPTH:
                self.layouts.add((node, _digest(children), len(set(children))))
        del self.stack[start:]

    def end_head(self, everything: bool) -> None:
        """Close an open head that has no end tag; with `everything` also what is left open in it."""
        places = [k for k, x in enumerate(self.stack) if x[0] == "head"]
        if places and (everything or places[-1] == len(self.stack) - 1):
            self.text.clear()
            self.close_from(places[0])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in _IN_HEAD:
            self.end_head(tag == "body")
        if tag == "br":
            self.text.append(" ")
        if tag in _VOID:
            if tag not in _INLINE:
                self.flush_block()
            return
        if tag not in _INLINE:
            self.flush_block()
            for k in range(len(self.stack) - 1, -1, -1):
                open_ = self.stack[k][0]
                if open_ == "p" and tag not in _SKIP or open_ in _CLOSED_BY.get(tag, ()):
                    self.close_from(k)
                    break
                if open_ not in _INLINE:
                    break
        got = {k: v or "" for k, v in attrs}
        classes = got.get("class", "").lower().split()
        names = classes + (got.get("id", "").lower().split() if tag in _CONTAINERS else [])
        parent = self.stack[-1][2] if self.stack else 1
        if parent < 0 or tag in _SKIP:
            kind = -1
        elif parent == 0 or tag in _BOILER or got.get("role", "").lower() in _ROLES or "hidden" in got or got.get("aria-hidden") == "true":
            kind = 0
        elif "none" in got.get("style", "") and re.search(r"display\s*:\s*none", got["style"]) or _boilerplate_name(tag, names, parent == 2):
            kind = 0
        elif tag == "header" and parent != 2:
            kind = 0
        else:
            kind = 2 if tag in ("article", "main") or got.get("role", "").lower() in ("main", "article") else parent
        if kind == -1 or kind == 0 and parent:
            self.flush_block()
        style = " ".join(sorted({w for n in classes for w in _WORD.findall(n)}))
        style = f"{tag}.{style}" if style else tag
        node = 0
        if tag not in _INLINE and kind >= 0:
            around = next((x for x in reversed(self.stack) if x[0] not in _INLINE), None)
            deep = len(self.stack) >= MAX_DEPTH
            node = around[1] if around and deep else _digest(around[1] if around else 0, style)
            if around and not deep and around[3][-1:] != [style]:
                around[3].append(style)
        self.stack.append((tag, node, kind, []))

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                if tag not in _INLINE or self.stack[k][2] != (self.stack[k - 1][2] if k else 1):
                    self.flush_block()
                self.close_from(k)
                return
            if tag in _INLINE and self.stack[k][0] not in _INLINE:
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.end_head(False)
        if not (self.stack and self.stack[-1][2] < 0):
            self.text.append(data)


def read_page(html: str | None) -> tuple[list[tuple[list[int], int, str]], set[tuple[int, int, int]]]:
    """Blocks (nodes from the root, kind, text) in page order; layouts (node, layout, kinds of children) of all elements."""
    page, html = _Page(), html or ""
    comment = html.rfind("<!--")
    if comment >= 0 and not _COMMENT_END.search(html, comment + 2):
        html = html[:comment]  # without an end a comment goes to the page's end
    page.feed(html)
    page.close()
    page.flush_block()
    page.close_from(0)
    return page.blocks, page.layouts


def parse_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, digest of the html, blocks and layouts of every page."""

    @F.pandas_udf("blocks array<struct<nodes array<long>, kind int, text string>>, layouts array<struct<node long, layout long, kinds int>>")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 500):
                got = [read_page(x) for x in part.iloc[at : at + 500]]
                held = [[{"nodes": n, "kind": k, "text": t} for n, k, t in blocks] for blocks, _ in got]
                seen = [[{"node": n, "layout": x, "kinds": k} for n, x, k in sorted(layouts)] for _, layouts in got]
                yield pd.DataFrame({"blocks": held, "layouts": seen})

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1), F.lit("")))
    rows = pages.select("page_id", "url", host.alias("host"), F.md5(F.col("html").cast("binary")).alias("digest"), read("html").alias("page"))
    return rows.select("page_id", "url", "host", "digest", "page.blocks", "page.layouts")


def style_tree(parsed: DataFrame) -> DataFrame:
    """Nodes of the merged trees: host, node, pages (different ones that show it), presentation, content, importance, best (below it)."""
    texts = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["nodes"].alias("nodes"), F.xxhash64(b["text"]).alias("t"))))
    pages = parsed.where("size(blocks) > 0").select("host", "digest", texts.alias("texts"), "layouts").dropDuplicates(["host", "digest"])
    nodes = F.array_distinct(F.flatten(F.transform("texts", lambda b: b["nodes"])))
    shown = pages.select("host", F.explode(nodes).alias("node")).groupBy("host", "node").agg(F.count("*").alias("pages"))
    # A text that stands on c of m pages has the entropy log c / log m.
    counts = pages.select("host", F.explode("texts").alias("b")).groupBy("host", "b.nodes", "b.t").agg(F.count("*").alias("c"))
    per = counts.groupBy("host", "nodes").agg(F.sum("c").alias("weight"), F.sum(F.col("c") * F.ln("c")).alias("h"))
    per = per.join(shown.select("host", F.col("node").alias("own"), "pages"), (per["host"] == shown["host"]) & (F.element_at("nodes", -1) == F.col("own"))).select(per["host"], "nodes", "weight", F.when(F.col("pages") > 1, F.col("h") / F.ln("pages")).otherwise(0.0).alias("h"))
    content = per.select("host", F.explode("nodes").alias("node"), "weight", "h").groupBy("host", "node").agg((1 - F.sum("h") / F.sum("weight")).alias("content"))
    styles = pages.select("host", F.explode("layouts").alias("x")).groupBy("host", "x.node", "x.layout", "x.kinds").agg(F.count("*").cast("double").alias("c"))
    styles = styles.groupBy("host", "node").agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.ln("c")).alias("h"), F.max("kinds").alias("kinds"))
    spread = F.when(F.col("all") > 1, (F.ln("all") - F.col("h") / F.col("all")) / F.ln("all")).otherwise(1.0)
    out = shown.join(content, ["host", "node"]).join(styles.select("host", "node", "kinds", spread.alias("presentation")), ["host", "node"], "left")
    fade = F.pow(F.lit(FADE), F.coalesce("kinds", F.lit(0)))
    out = stored(out.withColumn("importance", (1 - fade) * F.coalesce("presentation", F.lit(0.0)) + fade * F.col("content")).select("host", "node", "pages", "presentation", "content", "importance"), "tree")
    release(parsed.sparkSession)
    leaves = per.select("host", F.element_at("nodes", -1).alias("node"), "nodes").join(out.select("host", "node", "importance"), ["host", "node"])
    best = leaves.select("host", F.explode("nodes").alias("node"), "importance").groupBy("host", "node").agg(F.max("importance").alias("best"))
    return out.join(best, ["host", "node"])


def weak_nodes(parsed: DataFrame, tree: DataFrame, low: float, min_pages: int) -> DataFrame:
    """host, digest, weak: the nodes of each page whose branch has low importance."""
    weak = stored(tree.where((F.greatest("importance", "best") < low) & (F.col("pages") >= min_pages)).select("host", "node"), "weak")
    nodes = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["nodes"])))
    pages = parsed.select("host", "digest", F.explode(nodes).alias("node")).distinct()
    return join_small(pages, weak, ["host", "node"], "inner").groupBy("host", "digest").agg(F.collect_set("node").alias("weak"))


def main_texts(pages: DataFrame, low: float = LOW_IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars and n_weak (blocks that only the style tree drops) of every page."""
    parsed = stored(parse_pages(pages), "pages")
    weak = stored(weak_nodes(parsed, style_tree(parsed), low, min_pages), "weakest")
    release(pages.sparkSession)
    rows = join_small(parsed.drop("layouts"), weak, ["host", "digest"], "left")
    strong = lambda b: ~F.arrays_overlap(b["nodes"], F.coalesce("weak", F.array().cast("array<bigint>")))
    size = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + F.length(b["text"]))
    rows = rows.withColumn("named", F.filter("blocks", lambda b: b["kind"] > 0)).withColumn("main", F.filter("named", lambda b: b["kind"] == 2))
    rows = rows.withColumn("fine", F.filter("named", strong)).withColumn("mainfine", F.filter("main", strong))
    # The main part holds a third of what is left or more, its weak branches apart where it isn't weak as a whole.
    part = F.when(2 * size("mainfine") >= size("main"), F.col("mainfine")).otherwise(F.col("main"))
    inside = (F.size("main") > 0) & (MAIN_SHARE * size("main") >= size(F.when(F.size("fine") > 0, F.col("fine")).otherwise(F.col("named"))))
    chosen = F.when(inside, part).when(F.size("fine") > 0, F.col("fine")).otherwise(F.col("named"))
    rows = rows.withColumn("chosen", chosen)
    left = F.when(inside, F.size("main")).otherwise(F.size("named")) - F.size("chosen")
    text = F.coalesce(F.array_join(F.transform("chosen", lambda b: b["text"]), "\n"), F.lit(""))
    return rows.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), left.cast("long").alias("n_weak"))


def op3_main_text(spark, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
