"""HTML pages as tables: nodes of the document tree, navigation by joins, selectors, tokens, entities, edits, block classes by decision tree.

Pages are parsed in Arrow batches, one row a page; everything after that is columns and equi-joins on (page, node). Nodes are numbered in
document order and carry the number of their last descendant, so descendants are an interval of one page.

Rules for malformed pages: elements without content close at once, </br> is <br>, script, style and noxhtml hold raw text, p nests, an
end tag closes the latest open element of its name and what is inside it, and an end tag without opener is dropped. Null and empty pages
have no nodes.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .pages import INLINE, RAW, VOID

#: Pages whose nodes, tokens or blocks are in memory at once.
PAGES = 200
NODE = "node_id int, parent_id int, last_id int, depth int, tag string, attrs map<string,string>, text string, path string, start int, end int, inner_start int, inner_end int"
_NODE = pa.schema([("node_id", pa.int32()), ("parent_id", pa.int32()), ("last_id", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("path", pa.string()), *[(c, pa.int32()) for c in ("start", "end", "inner_start", "inner_end")]])


class _Tree(HTMLParser):
    CDATA_CONTENT_ELEMENTS = ("script", "style", "noxhtml")

    def __init__(self, page: str):
        super().__init__(convert_charrefs=False)
        self.page, self.nodes, self.open = page, [], []
        self.lines = [0]
        for m in re.finditer("\n", page):
            self.lines.append(m.end())
        self.feed(page)
        self.close()
        for node in self.open[::-1]:
            self._end(node, len(page), len(page))

    def _at(self) -> int:
        line, col = self.getpos()
        return self.lines[line - 1] + col

    def _add(self, tag: str, attrs: dict, text: str | None, start: int, end: int) -> dict:
        up = self.open[-1] if self.open else None
        path = (up["path"] + "/" if up else "") + tag
        n = {"node_id": len(self.nodes), "parent_id": up["node_id"] if up else None, "depth": len(self.open), "tag": tag, "attrs": attrs, "text": text, "path": path, "start": start, "end": end, "inner_start": end, "inner_end": end}
        n["last_id"] = n["node_id"]
        self.nodes.append(n)
        return n

    def _end(self, node: dict, inner: int, end: int) -> None:
        node["inner_end"], node["end"], node["last_id"] = inner, end, len(self.nodes) - 1

    def handle_starttag(self, tag, attrs):
        at = self._at()
        n = self._add(tag, {k: v if v is not None else "" for k, v in reversed(attrs)}, None, at, at + len(self.get_starttag_text() or ""))
        if tag not in VOID:
            self.open.append(n)

    def handle_startendtag(self, tag, attrs):
        at = self._at()
        self._add(tag, {k: v if v is not None else "" for k, v in reversed(attrs)}, None, at, at + len(self.get_starttag_text() or ""))

    def handle_endtag(self, tag):
        at = self._at()
        if tag == "br":
            self._add("br", {}, None, at, self.page.find(">", at) + 1)
            return
        if any(n["tag"] == tag for n in self.open):
            end = self.page.find(">", at) + 1 or len(self.page)
            while self.open:
                n = self.open.pop()
                self._end(n, at, end if n["tag"] == tag else at)
                if n["tag"] == tag:
                    break

    def _text(self, kind: str, raw: str, at: int):
        last = self.nodes[-1] if self.nodes else None
        if kind == "#text" and last and last["tag"] == "#text" and last["end"] == at:
            last["text"] += raw
            last["end"] = last["inner_end"] = at + len(raw)
        else:
            self._add(kind, {}, raw, at, at + len(raw))

    def handle_data(self, data):
        self._text("#text", data, self._at())

    def handle_entityref(self, name):
        at = self._at()
        self._text("#text", f"&{name}" + (";" if self.page[at + len(name) + 1 : at + len(name) + 2] == ";" else ""), at)

    def handle_charref(self, name):
        at = self._at()
        self._text("#text", f"&#{name}" + (";" if self.page[at + len(name) + 2 : at + len(name) + 3] == ";" else ""), at)

    def handle_comment(self, data):
        self._add("#comment", {}, data, self._at(), self._at() + len(data) + 7)


def nodes_of(page: str | None) -> list[dict]:
    return _Tree(page).nodes if page else []


def nodes(pages: DataFrame, row: str, html: str) -> DataFrame:
    """row and the columns of NODE: elements, #text (entities as written) and #comment nodes in document order, with offsets in the page."""
    kind = dict(pages.dtypes)[row]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES):
                b = whole.slice(start, PAGES)
                found = [nodes_of(h) for h in b.column(1).to_pylist()]
                keys = b.column(0).take(pa.array([i for i, f in enumerate(found) for _ in f], pa.int64()))
                flat = [n for f in found for n in f]
                cols = [pa.array([list(n["attrs"].items()) if c.name == "attrs" else n[c.name] for n in flat], c.type) for c in _NODE]
                yield pa.RecordBatch.from_arrays([keys, *cols], [row, *_NODE.names])

    return pages.select(row, html).mapInArrow(run, f"{row} {kind}, {NODE}")


# ---- navigation
def children(of: DataFrame, all_nodes: DataFrame, row: str) -> DataFrame:
    """The child nodes of some nodes (row, node_id), with of_id."""
    return all_nodes.join(of.select(row, F.col("node_id").alias("of_id")), (all_nodes[row] == of[row]) & (all_nodes["parent_id"] == F.col("of_id"))).drop(of[row])


def descendants(of: DataFrame, all_nodes: DataFrame, row: str, tag: str | None = None, itself: bool = False) -> DataFrame:
    """The nodes below some nodes (row, node_id, last_id), with of_id; of one tag if given. An equi-join on the page, then an interval."""
    o = of.select(F.col(row).alias("_r"), F.col("node_id").alias("of_id"), F.col("last_id").alias("_l"))
    n = all_nodes if tag is None else all_nodes.where(F.col("tag") == tag)
    low = F.col("node_id") >= F.col("of_id") if itself else F.col("node_id") > F.col("of_id")
    return n.join(o, (F.col(row) == F.col("_r")) & low & (F.col("node_id") <= F.col("_l"))).drop("_r", "_l")


def ancestors(of: DataFrame, all_nodes: DataFrame, row: str, itself: bool = False) -> DataFrame:
    """The nodes above some nodes (row, node_id), with of_id."""
    o = of.select(F.col(row).alias("_r"), F.col("node_id").alias("of_id"))
    low = F.col("node_id") <= F.col("of_id") if itself else F.col("node_id") < F.col("of_id")
    return all_nodes.join(o, (F.col(row) == F.col("_r")) & low & (F.col("of_id") <= F.col("last_id"))).drop("_r")


def select(all_nodes: DataFrame, selector: str) -> DataFrame:
    """Nodes that a simple path selects: /a/b from the root, //a anywhere, * any element, [@x] or [@x='v'] on the last step."""
    m = re.fullmatch(r"((?://?(?:[\w#-]+|\*))+)((?:\[@[\w-]+(?:='[^']*')?\])*)", selector)
    if not m:
        raise ValueError(f"can't read the selector {selector}")
    rx = "^"
    for sep, step in re.findall(r"(//?)([\w#-]+|\*)", m[1]):
        one = "[^/#]+" if step == "*" else re.escape(step)
        rx += ("(?:.*/)?" if sep == "//" else "" if rx == "^" else "/") + one if not (sep == "//" and rx != "^") else "/(?:.*/)?" + one
    out = all_nodes.where(F.col("path").rlike(rx + "$"))
    for name, _, value in re.findall(r"\[@([\w-]+)(='([^']*)')?\]", m[2]):
        a = F.try_element_at("attrs", F.lit(name))
        out = out.where(a == value if _ else a.isNotNull())
    return out


def first_of(found: DataFrame, row: str) -> DataFrame:
    """The first selected node of every page."""
    first = found.groupBy(row).agg(F.min("node_id").alias("node_id"))
    return found.join(first, [row, "node_id"], "left_semi")


# ---- reading
def attribute(name: str, default: object = None, kind: str = "string") -> Column:
    """An attribute as a string, int or boolean; the default where it is missing or can't be read."""
    return F.coalesce(F.try_element_at("attrs", F.lit(name)).try_cast(kind), F.lit(default).cast(kind))


def by_id(all_nodes: DataFrame, value: str) -> DataFrame:
    return all_nodes.where(F.try_element_at("attrs", F.lit("id")) == value)


def inner_text(of: DataFrame, all_nodes: DataFrame, row: str) -> DataFrame:
    """row, of_id, text: the text nodes below each node in order, entities as written; scripts and styles left out."""
    t = descendants(of, all_nodes, row, "#text", itself=True).where(~F.col("path").rlike("(^|/)(script|style|noscript)/"))
    return t.groupBy(row, "of_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "text"))), lambda x: x["text"]), "").alias("text"))


def with_markup(found: DataFrame, pages: DataFrame, row: str, html: str) -> DataFrame:
    """Adds outer_html and inner_html of each node, cut out of its page."""
    j = found.join(pages.select(row, html), row)
    return j.withColumns({"outer_html": F.substring(F.col(html), F.col("start") + 1, F.col("end") - F.col("start")), "inner_html": F.substring(F.col(html), F.col("inner_start") + 1, F.col("inner_end") - F.col("inner_start"))}).drop(html)


def escaped(c: Column) -> Column:
    """Text as it stands in markup or in a quoted attribute."""
    for sign, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(code))
    return c


def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: entities.unescape(x) if x is not None else None)


def unescaped(c: Column) -> Column:
    """Markup text with its entities read."""
    return F.when(c.contains("&"), F.pandas_udf(_unescape, StringType())(c)).otherwise(c)


# ---- editing: rows are values, an edit is a new table
def set_attribute(all_nodes: DataFrame, where: Column, name: str, value: str | None) -> DataFrame:
    """Sets an attribute of the nodes that fulfil a condition; None removes it."""
    rest = F.map_filter("attrs", lambda k, _: k != name)
    new = rest if value is None else F.map_concat(rest, F.create_map(F.lit(name), F.lit(value)))
    return all_nodes.withColumn("attrs", F.when(where, new).otherwise(F.col("attrs")))


def removed(all_nodes: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """All nodes but some (row, node_id, last_id) and what is below them."""
    d = descendants(gone, all_nodes, row, itself=True).select(row, "node_id").distinct()
    return all_nodes.join(d, [row, "node_id"], "left_anti")


def rendered(all_nodes: DataFrame, row: str) -> DataFrame:
    """row, html: pages written anew from their nodes, in order of node_id below each parent; one row a page."""

    def write(rows: list) -> str:
        kids: dict = {}
        have = {r["node_id"] for r in rows}
        for r in sorted(rows, key=lambda r: r["node_id"]):
            kids.setdefault(r["parent_id"] if r["parent_id"] in have else None, []).append(r)
        out: list[str] = []
        todo: list = [(r, False) for r in reversed(kids.get(None, []))]
        while todo:
            r, closing = todo.pop()
            if closing:
                out.append(f"</{r['tag']}>")
            elif r["tag"] == "#text":
                out.append(r["text"] or "")
            elif r["tag"] == "#comment":
                out.append(f"<!--{r['text'] or ''}-->")
            else:
                attrs = "".join(f' {k}="{entities.escape(v or "", quote=True)}"' for k, v in (dict(r["attrs"]) if r["attrs"] is not None else {}).items())
                out.append(f"<{r['tag']}{attrs}>")
                if r["tag"] not in VOID:
                    todo.append((r, True))
                    todo += [(k, False) for k in reversed(kids.get(r["node_id"], []))]
        return "".join(out)

    kind = dict(all_nodes.dtypes)[row]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([write(r) for r in b.column(1).to_pylist()], pa.string())], [row, "html"])

    g = all_nodes.groupBy(row).agg(F.collect_list(F.struct("node_id", "parent_id", "tag", "attrs", "text")).alias("rows"))  # a page's nodes
    return g.mapInArrow(run, f"{row} {kind}, html string")


# ---- tokens and blocks
_WORD = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’-][^\W\d_]+)*")
#: Tokens per block feature row.
FEATURES = ("Wrds", "Chars", "LnkDns", "TxtDns", "AvgWrdLn", "CapWrdRtio", "CapStrtWrdRtio", "FlstpRtio", "WrdsQt", "TxtDnsQt", "InP", "InH", "RelPos")


def tokens_of(page: str | None) -> list[tuple[str, str, str, int, int]]:
    """(kind, token, normal form, offset, stops): open, close and empty tags, words and numbers outside scripts and styles.

    stops: full stops from the token to the next one of its text node (the first also has those before it).
    """
    out: list[tuple[str, str, str, int, int]] = []
    found = nodes_of(page)
    ends: list[tuple[int, str]] = []
    for n in found:
        while ends and ends[-1][0] <= n["start"]:
            at, tag = ends.pop()
            out.append(("close", f"</{tag}>", f"</{tag}>", at, 0))
        if n["tag"] == "#text":
            if not RAW.intersection(n["path"].split("/")):
                t = entities.unescape(n["text"])
                found_words = list(_WORD.finditer(t))
                for i, m in enumerate(found_words):
                    number = m[0][0].isdigit()
                    stops = t.count(".", m.start() if i else 0, found_words[i + 1].start() if i + 1 < len(found_words) else len(t))
                    out.append(("number" if number else "word", m[0], "1" if number else m[0].lower(), n["start"] + m.start(), stops))
        elif n["tag"] != "#comment":
            empty = n["tag"] in VOID
            out.append(("empty" if empty else "open", f"<{n['tag']}>", f"<{n['tag']}/>" if empty else f"<{n['tag']}>", n["start"], 0))
            if not empty:
                ends.append((n["inner_end"], n["tag"]))
    while ends:
        at, tag = ends.pop()
        out.append(("close", f"</{tag}>", f"</{tag}>", at, 0))
    return out


def tokens(pages: DataFrame, row: str, html: str, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """row, pos, kind, token, normal, start, stops of every token of a page, or only of those of some kinds."""
    kind = dict(pages.dtypes)[row]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES):
                b = whole.slice(at, PAGES)
                found = [tokens_of(h) for h in b.column(1).to_pylist()]
                flat = [(i, p, *t) for i, f in enumerate(found) for p, t in enumerate(f) if kinds is None or t[0] in kinds]
                keys = b.column(0).take(pa.array([t[0] for t in flat], pa.int64()))
                cols = [pa.array([t[k] for t in flat], c) for k, c in enumerate((pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()), 1)]
                yield pa.RecordBatch.from_arrays([keys, *cols], [row, "pos", "kind", "token", "normal", "start", "stops"])

    return pages.select(row, html).mapInArrow(run, f"{row} {kind}, pos int, kind string, token string, normal string, start int, stops int")


def _upper(c: str) -> bool:
    return unicodedata.category(c) == "Lu"


def page_blocks_of(page: str | None) -> list[dict]:
    """block_no (from 1), text and the features of FEATURES of the blocks of one page, as block_table has them."""
    parts: list[list] = []  # words, linked, in p, in h, characters, capitals, capital starts, first, last, stops
    now: list | None = None
    ends: list[tuple[int, str]] = []
    inside = {"a": 0, "p": 0, "h1": 0, "h2": 0, "h3": 0}
    for n in nodes_of(page):
        while ends and ends[-1][0] <= n["start"]:
            tag = ends.pop()[1]
            now = now if tag in INLINE else None
            if tag in inside:
                inside[tag] -= 1
        tag = n["tag"]
        if tag == "#text":
            t = entities.unescape(n["text"])
            words = [] if RAW.intersection(n["path"].split("/")) else _WORD.findall(t)
            if not words:
                continue
            if now is None:
                now = [[], 0, False, False, 0, 0, 0, n["start"] + t.find(words[0]), 0, 0]
                parts.append(now)
            capital = [w for w in words if w[0].isupper() and _upper(w[0])]
            now[0] += words
            now[1] += len(words) if inside["a"] else 0
            now[2] |= inside["p"] > 0
            now[3] |= inside["h1"] + inside["h2"] + inside["h3"] > 0
            now[4] += sum(map(len, words))
            now[5] += sum(all(map(_upper, w)) for w in capital)
            now[6] += len(capital)
            now[8] = max(now[8], n["start"] + t.rfind(words[-1]) + len(words[-1]))  # behind the last word there is no letter or digit
            now[9] += t.count(".")
        elif tag != "#comment":
            now = now if tag in INLINE else None
            if tag not in VOID:
                ends.append((n["inner_end"], tag))
                if tag in inside:
                    inside[tag] += 1
    out: list[dict] = []
    words, density = 0.0, 0.0
    for no, (text, linked, in_p, in_h, chars, caps, starts, first, last, stops) in enumerate(parts, 1):
        n, wide = float(len(text)), last - first
        lines = wide // 80
        dense = n if lines <= 1 else n / (lines - 1)
        f = (n, float(wide), min(1.0, linked / n), dense, chars / n, caps / n, starts / n, stops / n, words / n, density / dense, float(in_p), float(in_h), no / len(parts))
        out.append({"block_no": no, "text": " ".join(text), **dict(zip(FEATURES, f))})
        words, density = n, dense
    return out


def page_blocks(pages: DataFrame, row: str, html: str) -> DataFrame:
    """row, blocks: one row a page that has blocks, with all its blocks (block_no, text, the features of FEATURES) in order; no shuffle."""
    kind = dict(pages.dtypes)[row]
    one = pa.struct([("block_no", pa.int32()), ("text", pa.string()), *[(f, pa.float64()) for f in FEATURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES):
                b = whole.slice(start, PAGES)
                found = [page_blocks_of(h) for h in b.column(1).to_pylist()]
                have = [i for i, f in enumerate(found) if f]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(have, pa.int64())), pa.array([found[i] for i in have], pa.list_(one))], [row, "blocks"])

    fields = ", ".join(f"{f}: double" for f in FEATURES)
    return pages.select(row, html).mapInArrow(run, f"{row} {kind}, blocks array<struct<block_no: int, text: string, {fields}>>")


def block_table(toks: DataFrame, row: str) -> DataFrame:
    """row, block_no (from 1), text and the features of FEATURES, from the tokens of pages.

    A block ends at a tag that is not inline, once it has a word. Text and word counts are of words and numbers; a capital word is all in
    capitals, a capital start begins with one. Links count by tokens between a and /a. Ratios to the block before take it as it was.
    """
    name = F.regexp_extract("token", r"^</?([^>]+)>$", 1)
    up = Window.partitionBy(row).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_tag = F.col("kind").isin("open", "close", "empty")
    x = toks.withColumns({"name": F.when(is_tag, name), "word": (~is_tag).cast("int")})
    breaks = F.coalesce(is_tag & ~F.col("name").isin(*sorted(INLINE)), F.lit(False)).cast("int")

    def inside(*tags: str) -> Column:
        n = F.when(F.col("name").isin(*tags), F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)).otherwise(0)
        return F.sum(n).over(up) > 0

    x = x.withColumns({"part": F.sum(breaks).over(up), "in_a": inside("a").cast("int"), "in_p": inside("p").cast("int"), "in_h": inside("h1", "h2", "h3").cast("int")})
    w = x.where("word = 1").groupBy(row, "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda t: t["token"]), " ").alias("text"), F.count("*").alias("n"), F.sum("in_a").alias("linked"), F.max("in_p").alias("InP"), F.max("in_h").alias("InH"),
        F.sum(F.length("token")).alias("len"), F.sum(F.col("token").rlike(r"^\p{Lu}+$").cast("int")).alias("caps"), F.sum(F.col("token").rlike(r"^\p{Lu}").cast("int")).alias("starts"), F.min("start").alias("first"), F.max(F.col("start") + F.length("token")).alias("last"), F.sum("stops").alias("stops"),
    )
    at = Window.partitionBy(row).orderBy("part")
    n, chars = F.col("n"), F.col("last") - F.col("first")
    lines = F.floor(chars / 80)
    f = w.select(row, "part", F.row_number().over(at).alias("block_no"), "text", n.cast("double").alias("Wrds"), chars.cast("double").alias("Chars"), F.least(F.lit(1.0), F.col("linked") / n).alias("LnkDns"), F.when(lines <= 1, n.cast("double")).otherwise(n / (lines - 1)).alias("TxtDns"), (F.col("len") / n).alias("AvgWrdLn"), (F.col("caps") / n).alias("CapWrdRtio"), (F.col("starts") / n).alias("CapStrtWrdRtio"), (F.col("stops") / n).alias("FlstpRtio"), F.col("InP").cast("double").alias("InP"), F.col("InH").cast("double").alias("InH"))
    every = F.count("*").over(Window.partitionBy(row))
    before = {c: F.coalesce(F.lag(c).over(at), F.lit(0.0)) for c in ("Wrds", "TxtDns")}
    return f.withColumns({"WrdsQt": before["Wrds"] / F.col("Wrds"), "TxtDnsQt": before["TxtDns"] / F.col("TxtDns"), "RelPos": F.col("block_no") / every}).drop("part")


def with_neighbours(blocks: DataFrame, row: str) -> DataFrame:
    """Blocks with the features of the block before (p.), themselves (c.) and the block after (n.); at the ends these are 0."""
    w = Window.partitionBy(row).orderBy("block_no")
    p = [F.coalesce(F.lag(f).over(w), F.lit(0.0)).alias(f"p.{f}") for f in FEATURES]
    n = [F.coalesce(F.lead(f).over(w), F.lit(1.0 if f == "RelPos" else 0.0)).alias(f"n.{f}") for f in FEATURES]
    return blocks.select(row, "block_no", "text", *p, *[F.col(f).alias(f"c.{f}") for f in FEATURES], *n)


# What a leaf's number means.
CLASSES = ("Boilerplate", "Headline", "FullText", "Supplement", "RelatedContent", "UserComment")


def read_tree(text: str) -> list[dict]:
    """node_id, parent_id, feature, op, threshold, cls of the lines of a decision tree as text; comments and blank lines are skipped."""
    out: list[dict] = []
    stack: list[tuple[int, int]] = []
    for line in text.splitlines():
        m = re.fullmatch(r"((?:\|\s*)*)([\w.]+)\s*(<=|>=|<|>|=|!=)\s*(-?[\d.]+)\s*(?::\s*(\d+).*)?", line.rstrip())
        if not m or line.lstrip().startswith("#"):
            continue
        depth = m[1].count("|")
        while stack and stack[-1][0] >= depth:
            stack.pop()
        n = {"node_id": len(out), "parent_id": stack[-1][1] if stack else None, "feature": m[2], "op": m[3], "threshold": float(m[4]), "cls": int(m[5]) if m[5] is not None else None}
        stack.append((depth, n["node_id"]))
        out.append(n)
    return out


def tree_class(tree: list[dict], names: tuple[str, ...] = CLASSES, feature: Callable[[str], Column] = lambda f: F.col(f"`{f}`")) -> Column:
    """The class a tree gives to a row, as one nested CASE: the first child whose condition holds, level by level; Unknown if none does."""
    kids: dict = {}
    for n in tree:
        kids.setdefault(n["parent_id"], []).append(n)

    def value(parent) -> Column:
        out = None
        for n in kids.get(parent, []):
            c = feature(n["feature"])
            t = F.lit(n["threshold"])
            ok = {"<=": c <= t, ">=": c >= t, "<": c < t, ">": c > t, "=": c == t, "!=": c != t}[n["op"]]
            leaf = F.lit(names[n["cls"]] if n["cls"] < len(names) else "Unknown") if n["cls"] is not None else value(n["node_id"])
            out = F.when(ok, leaf) if out is None else out.when(ok, leaf)
        return out.otherwise(F.lit("Unknown")) if out is not None else F.lit("Unknown")

    return value(None)


#: A small tree of our own: links make furniture, headings in h1 to h3 headlines, long linkless blocks full text.
SMALL_TREE = """
c.LnkDns <= 0.34
|   c.InH = 1: 1
|   c.InH = 0
|   |   c.Wrds <= 6
|   |   |   p.LnkDns <= 0.34: 3
|   |   |   p.LnkDns > 0.34: 0
|   |   c.Wrds > 6: 2
c.LnkDns > 0.34
|   c.Wrds <= 12: 0
|   c.Wrds > 12: 4
"""


def classified(blocks: DataFrame, row: str, tree: str = SMALL_TREE) -> DataFrame:
    """row, block_no, text, cls of the blocks of pages."""
    return with_neighbours(blocks, row).select(row, "block_no", "text", tree_class(read_tree(tree)).alias("cls"))


def main_text(classes: DataFrame, row: str) -> DataFrame:
    """row, text: the full-text blocks joined by blanks."""
    g = classes.where("cls = 'FullText'").groupBy(row).agg(F.array_sort(F.collect_list(F.struct("block_no", "text"))).alias("b"))
    return g.select(row, F.array_join(F.transform("b", lambda x: x["text"]), " ").alias("text"))


def page_classes(pages: DataFrame, row: str, tree: str = SMALL_TREE) -> DataFrame:
    """row, blocks: the blocks of each page of page_blocks as (block_no, text, cls), classified as by classified, without a shuffle."""
    nodes = read_tree(tree)

    def one(b: Column, i: Column) -> Column:
        def feature(name: str) -> Column:
            side, f = name.split(".", 1)
            if side == "c":
                return b[f]
            other = F.get("blocks", i - 1 if side == "p" else i + 1)[f]
            return F.coalesce(other, F.lit(1.0 if name == "n.RelPos" else 0.0))

        return F.struct(b["block_no"].alias("block_no"), b["text"].alias("text"), tree_class(nodes, feature=feature).alias("cls"))

    return pages.select(row, F.transform("blocks", one).alias("blocks"))


def page_main_text(classes: DataFrame, row: str) -> DataFrame:
    """row, text: the full-text blocks of each page of page_classes joined by blanks."""
    full = F.filter("blocks", lambda b: b["cls"] == "FullText")
    return classes.select(row, full.alias("b")).where(F.size("b") > 0).select(row, F.array_join(F.transform("b", lambda b: b["text"]), " ").alias("text"))
