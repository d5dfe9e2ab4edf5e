"""HTML pages: nodes, text blocks with paths and link shares, block features."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Elements that don't break a text block, that have no content, and whose content is no text.
INLINE = frozenset("a abbr acronym b bdo big cite code dfn em font i img input kbd label q s samp select small span strike strong sub sup textarea tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "noscript"))


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.blocks: list[tuple[str, str, int]] = []
        self.text, self.path, self.linked = [], None, 0

    def flush(self):
        t = " ".join(" ".join(self.text).split())
        if t:
            self.blocks.append((t, "/".join(self.path or []), self.linked))
        self.text, self.path, self.linked = [], None, 0

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if tag in self.open:  # closes the latest open element of the name; others inside it stay ignored
            at = len(self.open) - 1 - self.open[::-1].index(tag)
            del self.open[at:]

    def handle_data(self, data):
        if RAW.intersection(self.open) or not data.strip():
            return
        self.text.append(data)
        if self.path is None or len(self.open) < len(self.path):
            self.path = [t for t in self.open if t not in INLINE or t == "a"]
        if "a" in self.open:
            self.linked += len(" ".join(data.split()))


def blocks_of(html: str | None) -> list[tuple[str, str, int]]:
    """(text, path, characters inside links) of the text blocks of a page; null and empty pages have none."""
    p = _Blocks()
    p.feed(html or "")
    p.close()
    p.flush()
    return p.blocks


def text_blocks(pages: DataFrame, row: str, html: str) -> DataFrame:
    """row, block_no, text, path, link_chars, start: offsets step by the block's length and two line end characters."""
    kinds = dict(pages.dtypes)
    schema = f"{row} {kinds[row]}, block_no int, text string, path string, link_chars int, start int"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for r, h in zip(p[row], p[html], strict=True):
                at = 0
                for i, (t, path, linked) in enumerate(blocks_of(h)):
                    out.append((r, i, t, path, linked, at))
                    at += len(t) + 2
            yield pd.DataFrame(out, columns=[row, "block_no", "text", "path", "link_chars", "start"])

    return pages.select(row, html).mapInPandas(run, schema)


def block_features(blocks: DataFrame, row: str) -> DataFrame:
    """Features of each block (link and text density, word length, capitals, full stops, position) and the ratios to the block before."""
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    chars = F.length("text")
    lines = F.floor(chars / 80)
    x = blocks.withColumns(
        {
            "n_words": words,
            "link_density": F.least(F.lit(1.0), F.col("link_chars") / F.greatest(chars, F.lit(1))),
            "text_density": F.when(lines <= 1, words.cast("double")).otherwise(words / (lines - 1)),
            "word_len": F.length(F.regexp_replace("text", r"\s+", "")) / F.greatest(words, F.lit(1)),
            "capital_start": F.size(F.regexp_extract_all("text", F.lit(r"(?:^|\s)(\p{Lu})"), F.lit(1))) / F.greatest(words, F.lit(1)),
            "full_stops": F.size(F.regexp_extract_all("text", F.lit(r"([.!?](?:\s|$))"), F.lit(1))) / F.greatest(words, F.lit(1)),
            "in_p": F.col("path").rlike(r"(^|/)p(/|$)"),
            "in_h": F.col("path").rlike(r"(^|/)h[1-3](/|$)"),
        }
    )
    w = Window.partitionBy(row).orderBy("block_no")
    n = F.count("*").over(Window.partitionBy(row))
    return x.withColumns(
        {
            "words_ratio": F.lag("n_words").over(w) / F.greatest(F.col("n_words"), F.lit(1)),
            "density_ratio": F.lag("text_density").over(w) / F.greatest(F.col("text_density"), F.lit(1e-9)),
            "rel_position": F.row_number().over(w) / n,
        }
    )
