"""Main body of a page from its text blocks: composite text density over the blocks' DOM paths.

Each non-blank line of a page is a block with (roughly right) annotations: a DOM path and the share of its characters inside links.
A logistic model over the words of a line (first and last words one by one, all words of long lines by their mean), fitted on lines whose annotations are clear, gives the expected link
share of every block, also where the annotation is missing or wrong. Reported paths are missing for a third of the blocks and the same for
main text and furniture in many pages, so a block whose expected share contradicts its path is hung into the tree's main or side container.
The composite text density of Sun, Song and Liao (2011) is then computed from characters, expected link characters and tags for every
node of the page; child densities are summed, and the subtree with the largest sum is the body. The smallest density on its path to the
root gives the threshold below which its blocks are dropped. A page whose subtrees are all mostly links has no body.

Defined results: a null or blank text has no body lines; without annotations the line model alone hangs the blocks.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import hash_sample
from .encoding import quick_repair

#: Documents on which the line model is fitted, at most.
FIT_DOCS = 2500
#: Share of the body-path threshold that a block's density must reach.
TAU = 0.1
# The containers of blocks whose path is missing or contradicted.
MAIN, SIDE = "html/body/article/p", "html/body/div/ul/li"
EDGE = 90
MEMO = 200_000

_MARK = re.compile("[̀-ͯ]+")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")
_LEAD = re.compile(r"^[\s*•→»|>·–—-]+")
_TAIL = re.compile(r"\s*\(\d+\)\s*$")
_FURNITURE_TAGS = frozenset(("aside", "footer", "nav", "li", "header"))


def fold(s: str) -> str:
    """Lower case without accents."""
    return _MARK.sub("", unicodedata.normalize("NFKD", s)).lower()


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """(start offset, line without its line end) of all lines, numbered from 0 by position."""
    out, pos = [], 0
    for raw in (text or "").split("\n"):
        out.append((pos, raw[:-1] if raw.endswith("\r") else raw))
        pos += len(raw) + 1
    return out


def mended_lines(text: str | None) -> list[tuple[int, str]]:
    """lines_of with wrongly read UTF-8 put right in each line; offsets are those of the stored text."""
    lines = lines_of(text)
    return lines if not text or text.isascii() else [(p, x if x.isascii() else quick_repair(x)) for p, x in lines]


def features(line: str) -> tuple[list[str], list[str]]:
    """The model's features of one line: its first and last words, the words of short lines, its length and its end; and all words of long lines."""
    s = line.strip()
    n, every = len(s), []
    if n > 2 * EDGE:
        a = _TOKEN.findall(_LEAD.sub("", fold(s[:EDGE])))[:-1]
        z = _TOKEN.findall(fold(s[-EDGE:]))[1:]
        words = set(a[:6]) | set(z[-6:])
        every = s.lower().split()
    else:
        a = z = _TOKEN.findall(_TAIL.sub("", _LEAD.sub("", fold(s))))
        words = set(a)
    if not a or not z:
        return ["nothing"], every
    a, z = [("0" if t.isdigit() else t) for t in a[:2]], [("0" if t.isdigit() else t) for t in z[-2:]]
    out = ["b " + a[0], "b2 " + " ".join(a), "e " + z[-1], "e2 " + " ".join(z), "n %d" % min(9, n // 35), "w %d" % min(8, len(words))]
    out.extend("u " + ("0" if t.isdigit() else t) for t in words)
    if s[-1] in ".!?…”“»":
        out.append("stop")
    return out, every


class LineModel:
    """Log odds that a line is furniture, by its words; memoises whole lines. every: weights of the words of long lines, of which the mean counts."""

    def __init__(self, weights: dict[str, float], bias: float, every: dict[str, float] | None = None):
        self.weights, self.bias, self.every, self.memo = weights, bias, every or {}, {}

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "every": self.every, "memo": {}}

    def logit(self, line: str) -> float:
        v = self.memo.get(line)
        if v is None:
            w, mean = self.weights, self.every
            found, every = features(line)
            v = self.bias + sum([w.get(f, 0.0) for f in found])
            if every and mean:
                v += sum([mean[t] for t in every if t in mean]) / len(every)
            v = max(-7.0, min(7.0, v))
            if len(line) < 200:
                if len(self.memo) > MEMO:
                    self.memo.clear()
                self.memo[line] = v
        return v


def _aligned(lines: list[tuple[int, str]], notes: list[dict] | None) -> list[dict | None]:
    """The annotation features of each line: by order if there is one per non-blank line, else by offset."""
    at = [i for i, (_, x) in enumerate(lines) if x.strip()]
    out: list[dict | None] = [None] * len(lines)
    blocks = [a for a in notes or () if a and (a["type"] or "").startswith("TextBlock")]
    if len(blocks) == len(at):
        for i, a in zip(at, sorted(blocks, key=lambda a: a["spanstart"] or 0), strict=True):
            out[i] = a["features"]
    elif blocks:
        starts = {a["spanstart"]: a["features"] for a in blocks}
        for i in at:
            out[i] = starts.get(lines[i][0])
    return [dict(f) if f else None for f in out]


def link_share(f: dict | None) -> float | None:
    """The share of a block's characters inside links, None if unknown."""
    a, _, b = ((f or {}).get("linkToTextRatio") or "").partition("/")
    try:
        return min(1.0, max(0.0, float(a) / float(b))) if b and float(b) > 0 else None
    except ValueError:
        return None


def path_of(f: dict | None) -> str:
    return (f or {}).get("domPath") or "html/body/div/p"


def hung(path: str | None, share: float) -> str:
    """Where a block hangs: at its path if that agrees with its expected link share, else in the main or side container."""
    main = share < 0.5
    return path if path and ("article" in path.split("/")) == main else MAIN if main else SIDE


def evidence(f: dict | None) -> float:
    """Log odds that an annotation gives for furniture; path and link share are roughly right only."""
    if not f:
        return 0.0
    tags, v = path_of(f).split("/"), 0.0
    if "domPath" in f:
        v = 3.0 if _FURNITURE_TAGS.intersection(tags) else -2.5 if "article" in tags else -0.6
    s = link_share(f)
    return v + (0.0 if s is None else 4.0 if s >= 0.55 else -1.6 if s == 0 else 0.1)


def weak_label(line: str, f: dict | None) -> int | None:
    """1 furniture, 0 body, None if the annotation is not clear enough to learn from."""
    if not f:
        return None
    s, tags = link_share(f), path_of(f).split("/")
    if _FURNITURE_TAGS.intersection(tags) or (s is not None and s >= 0.55):
        return 1
    if s is None or s >= 0.55 or "domPath" not in f:
        return None
    return 0 if "article" in tags or len(line) > 200 else None


def _density(c: float, lc: float, t: float, lt: float, ratio: float) -> float:
    if c <= 0:
        return 0.0
    lc1, lt1 = max(lc, 1.0), max(lt, 1.0)
    base = math.log(c / max(c - lc, 1.0) * lc + ratio * c + math.e)
    return max(0.0, c / t * math.log(max(1.0, c * t / (lc1 * lt1))) / max(math.log(base), 0.1))


def body_mask(lines: list[tuple[int, str]], notes: list[dict] | None, model: LineModel, title: str | None = None) -> list[bool]:
    """For each line, whether it belongs to the main body. A line that equals the page's title is its headline."""
    fs = _aligned(lines, notes)
    blocks = []
    head = " ".join(fold(title).split()) if title else None
    for i, (_, x) in enumerate(lines):
        c = len(x.strip())
        if c:
            v = model.logit(x) + evidence(fs[i])
            if head and c < 400 and " ".join(fold(x).split()) == head:
                v -= 6.0
            share = 1 / (1 + math.exp(-v))
            blocks.append((i, c, share, hung((fs[i] or {}).get("domPath"), share)))
    keep = [False] * len(lines)
    if not blocks:
        return keep
    total = sum(b[1] for b in blocks)
    ratio = sum(c * s for _, c, s, _ in blocks) / total
    nodes: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0, 0.0])  # chars, link chars, tags, link tags, density sum
    own = {}
    for i, c, s, path in blocks:
        own[i] = _density(c, c * s, 1, s, ratio)
        nodes[path][4] += own[i]
        tags = path.split("/")
        for k in range(1, len(tags) + 1):
            n = nodes["/".join(tags[:k])]
            n[0] += c
            n[1] += c * s
            n[2] += 1
            n[3] += s
    d = {p: _density(n[0], n[1], n[2], n[3], ratio) for p, n in nodes.items()}
    for p in d:
        up = p.rpartition("/")[0]
        if up:
            nodes[up][4] += d[p]
    texty = [p for p, n in nodes.items() if n[1] < 0.5 * n[0]]
    if not texty:
        return keep
    top = max(texty, key=lambda p: (nodes[p][4], p))
    threshold = TAU * min(d[p] for p in d if top == p or top.startswith(p + "/"))
    for i, _, _, path in blocks:
        keep[i] = (path == top or path.startswith(top + "/")) and own[i] >= threshold
    return keep


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, every, y = [], [], []
        for text, notes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            lines = mended_lines(text)
            for (_, line), f in zip(lines, _aligned(lines, notes), strict=True):
                if line.strip() and (label := weak_label(line, f)) is not None:
                    found, words = features(line)
                    x.append(found + ["i " + t for t in words])
                    every.append(len(words))
                    y.append(label)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.string())), pa.array(every, pa.int32()), pa.array(y, pa.int8())], ["x", "every", "y"])


def _logistic(code: np.ndarray, row: np.ndarray, value: np.ndarray, kinds: int, y: np.ndarray, rounds: int, given: np.ndarray | None = None) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights of the features, bias and log odds of the rows; given: log odds that stay, so only what they leave open is fitted, without bias."""
    w, g2, bias = np.zeros(kinds), np.full(kinds, 1e-6), 0.0
    start, norm = 0.0 if given is None else given, 1 / len(y)
    z = np.zeros(len(y)) + start
    for _ in range(rounds):
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(code, weights=value * err[row], minlength=kinds) * norm + 2e-5 * w
        g2 += g * g
        w -= 0.5 * g / np.sqrt(g2)
        if given is None:
            bias -= 0.5 * err.mean()
        z = start + bias + np.bincount(row, weights=value * w[code], minlength=len(y))
    return w, bias, z


def fit_line_model(docs: DataFrame, fit_docs: int = FIT_DOCS, rounds: int = 60) -> LineModel:
    """Fits the line model on at most about fit_docs annotated documents; without any, every line counts as body."""
    sample = hash_sample(docs.select("docid", "text", "annotations"), "docid", fit_docs).where("annotations is not null and text is not null")
    t = sample.select("text", "annotations").mapInArrow(_training_rows, "x array<string>, every int, y byte").toArrow()
    if not t.num_rows:
        return LineModel({}, -1.0)
    x = t.column("x").combine_chunks()
    counts = np.diff(x.offsets.to_numpy())
    enc = x.flatten().dictionary_encode()
    code, names = enc.indices.to_numpy(), enc.dictionary.to_pylist()
    freq = np.bincount(code, minlength=len(names))
    y = t.column("y").to_numpy().astype(float)
    row = np.repeat(np.arange(len(y)), counts)
    every = t.column("every").to_numpy()
    mean = np.arange(len(row)) >= (np.cumsum(counts) - every)[row]  # the last features of a row
    live = freq[code] >= 3
    single, mean = live & ~mean, live & mean
    w, bias, z = _logistic(code[single], row[single], np.ones(single.sum()), len(names), y, rounds)
    w += _logistic(code[mean], row[mean], 1 / every[row[mean]], len(names), y, rounds, z)[0]
    kept = {n: round(float(v), 4) for n, v in zip(names, w, strict=True) if abs(v) > 0.02}
    return LineModel({n: v for n, v in kept.items() if not n.startswith("i ")}, float(bias), {n[2:]: v for n, v in kept.items() if n.startswith("i ")})


def body_lines(docs: DataFrame, model: LineModel) -> DataFrame:
    """docid, line_no, line, is_body of every non-blank line. Rows of a null or blank text: none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "docid long, line_no int, line string, is_body boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out: list[list] = [[], [], [], []]
            for docid, text, notes, title in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lines = mended_lines(text)
                for i, ok in enumerate(body_mask(lines, notes, m, title)):
                    if lines[i][1].strip():
                        for column, v in zip(out, (docid, i, lines[i][1], ok), strict=True):
                            column.append(v)
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["docid", "line_no", "line", "is_body"])

    return docs.select("docid", "text", "annotations", "name").mapInArrow(run, schema)


def furniture_lines(docs: DataFrame, model: LineModel | None = None) -> DataFrame:
    """docid, line_no of the non-blank lines that are not main body."""
    model = model or fit_line_model(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            ids, nos = [], []
            for docid, text, notes, title in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lines = mended_lines(text)
                for i, ok in enumerate(body_mask(lines, notes, m, title)):
                    if not ok and lines[i][1].strip():
                        ids.append(docid)
                        nos.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32())], ["docid", "line_no"])

    return docs.select("docid", "text", "annotations", "name").mapInArrow(run, "docid long, line_no int")


def body_sizes(docs: DataFrame, written: DataFrame, model: LineModel | None = None) -> DataFrame:
    """docid, body_chars, stored_chars, agrees: the size of each body beside the stored count, which is not always right."""
    model = model or fit_line_model(docs)
    own = body_lines(docs, model).where("is_body").groupBy("docid").agg(F.sum(F.length(F.trim("line"))).alias("body_chars"))
    stored = written.groupBy("docid").agg(F.max("bprcontentcharcount").alias("stored_chars"))
    j = docs.select("docid").join(own, "docid", "left").join(stored, "docid", "left").withColumn("body_chars", F.coalesce("body_chars", F.lit(0)))
    return j.withColumn("agrees", F.abs(F.col("body_chars") - F.col("stored_chars")) <= F.greatest(F.lit(20), F.col("stored_chars") * 0.05))
