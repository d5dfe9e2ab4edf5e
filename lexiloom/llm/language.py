"""Language of documents and of their segments by nearest centroids of n-gram vectors.

Sentences of the main body become TF-IDF vectors of character n-grams (1 to 3, with word ends), scaled to length 1, and are compared by
cosine with several centroids per language, found by spherical k-means. A sentence farther from every centroid than nearly all of that
centroid's own training sentences, or has too few words, is rejected and takes its neighbours' language. Runs of equal language are the
segments; a bracketed addition belongs to the sentence before it.

The classifier is fitted on at most FIT_DOCS documents (FIT_SENTENCES sentences a language) with a label; sentences whose label another
language's centroid contradicts are dropped before clustering, so wrong labels do no harm. Everything else covers all documents.
Defined results: a null or blank text, or one whose body has no words, has no segment.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import hash_sample
from .article import LineModel, body_mask, fit_line_model, fold, mended_lines

FIT_DOCS = 3000
FIT_SENTENCES = 500
TERMS = 1024
CLUSTERS = 4
#: How much nearer another language must be before a sentence starts a new segment.
MARGIN = 0.03
#: The same for a segment of one sentence: a single short sentence says less than two.
MARGIN_ONE = 0.06
#: Words of three letters or more, addresses left out, without which a sentence has no language of its own.
TELLING = 4
CHUNK = 128

_WORD = re.compile(r"[^\W\d_]+")
_ADDRESS = re.compile(r"\S+[/?=@]\S*|\S+\.\S+\.\S+")
_END = re.compile(r"(?<=[.!?…])[\"“”»’)]*\s+")


def sentences(line: str) -> list[str]:
    """The sentences of a line. A bracketed addition, and a piece without a word, belong to the sentence before it (or after, if first)."""
    out: list[str] = []
    for s in _END.split(line):
        if not s.strip():
            continue
        if out and (s[0] in "([{" or not _WORD.search(s) or not _WORD.search(out[-1])):
            out[-1] += " " + s
        else:
            out.append(s)
    return out


def tells(s: str) -> bool:
    """Whether a sentence has enough words to have a language of its own; others take their neighbours'."""
    if "/" in s or "=" in s or "@" in s:
        s = _ADDRESS.sub(" ", s)
    return len(s) > 90 or sum(1 for w in _WORD.findall(s) if len(w) > 2) >= TELLING


def grams(word: str) -> list[str]:
    w = f"_{word}_"
    n = len(w)
    return [*word, *(w[i : i + 2] for i in range(n - 1)), *(w[i : i + 3] for i in range(n - 2))]


class LanguageModel:
    """Vectors of sentences and their nearest centroids."""

    def __init__(self, langs: list[str], terms: dict[str, int], idf: np.ndarray, centroids: np.ndarray, owner: np.ndarray, reach: np.ndarray):
        self.langs, self.terms, self.idf, self.centroids, self.owner, self.reach = langs, terms, idf.astype(np.float32), centroids.astype(np.float32), owner, reach
        self._clear()

    def _clear(self) -> None:
        """Known words by number, and each one's n-gram ids in one growing buffer."""
        self.ids: dict[str, int] = {}
        self.start, self.length, self.buf, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(16384, np.int64), 0

    def __getstate__(self):
        return self.__dict__ | {"ids": {}, "used": 0, "start": np.zeros(1024, np.int64), "length": np.zeros(1024, np.int64), "buf": np.zeros(16384, np.int64)}

    def _add(self, w: str) -> None:
        get = self.terms.get
        v = [i for g in grams(w) if (i := get(g)) is not None]
        k, n = len(self.ids), self.used
        if k == len(self.start):
            self.start, self.length = np.concatenate([self.start, self.start]), np.concatenate([self.length, self.length])
        while n + len(v) > len(self.buf):
            self.buf = np.concatenate([self.buf, self.buf])
        self.buf[n : n + len(v)] = v
        self.ids[w], self.start[k], self.length[k], self.used = k, n, len(v), n + len(v)

    def vectors(self, texts: list[str]) -> np.ndarray:
        """A row of length 1 for each text (zeros where no word is known)."""
        m = len(self.terms)
        words = [_WORD.findall(t.lower()) for t in texts]
        flat = list(chain.from_iterable(words))
        if not flat:
            return np.zeros((len(texts), m), np.float32)
        if len(self.ids) > 150_000:
            self._clear()
        ids = self.ids
        for w in set(flat).difference(ids):
            self._add(w)
        no = np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat))
        n = self.length[no]
        upto = np.cumsum(n)
        gram = self.buf[np.repeat(self.start[no] - upto + n, n) + np.arange(upto[-1])]
        row = np.repeat(np.repeat(np.arange(len(texts)) * m, [len(w) for w in words]), n)
        x = np.bincount(row + gram, minlength=len(texts) * m).reshape(len(texts), m).astype(np.float32)
        x *= self.idf
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        x /= np.maximum(norm, 1e-9)[:, None]
        return x

    def classify(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its cosine with the best centroid of each language, and whether it is within reach of the best."""
        out, ok = [], []
        for i in range(0, len(texts), CHUNK):
            c = self.vectors(texts[i : i + CHUNK]) @ self.centroids.T
            best = np.stack([c[:, self.owner == k].max(axis=1) for k in range(len(self.langs))], axis=1)
            near = c.argmax(axis=1)
            out.append(best)
            ok.append((c[np.arange(len(c)), near] >= self.reach[near]) & np.array([tells(t) for t in texts[i : i + CHUNK]], bool))
        return (np.concatenate(out), np.concatenate(ok)) if out else (np.zeros((0, len(self.langs))), np.zeros(0, bool))


def label_code(label: str | None, names: dict[str, str]) -> str | None:
    """The code that a stored label means, None if it means none; names: lower-case codes and names to codes."""
    v = (label or "").strip().lower()
    return names.get(v) or names.get(re.split(r"[-_]", v)[0] if v else v)


def language_names(langs: DataFrame) -> dict[str, str]:
    """Lower-case codes and names to codes; the table of languages is a few rows."""
    return {k.lower(): r["lang"] for r in langs.select("lang", "name").collect() for k in (r["lang"], r["name"]) if k}


def fit_language_model(labelled: list[tuple[str, str]]) -> LanguageModel:
    """labelled: (code, sentence). Every third sentence also counts without its accents, as some texts lack theirs."""
    by: dict[str, list[str]] = defaultdict(list)
    for code, s in labelled:
        if len(by[code]) < FIT_SENTENCES:
            by[code].append(s)
            if len(by[code]) % 3 == 0 and not s.isascii():
                by[code].append(fold(s))
    langs = sorted(by)
    share, df, total = {}, Counter(), 0
    for code in langs:
        c: Counter = Counter()
        for s in by[code]:
            g = Counter(x for w in _WORD.findall(s.lower()) for x in grams(w))
            c.update(g)
            df.update(g.keys())
            total += 1
        n = sum(c.values()) or 1
        share[code] = {g: k / n for g, k in c.items()}
    spread = {g: max(p) - sum(p) / len(p) for g in df if df[g] >= 3 for p in [[share[c].get(g, 0.0) for c in langs]]}
    chosen = sorted(spread, key=lambda g: (-spread[g], g))[:TERMS]
    terms = {g: i for i, g in enumerate(chosen)}
    idf = np.array([math.log(1 + total / df[g]) for g in chosen]) if chosen else np.ones(1)
    m = LanguageModel(langs, terms or {"": 0}, idf, np.zeros((0, max(1, len(chosen)))), np.zeros(0, int), np.zeros(0))
    x = {c: m.vectors(by[c]) for c in langs}

    def unit(v: np.ndarray) -> np.ndarray:
        return v / max(float(np.sqrt((v * v).sum())), 1e-9)

    mean = np.stack([unit(x[c].mean(axis=0)) for c in langs]) if langs else np.zeros((0, len(idf)))
    centroids, owner, reach = [], [], []
    for k, code in enumerate(langs):
        v = x[code]
        v = v[(v @ mean.T).argmax(axis=1) == k]
        if not len(v):
            continue
        seeds = [int((v @ mean[k]).argmax())]
        while len(seeds) < min(CLUSTERS, len(v)):
            seeds.append(int((v @ v[seeds].T).max(axis=1).argmin()))
        c = v[seeds]
        for _ in range(10):
            near = (v @ c.T).argmax(axis=1)
            c = np.stack([unit(v[near == j].mean(axis=0)) if (near == j).any() else c[j] for j in range(len(c))])
        near = (v @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (own := v[near == j]).size:
                centroids.append(c[j])
                owner.append(k)
                reach.append(0.6 * float(np.quantile(own @ c[j], 0.01)))
    m.centroids, m.owner, m.reach = np.array(centroids, np.float32).reshape(len(centroids), -1), np.array(owner, int), np.array(reach)
    return m


def body_sentences(text: str | None, notes: list | None, title: str | None, lines_model: LineModel) -> list[str]:
    """The sentences of the main body in text order; headline and headings count as sentences."""
    lines = mended_lines(text)
    keep = body_mask(lines, notes, lines_model, title)
    return [s for (_, x), ok in zip(lines, keep, strict=True) if ok for s in sentences(x)]


def fit_languages(docs: DataFrame, names: dict[str, str], lines_model: LineModel) -> LanguageModel:
    """Fits the classifier on labelled documents of docs (docid, text, annotations, name, features)."""
    shared = docs.sparkSession.sparkContext.broadcast((lines_model, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, known = shared.value
        for b in batches:
            codes, found = [], []
            for text, notes, title, label in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if code := label_code(label, known):
                    for s in body_sentences(text, notes, title, lm)[:8]:
                        if len(s) > 40:
                            codes.append(code)
                            found.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.string()), pa.array(found, pa.string())], ["code", "s"])

    sample = hash_sample(docs.select("docid", "text", "annotations", "name", "features"), "docid", FIT_DOCS).where("text is not null and features is not null")
    label = F.try_element_at("features", F.lit("detectedLanguage"))
    t = sample.select("text", "annotations", "name", label.alias("label")).mapInArrow(run, "code string, s string").toArrow()
    return fit_language_model(sorted(set(zip(t.column("code").to_pylist(), t.column("s").to_pylist(), strict=True)), key=lambda p: hash_order(p[1])))


def hash_order(s: str) -> int:
    """A fixed pseudorandom order of texts."""
    h = 2166136261
    for c in s[:60]:
        h = (h ^ ord(c)) * 16777619 & 0xFFFFFFFF
    return h


def _apart(cos: np.ndarray, own: list[tuple[int, int]], j: int, cur: int) -> bool:
    """Whether the j-th sentence with a language of its own is clearly not in language cur; alone in its language, it must be clearer."""
    i, k = own[j]
    alone = not any(0 <= n < len(own) and own[n][1] == k for n in (j - 1, j + 1))
    return bool(cos[i, k] - cos[i, cur] >= (MARGIN_ONE if alone else MARGIN))


def runs(cos: np.ndarray, ok: np.ndarray, langs: list[str]) -> list[tuple[str, int, float]]:
    """(language, sentences, confidence) of the runs of one document's sentences; cos: sentences by languages."""
    if not len(cos) or not langs:
        return []
    top = cos.argmax(axis=1)
    known = [int(t) if o else -1 for t, o in zip(top, ok, strict=True)]
    if all(k < 0 for k in known):
        if cos.max() <= 0:
            return []
        known = [int(cos.sum(axis=0).argmax())] * len(known)
    own = [(i, k) for i, k in enumerate(known) if k >= 0]
    out: list[list] = []
    cur = own[0][1]
    if len(own) > 1 and own[1][1] != cur and not _apart(cos, own, 0, own[1][1]):
        cur = own[1][1]  # an unsure first sentence belongs to the second's language
    at = {i: j for j, (i, _) in enumerate(own)}
    for i, k in enumerate(known):
        if k >= 0 and k != cur and _apart(cos, own, at[i], cur):
            cur = k
        rest = np.delete(cos[i], cur).max() if len(langs) > 1 else 0.0
        conf = float(cos[i, cur] / max(cos[i, cur] + rest, 1e-9))
        if out and out[-1][0] == cur:
            out[-1][1] += 1
            out[-1][2] += conf
        else:
            out.append([cur, 1, conf])
    return [(langs[c], n, round(s / n, 4)) for c, n, s in out]


_SEGMENTS = "docid long, seg_no int, lang string, n_sentences int, confidence double, n_segments int, label string"


def segments(docs: DataFrame, model: LanguageModel, lines_model: LineModel) -> DataFrame:
    """docid, seg_no, lang, n_sentences, confidence, n_segments, label: the segments of every document's main body.

    docs: docid, text, annotations, name, features (any of the last four may be null).
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, lines_model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, lm = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 400):
                b = whole.slice(start, 400)
                rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
                spans, texts = [], []
                for _, text, notes, title, _ in rows:
                    s = body_sentences(text, notes, title, lm) if text else []
                    spans.append((len(texts), len(texts) + len(s)))
                    texts.extend(s)
                cos, ok = m.classify(texts)
                out: list[list] = [[] for _ in range(7)]
                for (docid, _, _, _, label), (i, j) in zip(rows, spans, strict=True):
                    found = runs(cos[i:j], ok[i:j], m.langs)
                    for no, (lang, n, conf) in enumerate(found):
                        for column, v in zip(out, (docid, no, lang, n, conf, len(found), label), strict=True):
                            column.append(v)
                kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [x.split()[0] for x in _SEGMENTS.split(", ")])

    label = F.try_element_at("features", F.lit("detectedLanguage"))
    return docs.select("docid", "text", "annotations", "name", label.alias("label")).mapInArrow(run, _SEGMENTS)


def label_segments(docs: DataFrame, langs: DataFrame) -> DataFrame:
    """segments with a column bad: the stored label is missing or wrong, or the text has several languages."""
    names = language_names(langs)
    lm = fit_line_model(docs)
    seg = segments(docs, fit_languages(docs, names, lm), lm)
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    label = F.lower(F.trim("label"))
    code = F.coalesce(F.try_element_at(known, label), F.try_element_at(known, F.regexp_extract(label, r"^([^-_]*)[-_]", 1)))
    return seg.withColumn("bad", (F.col("n_segments") > 1) | ~code.eqNullSafe(F.col("lang")))


def document_languages(docs: DataFrame, langs: DataFrame) -> DataFrame:
    """docid, lang, confidence, n_segments: each document's language by most sentences (ties: the first in text order).

    Documents without segments (no text, no words) have no row; rows of the same docid are one document.
    """
    s = label_segments(docs, langs).dropDuplicates(["docid", "seg_no"])
    total = s.groupBy("docid", "lang").agg(F.sum("n_sentences").alias("n"), F.min("seg_no").alias("at"), F.round(F.sum(F.col("confidence") * F.col("n_sentences")) / F.sum("n_sentences"), 4).alias("confidence"), F.max("n_segments").alias("n_segments"))
    return total.groupBy("docid").agg(F.max_by(F.struct("lang", "confidence"), F.struct("n", -F.col("at"))).alias("b"), F.max("n_segments").alias("n_segments")).select("docid", "b.lang", "b.confidence", "n_segments")
