"""Abusive, hateful and sexually explicit content: fuzzy lexicon matches scored in their context.

The lexicon (a seed of terms, and words that labelled documents show to be telling) is a trie; misspelled terms are caught by a Levenshtein
automaton run over the trie, determinised as far as texts need it. Before that, spellings that hide a term are undone: digits and signs for
letters, letters set apart, repeated or starred letters. Where a term matches, the words of a window around it, their pairs, and marks of
quotation and report are the context; a logistic model over terms and context, fitted on labelled documents, separates abuse from
quotation and sober use. A document's score is that of its most abusive sentence. Every sentence of every text is scored.

The model is fitted on at most about FIT_TOXIC documents labelled toxic and FIT_CLEAN others. Labels are of documents: each round, the
sentence of a toxic document with the highest score so far counts as its example. Without labels the seed terms decide.

Defined results: a null, empty or blank text scores 0; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, hash_sample
from .article import fold

# Seed terms, by language.
SEED = {
    "English": "fuck fucking fucker motherfucker shit shithead shitheads bullshit asshole bitch bastard cunt slut whore moron morons imbecile imbeciles idiot idiots retard fool fools worthless scum vermin cockroaches subhuman pussy cock dick tits porn porno xxx blowjob cum horny rape",
    "German": "arsch arschloch hurensohn hure scheisse scheiße ficken fick wichser fotze schlampe vollidiot damlicher fresse schnauze dreck widerliches ungeziefer missgeburt geile nackte untermenschen",
    "French": "connard connasse salope pute putain merde encule gueule ordure abruti debile baiser nues vermine crever imbécile",
    "Spanish": "mierda puta puto cabron pendejo gilipollas idiota imbecil follar desnudas callate plaga ratas coño joder estupido",
    "Slovene": "kreten bedak idioti kurac pizda prasec jebi jebe utihni crkne golazen",
    "Italian, Portuguese, Dutch, Czech, Russian": "cazzo stronzo stronza vaffanculo puttana troia merda coglione caralho foder foda porra klootzak hoer kut neuken eikel kurva debil blbec hovno сука блядь хуй дебил мразь идиот ублюдок",
}
# Words that report what someone else has said.
REPORTING = frozenset("said says wrote written quoted called sagt sagte schrieb nannte dit ecrit dijo escribio llamo dejal pravi zapisal ha detto disse zei rekl сказал".split())
THRESHOLD = 0.5
#: Labelled documents on which the model is fitted, at most about.
FIT_TOXIC, FIT_CLEAN = 1500, 4000
#: Words on either side of a term that are its context.
WINDOW = 7
#: What a seed term weighs, and the bias, before any label is seen.
PRIOR, BIAS = 2.6, -2.0
#: How strongly weights are held to what they were before: terms, context.
HOLD, HOLD_CONTEXT = 0.3, 2.0
#: Share of toxic documents among those with a word from which the word joins the lexicon; it is shrunk towards LEARN_BACK, the share
#: of a word that says nothing (some labels are wrong), as if seen in LEARN_SEEN more documents.
LEARN_SHARE, LEARN_BACK, LEARN_SEEN = 0.62, 0.12, 4
_LEET = str.maketrans({"4": "a", "@": "a", "3": "e", "€": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "8": "b"})
_SENTENCE = re.compile(r"(?<=[.!?…])[\"“”»’)]*\s+|[\r\n]+")
_RAW = re.compile(r"[^\s]+")
_SPACED = re.compile(r"(?<![^\W_])((?:[^\W_]|\$)(?:[ .\-_·]{1,2}(?:[^\W_]|\$)){1,}(?:[ .\-_·]{1,2}[^\W_]{2,})?)(?![^\W_])")
_WORDS = re.compile(r"[\w$@*]+")


class LexiconAutomaton:
    """The words within a number of edits of a lexicon term, as a lazily determinised automaton over the lexicon trie.

    A state is a set of (trie node, edits so far). Terms of up to 5 letters, and those of exact, must match exactly, others within one
    edit after their first letter; a star stands for any letter.
    """

    def __init__(self, terms: Iterable[str], exact: frozenset[str] = frozenset()):
        self.next: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allow: list[int] = [0]  # edits allowed below this node: the most of any term through it
        for t in sorted(terms):
            node, most = 0, 1 if len(t) >= 6 and t not in exact else 0
            for c in t:
                node = self.next[node].setdefault(c, len(self.next))
                if node == len(self.term):
                    self.next.append({})
                    self.term.append(None)
                    self.allow.append(0)
                self.allow[node] = max(self.allow[node], most)
            self.term[node] = t
        self.fuzzy = frozenset(t for t in terms if len(t) >= 6 and t not in exact)
        self.start = frozenset({(0, 0)})
        self.moves: dict[tuple[frozenset, str], frozenset] = {}

    def step(self, state: frozenset, c: str) -> frozenset:
        key = (state, c)
        to = self.moves.get(key)
        if to is None:
            out: set[tuple[int, int]] = set()
            for node, e in state:
                for ch, child in self.next[node].items():
                    if ch == c or c == "*":
                        out.add((child, e))
                    elif node and e < self.allow[child]:
                        out.add((child, e + 1))  # another letter
                if node and e < self.allow[node]:
                    out.add((node, e + 1))  # a letter too many
            todo = list(out)
            while todo:  # a letter missing
                node, e = todo.pop()
                for child in self.next[node].values():
                    if e < self.allow[child] and (child, e + 1) not in out:
                        out.add((child, e + 1))
                        todo.append((child, e + 1))
            to = self.moves[key] = frozenset(out)
        return to

    def match(self, word: str) -> str | None:
        """The nearest term of a word, if any."""
        state = self.start
        for c in word:
            state = self.step(state, c)
            if not state:
                return None
        best = None
        for node, e in state:
            t = self.term[node]
            if t and (e == 0 or (t in self.fuzzy and e <= 1 and "*" not in word)) and (best is None or (e, t) < best):
                best = (e, t)
        return best[1] if best else None


def seed_terms() -> list[str]:
    return sorted({w for v in SEED.values() for w in v.split()})


class AbuseModel:
    """Scores sentences and texts; memoises words per worker."""

    def __init__(self, learned: Iterable[str] = (), weights: dict[str, float] | None = None, bias: float = BIAS):
        self.learned, self.bias = frozenset(learned), bias
        self.lexicon = {fold(t) for t in seed_terms()} | self.learned
        self.weights = {f"t {t}": PRIOR for t in self.lexicon - self.learned} | (weights or {})
        self.automaton = LexiconAutomaton(self.lexicon | set(seed_terms()), self.learned - set(seed_terms()))
        self.memo: dict[str, tuple[str, str | None]] = {}

    def __getstate__(self):
        return {"learned": self.learned, "weights": self.weights, "bias": self.bias}

    def __setstate__(self, state):
        self.__init__(state["learned"], state["weights"], state["bias"])

    def word(self, raw: str) -> tuple[str, str | None]:
        """A token's plain form and the lexicon term it stands for."""
        v = self.memo.get(raw)
        if v is None:
            low = raw.lower()
            plain = fold(low)
            tries = [low, plain]
            if any(c in "0134578$@€!" for c in low) and any(c.isalpha() for c in low):
                leet = low.translate(_LEET)
                tries += [leet, fold(leet), low.replace("1", "l").translate(_LEET)]
                plain = fold(leet)
            for t in tuple(tries):
                if (short := re.sub(r"(.)\1{2,}", r"\1", t)) != t:
                    tries += [short, re.sub(r"(.)\1{2,}", r"\1\1", t)]
                    plain = fold(short)
            stars = low.count("*")
            term = None
            if not stars or (low[0] != "*" and low[-1] != "*" or len(low) > 6) and len(low) - stars >= 2 - (len(low) == 3):
                for t in tries:
                    if len(t) >= 3 and (term := self.automaton.match(t)):
                        break
            if len(self.memo) > 300_000:
                self.memo.clear()
            v = self.memo[raw] = (plain, fold(term) if term else None)
        return v

    def tokens(self, s: str) -> list[tuple[str, str | None, bool]]:
        """(plain form, term, hidden) of a sentence's words, and of letters set apart that form a term."""
        out = [(*self.word(t), "*" in t) for t in _WORDS.findall(s)]
        for m in _SPACED.findall(s):
            parts = re.split(r"[ .\-_·]+", m)
            for joined in {"".join(parts), "".join(x for x in parts if len(x) == 1)}:
                if len(joined) >= 3:
                    plain, term = self.word(joined)
                    if term:
                        out.append((plain, term, True))
        return out

    def features(self, s: str) -> list[str]:
        """Terms and context of a sentence; none if it has no term."""
        tokens = self.tokens(s)
        hits = [i for i, t in enumerate(tokens) if t[1]]
        if not hits:
            return []
        plain = [t[1] or t[0] for t in tokens]
        out = {f"t {tokens[i][1]}" for i in hits}
        near = sorted({j for i in hits for j in range(max(0, i - WINDOW), min(len(plain), i + WINDOW + 1))})
        for j in near:
            out.add(f"c {plain[j]}")
            for k in (j + 1, j + 2):
                if k < len(plain):
                    out.add(f"p {plain[j]} {plain[k]}")
        if any(t[2] for t in tokens if t[1]):
            out.add("hidden")
        if len({tokens[i][1] for i in hits}) > 1:
            out.add("several")
        if re.search(r"[\"“”„«»]", s):
            out.add("quoted report" if REPORTING.intersection(plain) else "quoted")
        return sorted(out)

    def sentence(self, s: str) -> tuple[float, list[str]]:
        """Score (a probability) and terms of a sentence."""
        f = self.features(s)
        if not f:
            return 0.0, []
        get = self.weights.get
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum([get(x, 0.0) for x in f]))))), [x[2:] for x in f if x.startswith("t ")]

    def text(self, text: str | None) -> tuple[float, list[str]]:
        """The highest sentence score of a text, and that sentence's terms."""
        best: tuple[float, list[str]] = (0.0, [])
        for s in _SENTENCE.split(text or ""):
            if s:
                v = self.sentence(s)
                if v[0] > best[0]:
                    best = v
        return best


def learned_words(words: list[set[str]], toxic: list[bool]) -> list[str]:
    """Words that labelled documents show to be telling; words: the plain words of each document."""
    pos, neg = Counter(), Counter()
    for w, y in zip(words, toxic, strict=True):
        (pos if y else neg).update(w)
    return sorted(w for w, k in pos.items() if len(w) > 2 and (k + LEARN_SEEN * LEARN_BACK) / (k + neg[w] + LEARN_SEEN) >= LEARN_SHARE)


def fit_weights(model: AbuseModel, docs: list[list[list[str]]], toxic: list[bool], rounds: int = 4, steps: int = 60) -> AbuseModel:
    """Fits weights around their prior. docs: for each document the features of its sentences that have terms."""
    code: dict[str, int] = {}
    freq = Counter(f for d in docs for s in d for f in s)
    rows, doc, y = [], [], []
    for i, (d, t) in enumerate(zip(docs, toxic, strict=True)):
        for s in d:
            rows.append([code.setdefault(f, len(code)) for f in s if freq[f] >= 3])
            doc.append(i)
            y.append(t)
    if not rows or not any(y):
        return model
    at, doc, y = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array(doc), np.array(y, bool)
    ids = np.array([f for r in rows for f in r], np.int64)
    prior = np.array([model.weights.get(f, PRIOR if f.startswith("t ") else 0.0) for f in code])
    hold = np.array([HOLD if f.startswith("t ") else HOLD_CONTEXT for f in code])
    w, bias = prior.copy(), model.bias
    for _ in range(rounds):
        z = bias + np.bincount(at, weights=w[ids], minlength=len(rows))
        best = np.full(int(doc.max()) + 1, -np.inf)
        np.maximum.at(best, doc, z)
        example = y & (z >= best[doc]) & (z > 0)  # a toxic document without any abusive sentence is labelled wrongly
        use = example | ~y
        g2, gb = np.full(len(w), 1e-3), 1e-3
        for _ in range(steps):
            z = bias + np.bincount(at, weights=w[ids], minlength=len(rows))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - example) * use
            g = np.bincount(ids, weights=err[at], minlength=len(w)) + hold * (w - prior)
            g2 += g * g
            w -= 0.4 * g / np.sqrt(g2)
            gb += err.sum() ** 2
            bias -= 0.4 * err.sum() / math.sqrt(gb)
    fitted = {f: round(float(w[k]), 4) for f, k in code.items() if abs(w[k]) > 0.02}
    return AbuseModel(model.learned, {**{f: v for f, v in model.weights.items() if f not in code}, **fitted}, float(bias))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic: the bounded sample of labelled documents; a document labelled twice is toxic if any label says so."""
    y = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    y = hash_sample(y.where("toxic > 0"), "doc_id", FIT_TOXIC).unionByName(hash_sample(y.where("toxic = 0"), "doc_id", FIT_CLEAN))
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(y), "doc_id")  # at most about FIT_TOXIC + FIT_CLEAN rows


def fit_abuse_model(rows: DataFrame) -> AbuseModel:
    """Fits the model on labelled rows (doc_id, text, toxic), a bounded sample: first the lexicon's learned words, then the weights."""
    seed = AbuseModel()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [sorted({t[0] for s in _SENTENCE.split(x) if s for t in seed.tokens(s) if t[0].isalpha()}) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], ["toxic", "words"])

    rows = cut(rows)
    t = rows.select("toxic", "text").mapInArrow(words, "toxic int, words array<string>").toArrow()
    if not t.num_rows:
        return seed
    model = AbuseModel(learned_words([set(w) for w in t.column("words").to_pylist()], [y > 0 for y in t.column("toxic").to_pylist()]))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[f for s in _SENTENCE.split(x) if s and (f := model.features(s))] for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.list_(pa.string())))], ["doc_id", "toxic", "found"])

    t = rows.select("doc_id", "toxic", "text").mapInArrow(features, "doc_id long, toxic int, found array<array<string>>").toArrow().sort_by("doc_id")
    return fit_weights(model, t.column("found").to_pylist(), [y > 0 for y in t.column("toxic").to_pylist()])


_SCORES = "doc_id long, source string, score double, terms array<string>"


def abuse_scores(docs: DataFrame, model: AbuseModel) -> DataFrame:
    """doc_id, source, score, terms: the highest sentence score of each document, and the terms found in that sentence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = [m.text(x) for x in b.column(2).to_pylist()]
            cols = [b.column(0), b.column(1), pa.array([round(s, 4) for s, _ in found], pa.float64()), pa.array([t for _, t in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "source", "score", "terms"])

    return docs.select("doc_id", "source", "text").mapInArrow(run, _SCORES)


def fitted(docs: DataFrame, labels: DataFrame) -> AbuseModel:
    return fit_abuse_model(labelled_rows(docs, labels))


def abusive(docs: DataFrame, model: AbuseModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id of the documents with a sentence at or above the threshold."""
    return abuse_scores(docs, model).where(F.col("score") >= threshold).select("doc_id")


def abuse_rates(docs: DataFrame, model: AbuseModel, threshold: float = THRESHOLD) -> DataFrame:
    """source, n_docs, n_abusive, rate, mean_score; documents without a source form the source null."""
    s = abuse_scores(docs, model)
    n_bad = F.sum((F.col("score") >= threshold).cast("long"))
    return s.groupBy("source").agg(F.count("*").alias("n_docs"), n_bad.alias("n_abusive"), F.round(n_bad / F.count("*"), 6).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score"))


def held_out(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """n, toxic, found, both, precision, recall on the labelled documents left out of the fit (one in five, by hash).

    A few labels are wrong, so neither figure can reach 1.
    """
    fold_ = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5))
    model = fit_abuse_model(labelled_rows(docs, labels.where(fold_ != 0)))
    y = labels.where("toxic is not null").where(fold_ == 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    x = abuse_scores(docs, model).join(y, "doc_id").select((F.col("toxic") > 0).cast("long").alias("y"), (F.col("score") >= threshold).cast("long").alias("f"))
    x = x.agg(F.count("*").alias("n"), F.sum("y").alias("toxic"), F.sum("f").alias("found"), F.sum(F.col("y") * F.col("f")).alias("both"))
    return x.select("*", F.round(F.try_divide("both", "found"), 4).alias("precision"), F.round(F.try_divide("both", "toxic"), 4).alias("recall"))
