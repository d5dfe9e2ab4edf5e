"""Garbled text from wrong decoding: latent encoding chains found by expectation-maximisation, repair by posterior.

A chain says with which codec a text's bytes were written and with which they were read. The language model is the corpus's own table of
words with characters beyond ASCII (all that stand twice or more: a word's only place is no evidence for itself) and a character
bigram model beneath it. EM over that table divides each word's count between "as written" and "garbled by chain z from word v", so garbled
forms leave the model; the table stays distributed and its rounds are joins. Then, per line, log likelihood ratios of the chains are summed
over its words: the VOCABULARY most frequent words are in memory, and the counts of all others come by a join to the lines whose judgement
may depend on them. A second EM gives each
pool (source and declared charset) its own chain shares, so weak evidence adds up across records. A line is garbled if the posterior of
"as written" is below one half. Lost characters (replacement signs, or question marks in place of letters) can't be restored, only found.

Defined results: a null or empty text has no lines; text without its accents and rare right characters are no case.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import FILTER_BITS, cut, may_have, stored

#: Words whose counts executors hold in memory; those of the others are joined.
VOCABULARY = 60_000
_WORD = re.compile(r"[^ \t\r\n]*[^\x00-\x7f][^ \t\r\n]*")
_HIGH = re.compile(r"[^\x00-\x7f]+")
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Fixed values: (codec the bytes were written in, codec they were read in), once or twice.
CHAINS = (
    ("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1250"), ("utf-8", "iso8859-2"), ("utf-8", "cp1251"), ("utf-8", "koi8-r"), ("utf-8", "cp866"),
    ("utf-8", "mac-roman"), ("utf-8", "cp437"), ("utf-8", "cp850"), ("utf-8", "cp852"), ("utf-8", "cp1254"), ("utf-8", "iso8859-15"),
    ("cp1252", "cp1250"), ("cp1252", "iso8859-2"), ("cp1250", "cp1252"), ("iso8859-2", "cp1252"), ("iso8859-2", "cp1250"), ("cp1250", "iso8859-2"),
    ("cp1251", "cp1252"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("koi8-r", "cp1252"), ("cp866", "cp1252"), ("iso8859-5", "cp1252"), ("iso8859-5", "cp1251"),
    ("cp1252", "mac-roman"), ("mac-roman", "cp1252"), ("cp1252", "cp850"), ("cp850", "cp1252"), ("cp1252", "cp437"), ("cp437", "cp1252"), ("cp1250", "cp852"), ("cp852", "cp1250"), ("cp852", "cp1252"), ("cp1250", "cp850"), ("cp1252", "cp1251"), ("cp1250", "cp1251"),
)
DOUBLE = (("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1250"), ("utf-8", "cp1251"))
N_CHAINS = len(CHAINS) + len(DOUBLE)
#: What it says, as a log likelihood ratio, that a word's bytes form valid UTF-8 at all: clean words hardly ever do.
VALID_UTF8 = 5.0
BONUS = tuple(VALID_UTF8 if z >= len(CHAINS) or CHAINS[z][0] == "utf-8" else 0.0 for z in range(N_CHAINS))
LOST = re.compile(r"�|(?<=[^\W\d_])\?(?=[^\W\d_])|(?:(?<=^)|(?<=[\s“„«(]))\?+(?=[^\W\d_?])|(?<=[^\W\d_])\?(?=[,;])")
_URL = re.compile(r"\S+://\S+|\S+\.\S+/\S*\?\S*")


@functools.cache
def _to_bytes(codec: str) -> dict[str, int]:
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)  # browsers pass such bytes on
        out.setdefault(c, b)
    return out


@functools.cache
def _swap(written: str, read: str) -> dict[str, str]:
    out = {}
    for c, b in _to_bytes(read).items():
        try:
            out[c] = bytes([b]).decode(written)
        except UnicodeDecodeError:
            pass
    return out


def undo(word: str, written: str, read: str) -> str | None:
    """The word before it was read in the wrong codec; None if that can't have happened or changes nothing."""
    if written != "utf-8":
        table = _swap(written, read)
        out = []
        for c in word:
            if c >= "\x80":
                c = table.get(c)
                if c is None:
                    return None
            out.append(c)
        s = "".join(out)
        return s if s != word else None
    table, raw = _to_bytes(read), bytearray()
    for c in word:
        b = ord(c)
        if b >= 128:
            b = table.get(c)
            if b is None:
                return None
        raw.append(b)
    try:
        s = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return s if s != word else None


def undo_chain(word: str, z: int) -> str | None:
    """Chain number z undone."""
    if z < len(CHAINS):
        return undo(word, *CHAINS[z])
    once = undo(word, *DOUBLE[z - len(CHAINS)])
    return undo(once, *DOUBLE[z - len(CHAINS)]) if once and _HIGH.search(once) else None


#: The codecs quick_repair undoes; in the others clean Cyrillic looks like UTF-8 too often.
_QUICK = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "mac-roman", "cp437", "cp850", "cp852", "cp1254", "iso8859-15")


@functools.cache
def _pair(read: str) -> re.Pattern:
    """A lead byte of UTF-8 and a byte that continues it, as read in another codec."""
    table = _to_bytes(read)
    lead, rest = ("".join(re.escape(c) for c, b in table.items() if lo <= b < hi) for lo, hi in ((0xC2, 0xF5), (0x80, 0xC0)))
    return re.compile(f"[{lead}][{rest}]")


def quick_repair(line: str) -> str:
    """The line with byte sequences of UTF-8 that were read in another codec put right; needs no model."""
    for _ in range(2):
        words: set[str] = set()
        for read in _QUICK:
            if not _pair(read).search(line):
                continue
            words = words or set(_WORD.findall(line))
            done = {}
            for w in words:
                u = undo(w, "utf-8", read)
                if u is None:
                    break
                done[w] = u
            else:
                break
        else:
            return line
        line = _WORD.sub(lambda m: done[m[0]], line)
    return line


def core(word: str) -> str:
    return word.strip(_EDGE).lower()


class WordModel:
    """Log probabilities of words with characters beyond ASCII.

    counts are those of the words in memory. The bits of rest mark all words beyond them (and some that are in no table); none of these
    counts more than ceiling.
    """

    def __init__(self, counts: dict[str, float], bigrams: dict[str, float], total: float, rest: bytes = b"", ceiling: float = 0.0, kappa: float = 50.0):
        self.counts, self.bigrams, self.kappa = counts, bigrams, kappa
        self.rest, self.ceiling, self.total = rest, ceiling, total + kappa

    def char_log(self, w: str) -> float:
        get, p, v = self.bigrams.get, " ", 0.0
        for c in w + " ":
            v += get(p + c, -9.0)
            p = c
        return v

    def log(self, word: str, count: float | None = None) -> float:
        """count: what the word counts, if not what memory says."""
        if not _HIGH.search(word):
            return -7.0  # a plain ASCII word: as likely as a middling known word
        n = self.counts.get(word, 0.0) if count is None else count
        return math.log((n + self.kappa * math.exp(max(-60.0, self.char_log(word)))) / self.total)

    def open(self, word: str) -> bool:
        """Whether the word's count may be one that is not in memory."""
        if not self.rest or word in self.counts or word.isascii():
            return False
        i = zlib.crc32(word.encode()) & ((1 << FILTER_BITS) - 1)
        return self.rest[i >> 3] >> (i & 7) & 1 == 1


def char_bigrams(counts: DataFrame) -> dict[str, float]:
    """Log probabilities of a character after another, from weighted words (w, c). The pairs of characters are no more for more words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Counter()
        for b in batches:
            for w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                p = " "
                for c in w + " ":
                    pair[p + c] += n
                    p = c
        yield pa.RecordBatch.from_arrays([pa.array(list(pair), pa.string()), pa.array(list(pair.values()), pa.float64())], ["k", "n"])

    pairs = counts.select("w", "c").mapInArrow(run, "k string, n double").groupBy("k").agg(F.sum("n").alias("n")).orderBy("k").collect()
    first = Counter()
    for k, n in pairs:
        first[k[0]] += n
    kinds = max(1, len({k[1] for k, _ in pairs}))
    return {k: math.log((n + 0.01) / (first[k[0]] + 0.01 * kinds)) for k, n in pairs}


_EDGES = "w string, n double, z int, v string"


def _origins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word (w, n) as written (z = -1) and every word v it may be garbled from."""
    for b in batches:
        out: list[list] = [[], [], [], []]
        for w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            for z, v in [(-1, w), *((z, c) for z in range(N_CHAINS) if (v := undo_chain(w, z)) and (c := core(v)))]:
                for column, x in zip(out, (w, n, z, v), strict=True):
                    column.append(x)
        kinds = (pa.string(), pa.float64(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [x.split()[0] for x in _EDGES.split(", ")])


def _shared_out(edges: DataFrame, counts: DataFrame, model: WordModel, share: dict[int, float]) -> DataFrame:
    """v, z, m: how much of the words' counts goes to v by chain z in one round; v is null where nothing beyond ASCII is left of it."""
    clean = 1 - sum(share.values())
    prior = {-1: math.log(max(clean, 1e-6))} | {z: math.log(x) + BONUS[z] for z, x in share.items()}
    shared = edges.sparkSession.sparkContext.broadcast((model, prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, before = shared.value
        for b in batches:
            out: list[list] = [[], [], []]
            for n, ways in zip(*(c.to_pylist() for c in b.columns), strict=True):
                logs = [m.log(x["v"], x["c"]) + before[x["z"]] for x in ways]
                top = max(logs)
                weights = [math.exp(x - top) for x in logs]
                s = sum(weights)
                for x, weight in zip(ways, weights, strict=True):
                    if x["z"] < 0 or weight / s > 1e-4:
                        for column, y in zip(out, (x["v"] if _HIGH.search(x["v"]) else None, x["z"], n * weight / s), strict=True):
                            column.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.string(), pa.int32(), pa.float64()), strict=True)], ["v", "z", "m"])

    known = edges.join(counts.select(F.col("w").alias("v"), "c"), "v", "left")
    ways = known.groupBy("w", "n").agg(F.array_sort(F.collect_list(F.struct("z", "v", F.coalesce("c", F.lit(0.0)).alias("c")))).alias("ways"))
    return ways.select("n", "ways").mapInArrow(run, "v string, z int, m double")


def fit_words(table: DataFrame, rounds: int = 4) -> tuple[DataFrame, dict[str, float]]:
    """EM over a word table (w, c): each count is shared between the word itself and the words it may be garbled from.

    Returns the table of counts that leaves, and the character bigrams. Words stay distributed: a round is a join of words and origins.
    """
    counts = stored(table, "words")
    total = counts.agg(F.sum("c")).first()[0] or 0.0
    edges = stored(counts.select("w", "c").mapInArrow(_origins, _EDGES), "origins")
    share, left = {z: 0.05 / N_CHAINS for z in range(N_CHAINS)}, total
    for _ in range(rounds):
        masses = stored(_shared_out(edges, counts, WordModel({}, char_bigrams(counts), left), share), "masses")
        new_share = dict(masses.groupBy("z").agg(F.sum("m")).collect())
        share = {z: max(1e-6, (new_share.get(z, 0.0) + 0.01) / (total + 1)) for z in range(N_CHAINS)}
        counts = stored(masses.where("v is not null").groupBy(F.col("v").alias("w")).agg(F.sum("m").alias("c")).where("c > 0.05"), "words")
        left = counts.agg(F.sum("c")).first()[0] or 0.0
    return counts, char_bigrams(counts)


def in_memory(counts: DataFrame, bigrams: dict[str, float], limit: int = VOCABULARY) -> tuple[WordModel, DataFrame | None]:
    """The model with the most frequent words, at most limit, and the table (w, c) of all others, None if there are none."""
    n, total = counts.agg(F.count("*"), F.sum("c")).first()
    top = counts.orderBy(F.desc("c"), "w").limit(limit).collect()
    hot = {r["w"]: r["c"] for r in top}
    if n <= limit:
        return WordModel(hot, bigrams, total or 0.0), None
    last = top[-1]
    rest = counts.where((F.col("c") < last["c"]) | ((F.col("c") == last["c"]) & (F.col("w") > last["w"])))
    at = F.crc32(F.encode("w", "UTF-8")).bitwiseAND((1 << FILTER_BITS) - 1)
    marked = rest.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("b")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), "<i8")
    bits[marked.column("i").to_numpy()] = marked.column("b").to_numpy()
    return WordModel(hot, bigrams, total, bits.tobytes(), last["c"]), rest


def word_table(docs: DataFrame) -> DataFrame:
    """w, c: counts of the words beyond ASCII over all documents, of those that stand twice or more."""
    words = docs.where("text is not null").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([^ \t\r\n]*[^\x00-\x7F][^ \t\r\n]*)"), F.lit(1))).alias("w"))
    core_ = F.regexp_replace("w", r"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$", "")
    return words.select(core_.alias("w")).groupBy("w").agg(F.count("*").cast("double").alias("c")).where("c >= 2")


class LineJudge:
    """Log likelihood ratios of the chains against "as written" for one line; memoises words.

    Where counts are open (not in memory), a word's ratios are the highest they may be, until known gives the counts; what it lacks counts 0.
    """

    FLOOR = -12.0

    def __init__(self, model: WordModel):
        self.model, self.memo = model, {}

    def ratios(self, w: str, known: dict[str, float] | None = None) -> tuple[dict[int, float], tuple[str, ...]]:
        """The ratio of each chain (-2: the best any chain does), and the words whose counts are open."""
        c, m = core(w), self.model
        origins = [(z, core(u)) for z in range(N_CHAINS) if (u := undo_chain(w, z))]
        open_ = {x for x in (c, *(u for _, u in origins)) if m.open(x)} if origins else set()
        if known is not None:
            count = {x: known.get(x, 0.0) for x in open_}
            own = count.get(c)
        else:
            count = dict.fromkeys(open_, m.ceiling)
            own = 0.0 if c in open_ else None
        own = m.log(c, own) if c else -7.0
        v = {z: max(self.FLOOR, min(25.0, m.log(u, count.get(u)) - own + BONUS[z])) for z, u in origins}
        v[-2] = max(v.values(), default=self.FLOOR)
        return v, tuple(open_)

    def word(self, w: str) -> tuple[dict[int, float], tuple[str, ...]]:
        v = self.memo.get(w)
        if v is None:
            v = self.ratios(w)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[w] = v
        return v

    def line(self, words: list[str], known: dict[str, float] | None = None) -> tuple[dict[int, float], set[str]]:
        """Chains that may have garbled the line of these words; a word that a chain can't have made counts heavily against it.

        If counts that matter are open, these words are returned, and the chains are those that are possible.
        """
        if not words:
            return {}, set()
        word = self.word
        judged = [word(w) for w in words]
        if known is not None:
            judged = [self.ratios(w, known) if j[1] else j for w, j in zip(words, judged, strict=True)]
        per = [j[0] for j in judged]
        if sum([p[-2] for p in per]) <= -6:
            return {}, set()
        zs = set().union(*per) - {-2}
        out = {}
        for z in zs:
            s = sum(p.get(z, self.FLOOR) for p in per)
            if s > -6:
                out[z] = s
        return out, set().union(*(j[1] for j in judged)) if out and known is None else set()


def lost(line: str) -> bool:
    """Whether characters of the line were lost: replacement signs, or question marks where letters belong."""
    if "�" in line:
        return True
    return "?" in line and LOST.search(_URL.sub(" ", line)) is not None


_SUSPECTS = "docid long, line_no int, z int, llr double"
_JUDGED = _SUSPECTS + ", words array<string>, open array<string>"
_KINDS = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()))


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=False)], [x.split()[0] for x in schema.split(", ")])


def suspects(docs: DataFrame, model: WordModel, rest: DataFrame | None = None) -> DataFrame:
    """docid, line_no, z, llr: every line with the chains that may have garbled it; z = -1 for lost characters.

    Lines that memory can't decide travel as their words beyond ASCII and are judged again with the counts of rest.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = LineJudge(shared.value)
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for docid, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not text or (text.isascii() and "?" not in text):
                    continue
                for i, line in enumerate(text.split("\n")):
                    words, open_ = None, None
                    if lost(line):
                        found = {-1: 50.0}
                    elif line.isascii():
                        continue
                    else:
                        found, open_ = judge.line(words := _WORD.findall(line))
                    for z, llr in [(None, None)] if open_ else found.items():
                        for column, v in zip(out, (docid, i, z, llr, words if open_ else None, sorted(open_) if open_ else None), strict=True):
                            column.append(v)
            yield _batch(out, _JUDGED)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = LineJudge(shared.value)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for docid, i, words, known in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for z, llr in judge.line(words, {x["w"]: x["c"] for x in known or ()})[0].items():
                    for column, v in zip(out, (docid, i, z, llr), strict=True):
                        column.append(v)
            yield _batch(out, _SUSPECTS)

    judged = docs.select("docid", "text").mapInArrow(run, _JUDGED)
    if rest is None:
        return judged.select("docid", "line_no", "z", "llr")
    judged = stored(judged, "judged")
    undecided = judged.where("open is not null")
    known = undecided.select("docid", "line_no", F.explode("open").alias("w")).distinct().join(rest, "w")
    known = known.groupBy(F.col("docid").alias("_d"), F.col("line_no").alias("_l")).agg(F.collect_list(F.struct("w", "c")).alias("known"))
    decided = undecided.join(known, F.col("docid").eqNullSafe(F.col("_d")) & (F.col("line_no") == F.col("_l")), "left")
    decided = decided.select("docid", "line_no", "words", "known").mapInArrow(again, _SUSPECTS)
    return judged.where("open is null").select("docid", "line_no", "z", "llr").unionByName(decided)


def posteriors(sus: DataFrame, rounds: int = 2, start: float = 0.02) -> DataFrame:
    """docid, line_no, z, p: the most probable chain of each suspect line and the posterior that it is garbled.

    sus holds suspect lines only. The chain shares of a pool start even and are re-estimated over all its suspect lines,
    beginning from what the whole table says; rows of a line are few, so each round is one small aggregation.
    """
    prior = F.lit(start / N_CHAINS)
    cur = sus.withColumn("prior", F.when(F.col("z") == -1, 0.5).otherwise(prior))
    line = ["docid", "pool", "line_no"]
    for r in range(rounds + 1):
        weight = F.col("prior") * F.exp(F.least(F.col("llr"), F.lit(60.0)))
        scored = cur.withColumn("wt", weight).groupBy(*line).agg(F.sum("wt").alias("s"), F.collect_list(F.struct("z", "llr", "wt")).alias("c"))
        scored = scored.select(*line, F.inline(F.transform("c", lambda x: F.struct(x["z"].alias("z"), x["llr"].alias("llr"), (x["wt"] / (F.col("s") + 1 - start)).alias("p")))))
        if r == rounds:
            break
        n = scored.groupBy("pool").agg(F.count_distinct("docid", "line_no").alias("n"))
        share = scored.groupBy("pool", "z").agg(F.sum("p").alias("sp")).join(n, "pool")
        share = share.select("pool", "z", F.greatest(F.lit(1e-5), F.least(F.lit(0.9), (F.col("sp") + start / N_CHAINS) / (F.col("n") + 20))).alias("prior"))
        cur = cut(sus.join(share, ["pool", "z"])) if r == 0 else sus.join(share, ["pool", "z"])
    best = scored.groupBy("docid", "line_no").agg(F.max_by("z", F.struct("p", -F.col("z"))).alias("z"), F.sum("p").alias("p"))
    return best


def with_pool(sus: DataFrame, written: DataFrame) -> DataFrame:
    """Adds the pool: site and declared charset of the written document, if any. Only suspect lines' ids move."""
    w = written.groupBy("docid").agg(F.concat_ws("|", F.coalesce(F.min("siteid"), F.min("domainname"), F.lit("")), F.lower(F.coalesce(F.min("charset"), F.lit("")))).alias("pool"))
    return sus.join(w, "docid", "left").withColumn("pool", F.coalesce("pool", F.lit("")))


def garbled_lines(docs: DataFrame, written: DataFrame, vocabulary: int = VOCABULARY) -> DataFrame:
    """docid, line_no, z: lines with garbled or lost characters (z = -1), and the chain that made them.

    vocabulary: how many words' counts are held in memory; the result does not depend on it.
    """
    model, rest = in_memory(*fit_words(word_table(docs)), vocabulary)
    sus = stored(suspects(docs, model, rest), "suspects")
    sus = stored(with_pool(sus, written), "pooled")
    return posteriors(sus).where("p > 0.5").select("docid", F.col("line_no").cast("int").alias("line_no"), "z")


def repaired_lines(docs: DataFrame, written: DataFrame) -> DataFrame:
    """docid, line_no, line, repaired, lossless: garbled lines and their text put right where nothing was lost.

    The line numbers of a document travel as one row; lines are cut out and repaired inside the text.
    """
    bad = garbled_lines(docs, written).groupBy("docid").agg(F.collect_list(F.struct("line_no", "z")).alias("bad"))

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for docid, text, found in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lines = text.split("\n")
                for x in found:
                    line, z = lines[x["line_no"]], x["z"]
                    right = _WORD.sub(lambda m, z=z: undo_chain(m[0], z) or m[0], line) if z >= 0 else line
                    for column, v in zip(out, (docid, x["line_no"], line, right, z >= 0), strict=True):
                        column.append(v)
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["docid", "line_no", "line", "repaired", "lossless"])

    with_bad = may_have(docs.select("docid", "text"), "docid", bad, "docid").join(bad, "docid")
    return with_bad.select("docid", "text", "bad").mapInArrow(fix, "docid long, line_no int, line string, repaired string, lossless boolean")
