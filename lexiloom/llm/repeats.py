"""Records of new batches that repeat an accepted record: a segment index for edit distance over article words.

An article becomes the string of its words (case, accents, punctuation and furniture ignored). Its telling words, those that few
documents have, form a symbol string that is cut into segments of about SEGMENT symbols at every length; the index stores each segment with
the string's length and the segment's position. A batch probes with the substrings of its own strings that may equal a segment of a string
not longer than itself: by pigeonhole, fewer edits of telling words than segments leave one segment whole. That covers edits that hit up to
one telling word in SEGMENT; edits that fall mostly on telling words may exceed it (README). Candidates are verified by the bit-parallel edit distance of
the whole articles. Accepted records append their segments; a batch never reads earlier texts except those of its candidates.

find_repeats runs all batches of a corpus at once: the order of document ids alone decides which record is accepted, so the result is
that of one batch after the other. Groups of exact copies stay one node. All pairs of texts that share a segment are compared; the pairs
of a hot segment are dealt to many tasks.

Defined results: records without hash, address and article repeat nothing; articles under MIN_WORDS words repeat by hash,
as identical texts, or (from four words on) as the beginning of a text at the same address; articles without words by hash only.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, may_have, shared_dir, stored
from .article import _TOKEN, LineModel, body_mask, fit_line_model, fold, mended_lines

#: Share of an article's words that may differ: about one in eight, with room for a line the body model mistakes.
RATE = 0.16
#: Words from which articles are compared for near copies; shorter ones repeat by equality or as beginnings.
MIN_WORDS = 8
#: Telling words of a segment.
SEGMENT = 4
#: Texts of one address that are compared pair by pair.
SMALL = 16
#: Words of a key of an address's texts.
PIECE = 6
#: Texts of a segment that one task compares.
FAMILY = 64
#: Ids (8 bytes each) that may be broadcast at once.
BROADCAST_IDS = 1_000_000
#: Share of all articles that makes a word common.
COMMON = 0.006
#: Parts of the stored articles; a batch reads only those that hold a candidate.
PARTS = 64


def article_words(text: str | None, notes: list | None, title: str | None, model: LineModel) -> list[str]:
    """The words of the main body in text order, folded."""
    lines = mended_lines(text)
    keep = body_mask(lines, notes, model, title)
    return [t for (_, x), ok in zip(lines, keep, strict=True) if ok for t in _TOKEN.findall(fold(x)) if t[0].isalnum()]


def url_key(c: Column) -> Column:
    """An address without scheme, port, www., fragment, tracking parameters, closing slash and case."""
    u = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    u = F.regexp_replace(u, r"#.*$|^www\d?\.", "")
    u = F.regexp_replace(u, r"^([^/?]*?)\.?:\d+", "$1")
    u = F.regexp_replace(u, r"(?<=[?&])(?:utm_[a-z]+|fbclid|gclid|ref)=[^&]*(?:&|$)", "")
    u = F.regexp_replace(F.regexp_replace(u, r"[?&/]+$", ""), r"^([^/?]+)/+", "$1/")
    return F.when(u != "", u)


def edit_distance(a: list, b: list, limit: int) -> int:
    """Levenshtein distance of two sequences (Myers' bit vectors), or limit + 1 if it is greater."""
    m, n = len(a), len(b)
    if abs(m - n) > limit:
        return limit + 1
    if not m:
        return n
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, d = mask, 0, m
    for j, y in enumerate(b):
        x = where.get(y, 0) | vn
        d0 = (((x & vp) + vp) ^ vp) | x
        hn, hp = vp & d0, (vn | ~(vp | d0)) & mask
        d += 1 if hp & top else -1 if hn & top else 0
        if d - (n - 1 - j) > limit:
            return limit + 1
        x = (hp << 1 | 1) & mask
        vn, vp = x & d0, (hn << 1 | ~(x | d0)) & mask
    return min(d, limit + 1)


def agree(a: list[str], b: list[str], rate: float = RATE) -> bool:
    """Whether two articles agree in all but the allowed share of words."""
    n = max(len(a), len(b))
    limit = int(n * rate)
    if abs(len(a) - len(b)) > limit or sum((Counter(a) & Counter(b)).values()) < n - limit:
        return False
    return edit_distance(a, b, limit) <= limit


def begins(b: list[str], a: list[str], rate: float = RATE) -> bool:
    """Whether b is the beginning of a (its last word may be cut off)."""
    if len(b) < 4 or len(b) > len(a):
        return False
    b, a = b[:-1], a[: len(b) - 1]
    return b == a or edit_distance(b, a, int(len(b) * rate / 2)) <= int(len(b) * rate / 2)


def n_segments(r: int) -> int:
    """How many segments a symbol string of length r has: as the allowed edits, they grow with it."""
    return max(4, r // SEGMENT) if r >= 8 else 2


def symbols(words: list[str], common: frozenset[str]) -> list[str]:
    """The telling words; all words if they are too few. Short ones and numbers tell little: garbled text is full of them."""
    s = [w for w in words if len(w) >= 4 and w not in common and w.isalpha()]
    return s if len(s) >= 6 else words


class Segmenter:
    """Segments and probes of symbol strings as 64-bit keys."""

    def __init__(self, common: frozenset[str]):
        self.common, self.memo = common, {}
        self.power = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(4096)], np.uint64)

    def codes(self, words: list[str]) -> np.ndarray:
        memo, out = self.memo, []
        for w in symbols(words, self.common):
            v = memo.get(w)
            if v is None:
                if len(memo) > 300_000:
                    memo.clear()
                v = memo[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
            out.append(v)
        return np.array(out, np.uint64)

    def windows(self, c: np.ndarray, size: int) -> np.ndarray:
        n = len(c) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = np.full(n, size * 0x2545F491 & 0xFFFFFFFF, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                h = h * np.uint64(0x100000001B3) + c[k : k + n] * self.power[k % 4096]
        return h

    def segments(self, c: np.ndarray) -> list[tuple[int, int]]:
        """(key, position) of a string's segments."""
        r = len(c)
        size = max(1, r // n_segments(r))
        w = self.windows(c, size)
        return [(int(w[i * size]), i * size) for i in range(n_segments(r)) if i * size < len(w)]

    def probes(self, c: np.ndarray) -> list[tuple[int, int]]:
        """(key, position) of the substrings that may equal a segment of a string at most as long."""
        r = len(c)
        sizes = {max(1, x // n_segments(x)) for x in range(max(1, int(r * 0.7)), r + 1)}
        return [(int(h), i) for s in sorted(sizes) for i, h in enumerate(self.windows(c, s))]


def signed(k: int) -> int:
    """An unsigned 64-bit number as a signed one."""
    return k - (1 << 64) if k >= 1 << 63 else k


def records(docs: DataFrame, written: DataFrame, model: LineModel) -> DataFrame:
    """docid, hash, url, norm (article words, null if there are none), tkey (64-bit hash of norm), one row per record."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                b = whole.slice(start, 1000)
                out = []
                for text, notes, title in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                    w = article_words(text, notes, title, m) if text else []
                    out.append(" ".join(w) if w else None)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["docid", "norm"])

    articles = docs.select("docid", "text", "annotations", "name").mapInArrow(run, "docid long, norm string").dropDuplicates(["docid"])
    w = written.groupBy("docid").agg(F.min("hash").alias("hash"), F.min(url_key(F.col("urlkey"))).alias("url"))
    j = w.join(articles, "docid", "full")
    return j.withColumn("tkey", F.when(F.col("norm").isNotNull(), F.xxhash64("norm")))


def common_words(recs: DataFrame, share: float = COMMON) -> frozenset[str]:
    """Words that at least this share of all articles has: at most (mean distinct words / share) words, however many articles there are.

    Counts are combined map-side, so a task sends one row a word.
    """
    s = recs.where("norm is not null")
    n = s.count()
    df = s.select(F.explode(F.array_distinct(F.split("norm", " "))).alias("w")).groupBy("w").count().where(F.col("count") >= max(4, n * share))
    return frozenset(r["w"] for r in df.collect())


_KEYS = "tkey long, first long, kind string, h long, pos int, r int"


def segment_keys(texts: DataFrame, common: frozenset[str]) -> DataFrame:
    """tkey, first (document id), kind (i: index, p: probe), h, pos, r of every text; texts: tkey, first, norm."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Segmenter(shared.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                b = whole.slice(start, 500)
                out: list[list] = [[] for _ in range(6)]
                for tkey, first, norm in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    c = s.codes(norm.split(" "))
                    for kind, keys in (("i", s.segments(c)), ("p", s.probes(c))):
                        n = len(keys)
                        for column, v in zip(out, ([tkey] * n, [first] * n, [kind] * n, [signed(k) for k, _ in keys], [p for _, p in keys], [len(c)] * n), strict=True):
                            column.extend(v)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [x.split()[0] for x in _KEYS.split(", ")])

    return texts.select("tkey", "first", "norm").mapInArrow(run, _KEYS)


def verified(pairs: DataFrame, texts: DataFrame, how: str = "agree") -> DataFrame:
    """The pairs (a, b by tkey) whose articles agree, or of which b begins a.

    Only the texts of candidates move: while their ids are few (at most BROADCAST_IDS, counted), they are sent to the texts.
    """
    pairs = cut(pairs)
    ids = cut(pairs.select(F.col("a").alias("tkey")).union(pairs.select("b")).distinct())
    t = texts.select("tkey", "norm").join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "tkey")
    j = pairs.join(t.select(F.col("tkey").alias("a"), F.col("norm").alias("na")), "a").join(t.select(F.col("tkey").alias("b"), F.col("norm").alias("nb")), "b").select("a", "b", "na", "nb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                p = whole.slice(start, 1000)
                ok = []
                for x, y in zip(p.column(2).to_pylist(), p.column(3).to_pylist(), strict=True):
                    x, y = x.split(" "), y.split(" ")
                    ok.append(agree(x, y) if how == "agree" else begins(y, x))
                keep = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([p.column(0).filter(keep), p.column(1).filter(keep)], ["a", "b"])

    return j.mapInArrow(run, "a long, b long")


def _compatible() -> Column:
    """Positions and lengths that fewer edits than segments allow."""
    shift = F.greatest(F.lit(4), F.col("p_r") / 3)
    return (F.col("p_tkey") != F.col("tkey")) & (F.abs(F.col("p_pos") - F.col("pos")) <= shift) & (F.col("r") <= F.col("p_r"))


def near_links(texts: DataFrame, common: frozenset[str]) -> DataFrame:
    """a, b (tkeys): different texts that agree and share a segment; texts: tkey, first, norm, one row per text.

    All pairs of a segment are compared, whatever the number of texts that hold it. Of a segment that more than FAMILY texts hold, the
    texts are dealt to parts of about FAMILY and the probes go to every part, so no task makes all pairs of a hot segment. A family of n
    near-copies costs n * n / 2 comparisons: none can be left out before it is known which records are accepted.
    """
    keys = stored(segment_keys(texts.where(F.size(F.split("norm", " ")) >= MIN_WORDS), common), "segments")
    idx = keys.where("kind = 'i'").select("h", "tkey", "pos", "r")
    prb = keys.where("kind = 'p'").select("h", F.col("tkey").alias("p_tkey"), F.col("pos").alias("p_pos"), F.col("r").alias("p_r"))
    often = cut(idx.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > FAMILY).select("h", F.ceil(F.col("n") / FAMILY).alias("parts")))
    pair = (F.least("tkey", "p_tkey").alias("a"), F.greatest("tkey", "p_tkey").alias("b"))
    pairs = idx.join(often, "h", "left_anti").join(prb, "h").where(_compatible()).select(*pair)
    hot_i = idx.join(often, "h").withColumn("part", F.pmod(F.xxhash64("tkey"), F.col("parts"))).drop("parts")
    hot_p = prb.join(often, "h").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    pairs = pairs.unionByName(hot_i.join(hot_p, ["h", "part"]).where(_compatible()).select(*pair))
    return cut(verified(pairs.distinct(), texts))


def _starts(b: list[str]) -> list[tuple[int, int, str]]:
    """(size, position, words) of the first words of the pieces of b, one of which any text that b begins holds about there."""
    m = len(b) - 1
    pieces = int(m * RATE / 2) + 1
    size = m // pieces
    n = min(PIECE, size)
    return [(n, i * size, " ".join(b[i * size : i * size + n])) for i in range(pieces)]


def prefix_keys(per: DataFrame, texts: DataFrame) -> DataFrame:
    """url, tkey, kind (b: pieces of a possible beginning, a: windows of the text it may begin), h, pos, m (words); per: url, tkey."""
    t = per.select("url", "tkey").join(texts.select("tkey", "norm"), "tkey").select("url", "tkey", "norm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                out: list[list] = [[] for _ in range(6)]
                for url, tkey, norm in zip(*(c.to_pylist() for c in whole.slice(start, 200).columns), strict=True):
                    w = norm.split(" ")
                    keys = [("b", *k) for k in _starts(w)] if len(w) >= 4 else []
                    keys += [("a", PIECE, i, " ".join(w[i : i + PIECE])) for i in range(len(w) - PIECE + 1)]
                    keys += [("a", n, 0, " ".join(w[:n])) for n in range(3, min(PIECE, len(w) + 1))]
                    for kind, n, i, x in keys:
                        h = int.from_bytes(hashlib.blake2b(f"{n} {x}".encode(), digest_size=8).digest(), "little", signed=True)
                        for column, v in zip(out, (url, tkey, kind, h, i, len(w)), strict=True):
                            column.append(v)
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["url", "tkey", "kind", "h", "pos", "m"])

    return t.mapInArrow(run, "url string, tkey long, kind string, h long, pos int, m int")


def address_links(recs: DataFrame, texts: DataFrame) -> DataFrame:
    """url, a, b (tkeys): texts of one address where b is the beginning of the earlier a.

    Copies of one text at one address count once. Up to SMALL texts of an address are compared pair by pair. Of more, b is cut into one
    piece more than begins() allows edits, so one piece stays whole and stands in a, shifted by no more than the edits: the same pairs.
    """
    per = recs.where("url is not null and tkey is not null").groupBy("url", "tkey").agg(F.min("docid").alias("first"), F.max("docid").alias("last"))
    n = per.groupBy("url").agg(F.count("*").alias("n")).where("n > 1")
    per = cut(per.join(n, "url"))
    x = per.select("url", F.col("tkey").alias("a"), F.col("first").alias("first_a"), "n")
    y = per.select("url", F.col("tkey").alias("b"), F.col("last").alias("last_b"))
    cand = x.where(F.col("n") <= SMALL).join(y, "url").where((F.col("a") != F.col("b")) & (F.col("first_a") < F.col("last_b"))).select("url", "a", "b")
    keys = stored(prefix_keys(per.where(F.col("n") > SMALL), texts), "prefixes")
    ka = keys.where("kind = 'a'").select("url", "h", F.col("tkey").alias("a"), F.col("pos").alias("pa"), F.col("m").alias("ma"))
    kb = keys.where("kind = 'b'").select("url", "h", F.col("tkey").alias("b"), F.col("pos").alias("pb"), F.col("m").alias("mb"))
    edits = F.floor((F.col("mb") - 1) * F.lit(RATE / 2))
    hot = ka.join(kb, ["url", "h"]).where((F.col("a") != F.col("b")) & (F.col("mb") <= F.col("ma")) & (F.abs(F.col("pa") - F.col("pb")) <= edits)).select("url", "a", "b").distinct()
    hot = hot.join(x.drop("n"), ["url", "a"]).join(y, ["url", "b"]).where("first_a < last_b").select("url", "a", "b")
    cand = cut(cand.unionByName(hot))
    ok = verified(cand.select("a", "b").distinct(), texts, "begins")
    return cand.join(ok, ["a", "b"]).select("url", "a", "b").distinct()


def settle(recs: DataFrame, near: DataFrame, heads: DataFrame) -> DataFrame:
    """docid_a, docid_b: each record b that repeats an accepted record a < b (the smallest such a).

    recs: docid, hash, url, tkey. near: a, b (tkeys). heads: url, a, b (tkeys; b begins a). Works on ids only; every round decides at
    least the earliest undecided record of each connected group, usually all but a few.
    """
    hs = recs.where("hash is not null").groupBy("hash").count().where("count > 1").select("hash", F.lit(True).alias("h2"))
    ts = recs.where("tkey is not null").groupBy("tkey").count().where("count > 1").select("tkey")
    linked = ts.unionByName(near.select(F.col("a").alias("tkey"))).unionByName(near.select(F.col("b").alias("tkey"))).unionByName(heads.select(F.col("a").alias("tkey"))).unionByName(heads.select(F.col("b").alias("tkey"))).distinct().withColumn("t2", F.lit(True))
    live = recs.select("docid", "hash", "url", "tkey").join(hs, "hash", "left").join(linked, "tkey", "left").where("h2 or t2").select("docid", "hash", "url", "tkey", F.lit(False).alias("accepted"))
    live = cut(live)
    sides = cut(near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    heads = cut(heads)
    done = None
    while True:
        by_h = live.where("hash is not null").groupBy("hash").agg(F.min("docid").alias("m1"))
        by_t = live.where("tkey is not null").groupBy("tkey").agg(F.min("docid").alias("m2"))
        by_n = sides.join(by_t, sides.a == by_t.tkey).groupBy("b").agg(F.min("m2").alias("m3")).withColumnRenamed("b", "tkey")
        first = live.where("url is not null and tkey is not null").groupBy("url", "tkey").agg(F.min("docid").alias("m")).withColumnRenamed("tkey", "a")
        by_u = heads.join(first, ["url", "a"]).groupBy("url", "b").agg(F.min("m").alias("m4")).withColumnRenamed("b", "tkey")
        todo = live.where(~F.col("accepted")).join(by_h, "hash", "left").join(by_t, "tkey", "left").join(by_n, "tkey", "left").join(by_u, ["url", "tkey"], "left")
        smaller = F.array_min(F.filter(F.array("m1", "m2", "m3", "m4"), lambda m: m < F.col("docid")))
        todo = todo.select("docid", smaller.alias("best"))
        ok = live.where("accepted").select(F.col("docid").alias("best"), F.lit(True).alias("sure"))
        todo = cut(todo.join(ok, "best", "left"))
        # what nothing earlier may repeat is accepted now, and what repeats one of these is settled in the same round
        new = todo.where("best is null").select("docid")
        hit = todo.where("best is not null").join(new.select(F.col("docid").alias("best"), F.lit(True).alias("now")), "best", "left").where("sure or now").select(F.col("best").alias("docid_a"), F.col("docid").alias("docid_b"))
        done = cut(hit if done is None else done.unionByName(hit))
        live = cut(live.join(done.select(F.col("docid_b").alias("docid")), "docid", "left_anti").join(new.withColumn("now", F.lit(True)), "docid", "left").select("docid", "hash", "url", "tkey", (F.col("accepted") | F.coalesce("now", F.lit(False))).alias("accepted")))
        if live.where(~F.col("accepted")).isEmpty():
            return done


def find_repeats(docs: DataFrame, written: DataFrame) -> DataFrame:
    """docid_a, docid_b: one row for each record b that repeats an accepted record a < b."""
    recs = stored(records(docs, written, fit_line_model(docs)), "records")
    return repeats_among(recs, common_words(recs))


class SegmentIndex:
    """The accepted records of all committed batches: ids (docid, hash, url, tkey), texts (tkey, norm, part) and segments (h, tkey).

    A batch's tables are written first and its commit last; what a broken run left behind is not read, and written anew. A new batch reads
    of the history the narrow ids and segments, which pass a filter of fixed size where they lie, and of the texts the parts that hold
    its candidates.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def batches(self) -> list[int]:
        glob = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/batch=*/_SUCCESS")
        found = glob.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(glob) or []
        return sorted(int(f.getPath().getParent().getName()[6:]) for f in found)

    def read(self, name: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{name}/batch={n}" for n in self.batches()]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def ids(self) -> DataFrame:
        return self.read("ids", "docid long, hash string, url string, tkey long").select("docid", "hash", "url", "tkey")

    def texts(self) -> DataFrame:
        return self.read("texts", "tkey long, norm string, part int").select("tkey", "norm", "part")

    def segments(self, kind: str) -> DataFrame:
        return self.read("segments", "h long, tkey long, kind string").where(F.col("kind") == kind).select("h", F.col("tkey").alias("o"))

    def commit(self, taken: DataFrame, common: frozenset[str]) -> None:
        """Adds accepted records (docid, hash, url, tkey, norm) as the next batch."""
        n = max(self.batches(), default=0) + 1
        one = taken.where("tkey is not null").groupBy("tkey").agg(F.min("docid").alias("first"), F.first("norm").alias("norm"))
        one = stored(one, "accepted")
        to = lambda name: f"{self.path}/{name}/batch={n}"
        part = F.pmod("tkey", F.lit(PARTS)).cast("int").alias("part")
        one.select("tkey", "norm", part).repartition("part").write.mode("overwrite").partitionBy("part").parquet(to("texts"))
        segment_keys(one.where(F.size(F.split("norm", " ")) >= MIN_WORDS), common).select("h", "tkey", "kind").write.mode("overwrite").partitionBy("kind").parquet(to("segments"))
        taken.select("docid", "hash", "url", "tkey").write.mode("overwrite").parquet(to("ids"))
        self.spark.range(1).write.mode("overwrite").parquet(to("commits"))


def start_index(index_dir: str, docs: DataFrame, written: DataFrame, model: LineModel) -> tuple[frozenset[str], DataFrame]:
    """Loads a first, large batch into an empty index; returns the list of common words that later batches keep, and the batch's repeats."""
    recs = stored(records(docs, written, model), "records")
    common = common_words(recs)
    found = cut(repeats_among(recs, common))
    SegmentIndex(docs.sparkSession, index_dir).commit(recs.join(found.select(F.col("docid_b").alias("docid")), "docid", "left_anti"), common)
    return common, found


def repeats_among(recs: DataFrame, common: frozenset[str]) -> DataFrame:
    """docid_a, docid_b of records (docid, hash, url, norm, tkey) that are compared with each other."""
    one = recs.where("tkey is not null").groupBy("tkey").agg(F.min("docid").alias("first"))
    texts = stored(recs.select("docid", "norm").join(one.select("first", F.col("tkey").alias("k")), F.col("docid") == F.col("first")).select(F.col("k").alias("tkey"), "first", "norm"), "texts")
    return settle(recs, near_links(texts, common), address_links(recs, texts))


def append_batch(index_dir: str, docs: DataFrame, written: DataFrame, model: LineModel, common: frozenset[str]) -> DataFrame:
    """Checks one batch against the index below index_dir, appends what it accepts, and returns docid_a, docid_b of its repeats.

    Batches are given in order; model and common stay those the index was begun with. Records whose docid is stored already are skipped.
    """
    index = SegmentIndex(docs.sparkSession, index_dir)
    new = stored(records(docs, written, model), "batch")
    ids = index.ids()
    new = stored(new.join(may_have(ids, "docid", new, "docid").select("docid"), "docid", "left_anti"), "new")
    texts = new.where("tkey is not null").groupBy("tkey").agg(F.first("norm").alias("norm"), F.min("docid").alias("first"))
    keys = stored(segment_keys(texts.where(F.size(F.split("norm", " ")) >= MIN_WORDS), common), "keys")
    near = None
    for mine, theirs in (("p", "i"), ("i", "p")):
        k = keys.where(F.col("kind") == mine).select("h").distinct()
        x = may_have(index.segments(theirs), "h", k, "h").join(k, "h", "left_semi").select(F.col("o").alias("tkey"))
        near = x if near is None else near.unionByName(x)
    near = near.unionByName(new.where("tkey is not null").select("tkey")).distinct()
    old = None
    for rows, key in ((new.select("hash"), "hash"), (new.select("url"), "url"), (near, "tkey")):
        rows = rows.where(F.col(key).isNotNull()).distinct()
        x = may_have(ids, key, rows, key).join(rows, key, "left_semi").select("docid", "hash", "url", "tkey")
        old = x if old is None else old.unionByName(x)
    old = stored(old.distinct(), "touched")
    parts = [r["part"] for r in old.where("tkey is not null").select(F.pmod("tkey", F.lit(PARTS)).alias("part")).distinct().collect()]  # at most PARTS
    norms = index.texts().where(F.col("part").isin(parts)).join(old.select("tkey").distinct(), "tkey", "left_semi").select("tkey", "norm")
    both = stored(old.join(norms, "tkey", "left").select(*new.columns).unionByName(new), "both")
    found = repeats_among(both, common).join(new.select(F.col("docid").alias("docid_b")), "docid_b").select("docid_a", "docid_b")
    found = cut(found)
    index.commit(new.join(found.select(F.col("docid_b").alias("docid")), "docid", "left_anti"), common)
    return found


def newest_batch_repeats(docs: DataFrame, written: DataFrame) -> DataFrame:
    """docid_a, docid_b of the newest batch (by batchno), checked against an index of all earlier ones.

    A record delivered in several batches belongs to the first of them.
    """
    spark = docs.sparkSession
    path = os.path.join(shared_dir(spark), f"index-{uuid.uuid4().hex}")
    model = fit_line_model(docs)
    batch = stored(written.groupBy("docid").agg(F.min("batchno").alias("batchno")), "batches")
    last = batch.agg(F.max("batchno")).first()[0]
    newest = batch.where(F.col("batchno") == F.lit(last)).select("docid")
    common, _ = start_index(path, docs.join(newest, "docid", "left_anti"), written.join(newest, "docid", "left_anti"), model)
    return append_batch(path, docs.join(newest, "docid", "left_semi"), written.join(newest, "docid", "left_semi"), model, common)


