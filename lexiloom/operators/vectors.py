"""Bag-of-words spaces in long form (row, term, weight): counting, weighting, cutting, normalising, keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ngrams, simple_tokens


def terms(docs: DataFrame, text: str = "text", row: str = "doc_id", max_n: int = 1, min_len: int = 1, stop_words: DataFrame | None = None) -> DataFrame:
    """row, term: one row per occurrence. Stop words go before n-grams form, so n-grams bridge them."""
    toks = simple_tokens(F.lower(F.col(text)), "alpha", min_len)
    d = docs.select(row, toks.alias("t"))
    if stop_words is not None:
        x = d.select(row, F.posexplode("t").alias("pos", "w")).join(F.broadcast(stop_words.select("w")), "w", "left_anti")
        d = x.groupBy(row).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "w"))), lambda s: s["w"]).alias("t"))
    grams = F.concat(*[ngrams(F.col("t"), n) for n in range(1, max_n + 1)])
    return d.select(row, F.explode(grams).alias("term"))


def frequencies(occ: DataFrame, row: str = "doc_id") -> DataFrame:
    """term, freq, df of occurrences."""
    tf = occ.groupBy(row, "term").agg(F.count("*").alias("tf"))
    return tf.groupBy("term").agg(F.sum("tf").alias("freq"), F.count("*").alias("df"))


def weights(occ: DataFrame, n_docs: Column, row: str = "doc_id", kind: str = "tfidf", min_freq: int = 1) -> DataFrame:
    """row, term, w: tf, tfidf (tf ln(N/df)) or logdf (ln(1+df) tf ln(N/df)); zero weights are dropped.

    Term counts come from the already aggregated (row, term) table, so occurrences are shuffled once.
    """
    tf = occ.groupBy(row, "term").agg(F.count("*").alias("tf"))
    voc = tf.groupBy("term").agg(F.sum("tf").alias("freq"), F.count("*").alias("df")).where(F.col("freq") >= min_freq)
    j = tf.join(voc, "term")
    idf = F.log(n_docs.cast("double") / F.col("df"))
    w = {"tf": F.col("tf").cast("double"), "tfidf": F.col("tf") * idf, "logdf": F.log1p(F.col("df").cast("double")) * F.col("tf") * idf}[kind]
    return j.select(row, "term", w.alias("w")).where("w != 0")


def cut_low(v: DataFrame, share: float = 0.2, row: str = "doc_id") -> DataFrame:
    """Drops each row's lightest weights: all below the first at which the running sum reaches the share of the total."""
    if share <= 0:
        return v
    up = Window.partitionBy(row).orderBy("w", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = v.withColumn("run", F.sum("w").over(up)).withColumn("total", F.sum("w").over(Window.partitionBy(row)))
    x = x.withColumn("at", F.min(F.when(F.col("run") >= F.col("total") * share - F.lit(1e-12), F.col("w"))).over(Window.partitionBy(row)))
    return x.where("w >= at").drop("run", "total", "at")


def l2(v: DataFrame, row: str = "doc_id") -> DataFrame:
    """Each row scaled to length 1."""
    return v.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(row))))


def keywords(v: DataFrame, n: int, row: str = "doc_id") -> DataFrame:
    """row, rank, term, w of the n heaviest terms; ties by term."""
    r = F.row_number().over(Window.partitionBy(row).orderBy(F.desc("w"), "term"))
    return v.withColumn("rank", r).where(F.col("rank") <= n)


def window_weights(docs: DataFrame, size: int, order: str = "doc_id", safe: bool = False) -> DataFrame:
    """doc_id, term, w over the newest `size` documents: tf ln(W/df), or tf ln((W+1)/df) if safe; zeros are kept."""
    new = docs.orderBy(F.desc(order)).limit(size)
    tf = terms(new).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = new.agg(F.count("*").alias("n"))
    return tf.join(df, "term").join(F.broadcast(n)).select("doc_id", "term", (F.col("tf") * F.log((F.col("n") + int(safe)) / F.col("df"))).alias("w"))


def simhash(occ: DataFrame, row: str = "doc_id") -> DataFrame:
    """row, fingerprint: 64 signed sums over the terms' 64-bit hashes, bit i set where the sum is not negative."""
    from ..functions.text import hash64

    tf = occ.groupBy(row, "term").agg(F.count("*").alias("tf")).withColumn("h", hash64(F.col("term")))
    sums = [F.sum(F.when(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(1)) == 1, F.col("tf")).otherwise(-F.col("tf"))).alias(f"b{i}") for i in range(64)]
    bits = tf.groupBy(row).agg(*sums)
    word = F.lit(0).cast("bigint")
    for i in range(64):
        word = word.bitwiseOR(F.when(F.col(f"b{i}") >= 0, F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("bigint"))
    return bits.select(row, word.alias("fingerprint"))


def near_fingerprints(fp: DataFrame, k: int = 3, row: str = "doc_id") -> DataFrame:
    """a, b, distance of different fingerprints at most k <= 3 bits apart, by representatives (equal ones share theirs).

    Five blocks of 13, 13, 13, 13 and 12 bits; ten tables keyed by two blocks each find every pair with at most three differing bits.
    """
    rep = fp.groupBy("fingerprint").agg(F.min(row).alias("id"))
    cuts, at = [], 0
    for size in (13, 13, 13, 13, 12):
        cuts.append(F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit((1 << size) - 1)))
        at += size
    keys = F.array(*[F.xxhash64(F.lit(i * 5 + j), cuts[i], cuts[j]) for i in range(5) for j in range(i + 1, 5)])
    t = rep.select("id", "fingerprint", F.explode(keys).alias("key"))
    o = t.select(F.col("id").alias("id2"), F.col("fingerprint").alias("f2"), "key")
    d = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("f2")))
    return t.join(o, "key").where((F.col("id") < F.col("id2")) & (d <= k)).select(F.col("id").alias("a"), F.col("id2").alias("b"), d.alias("distance")).distinct()


def fingerprint_members(fp: DataFrame, row: str = "doc_id") -> DataFrame:
    """row, representative: the smallest row of each fingerprint stands for all that have it in near_fingerprints."""
    rep = fp.groupBy("fingerprint").agg(F.min(row).alias("representative"))
    return fp.join(rep, "fingerprint").select(row, "representative")


def best_forms(occ: DataFrame, row: str, pos: str, form: str) -> DataFrame:
    """term, form: the most frequent spelling of every lower-case term; ties go to the one that is seen first (by row, then position)."""
    c = occ.groupBy(F.lower(F.col(form)).alias("term"), F.col(form).alias("form")).agg(F.count("*").alias("n"), F.min(F.struct(row, pos)).alias("at"))
    best = c.groupBy("term").agg(F.min_by("form", F.struct(-F.col("n"), F.col("at"))).alias("form"))
    return best.select("term", "form")
