"""Classifiers, centroids, clusterings and their evaluation over long or dense vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, stored


def dot(a: Column, b: Column) -> Column:
    """Dot product of two numeric arrays, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; null if either has length 0."""
    return F.when((norm(a) > 0) & (norm(b) > 0), dot(a, b) / (norm(a) * norm(b)))


def majority(rows: DataFrame, label: str) -> DataFrame:
    """label, n, score: the share of every label."""
    n = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return n.withColumn("score", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))  # as many rows as labels


def threshold_links(rows: DataFrame, threshold: float, block: int = 1024) -> DataFrame:
    """id, n_links of every row (id, vec; ids unique): how many others have a cosine above the threshold, 0 where none.

    Rows are numbered into blocks and every pair of blocks is one group of a matrix product, so that no task holds more than two blocks.
    """
    n = max(1, -(-rows.count() // block))
    b = rows.select("id", F.col("vec").cast("array<double>").alias("vec"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = b.select("id", "vec", F.col("block").alias("x"), every.alias("y"))
    r = b.select("id", "vec", every.alias("x"), F.col("block").alias("y"))

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "n_links": []}).astype("int64")
        a, z = (np.stack(t["vec"].to_numpy()) for t in (left, right))
        with np.errstate(divide="ignore", invalid="ignore"):
            c = (a @ z.T) / (np.sqrt((a * a).sum(1))[:, None] * np.sqrt((z * z).sum(1))[None, :])
        hit = (c > threshold) & (left["id"].to_numpy()[:, None] != right["id"].to_numpy()[None, :])
        return pd.DataFrame({"id": left["id"].to_numpy(), "n_links": hit.sum(1)})

    links = q.where("vec is not null").groupBy("x", "y").cogroup(r.where("vec is not null").groupBy("x", "y")).applyInPandas(count, "id long, n_links long")
    links = links.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    return rows.select("id").join(links, "id", "left").select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def scored_against(queries: DataFrame, rows: DataFrame, score: Column, block: int = 1024) -> DataFrame:
    """Every query row (q_id, q_vec) against every row (id, vec), in blocks of queries: q_id, id, score.

    Queries are numbered into blocks and rows repeated per block, so that the pairing is an equi-join of any size.
    """
    n = max(1, -(-queries.count() // block))
    q = queries.withColumn("block", F.pmod(F.xxhash64("q_id"), F.lit(n)))
    r = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")))
    return r.join(q, "block").where("q_id != id").select("q_id", "id", score.alias("score"), *[c for c in rows.columns if c not in ("id", "vec")])


def top_k(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of each query; ties by id."""
    r = F.row_number().over(Window.partitionBy("q_id").orderBy(F.desc("score"), "id"))
    return pairs.withColumn("rank", r).where(F.col("rank") <= k)


def centroids(rows: DataFrame, group: str, vec: str, kind: str = "avg") -> DataFrame:
    """group, pos, v: the sum, avg or nrml2 centroid of each group, in long form."""
    x = rows.select(group, F.posexplode(vec).alias("pos", "x"))
    f = F.sum(F.col("x").cast("double")) if kind == "sum" else F.avg(F.col("x").cast("double"))
    c = x.groupBy(group, "pos").agg(f.alias("v"))
    return c.withColumn("v", F.col("v") / F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy(group)))) if kind == "nrml2" else c


def unit_rows(rows: DataFrame, vec: str) -> DataFrame:
    """rows whose vector is scaled to length 1; those of length 0 or without a vector go."""
    x = rows.withColumn("_n", norm(F.col(vec))).where("_n > 0")
    return x.withColumn(vec, F.transform(F.col(vec), lambda v: F.try_divide(v.cast("double"), F.col("_n")))).drop("_n")


def centroid_table(rows: DataFrame, group: str, vec: str, kind: str = "avg", order: str | None = None) -> DataFrame:
    """One row: cs, the array of (label, c) of all groups, by label. As large as groups times dimensions, whatever the rows."""
    c = centroids(rows, group, vec, kind).groupBy(group).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("c"))
    return c.agg(F.array_sort(F.collect_list(F.struct(F.col(group).alias("label"), "c"))).alias("cs"))


def best_of(x: Column, cs: Column, score=None) -> Column:
    """struct(label, score) of the best entry of an array of (label, c); ties by rounding go to the first."""
    score = score or cosine
    each = F.transform(cs, lambda c: F.struct(score(x, c["c"]).alias("score"), c["label"].alias("label")))
    return F.reduce(each, each[0], lambda a, b: F.when(F.round(b["score"], 9) > F.round(a["score"], 9), b).otherwise(a))


def nearest_centroid(rows: DataFrame, group: str, vec: str, row: str, train: Column) -> DataFrame:
    """row, label, score of the rows outside train: the centroid with the greatest cosine; ties by label. Rows are not shuffled."""
    c = centroid_table(rows.where(train), group, vec)
    t = rows.where(~train).select(row, F.col(vec).alias("x")).join(F.broadcast(c))  # one row
    return t.select(row, best_of(F.col("x"), F.col("cs")).alias("b")).where("b is not null").select(row, F.col("b.label").alias(group), "b.score").withColumnRenamed(group, "label")


def naive_bayes(train: DataFrame, test: DataFrame) -> DataFrame:
    """row, label, score for every label: Bernoulli presence model with m-estimates; unknown features are ignored.

    train: row, label, feature; test: row, feature; both with distinct features. The score is a sum of logs.
    """
    ex = train.select("row", "label").distinct()
    n_c = ex.groupBy("label").agg(F.count("*").alias("n_c"))
    n = ex.agg(F.count("*").alias("n"), F.count_distinct("label").alias("k"))
    cls = n_c.join(F.broadcast(n)).withColumn("prior", F.log((F.col("n_c") + 2.0 / F.col("k")) / (F.col("n") + 2.0)))
    n_fc = train.groupBy("feature", "label").agg(F.count("*").alias("n_fc"))
    p0 = n_fc.groupBy("feature").agg(F.sum("n_fc").alias("n_f"))
    grid = p0.join(F.broadcast(cls)).join(n_fc, ["feature", "label"], "left")  # features by labels
    lp = F.log((F.coalesce("n_fc", F.lit(0)) + 2.0 * ((F.col("n_f") + 1.0) / (F.col("n") + 2.0))) / (F.col("n_c") + 2.0))
    s = test.join(grid.select("feature", "label", lp.alias("lp")), "feature").groupBy("row", "label").agg(F.sum("lp").alias("lp"))
    rows = test.select("row").distinct().join(F.broadcast(cls.select("label", "prior")))
    return rows.join(s, ["row", "label"], "left").select("row", "label", (F.col("prior") + F.coalesce("lp", F.lit(0.0))).alias("score"))


def confusion(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    return pred.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def precision_recall(conf: DataFrame) -> DataFrame:
    """label, precision, recall, f1 of every label seen; empty denominators give 1, f1 of two zeros 0."""
    a = conf.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("row_n"))
    p = conf.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("col_n"))
    d = conf.where("actual = predicted").select(F.col("actual").alias("label"), F.col("n").alias("diag"))
    j = a.join(p, "label", "full").join(d, "label", "left").fillna(0)
    pr = F.when(F.col("col_n") == 0, 1.0).otherwise(F.col("diag") / F.col("col_n"))
    rc = F.when(F.col("row_n") == 0, 1.0).otherwise(F.col("diag") / F.col("row_n"))
    return j.select("label", pr.alias("precision"), rc.alias("recall")).withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))


def kmeans(rows: DataFrame, row: str, vec: str, seeds: DataFrame, rounds: int = 10) -> DataFrame:
    """row, cluster, score: spherical k-means with given seeds (cluster, c) and a fixed number of rounds; ties to the smaller cluster.

    Points are scaled and stored once. A round assigns them against one broadcast row of centroids, without a shuffle, and sums them in
    one aggregation of clusters times dimensions rows; a cluster that loses all its points is gone.
    """
    pts = stored(unit_rows(rows.select(row, F.col(vec).alias("x")), "x"), "points")
    unit = unit_rows(seeds.select("cluster", "c"), "c")
    cs = unit.agg(F.array_sort(F.collect_list(F.struct(F.col("cluster").alias("label"), "c"))).alias("cs"))
    for i in range(rounds):
        got = pts.join(F.broadcast(cs)).select(row, "x", best_of(F.col("x"), F.col("cs"), dot).alias("b")).select(row, "x", F.col("b.label").alias("cluster"), "b.score")
        if i < rounds - 1:
            cs = cut(centroid_table(got, "cluster", "x", "nrml2"))
    return got.drop("x")


def mean_score(got: DataFrame) -> float:
    """The quality of a clustering: the mean similarity of rows and their centroids."""
    return float(got.agg(F.avg("score")).first()[0] or 0.0)


def seed_sets(rows: DataFrame, row: str, vec: str, k: int, trial: int) -> DataFrame:
    """cluster, c: of three pseudorandom choices of k rows the one whose rows are least alike on average."""
    out = []
    for j in range(3):
        pick = rows.where(F.col(vec).isNotNull()).orderBy(F.xxhash64(F.lit(1000 * trial + j), F.col(row)), row).limit(k).select(row, vec).collect()  # k rows
        x = np.array([[float(v) for v in r[vec]] for r in pick])
        x = x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12) if len(x) else x
        s = x @ x.T if len(x) else np.zeros((0, 0))
        out.append((float(s[np.triu_indices(len(x), 1)].mean()) if len(x) > 1 else 0.0, j, x))
    best = min(out, key=lambda t: t[:2])[2]
    return rows.sparkSession.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(best)], "cluster int, c array<double>")


def kmeans_trials(rows: DataFrame, row: str, vec: str, k: int, trials: int = 1, eps: float = 5e-4, most: int = 50) -> DataFrame:
    """row, cluster, score: the best of several k-means runs, each going on until its quality gains at most eps."""
    best, top = None, -2.0
    for t in range(trials):
        seeds, q = seed_sets(rows, row, vec, k, t), -2.0
        for _ in range(most):
            got = cut(kmeans(rows, row, vec, seeds, 1))
            new = mean_score(got)
            if new - q <= eps:
                break
            q = new
            c = centroids(got.join(rows.select(row, vec), row), "cluster", vec, "nrml2")
            seeds = cut(c.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"]).alias("c")))
        if new > top:
            best, top = got, new
    return best
