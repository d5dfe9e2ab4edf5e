"""Iterative trainers in DataFrame rounds: maximum entropy by iterative scaling, batch-updated centroids, bisecting clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .models import best_of, centroids, dot, kmeans, norm


def maxent(train: DataFrame, rounds: int = 50, cut_off: int = 0) -> DataFrame:
    """label, feature, lam: generalised iterative scaling over binary features (row, label, feature, distinct).

    Weights of pairs observed at most cut_off times don't exist. One pass over examples by features per round; only the table of
    weights is carried from round to round.
    """
    x = cut(train.select("row", "label", "feature").distinct())
    obs = x.groupBy("label", "feature").agg(F.count("*").cast("double").alias("obs")).where(F.col("obs") > cut_off)
    big = x.groupBy("row").count().agg(F.max("count")).first()[0] or 1
    lam = cut(obs.withColumn("lam", F.lit(0.0)))
    rf = x.select("row", "feature")
    labels = lam.select("label").distinct()
    for _ in range(rounds):
        s = rf.join(lam, "feature").groupBy("row", "label").agg(F.sum("lam").alias("s"))
        grid = rf.select("row").distinct().join(F.broadcast(labels)).join(s, ["row", "label"], "left").select("row", "label", F.exp(F.coalesce("s", F.lit(0.0))).alias("e"))
        p = grid.select("row", "label", (F.col("e") / F.sum("e").over(Window.partitionBy("row"))).alias("p"))  # a row's labels
        exp = rf.join(p, "row").groupBy("label", "feature").agg(F.sum("p").alias("exp"))
        lam = lam.join(exp, ["label", "feature"]).select("label", "feature", "obs", (F.col("lam") + F.log(F.col("obs") / F.col("exp")) / big).alias("lam"))
        lam = cut(lam)  # read twice in the next round
    return lam.select("label", "feature", "lam")


def maxent_predict(test: DataFrame, lam: DataFrame) -> DataFrame:
    """row, label, p of every label; unknown features are ignored."""
    labels = lam.select("label").distinct()
    s = test.select("row", "feature").distinct().join(lam, "feature").groupBy("row", "label").agg(F.sum("lam").alias("s"))
    e = test.select("row").distinct().join(F.broadcast(labels)).join(s, ["row", "label"], "left").select("row", "label", F.exp(F.coalesce("s", F.lit(0.0))).alias("e"))
    return e.join(e.groupBy("row").agg(F.sum("e").alias("z")), "row").select("row", "label", (F.col("e") / F.col("z")).alias("p"))


def batch_centroids(rows: DataFrame, label: str, vec: str, row: str, rounds: int = 20, rate: float = 1.0, damping: float = 0.8) -> DataFrame:
    """label, pos, v: class sums, corrected after each round by the rows they misclassify; the rate is damped every round."""
    pts = cut(rows.select(row, F.col(label).alias("actual"), F.transform(vec, lambda x: x.cast("double")).alias("x")))
    c = centroids(pts, "actual", "x", "sum").withColumnRenamed("actual", "label")
    for _ in range(rounds):
        packed = c.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"]).alias("c"))
        unit = packed.select("label", F.transform("c", lambda v: v / F.greatest(norm(F.col("c")), F.lit(1e-12))).alias("c"))
        cs = unit.agg(F.sort_array(F.collect_list(F.struct("label", "c")), asc=False).alias("cs"))  # one row; ties go to the greater label
        best = pts.join(F.broadcast(cs)).select(row, "actual", "x", best_of(F.col("x"), F.col("cs"), dot)["label"].alias("label"))
        wrong = best.where("actual != label")
        delta = wrong.select(F.explode(F.array(F.struct(F.col("actual").alias("l"), F.lit(rate).alias("r")), F.struct(F.col("label").alias("l"), F.lit(-rate).alias("r")))).alias("d"), "x").select("d.l", "d.r", F.posexplode("x").alias("pos", "v"))
        moved = delta.groupBy(F.col("l").alias("label"), "pos").agg(F.sum(F.col("r") * F.col("v")).alias("dv"))
        c = cut(c.join(moved, ["label", "pos"], "left").select("label", "pos", (F.col("v") + F.coalesce("dv", F.lit(0.0))).alias("v")))
        rate *= damping
    return c


def bisecting(rows: DataFrame, row: str, vec: str, quality: float = 0.2, most: int = 64, rounds: int = 5) -> DataFrame:
    """row, cluster: clusters whose mean dot product with their centroid is below `quality` are split in two, breadth first.

    A cluster is a path of 0 and 1. Splits are seeded by the member nearest to and farthest from the centroid. At most `most` leaves;
    clusters of one row stay.
    """
    pts = cut(rows.select(row, F.transform(vec, lambda x: x.cast("double")).alias("x")).where(norm(F.col("x")) > 0).withColumn("cluster", F.lit("r")))
    done: set[str] = set()
    while True:
        c = centroids(pts, "cluster", "x", "nrml2").groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"]).alias("c"))
        sim = dot(F.col("x"), F.col("c")) / norm(F.col("x"))
        q = pts.join(F.broadcast(c), "cluster").withColumn("s", sim).groupBy("cluster").agg(F.avg("s").alias("q"), F.count("*").alias("n"), F.max_by("x", "s").alias("near"), F.min_by("x", "s").alias("far")).collect()
        todo = [r for r in q if r["q"] < quality and r["n"] > 1 and r["cluster"] not in done]  # at most `most` rows
        if not todo or len(q) >= most:
            return pts.select(row, "cluster")
        for r in todo:
            part = pts.where(F.col("cluster") == r["cluster"])
            seeds = rows.sparkSession.createDataFrame([(0, r["near"]), (1, r["far"])], "cluster int, c array<double>")
            got = kmeans(part, row, "x", seeds, rounds).select(row, F.concat(F.lit(r["cluster"]), F.col("cluster").cast("string")).alias("sub"))
            pts = cut(pts.join(got, row, "left").select(row, "x", F.coalesce("sub", "cluster").alias("cluster")))
            done.add(r["cluster"])
