"""Linear models and hierarchical, agglomerative and incremental clusterings of dense vectors, as fit and predict over DataFrames.

Rows with a null or zero vector are left out. What reaches the driver are centroids, weights or normal equations, never rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, stored
from .models import best_of, centroid_table, centroids, cosine, dot, kmeans, norm, seed_sets, unit_rows


class LinearSvm:
    """A linear two-class machine with a bias: hinge loss and L2 penalty, minimised by full-batch subgradient rounds (hinge_weights).

    Label 1 counts as positive. The model is a table of numbers that
    can be saved and loaded.
    """

    def __init__(self, row: str, vec: str, label: str, c: float = 1.0, rounds: int = 60):
        self.row, self.vec, self.label, self.c, self.rounds = row, vec, label, c, rounds
        self.weights: list[float] = []
        self.bias = 0.0

    def fit(self, rows: DataFrame) -> LinearSvm:
        x = rows.where(F.col(self.vec).isNotNull() & F.col(self.label).isNotNull()).select(F.col(self.vec).cast("array<double>").alias("x"), F.array(F.when(F.col(self.label) == 1, 1.0).otherwise(-1.0)).alias("y"))
        w = hinge_weights(x, self.c, self.rounds)
        if len(w):
            self.weights, self.bias = [float(v) for v in w[0, :-1]], float(w[0, -1])
        return self

    def score(self):
        return dot(F.col(self.vec), F.array(*[F.lit(v) for v in self.weights])) + F.lit(self.bias)

    def predict(self, rows: DataFrame) -> DataFrame:
        """row, predicted, score: the label whose side of the plane a row lies on, and how far."""
        s = rows.where(F.col(self.vec).isNotNull()).select(self.row, self.score().alias("score"))
        return s.select(self.row, (F.col("score") > 0).cast("int").alias("predicted"), "score")

    def feature_ranks(self, spark: SparkSession) -> DataFrame:
        """feature, score: half of the squared weight, by which a linear model ranks its features."""
        return spark.createDataFrame([(i, w * w / 2) for i, w in enumerate(self.weights)], "feature int, score double")

    def explained(self, rows: DataFrame) -> DataFrame:
        """row, feature, share: what every feature adds to a row's score; feature -1 is the bias."""
        w = F.array(*[F.lit(v) for v in self.weights])
        x = rows.select(self.row, F.posexplode(F.zip_with(self.vec, w, lambda a, b: a * b)).alias("feature", "share"))
        return x.unionByName(rows.select(self.row, F.lit(-1).alias("feature"), F.lit(self.bias).alias("share")))

    def save(self, spark: SparkSession, path: str) -> None:
        state = {"row": self.row, "vec": self.vec, "label": self.label, "c": self.c, "rounds": self.rounds, "weights": self.weights, "bias": self.bias}
        spark.createDataFrame([(json.dumps(state),)], "model string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearSvm:
        state = json.loads(spark.read.parquet(path).first()["model"])
        m = cls(state["row"], state["vec"], state["label"], state["c"], state["rounds"])
        m.weights, m.bias = state["weights"], state["bias"]
        return m


def hinge_weights(rows: DataFrame, c: float, rounds: int) -> np.ndarray:
    """Weights and bias (last) of as many linear machines as rows (x, y) have targets of 1 or -1, all fitted in the same rounds.

    A round is one pass over Arrow batches, each of which sends one sum per machine and dimension. Steps decay as in Pegasos, and the
    second half of the rounds is averaged.
    """
    x = stored(rows, "svm")
    first = x.select(F.size("x"), F.size("y")).first()
    if first is None:
        return np.zeros((0, 1))
    k, m, n = first[0], first[1], x.count()
    w, avg, seen, lam = np.zeros((m, k + 1)), np.zeros((m, k + 1)), 0, 1.0 / c / n
    schema = "machine int, pos int, g double"

    def gradient(now: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g = np.zeros_like(now)
            for b in batches:
                if b.num_rows:
                    a = np.column_stack([b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), np.ones(b.num_rows)])
                    y = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    g += (y * (y * (a @ now.T) < 1)).T @ a
            i, j = np.indices(g.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(g.ravel())], ["machine", "pos", "g"])

        return run

    for t in range(1, rounds + 1):
        g = np.zeros_like(w)
        for r in x.mapInArrow(gradient(w), schema).groupBy("machine", "pos").agg(F.sum("g").alias("g")).collect():  # machines times dimensions
            g[r["machine"], r["pos"]] = r["g"]
        step = 1.0 / (t + 10)
        g[:, -1] *= 0.1
        w = np.column_stack([w[:, :-1] * (1 - step), w[:, -1]]) + step / (lam * n) * g / n
        if t > rounds // 2:
            avg += w
            seen += 1
    return avg / max(1, seen)


def one_vs_rest(train: DataFrame, test: DataFrame, row: str, vec: str, label: str, c: float = 1.0, rounds: int = 60) -> DataFrame:
    """row, predicted, score: the label whose machine against all others scores highest; ties go to the smaller label."""
    names = sorted(r[0] for r in train.select(label).where(F.col(label).isNotNull()).distinct().collect())  # as many rows as labels
    y = F.array(*[F.when(F.col(label) == v, 1.0).otherwise(-1.0) for v in names])
    w = hinge_weights(train.where(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(F.col(vec).cast("array<double>").alias("x"), y.alias("y")), c, rounds)
    cs = train.sparkSession.createDataFrame([([(v, [float(z) for z in u]) for v, u in zip(names, w, strict=True)],)], f"cs array<struct<label:{dict(train.dtypes)[label]},c:array<double>>>")
    x = test.where(F.col(vec).isNotNull()).select(row, F.concat(F.col(vec).cast("array<double>"), F.array(F.lit(1.0))).alias("x")).join(F.broadcast(cs))  # one row
    return x.select(row, best_of(F.col("x"), F.col("cs"), dot).alias("b")).select(row, F.col("b.label").alias("predicted"), "b.score")


def least_squares(rows: DataFrame, features: list[str], target: str) -> DataFrame:
    """feature, weight without an intercept: the normal equations are summed in one aggregation and solved on the driver.

    Rows with a null in any column are left out; dependent features share their weight (least norm).
    """
    x = rows.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]]).dropna()
    k = len(features)
    sums = [F.sum(F.col(features[i]) * F.col(features[j])) for i in range(k) for j in range(i, k)] + [F.sum(F.col(f) * F.col(target)) for f in features]
    got = [float(v or 0.0) for v in x.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
    a = np.zeros((k, k))
    a[np.triu_indices(k)] = got[: k * (k + 1) // 2]
    a = a + a.T - np.diag(np.diag(a))
    w = np.linalg.lstsq(a, np.array(got[k * (k + 1) // 2 :]), rcond=None)[0]
    return rows.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(features, w, strict=True)], "feature string, weight double")


def agglomerative(rows: DataFrame, row: str, vec: str, leaves: int = 20, rounds: int = 5, damping: float = 0.9, share: float = 0.2, terms: int = 1000) -> DataFrame:
    """row, leaf, path: k-means leaves merged pair by pair into a tree; path leads from the root (0 and 1) to the row's leaf.

    The pair with the greatest similarity times damping ** (mean level) is merged next. A merged centroid keeps its greatest terms, less
    those that make up the lightest share, scaled to length 1. Leaves are built in Spark, the tree of at most `leaves` centroids here.
    """
    pts = unit_rows(rows.select(row, vec), vec)
    got = cut(kmeans(pts, row, vec, seed_sets(pts, row, vec, leaves, 0), rounds))
    sums = centroids(got.join(pts, row), "cluster", vec, "sum").groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"]).alias("c")).collect()
    spark = rows.sparkSession
    if not sums:
        return spark.createDataFrame([], f"{row} {dict(rows.dtypes)[row]}, leaf int, path string")
    nodes = {int(r["cluster"]): (np.array(r["c"]), 0, [int(r["cluster"])]) for r in sums}
    paths = {k: "" for k in nodes}
    unit = {k: c / max(float(np.sqrt((c * c).sum())), 1e-12) for k, (c, _, _) in nodes.items()}
    nxt = max(nodes) + 1
    while len(nodes) > 1:
        ids = sorted(nodes)
        a, b = max(((i, j) for n, i in enumerate(ids) for j in ids[n + 1 :]), key=lambda p: (float(unit[p[0]] @ unit[p[1]]) * damping ** ((nodes[p[0]][1] + nodes[p[1]][1]) / 2), -p[0], -p[1]))
        for side, k in (("0", a), ("1", b)):
            for leaf in nodes[k][2]:
                paths[leaf] = side + paths[leaf]
        c = nodes[a][0] + nodes[b][0]
        w = np.abs(c)
        keep = np.argsort(-w, kind="stable")[:terms]
        upto = np.cumsum(w[keep][::-1])
        light = keep[::-1][upto < share * upto[-1]]
        trimmed = np.zeros_like(c)
        trimmed[keep] = c[keep]
        trimmed[light] = 0.0
        nodes[nxt] = (c, max(nodes[a][1], nodes[b][1]) + 1, nodes[a][2] + nodes[b][2])
        unit[nxt] = trimmed / max(float(np.sqrt((trimmed * trimmed).sum())), 1e-12)
        del nodes[a], nodes[b]
        nxt += 1
    tree = spark.createDataFrame(sorted(paths.items()), "leaf int, path string")
    return got.join(F.broadcast(tree), got.cluster == tree.leaf).select(row, "leaf", "path")


def incremental_topics(rows: DataFrame, row: str, vec: str, batch: str, window: int = 4, quality: float = 0.2, most: int = 64) -> DataFrame:
    """batch, row, topic: topics of a window of batches that keep their ids while the window moves.

    Each batch drops the rows that left the window, assigns the new ones to the nearest centroid, and re-runs. While the mean similarity
    is below `quality` the worst topic is split (the larger half keeps the id); while it is above, and rows were dropped, the two most
    similar topics are merged (the larger keeps the id). The topics, at most `most`, are what the driver holds.
    """
    spark = rows.sparkSession
    pts = cut(unit_rows(rows.where(F.col(batch).isNotNull()).select(row, F.transform(vec, lambda v: v.cast("double")).alias("x"), F.col(batch).alias("batch")), "x"))
    state: dict[int, list[float]] = {}
    nxt, out = 0, None

    def assign(part: DataFrame, topics: dict[int, list[float]]) -> tuple[DataFrame, dict[int, tuple[list[float], int, float]]]:
        got = part
        for _ in range(3):
            cs = spark.createDataFrame([(sorted((k, v) for k, v in topics.items()),)], "cs array<struct<label:int,c:array<double>>>")
            got = cut(part.join(F.broadcast(cs)).select(row, "x", "batch", best_of(F.col("x"), F.col("cs"), dot).alias("b")).select(row, "x", "batch", F.col("b.label").alias("topic"), "b.score"))
            c = centroids(got, "topic", "x", "nrml2").groupBy("topic").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"]).alias("c"))
            info = {r["topic"]: (r["c"], r["n"], r["q"]) for r in c.join(got.groupBy("topic").agg(F.count("*").alias("n"), F.avg("score").alias("q")), "topic").collect()}
            topics = {k: v[0] for k, v in info.items()}
        return got, info

    def mean(info: dict) -> float:
        return sum(n * q for _, n, q in info.values()) / max(1, sum(n for _, n, _ in info.values()))

    for b in sorted(r[0] for r in pts.select("batch").distinct().collect()):  # one row a batch
        part = pts.where((F.col("batch") <= b) & (F.col("batch") > b - window))
        dropped = pts.where(F.col("batch") == b - window).limit(1).count() > 0
        if not state:
            state, nxt = {0: part.orderBy(row).first()["x"]}, 1
        got, info = assign(part, state)
        while mean(info) < quality and len(info) < most:
            worst = min(info, key=lambda k: (info[k][2], k))
            far = got.where(F.col("topic") == worst).agg(F.min_by("x", "score")).first()[0]
            new, new_info = assign(part, {k: v[0] for k, v in info.items()} | {nxt: far})
            if len(new_info) <= len(info):
                break
            if new_info.get(nxt, (0, 0))[1] > new_info.get(worst, (0, 0))[1]:  # the larger keeps the id
                new = new.withColumn("topic", F.when(F.col("topic") == nxt, worst).when(F.col("topic") == worst, nxt).otherwise(F.col("topic")))
                new_info[worst], new_info[nxt] = new_info[nxt], new_info[worst]
            got, info, nxt = new, new_info, nxt + 1
        while dropped and len(info) > 1 and mean(info) > quality:
            ids = sorted(info)
            x, y = max(((i, j) for n, i in enumerate(ids) for j in ids[n + 1 :]), key=lambda p: (float(np.dot(info[p[0]][0], info[p[1]][0])), -p[0], -p[1]))
            keep, gone = (x, y) if info[x][1] >= info[y][1] else (y, x)
            new, new_info = assign(part, {k: v[0] for k, v in info.items() if k != gone})
            if mean(new_info) < quality:
                break
            got, info = new, new_info
            _ = keep
        state = {k: v[0] for k, v in info.items()}
        rows_now = got.where(F.col("batch") == b).select("batch", row, "topic")
        out = rows_now if out is None else out.unionByName(rows_now)
    return out if out is not None else pts.select("batch", row, F.lit(0).alias("topic")).where("false")


def categorise(train: DataFrame, test: DataFrame, row: str, vec: str, path: str, tolerance: float = 0.9) -> DataFrame:
    """row, category, score: categories of a tree, level by level, by the nearest centroids below each prefix.

    path: slash-separated categories of the training rows. Every child whose score is at least tolerance times the best child's is gone
    into; a score of 0 or less ends the branch. Only centroids travel.
    """
    depth = train.agg(F.max(F.size(F.split(path, "/")))).first()[0] or 0
    x = cut(test.where((norm(F.col(vec)) > 0)).select(row, F.transform(vec, lambda v: v.cast("double")).alias("x")))
    front, out = x.select(row, "x", F.lit("").alias("at")), None
    for level in range(1, depth + 1):
        p = F.split(path, "/")
        t = train.where((F.size(p) >= level) & F.col(vec).isNotNull()).select(F.array_join(F.slice(p, 1, level), "/").alias("node"), F.array_join(F.slice(p, 1, level - 1), "/").alias("at"), F.transform(vec, lambda v: v.cast("double")).alias("v"))
        cs = centroid_table(t, "node", "v").select(F.explode("cs").alias("c")).join(t.select("node", "at").distinct().withColumnRenamed("at", "parent"), F.col("c.label") == F.col("node"))
        cs = cs.groupBy("parent").agg(F.array_sort(F.collect_list("c")).alias("cs"))
        scored = front.join(cs, front["at"] == cs["parent"]).withColumn("all", F.transform("cs", lambda c: F.struct(cosine(F.col("x"), c["c"]).alias("score"), c["label"].alias("node"))))
        top = F.array_max(F.transform("all", lambda s: s["score"]))
        front = scored.select(row, "x", F.explode(F.filter("all", lambda s: (s["score"] > 0) & (s["score"] >= tolerance * top))).alias("s"))
        front = cut(front.select(row, "x", F.col("s.node").alias("at"), F.col("s.score").alias("score")))
        got = front.select(row, F.col("at").alias("category"), F.round("score", 6).alias("score"))
        out = got if out is None else out.unionByName(got)
        front = front.drop("score")
    return out if out is not None else x.select(row, F.lit("").alias("category"), F.lit(0.0).alias("score")).where("false")
