"""Graphs as vertices(id) and edges(src, dst, w): ranking, reachability, components, Laplacian, SimRank."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()


def pagerank(edges: DataFrame, rounds: int, damping: float = 0.85) -> DataFrame:
    """id, rank after a fixed number of rounds; missing mass goes evenly to all vertices."""
    v = cut(vertices_of(edges))
    n = v.count()
    share = F.col("w") / F.col("out")
    e = cut(edges.join(edges.groupBy("src").agg(F.sum("w").alias("out")), "src").select("src", "dst", share.alias("p")))
    r = v.withColumn("rank", F.lit(1.0 / n))
    for _ in range(rounds):
        got = e.join(r, e.src == r.id).groupBy("dst").agg(F.sum(F.col("rank") * F.col("p")).alias("got"))
        r = cut(v.join(got, v.id == got.dst, "left").select("id", F.coalesce("got", F.lit(0.0)).alias("got")))  # read twice below
        lost = r.agg((1 - F.sum("got")).alias("lost"))
        r = r.join(F.broadcast(lost)).select("id", (damping * (F.col("got") + F.col("lost") / n) + (1 - damping) / n).alias("rank"))
    return r


def ranked(edges: DataFrame, sources: DataFrame | None = None, damping: float = 0.85, eps: float = 1e-5, most: int = 10_000) -> DataFrame:
    """id, rank, personalised to sources (id) or to all vertices: rounds until the ranks move by at most eps in all, or `most` rounds.

    All weights must be positive. Mass that dead ends lose goes evenly to the sources, as do the jumps. The change is measured every fifth
    round.
    """
    v = vertices_of(edges)
    src = v if sources is None else sources.select("id").distinct().join(v, "id", "left_semi")
    n = src.count()
    v = cut(v.join(src.withColumn("is_source", F.lit(True)), "id", "left").select("id", F.coalesce("is_source", F.lit(False)).cast("int").alias("is_source")))
    e = cut(edges.join(edges.groupBy("src").agg(F.sum("w").alias("out")), "src").select("src", "dst", (F.col("w") / F.col("out")).alias("p")))
    r = v.withColumn("rank", F.col("is_source") / F.lit(float(n)))
    for i in range(most):
        got = e.join(r, e.src == r.id).groupBy("dst").agg(F.sum(F.col("rank") * F.col("p")).alias("got"))
        new = v.join(r.select("id", F.col("rank").alias("was")), "id").join(got, v.id == got.dst, "left").select("id", "is_source", "was", F.coalesce("got", F.lit(0.0)).alias("got"))
        new = cut(new)  # read twice below
        lost = new.agg(F.greatest(F.lit(0.0), 1 - F.sum("got")).alias("lost"))
        new = new.join(F.broadcast(lost)).withColumn("got", F.col("got") + F.col("is_source") * F.when(F.col("lost") >= 1e-6, F.col("lost") / n).otherwise(0.0))
        new = new.select("id", "is_source", "was", (damping * F.col("got") + F.col("is_source") * (1 - damping) / n).alias("rank"))
        if i % 5 == 4 and new.agg(F.sum(F.abs(F.col("rank") - F.col("was")))).first()[0] <= eps:
            return new.select("id", "rank")
        r = new.drop("was")
    return r.select("id", "rank")


def inverted(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *[c for c in edges.columns if c not in ("src", "dst")])


def without_loops(edges: DataFrame) -> DataFrame:
    return edges.where("src != dst")


def symmetrised(edges: DataFrame, f: Callable[[Column, Column], Column] = lambda a, b: a + b) -> DataFrame:
    """src, dst, w: f of the upper and the lower value where both directions exist, else the one that is there; loops stay."""
    up = edges.where("src < dst").select("src", "dst", F.col("w").alias("a"))
    low = edges.where("src > dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("w").alias("b"))
    both = up.join(low, ["src", "dst"], "full")
    w = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), f(F.col("a"), F.col("b"))).otherwise(F.coalesce("a", "b"))
    half = both.select("src", "dst", w.alias("w"))
    return half.unionByName(inverted(half).select("src", "dst", "w")).unionByName(edges.where("src = dst").select("src", "dst", "w"))


def predicates(edges: DataFrame, eps: float = 1e-9) -> DataFrame:
    """n_vertices, n_edges, sparseness, is_positive, is_non_negative, has_loops, is_undirected of a graph, in one row."""
    n = vertices_of(edges).agg(F.count("*").alias("n_vertices"))
    e = edges.agg(F.count("*").alias("n_edges"), F.coalesce(F.bool_and(F.col("w") > 0), F.lit(True)).alias("is_positive"), F.coalesce(F.bool_and(F.col("w") >= 0), F.lit(True)).alias("is_non_negative"), F.coalesce(F.bool_or(F.col("src") == F.col("dst")), F.lit(False)).alias("has_loops"))
    u = edges.select("src", "dst", "w").unionByName(inverted(edges).select("src", "dst", (-F.col("w")).alias("w"))).groupBy("src", "dst").agg(F.sum("w").alias("w"), F.count("*").alias("k"))
    u = u.agg(F.coalesce(F.bool_and((F.abs("w") <= eps) & (F.col("k") % 2 == 0)), F.lit(True)).alias("is_undirected"))
    one = n.join(F.broadcast(e)).join(F.broadcast(u))  # one row each
    cells = F.col("n_vertices") * F.col("n_vertices")
    return one.select("n_vertices", "n_edges", F.try_divide(cells - F.col("n_edges"), cells).alias("sparseness"), "is_positive", "is_non_negative", "has_loops", "is_undirected")


def hops(edges: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """id, depth: the fewest edges from any source (id), up to `most`; each vertex once."""
    seen = cut(sources.select("id", F.lit(0).alias("depth")).distinct())
    front = seen
    for d in range(1, most + 1):
        nxt = edges.join(front, F.col("src") == F.col("id")).select(F.col("dst").alias("id")).distinct().join(seen, "id", "left_anti")
        front = cut(nxt.withColumn("depth", F.lit(d)))
        if front.isEmpty():
            break
        seen = cut(seen.unionByName(front))
    return seen


def components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """id, component (its smallest id): alternating large-star and small-star rounds until nothing moves; isolated vertices keep themselves."""
    v = (vertices if vertices is not None else vertices_of(edges)).select("id").distinct()
    e = cut(edges.where("src != dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct())
    was = None
    while True:
        both = e.union(e.select("b", "a")).toDF("u", "x")
        m = both.groupBy("u").agg(F.least(F.min("x"), F.col("u")).alias("m"))
        large = both.where("x > u").join(m, "u").select(F.col("m").alias("a"), F.col("x").alias("b")).where("a != b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")).where("a != b")
        new = cut(small.unionByName(low.select(F.col("m").alias("a"), "b")).distinct())
        now = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == was:
            return v.join(new.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("m")), "id", "left").select("id", F.coalesce("m", "id").alias("component"))
        e, was = new, now


def laplacian(edges: DataFrame) -> DataFrame:
    """i, j, v: -w off the diagonal, the column sum without loops on it."""
    e = edges.where("src != dst")
    off = e.select(F.col("src").alias("i"), F.col("dst").alias("j"), (-F.col("w")).alias("v"))
    return off.unionByName(e.groupBy("dst").agg(F.sum("w").alias("v")).select(F.col("dst").alias("i"), F.col("dst").alias("j"), "v"))


def simrank(edges: DataFrame, rounds: int, damping: float = 0.85) -> DataFrame:
    """a, b, sim of vertex pairs with a common out-neighbourhood, after a fixed number of rounds; for small graphs."""
    out = edges.select("src", "dst").distinct()
    deg = out.groupBy("src").agg(F.count("*").alias("k"))
    v = vertices_of(edges)
    s = v.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("sim"))
    for _ in range(rounds):
        x = s.join(out.select(F.col("src").alias("p"), F.col("dst").alias("a")), "a").join(out.select(F.col("src").alias("q"), F.col("dst").alias("b")), "b")
        t = x.groupBy("p", "q").agg(F.sum("sim").alias("t"))
        t = t.join(deg.select(F.col("src").alias("p"), F.col("k").alias("kp")), "p").join(deg.select(F.col("src").alias("q"), F.col("k").alias("kq")), "q")
        new = t.where("p != q").select(F.col("p").alias("a"), F.col("q").alias("b"), (damping * F.col("t") / (F.col("kp") * F.col("kq"))).alias("sim")).where("sim > 0")
        s = cut(new.unionByName(v.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("sim"))))
    return s
