"""Golden cases of tokens, hashes, vector spaces, models and graphs."""

import pytest
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.operators import evaluation
from lexiloom.operators import graph as G
from lexiloom.operators import models as M
from lexiloom.operators import vectors as V


def one(spark, value, *cols):
    return spark.createDataFrame([(value,)], "x string").select(*cols).first()


def test_hashes(spark):
    x = F.col("x")
    assert one(spark, "word", T.hash64(x), T.hash64(x, "UTF-16LE"))[:] == (-4672137363799328522, 2397197240290041380)
    assert one(spark, "", T.hash64(x))[0] == 8858853572222491965
    assert one(spark, "the", T.hash64(x))[0] == -8348096209822102092


@pytest.mark.parametrize(("w", "want"), [("USA", "ABC"), ("usa", "abc"), ("Usa", "Abc"), ("uSa", "aBc"), ("UsA", "AbC"), ("123", "Other")])
def test_case_type(spark, w, want):
    assert one(spark, w, T.case_type(F.col("x")))[0] == want


def test_tokens(spark):
    x = F.col("x")
    assert one(spark, "a1b-c", T.simple_tokens(x))[0] == ["a", "b", "c"]
    assert one(spark, "!!!", T.regex_tokens(x))[0] == []
    assert one(spark, "a ! b-c", T.regex_tokens(x))[0] == ["a", "!", "b-c"]
    assert one(spark, "can't 3.14 a_b x", T.unicode_tokens(x))[0] == ["can't", "3.14", "a_b"]
    assert one(spark, None, T.unicode_tokens(x))[0] == []


def test_tfidf_golden(spark):
    d = spark.createDataFrame([(0, "a b a"), (1, "b c"), (2, "a c c")], "doc_id long, text string")
    w = {r.term: r.w for r in V.weights(V.terms(d, max_n=2), F.lit(3)).where("doc_id = 0").collect()}
    assert w == pytest.approx({"a": 0.81093, "b": 0.405465, "a b": 1.098612, "b a": 1.098612}, abs=1e-5)
    w = {r.term: r.w for r in V.weights(V.terms(d, max_n=2), F.lit(3), kind="logdf").where("doc_id = 0").collect()}
    assert w == pytest.approx({"a": 0.890898, "b": 0.445449, "a b": 0.7615, "b a": 0.7615}, abs=1e-5)


def test_cut(spark):
    v = spark.createDataFrame([(1, t, float(w)) for t, w in (("a", 1), ("b", 1), ("c", 2), ("d", 6))], "doc_id long, term string, w double")
    assert V.cut_low(v, 0.2).count() == 4
    assert sorted(r.term for r in V.cut_low(v, 0.3).collect()) == ["c", "d"]


def test_naive_bayes_golden(spark):
    tr = spark.createDataFrame([(1, "x", "1"), (1, "x", "2"), (2, "x", "1"), (3, "y", "2"), (3, "y", "3")], "row long, label string, feature string")
    te = spark.createDataFrame([(9, "1")], "row long, feature string")
    got = {r.label: r.p for r in M.naive_bayes(tr, te).select("label", F.exp("score").alias("p")).collect()}
    assert got == pytest.approx({"x": 0.48, "y": 0.16})


def test_metrics_golden(spark):
    c = spark.createDataFrame([("a", "a", 3), ("a", "b", 1), ("b", "b", 2), ("c", "a", 1)], "actual string, predicted string, n long")
    got = {r.label: (round(r.precision, 4), round(r.recall, 4), round(r.f1, 4)) for r in M.precision_recall(c).collect()}
    assert got == {"a": (0.75, 0.75, 0.75), "b": (0.6667, 1.0, 0.8), "c": (1.0, 0.0, 0.0)}


def test_cv(spark):
    f = [r.fold for r in evaluation.folds(spark.range(10).toDF("id"), "id", 4).orderBy("id").collect()]
    assert f == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3]


def test_pagerank_golden(spark):
    e = spark.createDataFrame([(0, 1, 1.0), (0, 2, 1.0), (1, 2, 1.0), (2, 0, 1.0), (3, 2, 1.0)], "src long, dst long, w double")
    r = {x.id: x["rank"] for x in G.pagerank(e, 24).collect()}
    assert [r[i] for i in range(4)] == pytest.approx([0.37253, 0.19583, 0.39415, 0.03750], abs=2e-4)


def test_components_and_hops(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (7, 8), (9, 8)], "src long, dst long")
    v = spark.range(1, 11).toDF("id")
    got = {r.id: r.component for r in G.components(e, v).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 9: 7, 10: 10}
    h = {r.id: r.depth for r in G.hops(e, spark.createDataFrame([(1,)], "id long"), 5).collect()}
    assert h == {1: 0, 2: 1, 3: 2}


def test_simhash_join_is_complete(spark):
    fp = spark.createDataFrame([(1, 0), (2, 7), (3, 15), (4, -1), (5, 0)], "doc_id long, fingerprint long")
    got = {(r.a, r.b): r.distance for r in V.near_fingerprints(fp).collect()}
    assert got == {(1, 2): 3, (2, 3): 1}
