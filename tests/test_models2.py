"""Language profiles, trainers, lemmas, tags and page blocks."""

import math

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import langid, pages, tagging, trainers


def test_profile_grams(spark):
    g = spark.createDataFrame([("ABA",)], "x string").select(F.explode(langid.profile_grams(F.col("x"))).alias("g")).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in g} == {"A": 2, "B": 1, "_A": 1, "AB": 1, "BA": 1, "A_": 1}


def test_detect(spark):
    docs = spark.createDataFrame([(1, "en", "the house of the king and the queen"), (2, "de", "das haus des königs und der königin")], "id long, lang string, text string")
    prof = langid.profiles(docs, "lang", "text")
    got = {r.id: r.lang for r in langid.detect(docs, prof, "id", "text").collect()}
    assert got == {1: "en", 2: "de"}


def test_maxent(spark):
    tr = spark.createDataFrame([(1, "x", "a"), (1, "x", "c"), (2, "x", "a"), (3, "y", "b"), (3, "y", "c"), (4, "y", "b")], "row long, label string, feature string")
    lam = trainers.maxent(tr, 15)
    p = {(r.row, r.label): r.p for r in trainers.maxent_predict(tr, lam).collect()}
    assert all(p[i, lab] > 0.8 for i, lab in ((1, "x"), (2, "x"), (3, "y"), (4, "y")))
    assert math.isclose(p[1, "x"] + p[1, "y"], 1.0)


def test_batch_centroids_and_bisecting(spark):
    rows = [(i, "a" if i < 6 else "b", [1.0, 0.1 * i] if i < 6 else [0.1 * (i - 6), 1.0]) for i in range(12)]
    d = spark.createDataFrame(rows, "id long, label string, vec array<double>")
    c = trainers.batch_centroids(d, "label", "vec", "id", rounds=3)
    assert c.count() == 4
    got = {r.id: r.cluster for r in trainers.bisecting(d, "id", "vec", quality=0.95).collect()}
    assert len(set(got.values())) >= 2
    assert got[0] != got[6]


def test_lemmas_and_tags(spark):
    lex = spark.createDataFrame([("walks", "walk", 1.0), ("talks", "talk", 1.0), ("cats", "cat", 1.0), ("ran", "run", 1.0), ("sing", "sing", 1.0)], "word string, lemma string, freq double")
    rules = tagging.suffix_rules(lex)
    got = {r.word: r.lemma for r in tagging.lemmas(spark.createDataFrame([("walks",), ("barks",), ("ran",), ("sing",), (None,)], "word string"), rules).collect()}
    assert got == {"walks": "walk", "barks": "bark", "ran": "run", "sing": "sing"}
    m = tagging.suffix_tags(spark.createDataFrame([("walks", "V"), ("cats", "N"), ("talks", "V")], "word string, tag string"))
    got = {r.word: (r.cls, r.best) for r in tagging.ambiguity_class(spark.createDataFrame([("barks",), ("mats",)], "word string"), m).collect()}
    assert got == {"barks": ("V", "V"), "mats": ("N", "N")}
    t = spark.createDataFrame([(1, 0, "A"), (1, 1, "bc")], "doc_id long, pos int, word string")
    f = {r.pos: r.features for r in tagging.context_features(t, 1).collect()}
    assert "w1=bc" in f[0]
    assert "w-1=|" in f[0]


@pytest.mark.parametrize(("html", "want"), [("<p>a <b>c</b> d</p><div>x <a href=u>link</a></div>", [("a c d", "p", 0), ("x link", "div", 4)]), ("<p>a<p>b", [("a", "p", 0), ("b", "p/p", 0)]), ("<script>no</script>&amp; t", [("& t", "", 0)]), (None, [])])
def test_blocks(html, want):
    assert pages.blocks_of(html) == want


def test_block_table(spark):
    d = spark.createDataFrame([(1, "<h1>Head line</h1><p>One two. Three four.</p>"), (2, None)], "id long, html string")
    x = pages.block_features(pages.text_blocks(d, "id", "html"), "id").orderBy("block_no").collect()
    assert [(r.text, r.start, r.in_h, r.in_p) for r in x] == [("Head line", 0, True, False), ("One two. Three four.", 11, False, True)]


def test_stems_and_optimizer(spark):
    import numpy as np

    from lexiloom.functions.stemming import stem, with_stems
    from lexiloom.operators.optimize import differential_evolution

    want = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "hopping": "hop", "filing": "file", "happy": "happi", "relational": "relat", "formaliti": "formal", "triplicate": "triplic", "goodness": "good", "adjustment": "adjust", "adoption": "adopt", "controll": "control", "rate": "rate", "is": "is"}
    assert {w: stem(w) for w in want} == want
    d = with_stems(spark.createDataFrame([("hopping",), ("hopping",), (None,)], "term string"))
    assert sorted(r.stem or "" for r in d.collect()) == ["", "hop", "hop"]
    x, v = differential_evolution(lambda p: -float(((p - 2) ** 2).sum()), np.zeros(2), patience=20)
    assert v > -1e-3
    assert abs(x[0] - 2) < 0.1


def test_tree_votes(spark):
    from lexiloom.operators.web import group_predictions, tree_votes

    docs = spark.createDataFrame([(i, f"g{i}", f"http://h.example:80/a/t{i}") for i in range(8)] + [(9, "g9", None)], "docid long, guid string, url string")
    blocks = spark.createDataFrame([(f"g{i}", 1) for i in range(8)] + [(f"g{i}", 10 + i) for i in range(8)], "guid string, hash long")
    got = {(r.docid, r.hash): r.boilerplate for r in tree_votes(docs, blocks).collect()}
    assert all(got[i, 1] and not got[i, 10 + i] for i in range(8))
    p = spark.createDataFrame([("g", 1, "a", 0.6), ("g", 1, "b", 0.4), ("g", 2, "b", 0.9), ("g", 3, "a", 0.7)], "grp string, row long, label string, score double")
    assert {r.label: r.score for r in group_predictions(p, "grp", "vote").collect()} == {"a": 2.0, "b": 1.0}
    assert {r.label: round(r.score, 2) for r in group_predictions(p, "grp").collect()} == {"a": 1.3, "b": 1.3}
