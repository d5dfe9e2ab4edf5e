"""Sparse vectors, graphs, pages, formats, languages, clusterings, taggers and stateful streams on small tables, with nulls and edges."""

import math

import pytest
from pyspark.sql import functions as F

from lexiloom.functions import languages as L
from lexiloom.functions import text as T
from lexiloom.operators import clustering as C
from lexiloom.operators import evaluation as E
from lexiloom.operators import graph as G
from lexiloom.operators import html as H
from lexiloom.operators import models as M
from lexiloom.operators import pages as P
from lexiloom.operators import sparse as S
from lexiloom.operators import tagger as A
from lexiloom.operators import web as W
from lexiloom.sources import formats as X
from lexiloom.sources.readers import read_corpus_xml
from lexiloom.streaming import urltree as U


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


# ---- sparse
def test_self_join_against_brute_force(spark):
    import random

    rng = random.Random(2)
    v = {i: {f"t{rng.randrange(12)}": rng.choice([0.2, 0.5, 1.0, -0.4]) for _ in range(rng.randrange(0, 6))} for i in range(25)}
    df = spark.createDataFrame([(i, t, w) for i, x in v.items() for t, w in x.items()], "id long, term string, w double")
    want = set()
    for a in v:
        for b in v:
            s = sum(w * v[b].get(t, 0.0) for t, w in v[a].items())
            if a <= b and s > 0.7 + 1e-12:
                want.add((a, b))
    assert {(r.a, r.b) for r in S.self_join(df, 0.7, "id").collect()} == want
    assert S.self_join(df.where("false"), 0.7, "id").count() == 0
    with pytest.raises(ValueError, match="threshold"):
        S.self_join(df, 0.0, "id")


def test_sparse_operations(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "x", 4.0)], "r long, term string, w double")
    b = spark.createDataFrame([(1, "x", 3.0), (3, "z", None)], "r long, term string, w double")
    assert rows(S.merged(a, b, lambda p, q: p * q, ["r", "term"])) == [(1, "x", 3.0), (1, "y", 2.0), (2, "x", 4.0)]
    assert rows(S.mapped(a, lambda w: F.when(w > 1, w - 1))) == [(1, "y", 1.0), (2, "x", 3.0)]
    assert rows(S.min_max(a, "term"), "r", "term", "w") == [(1, "x", 0.0), (1, "y", 0.0), (2, "x", 1.0)]
    assert rows(S.appended(a.select("r"), a.select("r"), "r")) == [(1,), (1,), (2,), (4,), (4,), (5,)]
    t = S.trimmed(spark.createDataFrame([(1, c, w) for c, w in zip("abcd", (1.0, 1.0, 2.0, 6.0), strict=True)], "r long, term string, w double"), 4, 0.3, "r")
    assert rows(t, "term") == [("c",), ("d",)]
    m = spark.createDataFrame([(1, 2, 5.0), (2, 1, 5.0), (1, 1, 1.0)], "i long, j long, w double")
    assert S.shape(m, "i", "j").first().is_symmetric
    assert not S.shape(m.where("i < 2"), "i", "j").first().is_symmetric
    assert S.shape(m.where("false"), "i", "j").first().sparseness is None
    counts = spark.createDataFrame([("a", 2), ("b", 1)], "k string, n long")
    assert rows(S.edited(counts, spark.createDataFrame([("a", -2), ("b", 3), ("c", -1)], "k string, n long"), ["k"])) == [("b", 4)]
    look = S.looked_up(spark.createDataFrame([("x",), ("q",), (None,)], "w string"), spark.createDataFrame([("x", "2", 2), ("x", "1", 1)], "k string, v string, ord int"), "w", "k", "v")
    assert rows(look) == [("1",), ("q",), (None,)]
    z = S.zipped(*[spark.createDataFrame([(1, i, w) for i, w in enumerate(s)], "doc long, pos int, word string") for s in ("ab", "axc")], "doc", "pos", "word")
    assert rows(z, "pos", "same") == [(0, True), (1, False), (2, None)]


def test_averages_and_folds(spark):
    c = spark.createDataFrame([("a", "a", 3), ("a", "b", 1), ("b", "b", 2), ("c", "a", 1)], "actual string, predicted string, n long")
    r = E.averages(c).first()
    assert r.micro == pytest.approx(0.714286, abs=1e-6)
    assert r.macro_f == pytest.approx(0.516667, abs=1e-6)
    got = {r.id: r.fold for r in E.folds(spark.range(10), "id", 3).collect()}
    assert [got[i] for i in range(10)] == [0, 0, 0, 1, 1, 1, 1, 2, 2, 2]
    assert E.folds(spark.range(0), "id", 3).count() == 0


# ---- graphs
def test_ranks_and_symmetry(spark):
    e = spark.createDataFrame([(0, 1, 1.0), (0, 2, 1.0), (1, 2, 1.0), (2, 0, 1.0), (3, 2, 1.0)], "src long, dst long, w double")
    got = {r.id: r.rank for r in G.ranked(e, most=20).collect()}
    for i, want in enumerate((0.37253, 0.19583, 0.39415, 0.0375)):
        assert got[i] == pytest.approx(want, abs=2e-4)
    own = {r.id: r.rank for r in G.ranked(e, spark.range(1), most=25).collect()}
    for i, want in enumerate((0.45224, 0.1922, 0.35557, 0.0)):
        assert own[i] == pytest.approx(want, abs=1e-3)
    s = G.symmetrised(spark.createDataFrame([(1, 2, 3.0), (2, 1, 4.0), (1, 3, 1.0), (3, 3, 9.0)], "src long, dst long, w double"), lambda a, b: a * 10 + b)
    assert rows(s) == [(1, 2, 34.0), (1, 3, 1.0), (2, 1, 34.0), (3, 1, 1.0), (3, 3, 9.0)]
    assert G.predicates(s).first().is_undirected
    assert not G.predicates(e).first().is_undirected
    p = {(r.a, r.b): r.sim for r in G.simrank(spark.createDataFrame([(1, 9), (2, 9), (3, 8)], "src long, dst long"), 3).collect()}
    assert p[1, 2] == pytest.approx(0.85)
    assert (1, 3) not in p


# ---- pages
PAGE = '<html><body><!-- c --><div id="m" class="x y"><p>a &amp; b<p>nested</div><br></br><script>if (a < b) {}</script><img src=\'i.png\' width="3"/>tail</body></html></b>'


def test_nodes(spark):
    d = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "plain < text")], "page long, html string").withColumn("tag", F.lit("clash"))
    n = H.nodes(d.select("page", "html"), "page", "html").cache()
    one = [r.tag for r in n.where("page = 1").orderBy("node_id").collect()]
    assert one == ["html", "body", "#comment", "div", "p", "#text", "p", "#text", "br", "br", "script", "#text", "img", "#text"]
    assert n.where("page in (2, 3)").count() == 0
    assert H.select(n, "//div/p/p").count() == 1
    assert H.select(n, "/html/body/*").where("page = 1").count() == 5
    assert H.select(n, "//*[@width='3']").select(H.attribute("width", 0, "int").alias("w"), H.attribute("src", "?").alias("s")).first() == (3, "i.png")
    assert H.by_id(n, "m").first().path == "html/body/div"
    t = H.inner_text(H.select(n, "//div"), n, "page").select(H.unescaped(F.col("text")).alias("t")).first().t
    assert t == "a & bnested"
    m = H.with_markup(H.select(n, "//div"), d.select("page", "html"), "page", "html").first()
    assert m.inner_html == "<p>a &amp; b<p>nested"
    assert m.outer_html.startswith('<div id="m"')
    assert H.ancestors(n.where("tag = 'p'"), n, "page").where("tag = 'body'").count() == 2
    left = H.removed(n, H.select(n, "//div"), "page")
    page = {r.page: r.html for r in H.rendered(H.set_attribute(left, F.col("tag") == "img", "alt", 'a"b'), "page").collect()}[1]
    assert 'alt="a&quot;b"' in page
    assert "nested" not in page
    with pytest.raises(ValueError, match="selector"):
        H.select(n, "p > q")


def test_blocks_and_classes(spark):
    page = "<body><h1>A Headline HERE now</h1><p>" + "Many words of a long paragraph. " * 8 + '</p><ul><li><a href="#">one two</a></li></ul></body>'
    d = spark.createDataFrame([(1, page), (2, None)], "page long, html string")
    b = H.block_table(H.tokens(d, "page", "html"), "page").orderBy("block_no").collect()
    assert [(r.Wrds, r.InH, r.InP, r.LnkDns) for r in b] == [(4.0, 1.0, 0.0, 0.0), (48.0, 0.0, 1.0, 0.0), (2.0, 0.0, 0.0, 1.0)]
    assert b[1].FlstpRtio == pytest.approx(8 / 48)
    assert [r.RelPos for r in b] == [pytest.approx(k / 3) for k in (1, 2, 3)]
    assert b[1].WrdsQt == pytest.approx(4 / 48)
    assert b[0].CapWrdRtio == pytest.approx(2 / 4)
    got = H.classified(H.block_table(H.tokens(d, "page", "html"), "page"), "page").orderBy("block_no").collect()
    assert [r.cls for r in got] == ["Headline", "FullText", "Boilerplate"]
    assert H.main_text(H.classified(H.block_table(H.tokens(d, "page", "html"), "page"), "page"), "page").first().text.startswith("Many words")
    tree = H.read_tree("# c\n\nc.a <= 1\n|   n.b = 0: 2 (3.0/1.0)\n|   n.b = 1: 9\nc.a > 1: 0\n")
    assert [(n["parent_id"], n["cls"]) for n in tree] == [(None, None), (0, 2), (0, 9), (None, 0)]
    f = P.block_features(P.text_blocks(d, "page", "html"), "page").orderBy("block_no").collect()
    assert [r.rel_position for r in f] == [pytest.approx(k / 3) for k in (1, 2, 3)]


# ---- languages, text and addresses
def test_languages(spark):
    d = spark.createDataFrame([("EN",), ("de-AT",), ("xx",), (None,), ("pt_BR",)], "c string")
    assert [r[0] for r in d.select(L.language_name(F.col("c"))).collect()] == ["English", "German", "Unspecified", "Unspecified", "Portuguese"]
    assert spark.range(1).select(L.language_code(F.lit(" slovene "))).first()[0] == "sl"
    t = spark.createDataFrame([("abc где",), ("где это",), ("",), (None,)], "t string")
    assert [r[0] for r in t.select(L.dominant_range(F.col("t"))).collect()] == ["Basic Latin", "Cyrillic", "Other", "Other"]
    w = L.stop_words(spark, ("english", "german"))
    assert w.where("lang = 'en' and w = 'the'").count() == 1
    s = T.search_query(F.lit('B  "New  York" +a -"x y" b'))
    assert spark.range(1).select(s).first()[0] == '"new york" +a -"x y" b'
    o = spark.range(1).select(T.with_offsets(F.array(F.lit("a"), F.lit("a")), F.lit("ba a"))).first()[0]
    assert [(x.start, x.end) for x in o] == [(1, 2), (3, 4)]
    assert spark.range(1).select(T.sentences(F.lit("One. Two e.g. this! 3rd\nfour"))).first()[0] == ["One.", "Two e.g. this!", "3rd", "four"]


def test_addresses(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    u = F.lit("HTTP://Www.A.example/x//y%20z?b=2&a=1&b=1#top")
    assert one(W.normal_url(u)) == "http://www.a.example:80/x/y z?a=1&b=1,2"
    assert one(W.normal_url(u, "drop")) == "http://www.a.example:80/x/y z"
    rules = [(r"\.b\.", ["a"]), (r"\.example", ["a", "c"]), (r"\.example", ["a"])]
    assert one(W.normal_url(u, "heuristics", rules)) == "http://www.a.example:80/x/y z?a=1"
    assert one(W.normal_url(F.lit("nonsense"))) is None
    assert one(W.normal_url(F.lit("https://a.example/"), title=F.lit("A b 1"))).startswith("https://a.example:443/?__cid__=")
    assert one(W.black_listed(u, ["http://www.a.example:80/x"]))
    for host, want in (("a.b.co.uk", "co.uk"), ("x.y.ck", "y.ck"), ("www.ck", "ck"), ("q.zz", "zz")):
        assert one(W.public_suffix(F.lit(host), ["co.uk", "*.ck", "!www.ck", "uk"])) == want


# ---- models
def vectors(spark):
    out = [(i, [1.0 + 0.01 * i, 0.0, 0.1] if i % 2 else [0.0, 1.0 + 0.01 * i, -0.1], i % 2) for i in range(20)]
    return spark.createDataFrame([*out, (90, None, 0), (91, [0.0, 0.0, 0.0], None)], "id long, v array<double>, y int")


def test_linear_models(spark, tmp_path):
    d = vectors(spark)
    m = C.LinearSvm("id", "v", "y", rounds=12).fit(d)
    assert {r.id % 2 for r in m.predict(d.where("id < 50")).where("predicted = 1").collect()} == {1}
    m.save(spark, str(tmp_path / "m"))
    assert C.LinearSvm.load(spark, str(tmp_path / "m")).weights == m.weights
    x = m.explained(d.where("id = 1")).agg(F.sum("share")).first()[0]
    assert x == pytest.approx(m.predict(d.where("id = 1")).first().score)
    p = C.one_vs_rest(d, d.where("id < 50"), "id", "v", "y", rounds=12)
    assert all(r.predicted == r.id % 2 for r in p.collect())
    assert C.LinearSvm("id", "v", "y").fit(d.where("false")).weights == []
    xy = spark.createDataFrame([(float(i), float(i % 3), 2.0 * i - 3.0 * (i % 3)) for i in range(12)] + [(None, 1.0, 1.0)], "a double, b double, t double")
    assert {r.feature: round(r.weight, 6) for r in C.least_squares(xy, ["a", "b"], "t").collect()} == {"a": 2.0, "b": -3.0}


def test_clusterings(spark):
    d = vectors(spark)
    k = M.kmeans_trials(d, "id", "v", 2)
    groups = {}
    for r in k.collect():
        groups.setdefault(r.cluster, set()).add(r.id % 2)
    assert sorted(map(tuple, groups.values())) == [(0,), (1,)]
    t = C.agglomerative(d, "id", "v", 4, rounds=2)
    assert t.count() == 20
    assert t.select("leaf", "path").distinct().count() == t.select("path").distinct().count()
    assert len({(r.id % 2, r.path[0]) for r in t.collect()}) == 2
    topics = C.incremental_topics(d.withColumn("b", F.pmod("id", F.lit(3)).cast("int")), "id", "v", "b", window=2, quality=0.8)
    per = {}
    for r in topics.collect():
        per.setdefault(r.id % 2, set()).add(r.topic)
    assert topics.count() == 20
    assert not per[0] & per[1]
    c = C.categorise(d.withColumn("p", F.concat(F.lit("t/"), F.col("y").cast("string"))).where("y is not null"), d, "id", "v", "p")
    assert {(r.id % 2, r.category) for r in c.collect()} == {(0, "t"), (0, "t/0"), (1, "t"), (1, "t/1")}


# ---- tagging
def test_tagger(spark):
    sents = ["the dog runs .", "a dog sleeps .", "the cat runs ,", "a runs dog ."]
    tags = {"the": "Da", "a": "Da", "dog": "Nn", "cat": "Nn", "sleeps": "Vb", ".": "Zz", ",": "Zz"}
    rows_ = [(i, k, w, tags.get(w, "Vb" if s.split()[max(0, k - 1)] in ("dog", "cat") else "Nn")) for i, s in enumerate(sents) for k, w in enumerate(s.split())]
    gold = spark.createDataFrame(rows_, "doc_id long, pos int, word string, tag string")
    model = A.train(gold, rounds=4, cut_off=0)
    got = A.tag(gold.select("doc_id", "pos", "word"), *model)
    acc = {(r.words, r.punctuation): r for r in A.accuracy(got, gold).collect()}
    assert acc["all", "with"].tag_accuracy == 1.0
    assert acc["all", "without"].n == 12
    new = A.tag(spark.createDataFrame([(9, 0, "creeps"), (9, 1, "dog")], "doc_id long, pos int, word string"), *model).orderBy("pos").collect()
    assert [(r.known, r.predicted) for r in new] == [(False, "Vb"), (True, "Nn")]
    flat = A.tag(gold, *model[:2], None, context=False)
    meta = A.meta_training(A.meta_rows(got, flat), gold).collect()
    assert {r.right for r in meta} <= {1}
    links = spark.createDataFrame([(1, 0, 1, "x"), (1, 1, 2, "cut"), (1, 2, 3, "x"), (1, 3, None, None)], "sent_id long, from_id int, dep_id int, afun string")
    assert rows(A.chunks(links, ("cut",)), "token", "head") == [(0, 0), (1, 0), (2, 2), (3, 2)]


def test_stylometry(spark):
    words = "Voda je , voda . Prst ?".split()
    t = spark.createDataFrame([(1, int(i > 4), w) for i, w in enumerate(words)] + [(2, 0, "!")], "doc_id long, sent_no int, word string")
    r = A.stylometry(t).collect()
    assert len(r) == 1
    assert (r[0].n, r[0].sentences, r[0].ttr) == (4, 2, 0.75)
    assert r[0].fog == pytest.approx(0.4 * 2)
    assert r[0].honore == pytest.approx(100 * math.log(4) / (1 - 2 / 3))


# ---- formats
def test_formats(spark, tmp_path):
    ann = "array<struct<spanstart:int,spanend:int,type:string,features:map<string,string>>>"
    d = spark.createDataFrame([("n1", 'a <b> & "c"', {"k": "v&"}, [(0, 2, "T", {"f": "1"}), (4, 4, "U", None)]), ("n2", None, None, None)], f"name string, text string, features map<string,string>, annotations {ann}")
    X.write_corpus_xml(d, str(tmp_path / "x"))
    back = {r.name: r for r in read_corpus_xml(spark, str(tmp_path / "x")).collect()}
    assert back["n1"].text == 'a <b> & "c"'
    assert back["n1"].features == {"k": "v&"}
    assert [(a.spanstart, a.spanend, a.type, a.features) for a in back["n1"].annotations] == [(0, 2, "T", {"f": "1"}), (4, 4, "U", {})]
    assert back["n2"].annotations == []
    one = d.where("name = 'n1'")
    assert "<Document><Name>n1" in one.select(X.document_xml(F.col("name"), F.col("text"), F.col("features"), F.col("annotations"))).first()[0]
    assert '<span class="T">a &lt;</span>' in one.select(X.document_html(F.col("name"), F.col("text"), F.col("annotations"))).first()[0]
    gate = one.select(X.document_gate(F.col("text"), F.col("annotations"))).first()[0]
    assert 'a &lt;<Node id="3"/>b<Node id="4"/>&gt;<Node id="5"/>' in gate
    assert 'StartNode="4" EndNode="5"' in gate
    (tmp_path / "t.tsv").write_text("the\tDa\ndog\tNn\n\nruns\tVb\n")
    assert rows(X.read_tagged_tsv(spark, str(tmp_path / "t.tsv")), "sent_no", "pos", "word", "tag") == [(0, 0, "the", "Da"), (0, 1, "dog", "Nn"), (1, 0, "runs", "Vb")]
    (tmp_path / "t.xml").write_text('<text><p><s><w msd="Da" lemma="the">The</w><S/><w ana="Nn" lemma="dog">dog</w><c>.</c></s></p></text>')
    tei = rows(X.read_tagged_tei(spark, str(tmp_path / "t.xml")), "pos", "word", "tag", "lemma", "is_punct", "space_after")
    assert tei == [(0, "The", "Da", "the", False, True), (1, "dog", "Nn", "dog", False, False), (2, ".", ".", ".", True, False)]
    (tmp_path / "m.txt").write_text("dogs\t=\tx\t0\nran\trun\ty\t5\n")
    assert rows(X.read_multext(spark, str(tmp_path / "m.txt"), "word lemma - freq")) == [("dogs", "dogs", 0.1), ("ran", "run", 5.0)]
    (tmp_path / "b.tsv").write_text("# c\nb1\tu\tt\ts\nb2\tu\tt\ts\te\tf\t30\tr\tx\n")
    assert [r.age for r in X.read_blog_metadata(spark, str(tmp_path / "b.tsv")).orderBy("blog").collect()] == [None, "30"]
    (tmp_path / "f.xml").write_text("junk<rss><item><title>a</title><category>x</category><category>y</category></item><item></item></rss>")
    assert rows(X.read_feeds(spark, str(tmp_path / "f.xml")), "title", "category") == [("a", "x ;; y"), (None, None)]
    X.write_tab(spark.createDataFrame([(1.0, "p,q")], "f double, c string"), str(tmp_path / "tab"), ["f"], "c")
    assert rows(spark.read.text(str(tmp_path / "tab" / "data"))) == [("1.0\tp",), ("1.0\tq",)]
    kept = one.select(X.kept_features(F.expr("array(named_struct('spanstart', 0, 'spanend', 1, 'type', 'TextBlock', 'features', map('domPath', 'p', 'z', '1')))")).alias("a")).first().a
    assert kept[0].features == {"domPath": "p"}


# ---- state
def test_url_tree_state():
    t = U.UrlTree(least=2, most=50, days=14, voters=2)
    assert U.nodes_of("http://news.a.example:80/x/y/z", "a.example") == ["/", "/@news/", "/@news/x/", "/@news/x/y/"]
    same, n = 7, 100
    docs = [(i, i * 1000, f"http://a.example:80/x/{i}", [same, n + i], [10, 10], [None, None], [None, None]) for i in range(6)]
    got = {(d, b): k for d, _, b, k in t.batch(docs, "a.example")}
    assert got[0, 0] == "TextBlock/Boilerplate"
    assert got[0, 1] == "TextBlock/Content"
    again = t.batch([(9, 9000, "http://a.example:80/x/1", [same, 999], [10, 200], [0.0, 0.0], ["html/body/p"] * 2), (10, 9001, "http://a.example:80/x/77", [5, 6], [1, 1], [1.0, 0.0], [None, "html/nav/a"])], "a.example")
    assert [(d, r, k) for d, r, _, k in again] == [(9, 2, "TextBlock/Boilerplate"), (9, 2, "TextBlock/Content/Unseen"), (10, 1, "TextBlock/Boilerplate"), (10, 1, "TextBlock/Boilerplate")]
    t.batch([(20, 40 * U.DAY, "http://a.example:80/q/1", [1], [1], [None], [None])], "a.example")
    assert len(t.queue) == 2  # the others are older than the horizon
    assert all(v > 0 for v in t.blocks.values())
    small = U.UrlTree(most=3)
    small.batch([(i, i, f"http://a.example:80/{i}", [i], [1], [None], [None]) for i in range(9)], "a.example")
    assert small.docs["/"] == 3
    assert len(small.revs) == 3


def test_split_batch(spark):
    out = {}
    U.kept_and_dumped(spark.createDataFrame([(1, True), (2, False), (3, None)], "i long, ok boolean"), F.col("ok"), lambda d: out.update(kept=rows(d, "i")), lambda d: out.update(dump=rows(d, "i")))
    assert out == {"kept": [(1,), (3,)], "dump": [(2,)]}
