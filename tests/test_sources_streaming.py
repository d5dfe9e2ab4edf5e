"""Round trips of formats; streams give what a batch gives."""

from pyspark.sql import functions as F

from lexiloom.sources import readers as R
from lexiloom.streaming import pipelines as P


def test_corpus_xml(spark, tmp_path):
    (tmp_path / "c.xml").write_text(
        "<DocumentCorpus><Documents><Document><Name>n</Name><Text>hello world</Text><Annotations><Annotation><Id>0</Id><SpanStart>6</SpanStart><SpanEnd>10</SpanEnd><Type>TextBlock</Type>"
        "<Features><Feature><Name>k</Name><Value>v</Value></Feature></Features></Annotation></Annotations><Features><Feature><Name>guid</Name><Value>g</Value></Feature></Features></Document>"
        "<Document><Name>m</Name></Document></Documents></DocumentCorpus>"
    )
    a, b = sorted(R.read_corpus_xml(spark, str(tmp_path / "c.xml")).collect(), key=lambda r: r.name, reverse=True)
    assert (a.text, a.features, a.annotations[0].type, a.annotations[0].features) == ("hello world", {"guid": "g"}, "TextBlock", {"k": "v"})
    assert (b.name, b.text, b.features, b.annotations) == ("m", None, {}, [])


def test_text_formats(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a first doc\nb second\n")
    assert [(r.name, r.text) for r in R.read_line_documents(spark, str(tmp_path / "l.txt"), True).collect()] == [("a", "first doc"), ("b", "second")]
    (tmp_path / "s.txt").write_text("# c\n1 3:0.5 7:2 # x\n-1 1:1\n")
    assert [(r.label, r.idx, r.val) for r in R.read_svmlight(spark, str(tmp_path / "s.txt")).collect()] == [(1.0, [3, 7], [0.5, 2.0]), (-1.0, [1], [1.0])]
    (tmp_path / "x.tsv").write_text("walks\twalk\tV\t0\nx\ty\tN\n")
    assert [r.freq for r in R.read_lexicon(spark, str(tmp_path / "x.tsv")).collect()] == [0.1, 0.1]


def test_dated_store(spark, tmp_path):
    d = spark.createDataFrame([("g1", "2019-01-01 10:00:00"), ("g2", "2019-01-02 10:00:00")], "guid string, t string").withColumn("time", F.to_timestamp("t"))
    R.write_dated(d, str(tmp_path / "s"))
    x = R.lookup(spark, str(tmp_path / "s"), "2019-01-02", "guid", "g2")
    assert x.count() == 1
    assert "PartitionFilters: [isnotnull(day" in x._jdf.queryExecution().toString()


def test_streams(spark, tmp_path):
    schema = "id long, k string, ts timestamp"
    rows = [(i, "ab"[i % 2], f"2019-01-01 {i % 24:02d}:00:00") for i in range(30)]
    d = spark.createDataFrame(rows, "id long, k string, t string").select("id", "k", F.to_timestamp("t").alias("ts"))
    for i in range(3):
        d.where(F.col("id") % 3 == i).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    src = str(tmp_path / "in" / "*")
    out = str(tmp_path / "rev")
    P.run_once(P.revisions(P.file_stream(spark, src, schema, 1), "k", "id"), P.parquet_sink(out), str(tmp_path / "cp1"))
    got = spark.read.parquet(out)
    assert {(r.k, r.rev) for r in got.collect()} == {(k, n) for k in "ab" for n in range(1, 16)}
    seen = str(tmp_path / "seen")
    P.run_once(P.first_seen(P.file_stream(spark, src, schema, 1), ["k"], "ts", "30 days"), P.parquet_sink(seen), str(tmp_path / "cp2"))
    assert spark.read.parquet(seen).select("k").distinct().count() == spark.read.parquet(seen).count() == 2
    win = str(tmp_path / "win")
    P.run_once(P.window_counts(P.file_stream(spark, src, schema, 100), "ts", "k"), P.parquet_sink(win), str(tmp_path / "cp3"), "complete")
    assert spark.read.parquet(win).agg(F.sum("n")).first()[0] == 30
