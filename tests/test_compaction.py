"""Records are kept once, merges are planned level by level and repeated runs do nothing."""

from lexiloom.operators import compaction as C


def doc(guid, rev=1, name="n"):
    return f"<Document>\n <Name>{name}</Name><Text>t</Text><Features><Feature><Name>guid</Name><Value>{guid}</Value></Feature><Feature><Name>rev</Name><Value>{rev}</Value></Feature></Features></Document>"


def files(spark):
    rows = [
        (1, "a", 400, doc("AB-1") + doc("AB-2")),
        (2, "b", 300, doc("ab1") + "\n" + doc("ab2", 2) + doc("ab1")[:-30]),
        (3, "c", 0, ""),
        (4, None, None, None),
        (5, "d", 100, doc("ab2", 2) + doc("ab2", 2)),
        (6, "e", 90, "<Document><Text>no guid</Text></Document><Document><Text>no guid</Text></Document>"),
    ]
    return spark.createDataFrame(rows, "file_id long, filename string, n_bytes long, payload string")


def test_repeated_records(spark):
    got = sorted((r.file_id, r.rec_no) for r in C.repeated_records(files(spark), target_bytes=10_000, fanout=2).collect())
    assert got == [(2, 0), (5, 0), (5, 1)]
    assert C.repeated_records(files(spark).where("false")).count() == 0


def test_plan_and_run(spark, tmp_path):
    journal, places = C.plan_merges(files(spark), target_bytes=700, fanout=2)
    j = journal.collect()
    assert j
    assert all(r.n_inputs == len(r.inputs) > 1 for r in j)
    assert places.count() == 6


def stored_records(spark, out):
    return sorted((r.guid, r.rev) for r in C.live_records(spark, out).collect())


def distinct_records(files):
    keyed = {(r.guid, r.rev) for r in C.records_of(files).where("guid is not null").collect()}
    return sorted(keyed)


def test_arrivals_keep_each_record_once(spark, tmp_path):
    out = str(tmp_path / "o")
    rows = [(i, f"f{i}", 50 + 40 * (i % 5), doc(f"g{i}") + (doc(f"g{i // 3}") if i % 4 == 0 else "")) for i in range(1, 61)]
    all_ = spark.createDataFrame(rows, "file_id long, filename string, n_bytes long, payload string").withColumn("output_id", C.F.lit("clash"))
    runs = []
    for upto in (20, 21, 55, 55, 60):
        runs.append(C.run_compaction(all_.where(f"file_id <= {upto}"), out, 4000, 4).count())
        got = stored_records(spark, out)
        assert len(got) == len(set(got))
    assert runs[3] == 0
    C.run_compaction(all_, out, 4000, 4, across=True)
    waiting = all_.join(C.journal_of(spark, out).select(C.F.explode("inputs").alias("f")), C.F.col("file_id").cast("string") == C.F.col("f"), "left_anti")
    assert sorted({*stored_records(spark, out), *distinct_records(waiting)}) == distinct_records(all_)
    ids = [r.output_id for r in C.live_records(spark, out).select("output_id").distinct().collect()]
    assert 0 < len(ids) < 15


def test_broken_run_is_repeated(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "o")
    C.run_compaction(files(spark).where("file_id < 3"), out, 10_000, 2, across=True)
    assert stored_records(spark, out) == [("ab1", "1"), ("ab2", "1"), ("ab2", "2")]
    real = C._runs
    C.run_compaction(files(spark), out, 10_000, 2, across=True)
    last = max(real(spark, out))
    (tmp_path / "o" / "journal" / f"run={last}" / "_SUCCESS").unlink()  # as if it had broken off before the journal was complete
    assert stored_records(spark, out) == [("ab1", "1"), ("ab2", "1"), ("ab2", "2")]
    more = files(spark).unionByName(spark.createDataFrame([(7, "g", 80, doc("new"))], "file_id long, filename string, n_bytes long, payload string"))
    C.run_compaction(more, out, 10_000, 2, across=True)
    got = [(r.guid, r.rev) for r in C.live_records(spark, out).collect()]
    assert sorted(g for g in got if g[0]) == [("ab1", "1"), ("ab2", "1"), ("ab2", "2"), ("new", "1")]
    assert sum(1 for g in got if g[0] is None) == 2
