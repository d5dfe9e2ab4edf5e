"""The threshold join has a row for every vector and counts what its SQL counts."""

import duckdb

import __spark_entry__ as entry
from lexiloom.operators import models as M

DATA = "/root/testdata/sf0.01"


def test_every_vector_has_its_links(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    want = sorted(c.execute(entry.oracle_sql()["cosine_threshold_join"]).fetchall())
    got = sorted(map(tuple, entry.queries()["cosine_threshold_join"](spark, DATA).collect()))
    assert got == want
    assert len(got) == c.execute("SELECT count(*) FROM embeddings").fetchone()[0]


def test_blocks_and_rows_without_links(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [-1.0, 0.0]), (4, [0.0, 0.0]), (5, None)]
    d = spark.createDataFrame(rows, "id long, vec array<float>")
    for block in (1, 2, 100):
        assert sorted(map(tuple, M.threshold_links(d, 0.25, block).collect())) == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0)]
