"""The self-join over groups and blocks of rows has every pair of brute force, and joins no pairs of rows with their terms."""

import random

import pyarrow as pa
import pytest

from lexiloom.operators import sparse as S


def vectors(n):
    rng = random.Random(n)
    return {i: {rng.randrange(14): rng.choice([0.2, 0.5, 1.0, -0.4]) for _ in range(rng.randrange(1, 7))} for i in range(n)}


def wanted(v):
    dots = {(a, b): sum(w * v[b].get(t, 0.0) for t, w in v[a].items()) for a in v for b in v if a < b}
    return {k: pytest.approx(s) for k, s in dots.items() if s > 0.7 + 1e-9}


def test_groups_of_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 7)
    v = vectors(30)
    df = spark.createDataFrame([(f"r{i:02}", f"t{t}", w) for i, x in v.items() for t, w in x.items()], "id string, term string, w double")
    joined = S.self_join(df, 0.7 + 1e-9, "id", diagonal=False)
    assert {(int(r.a[1:]), int(r.b[1:])): r.s for r in joined.collect()} == wanted(v)
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("block", "terms", "dense"), [(4, 5, 2), (3, 2, 99), (100, 100, 1)])
def test_blocks_of_rows(monkeypatch, block, terms, dense):
    for name, value in (("BLOCK", block), ("TERMS", terms), ("DENSE", dense)):
        monkeypatch.setattr(S, name, value)
    v = vectors(25)
    cols = [pa.array([sorted(x) for x in v.values()], pa.list_(pa.int64())), pa.array([[x[t] for t in sorted(x)] for x in v.values()], pa.list_(pa.float64()))]
    ids = pa.array(list(v), pa.int64())
    group = pa.array([i % 2 for i in v]).to_numpy()
    got = {}
    for g in (group, group[group == 0], group[group == 1]):
        keep = pa.array([len(g) == len(v) or i % 2 == g[0] for i in v])
        for a, b, s in S._shared(ids.filter(keep), g, cols[0].filter(keep), cols[1].filter(keep), 0.7 + 1e-9):
            for k in zip(a.to_pylist(), b.to_pylist(), s.tolist()):
                assert k[:2] not in got
                got[k[:2]] = k[2]
    assert got == wanted(v)
