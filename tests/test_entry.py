"""The contract: names, and SQL only for queries that exist."""

import __spark_entry__


def test_names():
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q)
    assert "term_doc_freq" in q
    assert all(callable(f) for f in q.values())
