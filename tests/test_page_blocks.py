"""Tokens, blocks, classes and main text of pages in bounded batches, one page at a time, as the tables of tokens have them."""

import random

import pyarrow as pa
import pytest

import __spark_entry__ as entry
from lexiloom.operators import html as H

DATA = "/root/testdata/sf0.001"
PIECES = ["<p>", "</p>", "<a href=x>", "</a>", "<b>", "</b>", "<h1>", "</h1>", "<h3>", "<br>", "</br>", "<script>x y</script>", "<!-- c -->", "&amp;", "&Auml;", "&#65;", "B. C.", "don’t", "3.14,5", "ABC", "Ⅷ", "x²½", "...", "a-b-", "<noscript>q</noscript>", "</div>", "<div>", "<a/>", "<p", "word Word WORD " * 9, "\n", "ÉCOLE"]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(PIECES) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    return spark.createDataFrame([*rows, (-1, None), (-2, "")], "page long, html string")


class Pages:
    """Stands for a table of pages and keeps the function that runs over its batches."""

    dtypes = [("page", "bigint"), ("html", "string")]

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self


def batches(f, n):
    rows = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(["<p>a b</p>"] * n)], ["page", "html"])
    return list(f(Pages(), "page", "html").run(iter([rows])))


def plan(spark, name):
    return entry.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("f", ["tokens", "page_blocks"])
def test_batches_are_bounded(f):
    b = batches(getattr(H, f), 1000)
    assert max(len(set(x.column(0).to_pylist())) for x in b) <= H.PAGES
    assert len({k for x in b for k in x.column(0).to_pylist()}) == 1000


def test_blocks_of_pages_are_those_of_tokens(odd):
    cols = ["page", "block_no", "text", *H.FEATURES]
    want = H.block_table(H.tokens(odd, "page", "html"), "page").select(*cols)
    got = H.page_blocks(odd, "page", "html").selectExpr("page", "inline(blocks)").select(*cols)
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_features_without_windows(spark):
    assert "Window" not in plan(spark, "html_block_features")


def test_tokens_of_some_kinds(odd):
    cols = ["page", "pos", "kind", "token"]
    want = H.tokens(odd, "page", "html").where("kind in ('open', 'close')").select(*cols)
    got = H.tokens(odd, "page", "html", ("open", "close")).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_tag_tokens_leave_words_in_python(spark):
    assert "Filter kind" not in plan(spark, "html_tag_tokens")


def test_classes_of_pages_are_those_of_blocks(odd, spark):
    tree = "p.Wrds <= 9\n|   n.RelPos >= 1: 1\n|   n.RelPos < 1: 2\np.Wrds > 9: 3\n"
    b = H.block_table(H.tokens(odd, "page", "html"), "page")
    pages = H.page_blocks(odd, "page", "html")
    for t in (H.SMALL_TREE, tree):
        want = H.classified(b, "page", t)
        got = H.page_classes(pages, "page", t).selectExpr("page", "inline(blocks)")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "Window" not in plan(spark, "html_block_classes")


def test_main_text_of_pages(odd, spark):
    want = H.main_text(H.classified(H.block_table(H.tokens(odd, "page", "html"), "page"), "page"), "page")
    got = H.page_main_text(H.page_classes(H.page_blocks(odd, "page", "html"), "page"), "page")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "Window" not in plan(spark, "html_main_text")
