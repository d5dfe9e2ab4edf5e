"""Queries over pages: HTML is written from the annotated blocks of the documents, then read as nodes, tokens and blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import docmodel as D
from ..operators import html as H
from ..operators import pages as P
from ..session import table
from .reference_queries import r6
from .registry import registry

QUERIES, ORACLES, query = registry()


def _path(c: Column) -> Column:
    return F.coalesce(F.try_element_at(c, F.lit("domPath")), F.lit("html/body/div/p"))


def _pages(s: SparkSession, d: str) -> DataFrame:
    """docid, html: every annotated block inside the tags of its path below body, with its number as id."""
    a = D.annotations_of(table(s, d, "news_documents").where("text is not null and annotations is not null"))
    tags = F.slice(F.split(_path(F.col("features")), "/"), 3, 100)
    first = F.concat(F.lit("<"), F.get(tags, F.lit(0)), F.lit(' id="b'), F.col("ann_no").cast("string"), F.lit('">'))
    opened = F.concat(first, F.array_join(F.transform(F.slice(tags, 2, 100), lambda t: F.concat(F.lit("<"), t, F.lit(">"))), ""))
    closed = F.array_join(F.transform(F.reverse(tags), lambda t: F.concat(F.lit("</"), t, F.lit(">"))), "")
    piece = F.concat(opened, H.escaped(F.col("block")), closed)
    g = a.groupBy("docid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ann_no", piece.alias("p")))), lambda x: x["p"]), "\n").alias("body"))
    return g.select("docid", F.concat(F.lit("<html><head><title>x</title><style>p {}</style></head><body>"), "body", F.lit("</body></html>")).alias("html"))


#: What splits words: blanks of any kind.
_BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_ANN = "SELECT docid, row_number() OVER (PARTITION BY docid ORDER BY i) AS k, coalesce(a.features['domPath'], 'html/body/div/p') AS path, substr(text, a.spanstart + 1, a.spanend - a.spanstart + 1) AS block, i FROM (SELECT docid, text, unnest(annotations) AS a, generate_subscripts(annotations, 1) AS i FROM news_documents WHERE text IS NOT NULL AND annotations IS NOT NULL)"


@query(f"WITH a AS ({_ANN}), p AS (SELECT docid, unnest(string_split(path, '/')[3:]) AS tag FROM a), d AS (SELECT DISTINCT docid FROM a) SELECT tag, count(*) AS n FROM (SELECT tag FROM p UNION ALL SELECT unnest(['html', 'head', 'title', 'style', 'body']) FROM d) GROUP BY tag")
def html_elements(s: SparkSession, d: str) -> DataFrame:
    n = H.nodes(_pages(s, d), "docid", "html")
    return n.where("tag not like '#%'").groupBy("tag").agg(F.count("*").alias("n"))


@query(f"WITH a AS ({_ANN}) SELECT docid, k - 1 AS of_no, block AS text FROM a WHERE trim(block) != ''")
def html_inner_text(s: SparkSession, d: str) -> DataFrame:
    n = H.nodes(_pages(s, d), "docid", "html")
    of = H.select(n, "//*[@id]")
    t = H.inner_text(of, n, "docid").join(of.select("docid", F.col("node_id").alias("of_id"), H.attribute("id").alias("id")), ["docid", "of_id"])
    return t.select("docid", F.expr("cast(substr(id, 2) as bigint)").alias("of_no"), H.unescaped(F.col("text")).alias("text")).where("trim(text) != ''")


@query(f"WITH a AS ({_ANN}) SELECT docid, count(*) AS n FROM a WHERE path LIKE '%/div/aside/a' GROUP BY docid")
def html_selected(s: SparkSession, d: str) -> DataFrame:
    n = H.nodes(_pages(s, d), "docid", "html")
    return H.select(n, "/html/body/div//a").groupBy("docid").agg(F.count("*").alias("n"))


@query(f"WITH a AS ({_ANN}), x AS (SELECT docid, len(string_split(path, '/')) AS depth FROM a WHERE trim(block) != '') SELECT docid, CAST(sum(depth) AS BIGINT) AS n FROM x GROUP BY docid")
def html_ancestors(s: SparkSession, d: str) -> DataFrame:
    n = H.nodes(_pages(s, d), "docid", "html")
    texts = n.where("tag = '#text' and trim(text) != '' and path not rlike '(style|title)/'").where(F.trim(F.regexp_replace("text", "\n", "")) != "")
    return H.ancestors(texts, n, "docid").groupBy("docid").agg(F.count("*").alias("n"))


@query(f"WITH a AS ({_ANN}) SELECT docid, count(*) AS n, count(*) FILTER (WHERE path LIKE '%/aside/%') AS n_gone FROM a GROUP BY docid")
def html_edited(s: SparkSession, d: str) -> DataFrame:
    n = H.nodes(_pages(s, d), "docid", "html")
    left = H.removed(n, H.select(n, "//aside"), "docid")
    left = H.set_attribute(left, F.col("attrs").getItem("id").isNotNull(), "seen", "1")
    again = H.nodes(H.rendered(left, "docid"), "docid", "html")
    had = H.select(n, "//*[@id]").groupBy("docid").agg(F.count("*").alias("n"))
    kept = again.where(F.try_element_at("attrs", F.lit("seen")) == "1").withColumn("has", F.lit(1))
    p = H.select(n, "//aside").groupBy("docid").agg(F.count("*").alias("g"))
    check = kept.groupBy("docid").agg(F.count("*").alias("k"))
    return had.join(p, "docid", "left").join(check, "docid", "left").where(F.coalesce("k", F.lit(0)) == F.col("n")).select("docid", "n", F.coalesce("g", F.lit(0)).alias("n_gone"))


@query(f"WITH a AS ({_ANN}), d AS (SELECT DISTINCT docid FROM a), o AS (SELECT 'open' AS kind, count(*) * 5 AS n FROM d UNION ALL SELECT 'open', sum(len(string_split(path, '/')) - 2) FROM a), t AS (SELECT kind, CAST(sum(n) AS BIGINT) AS n FROM o GROUP BY kind) SELECT kind, n FROM t UNION ALL SELECT 'close', n FROM t")
def html_tag_tokens(s: SparkSession, d: str) -> DataFrame:
    return H.tokens(_pages(s, d), "docid", "html", ("open", "close")).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"WITH a AS ({_ANN}) SELECT docid, CAST(row_number() OVER (PARTITION BY docid ORDER BY k) - 1 AS INT) AS block_no, trim(regexp_replace(block, '{_BLANK}+', ' ', 'g')) AS text, path FROM a WHERE trim(regexp_replace(block, '{_BLANK}+', ' ', 'g')) != ''")
def html_blocks(s: SparkSession, d: str) -> DataFrame:
    b = P.text_blocks(_pages(s, d), "docid", "html").where("path not rlike '(title|style)'")
    from pyspark.sql import Window

    no = F.row_number().over(Window.partitionBy("docid").orderBy("block_no")) - 1
    return b.select("docid", no.alias("block_no"), "text", "path")


@query()
def html_block_classes(s: SparkSession, d: str) -> DataFrame:
    c = H.page_classes(H.page_blocks(_pages(s, d), "docid", "html"), "docid")
    return c.select(F.explode("blocks.cls").alias("cls")).groupBy("cls").agg(F.count("*").alias("n"))


@query()
def html_main_text(s: SparkSession, d: str) -> DataFrame:
    return H.page_main_text(H.page_classes(H.page_blocks(_pages(s, d), "docid", "html"), "docid"), "docid")


@query()
def html_block_features(s: SparkSession, d: str) -> DataFrame:
    f = H.page_blocks(_pages(s, d), "docid", "html").selectExpr("docid", "inline(blocks)")
    return f.select("docid", "block_no", *[r6(c).alias(c) for c in H.FEATURES])
