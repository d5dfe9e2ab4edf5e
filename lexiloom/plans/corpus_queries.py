"""Queries over corpus formats, feeds, tagging, stylometry and the stateful address trees."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import tagger as G
from ..operators import web as W
from ..session import host_key, shared_dir, stored, table
from ..sources import formats as X
from ..sources.readers import read_corpus_xml
from ..streaming import pipelines as P
from ..streaming import urltree as U
from .reference_queries import r6
from .registry import registry

QUERIES, ORACLES, query = registry()


def _folder(s: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(s), f"{name}-{uuid.uuid4().hex}")


# ---- formats


@query("SELECT features['guid'] AS name, CAST(sum(len(annotations)) AS BIGINT) AS n_annotations, CAST(sum(len(map_keys(features))) AS BIGINT) AS n_features, count(*) AS n FROM news_documents WHERE text IS NOT NULL AND features['guid'] IS NOT NULL AND annotations IS NOT NULL GROUP BY 1")
def corpus_round_trip(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "news_documents").where("text is not null and annotations is not null").withColumn("guid", F.try_element_at("features", F.lit("guid"))).where("guid is not null")
    clean = F.regexp_replace("text", r"[^\x{9}\x{A}\x{D}\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "")
    out = _folder(s, "corpus")
    X.write_corpus_xml(docs.select(F.col("guid").alias("name"), clean.alias("text"), "features", "annotations"), out)
    back = read_corpus_xml(s, out)
    return back.groupBy("name").agg(F.sum(F.size("annotations")).alias("n_annotations"), F.sum(F.size(F.map_keys("features"))).alias("n_features"), F.count("*").alias("n"))


@query("SELECT DISTINCT itemid, title, link, description, category, pubdate, lower(substr(m,7,2)||substr(m,5,2)||substr(m,3,2)||substr(m,1,2)||substr(m,11,2)||substr(m,9,2)||substr(m,15,2)||substr(m,13,2)||substr(m,17,16)) AS item_hash FROM (SELECT itemid, nullif(trim(title), '') AS title, nullif(trim(link), '') AS link, nullif(trim(description), '') AS description, nullif(trim(category), '') AS category, nullif(trim(pubdate), '') AS pubdate, md5(coalesce(trim(title), '') || ' ' || coalesce(trim(description), '') || ' ' || coalesce(trim(pubdate), '')) AS m FROM rss_items)")
def feed_items_parsed(s: SparkSession, d: str) -> DataFrame:
    def tag(name: str, c: str):
        return F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{name}><![CDATA["), F.trim(F.col(c)), F.lit(f"]]></{name}>"))).otherwise("")

    cats = F.array_join(F.transform(F.split(F.trim(F.coalesce("category", F.lit(""))), " ;; "), lambda c: F.concat(F.lit("<category>"), c, F.lit("</category>"))), "")
    r = table(s, d, "rss_items").distinct()
    item = F.concat(F.lit("<item>"), tag("title", "title"), tag("link", "link"), tag("description", "description"), cats, tag("pubDate", "pubdate"), F.lit("</item>"))
    x = X.feed_items(r.select(F.col("itemid").cast("string").alias("path"), item.alias("item")))
    return x.select(F.col("path").cast("bigint").alias("itemid"), "title", "link", "description", "category", "pubdate", "item_hash").distinct()


@query("SELECT corpusno, docguid, substr(m,7,2)||substr(m,5,2)||substr(m,3,2)||substr(m,1,2)||substr(m,11,2)||substr(m,9,2)||substr(m,15,2)||substr(m,13,2)||substr(m,17,16) AS id FROM (SELECT DISTINCT w.corpusno, w.guid AS docguid, md5(coalesce(c.guid, '') || coalesce(w.guid, '')) AS m FROM written_docs w JOIN corpora c USING (corpusno))")
def written_document_ids(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "corpora").select("corpusno", F.col("guid").alias("corpus"))
    w = table(s, d, "written_docs").select("corpusno", F.col("guid").alias("docguid")).join(c, "corpusno").distinct()
    return w.select("corpusno", "docguid", X.document_id(F.col("corpus"), F.col("docguid")).alias("id")).distinct()


@query("SELECT year(arrived) AS year, month(arrived) AS month, day(arrived) AS day, count(*) AS n, max(len(title)) AS longest FROM (SELECT DISTINCT docid, arrived, left(title, 400) AS title FROM written_docs WHERE arrived IS NOT NULL) GROUP BY ALL")
def written_by_day(s: SparkSession, d: str) -> DataFrame:
    w = table(s, d, "written_docs").where("arrived is not null").select("docid", "arrived", "title").distinct()
    out = _folder(s, "days")
    for _ in range(2):  # a repeated batch writes the same
        X.write_documents(w, out, "arrived")
    return s.read.parquet(out).groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.max(F.length("title")).alias("longest"))


def _tokens(s: SparkSession, d: str, col: str = "text") -> DataFrame:
    """doc_id, pos, sent_no, word: words and single signs; a sentence ends at . ! or ?."""
    from pyspark.sql import Window

    t = F.regexp_extract_all(F.coalesce(F.col(col), F.lit("")), F.lit(r"(\p{L}+|[^\p{L}\s])"), F.lit(1))
    x = table(s, d, "documents").select("doc_id", F.lower("lang").alias("lang"), F.posexplode(t).alias("pos", "word"))
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return x.withColumn("sent_no", F.coalesce(F.sum(F.col("word").isin(".", "!", "?").cast("int")).over(before), F.lit(0)))


_TOKENS = "t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT doc_id, regexp_extract_all({c}, '\\p{{L}}+|[^\\p{{L}}\\s]') AS w FROM documents WHERE {c} IS NOT NULL))"


@query(f"WITH {_TOKENS.format(c='title')} SELECT doc_id, CAST(pos AS INT) AS pos, CASE WHEN regexp_matches(word, '[\\p{{L}}\\p{{N}}]') THEN '<w msd=\"\" lemma=\"' || lower(word) || '\">' || replace(replace(replace(word, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</w>' ELSE '<c>' || replace(replace(replace(replace(word, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') || '</c>' END AS value FROM t")
def token_lines_xml(s: SparkSession, d: str) -> DataFrame:
    t = _tokens(s, d, "title").select("doc_id", "pos", "word", F.lit(None).cast("string").alias("tag"), F.lower("word").alias("lemma"))
    return X.token_lines(t, "xml")


_SYL = "greatest(1, len(regexp_extract_all(lower(word), '[aeiouyáéíóúàèìòùäöüâêîôûěůýąęаеёиоуыэюя]+')))"


@query(
    f"WITH {_TOKENS.format(c='text')}, s AS (SELECT *, coalesce(sum(CASE WHEN word IN ('.', '!', '?') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent, regexp_matches(word, '\\p{{L}}') AS w, {_SYL} AS syl FROM t), f AS (SELECT doc_id, count(*) AS v, count(*) FILTER (WHERE k = 1) AS v1 FROM (SELECT doc_id, lower(word) AS x, count(*) AS k FROM s WHERE w GROUP BY ALL) GROUP BY doc_id), g AS (SELECT doc_id, count(*) FILTER (WHERE w)::double AS n, count(DISTINCT CASE WHEN w THEN sent END)::double AS st, sum(len(word)) FILTER (WHERE w)::double AS ch, sum(syl) FILTER (WHERE w)::double AS sy, count(*) FILTER (WHERE w AND syl > 2)::double AS cx, count(*) FILTER (WHERE word = ',')::double AS cm, count(*) FILTER (WHERE w AND regexp_matches(word, '^\\p{{Lu}}'))::double AS cp FROM s GROUP BY doc_id) SELECT doc_id, round(v / n, 5) AS ttr, round(v1 / n, 5) AS hl, round(0.5::double * n / st + 4.71::double * ch / n - 21.43::double, 5) AS ari, round(206.835::double - 1.015::double * n / st - 84.6::double * sy / n, 5) AS flesch, round(0.4::double * (n / st + 100 * cx / n), 5) AS fog, round(cm / n, 5) AS commas, round(cp / n, 5) AS capitals FROM g JOIN f USING (doc_id) WHERE n > 0"
)
def stylometric_features(s: SparkSession, d: str) -> DataFrame:
    f = G.stylometry(_tokens(s, d))
    return f.select("doc_id", *[r6(c, 5).alias(c) for c in ("ttr", "hl", "commas", "capitals", "ari", "flesch", "fog")])


# ---- tagging: the tag of a token is the language of its document, so many words are ambiguous
def _halves(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = _tokens(s, d, "title").where("lang is not null").select("doc_id", "pos", "word", F.upper(F.left("lang", F.lit(2))).alias("tag"))
    return t.where("doc_id % 2 = 0"), t.where("doc_id % 2 = 1")


_LEX = f"WITH {_TOKENS.format(c='title')}, g AS (SELECT t.*, upper(left(lower(lang), 2)) AS tag FROM t JOIN documents USING (doc_id) WHERE lang IS NOT NULL), l AS (SELECT lower(word) AS w, tag, count(*) AS n FROM g WHERE doc_id % 2 = 0 GROUP BY ALL), b AS (SELECT w, tag FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, tag DESC) AS r FROM l) WHERE r = 1)"


@query(f"{_LEX} SELECT count(*) AS n, round(avg(CASE WHEN b.tag = g.tag THEN 1.0::double ELSE 0.0::double END), 6) AS tag_accuracy FROM g JOIN b ON b.w = lower(g.word) WHERE doc_id % 2 = 1")
def tagging_known_words(s: SparkSession, d: str) -> DataFrame:
    train, test = _halves(s, d)
    lexicon = train.groupBy(F.lower("word").alias("word"), "tag").agg(F.count("*").alias("n"))
    p = G.tag(test, stored(lexicon, "lexicon"), stored(G.suffix_tags(lexicon.select("word", "tag")), "suffixes"), None, context=False)
    return G.accuracy(p, test).where("words = 'known' and punctuation = 'with'").select("n", "tag_accuracy")


@query()
def tagging_accuracy(s: SparkSession, d: str) -> DataFrame:
    train, test = _halves(s, d)
    return G.accuracy(G.tag(test, *G.train(train, rounds=5)), test)


@query()
def meta_tagger_training(s: SparkSession, d: str) -> DataFrame:
    train, test = _halves(s, d)
    lexicon, suffixes, lam = G.train(train, rounds=3)
    one, two = G.tag(test, lexicon, suffixes, lam), G.tag(test, lexicon, suffixes, None, context=False)
    return G.meta_training(G.meta_rows(stored(one, "one"), stored(two, "two")), test).groupBy("right").agg(F.count("*").alias("n"))


@query("WITH RECURSIVE e AS (SELECT l_orderkey AS s, l_linenumber - 1 AS up, l_linenumber AS token, min(l_returnflag) = 'R' AS is_cut FROM lineitem GROUP BY ALL), c(s, token, head) AS (SELECT DISTINCT s, up, up FROM e WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.s = e.s AND x.token = e.up) UNION SELECT e.s, e.token, CASE WHEN is_cut THEN e.token ELSE c.head END FROM c JOIN e ON e.s = c.s AND e.up = c.token) SELECT head, count(*) AS n FROM c GROUP BY head")
def dependency_chunks(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem")
    links = li.groupBy(F.col("l_orderkey").alias("sent_id"), (F.col("l_linenumber") - 1).alias("from_id"), F.col("l_linenumber").alias("dep_id")).agg(F.min("l_returnflag").alias("afun"))
    return G.chunks(links, ("R",)).groupBy("head").agg(F.count("*").alias("n"))


# ---- groups of predictions
def _group(name: str, how: str, sql: str) -> None:
    def run(s: SparkSession, d: str) -> DataFrame:
        e = table(s, d, "embeddings")
        x = e.select((F.col("vec_id") % 7).alias("grp"), F.col("vec_id").alias("row"), F.posexplode(F.slice("embedding", 1, 5)).alias("label", "score"))
        return W.group_predictions(x.withColumn("score", F.col("score").cast("double")), "grp", how).select("grp", "label", r6("score").alias("score"))

    run.__name__ = name
    query(f"WITH x AS (SELECT vec_id % 7 AS grp, vec_id AS row_, CAST(i - 1 AS INT) AS label, embedding[i]::double AS score FROM embeddings, (SELECT unnest(range(1, 6)) AS i)) {sql}")(run)


_group("group_sums", "sum", "SELECT grp, label, round(sum(score), 6) AS score FROM x GROUP BY grp, label")
_group("group_maxima", "max", "SELECT grp, label, round(max(score), 6) AS score FROM x GROUP BY grp, label")
_group("group_votes", "vote", ", b AS (SELECT grp, label FROM (SELECT *, row_number() OVER (PARTITION BY row_ ORDER BY score DESC, label DESC) AS r FROM x) WHERE r = 1) SELECT grp, label, count(*)::double AS score FROM b GROUP BY grp, label")


# ---- streams over the tables
@query()
def url_tree_stream(s: SparkSession, d: str) -> DataFrame:
    """docid, rev, block_no, kind: the stateful labels of all documents, streamed batch by batch in the order of their arrival."""
    w = table(s, d, "written_docs").where("urlkey is not null and arrived is not null").groupBy("docid").agg(F.min_by(F.struct("guid", "urlkey", "arrived", "batchno", "domainname"), "arrived").alias("w")).select("docid", "w.*")
    hashes = table(s, d, "text_blocks").groupBy("docguid").agg(F.first("hashcodes").alias("hashes"))
    x = w.join(hashes, F.col("guid") == F.col("docguid")).where(host_key(F.col("urlkey")).isNotNull())
    nulls = F.transform("hashes", lambda _: F.lit(None))
    x = x.select(W.domain_of(host_key(F.col("urlkey"))).alias("domain"), "docid", F.unix_micros(F.col("arrived").cast("timestamp")).alias("time"), W.normal_url(F.col("urlkey"), "drop").alias("url"), "hashes", nulls.cast("array<int>").alias("chars"), nulls.cast("array<double>").alias("link_shares"), nulls.cast("array<string>").alias("paths"), "batchno").where("url is not null")
    src, out, cp = _folder(s, "docs"), _folder(s, "labels"), _folder(s, "checkpoint")
    x.repartitionByRange(4, "batchno").write.parquet(src)
    stream = P.file_stream(s, src, s.read.parquet(src).schema, per_trigger=2)
    P.run_once(U.label_stream(stream), P.parquet_sink(out), cp)
    return s.read.schema(U.OUT).parquet(out)


@query("SELECT siteid, itemid, item_hash FROM (SELECT siteid, min(itemid) AS itemid, md5(coalesce(title, '') || coalesce(description, '') || coalesce(pubdate, '')) AS item_hash FROM rss_items WHERE siteid IS NOT NULL GROUP BY siteid, item_hash)")
def feed_stream_first_seen(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "rss_items").where("siteid is not null").select("siteid", "itemid", F.md5(F.concat(*[F.coalesce(c, F.lit("")) for c in ("title", "description", "pubdate")])).alias("item_hash"))
    src, out, cp = _folder(s, "items"), _folder(s, "seen"), _folder(s, "checkpoint")
    x.coalesce(1).write.parquet(src)
    schema = s.read.parquet(src).schema
    P.run_once(U.first_seen_bounded(P.file_stream(s, src, schema, 1), "item_hash", "siteid", "itemid"), P.parquet_sink(out), cp)
    return s.read.parquet(out).select("siteid", "itemid", "item_hash")


@query("SELECT docid, left(string_agg(block, ' ' ORDER BY i), 600) AS snippet FROM (SELECT docid, generate_subscripts(annotations, 1) AS i, unnest(annotations) AS a, text, name FROM news_documents WHERE text IS NOT NULL AND name IS NOT NULL AND annotations IS NOT NULL) x, LATERAL (SELECT substr(text, a.spanstart + 1, a.spanend - a.spanstart + 1) AS block) b, LATERAL (SELECT list_distinct(regexp_extract_all(lower(block), '\\p{L}+')) AS p, list_distinct(regexp_extract_all(lower(name), '\\p{L}+')) AS q) c WHERE coalesce(len(list_intersect(p, q))::double / nullif(len(p) + len(q) - len(list_intersect(p, q)), 0), 0) < 0.2 GROUP BY docid")
def site_snippets(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "news_documents").where("text is not null and name is not null and annotations is not null")
    blocks = F.transform("annotations", lambda a: F.substring(F.col("text"), a["spanstart"] + 1, a["spanend"] - a["spanstart"] + 1))
    y = x.select("docid", "name", blocks.alias("blocks"))
    return y.select("docid", X.snippet(F.col("name"), F.col("blocks")).alias("snippet")).where("snippet != ''")


@query("SELECT doc_id, regexp_replace(trim(replace(replace(title, chr(13), ''), chr(10), ' ')), '\\s+', ' ', 'g') AS line FROM documents WHERE title IS NOT NULL AND NOT regexp_matches(title, '[^ \\S]')")
def one_line_titles(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "documents").where("title is not null").where(~F.col("title").rlike(r"[^ \S]"))
    return t.select("doc_id", T.one_line(F.col("title")).alias("line"))
