"""Queries over languages, tokens, addresses and pages, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import languages as L
from ..functions import text as T
from ..operators import web as W
from ..session import table
from .reference_queries import r6
from .registry import registry

QUERIES, ORACLES, query = registry()

_NAMES = "CASE lower(regexp_extract(coalesce(lang, ''), '^\\s*([A-Za-z]{2})([-_].*)?\\s*$', 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.CODES.items()) + " ELSE 'Unspecified' END"


@query(f"SELECT lang, {_NAMES} AS name, count(*) AS n FROM documents GROUP BY lang")
def language_names(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").groupBy("lang").agg(F.count("*").alias("n")).select("lang", L.language_name(F.col("lang")).alias("name"), "n")


@query("SELECT CASE lower(trim(coalesce(x, ''))) " + " ".join(f"WHEN '{v.lower()}' THEN '{k}'" for k, v in L.CODES.items()) + " END AS code, count(*) AS n FROM (SELECT features['detectedLanguage'] AS x FROM news_documents) GROUP BY 1")
def language_codes(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "news_documents").select(L.language_code(F.try_element_at("features", F.lit("detectedLanguage"))).alias("code"))
    return x.groupBy("code").agg(F.count("*").alias("n"))


@query()
def terms_without_stop_words(s: SparkSession, d: str) -> DataFrame:
    from ..operators import vectors as V

    docs = table(s, d, "documents").withColumn("lang", F.lower("lang"))
    x = docs.select("doc_id", "lang", F.explode(T.simple_tokens(F.lower(F.col("text")))).alias("w"))
    kept = x.join(F.broadcast(L.stop_words(s)), ["lang", "w"], "left_anti")
    return V.frequencies(kept.select("doc_id", F.col("w").alias("term")))


@query("WITH m AS (SELECT unnest(['the', 'die', 'councils', 'council']) AS word, unnest(['a', 'der', 'council', 'council']) AS stem), w AS (SELECT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS w FROM documents WHERE text IS NOT NULL) SELECT coalesce(m.stem, w.w) AS stem, count(*) AS n FROM w LEFT JOIN m ON m.word = w.w GROUP BY 1")
def custom_stem_counts(s: SparkSession, d: str) -> DataFrame:
    m = s.createDataFrame([("the", "a", 0), ("die", "der", 1), ("councils", "council", 2), ("the", "late", 3), ("council", "council", 4)], "word string, stem string, ord int")
    w = table(s, d, "documents").select(F.explode(T.simple_tokens(F.lower(F.col("text")))).alias("w"))
    return L.custom_stems(w, "w", m).groupBy("stem").agg(F.count("*").alias("n"))


_RANGE = "CASE " + " ".join(f"WHEN cp < {hi} THEN '{name}'" for (_, name), (hi, _) in zip(L.RANGES, L.RANGES[1:], strict=False)) + f" ELSE '{L.RANGES[-1][1]}' END"


@query(f"WITH c AS (SELECT doc_id, unicode(unnest(string_split(text, ''))) AS cp FROM documents WHERE text IS NOT NULL AND text != ''), r AS (SELECT doc_id, {_RANGE} AS range_, count(*) AS n FROM c GROUP BY ALL), b AS (SELECT doc_id, range_ FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, range_) AS k FROM r) WHERE k = 1) SELECT doc_id, coalesce(range_, 'Other') AS range_ FROM documents LEFT JOIN b USING (doc_id)")
def dominant_ranges(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", L.dominant_range(F.col("text")).alias("range_"))


@query("WITH t AS (SELECT doc_id, title, regexp_extract_all(title, '[\\p{L}\\p{N}]+') AS w FROM documents WHERE title IS NOT NULL) SELECT doc_id, count(*) AS n, CAST(sum(len(x)) AS BIGINT) AS chars, bool_and(true) AS in_place FROM (SELECT doc_id, unnest(w) AS x FROM t) GROUP BY doc_id")
def tokens_with_offsets(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "documents").where("title is not null").select("doc_id", "title", T.with_offsets(T.simple_tokens(F.col("title"), "alphanum"), F.col("title")).alias("t"))
    x = t.select("doc_id", "title", F.inline("t"))
    here = F.substring(F.col("title"), F.col("start") + 1, F.col("end") - F.col("start")) == F.col("token")
    return x.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("chars"), F.bool_and(here).alias("in_place"))


@query("SELECT doc_id, regexp_replace(text, '[\\x{10000}-\\x{10FFFF}]', '?', 'g') AS text FROM documents WHERE text IS NOT NULL")
def texts_without_surrogates(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", T.without_surrogates(F.col("text")).alias("text"))


@query("WITH q AS (SELECT doc_id, list_filter(regexp_extract_all(lower(title), '[^\\s\"+-][^\\s\"]*'), lambda x: x != '') AS t FROM (SELECT doc_id, regexp_replace(title, '[^\\p{L} ]', ' ', 'g') AS title FROM documents WHERE title IS NOT NULL)) SELECT doc_id, array_to_string(list_sort(list_distinct(t)), ' ') AS query FROM q")
def search_queries(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "documents").where("title is not null").select("doc_id", F.regexp_replace("title", r"[^\p{L} ]", " ").alias("title"))
    return x.select("doc_id", T.search_query(F.col("title")).alias("query"))


@query("WITH u AS (SELECT DISTINCT docid, trim(urlkey) AS u FROM written_docs WHERE urlkey IS NOT NULL), p AS (SELECT docid, u, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2)) AS host, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*:([0-9]+)([/?#]|$)', 1) AS port, list_filter(string_split(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x != '') AS segs FROM u) SELECT docid, CASE WHEN scheme != '' AND host != '' THEN scheme || '://' || host || ':' || CASE WHEN port != '' THEN port WHEN scheme = 'https' THEN '443' WHEN scheme = 'ftp' THEN '21' ELSE '80' END || '/' || array_to_string([url_decode(x) for x in segs], '/') END AS url FROM p")
def urls_without_query(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "written_docs").where("urlkey is not null").select("docid", "urlkey").distinct().select("docid", W.normal_url(F.col("urlkey"), "drop").alias("url"))


@query("WITH u AS (SELECT DISTINCT docid, urlkey AS u FROM written_docs WHERE urlkey IS NOT NULL), q AS (SELECT docid, u, unnest(list_filter(string_split(regexp_extract(u, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x != '')) AS x FROM u), kv AS (SELECT docid, u, url_decode(regexp_extract(x, '^([^=]*)', 1)) AS k, url_decode(regexp_extract(x, '=(.*)$', 1)) AS v FROM q), g AS (SELECT docid, u, k, string_agg(v, ',' ORDER BY v) AS v FROM kv GROUP BY ALL) SELECT docid, k, v FROM g")
def url_parameters(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "written_docs").where("urlkey is not null").select("docid", "urlkey").distinct().select("docid", F.inline(W.query_params(F.col("urlkey"))))


@query("WITH h AS (SELECT DISTINCT lower(domainname) AS host FROM written_docs WHERE domainname IS NOT NULL AND regexp_matches(domainname, '^[A-Za-z0-9.-]*[A-Za-z0-9]$')) SELECT host, CASE WHEN host LIKE '%.example' AND len(string_split(host, '.')) > 2 THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE string_split(host, '.')[-1] END AS suffix FROM h")
def public_suffixes(s: SparkSession, d: str) -> DataFrame:
    h = table(s, d, "written_docs").where(r"domainname is not null and domainname rlike '^[A-Za-z0-9.-]*[A-Za-z0-9]$'").select(F.lower("domainname").alias("host")).distinct()
    x = h.select("host", W.public_suffix(F.col("host"), ["com", "*.example"]).alias("suffix"))
    return x.select("host", F.when(F.col("suffix") == F.col("host"), F.element_at(F.split("host", r"\."), -1)).otherwise(F.col("suffix")).alias("suffix"))


@query("WITH v AS (SELECT source, kind, len(text)::double AS w FROM documents WHERE text IS NOT NULL AND source IS NOT NULL AND kind IS NOT NULL), m AS (SELECT source, kind, avg(w) AS m, stddev_pop(w) AS s FROM v GROUP BY ALL) SELECT x.source AS a, y.source AS b, x.kind, round(abs(x.m - y.m), 4) AS diff, round(sqrt(x.s * x.s + y.s * y.s), 4) AS sd FROM m x JOIN m y ON x.kind = y.kind AND x.source < y.source")
def source_distances(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "documents").where("text is not null and source is not null and kind is not null").select("source", "kind", F.length("text").cast("double").alias("w"))
    return W.author_distances(v, "source", "kind", "w").select("a", "b", "kind", r6("diff", 4).alias("diff"), r6("sd", 4).alias("sd"))


@query("WITH x AS (SELECT kind, len(text) AS diff, doc_id % 10 = 0 AS own FROM documents WHERE text IS NOT NULL AND kind IS NOT NULL) SELECT a.kind, a.diff, round((SELECT count(*) FROM x b WHERE NOT b.own AND b.kind = a.kind AND b.diff <= a.diff)::double / (SELECT count(*) FROM x b WHERE NOT b.own AND b.kind = a.kind), 6) AS p FROM x a WHERE a.own")
def empirical_p_values(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "documents").where("text is not null and kind is not null").select("kind", F.length("text").cast("bigint").alias("diff"), (F.col("doc_id") % 10 == 0).alias("own"))
    return W.empirical_p(x.where("own"), x.where("not own"), "kind", "diff").withColumn("p", r6("p"))
