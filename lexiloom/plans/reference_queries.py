"""Queries over text, vectors, models, documents, graphs, events and the star schema, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import docmodel as D
from ..operators import evaluation as E
from ..operators import graph as G
from ..operators import models as M
from ..operators import vectors as V
from ..operators import web as W
from ..session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(c, n: int = 6):
    return F.round(c, n)


_TOK = "SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM documents WHERE text IS NOT NULL"
_TF = f"occ AS ({_TOK}), tf AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY ALL), voc AS (SELECT term, sum(tf) AS freq, count(*) AS df FROM tf GROUP BY ALL), n AS (SELECT count(*)::double AS n FROM documents)"


def _occ(s, d, **k):
    return V.terms(table(s, d, "documents"), **k)


def _n(s, d):
    return F.lit(table(s, d, "documents").count())


# ---- tokens and term spaces
@query(f"WITH {_TF} SELECT term, CAST(freq AS BIGINT) AS freq, df FROM voc")
def term_doc_freq(s: SparkSession, d: str) -> DataFrame:
    return V.frequencies(_occ(s, d))


@query(
    "WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+') AS w FROM documents WHERE text IS NOT NULL), g AS (SELECT unnest(w) AS term FROM t UNION ALL SELECT unnest([w[i] || ' ' || w[i+1] for i in range(1, len(w))]) FROM t WHERE len(w) > 1) SELECT term, count(*) AS freq FROM g GROUP BY term HAVING count(*) >= 5"
)
def ngram_freq(s: SparkSession, d: str) -> DataFrame:
    return V.frequencies(_occ(s, d, max_n=2)).where("freq >= 5").select("term", "freq")


@query(f"WITH {_TF} SELECT doc_id, term, round(tf * ln(n / df), 6) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0 AND freq >= 5")
def tfidf_weights(s: SparkSession, d: str) -> DataFrame:
    return V.weights(_occ(s, d), _n(s, d), min_freq=5).withColumn("w", r6("w"))


@query(f"WITH {_TF} SELECT doc_id, term, round(ln(1 + df::double) * tf * ln(n / df), 6) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0")
def logdf_weights(s: SparkSession, d: str) -> DataFrame:
    return V.weights(_occ(s, d), _n(s, d), kind="logdf").withColumn("w", r6("w"))


_CUT = f"WITH {_TF}, v AS (SELECT doc_id, term, tf * ln(n / df) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0), x AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY w, term ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY doc_id) AS total FROM v), y AS (SELECT *, min(CASE WHEN run >= total * 0.2 - 1e-12 THEN w END) OVER (PARTITION BY doc_id) AS lim FROM x), c AS (SELECT doc_id, term, w FROM y WHERE w >= lim)"


@query(f"{_CUT} SELECT doc_id, count(*) AS n_terms, round(sum(w), 4) AS total FROM c GROUP BY doc_id")
def cut_low_weights(s: SparkSession, d: str) -> DataFrame:
    return V.cut_low(V.weights(_occ(s, d), _n(s, d))).groupBy("doc_id").agg(F.count("*").alias("n_terms"), r6(F.sum("w"), 4).alias("total"))


@query(f"WITH {_TF}, v AS (SELECT doc_id, term, tf * ln(n / df) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0) SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS w FROM v")
def l2_vectors(s: SparkSession, d: str) -> DataFrame:
    return V.l2(V.weights(_occ(s, d), _n(s, d))).withColumn("w", r6("w"))


@query(f"WITH {_TF}, v AS (SELECT doc_id, term, round(tf * ln(n / df), 9) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0) SELECT doc_id, term, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) AS INT) AS rank FROM v) WHERE rank <= 5")
def top_keywords(s: SparkSession, d: str) -> DataFrame:
    v = V.weights(_occ(s, d), _n(s, d)).withColumn("w", F.round("w", 9))
    return V.keywords(v, 5).select("doc_id", "term", "rank")


@query(
    "WITH new AS (SELECT doc_id, text FROM documents ORDER BY doc_id DESC LIMIT 500), occ AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM new WHERE text IS NOT NULL), tf AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL) SELECT doc_id, term, round(tf * ln((SELECT count(*) FROM new)::double / df), 6) AS w FROM tf JOIN df USING (term)"
)
def window_tfidf(s: SparkSession, d: str) -> DataFrame:
    return V.window_weights(table(s, d, "documents"), 500).withColumn("w", r6("w"))


@query("SELECT CASE WHEN len(regexp_replace(w, '\\P{L}', '', 'g')) = 0 THEN 'Other' WHEN len(regexp_replace(w, '\\P{L}', '', 'g')) = 1 THEN CASE WHEN NOT regexp_matches(w, '^\\p{L}') THEN 'Other' WHEN regexp_matches(w, '^\\p{Lu}') THEN 'ABC' ELSE 'abc' END WHEN regexp_matches(w, '^\\p{Lu}') THEN CASE WHEN len(regexp_replace(w, '\\P{Lu}', '', 'g')) = len(regexp_replace(w, '\\P{L}', '', 'g')) THEN 'ABC' WHEN len(regexp_replace(w, '\\P{Lu}', '', 'g')) = 1 THEN 'Abc' ELSE 'AbC' END WHEN len(regexp_replace(w, '\\P{Lu}', '', 'g')) = 0 THEN 'abc' ELSE 'aBc' END AS case_type, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS w FROM documents WHERE text IS NOT NULL) GROUP BY 1")
def case_type_counts(s: SparkSession, d: str) -> DataFrame:
    w = table(s, d, "documents").select(F.explode(T.simple_tokens(F.col("text"), "alphanum")).alias("w"))
    return w.groupBy(T.case_type(F.col("w")).alias("case_type")).agg(F.count("*").alias("n"))


@query()
def unicode_token_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.size(T.unicode_tokens(F.col("text"))).alias("n_tokens"))


@query("SELECT doc_id, len(CASE WHEN len(regexp_extract_all(text, '\\p{L}+(-\\p{L}+)*')) > 0 THEN regexp_extract_all(text, '\\p{L}+(-\\p{L}+)*') ELSE [] END) AS n_tokens FROM documents WHERE text IS NOT NULL")
def regex_token_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", F.size(T.regex_tokens(F.col("text"), keep_unknown=False)).cast("bigint").alias("n_tokens"))


@query("SELECT doc_id, md5(text) AS digest, substr(m,7,2)||substr(m,5,2)||substr(m,3,2)||substr(m,1,2)||substr(m,11,2)||substr(m,9,2)||substr(m,15,2)||substr(m,13,2)||substr(m,17,16) AS hash128 FROM (SELECT doc_id, text, md5(text) AS m FROM documents WHERE text IS NOT NULL)")
def text_hashes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", F.md5("text").alias("digest"), T.hash128(F.col("text")).alias("hash128"))


_BYTE = "xor(('0x' || substr(m, 2 * k + 1, 2))::INT, ('0x' || substr(m, 2 * k + 17, 2))::INT)"


@query(f"WITH b AS (SELECT doc_id, k, {_BYTE} AS v FROM (SELECT doc_id, md5(text) AS m, unnest(range(8)) AS k FROM documents WHERE text IS NOT NULL)), h AS (SELECT doc_id, sum(v::HUGEINT << (8 * k)::INT) AS h FROM b GROUP BY doc_id) SELECT doc_id, CAST(CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END AS BIGINT) AS hash64 FROM h")
def text_hash64(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", T.hash64(F.col("text")).alias("hash64"))


@query()
def text_hash64_utf16(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", T.hash64(F.col("text"), "UTF-16LE").alias("hash64"))


@query("SELECT min(doc_id) AS first_id, count(*) AS n, count(DISTINCT source) AS n_sources FROM documents WHERE text IS NOT NULL GROUP BY md5(text) HAVING count(*) > 1")
def exact_copies(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "documents").where("text is not null").groupBy(F.md5("text").alias("m")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.count_distinct("source").alias("n_sources"))
    return g.where("n > 1").drop("m")


_SIM = f"WITH {_TF}, w AS (SELECT term, md5(term) AS m FROM voc), bit AS (SELECT term, 8 * k + j AS i, (xb >> j) & 1 AS on_ FROM (SELECT term, k, {_BYTE} AS xb FROM (SELECT *, unnest(range(8)) AS k FROM w)), (SELECT unnest(range(8)) AS j)), s AS (SELECT doc_id, i, sum(CASE WHEN on_ = 1 THEN tf ELSE -tf END) AS s FROM tf JOIN bit USING (term) GROUP BY ALL), h AS (SELECT doc_id, sum(CASE WHEN s >= 0 THEN 1::HUGEINT << i::INT ELSE 0 END) AS h FROM s GROUP BY doc_id), fp AS (SELECT doc_id, CAST(CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END AS BIGINT) AS fingerprint FROM h)"


@query(f"{_SIM} SELECT doc_id, fingerprint FROM fp")
def simhash_fingerprints(s: SparkSession, d: str) -> DataFrame:
    return V.simhash(_occ(s, d))


@query(f"{_SIM}, r AS (SELECT fingerprint, min(doc_id) AS id FROM fp GROUP BY fingerprint) SELECT a.id AS a, b.id AS b, bit_count(xor(a.fingerprint, b.fingerprint))::INT AS distance FROM r a, r b WHERE a.id < b.id AND bit_count(xor(a.fingerprint, b.fingerprint)) <= 3")
def simhash_pairs(s: SparkSession, d: str) -> DataFrame:
    return V.near_fingerprints(V.simhash(_occ(s, d)))


@query(f"{_SIM} SELECT doc_id, min(doc_id) OVER (PARTITION BY fingerprint) AS representative FROM fp")
def simhash_members(s: SparkSession, d: str) -> DataFrame:
    return V.fingerprint_members(V.simhash(_occ(s, d)))


@query("WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '\\p{L}+')) AS a, list_distinct(regexp_extract_all(lower(title), '\\p{L}+')) AS b FROM documents WHERE text IS NOT NULL AND title IS NOT NULL) SELECT doc_id, round(CASE WHEN len(a) + len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b))::double / (len(a) + len(b) - len(list_intersect(a, b))) END, 6) AS jaccard FROM t")
def title_jaccard(s: SparkSession, d: str) -> DataFrame:
    a, b = F.array_distinct(T.simple_tokens(F.lower(F.col("text")))), F.array_distinct(T.simple_tokens(F.lower(F.col("title"))))
    t = table(s, d, "documents").where("text is not null and title is not null").select("doc_id", a.alias("a"), b.alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return t.select("doc_id", r6(F.when(F.size("a") + F.size("b") == 0, 1.0).otherwise(both / (F.size("a") + F.size("b") - both))).alias("jaccard"))


@query(f"WITH {_TF}, r AS (SELECT doc_id, sum(tf) AS n, count(*) AS v, sum(CASE WHEN tf = 1 THEN 1 ELSE 0 END) AS v1 FROM tf GROUP BY doc_id) SELECT doc_id, CAST(n AS BIGINT) AS n, v, round(v::double / n, 6) AS ttr, round(v1::double / n, 6) AS hl, round(CASE WHEN v1 < v THEN 100 * ln(n::double) / (1 - v1::double / v) END, 4) AS honore, round(pow(n::double, pow(v::double, -0.165)), 6) AS brunet FROM r")
def vocabulary_richness(s: SparkSession, d: str) -> DataFrame:
    return W.richness(_occ(s, d)).select("doc_id", "n", "v", r6("ttr").alias("ttr"), r6("hl").alias("hl"), r6("honore", 4).alias("honore"), r6("brunet").alias("brunet"))


@query("WITH t AS (SELECT doc_id, regexp_extract_all(text, '\\p{L}+') AS w, greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS s FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, len(w)::double AS n, s, list_sum([len(y) for y in w])::double AS chars, list_sum([greatest(len(regexp_extract_all(lower(y), '[aeiouy]+')), 1) for y in w])::double AS syl FROM t WHERE len(w) > 0) SELECT doc_id, round(0.5::double * (n / s) + 4.71::double * (chars / n) - 21.43::double, 3) AS ari, round(206.835::double - 1.015::double * (n / s) - 84.6::double * (syl / n), 3) AS flesch FROM x")
def readability_scores(s: SparkSession, d: str) -> DataFrame:
    return W.readability(table(s, d, "documents"), T.simple_tokens(F.col("text"))).select("doc_id", r6("ari", 3).alias("ari"), r6("flesch", 3).alias("flesch"))


@query("SELECT source, count(*) AS n_docs, CAST(sum(len(text)) AS BIGINT) AS chars, round(avg(len(text)), 4) AS mean_chars FROM documents GROUP BY source")
def source_sizes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("chars"), r6(F.avg(F.length("text")), 4).alias("mean_chars"))


# ---- vectors and models
_DOTS = "SELECT q.vec_id AS q_id, e.vec_id AS id, list_dot_product(q.embedding::double[], e.embedding::double[]) / (sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])) * sqrt(list_dot_product(e.embedding::double[], e.embedding::double[]))) AS score, e.label FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0 AND q.vec_id != e.vec_id"


def _pairs(s, d):
    e = table(s, d, "embeddings")
    rows = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q_vec"))
    return M.scored_against(q, rows, M.cosine(F.col("q_vec"), F.col("vec")))


@query(f"SELECT q_id, id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, id) AS rank FROM ({_DOTS})) WHERE rank <= 10")
def cosine_top10(s: SparkSession, d: str) -> DataFrame:
    return M.top_k(_pairs(s, d), 10).select("q_id", "id", r6("score").alias("score"), "rank")


@query(f"SELECT q_id, count(*) AS n_links, round(max(score), 6) AS best FROM ({_DOTS}) WHERE score > 0.25 GROUP BY q_id")
def cosine_links(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d).where("score > 0.25").groupBy("q_id").agg(F.count("*").alias("n_links"), r6(F.max("score")).alias("best"))


@query("SELECT q.vec_id, count(*) FILTER (WHERE list_dot_product(q.embedding::double[], e.embedding::double[]) / (sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])) * sqrt(list_dot_product(e.embedding::double[], e.embedding::double[]))) > 0.25 AND q.vec_id != e.vec_id) AS n_links FROM embeddings q, embeddings e GROUP BY q.vec_id")
def cosine_threshold_join(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    return M.threshold_links(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec")), 0.25).select(F.col("id").alias("vec_id"), "n_links")


_KNN = f"WITH p AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, id) AS rank FROM ({_DOTS})), v AS (SELECT q_id, label, sum(score) AS s FROM p WHERE rank <= 10 GROUP BY q_id, label), b AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(s, 9) DESC, label) AS r FROM v)"


def _knn(s, d):
    v = M.top_k(_pairs(s, d), 10).groupBy("q_id", "label").agg(F.sum("score").alias("s"))
    r = F.row_number().over(Window.partitionBy("q_id").orderBy(F.desc(F.round("s", 9)), "label"))
    return v.withColumn("r", r).where("r = 1")


@query(f"{_KNN} SELECT q_id, label AS predicted, round(s, 6) AS votes FROM b WHERE r = 1")
def knn_predict(s: SparkSession, d: str) -> DataFrame:
    return _knn(s, d).select("q_id", F.col("label").alias("predicted"), r6("s").alias("votes"))


@query(f"{_KNN} SELECT e.label AS actual, b.label AS predicted, count(*) AS n FROM b JOIN embeddings e ON e.vec_id = b.q_id WHERE r = 1 GROUP BY ALL")
def knn_confusion(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings").select(F.col("vec_id").alias("q_id"), F.col("label").alias("actual"))
    return M.confusion(_knn(s, d).join(e, "q_id"), "actual", "label")


@query(
    f"{_KNN}, c AS (SELECT e.label AS a, b.label AS p, count(*) AS n FROM b JOIN embeddings e ON e.vec_id = b.q_id WHERE r = 1 GROUP BY ALL), l AS (SELECT a AS label FROM c UNION SELECT p FROM c), x AS (SELECT label, coalesce((SELECT sum(n) FROM c WHERE a = label), 0)::double AS rn, coalesce((SELECT sum(n) FROM c WHERE p = label), 0)::double AS cn, coalesce((SELECT sum(n) FROM c WHERE a = label AND p = label), 0)::double AS dg FROM l), y AS (SELECT label, CASE WHEN cn = 0 THEN 1 ELSE dg / cn END AS pr, CASE WHEN rn = 0 THEN 1 ELSE dg / rn END AS rc FROM x) SELECT label, round(pr, 6) AS precision, round(rc, 6) AS recall, round(CASE WHEN pr + rc = 0 THEN 0 ELSE 2 * pr * rc / (pr + rc) END, 6) AS f1 FROM y"
)
def knn_metrics(s: SparkSession, d: str) -> DataFrame:
    m = M.precision_recall(knn_confusion(s, d))
    return m.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"))


_CENT = "WITH x AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"


@query(f"{_CENT} SELECT label, CAST(pos AS INT) AS pos, round(avg(x), 6) AS v FROM x GROUP BY label, pos")
def centroid_avg(s: SparkSession, d: str) -> DataFrame:
    return M.centroids(table(s, d, "embeddings"), "label", "embedding").withColumn("v", r6("v"))


@query(f"{_CENT}, c AS (SELECT label, pos, avg(x) AS v FROM x GROUP BY label, pos) SELECT label, CAST(pos AS INT) AS pos, round(v / sqrt(sum(v * v) OVER (PARTITION BY label)), 6) AS v FROM c")
def centroid_nrml2(s: SparkSession, d: str) -> DataFrame:
    return M.centroids(table(s, d, "embeddings"), "label", "embedding", "nrml2").withColumn("v", r6("v"))


@query("SELECT vec_id, round(sqrt(list_dot_product(embedding::double[], embedding::double[])), 6) AS norm FROM embeddings")
def l2_norms(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "embeddings").select("vec_id", r6(M.norm(F.col("embedding"))).alias("norm"))


_FOLDS = "f AS (SELECT *, len([i for i in range(1, 5) if round_even(i * n / 5.0::double, 0) <= pos]) AS fold FROM (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n FROM embeddings))"
_CV = f"WITH {_FOLDS}, k AS (SELECT unnest(range(5)) AS k), x AS (SELECT k, label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS p FROM f, k WHERE fold != k), c AS (SELECT k, label, list(v ORDER BY p) AS c FROM (SELECT k, label, p, avg(x) AS v FROM x GROUP BY ALL) GROUP BY k, label), sc AS (SELECT f.vec_id, f.fold, f.label AS actual, c.label, list_dot_product(f.embedding::double[], c.c) / (sqrt(list_dot_product(f.embedding::double[], f.embedding::double[])) * sqrt(list_dot_product(c.c, c.c))) AS s FROM f JOIN c ON c.k = f.fold), b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, label) AS r FROM sc)"


def _centroid_cv(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")

    def predict(train: DataFrame, test: DataFrame) -> DataFrame:
        x = train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))
        return M.nearest_centroid(x, "label", "embedding", "vec_id", F.col("is_train")).withColumnRenamed("label", "predicted")

    return E.cross_validated(e, "vec_id", 5, predict, "label")


@query(f"{_CV} SELECT fold, actual, label AS predicted, count(*) AS n FROM b WHERE r = 1 GROUP BY ALL")
def nearest_centroid_cv(s: SparkSession, d: str) -> DataFrame:
    return _centroid_cv(s, d).withColumn("fold", F.col("fold").cast("bigint"))


@query(f"{_CV}, a AS (SELECT fold, avg(CASE WHEN actual = label THEN 1.0::double ELSE 0.0::double END) AS acc FROM b WHERE r = 1 GROUP BY fold) SELECT round(avg(acc), 6) AS mean, round(stddev_pop(acc), 6) AS sd, count(*) AS n_folds FROM a")
def nearest_centroid_cv_summary(s: SparkSession, d: str) -> DataFrame:
    return E.fold_summary(_centroid_cv(s, d)).select(r6("mean").alias("mean"), r6("sd").alias("sd"), "n_folds")


@query("SELECT vec_id, CAST(len([i for i in range(1, 5) if round_even(i * n / 4.0::double, 0) <= pos]) AS INT) AS fold FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n FROM embeddings)")
def cv_split(s: SparkSession, d: str) -> DataFrame:
    return E.folds(table(s, d, "embeddings"), "vec_id", 4)


@query("SELECT quality, count(*) AS n, round(count(*)::double / sum(count(*)) OVER (), 6) AS score FROM labels WHERE quality IS NOT NULL GROUP BY quality")
def majority_prior(s: SparkSession, d: str) -> DataFrame:
    return M.majority(table(s, d, "labels"), "quality").withColumn("score", r6("score"))


@query(
    "WITH l AS (SELECT doc_id, min(toxic) AS label FROM labels GROUP BY doc_id), f AS (SELECT DISTINCT d.doc_id AS row, l.label, unnest(regexp_extract_all(lower(title), '\\p{L}+')) AS feature, row_number() OVER (PARTITION BY 1 ORDER BY d.doc_id) AS z FROM documents d JOIN l USING (doc_id) WHERE title IS NOT NULL), ff AS (SELECT DISTINCT row, label, feature FROM f), ex AS (SELECT DISTINCT row, label FROM ff), n AS (SELECT count(*)::double AS n, count(DISTINCT label)::double AS k FROM ex), c AS (SELECT label, count(*)::double AS n_c FROM ex GROUP BY label), p0 AS (SELECT feature, count(*)::double AS n_f FROM ff GROUP BY feature), fc AS (SELECT feature, label, count(*)::double AS n_fc FROM ff GROUP BY feature, label), g AS (SELECT p0.feature, c.label, ln((coalesce(n_fc, 0) + 2 * ((n_f + 1) / (n + 2))) / (n_c + 2)) AS lp FROM p0 CROSS JOIN c CROSS JOIN n LEFT JOIN fc ON fc.feature = p0.feature AND fc.label = c.label) SELECT ff.row, g.label, round(max(ln((n_c + 2 / k) / (n + 2))) + sum(lp), 4) AS score FROM ff JOIN g USING (feature) JOIN c ON c.label = g.label CROSS JOIN n GROUP BY ff.row, g.label"
)
def naive_bayes_titles(s: SparkSession, d: str) -> DataFrame:
    lab = table(s, d, "labels").groupBy("doc_id").agg(F.min("toxic").alias("label"))
    x = table(s, d, "documents").where("title is not null").join(lab, "doc_id").select(F.col("doc_id").alias("row"), "label", F.explode(F.array_distinct(T.simple_tokens(F.lower(F.col("title"))))).alias("feature"))
    return M.naive_bayes(x, x.select("row", "feature")).select("row", "label", r6("score", 4).alias("score"))


def _kmeans_sql(rounds: int) -> str:
    dot = "list_dot_product({}, {})"
    q = "WITH p AS MATERIALIZED (SELECT vec_id, [x / sqrt(list_dot_product(e, e)) for x in e] AS x FROM (SELECT vec_id, embedding::double[] AS e FROM embeddings) WHERE list_dot_product(e, e) > 0), c0 AS MATERIALIZED (SELECT vec_id AS cluster, x AS c FROM p ORDER BY vec_id LIMIT 10)"
    for i in range(rounds):
        d = dot.format("x", "c")
        q += f", a{i} AS MATERIALIZED (SELECT vec_id, x, cluster, s FROM (SELECT vec_id, x, cluster, {d} AS s, row_number() OVER (PARTITION BY vec_id ORDER BY round({d}, 9) DESC, cluster) AS r FROM p, c{i}) WHERE r = 1)"
        q += f", m{i} AS (SELECT cluster, list(v ORDER BY k) AS m FROM (SELECT cluster, k, avg(v) AS v FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM a{i}) GROUP BY ALL) GROUP BY cluster), c{i + 1} AS MATERIALIZED (SELECT cluster, [v / sqrt(list_dot_product(m, m)) for v in m] AS c FROM m{i})"
    return q + f" SELECT vec_id, cluster, round(s, 6) AS score FROM a{rounds - 1}"


@query(_kmeans_sql(10))
def kmeans_fixed(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    seeds = e.orderBy("vec_id").limit(10).select(F.col("vec_id").alias("cluster"), F.col("embedding").alias("c"))
    return M.kmeans(e, "vec_id", "embedding", seeds).select("vec_id", "cluster", r6("score").alias("score"))


# ---- documents, annotations, addresses
@query("SELECT a.type AS type, count(*) AS n, CAST(sum(len(substr(text, a.spanstart + 1, a.spanend - a.spanstart + 1))) AS BIGINT) AS chars FROM (SELECT text, unnest(annotations) AS a FROM news_documents WHERE text IS NOT NULL) GROUP BY 1")
def annotation_types(s: SparkSession, d: str) -> DataFrame:
    a = D.select_type(D.annotations_of(table(s, d, "news_documents").where("text is not null")), "")
    return a.groupBy("type").agg(F.count("*").alias("n"), F.sum(F.length("block")).alias("chars"))


@query("WITH p AS (SELECT string_split(a.features['domPath'], '/') AS p FROM (SELECT unnest(annotations) AS a FROM news_documents) WHERE a.features['domPath'] IS NOT NULL) SELECT node, count(*) AS n FROM (SELECT unnest([array_to_string(p[1:i], '/') for i in range(1, len(p) + 1)]) AS node FROM p) GROUP BY node")
def dom_path_tree(s: SparkSession, d: str) -> DataFrame:
    a = D.annotations_of(table(s, d, "news_documents")).withColumn("path", F.try_element_at("features", F.lit("domPath")))
    return D.type_tree(a, "path")


@query(
    "WITH a AS (SELECT docid, unnest(annotations) AS a FROM news_documents), i AS (SELECT docid, a.spanstart AS s, a.spanend AS e FROM a), o AS (SELECT docid, 0 AS s2, max(e) // 2 AS e2 FROM i GROUP BY docid) SELECT i.docid, count(*) AS n FROM i JOIN o USING (docid) WHERE s >= s2 AND e <= e2 GROUP BY i.docid"
)
def blocks_in_first_half(s: SparkSession, d: str) -> DataFrame:
    a = D.annotations_of(table(s, d, "news_documents"))
    half = a.groupBy("docid").agg(F.lit(0).alias("ann_no"), F.lit(0).alias("spanstart"), F.floor(F.max("spanend") / 2).cast("int").alias("spanend"))
    return D.contained(a, half).groupBy("docid").agg(F.count("*").alias("n"))


@query("SELECT features['siteId'] AS site, features['contentType'] AS content_type, count(*) AS n FROM news_documents GROUP BY ALL")
def feature_counts(s: SparkSession, d: str) -> DataFrame:
    f = table(s, d, "news_documents").select(F.try_element_at("features", F.lit("siteId")).alias("site"), F.try_element_at("features", F.lit("contentType")).alias("content_type"))
    return f.groupBy("site", "content_type").agg(F.count("*").alias("n"))


@query("SELECT h AS hash, count(DISTINCT docguid) AS n_docs FROM (SELECT docguid, unnest(hashcodes) AS h FROM text_blocks) GROUP BY h HAVING count(DISTINCT docguid) >= 5")
def block_hash_counts(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "text_blocks").select("docguid", F.explode("hashcodes").alias("hash")).distinct()
    return x.groupBy("hash").agg(F.count("*").alias("n_docs")).where("n_docs >= 5")


@query("SELECT DISTINCT domainname FROM (SELECT domainname FROM (SELECT domainname, max(arrived) AS m FROM written_docs WHERE domainname IS NOT NULL GROUP BY 1 ORDER BY m DESC, domainname LIMIT 3000) UNION ALL SELECT domainname FROM (SELECT domainname, count(*) AS n FROM written_docs WHERE domainname IS NOT NULL GROUP BY 1 ORDER BY n DESC, domainname LIMIT 3000))")
def top_domains(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "written_docs").where("domainname is not null").groupBy("domainname").agg(F.max("arrived").alias("m"), F.count("*").alias("n"))
    return g.orderBy(F.desc("m"), "domainname").limit(3000).select("domainname").union(g.orderBy(F.desc("n"), "domainname").limit(3000).select("domainname")).distinct()


@query(
    "WITH l AS (SELECT urlkey, arg_max(rev, {'a': arrived, 'r': rev}) AS latest FROM written_docs WHERE urlkey IS NOT NULL AND rev IS NOT NULL GROUP BY urlkey), x AS (SELECT DISTINCT d.domainname, d.docid, d.guid, d.arrived, l.latest, len(t.hashcodes) AS blocks FROM written_docs d JOIN text_blocks t ON d.guid = t.docguid JOIN l ON l.urlkey = d.urlkey WHERE d.domainname IS NOT NULL) SELECT domainname, docid, latest, blocks FROM (SELECT *, row_number() OVER (PARTITION BY domainname ORDER BY arrived DESC, docid, blocks) AS r FROM x) WHERE r <= 10000"
)
def recent_docs(s: SparkSession, d: str) -> DataFrame:
    w = table(s, d, "written_docs")
    latest = w.where("urlkey is not null and rev is not null").groupBy("urlkey").agg(F.max_by("rev", F.struct("arrived", "rev")).alias("latest"))
    t = table(s, d, "text_blocks").select(F.col("docguid").alias("guid"), F.size("hashcodes").cast("bigint").alias("blocks"))
    x = w.where("domainname is not null").join(t, "guid").join(latest, "urlkey").select("domainname", "docid", "guid", "arrived", "latest", "blocks").distinct()
    r = F.row_number().over(Window.partitionBy("domainname").orderBy(F.desc("arrived"), "docid", "blocks"))
    return x.withColumn("r", r).where("r <= 10000").select("domainname", "docid", "latest", "blocks")


@query("SELECT siteid, hash FROM (SELECT DISTINCT siteid, hash, arrived, docid FROM written_docs WHERE hash IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY siteid ORDER BY arrived DESC, docid DESC) <= 30000")
def feed_history(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "written_docs").where("hash is not null").select("siteid", "hash", "arrived", "docid").distinct()
    r = F.row_number().over(Window.partitionBy("siteid").orderBy(F.desc("arrived"), F.desc("docid")))
    return x.withColumn("r", r).where("r <= 30000").select("siteid", "hash")


@query("SELECT itemid, md5(coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(pubdate, '')) AS item_hash FROM (SELECT *, row_number() OVER (PARTITION BY md5(coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(pubdate, '')) ORDER BY itemid) AS r FROM rss_items) WHERE r = 1")
def feed_first_seen(s: SparkSession, d: str) -> DataFrame:
    h = F.md5(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "description", "pubdate")]))
    return table(s, d, "rss_items").groupBy(h.alias("item_hash")).agg(F.min("itemid").alias("itemid")).select("itemid", "item_hash")


@query("SELECT c AS category, count(*) AS n FROM (SELECT unnest(string_split(category, ' ;; ')) AS c FROM rss_items WHERE category IS NOT NULL) GROUP BY c")
def feed_categories(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "rss_items").where("category is not null").select(F.explode(F.split("category", " ;; ")).alias("category"))
    return x.groupBy("category").agg(F.count("*").alias("n"))


@query("SELECT docid, lower(regexp_extract(urlkey, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, lower(regexp_extract(urlkey, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host, regexp_extract(urlkey, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(urlkey, '\\?([^#]*)', 1) AS query FROM written_docs WHERE urlkey IS NOT NULL")
def url_parts(s: SparkSession, d: str) -> DataFrame:
    p = W.url_parts(F.col("urlkey"))
    return table(s, d, "written_docs").where("urlkey is not null").select("docid", *[c.alias(k) for k, c in p.items()])


@query("WITH s AS (SELECT lower(regexp_extract(urlkey, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#:]*)', 2)) AS host, list_filter(string_split(regexp_extract(urlkey, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x != '') AS segs, regexp_extract(urlkey, '\\?([^#]*)', 1) AS q FROM (SELECT DISTINCT docid, urlkey FROM written_docs) WHERE urlkey IS NOT NULL), k AS (SELECT host, segs[1:greatest(len(segs) - CASE WHEN q = '' THEN 1 ELSE 0 END, 0)] AS keep FROM s) SELECT host, prefix, count(*) AS n FROM (SELECT host, unnest(['/' || array_to_string(keep[1:i], '/') for i in range(0, len(keep) + 1)]) AS prefix FROM k) GROUP BY ALL")
def url_tree_nodes(s: SparkSession, d: str) -> DataFrame:
    return W.url_nodes(table(s, d, "written_docs").select("docid", "urlkey").distinct(), "urlkey")


@query("SELECT docid, urlkey, CAST(row_number() OVER (PARTITION BY urlkey ORDER BY arrived, docid) AS INT) AS occurrence FROM (SELECT DISTINCT docid, urlkey, arrived FROM written_docs WHERE urlkey IS NOT NULL)")
def url_occurrences(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "written_docs").where("urlkey is not null").select("docid", "urlkey", "arrived").distinct()
    return x.select("docid", "urlkey", F.row_number().over(Window.partitionBy("urlkey").orderBy("arrived", "docid")).alias("occurrence"))


@query("SELECT CASE WHEN lower(coalesce(mimetype, '')) LIKE '%html%' THEN 'Html' WHEN lower(coalesce(mimetype, '')) LIKE '%xml%' THEN 'Xml' WHEN lower(coalesce(mimetype, '')) LIKE 'text/%' THEN 'Text' ELSE 'Binary' END AS kind, count(*) AS n FROM written_docs GROUP BY 1")
def mime_classes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "written_docs").groupBy(T.mime_class(F.col("mimetype")).alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT docid, left(title, 400) AS title, left(snippet, 100) AS snippet, trim(regexp_replace(regexp_replace(replace(snippet, chr(13), ''), chr(10), ' ', 'g'), '[ \\t]+', ' ', 'g')) AS line FROM (SELECT DISTINCT docid, title, snippet FROM written_docs WHERE NOT regexp_matches(coalesce(snippet, ''), '[^ \\t\\r\\n\\S]'))")
def stored_columns(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "written_docs").select("docid", "title", "snippet").distinct().where(~F.coalesce("snippet", F.lit("")).rlike(r"[^ \t\r\n\S]"))
    line = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("snippet", "\r", ""), "\n", " "), "[ \\t]+", " "))
    return x.select("docid", F.left("title", F.lit(400)).alias("title"), F.left("snippet", F.lit(100)).alias("snippet"), line.alias("line"))


# ---- graphs
_EDGES = "WITH RECURSIVE e AS (SELECT s.s_nationkey AS src, c.c_nationkey AS dst, count(*)::double AS w FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL)"


def _edges(s, d):
    li = table(s, d, "lineitem").select("l_suppkey", "l_orderkey")
    o = table(s, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(table(s, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst")).agg(F.count("*").cast("double").alias("w"))


@query(
    f"{_EDGES}, v AS (SELECT src AS id FROM e UNION SELECT dst FROM e), n AS (SELECT count(*)::double AS n FROM v), p AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS p FROM e), r0 AS (SELECT id, 1.0::double / n AS r FROM v, n), "
    + ", ".join(
        f"g{i} AS (SELECT v.id, coalesce(sum(r * p), 0.0::double) AS g FROM v LEFT JOIN p ON p.dst = v.id LEFT JOIN r{i} q ON q.id = p.src GROUP BY v.id), r{i + 1} AS (SELECT id, 0.85::double * (g + (1 - (SELECT sum(g) FROM g{i})) / n) + 0.15::double / n AS r FROM g{i}, n)"
        for i in range(10)
    )
    + " SELECT id, round(r, 6) AS rank FROM r10"
)
def pagerank_nations(s: SparkSession, d: str) -> DataFrame:
    return G.pagerank(_edges(s, d), 10).select("id", r6("rank").alias("rank"))


@query(f"{_EDGES} SELECT src AS i, dst AS j, -w AS v FROM e WHERE src != dst UNION ALL SELECT dst, dst, sum(w) FROM e WHERE src != dst GROUP BY dst")
def laplacian_nations(s: SparkSession, d: str) -> DataFrame:
    return G.laplacian(_edges(s, d))


@query(
    "WITH RECURSIVE g AS (SELECT DISTINCT o_custkey AS src, o_custkey % 97 + 1 AS dst FROM orders WHERE o_orderstatus = 'F'), h(id, depth) AS (SELECT 5, 0 UNION SELECT g.dst, h.depth + 1 FROM h JOIN g ON g.src = h.id WHERE h.depth < 6) SELECT id, min(depth) AS depth FROM h GROUP BY id"
)
def hops_from_source(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("src"), (F.col("o_custkey") % 97 + 1).alias("dst")).distinct()
    src = s.range(5, 6).select("id")
    return G.hops(e, src, 6).select(F.col("id").cast("bigint").alias("id"), F.col("depth"))


@query("WITH RECURSIVE w AS (SELECT DISTINCT docid, hash, urlkey FROM written_docs), e AS (SELECT DISTINCT a.docid AS x, b.docid AS y FROM w a JOIN w b ON a.hash = b.hash UNION SELECT a.docid, b.docid FROM w a JOIN w b ON a.urlkey = b.urlkey), r(id, y) AS (SELECT docid, docid FROM w UNION SELECT r.id, e.y FROM r JOIN e ON e.x = r.y) SELECT id, min(y) AS component FROM r GROUP BY id")
def copy_components(s: SparkSession, d: str) -> DataFrame:
    w = table(s, d, "written_docs").select("docid", "hash", "urlkey").distinct()
    by = w.where("hash is not null").groupBy("hash").agg(F.min("docid").alias("m"))
    bu = w.where("urlkey is not null").groupBy("urlkey").agg(F.min("docid").alias("m"))
    e = w.join(by, "hash").select(F.col("m").alias("src"), F.col("docid").alias("dst")).union(w.join(bu, "urlkey").select("m", "docid"))
    return G.components(e, w.select(F.col("docid").alias("id")))


# ---- events
@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def events_first_seen(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("f")).select("f.event_id", "user_id", "event_type")


@query("SELECT prev, event_type, count(*) AS n FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) WHERE prev IS NOT NULL GROUP BY ALL")
def event_transitions(s: SparkSession, d: str) -> DataFrame:
    prev = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(s, d, "events").select("event_type", prev.alias("prev")).where("prev is not null").groupBy("prev", "event_type").agg(F.count("*").alias("n"))


@query("WITH x AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), y AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM x) SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n FROM y GROUP BY ALL")
def event_sessions(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("ts") - F.lag("ts").over(w)
    x = table(s, d, "events").select("user_id", "ts", "event_id", F.when(gap <= F.expr("INTERVAL '30' MINUTE"), 0).otherwise(1).alias("new"))
    y = x.select("user_id", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("session"))
    return y.groupBy("user_id", "session").agg(F.count("*").alias("n"))


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_hours(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return e.groupBy("hour", "event_type").agg(F.count("*").alias("n"), r6(F.sum("value"), 4).alias("total"))


# ---- relational breadth
@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), r6(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT n_name, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def orders_by_nation(s: SparkSession, d: str) -> DataFrame:
    j = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(r6(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").join(table(s, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_mktsegment")


@query("SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY CUBE (c_mktsegment, o_orderpriority)")
def segment_cube(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).cube("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n"))


def _bag(name: str, op: str) -> None:
    a = "SELECT l_returnflag || l_linestatus AS k, l_linenumber AS x FROM lineitem WHERE l_quantity > 25"
    b = "SELECT l_returnflag || l_linestatus AS k, l_linenumber AS x FROM lineitem WHERE l_discount > 0.05"

    def run(s: SparkSession, d: str) -> DataFrame:
        li = table(s, d, "lineitem")
        x = li.where("l_quantity > 25").select(F.concat("l_returnflag", "l_linestatus").alias("k"), F.col("l_linenumber").alias("x"))
        y = li.where("l_discount > 0.05").select(F.concat("l_returnflag", "l_linestatus").alias("k"), F.col("l_linenumber").alias("x"))
        r = {"UNION ALL": x.unionAll(y), "INTERSECT ALL": x.intersectAll(y), "EXCEPT ALL": x.exceptAll(y)}[op]
        return r.groupBy("k", "x").agg(F.count("*").alias("n"))

    run.__name__ = name
    query(f"SELECT k, x, count(*) AS n FROM ({a} {op} {b}) GROUP BY ALL")(run)


_bag("multiset_union", "UNION ALL")
_bag("multiset_intersection", "INTERSECT ALL")
_bag("multiset_difference", "EXCEPT ALL")


# ---- page trees, languages by profile, stems
_PRE = "WITH f AS (SELECT docid, guid, urlkey AS url FROM (SELECT DISTINCT docid, guid, urlkey, arrived FROM written_docs WHERE urlkey IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY urlkey ORDER BY arrived, docid) = 1), s AS (SELECT docid, guid, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host, list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x != '') AS segs, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM f), k AS (SELECT docid, guid, host, segs[1:greatest(len(segs) - CASE WHEN q = '' THEN 1 ELSE 0 END, 0)] AS keep FROM s), d AS (SELECT docid, guid, host, unnest(['/' || array_to_string(keep[1:i], '/') for i in range(0, len(keep) + 1)]) AS node FROM k)"


@query(
    f"{_PRE}, n AS (SELECT host, node, count(*) AS n FROM d GROUP BY ALL), b AS (SELECT DISTINCT docguid AS guid, unnest(hashcodes) AS hash FROM text_blocks), x AS (SELECT d.*, b.hash FROM d JOIN (SELECT DISTINCT * FROM b) b USING (guid)), c AS (SELECT host, node, hash, count(*) AS c FROM x GROUP BY ALL), v AS (SELECT x.docid, x.hash, CASE WHEN c.c > n.n // 100 + 1 THEN 1 ELSE 0 END AS yes FROM x JOIN n USING (host, node) JOIN c USING (host, node, hash) WHERE n.n >= 5 OR x.node = '/') SELECT docid, hash, 2 * sum(yes) >= count(*) AS boilerplate FROM v GROUP BY docid, hash"
)
def url_tree_labels(s: SparkSession, d: str) -> DataFrame:
    w = table(s, d, "written_docs").where("urlkey is not null").select("docid", "guid", F.col("urlkey").alias("url"), "arrived")
    first = w.groupBy("url").agg(F.min(F.struct("arrived", "docid", "guid")).alias("f")).select("f.docid", "f.guid", "url")
    b = table(s, d, "text_blocks").select(F.col("docguid").alias("guid"), F.explode("hashcodes").alias("hash"))
    return W.tree_votes(first, b)


def _coded(s: SparkSession, d: str) -> DataFrame:
    """documents with lang as a code, whatever its spelling (code, region or name); null where it means none."""
    from ..functions import languages as L

    c = F.lower(F.regexp_extract(F.coalesce("lang", F.lit("")), r"^\s*([A-Za-z]{2})(?:[-_].*)?\s*$", 1))
    return table(s, d, "documents").withColumn("lang", F.coalesce(F.when(c != "", c), L.language_code(F.col("lang"))))


@query()
def language_profiles(s: SparkSession, d: str) -> DataFrame:
    from ..operators import langid

    return langid.profiles(_coded(s, d), "lang", "text")


@query()
def language_by_rank(s: SparkSession, d: str) -> DataFrame:
    from ..operators import langid

    docs = _coded(s, d)
    return langid.detect(docs.select("doc_id", "text"), langid.profiles(docs, "lang", "text"), "doc_id", "text")


@query()
def stem_frequencies(s: SparkSession, d: str) -> DataFrame:
    from ..functions.stemming import with_stems

    return with_stems(V.frequencies(_occ(s, d))).groupBy("stem").agg(F.sum("freq").alias("freq"), F.count("*").alias("forms"))
