"""Queries over sparse vectors, sets, graphs, models and their evaluation, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import clustering as C
from ..operators import evaluation as E
from ..operators import graph as G
from ..operators import models as M
from ..operators import sparse as S
from ..operators import trainers as R
from ..operators import vectors as V
from ..session import table
from .reference_queries import _EDGES, _KNN, _TF, _edges, _n, _occ, knn_confusion, r6
from .registry import registry

QUERIES, ORACLES, query = registry()

_W = "v AS (SELECT doc_id, term, tf * ln(n / df) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0)"
_L2 = f"WITH {_TF}, {_W}, l AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM v)"


def _weights(s: SparkSession, d: str) -> DataFrame:
    return V.weights(_occ(s, d), _n(s, d))


def _one_a_text(s: SparkSession, d: str) -> DataFrame:
    """Documents, one (the first) for each text."""
    x = table(s, d, "documents").where("text is not null")
    return x.groupBy(F.md5("text").alias("m")).agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))


_ONE = "u AS (SELECT min(doc_id) AS doc_id, any_value(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY md5(text)), occ AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM u), tf AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY ALL), voc AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL), n AS (SELECT count(*)::double AS n FROM u), l0 AS (SELECT doc_id, term, tf * ln(n / df) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0), l AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM l0)"


def _unit_texts(s: SparkSession, d: str) -> DataFrame:
    one = _one_a_text(s, d)
    return V.l2(V.weights(V.terms(one.select("doc_id", "text")), F.lit(one.count())))


@query(f"WITH {_ONE}, p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.w * b.w) AS s FROM l a JOIN l b USING (term) WHERE a.doc_id <= b.doc_id GROUP BY ALL) SELECT a, b, round(s, 6) AS s FROM p WHERE s > 0.5")
def similarity_self_join(s: SparkSession, d: str) -> DataFrame:
    return S.self_join(_unit_texts(s, d), 0.5, "doc_id").withColumn("s", r6("s"))


@query("WITH c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS representative FROM documents WHERE text IS NOT NULL) SELECT doc_id, representative FROM c")
def text_representatives(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "documents").where("text is not null").select("doc_id", F.md5("text").alias("m"))
    return x.join(x.groupBy("m").agg(F.min("doc_id").alias("representative")), "m").select("doc_id", "representative")


@query(f"{_L2} SELECT b.doc_id, round(sum(a.w * b.w), 6) AS s FROM l a JOIN l b USING (term) WHERE a.doc_id = (SELECT min(doc_id) FROM l) GROUP BY b.doc_id HAVING sum(a.w * b.w) > 0.1")
def inverted_index_dots(s: SparkSession, d: str) -> DataFrame:
    v = V.l2(_weights(s, d))
    first = v.agg(F.min("doc_id").alias("doc_id"))
    return S.dot_with_rows(v.join(first, "doc_id", "left_semi"), v, "doc_id", threshold=0.1).withColumn("s", r6("s"))


@query(f"WITH {_TF}, {_W}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(w, 9) DESC, term) AS r FROM v), t AS (SELECT doc_id, term, round(w, 9) AS w FROM r WHERE r <= 20), x AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY w, term ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY doc_id) AS a FROM t), y AS (SELECT *, min(CASE WHEN run >= a * 0.2 - 1e-12 THEN w END) OVER (PARTITION BY doc_id) AS lim FROM x), z AS (SELECT doc_id, term, w FROM y WHERE w >= lim) SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS w FROM z")
def trimmed_vectors(s: SparkSession, d: str) -> DataFrame:
    return S.trimmed(_weights(s, d).withColumn("w", F.round("w", 9)), 20, 0.2, "doc_id").withColumn("w", r6("w"))


@query(f"WITH {_TF}, {_W} SELECT doc_id, term, round(CASE WHEN max(w) OVER p = min(w) OVER p THEN 0 ELSE (w - min(w) OVER p) / (max(w) OVER p - min(w) OVER p) END, 6) AS w FROM v WINDOW p AS (PARTITION BY term)")
def min_max_weights(s: SparkSession, d: str) -> DataFrame:
    return S.min_max(_weights(s, d), "term").withColumn("w", r6("w"))


@query(f"WITH {_TF} SELECT doc_id, term, round(sqrt(tf), 6) AS w FROM tf WHERE tf > 1")
def mapped_weights(s: SparkSession, d: str) -> DataFrame:
    tf = _occ(s, d).groupBy("doc_id", "term").agg(F.count("*").alias("w"))
    return S.mapped(tf, lambda w: F.when(w > 1, F.round(F.sqrt(w), 6)))


_SRC = "WITH a AS (SELECT source, term, count(*) AS n FROM (SELECT source, unnest(regexp_extract_all(lower(title), '\\p{L}+')) AS term FROM documents WHERE title IS NOT NULL AND source IS NOT NULL) GROUP BY ALL), b AS (SELECT source, term, count(*) AS n FROM (SELECT source, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM documents WHERE text IS NOT NULL AND source IS NOT NULL) GROUP BY ALL)"


def _source_terms(s: SparkSession, d: str, col: str) -> DataFrame:
    x = table(s, d, "documents").where(F.col(col).isNotNull() & F.col("source").isNotNull())
    return x.select("source", F.explode(T.simple_tokens(F.lower(F.col(col)))).alias("term")).groupBy("source", "term").agg(F.count("*").alias("n"))


@query(f"{_SRC} SELECT source, term, CASE WHEN a.n IS NOT NULL AND b.n IS NOT NULL THEN greatest(a.n, b.n) ELSE coalesce(a.n, b.n) END AS n FROM a FULL JOIN b USING (source, term)")
def merged_source_terms(s: SparkSession, d: str) -> DataFrame:
    return S.merged(_source_terms(s, d, "title"), _source_terms(s, d, "text"), F.greatest, ["source", "term"], "n")


@query(f"{_SRC} SELECT source, round(sum(least(coalesce(a.n, 0), coalesce(b.n, 0)))::double / sum(greatest(coalesce(a.n, 0), coalesce(b.n, 0))), 6) AS jaccard FROM a FULL JOIN b USING (source, term) GROUP BY source")
def multiset_jaccard(s: SparkSession, d: str) -> DataFrame:
    return S.multiset_jaccard(_source_terms(s, d, "title"), _source_terms(s, d, "text"), "source", "term").withColumn("jaccard", r6("jaccard"))


@query(f"{_SRC} SELECT source, term, coalesce(b.n, 0) - coalesce(a.n, 0) AS n FROM a FULL JOIN b USING (source, term) WHERE coalesce(b.n, 0) - coalesce(a.n, 0) > 0")
def multiset_edits(s: SparkSession, d: str) -> DataFrame:
    return S.edited(_source_terms(s, d, "text"), _source_terms(s, d, "title").withColumn("n", -F.col("n")), ["source", "term"])


@query("WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '\\p{L}+')) AS a, list_distinct(regexp_extract_all(lower(title), '\\p{L}+')) AS b FROM documents WHERE text IS NOT NULL AND title IS NOT NULL) SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(a, b))), ' ') AS either, array_to_string(list_sort(list_intersect(a, b)), ' ') AS both_, array_to_string(list_sort(list_filter(b, lambda x: NOT list_contains(a, x))), ' ') AS only_title FROM t")
def set_operations(s: SparkSession, d: str) -> DataFrame:
    a, b = F.array_distinct(T.simple_tokens(F.lower(F.col("text")))), F.array_distinct(T.simple_tokens(F.lower(F.col("title"))))
    t = table(s, d, "documents").where("text is not null and title is not null").select("doc_id", a.alias("a"), b.alias("b"))
    sets = {"either": S.set_union, "both_": S.set_intersection, "only_title": lambda x, y: S.set_difference(y, x)}
    return t.select("doc_id", *[F.array_join(f(F.col("a"), F.col("b")), " ").alias(k) for k, f in sets.items()])


@query(f"{_EDGES} SELECT count(DISTINCT src) AS n_rows, count(DISTINCT dst) AS n_cols, count(*) AS n_values, (count(DISTINCT src) * count(DISTINCT dst) - count(*))::double / (count(DISTINCT src) * count(DISTINCT dst)) AS sparseness, min(dst) AS first_col, max(dst) AS last_col, (SELECT count(*) = 0 FROM e a FULL JOIN e b ON a.src = b.dst AND a.dst = b.src WHERE a.w IS DISTINCT FROM b.w) AS is_symmetric FROM e")
def matrix_shape(s: SparkSession, d: str) -> DataFrame:
    return S.shape(_edges(s, d), "src", "dst")


@query("SELECT s_suppkey - 1 AS id, s_nationkey AS nation FROM supplier UNION ALL SELECT c_custkey - 1 + (SELECT max(s_suppkey) FROM supplier), c_nationkey FROM customer")
def appended_rows(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "supplier").select((F.col("s_suppkey") - 1).alias("id"), F.col("s_nationkey").alias("nation"))
    b = table(s, d, "customer").select((F.col("c_custkey") - 1).alias("id"), F.col("c_nationkey").alias("nation"))
    return S.appended(a, b, "id")


@query("WITH a AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS p FROM (SELECT doc_id, regexp_extract_all(lower(title), '\\p{L}+') AS w FROM documents WHERE title IS NOT NULL)), b AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS p FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+') AS w FROM documents WHERE text IS NOT NULL)) SELECT same, count(*) AS n FROM (SELECT a.w = b.w AS same FROM a FULL JOIN b USING (doc_id, p)) GROUP BY same")
def zipped_tokens(s: SparkSession, d: str) -> DataFrame:
    def stream(c: str) -> DataFrame:
        return table(s, d, "documents").select("doc_id", F.posexplode(T.simple_tokens(F.lower(F.col(c)))).alias("pos", "word"))

    return S.zipped(stream("title"), stream("text"), "doc_id", "pos", "word").groupBy("same").agg(F.count("*").alias("n"))


@query("SELECT doc_id, coalesce(l.name, d.lang) AS lang FROM documents d LEFT JOIN langs l ON d.lang = l.lang")
def dictionary_lookup(s: SparkSession, d: str) -> DataFrame:
    return S.looked_up(table(s, d, "documents").select("doc_id", "lang"), table(s, d, "langs").select(F.col("lang").alias("code"), "name"), "lang", "code", "name")


@query("SELECT count(*) AS n, count(DISTINCT doc_id) AS n_ids, true AS is_permutation FROM documents")
def seeded_shuffle(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "documents").select("doc_id")
    x = S.shuffled(ids, "doc_id", 7)
    return x.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_ids"), (F.sum("doc_id") == ids.agg(F.sum("doc_id")).first()[0]).alias("is_permutation"))


@query(
    "WITH x AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS p FROM embeddings), c AS (SELECT label, list(v ORDER BY p) AS c FROM (SELECT label, p, avg(x) AS v FROM x GROUP BY ALL) GROUP BY label), s AS (SELECT a.label AS a, b.label AS b, list_dot_product(a.c, b.c) / (sqrt(list_dot_product(a.c, a.c)) * sqrt(list_dot_product(b.c, b.c))) AS s FROM c a, c b WHERE a.label < b.label) SELECT a, b, round(s, 6) AS s FROM s ORDER BY s DESC LIMIT 1"
)
def most_similar_labels(s: SparkSession, d: str) -> DataFrame:
    c = M.centroids(table(s, d, "embeddings"), "label", "embedding", "nrml2").select("label", F.col("pos").alias("term"), F.col("v").alias("w"))
    return S.most_similar(S.self_join(c, 1e-9, "label", diagonal=False)).withColumn("s", r6("s"))


@query(f"WITH {_TF}, nw AS (SELECT doc_id, unnest(regexp_extract_all(lower(title), '\\p{{L}}+')) AS term FROM documents WHERE title IS NOT NULL), t AS (SELECT doc_id, term, count(*) AS k FROM nw GROUP BY ALL) SELECT doc_id, term, round(k * ln(n / df), 6) AS w FROM t JOIN voc USING (term), n WHERE ln(n / df) != 0")
def titles_on_frozen_vocabulary(s: SparkSession, d: str) -> DataFrame:
    return S.projected(V.terms(table(s, d, "documents"), "title"), V.frequencies(_occ(s, d)), _n(s, d), "doc_id").withColumn("w", r6("w"))


@query(f"WITH {_TF} SELECT CAST(freq AS BIGINT) AS freq, count(*) AS n_terms FROM voc GROUP BY freq")
def frequency_histogram(s: SparkSession, d: str) -> DataFrame:
    return V.frequencies(_occ(s, d)).groupBy("freq").agg(F.count("*").alias("n_terms"))


@query(f"WITH {_TF}, v AS (SELECT doc_id, term, round(tf * ln(n / df), 9) AS w FROM tf JOIN voc USING (term), n WHERE ln(n / df) != 0) SELECT doc_id, string_agg(term, ', ' ORDER BY w DESC, term) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) AS r FROM v) WHERE r <= 5 GROUP BY doc_id")
def keyword_lists(s: SparkSession, d: str) -> DataFrame:
    k = V.keywords(_weights(s, d).withColumn("w", F.round("w", 9)), 5)
    return k.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("keywords"))


@query("WITH o AS (SELECT doc_id, unnest(w) AS form, generate_subscripts(w, 1) AS p FROM (SELECT doc_id, regexp_extract_all(text, '\\p{L}+') AS w FROM documents WHERE text IS NOT NULL)), c AS (SELECT lower(form) AS term, form, count(*) AS n, min(doc_id * 100000000 + p) AS fst FROM o GROUP BY ALL) SELECT term, form FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY n DESC, fst) AS r FROM c) WHERE r = 1")
def surface_forms(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "documents").select("doc_id", F.posexplode(T.simple_tokens(F.col("text"))).alias("pos", "form"))
    return V.best_forms(o, "doc_id", "pos", "form")


# ---- evaluation
@query(
    f"{_KNN}, c AS (SELECT e.label AS a, b.label AS p, count(*) AS n FROM b JOIN embeddings e ON e.vec_id = b.q_id WHERE r = 1 GROUP BY ALL), l AS (SELECT a AS label FROM c UNION SELECT p FROM c), x AS (SELECT label, coalesce((SELECT sum(n) FROM c WHERE a = label), 0)::double AS rn, coalesce((SELECT sum(n) FROM c WHERE p = label), 0)::double AS cn, coalesce((SELECT sum(n) FROM c WHERE a = label AND p = label), 0)::double AS dg FROM l), y AS (SELECT label, CASE WHEN cn = 0 THEN 1 ELSE dg / cn END AS pr, CASE WHEN rn = 0 THEN 1 ELSE dg / rn END AS rc FROM x) SELECT round((SELECT sum(dg) / sum(rn) FROM x), 6) AS micro, round(avg(pr), 6) AS macro_precision, round(avg(rc), 6) AS macro_recall, round(avg(CASE WHEN pr + rc = 0 THEN 0 ELSE 1.25::double * pr * rc / (0.25::double * pr + rc) END), 6) AS macro_f FROM y"
)
def knn_averages(s: SparkSession, d: str) -> DataFrame:
    a = E.averages(knn_confusion(s, d), 0.5)
    return a.select(*[r6(c).alias(c) for c in ("micro", "macro_precision", "macro_recall", "macro_f")])


@query(f"{_KNN} SELECT e.label AS actual, " + ", ".join(f"count(*) FILTER (WHERE b.label = {i}) AS l{i}" for i in range(10)) + " FROM b JOIN embeddings e ON e.vec_id = b.q_id WHERE r = 1 GROUP BY e.label")
def knn_pivot(s: SparkSession, d: str) -> DataFrame:
    p = E.pivoted(knn_confusion(s, d), list(range(10)))
    return p.select("actual", *[F.col(str(i)).alias(f"l{i}") for i in range(10)])


# ---- graphs
@query(f"{_EDGES} SELECT dst AS src, src AS dst, w FROM e")
def inverted_graph(s: SparkSession, d: str) -> DataFrame:
    return G.inverted(_edges(s, d))


@query(f"{_EDGES}, b AS (SELECT coalesce(a.src, b.dst) AS x, coalesce(a.dst, b.src) AS y, coalesce(a.w, 0) + coalesce(b.w, 0) AS w FROM (SELECT * FROM e WHERE src < dst) a FULL JOIN (SELECT * FROM e WHERE src > dst) b ON a.src = b.dst AND a.dst = b.src) SELECT x AS src, y AS dst, w FROM b UNION ALL SELECT y, x, w FROM b UNION ALL SELECT src, dst, w FROM e WHERE src = dst")
def symmetrised_graph(s: SparkSession, d: str) -> DataFrame:
    return G.symmetrised(_edges(s, d))


@query(f"{_EDGES}, v AS (SELECT src AS id FROM e UNION SELECT dst FROM e) SELECT (SELECT count(*) FROM v) AS n_vertices, count(*) AS n_edges, ((SELECT count(*) FROM v) ** 2 - count(*)) / (SELECT count(*) FROM v) ** 2 AS sparseness, bool_and(w > 0) AS is_positive, bool_and(w >= 0) AS is_non_negative, bool_or(src = dst) AS has_loops, (SELECT count(*) = 0 FROM e a FULL JOIN e b ON a.src = b.dst AND a.dst = b.src WHERE a.w IS DISTINCT FROM b.w) AS is_undirected FROM e")
def graph_predicates(s: SparkSession, d: str) -> DataFrame:
    return G.predicates(_edges(s, d))


@query(
    f"{_EDGES}, v AS (SELECT src AS id FROM e UNION SELECT dst FROM e), s AS (SELECT id, CASE WHEN id < 3 THEN 1 ELSE 0 END AS is_s FROM v), n AS (SELECT sum(is_s)::double AS n FROM s), p AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS p FROM e), r0 AS (SELECT id, is_s / n AS r FROM s, n), "
    + ", ".join(
        f"g{i} AS (SELECT s.id, is_s, coalesce(sum(r * p), 0.0::double) AS g FROM s LEFT JOIN p ON p.dst = s.id LEFT JOIN r{i} q ON q.id = p.src GROUP BY ALL), r{i + 1} AS MATERIALIZED (SELECT id, 0.85::double * (g + is_s * greatest(0, 1 - (SELECT sum(g) FROM g{i})) / n) + is_s * 0.15::double / n AS r FROM g{i}, n)"
        for i in range(40)
    )
    + " SELECT id, round(r, 4) AS rank FROM r40"
)
def personalised_pagerank(s: SparkSession, d: str) -> DataFrame:
    return G.ranked(_edges(s, d), s.range(3), eps=1e-7).select("id", r6("rank", 4).alias("rank"))


@query()
def simrank_nations(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "nation").select(F.col("n_nationkey").alias("src"), (F.col("n_regionkey") + 100).alias("dst"))
    return G.simrank(e, 3).select("a", "b", r6("sim").alias("sim"))


# ---- models
@query()
def maxent_labels(s: SparkSession, d: str) -> DataFrame:
    lab = table(s, d, "labels").groupBy("doc_id").agg(F.min("quality").alias("label"))
    x = table(s, d, "documents").where("title is not null").join(lab, "doc_id").select(F.col("doc_id").alias("row"), "label", F.explode(F.array_distinct(T.simple_tokens(F.lower(F.col("title"))))).alias("feature"))
    lam = R.maxent(x.where("label is not null"), rounds=10)
    return R.maxent_predict(x.select("row", "feature"), lam).select("row", "label", r6("p", 4).alias("p"))


@query()
def batch_centroid_vectors(s: SparkSession, d: str) -> DataFrame:
    return R.batch_centroids(table(s, d, "embeddings"), "label", "embedding", "vec_id", rounds=5).withColumn("v", r6("v", 4))


@query()
def bisected_vectors(s: SparkSession, d: str) -> DataFrame:
    return R.bisecting(table(s, d, "embeddings"), "vec_id", "embedding", quality=0.3)


@query()
def kmeans_best_trial(s: SparkSession, d: str) -> DataFrame:
    return M.kmeans_trials(table(s, d, "embeddings"), "vec_id", "embedding", 10, trials=2).select("vec_id", "cluster", r6("score").alias("score"))


@query()
def agglomerated_vectors(s: SparkSession, d: str) -> DataFrame:
    return C.agglomerative(table(s, d, "embeddings"), "vec_id", "embedding", 12)


@query()
def topics_over_batches(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings").withColumn("batch", F.pmod("vec_id", F.lit(4)).cast("int"))
    return C.incremental_topics(e, "vec_id", "embedding", "batch", window=2)


@query()
def svm_scores(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings").withColumn("y", (F.col("label") < 5).cast("int"))
    m = C.LinearSvm("vec_id", "embedding", "y").fit(e)
    return m.predict(e).select("vec_id", "predicted", r6("score", 3).alias("score"))


@query()
def svm_feature_ranks(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings").withColumn("y", (F.col("label") < 5).cast("int"))
    return C.LinearSvm("vec_id", "embedding", "y").fit(e).feature_ranks(s).withColumn("score", r6("score", 6))


@query()
def svm_multiclass(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    return C.one_vs_rest(e, e, "vec_id", "embedding", "label").select("vec_id", "predicted")


@query("WITH x AS (SELECT l_quantity AS q, l_discount AS f, l_extendedprice AS y FROM lineitem), m AS (SELECT sum(q * q) AS a, sum(q * f) AS b, sum(f * f) AS c, sum(q * y) AS u, sum(f * y) AS v FROM x) SELECT unnest(['l_discount', 'l_quantity']) AS feature, unnest([round((a * v - b * u) / (a * c - b * b), 3), round((c * u - b * v) / (a * c - b * b), 3)]) AS weight FROM m")
def least_squares(s: SparkSession, d: str) -> DataFrame:
    w = C.least_squares(table(s, d, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")
    return w.withColumn("weight", r6("weight", 3))


@query()
def hierarchical_categories(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings").withColumn("path", F.concat(F.when(F.col("label") < 5, "low").otherwise("high"), F.lit("/"), F.col("label").cast("string")))
    return C.categorise(e, e, "vec_id", "embedding", "path")
