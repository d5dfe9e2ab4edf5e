"""Documents with features and span annotations: selection, text of spans, containment, type trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def annotations_of(docs: DataFrame, row: str = "docid") -> DataFrame:
    """row, ann_no, spanstart, spanend (inclusive), type, features, block: the span's text."""
    a = docs.select(row, "text", F.posexplode("annotations").alias("ann_no", "a")).select(row, "ann_no", "text", "a.*")
    block = F.substring(F.col("text"), F.col("spanstart") + 1, F.col("spanend") - F.col("spanstart") + 1)
    return a.withColumn("block", block).drop("text")


def select_type(ann: DataFrame, selector: str) -> DataFrame:
    """Annotations whose type begins with the selector."""
    return ann.where(F.col("type").startswith(selector))


def contained(inner: DataFrame, outer: DataFrame, row: str = "docid", bucket: int = 4096) -> DataFrame:
    """row, inner_no, outer_no of inner spans that lie within outer ones; long documents are split by span buckets."""
    i = inner.select(row, F.col("ann_no").alias("inner_no"), F.col("spanstart").alias("s1"), F.col("spanend").alias("e1"), F.floor(F.col("spanstart") / bucket).alias("k"))
    o = outer.select(row, F.col("ann_no").alias("outer_no"), F.col("spanstart").alias("s2"), F.col("spanend").alias("e2"))
    o = o.withColumn("k", F.explode(F.sequence(F.floor(F.col("s2") / bucket), F.floor(F.col("e2") / bucket))))
    return i.join(o, [row, "k"]).where("s1 >= s2 and e1 <= e2").select(row, "inner_no", "outer_no")


def type_tree(ann: DataFrame, col: str) -> DataFrame:
    """node, n: how many values lie at or below every prefix of a slash-separated column."""
    parts = F.split(F.col(col), "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return ann.where(F.col(col).isNotNull()).select(F.explode(prefixes).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
