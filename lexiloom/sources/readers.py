"""Readers and writers of the corpus formats, as batch or stream DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORPUS_SCHEMA = "Name string, Text string, Annotations struct<Annotation: array<struct<Id: string, SpanStart: int, SpanEnd: int, Type: string, Features: struct<Feature: array<struct<Name: string, Value: string>>>>>>, Features struct<Feature: array<struct<Name: string, Value: string>>>"


def _features(c):
    return F.map_from_entries(F.coalesce(F.transform(F.filter(c["Feature"], lambda f: f["Name"].isNotNull()), lambda f: F.struct(f["Name"].alias("a"), f["Value"].alias("b"))), F.array().cast("array<struct<a:string,b:string>>")))


def read_corpus_xml(spark: SparkSession, path: str) -> DataFrame:
    """name, text, features, annotations of the <Document> elements of XML files (plain or gzip)."""
    x = spark.read.format("xml").option("rowTag", "Document").schema(CORPUS_SCHEMA).load(path)
    ann = F.transform(F.col("Annotations.Annotation"), lambda a: F.struct(a["SpanStart"].alias("spanstart"), a["SpanEnd"].alias("spanend"), a["Type"].alias("type"), _features(a["Features"]).alias("features")))
    return x.select(F.col("Name").alias("name"), F.col("Text").alias("text"), _features(F.col("Features")).alias("features"), F.coalesce(ann, F.array().cast("array<struct<spanstart:int,spanend:int,type:string,features:map<string,string>>>")).alias("annotations"))


def read_line_documents(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """name, text: one document per line; if named, the first blank-delimited token is the name."""
    t = spark.read.text(path)
    if not named:
        return t.select(F.lit(None).cast("string").alias("name"), F.col("value").alias("text"))
    return t.select(F.regexp_extract("value", r"^\s*(\S+)", 1).alias("name"), F.regexp_extract("value", r"^\s*\S+\s?(.*)$", 1).alias("text"))


def read_svmlight(spark: SparkSession, path: str) -> DataFrame:
    """label, idx, val of `label idx:val ...` lines; # starts a comment; indices stay as written."""
    t = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"#.*$", "")).alias("v")).where("v != ''")
    parts = F.slice(F.split("v", r"\s+"), 2, 1_000_000)
    return t.select(F.element_at(F.split("v", r"\s+"), 1).cast("double").alias("label"), F.transform(parts, lambda p: F.element_at(F.split(p, ":"), 1).cast("int")).alias("idx"), F.transform(parts, lambda p: F.element_at(F.split(p, ":"), 2).cast("double")).alias("val"))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """word, lemma, tag, freq of tab-separated lines; frequencies are at least 0.1."""
    x = spark.read.csv(path, sep="\t", schema="word string, lemma string, tag string, freq double", mode="PERMISSIVE")
    return x.withColumn("freq", F.greatest(F.coalesce("freq", F.lit(0.1)), F.lit(0.1)))


def write_dated(docs: DataFrame, path: str, time: str = "time") -> None:
    """Documents as Parquet by day, so that a lookup by time and key reads one folder."""
    docs.withColumn("day", F.to_date(time)).repartition("day").write.mode("append").partitionBy("day").parquet(path)


def lookup(spark: SparkSession, path: str, day: str, key: str, value: str) -> DataFrame:
    """Documents of one day with a key; partition pruning keeps all other days unread."""
    return spark.read.parquet(path).where((F.col("day") == F.lit(day).cast("date")) & (F.col(key) == value))


def write_arff(rows: DataFrame, path: str, relation: str, features: list[str], label: str) -> None:
    """Rows as ARFF text; a label with commas gives one row per part. One header file line set, then data lines."""
    x = rows.withColumn(label, F.explode(F.split(label, ",")))
    classes = sorted(r[0] for r in x.select(label).distinct().collect() if r[0] is not None)  # the header lists them
    head = [f"@RELATION {relation}", *[f"@ATTRIBUTE {f} NUMERIC" for f in features], "@ATTRIBUTE class {" + ",".join(classes) + "}", "@DATA"]
    spark = rows.sparkSession
    spark.createDataFrame([(h,) for h in head], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")
    x.select(F.concat_ws(",", *[F.coalesce(F.col(f).cast("string"), F.lit("?")) for f in features], label).alias("value")).write.mode("overwrite").text(f"{path}/data")
