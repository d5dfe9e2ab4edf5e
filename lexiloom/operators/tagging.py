"""Lemmas by ripple-down suffix rules and tags by longest known suffix, as tables and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _common_prefix(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    return F.coalesce(F.array_max(F.filter(F.sequence(F.lit(0), n), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))), F.lit(0))


def suffix_rules(lexicon: DataFrame) -> DataFrame:
    """suffix, cut, add: for every suffix of the lexicon's words the heaviest rule; rules that a shorter suffix gives anyway go.

    lexicon: word, lemma, freq. A rule cuts the word's rest after the common prefix and adds the lemma's rest.
    """
    k = _common_prefix(F.col("word"), F.col("lemma"))
    x = lexicon.where("word is not null and lemma is not null").select("word", "freq", (F.length("word") - k).alias("cut"), F.substring(F.col("lemma"), k + 1, F.length("lemma")).alias("add"))
    suffix = F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.right(F.col("word"), i))
    s = x.select("cut", "add", "freq", F.explode(suffix).alias("suffix")).where(F.length("suffix") >= F.col("cut"))
    w = s.groupBy("suffix", "cut", "add").agg(F.sum("freq").alias("w"))
    best = w.groupBy("suffix").agg(F.max_by(F.struct("cut", "add"), F.struct("w", -F.col("cut"), "add")).alias("r")).select("suffix", "r.cut", "r.add")
    up = best.select(F.col("suffix").alias("parent"), F.col("cut").alias("pc"), F.col("add").alias("pa"))
    j = best.withColumn("parent", F.when(F.length("suffix") > 0, F.expr("right(suffix, length(suffix) - 1)"))).join(up, "parent", "left")
    return j.where(F.col("pc").isNull() | (F.col("cut") != F.col("pc")) | (F.col("add") != F.col("pa"))).select("suffix", "cut", "add")


def lemmas(words: DataFrame, rules: DataFrame, col: str = "word") -> DataFrame:
    """word, lemma of the distinct words: the rule of the longest suffix; words without rule are their own lemma."""
    d = words.select(F.col(col).alias("word")).where("word is not null").distinct()
    s = d.select("word", F.explode(F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.right(F.col("word"), i))).alias("suffix"))
    hit = s.join(rules, "suffix").where(F.length("word") >= F.col("cut")).groupBy("word").agg(F.max_by(F.struct("cut", "add"), F.length("suffix")).alias("r"))
    j = d.join(hit, "word", "left")
    return j.select("word", F.when(F.col("r").isNull(), F.col("word")).otherwise(F.concat(F.expr("left(word, length(word) - r.cut)"), F.col("r.add"))).alias("lemma"))


def suffix_tags(tagged: DataFrame) -> DataFrame:
    """suffix, tags, best: the tags seen with every suffix (sorted) and the most frequent one; tagged: word, tag."""
    s = tagged.select("tag", F.explode(F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.right(F.lower("word"), i))).alias("suffix"))
    c = s.groupBy("suffix", "tag").agg(F.count("*").alias("n"))
    return c.groupBy("suffix").agg(F.sort_array(F.collect_set("tag")).alias("tags"), F.max_by("tag", F.struct("n", "tag")).alias("best"))


def ambiguity_class(words: DataFrame, model: DataFrame) -> DataFrame:
    """word, cls, best: the tags of the longest known suffix joined by _, and its most frequent tag."""
    d = words.select("word").distinct()
    s = d.select("word", F.explode(F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.right(F.lower("word"), i))).alias("suffix"))
    hit = s.join(model, "suffix").groupBy("word").agg(F.max_by(F.struct(F.array_join("tags", "_").alias("cls"), "best"), F.length("suffix")).alias("b"))
    return d.join(hit, "word", "left").select("word", "b.cls", "b.best")


def context_features(tokens: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, pos, features: words and their 1-4 letter ends of the positions around each token; tokens: doc_id, pos, word."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    parts = []
    for k in range(-width, width + 1):
        word = F.lower(F.lag("word", abs(k)).over(w) if k < 0 else F.lead("word", k).over(w) if k > 0 else F.col("word"))
        parts.append(F.concat(F.lit(f"w{k}="), F.coalesce(word, F.lit("|"))))
        for n in range(1, 5):
            parts += [F.concat(F.lit(f"p{k}.{n}="), F.left(word, F.lit(n))), F.concat(F.lit(f"s{k}.{n}="), F.right(word, F.lit(n)))]
    return tokens.select("doc_id", "pos", F.array_compact(F.array(*parts)).alias("features"))
