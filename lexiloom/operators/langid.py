"""Language identification by rank-ordered n-gram profiles (out-of-place distance), in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUT_OFF = 500


def profile_grams(text: Column, n_max: int = 2) -> Column:
    """N-grams of the upper-case alphabetic tokens of a text; from n = 2 on tokens are padded with _ on both sides."""
    toks = F.regexp_extract_all(F.upper(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1))
    def slid(n: int) -> Column:
        def one(t: Column) -> Column:
            w = t if n == 1 else F.concat(F.lit("_"), t, F.lit("_" * (n - 1)))
            return F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substring(w, i, F.lit(n)))

        return F.flatten(F.transform(toks, one))

    out = F.concat(*[slid(n) for n in range(1, n_max + 1)])
    return out


def ranked(grams: DataFrame, group: str, cut_off: int = CUT_OFF) -> DataFrame:
    """group, gram, rank: competition ranks by count, the first cut_off grams of each group (ties by gram)."""
    c = grams.groupBy(group, "gram").agg(F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"))
    r = c.withColumn("rank", F.rank().over(w)).withColumn("pos", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "gram")))
    return r.where(F.col("pos") <= cut_off).select(group, "gram", "rank")


def profiles(docs: DataFrame, lang: str, text: str, n_max: int = 2) -> DataFrame:
    """lang, gram, rank of labelled texts: at most cut_off rows per language."""
    return ranked(docs.where(F.col(lang).isNotNull()).select(lang, F.explode(profile_grams(F.col(text), n_max)).alias("gram")), lang)


def detect(docs: DataFrame, prof: DataFrame, row: str, text: str, lang: str = "lang", n_max: int = 2, cut_off: int = CUT_OFF) -> DataFrame:
    """row, lang, distance: the profile with the smallest sum of rank differences; texts without letters have no row.

    The distance is absolute. A gram that a profile lacks costs min(cut_off, size of the profile); ties go to the first language.
    """
    d = ranked(docs.select(row, F.explode(profile_grams(F.col(text), n_max)).alias("gram")), row, cut_off)
    size = prof.groupBy(lang).agg(F.least(F.lit(cut_off), F.count("*")).alias("penalty"))
    mine = d.groupBy(row).agg(F.count("*").alias("n"))
    hit = d.join(prof.select(lang, "gram", F.col("rank").alias("pr")), "gram").join(F.broadcast(size), lang)
    part = hit.groupBy(row, lang).agg(F.sum(F.abs(F.col("rank") - F.col("pr"))).alias("s"), F.count("*").alias("k"))
    allp = mine.join(F.broadcast(size))  # texts by languages
    dist = allp.join(part, [row, lang], "left").select(row, lang, (F.coalesce("s", F.lit(0)) + (F.col("n") - F.coalesce("k", F.lit(0))) * F.col("penalty")).alias("distance"))
    return dist.groupBy(row).agg(F.min_by(F.struct(lang, "distance"), F.struct("distance", lang)).alias("b")).select(row, f"b.{lang}", "b.distance")
