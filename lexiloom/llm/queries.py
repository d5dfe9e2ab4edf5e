"""The queries of this package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from . import abuse, article, bpe, encoding, language, mixing, repeats, sitelines


def _news(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "news_documents")


def _written(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "written_docs")


def p1_found(s: SparkSession, d: str) -> DataFrame:
    return language.label_segments(_news(s, d), table(s, d, "langs")).where("bad").select("docid", "seg_no", "lang")


def p1_segments(s: SparkSession, d: str) -> DataFrame:
    return language.label_segments(_news(s, d), table(s, d, "langs")).drop("bad")


def p1_documents(s: SparkSession, d: str) -> DataFrame:
    return language.document_languages(_news(s, d), table(s, d, "langs"))


def p2_found(s: SparkSession, d: str) -> DataFrame:
    return repeats.find_repeats(_news(s, d), _written(s, d))


def p2_newest(s: SparkSession, d: str) -> DataFrame:
    return repeats.newest_batch_repeats(_news(s, d), _written(s, d))


def p4_found(s: SparkSession, d: str) -> DataFrame:
    return encoding.garbled_lines(_news(s, d), _written(s, d)).select("docid", "line_no")


def p4_repaired(s: SparkSession, d: str) -> DataFrame:
    return encoding.repaired_lines(_news(s, d), _written(s, d))


def p5_found(s: SparkSession, d: str) -> DataFrame:
    return article.furniture_lines(_news(s, d))


def p5_sizes(s: SparkSession, d: str) -> DataFrame:
    return article.body_sizes(_news(s, d), _written(s, d))


def p6_found(s: SparkSession, d: str) -> DataFrame:
    return sitelines.repeated_lines(_news(s, d), _written(s, d), table(s, d, "sites"))


def p6_texts(s: SparkSession, d: str) -> DataFrame:
    return sitelines.without_repeated_lines(_news(s, d), _written(s, d), table(s, d, "sites"))


def p8_ids(s: SparkSession, d: str) -> DataFrame:
    return bpe.token_ids(table(s, d, "documents"))


def p9_mix(s: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(s, d, "documents"), table(s, d, "source_targets"))


def p9_shares(s: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(table(s, d, "documents"), table(s, d, "source_targets"))


def _abuse(s: SparkSession, d: str) -> tuple[DataFrame, abuse.AbuseModel]:
    docs = table(s, d, "documents")
    return docs, abuse.fitted(docs, table(s, d, "labels"))


def p10_found(s: SparkSession, d: str) -> DataFrame:
    return abuse.abusive(*_abuse(s, d))


def p10_scores(s: SparkSession, d: str) -> DataFrame:
    return abuse.abuse_scores(*_abuse(s, d))


def p10_rates(s: SparkSession, d: str) -> DataFrame:
    return abuse.abuse_rates(*_abuse(s, d))


def p10_heldout(s: SparkSession, d: str) -> DataFrame:
    return abuse.held_out(table(s, d, "documents"), table(s, d, "labels"))


QUERIES = {f.__name__: f for f in (p1_found, p1_segments, p1_documents, p2_found, p2_newest, p4_found, p4_repaired, p5_found, p5_sizes, p6_found, p6_texts, p8_ids, p9_mix, p9_shares, p10_found, p10_scores, p10_rates, p10_heldout)}
ORACLES: dict[str, str] = {}
