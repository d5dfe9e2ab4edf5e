"""Queries of the general data operators: timestamps and compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import compaction, timestamps
from ..session import table


def p3_found(s: SparkSession, d: str) -> DataFrame:
    return timestamps.stamps_utc(table(s, d, "written_docs"), table(s, d, "sites"))


def p3_zones(s: SparkSession, d: str) -> DataFrame:
    return timestamps.zone_report(table(s, d, "written_docs"), table(s, d, "sites"))


def p7_found(s: SparkSession, d: str) -> DataFrame:
    return compaction.repeated_records(table(s, d, "small_files"))


def p7_journal(s: SparkSession, d: str) -> DataFrame:
    return compaction.plan_merges(table(s, d, "small_files"))[0].select("txn_id", "level", "output_id", "output_bytes", "n_inputs")


def p7_tiers(s: SparkSession, d: str) -> DataFrame:
    return compaction.tier_report(table(s, d, "small_files"))


QUERIES = {f.__name__: f for f in (p3_found, p3_zones, p7_found, p7_journal, p7_tiers)}
ORACLES = {
    "p7_tiers": "SELECT CAST(floor(ln(greatest(b, 1)::double) / ln(16.0::double)) AS INT) AS tier, count(*) AS n_files, CAST(sum(b) AS BIGINT) AS n_bytes FROM (SELECT coalesce(greatest(n_bytes, 0), 0) AS b FROM small_files) GROUP BY 1",
}
