"""Packing many tiny files into few files of good size, each distinct record once.

Size-tiered: a file of tier t holds about fanout**t bytes. Level by level, the files of a tier are merged in groups of fanout
into files of the next tiers until they reach the target size. Every merge is one transaction of a journal (inputs, output), which
retires its inputs; its id is a hash of its inputs, so a repeated or resumed run recognises what is done and does nothing twice.
"""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, shared_dir, stored

TARGET_BYTES = 128 << 20
FANOUT = 16


def _value(c: Column, name: str) -> Column:
    v = F.regexp_extract(c, rf"<Name>\s*{name}\s*</Name>\s*<Value>\s*([^<]*?)\s*</Value>", 1)
    return F.when(v == "", None).otherwise(v)


def records_of(files: DataFrame) -> DataFrame:
    """file_id, rec_no, record, guid, rev: the complete <Document> elements of each payload, counted from 0.

    A null or empty payload has none; a cut-off element is none. guid is compared without case and dashes.
    """
    parts = F.filter(F.split(F.col("payload"), r"<Document(?=[\s>])"), lambda x: x.contains("</Document>"))
    whole = F.transform(parts, lambda x: F.concat(F.lit("<Document"), F.substring_index(x, "</Document>", 1), F.lit("</Document>")))
    r = files.select("file_id", F.posexplode(whole).alias("rec_no", "record"))
    guid = F.regexp_replace(F.lower(_value(F.col("record"), "guid")), r"[^0-9a-z]", "")
    return r.select("file_id", "rec_no", "record", F.when(guid != "", guid).alias("guid"), _value(F.col("record"), "rev").alias("rev"))


def superseded(records: DataFrame) -> DataFrame:
    """file_id, rec_no of the records whose guid and rev an earlier record (file_id, then rec_no) has already.

    Records without guid equal no other. A missing rev equals a missing rev. The first of each key comes from a map-side
    combined minimum over keys that occur twice; the join behind it moves ids only, so AQE can split a hot key.
    """
    keyed = records.where("guid is not null").select("file_id", "rec_no", F.xxhash64("guid", F.coalesce("rev", F.lit("\0"))).alias("k"), "guid", "rev")
    first = keyed.groupBy("k", "guid", "rev").agg(F.min(F.struct("file_id", "rec_no")).alias("first"), F.count("*").alias("n")).where("n > 1")
    j = keyed.join(first.select("k", F.col("guid").alias("g2"), F.col("rev").alias("r2"), "first"), "k").where((F.col("guid") == F.col("g2")) & F.col("rev").eqNullSafe(F.col("r2")))
    return j.where(F.struct("file_id", "rec_no") > F.col("first")).select("file_id", "rec_no").distinct()


def plan_merges(files: DataFrame, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT, across: bool = True) -> tuple[DataFrame, DataFrame]:
    """The journal of the merges and the final place of every file, from file_id and n_bytes alone.

    journal: txn_id, level, output_id, output_bytes, n_inputs, inputs (at most a few times fanout ids). places: file_id, output_id.
    Groups come from a hash of the id into ceil(bytes of the tier / size of a group) bins, so no tier passes through one task.
    A tier's totals are at most 64 rows. Missing sizes count as 0. Levels number at most log_fanout(target / smallest). across: whether
    the few files that are left of different tiers are merged with each other in the end.
    """
    cur = files.select(F.col("file_id").cast("string").alias("id"), F.coalesce(F.greatest(F.col("n_bytes"), F.lit(0)), F.lit(0)).cast("long").alias("b")).dropDuplicates(["id"])
    places = cur.select(F.col("id").alias("file_id"), F.col("id").alias("output_id"))
    journal, level = None, 0
    for level in range(1, max(2, math.ceil(math.log(max(target_bytes, 2), fanout)) + 2)):
        tier = F.floor(F.log(float(fanout), F.greatest(F.col("b"), F.lit(1)).cast("double"))).cast("int")
        t = cur.withColumn("tier", tier).where(F.col("b") < target_bytes)
        sums = {r["tier"]: (r["n"], r["s"]) for r in t.groupBy("tier").agg(F.count("*").alias("n"), F.sum("b").alias("s")).collect()}
        bins = {k: max(1, math.ceil(n / fanout), math.ceil(s / target_bytes)) for k, (n, s) in sums.items()}
        if sum(n for n, _ in sums.values()) <= 1 or all(b >= n for b, (n, _) in zip(bins.values(), sums.values(), strict=True)):
            if len(bins) <= 1 or not across:
                break
            # few are left in each tier: the tiers themselves are merged
            bins = dict.fromkeys(bins, max(1, math.ceil(sum(s for _, s in sums.values()) / target_bytes)))
            t = t.withColumn("tier", F.lit(-1))
            bins[-1] = next(iter(bins.values()))
        if not bins:
            break
        nb = F.create_map(*[F.lit(x) for kv in bins.items() for x in kv])
        g = t.withColumn("bin", F.pmod(F.xxhash64("id", F.lit(level)), F.element_at(nb, F.col("tier"))))
        txn = g.groupBy("tier", "bin").agg(F.sort_array(F.collect_list("id")).alias("inputs"), F.sum("b").alias("output_bytes"), F.count("*").alias("n_inputs")).where("n_inputs > 1")
        txn = txn.select(F.md5(F.concat_ws(",", F.lit(str(level)), F.array_join("inputs", ","))).alias("txn_id"), F.lit(level).alias("level"), "output_bytes", "n_inputs", "inputs")
        txn = cut(txn.withColumn("output_id", F.concat(F.lit(f"L{level}-"), F.substring("txn_id", 1, 16))))
        moved = txn.select("output_id", "output_bytes", F.explode("inputs").alias("id"))
        places = places.join(moved.select(F.col("id").alias("output_id"), F.col("output_id").alias("next")), "output_id", "left").select("file_id", F.coalesce("next", "output_id").alias("output_id"))
        places = cut(places)
        cur = cut(cur.join(moved.select("id"), "id", "left_anti").select("id", "b").unionByName(txn.select(F.col("output_id").alias("id"), F.col("output_bytes").alias("b"))))
        journal = txn if journal is None else journal.unionByName(txn)
    if journal is None:
        journal = cur.where("false").select(F.col("id").alias("txn_id"), F.lit(0).alias("level"), F.col("b").alias("output_bytes"), F.lit(0).cast("long").alias("n_inputs"), F.array("id").alias("inputs"), F.col("id").alias("output_id"))
    return journal, places


_JOURNAL = "txn_id string, level int, output_id string, output_bytes long, n_inputs long, inputs array<string>"
_DATA = "file_id long, rec_no int, record string, guid string, rev string, output_id string"


def _runs(spark: SparkSession, out_dir: str) -> list[int]:
    """The numbers of the committed runs: those whose part of the journal was written to the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/journal/run=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(int(f.getPath().getParent().getName()[4:]) for f in found)


def journal_of(spark: SparkSession, out_dir: str) -> DataFrame:
    """All committed transactions; what a broken run left behind doesn't count."""
    paths = [f"{out_dir}/journal/run={n}" for n in _runs(spark, out_dir)]
    return spark.read.schema(_JOURNAL).parquet(*paths) if paths else spark.createDataFrame([], _JOURNAL)


def live_outputs(spark: SparkSession, out_dir: str) -> DataFrame:
    """output_id, output_bytes of the committed outputs that no committed transaction has merged further."""
    j = journal_of(spark, out_dir)
    return j.join(j.select(F.explode("inputs").alias("output_id")), "output_id", "left_anti").select("output_id", "output_bytes")


def live_records(spark: SparkSession, out_dir: str) -> DataFrame:
    """file_id, rec_no, record, guid, rev, output_id: the packed records, each distinct one once. Retired and orphaned outputs are not read."""
    if not _runs(spark, out_dir):
        return spark.createDataFrame([], _DATA)
    return spark.read.schema(_DATA).parquet(f"{out_dir}/data").join(live_outputs(spark, out_dir).select("output_id"), "output_id", "left_semi")


def run_compaction(files: DataFrame, out_dir: str, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT, across: bool = False) -> DataFrame:
    """Packs the files that no committed transaction has taken yet, and the outputs their tiers draw in; returns this run's transactions.

    Every transaction's inputs are retired by the journal entry that names its output, so a record is live in one output at any time. A
    run plans over unconsumed files and live outputs only, writes only the outputs it plans, and counts once its part of the journal is
    complete: a run broken off before is repeated, and what it wrote is never read. Files that stay alone in their tier wait (across:
    they are merged over tiers). A file's later rows under the same id are the same file. Records whose guid and rev are stored already,
    or occur earlier in the same run (file_id, then rec_no), are not written again.
    """
    spark = files.sparkSession
    runs = _runs(spark, out_dir)
    old = journal_of(spark, out_dir)
    size = F.coalesce(F.col("n_bytes"), F.octet_length("payload").cast("long"))
    new = files.select(F.col("file_id").cast("string").alias("file_id"), size.alias("n_bytes")).join(old.select(F.explode("inputs").alias("file_id")), "file_id", "left_anti")
    new = stored(new, "files")
    outputs = live_outputs(spark, out_dir).where(F.col("output_bytes") < target_bytes).select(F.col("output_id").alias("file_id"), F.col("output_bytes").alias("n_bytes"))
    if new.isEmpty():
        return old.where("false")
    journal, places = plan_merges(new.unionByName(outputs), target_bytes, fanout, across)
    journal = stored(journal, "journal")
    if journal.isEmpty():
        return journal
    moved = places.where("file_id != output_id")
    fresh = records_of(files.join(moved.select(F.col("file_id").try_cast("long").alias("file_id")), "file_id", "left_semi")).dropDuplicates(["file_id", "rec_no"])
    fresh = stored(fresh, "records")
    gone = superseded(fresh).unionByName(_known(fresh, live_records(spark, out_dir))).distinct() if runs else superseded(fresh)
    kept = fresh.join(gone, ["file_id", "rec_no"], "left_anti").withColumn("id", F.col("file_id").cast("string"))
    again = live_records(spark, out_dir).withColumnRenamed("output_id", "id").where(F.col("id").startswith("L"))
    body = kept.unionByName(again).join(moved.select(F.col("file_id").alias("id"), "output_id"), "id").drop("id")
    w = body.repartition("output_id").sortWithinPartitions("output_id", "file_id", "rec_no")
    w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("output_id").parquet(f"{out_dir}/data")
    journal.select(*[x.split()[0] for x in _JOURNAL.split(", ")]).write.mode("overwrite").parquet(f"{out_dir}/journal/run={max(runs, default=0) + 1}")
    return journal


def _known(fresh: DataFrame, stored_: DataFrame) -> DataFrame:
    """file_id, rec_no of the fresh records whose guid and rev are stored already."""
    have = stored_.where("guid is not null").select(F.xxhash64("guid", F.coalesce("rev", F.lit("\0"))).alias("k"), F.col("guid").alias("g2"), F.col("rev").alias("r2"))
    k = fresh.where("guid is not null").withColumn("k", F.xxhash64("guid", F.coalesce("rev", F.lit("\0"))))
    return k.join(have, (k.k == have.k) & (F.col("guid") == F.col("g2")) & F.col("rev").eqNullSafe(F.col("r2")), "left_semi").select("file_id", "rec_no")


def repeated_records(files: DataFrame, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT) -> DataFrame:
    """file_id, rec_no of the complete records that a compaction of all files into a new store did not keep.

    A file that is the only one stays where it is and its records are kept but for repeats within it.
    """
    spark = files.sparkSession
    out = os.path.join(shared_dir(spark), f"packed-{uuid.uuid4().hex}")
    journal = run_compaction(files, out, target_bytes, fanout, across=True)
    r = records_of(files).select("file_id", F.col("rec_no").cast("int").alias("rec_no"), "guid", "rev").dropDuplicates(["file_id", "rec_no"])
    alone = r.join(journal.select(F.explode("inputs").alias("f")).select(F.col("f").try_cast("long").alias("file_id")).where("file_id is not null"), "file_id", "left_anti")
    packed = r.join(alone.select("file_id").distinct(), "file_id", "left_anti").join(live_records(spark, out).select("file_id", "rec_no"), ["file_id", "rec_no"], "left_anti")
    return packed.select("file_id", "rec_no").unionByName(superseded(alone).select("file_id", F.col("rec_no").cast("int").alias("rec_no")))


def spelled_paths(names: DataFrame, col: str = "filename") -> DataFrame:
    """Adds path_key: the file name with one separator, without case, suffixes of pending writes and repeated separators."""
    k = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.col(col))), r"[\\/]+", "/"), r"\.(part|tmp)$", "")
    return names.withColumn("path_key", F.when(k != "", k))


def tier_report(files: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """tier, n_files, n_bytes of a set of files; null sizes count as 0."""
    b = F.coalesce(F.greatest(F.col("n_bytes"), F.lit(0)), F.lit(0))
    size = F.floor(F.log(float(fanout), F.greatest(b, F.lit(1)).cast("double"))).cast("int")
    return files.select(size.alias("tier"), b.alias("b")).groupBy("tier").agg(F.count("*").alias("n_files"), F.sum("b").alias("n_bytes"))


def revision_numbers(docs: DataFrame, key: str = "urlkey") -> DataFrame:
    """Adds occurrence: the how-manyth row of its key a row is, by time and docid."""
    return docs.withColumn("occurrence", F.row_number().over(Window.partitionBy(key).orderBy("time", "docid")))
