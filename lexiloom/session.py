"""Session, table access and the few helpers every operator shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HASH_SPACE = 1 << 30
#: Size of the filter in front of lookups of keys.
FILTER_BITS = 23


def get_spark(app: str = "lexiloom", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors once per application, so that Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_lexiloom_shipped", False) is not True:
        root = Path(__file__).resolve().parent
        out = Path(tempfile.mkdtemp(prefix="lexiloom-")) / "lexiloom_src.zip"  # on the driver; executors fetch it from there
        atexit.register(shutil.rmtree, out.parent, ignore_errors=True)
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, Path("lexiloom") / f.relative_to(root))
        sc.addPyFile(str(out))
        sc._lexiloom_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); in a local session without one, a temporary folder is set."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexiloom-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, most: int = 0) -> DataFrame:
    """Writes df as a Parquet table into the shared folder, with up to so many rows a file (0: any), and reads it back: lineage is cut, later reads prune columns."""
    path = os.path.join(shared_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.option("maxRecordsPerFile", most).parquet(path)
    return df.sparkSession.read.parquet(path)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """About n rows of df, chosen by a hash of key: the same rows on every run, spread over the whole table.

    Only models are fitted on such samples; n is the documented bound of each fit.
    """
    total = df.count()
    if total <= n:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(HASH_SPACE)) < int(HASH_SPACE * n / total))


def may_have(rows: DataFrame, key: str, members: DataFrame, member_key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose key (bigint) may be among the members: all that are, and few others while members are fewer than the bits.

    The members' hashes become a bitmap of at most 2**(bits - 6) rows of 64 bits, whatever their number; only that is broadcast.
    """

    def at(c: str) -> tuple[Column, Column]:
        h = F.xxhash64(c, F.lit(29))
        return F.shiftright(h, 6).bitwiseAND((1 << (bits - 6)) - 1), F.expr(f"shiftleft(1L, cast(xxhash64({c}, 29) & 63 as int))")

    i, b = at(member_key)
    m = members.select(i.alias("_i"), b.alias("_b")).groupBy("_i").agg(F.bit_or("_b").alias("_bits"))
    i, b = at(key)
    return rows.withColumns({"_i": i, "_b": b}).join(F.broadcast(m), "_i").where(F.col("_bits").bitwiseAND(F.col("_b")) != 0).drop("_i", "_b", "_bits")


def host_key(c: Column) -> Column:
    """A host without case, scheme, user, port, path, leading www. and trailing dot."""
    h = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://", "")
    h = F.regexp_replace(h, r"[/?#].*$|:\d*$", "")
    h = F.regexp_replace(h, r":\d*$|^[^@]*@", "")
    h = F.regexp_replace(h, r"^(www\d?\.)+|\.+$", "")
    return F.when(h == "", None).otherwise(h)
