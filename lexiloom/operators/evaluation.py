"""Measures of classifiers and their cross-validation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .models import precision_recall


def f_measure(p: Column, r: Column, w: float = 1.0) -> Column:
    """Weighted harmonic mean of precision and recall; 0 if both are 0."""
    return F.when((p == 0) & (r == 0), 0.0).otherwise((w * w + 1) * p * r / (w * w * p + r))


def averages(conf: DataFrame, w: float = 1.0) -> DataFrame:
    """micro, macro_precision, macro_recall, macro_f of a confusion table (actual, predicted, n) over all labels seen as either."""
    per = precision_recall(conf).withColumn("f", f_measure(F.col("precision"), F.col("recall"), w))
    macro = per.agg(F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f").alias("macro_f"))
    micro = conf.agg(F.try_divide(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)), F.sum("n")).alias("micro"))
    return micro.join(F.broadcast(macro))  # one row each


def pivoted(conf: DataFrame, labels: list) -> DataFrame:
    """actual and one column of counts for each predicted label."""
    return conf.groupBy("actual").pivot("predicted", labels).agg(F.sum("n")).fillna(0)


def folds(rows: DataFrame, row: str, k: int) -> DataFrame:
    """row, fold: contiguous folds by position in the order of row (unique), borders rounded half to even.

    Positions come from range-partitioned counts: each partition numbers its own rows, the partitions' offsets are a few numbers.
    """
    x = rows.select(row).repartitionByRange(row).withColumn("_p", F.spark_partition_id())
    x = stored(x, "folds")
    sizes = x.groupBy("_p").agg(F.count("*").alias("_c"), F.min(row).alias("_first"))
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    off = sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"), F.sum("_c").over(Window.partitionBy()).alias("_n"))
    pos = F.col("_off") + F.row_number().over(Window.partitionBy("_p").orderBy(row)) - 1
    bounds = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.bround(i * F.col("_n") / k, 0))
    return x.join(F.broadcast(off), "_p").withColumn("_pos", pos).select(row, F.size(F.filter(bounds, lambda b: b <= F.col("_pos"))).alias("fold"))


def cross_validated(rows: DataFrame, row: str, k: int, predict: Callable[[DataFrame, DataFrame], DataFrame], actual: str) -> DataFrame:
    """fold, actual, predicted, n over all folds. predict(train, test) gives row and predicted; a row it leaves out gets the training majority."""
    f = folds(rows, row, k)
    x = rows.join(f, row)
    out = None
    for i in range(k):
        train, test = x.where(F.col("fold") != i), x.where(F.col("fold") == i)
        top = train.groupBy(actual).count().agg(F.max_by(actual, F.struct("count", actual)).alias("_top"))
        p = predict(train, test).select(row, "predicted")
        j = test.select(row, F.col(actual).alias("actual")).join(p, row, "left").join(F.broadcast(top))  # one row
        c = j.select(F.lit(i).alias("fold"), "actual", F.coalesce("predicted", "_top").alias("predicted")).groupBy("fold", "actual", "predicted").agg(F.count("*").alias("n"))
        out = c if out is None else out.unionByName(c)
    return out


def fold_summary(conf: DataFrame) -> DataFrame:
    """mean, sd (of the population) and n_folds of the folds' accuracy; conf: fold, actual, predicted, n."""
    acc = conf.groupBy("fold").agg((F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n")).alias("acc"))
    return acc.agg(F.avg("acc").alias("mean"), F.stddev_pop("acc").alias("sd"), F.count("*").alias("n_folds"))
