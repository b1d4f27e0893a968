"""Sorted ranges of a table: places and running sums in a total order without one task that sees every row."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a local session without one gets a folder of this machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cliploom-"))
    folder = context.getCheckpointDir()
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder


def settled(rows: DataFrame) -> DataFrame:
    """rows computed once and kept in the cluster's checkpoint folder; a lost executor costs no recomputation."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def ranged(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """rows with _part, the number of their range in the order, and _at, their 0-based place within it.

    All order columns cut the ranges, so ties of the first ones are spread; adaptive execution sizes them.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return settled(placed.select("*", F.spark_partition_id().alias("_part"), at.alias("_at")))


def offsets(parts: DataFrame, total: Column) -> DataFrame:
    """(_part, _before): the sum of `total` over all ranges before each; a row a range."""
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return parts.groupBy("_part").agg(total.alias("_t")).select("_part", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
