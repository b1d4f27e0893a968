"""Sharding by jump consistent hashing, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cliploom.llm._util import Workspace, plain, work_units

_FACTOR = 2862933555777941757  # the multiplier of the generator in Lamping and Veach's paper


def jump(key: str, shards: int) -> Column:
    """The shard (int, 0 to shards - 1) of a bigint key, exactly as in the paper "A Fast, Minimal Memory,
    Consistent Hash Algorithm"; null keys go where key 0 goes.

    The 64-bit product is put together from limbs of 24, 24 and 16 bits, because Spark's bigint arithmetic
    raises on overflow. Each step jumps ahead, so about ln(shards) of the steps do work.
    """
    c0, c1, c2 = _FACTOR & 0xFFFFFF, _FACTOR >> 24 & 0xFFFFFF, _FACTOR >> 48
    limbs = "named_struct('a', s.k & 16777215L, 'b', shiftrightunsigned(s.k, 24) & 16777215L, 'c', shiftrightunsigned(s.k, 48))"
    sums = f"transform(array({limbs}), x -> named_struct('t', x.a * {c0}L + 1L, 'm', x.a * {c1}L + x.b * {c0}L, 'h', x.a * {c2}L + x.b * {c1}L + x.c * {c0}L))"
    carried = f"transform({sums}, x -> named_struct('t', x.t + shiftleft(x.m & 16777215L, 24), 'h', shiftright(x.m, 24) + x.h))"
    product = f"transform({carried}, x -> shiftleft((shiftright(x.t, 48) + x.h) & 65535L, 48) | (x.t & 281474976710655L))"
    after = f"transform({product}, k -> named_struct('k', k, 'b', s.j, 'j', cast(floor((s.j + 1L) * (2147483648D / (shiftrightunsigned(k, 33) + 1L))) as bigint)))[0]"
    start = f"named_struct('k', coalesce({key}, 0L), 'b', -1L, 'j', 0L)"
    return F.expr(f"cast(aggregate(sequence(1, {shards}), {start}, (s, i) -> if(s.j >= {shards}, s, {after}), s -> s.b) as int)")


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs.

    size is the text's UTF-8 bytes plus 8 (null: 8), text_crc32 that of the bytes (null: of none). The id alone
    decides the shard, so repeated rows share one and a null id has the shard of id 0; one more shard takes
    rows only into itself (grown_shard). slot numbers a shard's rows from 0 without gaps in order of their ids (a null
    id first, rows of one id by size and crc): rows are dealt into sorted ranges of (shard, id), and a range's numbers
    start where the ranges before it end, so no shard is sorted or gathered as a whole. An empty table gives an empty
    result; extra columns are ignored.
    """
    ws = Workspace(docs.sparkSession, "sharding")
    rows = plain(docs, id_col, text_col).toDF("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select("doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("id", F.col("doc_id").cast("long"))
    rows = ws.save(rows.withColumn("shard", jump("id", shards)).withColumn("grown_shard", jump("id", shards + 1)).drop("id"))
    order = ("shard", "doc_id", "size", "text_crc32")
    placed = rows.repartitionByRange(work_units(rows), *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ws.save(placed.select("*", F.spark_partition_id().alias("part"), at.alias("at")))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    starts = starts.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    numbered = placed.join(F.broadcast(starts), ["shard", "part"])  # a row for each range, and one more for each shard
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("at") + F.col("shift")).cast("long").alias("slot"), "grown_shard")
