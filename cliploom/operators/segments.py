"""Segments: gaps and islands, numbered parts, running offsets, balanced shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cliploom.operators.ranges import offsets, ranged
from cliploom.operators.select import global_rank


def merge_runs(segments: DataFrame, source: str, start: str, end: str) -> DataFrame:
    """(source, run, start, end, parts, use_suffix): segments that touch become one run.

    A source with several runs, or whose first run doesn't begin at 0, needs the span in its runs' names.
    """
    w = W.partitionBy(source).orderBy(start, end)
    marked = segments.select(F.col(source).alias("source"), F.col(start).alias("start"), F.col(end).alias("end"))
    w = W.partitionBy("source").orderBy("start", "end")
    marked = marked.withColumn("_new", F.coalesce((F.lag("end").over(w) != F.col("start")).cast("int"), F.lit(0)))
    marked = marked.withColumn("run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    runs = marked.groupBy("source", "run").agg(F.min("start").alias("start"), F.max_by("end", F.struct("start", "end")).alias("end"), F.count("*").alias("parts"))
    several = F.count("*").over(W.partitionBy("source")) > 1
    return runs.withColumn("use_suffix", several | (F.col("start") != 0))


def output_name(stem: Column, start: Column, end: Column, use_suffix: Column) -> Column:
    """stem.npz, or stem__000000_000000.npz with the span."""
    number = lambda c: F.lpad(c.cast("string"), 6, "0")
    return F.when(use_suffix, F.concat(stem, F.lit("__"), number(start), F.lit("_"), number(end), F.lit(".npz"))).otherwise(F.concat(stem, F.lit(".npz")))


def numbered_parts(names: DataFrame, column: str) -> DataFrame:
    """(output, parts, is_group, valid): names like base_1.npz, base_2.npz are parts of base.npz.

    A lone part keeps its own name; parts must be numbered 1 to n without gaps, else valid is false.
    """
    pattern = r"^(.+)_([1-9][0-9]*)\.npz$"
    held = names.select(F.col(column).alias("name"), F.regexp_extract(column, pattern, 1).alias("base"), F.regexp_extract(column, pattern, 2).try_cast("bigint").alias("i"))
    held = held.withColumn("group", F.when(F.col("base") == "", F.col("name")).otherwise(F.concat("base", F.lit(".npz"), F.lit("#"))))
    out = held.groupBy("group").agg(F.count("*").alias("parts"), F.min("i").alias("low"), F.max("i").alias("high"), F.min("name").alias("first"), F.min("base").alias("base"), F.count_distinct("i").alias("different"))
    group = (F.col("base") != "") & (F.col("parts") > 1)
    valid = ~group | ((F.col("low") == 1) & (F.col("high") == F.col("parts")) & (F.col("different") == F.col("parts")))
    return out.select(F.when(group, F.concat("base", F.lit(".npz"))).otherwise(F.col("first")).alias("output"), "parts", group.alias("is_group"), valid.alias("valid"))


def concatenated(frames: DataFrame, group: str, part: str, step: str) -> DataFrame:
    """frames with out_step: steps run on through a group's parts in their order.

    Each part's offset is a sum over part lengths, a table of one row a part, so no group's frames are sorted.
    """
    lengths = frames.groupBy(group, part).agg(F.count("*").alias("_len"))
    before = W.partitionBy(group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = lengths.select(group, part, F.coalesce(F.sum("_len").over(before), F.lit(0)).alias("_at"))
    return frames.join(offsets, [group, part]).withColumn("out_step", F.col("_at") + F.col(step)).drop("_at")


def id_runs(ids: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(src_start, src_end, dst_start, dst_end) of each run of consecutive sorted ids, per group."""
    if by:
        held = ids.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(column)) - 1)
    else:  # places in the whole order, without one task that sorts all ids
        held = global_rank(ids, [F.col(column)], "_n").withColumn("_n", F.col("_n") - 1)
    held = held.withColumn("_g", F.col(column) - F.col("_n"))
    runs = held.groupBy(*by, "_g").agg(F.min(column).alias("src_start"), (F.max(column) + 1).alias("src_end"), F.min("_n").cast("long").alias("dst_start"), (F.max("_n") + 1).cast("long").alias("dst_end"))
    return runs.drop("_g")


def clip_index(lengths: DataFrame, key: str = "motion_id") -> DataFrame:
    """(key, length, start, end): running offsets in key order.

    A range of keys starts where the ranges before it end, so the running sum is per range and no task sees all clips.
    """
    parts = ranged(lengths.select(key, "length"), [F.col(key)])
    running = F.sum("length").over(W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0))
    out = parts.withColumn("_run", running).join(F.broadcast(offsets(parts, F.sum("length"))), "_part").withColumn("end", F.col("_before") + F.col("_run"))
    return out.select(key, "length", (F.col("end") - F.col("length")).alias("start"), "end")


def shard_boundaries(index: DataFrame, shards: int, key: str = "motion_id") -> list[tuple[int, int]]:
    """(clip count, end frame) at each boundary, the first (0, 0): contiguous shards of nearly equal frames.

    Boundary i is the clip end nearest to total * i / shards, the earlier of two, but every shard gets a clip.
    Spark finds the clip ends on both sides of each target in one pass; only these few rows come to the driver.
    """
    if shards <= 0:
        raise ValueError(f"shards must be positive: {shards}")
    total, clips = index.agg(F.max("end"), F.count("*")).first()
    if clips < shards:
        raise ValueError(f"{clips} clips can't fill {shards} shards")
    counted = clip_counts(index, key)
    inner = F.sequence(F.lit(0), F.lit(shards))
    around = counted.withColumn("i", F.explode(F.filter(inner, lambda i: (i * F.lit(total) > F.col("start") * shards) & (i * F.lit(total) <= F.col("end") * shards))))
    near = {r.i: ((r.n - 1, r.start), (r.n, r.end)) for r in around.select("i", "n", "start", "end").collect()}
    out = [(0, 0)]
    for i in range(1, shards):
        low, high = out[-1][0] + 1, clips - (shards - i)
        options = {c: e for c, e in near[i] if low <= c <= high}
        missing = [c for c in (low, high) if c not in options and not options]
        if missing:
            options.update({r.n: r.end for r in counted.filter(F.col("n").isin(missing)).select("n", "end").collect()})
        best = min(options, key=lambda c: (abs(options[c] * shards - total * i), c))
        out.append((best, options[best]))
    return [*out, (clips, total)]


def clip_counts(index: DataFrame, key: str = "motion_id") -> DataFrame:
    """index with n, the number of clips up to and including each."""
    return clip_index(index.select(key, F.lit(1).cast("long").alias("length")), key).select(key, F.col("end").alias("n")).join(index, key)
