"""Serving frames: slices, windows, routing of ids, seeded sampling with rewinds, shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frame_to_clip(ids: DataFrame, index: DataFrame, frame: str, key: str = "motion_id", span: int = 4096) -> DataFrame:
    """ids with the clip that holds each global frame and the step in it.

    An interval join as an equi-join: a clip is listed under every span of `span` frames that it touches, a frame
    under its own, and the rest is an exact test; no broadcast and no nested loop.
    """
    cells = index.select(key, "start", "end", F.explode(F.sequence(F.floor(F.col("start") / span), F.floor((F.col("end") - 1) / span))).alias("_cell"))
    held = ids.withColumn("_cell", F.floor(F.col(frame) / span)).join(cells, "_cell")
    held = held.filter((F.col(frame) >= F.col("start")) & (F.col(frame) < F.col("end")))
    return held.withColumn("step", F.col(frame) - F.col("start")).drop("_cell", "start", "end")


def get_slice(requests: DataFrame, steps: Sequence[int], lengths: DataFrame, frames: DataFrame, key: str = "motion_id", start: str = "start_t") -> DataFrame:
    """The frames at start + each step, held at the clip's ends; a request keeps all its columns."""
    wide = requests.withColumn("_o", F.explode(F.array(*[F.lit(int(s)) for s in steps]))).join(lengths, key)
    at = F.greatest(F.lit(0), F.least(F.col(start) + F.col("_o"), F.col("length") - 1)).cast("long")
    return wide.withColumn("step", at).withColumnRenamed("_o", "offset").drop("length").join(frames, [key, "step"])


def hash_draw(column: Column, seed: int, bound: Column) -> Column:
    """A whole number in [0, bound) from sha256(seed:column): uniform, and the same on any engine."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), column.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), bound)


def uniform_frames(requests: DataFrame, index: DataFrame, env: str, seed: int, key: str = "motion_id") -> DataFrame:
    """requests with a uniformly drawn frame: its clip and start_t; clips come up in proportion to their length."""
    total = index.agg(F.max("end").alias("_total"))
    drawn = requests.join(F.broadcast(total)).withColumn("frame_id", hash_draw(F.col(env), seed, F.col("_total"))).drop("_total")
    return frame_to_clip(drawn, index, "frame_id", key).withColumnRenamed("step", "start_t")


def rewind_sample(requests: DataFrame, drawn: DataFrame, assigned: DataFrame, lengths: DataFrame, env: str, key: str = "motion_id") -> DataFrame:
    """(env, key, motion_len, start_t): a rewound env keeps its clip, terminated_t - rewind_steps but not under 0;
    the others take the drawn clip and start."""
    held = requests.join(drawn.select(env, F.col(key).alias("_new"), F.col("start_t").alias("_t")), env)
    held = held.join(assigned.select(env, F.col(key).alias("_old")), env, "left")
    back = F.col("rewind") & F.col("_old").isNotNull()
    held = held.withColumn(key, F.when(back, F.col("_old")).otherwise(F.col("_new")))
    held = held.withColumn("start_t", F.when(back, F.greatest(F.col("terminated_t") - F.col("rewind_steps"), F.lit(0))).otherwise(F.col("_t")))
    return held.join(lengths.select(key, F.col("length").alias("motion_len")), key).select(env, key, "motion_len", "start_t")


def window_starts(drawn: DataFrame, lengths: DataFrame, size: int, key: str = "motion_id") -> DataFrame:
    """drawn with start_t moved back so that `size` frames fit, or to 0 in short clips."""
    held = drawn.join(lengths, key)
    return held.withColumn("start_t", F.least(F.col("start_t"), F.greatest(F.col("length") - size, F.lit(0)))).drop("length")


def route(requests: DataFrame, spans: Sequence[int], column: str) -> DataFrame:
    """requests with the child dataset of each runtime id (children take consecutive spans) and the id in it."""
    ends, total = [], 0
    for s in spans:
        total += s
        ends.append(total)
    child = sum((F.when(F.col(column) >= e, 1).otherwise(0) for e in ends[1:]), F.when(F.col(column) >= ends[0], 1).otherwise(0))
    starts = F.array(*[F.lit(e) for e in [0, *ends]])
    return requests.filter(F.col(column) < total).withColumn("child", child).withColumn("child_id", F.col(column) - F.element_at(starts, F.col("child") + 1))


def assign_shards(index: DataFrame, boundaries: Sequence[tuple[int, int]]) -> DataFrame:
    """index with each clip's shard and its offsets rebased to the shard; boundaries as (clips, frames)."""
    shard = sum((F.when(F.col("start") >= frame, 1).otherwise(0) for _, frame in boundaries[1:-1]), F.lit(0))
    base = F.element_at(F.array(*[F.lit(f).cast("long") for _, f in boundaries]), F.col("shard") + 1)
    return index.withColumn("shard", shard).withColumns({"start": F.col("start") - base, "end": F.col("end") - base})
