"""Velocities, resampling, windows and window features of frames (clip key, step, values)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cliploom.functions import rotations as R
from cliploom.functions.scalars import lerp

KEY, STEP = "motion_id", "step"


def along(key: str = KEY, step: str = STEP):
    return W.partitionBy(key).orderBy(step)


def _spread(value: Column, w) -> Column:
    """A forward difference for every frame: the last repeats the one before, a lone frame has 0."""
    return F.coalesce(value, F.lag(value).over(w), F.lit(0.0))


def with_velocity(frames: DataFrame, columns: Sequence[str], fps: float, key: str = KEY, step: str = STEP, suffix: str = "_vel") -> DataFrame:
    """Forward differences per second."""
    w = along(key, step)
    ahead = frames.withColumns({f"_d_{c}": (F.lead(c).over(w) - F.col(c)) * fps for c in columns})
    return ahead.withColumns({c + suffix: _spread(F.col(f"_d_{c}"), w) for c in columns}).drop(*[f"_d_{c}" for c in columns])


def with_angular_velocity(frames: DataFrame, q: Sequence[str], fps: float, names: Sequence[str] = ("wx", "wy", "wz"), key: str = KEY, step: str = STEP) -> DataFrame:
    """Body-frame angular velocity of a quaternion (w, x, y, z)."""
    w = along(key, step)
    now, then = tuple(F.col(c) for c in q), tuple(F.lead(c).over(w) for c in q)
    ahead = frames.withColumns({f"_q{i}": c for i, c in enumerate(R.multiply(R.conjugate(now), then))})
    ahead = ahead.withColumn("_s", F.sqrt(F.col("_q1") ** 2 + F.col("_q2") ** 2 + F.col("_q3") ** 2))
    angle = 2 * F.atan2("_s", "_q0")
    ahead = ahead.withColumn("_v", F.when(angle > math.pi, angle - 2 * math.pi).otherwise(angle) * fps)
    axis = [F.when(F.col("_s") < 1e-15, F.lit(float(i == 1))).otherwise(F.col(f"_q{i}") / F.col("_s")) for i in (1, 2, 3)]
    ahead = ahead.withColumns({f"_d{i}": a * F.col("_v") for i, a in enumerate(axis)})
    spread = ahead.withColumns({n: _spread(F.col(f"_d{i}"), w) for i, n in enumerate(names)})
    return spread.drop("_q0", "_q1", "_q2", "_q3", "_s", "_v", "_d0", "_d1", "_d2")


def resample(frames: DataFrame, source: int, target: int, linear: Sequence[str] = (), quaternions: Sequence[Sequence[str]] = (), key: str = KEY, step: str = STEP) -> DataFrame:
    """Frames at `target` per second: values interpolated linearly, quaternions spherically.

    Each source segment makes the target frames that fall into it, so there is one window over the clips and no
    join. Rates are whole numbers and positions exact.
    """
    w = along(key, step)
    columns = [*linear, *(c for q in quaternions for c in q)]
    ahead = frames.select(key, step, *columns, *[F.lead(c).over(w).alias(f"_n_{c}") for c in columns], F.lead(step).over(w).alias("_n"))
    low = F.when(F.col(step) == 0, 0).otherwise(F.floor(F.col(step) * target / F.lit(source)) + 1)
    high = F.when(F.col("_n").isNull(), F.when(F.col(step) == 0, 0).otherwise(-1)).otherwise(F.floor((F.col(step) + 1) * target / F.lit(source)))
    made = ahead.withColumns({"_low": low.cast("long"), "_high": high.cast("long")}).filter("_low <= _high")
    made = made.withColumn("_k", F.explode(F.sequence("_low", "_high")))
    t = F.when(F.col("_n").isNull(), 0.0).otherwise((F.col("_k") * source - F.col(step) * target) / F.lit(float(target)))
    made = made.withColumn("_t", t)
    after = lambda c: F.coalesce(F.col(f"_n_{c}"), F.col(c))
    out = [F.col(key), F.col("_k").alias(step)]
    out += [lerp(F.col(c), after(c), F.col("_t")).alias(c) for c in linear]
    for q in quaternions:
        made = _turned(made, q, after)
        out += [F.col(c) for c in q]
    return made.select(*out)


def _turned(rows: DataFrame, q: Sequence[str], after) -> DataFrame:
    """q turned towards after(q) by _t: the steps of rotations.slerp, each a projection, so that none is computed twice."""
    a, b = R.normalize(tuple(F.col(c) for c in q)), R.normalize(tuple(after(c) for c in q))
    rows = rows.withColumns({f"_{n}{i}": x for n, v in (("a", a), ("b", b)) for i, x in enumerate(v)})
    dot = sum((F.col(f"_a{i}") * F.col(f"_b{i}") for i in range(1, 4)), F.col("_a0") * F.col("_b0"))
    rows = rows.withColumn("_dot", dot).withColumn("_cos", F.least(F.abs("_dot"), F.lit(1.0))).withColumn("_angle", F.acos("_cos"))
    rows = rows.withColumn("_sin", F.greatest(F.sin("_angle"), F.lit(1e-8)))
    near = F.col("_cos") > 0.9995
    wa = F.when(near, 1 - F.col("_t")).otherwise(F.sin((1 - F.col("_t")) * F.col("_angle")) / F.col("_sin"))
    wb = F.when(near, F.col("_t")).otherwise(F.sin(F.col("_t") * F.col("_angle")) / F.col("_sin"))
    rows = rows.withColumns({"_wa": wa, "_wb": wb * F.when(F.col("_dot") < 0, F.lit(-1.0)).otherwise(F.lit(1.0))})
    rows = rows.withColumns({f"_q{i}": F.col(f"_a{i}") * F.col("_wa") + F.col(f"_b{i}") * F.col("_wb") for i in range(4)})
    rows = rows.withColumn("_size", F.greatest(F.sqrt(sum((F.col(f"_q{i}") ** 2 for i in range(1, 4)), F.col("_q0") ** 2)), F.lit(1e-8)))
    return rows.withColumns({c: F.col(f"_q{i}") / F.col("_size") for i, c in enumerate(q)})


def clip_lengths(frames: DataFrame, key: str = KEY) -> DataFrame:
    return frames.groupBy(key).agg(F.count("*").alias("length"))


def window_index(lengths: DataFrame, size: int, downsample: int, stride: int = 1, fallback: bool = False, key: str = KEY) -> DataFrame:
    """(key, window_id, pos, step): dilated windows of `size` samples about centres `stride` apart.

    Clips too short for one have none, or with fallback a single one about their middle, held at the clip's ends.
    """
    half = (size - 1) // 2
    pad = half * downsample
    last = F.col("length") - 2 * pad - 1
    centres = F.when(last >= 0, F.sequence(F.lit(pad).cast("long"), F.lit(pad) + last, F.lit(max(1, stride)).cast("long")))
    if fallback:
        centres = F.when(last >= 0, centres).when(F.col("length") > 0, F.array(F.floor(F.col("length") / 2)))
    windows = lengths.select(key, "length", F.posexplode(centres).alias("window_id", "centre"))
    offsets = F.sequence(F.lit(-half), F.lit(half))
    placed = windows.select(key, "length", "window_id", "centre", F.posexplode(offsets).alias("pos", "_o"))
    step = F.greatest(F.lit(0), F.least(F.col("centre") + F.col("_o") * downsample, F.col("length") - 1))
    return placed.select(key, "window_id", "pos", step.cast("long").alias(STEP))


def windows(frames: DataFrame, size: int, downsample: int, stride: int = 1, fallback: bool = False, key: str = KEY) -> DataFrame:
    """The frames of each window of window_index: each frame finds its own places by arithmetic from its clip's length.

    There is no join: windows exploded from the lengths look as small to the planner as these, and would be broadcast.
    A shuffle of the frames parts the clips' buffers from what groups or sorts the windows: in one task this would take
    the memory that a long clip's buffer then can't get. The key stands there twice, as the planner leaves out a shuffle
    that deals the rows as they lie.
    """
    half, stride = (size - 1) // 2, max(1, stride)
    placed = _dealt(frames, key).withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(2 * half))))
    first, last = F.col(STEP) - F.col("pos") * downsample, F.col("_length") - 2 * half * downsample - 1
    inside = (first >= 0) & (first <= last) & (first % stride == 0)
    if fallback:
        alone = F.greatest(F.lit(0), F.least(F.floor(F.col("_length") / 2) + (F.col("pos") - half) * downsample, F.col("_length") - 1))
        inside = F.when(last >= 0, inside).otherwise(F.col(STEP) == alone)
    window = F.when(last >= 0, F.expr(f"({STEP} - pos * {downsample}) div {stride}")).otherwise(0).cast("int")
    return placed.filter(inside).select(key, STEP, window.alias("window_id"), "pos", *_more(frames, key))


def _more(frames: DataFrame, key: str) -> list[Column]:
    return [F.col(f"`{c}`") for c in frames.columns if c not in (key, STEP)]


def _dealt(frames: DataFrame, key: str) -> DataFrame:
    """frames with their clip's _length, shuffled anew."""
    counted = frames.select(key, F.col(STEP).cast("long").alias(STEP), F.count("*").over(W.partitionBy(key)).alias("_length"), *_more(frames, key))
    return counted.filter(F.col(key).isNotNull()).repartition(key, key)


def _in_blocks(frames: DataFrame, columns: Sequence[str], half: int, downsample: int, stride: int, key: str, block: int) -> DataFrame:
    """frames by _block of `block` windows of their clip; _held: the (step, c0, c1, ...) that a window with this frame can have up to it.

    A clip's block holds the frames that its windows need, so a task holds one at a time, however long the clip is.
    """
    span = 2 * half * downsample
    low = F.expr(f"greatest({STEP} - {span} + {stride - 1}, 0) div {stride} div {block}")
    blocks = _dealt(frames, key).filter(F.col(STEP) >= 0).withColumn("_block", F.explode(F.sequence(low, F.expr(f"{STEP} div {stride} div {block}"))))
    before = W.partitionBy(key, "_block", F.col(STEP) % downsample).orderBy(STEP).rangeBetween(-span, 0)
    return blocks.withColumn("_held", F.collect_list(F.struct(STEP, *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])).over(before))


def windows_with_first(frames: DataFrame, columns: Sequence[str], size: int, downsample: int, stride: int = 1, key: str = KEY, block: int = 256) -> DataFrame:
    """The rows of windows() without fallback, and first_<c>: the columns of each window's first frame that there is.

    Windows are neither sorted nor grouped, as there are several rows of them for each frame: a frame has the samples
    before it at hand, and so the first one of every window that it lies in.
    """
    half, stride = (size - 1) // 2, max(1, stride)
    placed = _in_blocks(frames, columns, half, downsample, stride, key, block).withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(2 * half))))
    first = F.col(STEP) - F.col("pos") * downsample
    window = F.expr(f"({STEP} - pos * {downsample}) div {stride}")
    inside = (first >= 0) & (first <= F.col("_length") - 2 * half * downsample - 1) & (first % stride == 0) & (F.expr(f"({STEP} - pos * {downsample}) div {stride} div {block}") == F.col("_block"))
    found = F.filter("_held", lambda x: x[STEP] >= first)[0]
    rows = placed.filter(inside).select(key, STEP, window.cast("int").alias("window_id"), "pos", *_more(frames, key), found.alias("_first"))
    return rows.select(key, STEP, "window_id", "pos", *_more(frames, key), *[F.col(f"_first.c{i}").alias(f"first_{c}") for i, c in enumerate(columns)])


def packed_windows(frames: DataFrame, columns: Sequence[str], size: int, downsample: int, stride: int = 1, key: str = KEY, block: int = 256) -> DataFrame:
    """(key, window_id, columns): a row a whole window, its samples in order, an array a column; steps don't repeat in a clip.

    A window is what its last frame has at hand, so that its samples are never rows to be grouped. One that lacks a
    frame isn't whole; a clip without gaps has none of these.
    """
    half, stride = (size - 1) // 2, max(1, stride)
    span = 2 * half * downsample
    first, of = F.col(STEP) - span, F.expr(f"({STEP} - {span}) div {stride}")
    ends = (first >= 0) & (first <= F.col("_length") - span - 1) & (first % stride == 0) & (F.expr(f"({STEP} - {span}) div {stride} div {block}") == F.col("_block"))
    whole = _in_blocks(frames, columns, half, downsample, stride, key, block).filter(ends & (F.size("_held") == 2 * half + 1))
    return whole.select(key, of.cast("int").alias("window_id"), *[F.col(f"_held.c{i}").alias(c) for i, c in enumerate(columns)])


def heading_frame(rows: DataFrame, position: Sequence[str], q: Sequence[str], by: Sequence[str], order: str) -> DataFrame:
    """Adds root_0..root_8: position and first two rotation columns, seen from each window's first frame's heading."""
    w = W.partitionBy(*by).orderBy(order)
    first = {f"_f_{c}": F.first(c).over(w) for c in [*position, *q]}
    return seen_from(rows.withColumns(first), position, q, "_f_").drop(*first)


def seen_from(rows: DataFrame, position: Sequence[str], q: Sequence[str], prefix: str) -> DataFrame:
    """Adds root_0..root_8 as heading_frame does, with the first frame's columns under a prefix."""
    held = rows.withColumn("_yaw", R.yaw(tuple(F.col(prefix + c) for c in q)))
    dx, dy, dz = (F.col(c) - F.col(prefix + c) for c in position)
    c, s = F.cos("_yaw"), F.sin("_yaw")
    turned = R.multiply(R.yaw_quat(-F.col("_yaw")), tuple(F.col(x) for x in q))
    out = (c * dx + s * dy, c * dy - s * dx, dz, *R.rot6d(turned))
    return held.withColumns({f"root_{i}": x for i, x in enumerate(out)}).drop("_yaw")


def local_root_velocity(frames: DataFrame, velocity: Sequence[str], q: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A world velocity in the root's own frame."""
    unit = frames.withColumns({f"_u{i}": x for i, x in enumerate(R.normalize(tuple(F.col(c) for c in q)))})
    w, *u = (F.col(f"_u{i}") for i in range(4))
    u, v = [-x for x in u], [F.col(c) for c in velocity]
    cross = lambda a, b: [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    unit = unit.withColumns({f"_c{i}": 2 * x for i, x in enumerate(cross(u, v))})
    turn = [F.col(f"_c{i}") for i in range(3)]
    turned = [a + w * b + c for a, b, c in zip(v, turn, cross(u, turn), strict=True)]
    return unit.withColumns(dict(zip(names, turned, strict=True))).drop("_u0", "_u1", "_u2", "_u3", "_c0", "_c1", "_c2")


def feature_stats(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(channel, mean, std): population deviation, at least 1e-6; one partial and one final aggregate."""
    sums = rows.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.avg(F.col(c) * F.col(c)).alias(f"s_{c}") for c in columns])
    each = [F.struct(F.lit(i).alias("channel"), F.col(f"m_{c}").alias("mean"), F.greatest(F.sqrt(F.greatest(F.col(f"s_{c}") - F.col(f"m_{c}") ** 2, F.lit(1e-12))), F.lit(1e-6)).alias("std")) for i, c in enumerate(columns)]
    return sums.select(F.inline(F.array(*each)))


def normalized(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns less their mean, over their deviation; the statistics are a single broadcast row."""
    stats = feature_stats(rows, columns)
    wide = one_row(stats, len(columns))
    held = rows.join(F.broadcast(wide))
    return held.withColumns({c: (F.col(c) - F.col(f"_mean{i}")) / F.col(f"_std{i}") for i, c in enumerate(columns)}).drop(*wide.columns)


def one_row(stats: DataFrame, channels: int) -> DataFrame:
    """feature_stats as _mean0, _std0, _mean1, ..."""
    return stats.agg(*[F.max(F.when(F.col("channel") == i, F.col(k))).alias(f"_{k}{i}") for i in range(channels) for k in ("mean", "std")])


def spectrum(rows: DataFrame, columns: Sequence[str], size: int, seconds: float, by: Sequence[str], pos: str = "pos") -> DataFrame:
    """amp_<c>, freq_<c>, offset_<c> of each group of `size` samples, by the discrete Fourier sums.

    One aggregate makes all sums of a window, a pair a frequency; samples aren't repeated for the frequencies.
    """
    freqs = range(1, size // 2 + 1)
    turn = lambda k: k * F.col(pos) * (2 * math.pi / size)
    parts = [x for i, c in enumerate(columns) for k in freqs for x in (F.sum(F.col(c) * F.cos(turn(k))).alias(f"_r{i}_{k}"), F.sum(F.col(c) * F.sin(turn(k))).alias(f"_i{i}_{k}"))]
    power = rows.groupBy(*by).agg(*parts, *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(columns)])
    power = power.withColumns({f"_p{i}_{k}": F.col(f"_r{i}_{k}") ** 2 + F.col(f"_i{i}_{k}") ** 2 for i in range(len(columns)) for k in freqs})
    add = lambda values: sum(values, F.lit(0.0))
    out = []
    for i, c in enumerate(columns):
        total = add(F.col(f"_p{i}_{k}") for k in freqs) + 1e-8
        rate = add(k / F.lit(seconds) * F.col(f"_p{i}_{k}") for k in freqs) / total
        out += [(2 * F.sqrt(total) / size).alias(f"amp_{c}"), rate.alias(f"freq_{c}"), (F.col(f"_s{i}") / size).alias(f"offset_{c}")]
    return power.select(*by, *out)


def complexity(frames: DataFrame, velocities: Sequence[str], fps: float, key: str = KEY, step: str = STEP) -> DataFrame:
    """(key, complexity): mean squared speed plus 0.05 times mean squared acceleration; 0 under three frames."""
    w = along(key, step)
    speed = sum((F.col(c) ** 2 for c in velocities[1:]), F.col(velocities[0]) ** 2)
    change = [((F.lead(c).over(w) - F.col(c)) * fps) ** 2 for c in velocities]
    rows = frames.select(key, speed.alias("_s"), sum(change[1:], change[0]).alias("_a"))
    value = F.when(F.count("*") < 3, 0.0).otherwise(F.avg("_s") + 0.05 * F.avg("_a"))
    return rows.groupBy(key).agg(value.alias("complexity"))
