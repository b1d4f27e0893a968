"""Sanity checks of clips, and the physical penalties and score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: The reasons in the order in which they are listed.
REASONS = (
    "root_qvel_spike", "joint_pos_spike", "joint_vel_spike", "body_lin_vel_spike", "body_ang_vel_spike", "too_short",
    "no_dynamic_bodies", "all_bodies_off_ground_too_long", "max_body_height_too_low",
)
#: Thresholds of the checks.
ROOT_VEL, JOINT_POS, JOINT_VEL, BODY_LIN, BODY_ANG, MIN_FRAMES, GROUND, AIR_SECONDS = 10.0, 3.0, 30.0, 20.0, 40.0, 250, 0.2, 1.0
#: Weights of the penalties in the physical score.
WEIGHTS = {"foot_sliding": 1.70, "velocity_violation": 44.22, "self_collision": 0.17, "jerk": 0.28, "penetration": 216.62, "floating_frames_ratio": 24.19}
KEPT_FROM = 90.0


def spike(values: list[Column], limit: float) -> Column:
    """Any of a clip's values beyond the limit, as an aggregate."""
    return F.coalesce(F.bool_or(F.greatest(*[F.abs(v) for v in values], F.lit(0.0)) > limit), F.lit(False))


def longest_run(frames: DataFrame, flag: Column, key: str = "motion_id", step: str = "step") -> DataFrame:
    """(key, longest_run, n): frames in the longest run of true flags, by gaps and islands over one sort."""
    w = W.partitionBy(key).orderBy(step)
    marked = frames.select(key, step, F.coalesce(flag, F.lit(False)).alias("_f"))
    marked = marked.withColumn("_n", F.row_number().over(w))
    marked = marked.withColumn("_last", F.coalesce(F.max(F.when(~F.col("_f"), F.col("_n"))).over(w), F.lit(0)))
    return marked.groupBy(key).agg(F.max(F.col("_n") - F.col("_last")).cast("long").alias("longest_run"), F.count("*").alias("n"))


def sustained_ratio(frames: DataFrame, flag: Column, fps: float, seconds: float, key: str = "motion_id", step: str = "step") -> DataFrame:
    """(key, ratio): the part of frames in whose window of `seconds` the flag always holds.

    Over a run of n true frames such windows number n - w + 1, so runs are counted instead of windows.
    """
    size = max(1, int(seconds * fps))
    w = W.partitionBy(key).orderBy(step)
    marked = frames.select(key, step, F.coalesce(flag, F.lit(False)).alias("_f")).withColumn("_n", F.row_number().over(w))
    marked = marked.withColumn("_run", F.coalesce(F.max(F.when(~F.col("_f"), F.col("_n"))).over(w), F.lit(0)))
    inside = F.col("_f") & (F.col("_n") - F.col("_run") >= size)
    return marked.groupBy(key).agg((F.sum(inside.cast("int")) / F.count("*")).alias("ratio"))


def reasons(flags: dict[str, Column]) -> Column:
    """Names of the true flags, in the fixed order."""
    return F.array_compact(F.array(*[F.when(flags[r], F.lit(r)) for r in REASONS if r in flags]))


def reason_counts(clips: DataFrame, column: str = "reasons") -> DataFrame:
    return clips.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def report(clips: DataFrame, column: str = "reasons") -> DataFrame:
    """total, kept, rejected."""
    valid = F.size(column) == 0
    return clips.agg(F.count("*").alias("total"), F.count_if(valid).alias("kept"), F.count_if(~valid).alias("rejected"))


def physical_score(penalties: dict[str, Column]) -> Column:
    """100 less the weighted penalties, at least 0."""
    total = sum((F.lit(WEIGHTS[k]) * v for k, v in penalties.items()), F.lit(0.0))
    return F.greatest(F.lit(0.0), 100 - total)


def motion_scores(frames: DataFrame, joints: dict[str, float], fps: float, seconds: float = 1.0, distance: float = 0.05, margin: float = 0.01, most: int = 10, key: str = "motion_id", step: str = "step") -> DataFrame:
    """(key, frames, the six penalties, score) of frames(key, step, slide, floor_min_dist, non_floor_contact_count, joints).

    joints: velocity column -> limit; slide: the feet's part in a frame. All penalties come from one sort a clip.
    Without joints there is neither violation nor jerk; floating is as in sustained_ratio over `distance` from the floor.
    """
    w = W.partitionBy(key).orderBy(step)
    size, zero = max(1, int(seconds * fps)), F.lit(0.0)
    over = sum((F.greatest(F.abs(F.col(c)) - limit, zero) for c, limit in joints.items()), zero) / max(1, len(joints))
    change = sum((((F.col(c) - F.coalesce(F.lag(c).over(w), F.col(c))) * fps) ** 2 for c in joints), zero)
    rows = frames.withColumns({"_n": F.row_number().over(w), "_air": F.col("floor_min_dist") > distance, "_over": over, "_jerk": 0.01 * F.sqrt(change)})
    rows = rows.withColumn("_run", F.coalesce(F.max(F.when(~F.col("_air"), F.col("_n"))).over(w), F.lit(0)))
    floating = (F.col("_air") & (F.col("_n") - F.col("_run") >= size)).cast("int")
    out = rows.groupBy(key).agg(
        F.count("*").alias("frames"), F.avg("slide").alias("foot_sliding"), F.avg("_over").alias("velocity_violation"),
        F.avg(F.least("non_floor_contact_count", F.lit(most))).alias("self_collision"), F.avg("_jerk").alias("jerk"),
        F.avg(F.greatest(-F.col("floor_min_dist") - margin, zero)).alias("penetration"), (F.sum(floating) / F.count("*")).alias("floating_frames_ratio"),
    )
    return out.withColumn("score", physical_score({k: F.col(k) for k in WEIGHTS}))


def status(score: Column, threshold: float = KEPT_FROM) -> Column:
    return F.when(score >= threshold, "kept").otherwise("rejected")


def foot_sliding(height: Column, vx: Column, vy: Column, height_limit: float = 0.05, speed_limit: float = 0.10) -> Column:
    """One foot's part in a frame: five times the speed over the limit while the foot is low."""
    return F.when(height < height_limit, 5 * F.greatest(F.sqrt(vx * vx + vy * vy) - speed_limit, F.lit(0.0))).otherwise(0.0)


def contact_summary(frames: DataFrame, contacts: DataFrame, on: str, is_floor: Column, dist: Column, capacity: int = 0) -> DataFrame:
    """Per frame: floor_min_dist (100 without floor contact), non_floor_contact_count, contact_buffer_saturated."""
    found = contacts.groupBy(on).agg(
        F.min(F.when(is_floor, dist)).alias("_d"), F.count_if(~is_floor & (dist < 0)).alias("_c"), F.count("*").alias("_n")
    )
    full = (F.coalesce("_n", F.lit(0)) >= capacity) if capacity > 0 else F.lit(False)
    joined = frames.join(found, on, "left")
    return joined.withColumns({"floor_min_dist": F.coalesce("_d", F.lit(100.0)), "non_floor_contact_count": F.coalesce("_c", F.lit(0)).cast("long"), "contact_buffer_saturated": full}).drop("_d", "_c", "_n")
