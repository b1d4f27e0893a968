"""Plans over v_bodies, v_contacts and the scores made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.operators import catalog, checks, select
from cliploom.plans.registry import plan
from cliploom.plans.views import FPS, Views, r9


@plan("SELECT motion_id, max(z) <= 0.9 AS max_body_height_too_low FROM v_bodies GROUP BY motion_id")
def check_height(v: Views) -> DataFrame:
    return v.bodies.groupBy("motion_id").agg((F.max("z") <= 0.9).alias("max_body_height_too_low"))


@plan("SELECT motion_id, bool_or(round(sqrt(vx * vx + vy * vy + vz * vz), 9) > 12.5) AS body_lin_vel_spike FROM v_bodies GROUP BY motion_id")
def check_body_lin(v: Views) -> DataFrame:
    speed = F.round(F.sqrt(F.col("vx") ** 2 + F.col("vy") ** 2 + F.col("vz") ** 2), 9)
    return v.bodies.groupBy("motion_id").agg(checks.spike([speed], 12.5).alias("body_lin_vel_spike"))


@plan("SELECT motion_id, bool_or(round(sqrt(vy * vy + vx * vx), 9) > 12) AS body_ang_vel_spike FROM v_bodies GROUP BY motion_id")
def check_body_ang(v: Views) -> DataFrame:
    speed = F.round(F.sqrt(F.col("vy") ** 2 + F.col("vx") ** 2), 9)
    return v.bodies.groupBy("motion_id").agg(checks.spike([speed], 12).alias("body_ang_vel_spike"))


@plan("SELECT s.motion_id, s.step, count(b.body) AS bodies, count(b.body) <= 1 AS no_dynamic_bodies FROM v_steps s LEFT JOIN v_bodies b ON b.frame = s.o_orderkey GROUP BY s.motion_id, s.step")
def check_no_bodies(v: Views) -> DataFrame:
    held = v.bodies.groupBy("frame").agg(F.count("*").alias("n"))
    out = v.steps.join(held, "frame", "left").withColumn("bodies", F.coalesce("n", F.lit(0)))
    return out.select("motion_id", "step", "bodies", (F.col("bodies") <= 1).alias("no_dynamic_bodies"))


AIR = "SELECT motion_id, step, row_number() OVER (PARTITION BY motion_id ORDER BY step) AS n, min(z) > 0.2 AS f FROM v_bodies GROUP BY motion_id, step"


@plan(f"SELECT a.motion_id, coalesce(max(r.len), 0) AS longest_run, round(coalesce(max(r.len), 0) / 50.0, 9) > 0.05 AS all_bodies_off_ground_too_long FROM (SELECT DISTINCT motion_id FROM v_bodies) a LEFT JOIN (SELECT motion_id, count(*) AS len FROM (SELECT motion_id, n - row_number() OVER (PARTITION BY motion_id ORDER BY n) AS g FROM ({AIR}) WHERE f) GROUP BY motion_id, g) r USING (motion_id) GROUP BY a.motion_id")
def check_airborne(v: Views) -> DataFrame:
    frames = v.bodies.groupBy("motion_id", "step").agg(F.min("z").alias("low"))
    out = checks.longest_run(frames, F.col("low") > checks.GROUND)
    return out.select("motion_id", "longest_run", (F.round(F.col("longest_run") / FPS, 9) > 0.05).alias("all_bodies_off_ground_too_long"))


@plan("SELECT motion_id, round(avg(slide), 8) AS foot_sliding FROM (SELECT motion_id, frame, sum(CASE WHEN body <= 2 AND z < 0.25 THEN 5 * greatest(sqrt(vx * vx + vy * vy) - 0.10, 0.0) ELSE 0.0 END) AS slide FROM v_bodies GROUP BY motion_id, frame) GROUP BY motion_id")
def foot_sliding(v: Views) -> DataFrame:
    each = F.when(F.col("body") <= 2, checks.foot_sliding(F.col("z"), F.col("vx"), F.col("vy"), height_limit=0.25)).otherwise(0.0)
    frames = v.bodies.groupBy("motion_id", "frame").agg(F.sum(each).alias("slide"))
    return frames.groupBy("motion_id").agg(F.round(F.avg("slide"), 8).alias("foot_sliding"))


@plan("SELECT count(*) AS total, count(*) FILTER (max_z > 0.9 AND NOT lin) AS kept, count(*) FILTER (NOT (max_z > 0.9 AND NOT lin)) AS rejected FROM (SELECT motion_id, max(z) AS max_z, bool_or(round(sqrt(vx * vx + vy * vy + vz * vz), 9) > 12.5) AS lin FROM v_bodies GROUP BY motion_id)")
def filter_report(v: Views) -> DataFrame:
    speed = F.round(F.sqrt(F.col("vx") ** 2 + F.col("vy") ** 2 + F.col("vz") ** 2), 9)
    clips = v.bodies.groupBy("motion_id").agg(F.max("z").alias("top"), checks.spike([speed], 12.5).alias("lin"))
    return checks.report(clips.withColumn("reasons", checks.reasons({"body_lin_vel_spike": F.col("lin"), "max_body_height_too_low": F.col("top") <= 0.9})))


@plan("SELECT n_name AS name, n_nationkey AS id FROM nation WHERE n_regionkey IN (1, 3)")
def name_to_index(v: Views) -> DataFrame:
    wanted = v.table("nation").filter("n_regionkey in (1, 3)").select(F.col("n_name").alias("name"))
    known = v.table("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    return wanted.join(known, "name")


@plan("SELECT a.frame, a.body AS body0, b.body AS body1, round(sqrt(pow(a.vx - b.vx, 2) + pow(a.vy - b.vy, 2) + pow(a.z - b.z, 2)), 9) AS dist FROM v_bodies a JOIN v_bodies b ON a.frame = b.frame AND a.body < b.body WHERE round(sqrt(pow(a.vx - b.vx, 2) + pow(a.vy - b.vy, 2) + pow(a.z - b.z, 2)), 9) < 1.2")
def self_collision_pairs(v: Views) -> DataFrame:
    side = lambda i: v.bodies.select("frame", *[F.col(c).alias(f"{c}{i}") for c in ("body", "vx", "vy", "z")])
    pairs = side(0).join(side(1), "frame").filter("body0 < body1")
    dist = F.round(F.sqrt((F.col("vx0") - F.col("vx1")) ** 2 + (F.col("vy0") - F.col("vy1")) ** 2 + (F.col("z0") - F.col("z1")) ** 2), 9)
    return pairs.withColumn("dist", dist).filter("dist < 1.2").select("frame", "body0", "body1", "dist")


@plan("SELECT frame, motion_id, step, floor_min_dist, non_floor_contact_count FROM v_summary")
def contact_summary(v: Views) -> DataFrame:
    return v.summary.select("frame", "motion_id", "step", "floor_min_dist", "non_floor_contact_count")


@plan("SELECT frame, n >= 5 AS contact_buffer_saturated FROM v_summary")
def contact_saturation(v: Views) -> DataFrame:
    return v.summary.select("frame", "contact_buffer_saturated")


@plan("SELECT motion_id, round(penetration, 9) AS penetration FROM v_scores")
def penetration(v: Views) -> DataFrame:
    return v.scores.select("motion_id", r9("penetration").alias("penetration"))


@plan("SELECT motion_id, round(self_collision, 9) AS self_collision FROM v_scores")
def self_collision(v: Views) -> DataFrame:
    return v.scores.select("motion_id", r9("self_collision").alias("self_collision"))


@plan("SELECT motion_id, frames, round(foot_sliding, 8) AS foot_sliding, round(velocity_violation, 8) AS velocity_violation, round(self_collision, 8) AS self_collision, round(jerk, 7) AS jerk, round(penetration, 8) AS penetration, round(floating_frames_ratio, 9) AS floating_frames_ratio, score AS physical_score FROM v_scores")
def physical_score(v: Views) -> DataFrame:
    each = [F.round(c, 8).alias(c) for c in ("foot_sliding", "velocity_violation", "self_collision", "penetration")]
    return v.scores.select("motion_id", "frames", *each, F.round("jerk", 7).alias("jerk"), r9("floating_frames_ratio").alias("floating_frames_ratio"), F.col("score").alias("physical_score"))


@plan("SELECT motion_id, score, CASE WHEN score >= 90 THEN 'kept' ELSE 'rejected' END AS status FROM v_scores")
def score_status(v: Views) -> DataFrame:
    return v.scores.select("motion_id", "score", checks.status(F.col("score")).alias("status"))


@plan("SELECT motion_id, score, row_number() OVER (ORDER BY score DESC, motion_id) AS place FROM v_scores")
def score_sorted(v: Views) -> DataFrame:
    return select.global_rank(v.scores.select("motion_id", "score", (-F.col("score")).alias("_s")), [F.col("_s"), F.col("motion_id")], "place").drop("_s")


LABEL = "CASE WHEN score >= 95 AND score < 100 OR abs(score - 100) <= 1e-7 THEN '100-95' WHEN score >= 90 AND score < 95 THEN '95-90' WHEN score >= 85 AND score < 90 THEN '90-85' WHEN score >= 80 AND score < 85 THEN '85-80' WHEN score >= 75 AND score < 80 THEN '80-75' WHEN score >= 70 AND score < 75 THEN '75-70' WHEN score >= 65 AND score < 70 THEN '70-65' WHEN score >= 60 AND score < 65 THEN '65-60' END"


@plan(f"SELECT label, count(*) AS n FROM (SELECT {LABEL} AS label FROM v_scores) WHERE label IS NOT NULL GROUP BY label")
def score_bins(v: Views) -> DataFrame:
    return v.scores.select(select.bin_label(F.col("score")).alias("label")).filter("label is not null").groupBy("label").agg(F.count("*").alias("n"))


@plan("SELECT CAST(least(floor(score / 5), 19) AS INTEGER) AS bin, count(*) AS n FROM v_scores WHERE score BETWEEN 0 AND 100 GROUP BY 1")
def score_histogram(v: Views) -> DataFrame:
    return select.histogram(v.scores, "score")


HASHED = f"SELECT *, row_number() OVER (PARTITION BY label ORDER BY sha256('42:' || label || ':' || CAST(motion_id AS VARCHAR)), motion_id) AS i FROM (SELECT motion_id, score, {LABEL} AS label FROM v_scores) WHERE label IS NOT NULL"


def _sample(v: Views) -> DataFrame:
    rows = v.scores.select("motion_id", "score", select.bin_label(F.col("score")).alias("label")).filter("label is not null")
    return select.stable_sample(rows, "label", "motion_id", 42, 10)


@plan(f"SELECT motion_id, score, label FROM ({HASHED}) WHERE i <= 10")
def stable_sample(v: Views) -> DataFrame:
    return _sample(v)


@plan(f"SELECT label || ': ' || CAST(motion_id AS VARCHAR) AS choice FROM ({HASHED}) WHERE i <= 10")
def bin_labels(v: Views) -> DataFrame:
    return _sample(v).select(F.concat_ws(": ", "label", F.col("motion_id").cast("string")).alias("choice"))


@plan("SELECT round(score, 1) AS score, count(*) AS n FROM v_scores GROUP BY round(score, 1) HAVING count(*) > 1")
def duplicate_keys(v: Views) -> DataFrame:
    return catalog.duplicates(v.scores.select(F.round("score", 1).alias("score")), "score")


@plan("SELECT 'clip_' || lpad(CAST(motion_id AS VARCHAR), 6, '0') || '.npz' AS filename FROM v_scores WHERE score >= 90")
def kept_filenames(v: Views) -> DataFrame:
    name = F.concat(F.lit("clip_"), F.lpad(F.col("motion_id").cast("string"), 6, "0"), F.lit(".npz"))
    return v.scores.filter(F.col("score") >= checks.KEPT_FROM).select(name.alias("filename"))


@plan("SELECT CAST(motion_id AS VARCHAR) AS motion, score FROM v_scores")
def score_json(v: Views) -> DataFrame:
    from cliploom.sources.tables import parse_scores

    rows = v.scores.select(F.struct(F.col("motion_id").cast("string").alias("motion"), F.col("score").cast("string").alias("physical_score")).alias("d"), (F.col("motion_id") % 16).alias("part"))
    text = rows.groupBy("part").agg(F.to_json(F.struct(F.collect_list("d").alias("details"))).alias("value"))
    return parse_scores(text).select("motion", F.col("physical_score").alias("score"))


@plan("SELECT c.c_custkey AS motion_id, c.c_name AS name, s.score, coalesce(CAST(s.score AS VARCHAR) <> '', false) AS scored FROM customer c LEFT JOIN v_scores s ON s.motion_id = c.c_custkey")
def score_lookup(v: Views) -> DataFrame:
    clips = v.table("customer").select(F.col("c_custkey").alias("motion_id"), F.col("c_name").alias("name"))
    return clips.join(v.scores.select("motion_id", "score"), "motion_id", "left").withColumn("scored", F.col("score").isNotNull())
