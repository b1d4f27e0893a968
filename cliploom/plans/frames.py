"""Plans over v_frames: one-channel clips of about 67 frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions import degrees_to_radians, integer_resampled_length, resampled_length, source_fps, window_length
from cliploom.operators import checks, kinematics, segments, serve
from cliploom.operators.datasets import ClipDataset, Router
from cliploom.plans.registry import plan
from cliploom.plans.rigid import VEL, moving
from cliploom.plans.views import FPS, Views, r9

HIGH = "x > 100"


@plan("SELECT motion_id, length, length < 60 AS too_short FROM v_lengths")
def check_too_short(v: Views) -> DataFrame:
    return v.lengths.select("motion_id", "length", (F.col("length") < 60).alias("too_short"))


@plan('SELECT motion_id, length, start, "end" FROM v_index')
def clip_index(v: Views) -> DataFrame:
    return v.index


QVEL = "SELECT motion_id, step, x, coalesce((lead(x) OVER w - x) * 50, (x - lag(x) OVER w) * 50, 0.0) AS q FROM v_frames WINDOW w AS (PARTITION BY motion_id ORDER BY step)"


@plan(f"SELECT motion_id, step, round(q, 6) + 0.0 AS qvel FROM ({QVEL})")
def qvel_scalar(v: Views) -> DataFrame:
    out = kinematics.with_velocity(v.frames, ["x"], FPS)
    return out.select("motion_id", "step", r9("x_vel", 6).alias("qvel"))


@plan(f"SELECT motion_id, round(CASE WHEN count(*) < 3 THEN 0.0 ELSE avg(q * q) + 0.05 * avg(a * a) END / 1e6, 6) AS complexity FROM (SELECT motion_id, q, (lead(q) OVER (PARTITION BY motion_id ORDER BY step) - q) * 50 AS a FROM ({QVEL})) GROUP BY motion_id")
def complexity(v: Views) -> DataFrame:
    out = kinematics.complexity(kinematics.with_velocity(v.frames, ["x"], FPS), ["x_vel"], FPS)
    return out.select("motion_id", F.round(F.col("complexity") / 1e6, 6).alias("complexity"))


@plan("SELECT motion_id, step, x, 0 AS child FROM v_frames WHERE motion_id % 2 = 0 UNION ALL SELECT motion_id, step, x, 1 AS child FROM v_frames WHERE motion_id % 2 = 1")
def concat_datasets(v: Views) -> DataFrame:
    part = lambda i: v.frames.filter(F.col("motion_id") % 2 == i).select("motion_id", "step", "x", F.lit(i).alias("child"))
    return part(0).unionByName(part(1))


RUNS = "SELECT motion_id, count(*) AS len, bool_or(f) AS f FROM (SELECT motion_id, f, step - row_number() OVER (PARTITION BY motion_id, f ORDER BY step) AS g FROM (SELECT *, x > 100 AS f FROM v_frames)) GROUP BY motion_id, f, g"


@plan(f"SELECT l.motion_id, coalesce(max(r.len), 0) AS longest_run, any_value(l.length) AS n FROM v_lengths l LEFT JOIN (SELECT * FROM ({RUNS}) WHERE f) r USING (motion_id) GROUP BY l.motion_id")
def longest_run(v: Views) -> DataFrame:
    return checks.longest_run(v.frames, F.expr(HIGH))


@plan(f"SELECT l.motion_id, round(coalesce(sum(greatest(r.len - 4, 0)), 0) / any_value(l.length), 9) AS ratio FROM v_lengths l LEFT JOIN (SELECT * FROM ({RUNS}) WHERE f) r USING (motion_id) GROUP BY l.motion_id")
def floating_ratio(v: Views) -> DataFrame:
    out = checks.sustained_ratio(v.frames, F.expr(HIGH), FPS, 0.1)
    return out.select("motion_id", r9("ratio").alias("ratio"))


FLAGS = f"""SELECT l.motion_id, coalesce(m.root, false) AS root_qvel_spike, coalesce(m.pos, false) AS joint_pos_spike, coalesce(m.vel, false) AS joint_vel_spike, coalesce(b.lin, false) AS body_lin_vel_spike,
    coalesce(b.ang, false) AS body_ang_vel_spike, l.length < 60 AS too_short, coalesce(b.most, 0) <= 1 AS no_dynamic_bodies, coalesce(b.run, 0) / 50.0 > 0.05 AS all_bodies_off_ground_too_long, coalesce(b.top <= 0.9, false) AS max_body_height_too_low
    FROM v_lengths l LEFT JOIN (SELECT motion_id, bool_or(abs(u0) > 780) AS root, bool_or(greatest(abs(j0), abs(j1)) > 16.2) AS pos, bool_or(greatest(abs(u0), abs(u1)) > 790) AS vel FROM ({VEL}) GROUP BY motion_id) m USING (motion_id)
    LEFT JOIN (SELECT motion_id, bool_or(lin) AS lin, bool_or(ang) AS ang, max(most) AS most, max(top) AS top, max(run) AS run FROM (SELECT *, CASE WHEN f THEN count(*) OVER (PARTITION BY motion_id, f, g) ELSE 0 END AS run FROM (
    SELECT *, n - row_number() OVER (PARTITION BY motion_id, f ORDER BY n) AS g FROM (SELECT *, row_number() OVER (PARTITION BY motion_id ORDER BY step) AS n FROM (SELECT motion_id, step, min(z) > 0.2 AS f, max(z) AS top, count(*) AS most,
    bool_or(round(sqrt(vx * vx + vy * vy + vz * vz), 9) > 12.5) AS lin, bool_or(round(sqrt(vy * vy + vx * vx), 9) > 12) AS ang FROM v_bodies GROUP BY motion_id, step)))) GROUP BY motion_id) b USING (motion_id)"""


def _reasons(v: Views) -> DataFrame:
    """Every check of a clip: joints from its frames, bodies from those of the same motion; a clip without bodies has none."""
    joints = moving(v).groupBy("motion_id").agg(
        checks.spike([F.col("u0")], 780).alias("root_qvel_spike"), checks.spike([F.col("j0"), F.col("j1")], 16.2).alias("joint_pos_spike"),
        checks.spike([F.col("u0"), F.col("u1")], 790).alias("joint_vel_spike"), F.count("*").alias("n"),
    )
    square = lambda *names: F.round(F.sqrt(sum((F.col(c) ** 2 for c in names), F.lit(0.0))), 9)
    steps = v.bodies.groupBy("motion_id", "step").agg(
        F.min("z").alias("low"), F.max("z").alias("top"), F.count("*").alias("most"),
        checks.spike([square("vx", "vy", "vz")], 12.5).alias("lin"), checks.spike([square("vy", "vx")], 12).alias("ang"),
    )
    runs = checks.longest_run(steps, F.col("low") > checks.GROUND).drop("n")
    bodies = steps.groupBy("motion_id").agg(F.bool_or("lin").alias("body_lin_vel_spike"), F.bool_or("ang").alias("body_ang_vel_spike"), F.max("most").alias("most"), F.max("top").alias("top"))
    held = joints.join(bodies.join(runs, "motion_id"), "motion_id", "left")
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("root_qvel_spike", "joint_pos_spike", "joint_vel_spike", "body_lin_vel_spike", "body_ang_vel_spike")}
    flags |= {"too_short": F.col("n") < 60, "no_dynamic_bodies": F.coalesce("most", F.lit(0)) <= 1}
    flags |= {"all_bodies_off_ground_too_long": F.coalesce("longest_run", F.lit(0)) / FPS > 0.05, "max_body_height_too_low": F.coalesce(F.col("top") <= 0.9, F.lit(False))}
    return held.select("motion_id", checks.reasons(flags).alias("reasons"))


NAMED = ", ".join(f"CASE WHEN {r} THEN '{r}' END" for r in checks.REASONS)


@plan(f"SELECT motion_id, concat_ws(',', {NAMED}) AS reasons, NOT ({' OR '.join(checks.REASONS)}) AS is_valid FROM ({FLAGS})")
def filter_reasons(v: Views) -> DataFrame:
    return _reasons(v).select("motion_id", F.array_join("reasons", ",").alias("reasons"), (F.size("reasons") == 0).alias("is_valid"))


EACH = f"SELECT motion_id, unnest(list_filter([{NAMED}], lambda r: r IS NOT NULL)) AS reason FROM ({FLAGS})"


@plan(f"SELECT reason, count(*) AS n FROM ({EACH}) GROUP BY reason")
def reason_counts(v: Views) -> DataFrame:
    return checks.reason_counts(_reasons(v))


@plan(f"SELECT coalesce(reason, 'all') AS reason, coalesce(parity, -1) AS parity, count(*) AS n FROM (SELECT reason, motion_id % 2 AS parity FROM ({EACH})) GROUP BY ROLLUP (reason, parity)")
def rollup_reasons(v: Views) -> DataFrame:
    each = _reasons(v).select(F.explode("reasons").alias("reason"), (F.col("motion_id") % 2).alias("parity"))
    out = each.rollup("reason", "parity").agg(F.count("*").alias("n"))
    return out.select(F.coalesce("reason", F.lit("all")).alias("reason"), F.coalesce("parity", F.lit(-1).cast("long")).alias("parity"), "n")


@plan("SELECT motion_id, step, x FROM v_frames WHERE step >= 5 AND step < 60 AND (step - 5) % 3 = 0")
def frame_slice(v: Views) -> DataFrame:
    return v.frames.filter("step >= 5 and step < 60 and (step - 5) % 3 = 0").select("motion_id", "step", "x")


@plan("SELECT l_orderkey * 7 % t.total AS frame_id, count(*) AS hits, any_value(i.motion_id) AS motion_id, any_value(l_orderkey * 7 % t.total - i.start) AS step FROM lineitem, (SELECT max(\"end\") AS total FROM v_index) t JOIN v_index i ON l_orderkey * 7 % t.total >= i.start AND l_orderkey * 7 % t.total < i.\"end\" GROUP BY 1")
def frame_to_clip(v: Views) -> DataFrame:
    total = v.index.agg(F.max("end").alias("total"))
    ids = v.table("lineitem").join(F.broadcast(total)).select((F.col("l_orderkey") * 7 % F.col("total")).alias("frame_id"))
    ids = ids.groupBy("frame_id").agg(F.count("*").alias("hits"))
    return serve.frame_to_clip(ids, v.index, "frame_id").select("frame_id", "hits", "motion_id", "step")


REQUESTS = "SELECT o_orderkey AS env, o_custkey % 150 AS motion_id, o_orderkey % 70 AS start_t FROM orders"


def _requests(v: Views) -> DataFrame:
    return v.table("orders").select(F.col("o_orderkey").alias("env"), (F.col("o_custkey") % 150).alias("motion_id"), (F.col("o_orderkey") % 70).alias("start_t"))


@plan(f"SELECT q.env, q.motion_id, CAST(o.o AS INTEGER) AS \"offset\", f.step, f.x FROM ({REQUESTS}) q CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS o) o JOIN v_lengths l USING (motion_id) JOIN v_frames f ON f.motion_id = q.motion_id AND f.step = greatest(0, least(q.start_t + o.o, l.length - 1))")
def get_slice(v: Views) -> DataFrame:
    return serve.get_slice(_requests(v), [0, 1, 2, 3], v.lengths, v.frames).select("env", "motion_id", "offset", "step", "x")


@plan(f"SELECT q.env, q.motion_id, CAST(o.o AS INTEGER) AS \"offset\", f.step, f.x FROM ({REQUESTS}) q CROSS JOIN (SELECT unnest([0, 5]) AS o) o JOIN v_lengths l USING (motion_id) JOIN v_frames f ON f.motion_id = q.motion_id AND f.step = greatest(0, least(q.start_t + o.o, l.length - 1))")
def routed_slices(v: Views) -> DataFrame:
    """Slices through a router over two datasets, whose ids run on from one to the other."""
    part = lambda low, high: ClipDataset(v.frames.filter((F.col("motion_id") >= low) & (F.col("motion_id") < high)).withColumn("motion_id", F.col("motion_id") - low))
    whole = Router([part(0, 60), part(60, 1 << 40)])
    return whole.get_slice(_requests(v), [0, 5]).select("env", "motion_id", "offset", "step", "x")


CENTRES = "SELECT motion_id, length, CAST(unnest(range(0, length - 20, 3)) AS BIGINT) + 10 AS centre FROM v_lengths WHERE length > 20"
WINDOWS = f"SELECT w.motion_id, w.window_id, CAST(p.pos AS INTEGER) AS pos, f.step, f.x FROM (SELECT motion_id, (centre - 10) // 3 AS window_id, centre FROM ({CENTRES})) w CROSS JOIN (SELECT unnest(range(0, 11)) AS pos) p JOIN v_frames f ON f.motion_id = w.motion_id AND f.step = w.centre + (p.pos - 5) * 2"


@plan(f"SELECT motion_id, CAST(window_id AS INTEGER) AS window_id, pos, step, round(x, 9) AS x FROM ({WINDOWS})")
def hme_windows(v: Views) -> DataFrame:
    return kinematics.windows(v.frames, 11, 2, 3).select("motion_id", "window_id", "pos", "step", r9("x").alias("x"))


@plan(
    f"""SELECT motion_id, CAST(window_id AS INTEGER) AS window_id, round(2 * sqrt(sum(p) + 1e-8) / 11, 6) AS amp, round(sum(k / 4.0 * p) / (sum(p) + 1e-8), 6) AS freq, round(max(s) / 11, 6) AS "offset" FROM (
    SELECT motion_id, window_id, k, pow(sum(x * cos(2 * pi() * k * pos / 11)), 2) + pow(sum(x * sin(2 * pi() * k * pos / 11)), 2) AS p, sum(x) AS s FROM ({WINDOWS}) CROSS JOIN (SELECT unnest(range(1, 6)) AS k) GROUP BY ALL) GROUP BY ALL"""
)
def fft_params(v: Views) -> DataFrame:
    rows = kinematics.windows(v.frames, 11, 2, 3)
    out = kinematics.spectrum(rows, ["x"], 11, 4.0, ["motion_id", "window_id"])
    return out.select("motion_id", "window_id", r9("amp_x", 6).alias("amp"), r9("freq_x", 6).alias("freq"), r9("offset_x", 6).alias("offset"))


@plan("SELECT motion_id, CAST(w AS INTEGER) AS window_id, CAST(p AS INTEGER) AS pos, CAST(greatest(0, least(c + (p - 20) * 2, length - 1)) AS BIGINT) AS step FROM (SELECT motion_id, length, unnest(CASE WHEN length > 80 THEN range(40, length - 40) ELSE [length // 2] END) AS c, unnest(range(greatest(length - 80, 1))) AS w FROM v_lengths) CROSS JOIN (SELECT unnest(range(41)) AS p)")
def window_fallback(v: Views) -> DataFrame:
    return kinematics.window_index(v.lengths, 41, 2, 1, fallback=True)


@plan("SELECT src_start, src_end, CAST(dst_start AS BIGINT) AS dst_start, CAST(dst_start + src_end - src_start AS BIGINT) AS dst_end FROM (SELECT min(id) AS src_start, max(id) + 1 AS src_end, min(n) AS dst_start FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS n FROM (SELECT DISTINCT step * 3 // 2 AS id FROM v_frames WHERE step % 5 <> 2)) GROUP BY id - n)")
def id_runs(v: Views) -> DataFrame:
    ids = v.frames.filter("step % 5 <> 2").select(F.expr("step * 3 div 2").alias("id")).distinct()
    return segments.id_runs(ids, "id")


@plan("SELECT motion_id, length FROM v_lengths ORDER BY motion_id LIMIT 20 OFFSET 10")
def offset_limit(v: Views) -> DataFrame:
    return v.lengths.orderBy("motion_id").offset(10).limit(20)


@plan(
    """SELECT motion_id, t.i AS step, round(a.x * (1 - (t.i * 12 - r0 * 5) / 5.0) + b.x * ((t.i * 12 - r0 * 5) / 5.0), 9) AS x FROM (
    SELECT motion_id, length, i, greatest(least(CAST(ceil(i * 12 / 5.0) AS BIGINT), length - 1), 1) - 1 AS r0 FROM (SELECT motion_id, length, CAST(unnest(range((length - 1) * 5 // 12 + 1)) AS BIGINT) AS i FROM v_lengths WHERE length > 1)) t
    JOIN v_frames a USING (motion_id) JOIN v_frames b USING (motion_id) WHERE a.step = r0 AND b.step = r0 + 1 UNION ALL SELECT f.motion_id, f.step, round(f.x, 9) FROM v_frames f JOIN v_lengths l USING (motion_id) WHERE l.length = 1"""
)
def resample_lerp(v: Views) -> DataFrame:
    return kinematics.resample(v.frames, 12, 5, ["x"]).select("motion_id", "step", r9("x").alias("x"))


@plan("SELECT motion_id, length, CASE WHEN length = 1 THEN 1 ELSE CAST(floor((length - 1) / 120.0 * 50 + 1e-9) AS BIGINT) + 1 END AS resampled, (length - 1) * 50 // 120 + 1 AS whole FROM v_lengths", name="resampled_length")
def resampled(v: Views) -> DataFrame:
    return v.lengths.select("motion_id", "length", resampled_length(F.col("length"), 120, 50).alias("resampled"), integer_resampled_length(F.col("length"), 120, 50).alias("whole"))


DRAW = "CAST(('0x' || substr(sha256('{seed}:' || CAST({env} AS VARCHAR)), 1, 12)) AS BIGINT) % t.total"
DRAWN = f"SELECT r.env, i.motion_id, r.frame_id, r.frame_id - i.start AS start_t FROM (SELECT q.env, {DRAW.format(seed=42, env='q.env')} AS frame_id FROM ({REQUESTS}) q, (SELECT max(\"end\") AS total FROM v_index) t) r JOIN v_index i ON r.frame_id >= i.start AND r.frame_id < i.\"end\""


def _drawn(v: Views) -> DataFrame:
    return serve.uniform_frames(_requests(v).select("env"), v.index, "env", 42)


@plan(f"SELECT env, motion_id, frame_id, start_t FROM ({DRAWN})")
def uniform_frames(v: Views) -> DataFrame:
    return _drawn(v).select("env", "motion_id", "frame_id", "start_t")


@plan(f"SELECT q.env, CASE WHEN q.env % 3 = 0 THEN q.motion_id ELSE d.motion_id END AS motion_id, l.length AS motion_len, CASE WHEN q.env % 3 = 0 THEN greatest(q.start_t - 25, 0) ELSE d.start_t END AS start_t FROM ({REQUESTS}) q JOIN ({DRAWN}) d USING (env) JOIN v_lengths l ON l.motion_id = CASE WHEN q.env % 3 = 0 THEN q.motion_id ELSE d.motion_id END")
def rewind_sample(v: Views) -> DataFrame:
    held = _requests(v)
    asked = held.select("env", (F.col("env") % 3 == 0).alias("rewind"), F.col("start_t").alias("terminated_t"), F.lit(25).alias("rewind_steps"))
    return serve.rewind_sample(asked, _drawn(v), held, v.lengths, "env")


@plan(f"SELECT d.env, d.motion_id, least(d.start_t, greatest(l.length - 32, 0)) AS start_t, CAST(p AS INTEGER) AS \"offset\", f.step, f.x FROM ({DRAWN}) d JOIN v_lengths l USING (motion_id) CROSS JOIN (SELECT unnest([0, 15, 31, 40]) AS p) JOIN v_frames f ON f.motion_id = d.motion_id AND f.step = greatest(0, least(least(d.start_t, greatest(l.length - 32, 0)) + p, l.length - 1))")
def window_pool(v: Views) -> DataFrame:
    starts = serve.window_starts(_drawn(v).select("env", "motion_id", "start_t"), v.lengths, 32)
    return serve.get_slice(starts, [0, 15, 31, 40], v.lengths, v.frames).select("env", "motion_id", "start_t", "offset", "step", "x")


@plan("SELECT o_orderkey AS env, o_custkey % 400 AS id, CASE WHEN o_custkey % 400 >= 250 THEN 2 WHEN o_custkey % 400 >= 100 THEN 1 ELSE 0 END AS child, CAST(o_custkey % 400 - CASE WHEN o_custkey % 400 >= 250 THEN 250 WHEN o_custkey % 400 >= 100 THEN 100 ELSE 0 END AS BIGINT) AS child_id FROM orders WHERE o_custkey % 400 < 390")
def route_ids(v: Views) -> DataFrame:
    asked = v.table("orders").select(F.col("o_orderkey").alias("env"), (F.col("o_custkey") % 400).alias("id"))
    return serve.route(asked, [100, 150, 140], "id").withColumn("child_id", F.col("child_id").cast("long"))


BOUNDS = """WITH RECURSIVE n AS (SELECT "end", start, row_number() OVER (ORDER BY motion_id) AS c, count(*) OVER () AS clips, max("end") OVER () AS total FROM v_index),
    b(i, c) AS (SELECT 0, CAST(0 AS BIGINT) UNION ALL SELECT i + 1, (SELECT n.c FROM n WHERE n.c BETWEEN b.c + 1 AND n.clips - (8 - (b.i + 1)) ORDER BY abs(n."end" * 8 - n.total * (b.i + 1)), n.c LIMIT 1) FROM b WHERE i + 1 < 8)"""


@plan(f"{BOUNDS} SELECT CAST(i AS INTEGER) AS i, c AS clips, coalesce((SELECT \"end\" FROM n WHERE n.c = b.c), 0) AS frames FROM b UNION ALL SELECT 8, max(c), max(total) FROM n")
def shard_boundaries(v: Views) -> DataFrame:
    found = segments.shard_boundaries(v.index, 8)
    return v.spark.createDataFrame([(i, *b) for i, b in enumerate(found)], "i int, clips long, frames long")


@plan(f"{BOUNDS}, e AS (SELECT b.i, coalesce((SELECT \"end\" FROM n WHERE n.c = b.c), 0) AS fr FROM b) SELECT motion_id, length, CAST(s AS INTEGER) AS shard, start - (SELECT fr FROM e WHERE e.i = s) AS start, \"end\" - (SELECT fr FROM e WHERE e.i = s) AS \"end\" FROM (SELECT x.*, (SELECT max(i) FROM e WHERE e.fr <= x.start) AS s FROM v_index x)")
def shard_assign(v: Views) -> DataFrame:
    return serve.assign_shards(v.index, segments.shard_boundaries(v.index, 8))


@plan("SELECT motion_id, round(CASE WHEN motion_id % 4 > 0 THEN CAST(motion_id % 4 * 30 AS DOUBLE) ELSE 1 / (0.01 + motion_id / 1e4) END, 9) AS fps FROM v_lengths", name="source_fps")
def fps_of_source(v: Views) -> DataFrame:
    fps = source_fps((F.col("motion_id") % 4 * 30).cast("double"), 0.01 + F.col("motion_id") / 1e4)
    return v.lengths.select("motion_id", r9(fps).alias("fps"))


@plan("SELECT motion_id, step, round(x * 0.01, 9) AS metres, round(radians(k * 1.0), 9) AS angle FROM v_frames")
def unit_scale(v: Views) -> DataFrame:
    return v.frames.select("motion_id", "step", r9(F.col("x") * 0.01).alias("metres"), r9(degrees_to_radians(F.col("k").cast("double"), "degrees")).alias("angle"))


@plan("SELECT CAST(n AS INTEGER) + 1 - CAST(n AS INTEGER) % 2 AS n, seconds, downsample FROM (SELECT floor(s * 50 / d) + 1 AS n, CAST(s AS DOUBLE) AS seconds, CAST(d AS INTEGER) AS downsample FROM (SELECT unnest([1.0, 2.5, 4.0]) AS s) CROSS JOIN (SELECT unnest([1, 5, 7]) AS d))")
def win_len(v: Views) -> DataFrame:
    rows = [(window_length(s, 50, d), s, d) for s in (1.0, 2.5, 4.0) for d in (1, 5, 7)]
    return v.spark.createDataFrame(rows, "n int, seconds double, downsample int")
