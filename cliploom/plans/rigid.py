"""Plans over v_rigid: clips of a free body with two joints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions import angle_between, axis_angle, euler, multiply, normalize, reorder_xyzw, rot6d, rotate, yaw
from cliploom.operators import autoencoder, checks, kinematics, learn, physics
from cliploom.plans.registry import plan
from cliploom.plans.views import FPS, Views, r9

Q = ("qw", "qx", "qy", "qz")
POS = ("px", "py", "pz")
W_ = "WINDOW w AS (PARTITION BY motion_id ORDER BY step)"


def q(prefix: str = "q") -> tuple:
    return tuple(F.col(f"{prefix}{c}") for c in "wxyz")


def named(values, *names: str, places: int = 9) -> list:
    return [r9(v, places).alias(n) for v, n in zip(values, names, strict=True)]


@plan("SELECT motion_id, step, round(cos(k / 40.0), 9) + 0.0 AS w, 0.0 + round(sin(k / 40.0), 9) AS x, CAST(0 AS DOUBLE) AS y, CAST(0 AS DOUBLE) AS z FROM v_frames", name="axis_angle")
def about_axis(v: Views) -> DataFrame:
    return v.frames.select("motion_id", "step", *named(axis_angle("x", F.col("k") / 20), *"wxyz"))


MUL = "round(qw * cos(k / 40.0) - qx * sin(k / 40.0), 9) + 0.0 AS w, round(qw * sin(k / 40.0) + qx * cos(k / 40.0), 9) + 0.0 AS x, round(qy * cos(k / 40.0) + qz * sin(k / 40.0), 9) + 0.0 AS y, round(qz * cos(k / 40.0) - qy * sin(k / 40.0), 9) + 0.0 AS z"


@plan(f"SELECT r.motion_id, r.step, {MUL} FROM v_rigid r JOIN v_frames f USING (motion_id, step)")
def quat_mul(v: Views) -> DataFrame:
    return v.rigid.select("motion_id", "step", *named(multiply(q(), axis_angle("x", F.col("j1") * 2)), *"wxyz"))


SCALED = "SELECT motion_id, step, qw * j0 AS qw, qx * j0 AS qx, qy * j0 AS qy, qz * j0 AS qz FROM v_rigid"


@plan(f"SELECT motion_id, step, round(qw / n, 9) + 0.0 AS w, round(qx / n, 9) + 0.0 AS x, round(qy / n, 9) + 0.0 AS y, round(qz / n, 9) + 0.0 AS z FROM (SELECT *, greatest(sqrt(qw * qw + qx * qx + qy * qy + qz * qz), 1e-8) AS n FROM ({SCALED}))")
def quat_normalize(v: Views) -> DataFrame:
    return v.rigid.select("motion_id", "step", *named(normalize(tuple(c * F.col("j0") for c in q())), *"wxyz"))


@plan("SELECT motion_id, step, round(qz, 9) + 0.0 AS w, round(qw, 9) + 0.0 AS x, round(qx, 9) + 0.0 AS y, round(qy, 9) + 0.0 AS z FROM v_rigid")
def quat_reorder(v: Views) -> DataFrame:
    return v.rigid.select("motion_id", "step", *named(reorder_xyzw(q()), *"wxyz"))


# A unit quaternion's rotation matrix, for the oracles.
M = "1 - 2 * (qy * qy + qz * qz) AS m00, 2 * (qx * qy - qw * qz) AS m01, 2 * (qx * qz + qw * qy) AS m02, 2 * (qx * qy + qw * qz) AS m10, 1 - 2 * (qx * qx + qz * qz) AS m11, 2 * (qy * qz - qw * qx) AS m12, 2 * (qx * qz - qw * qy) AS m20, 2 * (qy * qz + qw * qx) AS m21, 1 - 2 * (qx * qx + qy * qy) AS m22"


@plan(f"SELECT motion_id, step, round(m00 * px + m01 * py + m02 * pz, 6) + 0.0 AS x, round(m10 * px + m11 * py + m12 * pz, 6) + 0.0 AS y, round(m20 * px + m21 * py + m22 * pz, 6) + 0.0 AS z, round(m00 * px + m10 * py + m20 * pz, 6) + 0.0 AS back_x FROM (SELECT *, {M} FROM v_rigid)")
def quat_rotate(v: Views) -> DataFrame:
    p = tuple(F.col(c) for c in POS)
    return v.rigid.select("motion_id", "step", *named(rotate(q(), p), *"xyz", places=6), r9(rotate(q(), p, inverse=True)[0], 6).alias("back_x"))


@plan("SELECT motion_id, step, round(atan2(2 * (qw * qz + qx * qy), 1 - 2 * (qy * qy + qz * qz)), 7) + 0.0 AS yaw FROM v_rigid", name="yaw")
def heading(v: Views) -> DataFrame:
    return v.rigid.select("motion_id", "step", r9(yaw(q()), 7).alias("yaw"))


@plan(f"SELECT motion_id, step, round(m00, 9) + 0.0 AS a0, round(m10, 9) + 0.0 AS a1, round(m20, 9) + 0.0 AS a2, round(m01, 9) + 0.0 AS b0, round(m11, 9) + 0.0 AS b1, round(m21, 9) + 0.0 AS b2 FROM (SELECT *, {M} FROM v_rigid)", name="rot6d")
def rotation_columns(v: Views) -> DataFrame:
    return v.rigid.select("motion_id", "step", *named(rot6d(q()), "a0", "a1", "a2", "b0", "b1", "b2"))


@plan(
    """SELECT motion_id, step, round(cx * cy * cz + sx * sy * sz, 9) + 0.0 AS w, round(sx * cy * cz - cx * sy * sz, 9) + 0.0 AS x, round(cx * sy * cz + sx * cy * sz, 9) + 0.0 AS y, round(cx * cy * sz - sx * sy * cz, 9) + 0.0 AS z
    FROM (SELECT motion_id, step, cos(x / 60) AS cx, sin(x / 60) AS sx, cos(k / 50.0) AS cy, sin(k / 50.0) AS sy, cos(x / 500) AS cz, sin(x / 500) AS sz FROM v_frames)"""
)
def euler_to_quat(v: Views) -> DataFrame:
    angles = (F.col("x") / 30, F.col("k") / 25, F.col("x") / 250)
    return v.frames.select("motion_id", "step", *named(euler(angles), *"wxyz"))


@plan("SELECT motion_id, step, round(px, 9) AS q0, round(py, 9) AS q1, round(pz, 9) AS q2, round(qz / n, 9) + 0.0 AS q3, round(qw / n, 9) + 0.0 AS q4, round(qx / n, 9) + 0.0 AS q5, round(qy / n, 9) + 0.0 AS q6, round(j0, 9) AS q7, round(j1, 9) AS q8 FROM (SELECT *, sqrt(qw * qw + qx * qx + qy * qy + qz * qz) AS n FROM v_rigid)")
def gmr_qpos(v: Views) -> DataFrame:
    out = physics.gmr_to_qpos(v.rigid, [F.col(c) for c in POS], [F.col(c) for c in Q], [F.col("j0"), F.col("j1")])
    return out.select("motion_id", "step", *[r9(F.col("qpos")[i]).alias(f"q{i}") for i in range(9)])


@plan("SELECT motion_id, step, round(px / 100, 9) AS q0, round(py / 100, 9) AS q1, round(pz / 100, 9) AS q2, round(qw, 9) + 0.0 AS q3, round(qx, 9) + 0.0 AS q4, round(qy, 9) + 0.0 AS q5, round(qz, 9) + 0.0 AS q6, round(radians(j1), 9) AS q7, round(radians(j0), 9) AS q8 FROM v_rigid")
def qpos_assemble(v: Views) -> DataFrame:
    qpos = F.array(*[F.col(c) * 0.01 for c in POS], *[F.col(c) for c in Q], F.radians("j1"), F.radians("j0"))
    return v.rigid.select("motion_id", "step", qpos.alias("qpos")).select("motion_id", "step", *[r9(F.col("qpos")[i]).alias(f"q{i}") for i in range(9)])


DIFF = f"""SELECT motion_id, step, qw * nw + qx * nx + qy * ny + qz * nz AS dw, qw * nx - qx * nw - qy * nz + qz * ny AS dx, qw * ny + qx * nz - qy * nw - qz * nx AS dy, qw * nz - qx * ny + qy * nx - qz * nw AS dz
    FROM (SELECT *, lead(qw) OVER w AS nw, lead(qx) OVER w AS nx, lead(qy) OVER w AS ny, lead(qz) OVER w AS nz FROM v_rigid {W_})"""
SPEED = f"SELECT motion_id, step, CASE WHEN s < 1e-15 THEN 1 ELSE dx / s END * a AS x, CASE WHEN s < 1e-15 THEN 0 ELSE dy / s END * a AS y, CASE WHEN s < 1e-15 THEN 0 ELSE dz / s END * a AS z FROM (SELECT *, CASE WHEN 2 * atan2(s, dw) > pi() THEN 2 * atan2(s, dw) - 2 * pi() ELSE 2 * atan2(s, dw) END * 50 AS a FROM (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS s FROM ({DIFF})))"


@plan(f"SELECT motion_id, step, round(coalesce(x, lag(x) OVER w, 0.0), 5) + 0.0 AS wx, round(coalesce(y, lag(y) OVER w, 0.0), 5) + 0.0 AS wy, round(coalesce(z, lag(z) OVER w, 0.0), 5) + 0.0 AS wz FROM ({SPEED}) {W_}")
def qvel_quat(v: Views) -> DataFrame:
    out = kinematics.with_angular_velocity(v.rigid, Q, FPS)
    return out.select("motion_id", "step", *[r9(c, 5).alias(c) for c in ("wx", "wy", "wz")])


VEL = f"SELECT *, coalesce((lead(px) OVER w - px) * 50, (px - lag(px) OVER w) * 50, 0.0) AS vx, coalesce((lead(py) OVER w - py) * 50, (py - lag(py) OVER w) * 50, 0.0) AS vy, CAST(0 AS DOUBLE) AS vz, coalesce((lead(j0) OVER w - j0) * 50, (j0 - lag(j0) OVER w) * 50, 0.0) AS u0, coalesce((lead(j1) OVER w - j1) * 50, (j1 - lag(j1) OVER w) * 50, 0.0) AS u1 FROM v_rigid {W_}"


def moving(v: Views) -> DataFrame:
    out = kinematics.with_velocity(v.rigid, ["px", "py", "pz", "j0", "j1"], FPS)
    return out.withColumnsRenamed({"px_vel": "vx", "py_vel": "vy", "pz_vel": "vz", "j0_vel": "u0", "j1_vel": "u1"})


LOCAL = f"SELECT *, m00 * vx + m10 * vy + m20 * vz AS lx, m01 * vx + m11 * vy + m21 * vz AS ly, m02 * vx + m12 * vy + m22 * vz AS lz FROM (SELECT *, {M} FROM ({VEL}))"


@plan(f"SELECT motion_id, step, round(lx, 5) + 0.0 AS lx, round(ly, 5) + 0.0 AS ly, round(lz, 5) + 0.0 AS lz FROM ({LOCAL})")
def root_vel_local(v: Views) -> DataFrame:
    out = kinematics.local_root_velocity(moving(v), ("vx", "vy", "vz"), Q, ("lx", "ly", "lz"))
    return out.select("motion_id", "step", *[r9(c, 5).alias(c) for c in ("lx", "ly", "lz")])


RAW = ("j0", "j1", "u0", "u1", *POS, *Q, "lx", "ly", "lz", "wx", "wy", "wz")


@plan(
    f"SELECT motion_id, step, CAST(pos AS INTEGER) AS pos, round(value, 5) + 0.0 AS value FROM (SELECT l.motion_id, l.step, unnest(range(17)) AS pos, unnest([j0, j1, u0, u1, px, py, pz, qw, qx, qy, qz, lx, ly, lz, a.wx, a.wy, a.wz]) AS value FROM ({LOCAL}) l JOIN (SELECT motion_id, step, coalesce(x, lag(x) OVER w, 0.0) AS wx, coalesce(y, lag(y) OVER w, 0.0) AS wy, coalesce(z, lag(z) OVER w, 0.0) AS wz FROM ({SPEED}) {W_}) a USING (motion_id, step))"
)
def frame_features(v: Views) -> DataFrame:
    rows = kinematics.with_angular_velocity(moving(v), Q, FPS)
    rows = kinematics.local_root_velocity(rows, ("vx", "vy", "vz"), Q, ("lx", "ly", "lz"))
    out = rows.select("motion_id", "step", F.posexplode(F.array(*RAW)).alias("pos", "value"))
    return out.withColumn("value", r9("value", 5))


WIN = "SELECT w.motion_id, CAST(w.c // 4 AS INTEGER) AS window_id, CAST(p.pos AS INTEGER) AS pos, f.* EXCLUDE (motion_id) FROM (SELECT motion_id, unnest(range(0, length - 20, 4)) AS c FROM v_lengths WHERE length > 20) w CROSS JOIN (SELECT unnest(range(0, 11)) AS pos) p JOIN v_rigid f ON f.motion_id = w.motion_id AND f.step = w.c + 10 + (p.pos - 5) * 2"


def windows(v: Views) -> DataFrame:
    """Windows of v.rigid; what follows from x and k is made last, so that only these two are moved, sorted and held."""
    return v.posed(kinematics.windows(v.frames, 11, 2, 4))


@plan(
    f"""SELECT motion_id, window_id, pos, round(cos(yaw) * dx + sin(yaw) * dy, 6) + 0.0 AS root_0, round(cos(yaw) * dy - sin(yaw) * dx, 6) + 0.0 AS root_1, round(dz, 6) + 0.0 AS root_2,
    round(cos(yaw) * m00 + sin(yaw) * m10, 6) + 0.0 AS root_3, round(cos(yaw) * m10 - sin(yaw) * m00, 6) + 0.0 AS root_4, round(m20, 6) + 0.0 AS root_5, round(cos(yaw) * m01 + sin(yaw) * m11, 6) + 0.0 AS root_6, round(cos(yaw) * m11 - sin(yaw) * m01, 6) + 0.0 AS root_7, round(m21, 6) + 0.0 AS root_8
    FROM (SELECT *, {M}, px - first(px) OVER w AS dx, py - first(py) OVER w AS dy, pz - first(pz) OVER w AS dz, atan2(2 * (first(qw) OVER w * first(qz) OVER w + first(qx) OVER w * first(qy) OVER w), 1 - 2 * (first(qy) OVER w * first(qy) OVER w + first(qz) OVER w * first(qz) OVER w)) AS yaw FROM ({WIN}) WINDOW w AS (PARTITION BY motion_id, window_id ORDER BY pos))"""
)
def heading_frame(v: Views) -> DataFrame:
    rows = kinematics.windows_with_first(v.frames, ["x", "k"], 11, 2, 4)
    out = kinematics.seen_from(v.posed(v.posed(rows), "first_"), POS, Q, "first_")
    return out.select("motion_id", "window_id", "pos", *[r9(f"root_{i}", 6).alias(f"root_{i}") for i in range(9)])


STATS = f"SELECT avg(j0) AS m0, greatest(sqrt(greatest(avg(j0 * j0) - avg(j0) * avg(j0), 1e-12)), 1e-6) AS s0, avg(j1) AS m1, greatest(sqrt(greatest(avg(j1 * j1) - avg(j1) * avg(j1), 1e-12)), 1e-6) AS s1, avg(px) AS m2, greatest(sqrt(greatest(avg(px * px) - avg(px) * avg(px), 1e-12)), 1e-6) AS s2 FROM ({WIN})"


@plan(f"SELECT 0 AS channel, round(m0, 8) AS mean, round(s0, 8) AS std FROM ({STATS}) UNION ALL SELECT 1, round(m1, 8), round(s1, 8) FROM ({STATS}) UNION ALL SELECT 2, round(m2, 8), round(s2, 8) FROM ({STATS})")
def feature_stats(v: Views) -> DataFrame:
    return kinematics.feature_stats(windows(v), ["j0", "j1", "px"]).select("channel", r9("mean", 8).alias("mean"), r9("std", 8).alias("std"))


@plan(f"SELECT motion_id, window_id, pos, round((j0 - m0) / s0, 7) + 0.0 AS j0, round((j1 - m1) / s1, 7) + 0.0 AS j1, round((px - m2) / s2, 7) + 0.0 AS px FROM ({WIN}), ({STATS})")
def hme_window_norm(v: Views) -> DataFrame:
    out = kinematics.normalized(windows(v), ["j0", "j1", "px"])
    return out.select("motion_id", "window_id", "pos", *[r9(c, 7).alias(c) for c in ("j0", "j1", "px")])


@plan(
    f"""SELECT motion_id, CAST(pos AS INTEGER) AS pos, round(avg(value), 6) + 0.0 AS value FROM (SELECT motion_id, unnest(range(4)) AS pos, unnest([a0, f0, a1, f1]) AS value FROM (
    SELECT motion_id, window_id, 2 * sqrt(sum(p0) + 1e-8) / 11 AS a0, sum(k / 4.0 * p0) / (sum(p0) + 1e-8) AS f0, 2 * sqrt(sum(p1) + 1e-8) / 11 AS a1, sum(k / 4.0 * p1) / (sum(p1) + 1e-8) AS f1 FROM (
    SELECT motion_id, window_id, k, pow(sum(j0 * cos(2 * pi() * k * pos / 11)), 2) + pow(sum(j0 * sin(2 * pi() * k * pos / 11)), 2) AS p0, pow(sum(j1 * cos(2 * pi() * k * pos / 11)), 2) + pow(sum(j1 * sin(2 * pi() * k * pos / 11)), 2) AS p1 FROM ({WIN}) CROSS JOIN (SELECT unnest(range(1, 6)) AS k) GROUP BY ALL) GROUP BY ALL)) GROUP BY ALL"""
)
def mean_embedding(v: Views) -> DataFrame:
    each = kinematics.spectrum(windows(v), ["j0", "j1"], 11, 4.0, ["motion_id", "window_id"])
    return learn.mean_embedding(each, ["amp_j0", "freq_j0", "amp_j1", "freq_j1"], "motion_id").withColumn("value", r9("value", 6))


@plan()
def hme_encode(v: Views) -> DataFrame:
    """Rows only: an encoder trained on the windows, then amplitudes and frequencies of its curves."""
    by, columns = ["motion_id", "window_id"], ["j0", "j1"]
    made = kinematics.packed_windows(v.rigid.select("motion_id", "step", *columns), columns, 11, 2, 4)
    stats = kinematics.one_row(kinematics.feature_stats(windows(v), columns), len(columns))
    scaled = [F.expr(f"transform({c}, x -> (x - _mean{i}) / _std{i})").alias(c) for i, c in enumerate(columns)]
    rows = made.join(F.broadcast(stats)).select(*by, *scaled)
    start = autoencoder.Autoencoder.random(channels=2, hidden=(4,), latent=3, size=11, seconds=4.0, seed=7)
    trained = autoencoder.fit(rows, columns, start, epochs=4, rate=0.01)
    return learn.encode_packed(rows, trained.model.encoder(), by, columns)


LIM = "CASE name WHEN 'j0' THEN 20.0 ELSE 30.0 END"


@plan(f"SELECT name, CAST({LIM} AS DOUBLE) AS velocity_limit FROM (SELECT unnest(['j0', 'j1', 'j9']) AS name)")
def limit_lookup(v: Views) -> DataFrame:
    return physics.velocity_limits(v.spark.createDataFrame([("j0",), ("j1",), ("j9",)], "name string"), "name", {"j0": 20.0})


@plan(f"SELECT motion_id, round(avg((greatest(abs(u0) - 20, 0) + greatest(abs(u1) - 30, 0)) / 2), 6) AS velocity_violation FROM ({VEL}) GROUP BY motion_id")
def velocity_violation(v: Views) -> DataFrame:
    over = [F.greatest(F.abs(F.col(c)) - limit, F.lit(0.0)) for c, limit in (("u0", 20.0), ("u1", 30.0))]
    return moving(v).groupBy("motion_id").agg(r9(F.avg((over[0] + over[1]) / 2), 6).alias("velocity_violation"))


@plan(f"SELECT motion_id, round(avg(0.01 * sqrt(pow((u0 - p0) * 50, 2) + pow((u1 - p1) * 50, 2))), 5) AS jerk FROM (SELECT *, coalesce(lag(u0) OVER w, u0) AS p0, coalesce(lag(u1) OVER w, u1) AS p1 FROM ({VEL}) {W_}) GROUP BY motion_id")
def jerk(v: Views) -> DataFrame:
    return physics.jerk(moving(v), ["u0", "u1"], FPS).withColumn("jerk", r9("jerk", 5))


@plan("SELECT motion_id, bool_or(greatest(abs(j0), abs(j1)) > 16.2) AS joint_pos_spike FROM v_rigid GROUP BY motion_id")
def check_joint_pos(v: Views) -> DataFrame:
    return v.rigid.groupBy("motion_id").agg(checks.spike([F.col("j0"), F.col("j1")], 16.2).alias("joint_pos_spike"))


@plan(f"SELECT motion_id, bool_or(greatest(abs(u0), abs(u1)) > 790) AS joint_vel_spike FROM ({VEL}) GROUP BY motion_id")
def check_joint_vel(v: Views) -> DataFrame:
    return moving(v).groupBy("motion_id").agg(checks.spike([F.col("u0"), F.col("u1")], 790).alias("joint_vel_spike"))


@plan(f"SELECT motion_id, bool_or(abs(u0) > 780) AS root_qvel_spike FROM ({VEL}) GROUP BY motion_id")
def check_root_spike(v: Views) -> DataFrame:
    return moving(v).groupBy("motion_id").agg(checks.spike([F.col("u0")], 780).alias("root_qvel_spike"))


@plan("SELECT motion_id, step, round(j1, 9) AS c0, round(qw, 9) + 0.0 AS c1, round(px, 9) AS c2 FROM v_rigid")
def prune_channels(v: Views) -> DataFrame:
    packed = v.rigid.select("motion_id", "step", F.array("px", "py", "pz", "qw", "qx", "qy", "qz", "j0", "j1").alias("values"))
    out = physics.prune(packed, "values", ["px", "py", "pz", "qw", "qx", "qy", "qz", "j0", "j1"], ["j1", "qw", "px"])
    return out.select("motion_id", "step", *[r9(F.col("values")[i]).alias(f"c{i}") for i in range(3)])


@plan(
    f"SELECT motion_id, round(max(gap), 7) + 0.0 AS max_gap, round(max(turn), 5) + 0.0 AS max_turn, round(max(greatest(abs(j0 - p0), abs(j1 - p1))), 9) AS max_joint FROM (SELECT *, sqrt(pow(px - lag(px) OVER w, 2) + pow(py - lag(py) OVER w, 2)) AS gap, 2 * acos(least(abs(qw * lag(qw) OVER w + qx * lag(qx) OVER w + qy * lag(qy) OVER w + qz * lag(qz) OVER w), 1.0)) AS turn, lag(j0) OVER w AS p0, lag(j1) OVER w AS p1 FROM v_rigid WHERE step % 10 IN (0, 9) {W_}) WHERE step % 10 = 0 AND step > 0 GROUP BY motion_id"
)
def boundary_stats(v: Views) -> DataFrame:
    w = kinematics.along()
    edges = v.rigid.filter("step % 10 in (0, 9)")
    before = {f"_{c}": F.lag(c).over(w) for c in (*POS, *Q, "j0", "j1")}
    held = edges.withColumns(before).filter("step % 10 = 0 and step > 0")
    gap = F.sqrt(sum(((F.col(c) - F.col(f"_{c}")) ** 2 for c in POS[1:]), (F.col("px") - F.col("_px")) ** 2))
    turn = angle_between(q(), q("_q"))
    joint = F.greatest(F.abs(F.col("j0") - F.col("_j0")), F.abs(F.col("j1") - F.col("_j1")))
    return held.groupBy("motion_id").agg(r9(F.max(gap), 7).alias("max_gap"), r9(F.max(turn), 5).alias("max_turn"), r9(F.max(joint)).alias("max_joint"))


PAIR = "SELECT motion_id, k AS step, greatest(least(CAST(ceil(k * 12 / 5.0) AS BIGINT), length - 1), 1) - 1 AS r0 FROM (SELECT motion_id, length, CAST(unnest(range((length - 1) * 5 // 12 + 1)) AS BIGINT) AS k FROM v_lengths WHERE length > 1)"
ENDS = f"SELECT p.motion_id, p.step, (p.step * 12 - r0 * 5) / 5.0 AS t, a.qw AS aw, a.qx AS ax, a.qy AS ay, a.qz AS az, b.qw AS bw, b.qx AS bx, b.qy AS qy_, b.qz AS bz, a.px AS apx, b.px AS bpx, a.j0 AS aj, b.j0 AS bj FROM ({PAIR}) p JOIN v_rigid a ON a.motion_id = p.motion_id AND a.step = r0 JOIN v_rigid b ON b.motion_id = p.motion_id AND b.step = r0 + 1"
MIXED = f"SELECT *, CASE WHEN c > 0.9995 THEN 1 - t ELSE sin((1 - t) * acos(c)) / greatest(sin(acos(c)), 1e-8) END AS wa, CASE WHEN c > 0.9995 THEN t ELSE sin(t * acos(c)) / greatest(sin(acos(c)), 1e-8) END * CASE WHEN d < 0 THEN -1 ELSE 1 END AS wb FROM (SELECT *, least(abs(d), 1.0) AS c FROM (SELECT *, aw * bw + ax * bx + ay * qy_ + az * bz AS d FROM ({ENDS})))"
TURNED = f"SELECT *, greatest(sqrt(sw * sw + sx * sx + sy * sy + sz * sz), 1e-8) AS n FROM (SELECT *, aw * wa + bw * wb AS sw, ax * wa + bx * wb AS sx, ay * wa + qy_ * wb AS sy, az * wa + bz * wb AS sz FROM ({MIXED}))"


@plan(f"SELECT motion_id, step, round(sw / n, 6) + 0.0 AS qw, round(sx / n, 6) + 0.0 AS qx, round(sy / n, 6) + 0.0 AS qy, round(sz / n, 6) + 0.0 AS qz FROM ({TURNED})")
def resample_slerp(v: Views) -> DataFrame:
    out = kinematics.resample(v.rigid, 12, 5, quaternions=[Q]).join(v.lengths.filter("length > 1"), "motion_id", "left_semi")
    return out.select("motion_id", "step", *[r9(c, 6).alias(c) for c in Q])


@plan(f"SELECT motion_id, step, round(apx * (1 - t) + bpx * t, 8) + 0.0 AS px, round(aj * (1 - t) + bj * t, 8) + 0.0 AS j0, round(sz / n, 6) + 0.0 AS qz FROM ({TURNED})")
def resample_fields(v: Views) -> DataFrame:
    out = kinematics.resample(v.rigid, 12, 5, linear=["px", "j0"], quaternions=[Q]).join(v.lengths.filter("length > 1"), "motion_id", "left_semi")
    return out.select("motion_id", "step", r9("px", 8).alias("px"), r9("j0", 8).alias("j0"), r9("qz", 6).alias("qz"))


#: A chain of two hinges about z on a free base: link lengths 0.5 and 0.25 along x.
CHAIN = """<mujoco><worldbody><body name="base" pos="0 0 0"><freejoint name="root"/><body name="upper" pos="0.5 0 0"><joint name="a" type="hinge" axis="0 0 1"/>
<body name="lower" pos="0.25 0 0"><joint name="b" type="hinge" axis="0 0 1"/><geom name="tip" type="sphere" size="0.1"/></body></body></body></worldbody></mujoco>"""

LINKS = f"SELECT *, cos(j0) * 0.25 AS ex, sin(j0) * 0.25 AS ey FROM (SELECT *, {M} FROM v_rigid)"


@plan(f"SELECT motion_id, step, round(px + 0.5 * m00, 6) + 0.0 AS upper_x, round(py + 0.5 * m10, 6) + 0.0 AS upper_y, round(px + m00 * (0.5 + ex) + m01 * ey, 6) + 0.0 AS lower_x, round(py + m10 * (0.5 + ex) + m11 * ey, 6) + 0.0 AS lower_y, round(pz + m20 * (0.5 + ex) + m21 * ey, 6) + 0.0 AS lower_z FROM ({LINKS})")
def fk_positions(v: Views) -> DataFrame:
    qpos = v.rigid.select("motion_id", "step", F.array(*POS, *Q, "j0", "j1").alias("qpos"))
    out = physics.forward_kinematics(qpos, physics.parse_model(CHAIN), keep=["motion_id", "step"])
    p = lambda body, i: F.col("body_pos_w")[body][i]
    return out.select("motion_id", "step", *named((p(2, 0), p(2, 1), p(3, 0), p(3, 1), p(3, 2)), "upper_x", "upper_y", "lower_x", "lower_y", "lower_z", places=6))


@plan(f"SELECT motion_id, step, round(abs(qw * cos((j0 + j1) / 2) - qz * sin((j0 + j1) / 2)), 6) + 0.0 AS w, round(sqrt(pow(0.5 + ex, 2) + ey * ey), 6) AS reach FROM ({LINKS})")
def fk_chain(v: Views) -> DataFrame:
    qpos = v.rigid.select("motion_id", "step", "px", "py", "pz", F.array(*POS, *Q, "j0", "j1").alias("qpos"))
    out = physics.forward_kinematics(qpos, physics.parse_model(CHAIN), keep=["motion_id", "step", "px", "py", "pz"])
    reach = F.sqrt(sum(((F.col("body_pos_w")[3][i] - F.col(c)) ** 2 for i, c in ((1, "py"), (2, "pz"))), (F.col("body_pos_w")[3][0] - F.col("px")) ** 2))
    return out.select("motion_id", "step", r9(F.abs(F.col("body_quat_w")[3][0]), 6).alias("w"), r9(reach, 6).alias("reach"))


LOWER = f"SELECT motion_id, step, pz + m20 * (0.5 + ex) + m21 * ey AS z FROM ({LINKS})"


@plan(f"SELECT motion_id, step, 'floor' AS geom0, 'tip' AS geom1, round(z - 0.1, 6) + 0.0 AS dist FROM ({LOWER}) WHERE z - 0.1 <= 0.2")
def floor_contacts(v: Views) -> DataFrame:
    """The chain's tip against a floor that the model is given, up to a margin."""
    model = physics.parse_model(CHAIN).with_floor()
    found = physics.contacts(v.rigid.select("motion_id", "step", F.array(*POS, *Q, "j0", "j1").alias("qpos")), model, margin=0.2)
    names = F.array(*[F.lit(g.name) for g in model.geoms])
    return found.select("motion_id", "step", names[F.col("geom0")].alias("geom0"), names[F.col("geom1")].alias("geom1"), r9("dist", 6).alias("dist"))


@plan("SELECT motion_id, step, 4 AS bodies, 2 AS joints, CAST(0 AS DOUBLE) AS height, CAST(1 AS DOUBLE) AS w FROM v_rigid")
def constant_fk(v: Views) -> DataFrame:
    """The debugging mode: the chain's columns without its kinematics."""
    out = physics.constant_kinematics(v.rigid.select("motion_id", "step"), physics.parse_model(CHAIN))
    return out.select("motion_id", "step", F.size("body_pos_w").alias("bodies"), F.size("joint_pos").alias("joints"), F.col("body_pos_w")[3][2].alias("height"), F.col("body_quat_w")[3][0].alias("w"))


@plan("SELECT * FROM (VALUES ('body', 0, 'world', -1), ('body', 1, 'base', 0), ('body', 2, 'upper', 1), ('body', 3, 'lower', 2), ('joint', 0, 'root', 0), ('joint', 1, 'a', 7), ('joint', 2, 'b', 8), ('geom', 0, 'tip', 3)) m(kind, id, name, refers)")
def model_tables(v: Views) -> DataFrame:
    """A model's bodies with their parents, joints with their places in qpos, and geoms with their bodies."""
    t = physics.parse_model(CHAIN).tables(v.spark)
    pick = lambda kind, key, refers: t[f"{kind}s" if kind != "body" else "bodies"].select(F.lit(kind).alias("kind"), F.col(key).alias("id"), "name", F.col(refers).alias("refers"))
    return pick("body", "body", "parent").unionByName(pick("joint", "joint", "qpos")).unionByName(pick("geom", "geom", "body"))
