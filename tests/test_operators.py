"""Known values, properties and seeded comparisons with NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliploom.functions import euler, resampled_length, window_length
from cliploom.operators import catalog, checks, kinematics, learn, physics, segments, select, serve
from cliploom.streaming import running_velocity


def frames(spark, clips, columns):
    rows = [(m, s, *map(float, np.atleast_1d(v))) for m, values in clips.items() for s, v in enumerate(values)]
    return spark.createDataFrame(rows, "motion_id long, step long, " + ", ".join(f"{c} double" for c in columns))


def test_window_length():
    assert window_length(4.0, 50, 5) == 41


def test_windows(spark):
    lengths = spark.createDataFrame([(1, 250), (2, 200), (3, 0)], "motion_id long, length long")
    out = kinematics.window_index(lengths, 41, 5).collect()
    first = sorted((r.pos, r.step) for r in out if r.window_id == 0)
    assert len({r.window_id for r in out}) == 50 and {r.motion_id for r in out} == {1}
    assert (first[0][1], first[20][1], first[-1][1]) == (0, 100, 200)
    held = kinematics.window_index(lengths, 41, 5, fallback=True).filter("motion_id = 2").collect()
    assert len(held) == 41 and min(r.step for r in held) == 0 and max(r.step for r in held) == 199


def test_penalties(spark):
    df = spark.createDataFrame([(0, 0, 100.0, 0), (0, 1, -0.05, 2), (0, 2, -0.005, 12)], "motion_id int, step int, d double, c int")
    out = df.agg(F.avg(F.greatest(-F.col("d") - 0.01, F.lit(0.0))).alias("p"), F.avg(F.least("c", F.lit(10))).alias("s")).first()
    assert math.isclose(out.p, 0.04 / 3) and out.s == 4.0
    assert math.isclose(checks.sustained_ratio(df, F.col("d") > 0, 1, 1.0).first().ratio, 1 / 3)


def test_runs_and_ratios_match_numpy(spark):
    rng = np.random.default_rng(3)
    clips = {m: (rng.random(rng.integers(1, 60)) < 0.7).astype(float) for m in range(40)}
    df = frames(spark, clips, ["x"])
    runs = {r.motion_id: r.longest_run for r in checks.longest_run(df, F.col("x") > 0.5).collect()}
    for seconds in (0.02, 0.1, 0.3):
        ratios = {r.motion_id: r.ratio for r in checks.sustained_ratio(df, F.col("x") > 0.5, 50, seconds).collect()}
        w = max(1, int(seconds * 50))
        for m, x in clips.items():
            best = max((len(s) for s in "".join("1" if v else "0" for v in x).split("0")), default=0)
            assert runs[m] == best
            whole = sum(bool(x[i : i + w].all()) for i in range(len(x) - w + 1))
            assert math.isclose(ratios[m], whole / len(x), abs_tol=1e-12)


def test_velocity_edges(spark):
    df = frames(spark, {1: [3.0], 2: [1.0, 2.0], 3: [0.0, 1.0, 4.0]}, ["x"])
    out = {(r.motion_id, r.step): r.x_vel for r in kinematics.with_velocity(df, ["x"], 10).collect()}
    assert out == {(1, 0): 0, (2, 0): 10, (2, 1): 10, (3, 0): 10, (3, 1): 30, (3, 2): 30}


def turned(rng, n):
    q = rng.normal(size=(n, 4))
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def test_angular_velocity_restores_orientation(spark):
    rng = np.random.default_rng(42)
    q = turned(rng, 400)
    df = frames(spark, {0: q}, list("abcd"))
    out = sorted(kinematics.with_angular_velocity(df, list("abcd"), 120.0).collect(), key=lambda r: r.step)
    for i in range(399):
        w = np.array([out[i].wx, out[i].wy, out[i].wz]) / 120
        angle = np.linalg.norm(w)
        step = np.array([np.cos(angle / 2), *(np.sin(angle / 2) * w / angle)])
        nxt = physics._mul(q[i], step)
        assert min(np.abs(nxt - q[i + 1]).max(), np.abs(nxt + q[i + 1]).max()) < 1e-9 and angle <= np.pi + 1e-12
    assert out[399].wx == out[398].wx


@pytest.mark.parametrize("order", ["xyz", "zyx"])
def test_euler_frames_agree(spark, order):
    df = spark.createDataFrame([(0.3, -0.7, 1.1)], "a double, b double, c double")
    angles = [F.col(x) for x in "abc"]
    inner = df.select(*euler(angles, order, "intrinsic")).first()
    outer = df.select(*euler(angles[::-1], order[::-1], "extrinsic")).first()
    assert np.allclose(inner, outer)
    with pytest.raises(ValueError, match="order"):
        euler(angles, "xxy")


def test_resample(spark):
    rng = np.random.default_rng(1)
    clips = {0: rng.normal(size=(1, 5)), 1: rng.normal(size=(7, 5)), 2: rng.normal(size=(13, 5))}
    df = frames(spark, clips, ["x", *"abcd"])
    out = kinematics.resample(df, 120, 50, ["x"], [list("abcd")])
    assert {r.motion_id: r.n for r in out.groupBy("motion_id").agg(F.count("*").alias("n")).collect()} == {0: 1, 1: 3, 2: 6}
    lengths = df.groupBy("motion_id").agg(F.count("*").alias("n")).select("motion_id", resampled_length(F.col("n"), 120, 50).alias("n"))
    assert {r.motion_id: r.n for r in lengths.collect()} == {0: 1, 1: 3, 2: 6}
    alone = kinematics.resample(df.filter("motion_id = 2"), 120, 50, ["x"], [list("abcd")])
    assert sorted(alone.collect()) == sorted(out.filter("motion_id = 2").collect())
    for r in out.collect():
        t = r.step * 120 / 50
        x = clips[r.motion_id][:, 0]
        assert math.isclose(r.x, float(np.interp(t, np.arange(len(x)), x)), abs_tol=1e-12)
        assert math.isclose(r.a**2 + r.b**2 + r.c**2 + r.d**2, 1, abs_tol=1e-9)
    same = kinematics.resample(df, 50, 50, ["x"])
    assert sorted((r.motion_id, r.step, round(r.x, 9)) for r in same.collect()) == sorted((r.motion_id, r.step, round(r.x, 9)) for r in df.collect())


def test_heading_frame_ignores_world_yaw_and_sign(spark):
    rng = np.random.default_rng(5)
    p, q = rng.normal(size=(6, 3)), turned(rng, 6)
    half = 0.4
    spin = np.array([np.cos(half), 0, 0, np.sin(half)])
    p2, q2 = physics._turn(np.tile(spin, (6, 1)), p) + [3.0, -2.0, 0.0], -physics._mul(np.tile(spin, (6, 1)), q)
    df = frames(spark, {0: np.hstack([p, q]), 1: np.hstack([p2, q2])}, ["x", "y", "z", *"abcd"])
    out = kinematics.heading_frame(df, list("xyz"), list("abcd"), ["motion_id"], "step").orderBy("motion_id", "step").collect()
    values = np.array([[r[f"root_{i}"] for i in range(9)] for r in out])
    assert np.allclose(values[:6], values[6:], atol=1e-9)
    assert np.allclose(values[0, :3], 0)


def test_spectrum_matches_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=21)
    df = frames(spark, {0: x}, ["x"])
    r = kinematics.spectrum(df, ["x"], 21, 4.0, ["motion_id"], "step").first()
    power = np.abs(np.fft.rfft(x)[1:]) ** 2
    assert math.isclose(r.amp_x, 2 * math.sqrt(power.sum() + 1e-8) / 21)
    assert math.isclose(r.freq_x, (np.arange(1, 11) / 4.0 * power).sum() / (power.sum() + 1e-8))


def test_complexity_needs_three_frames(spark):
    df = frames(spark, {0: [1.0, 2.0], 1: [1.0, 2.0, 4.0]}, ["v"])
    out = {r.motion_id: r.complexity for r in kinematics.complexity(df, ["v"], 1).collect()}
    assert out == {0: 0.0, 1: 7.0 + 0.05 * 2.5}


def test_shard_boundaries(spark):
    lengths = spark.createDataFrame(list(enumerate([8, 1, 1, 1, 1, 1, 1, 1])), "motion_id long, length long")
    index = segments.clip_index(lengths)
    assert segments.shard_boundaries(index, 2) == [(0, 0), (1, 8), (8, 15)]
    view = serve.assign_shards(segments.clip_index(spark.createDataFrame(list(enumerate([3, 5, 2, 6])), "motion_id long, length long")), [(0, 0), (2, 8), (4, 16)])
    assert sorted((r.start, r.end) for r in view.filter("shard = 1").collect()) == [(0, 2), (2, 8)]
    with pytest.raises(ValueError, match="fill"):
        segments.shard_boundaries(index, 9)
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 40, 50).tolist()
    index = segments.clip_index(spark.createDataFrame(list(enumerate(sizes)), "motion_id long, length long"))
    for n in (1, 3, 7, 50):
        found = segments.shard_boundaries(index, n)
        assert [c for c, _ in found] == sorted({c for c, _ in found}) and found[-1] == (50, sum(sizes))


def test_slices_hold_the_last_frame(spark):
    df = frames(spark, {0: [0, 1, 2], 1: [3, 4, 5, 6]}, ["x"])
    asked = spark.createDataFrame([(0, 1, 2), (1, 0, 1), (2, 1, 0)], "env int, motion_id long, start_t long")
    out = serve.get_slice(asked, [0, 1, 2, 3], kinematics.clip_lengths(df), df).orderBy("env", "offset").collect()
    assert [[int(r.x) for r in out if r.env == e] for e in range(3)] == [[5, 6, 6, 6], [1, 2, 2, 2], [3, 4, 5, 6]]


def test_frame_to_clip_and_runs(spark):
    index = segments.clip_index(spark.createDataFrame([(0, 3), (1, 4)], "motion_id long, length long"))
    ids = spark.createDataFrame([(0,), (2,), (3,), (6,)], "f long")
    assert [(r.f, r.motion_id) for r in serve.frame_to_clip(ids, index, "f", span=2).orderBy("f").collect()] == [(0, 0), (2, 0), (3, 1), (6, 1)]
    runs = segments.id_runs(spark.createDataFrame([(i,) for i in (1, 2, 5, 9, 10, 11)], "i long"), "i")
    assert sorted(map(tuple, runs.collect())) == [(1, 3, 0, 2), (5, 6, 2, 3), (9, 12, 3, 6)]


def test_routing(spark):
    asked = spark.createDataFrame([(i, x) for i, x in enumerate([5, 4, 0, 1, 5, 0])], "pos int, id long")
    out = serve.route(asked, [1, 4, 1], "id").orderBy("pos").collect()
    assert [(r.child, r.child_id) for r in out] == [(2, 0), (1, 3), (0, 0), (1, 0), (2, 0), (0, 0)]


def test_segments(spark):
    names = spark.createDataFrame([(n,) for n in ("walk_1.npz", "walk_2.npz", "jump.npz", "run_1.npz", "run_3.npz", "solo_1.npz")], "n string")
    out = {r.output: (r.parts, r.is_group, r.valid) for r in segments.numbered_parts(names, "n").collect()}
    assert out == {"walk.npz": (2, True, True), "jump.npz": (1, False, True), "run.npz": (2, True, False), "solo_1.npz": (1, False, True)}
    parts = spark.createDataFrame([("w", p, s) for p in (1, 2) for s in range(3)], "g string, p int, step int")
    assert sorted(r.out_step for r in segments.concatenated(parts, "g", "p", "step").collect()) == list(range(6))


def test_motion_scores(spark):
    rows = [(0, t, 0.0, d, c, u, 0.0) for t, (d, c, u) in enumerate([(100.0, 0, 0.0), (-0.05, 2, 33.0), (-0.005, 12, 33.0)])]
    df = spark.createDataFrame(rows, "motion_id long, step long, slide double, floor_min_dist double, non_floor_contact_count long, u0 double, u1 double")
    out = checks.motion_scores(df, {"u0": 30.0, "u1": 20.0}, 1.0).first()
    assert (round(out.penetration, 9), round(out.floating_frames_ratio, 9), out.self_collision) == (round(0.04 / 3, 9), round(1 / 3, 9), 4.0)
    assert (out.velocity_violation, round(out.jerk, 9), out.foot_sliding, out.frames) == (1.0, round(0.33 / 3, 9), 0.0, 3)
    assert round(out.score, 6) == round(100 - 44.22 - 0.17 * 4 - 0.28 * 0.11 - 216.62 * 0.04 / 3 - 24.19 / 3, 6)
    assert checks.motion_scores(df, {}, 1.0, seconds=3).first().floating_frames_ratio == 0


def test_score_bins(spark):
    scores = [100.001, 100.0, 97.0, 95.0, 94.999, 90.0, 85.0, 80.0, 70.0, 60.0, 59.999, float("nan")]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    labels = [r[0] for r in df.select(select.bin_label(F.col("s"))).collect()]
    assert labels == [None, "100-95", "100-95", "100-95", "95-90", "95-90", "90-85", "85-80", "75-70", "65-60", None, None]


def test_farthest_points(spark):
    rows = [(i, [float(x), float(y)], c) for i, (x, y, c) in enumerate([(0, 0, 0.1), (1, 0, 0.4), (0, 1, 0.2), (1, 1, 1.0)])]
    df = spark.createDataFrame(rows, "id long, v array<double>, c double")
    out = [r.id for r in select.weighted_fps(df, "v", "c", "id", 2).orderBy("rank").collect()]
    assert out[0] == 3 and len(out) == 2
    assert [r.id for r in select.weighted_fps(df, "v", "c", "id", 9).orderBy("rank").collect()] == [0, 1, 2, 3]
    assert select.subset_sizes(10382, [0.04, 0.08, 0.16, 0.32]) == {0.04: 415, 0.08: 831, 0.16: 1661, 0.32: 3322}


@pytest.mark.parametrize("pool, alpha", [(1, 0.6), (5, 0.6), (5, 0.0), (5, 1.0), (2048, 0.6)])
def test_farthest_points_in_rounds(spark, pool, alpha):
    """Small pools need many rounds; the order is that of a plain loop over all rows, ties and repeated points included."""
    rng = np.random.default_rng(3)
    x, c = np.round(rng.normal(size=(90, 3)), 1), np.round(rng.random(90), 1)
    x[40:50], c[40:50] = x[3], c[3]
    order = [int(np.argmax(c))]
    while len(order) < 30:
        near = np.min([np.sqrt(((x - x[i]) ** 2).sum(axis=1)) for i in order], axis=0)
        score = alpha * near / near.max() + (1 - alpha) * c
        score[order] = -1
        order.append(int(np.argmax(score)))
    df = spark.createDataFrame([(f"n{i:02}", x[i].tolist(), float(c[i])) for i in range(90)], "id string, v array<double>, c double").repartition(3)
    out = [r.id for r in select.weighted_fps(df, "v", "c", "id", 30, alpha, pool).orderBy("rank").collect()]
    assert out == [f"n{i:02}" for i in order]


def test_running_sums_over_ranges(spark):
    rng = np.random.default_rng(2)
    keys = sorted({int(k) for k in np.concatenate([rng.integers(0, 50, 40), rng.integers(10**9, 10**12, 200)])})
    df = spark.createDataFrame([(k, k % 7 + 1) for k in keys], "motion_id long, length long").repartition(5)
    out, at = {r.motion_id: (r.start, r.end) for r in segments.clip_index(df).collect()}, 0
    for k in keys:
        assert out[k] == (at, at := at + k % 7 + 1)
    assert segments.clip_index(df.limit(0)).collect() == []


def test_global_rank_with_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(v)) for i, v in enumerate(rng.integers(0, 20, 500))]
    out = {r.i: r.rank for r in select.global_rank(spark.createDataFrame(rows, "i long, x double"), [F.col("x"), F.col("i")], "rank").collect()}
    assert out == {i: n + 1 for n, (_, i) in enumerate(sorted((v, i) for i, v in rows))}


def test_points(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0, 1.0), (1, 1.0, 1.0, 1.0)], "i int, x double, y double, z double")
    assert {(r.x, r.y, r.z) for r in select.normalize_points(df, list("xyz")).collect()} == {(0, 0, 0)}
    assert select.minmax_colors(df, ["x"]).first().color_x == 127
    assert select.nearest_to_ray(df, list("xyz"), "i", (0, 0, 0), (0, 0, 0)).count() == 0
    assert learn.perplexity(30, 10) == 3.0


def test_whitelist(spark):
    names = spark.createDataFrame([("a/b.npz\tx",), ("c.npz d",), (" e ",)], "t string")
    assert [r[0] for r in names.select(catalog.name_token(F.col("t"))).collect()] == ["b", "c", "e"]
    with pytest.raises(Exception, match="not a clip"):
        spark.createDataFrame([("../x.npz",)], "p string").select(catalog.view_path(F.col("p"))).collect()


SPHERES = """<mujoco><worldbody><geom name="floor" type="plane" size="0 0 1"/><body name="a" pos="0 0 0.05"><freejoint name="r"/><geom type="sphere" size="0.1"/></body>
<body name="b" pos="0 0 0"><joint name="s" type="slide" axis="0 0 1"/><geom type="sphere" size="0.1"/></body></worldbody></mujoco>"""


def test_contacts(spark):
    model = physics.parse_model(SPHERES)
    assert model.nq == 8 and model.nv == 7 and model.floor() == 0 and model.qpos_names()[-1] == "s"
    rows = [(0, 0, [0, 0, 0.05, 1, 0, 0, 0, 5.0]), (0, 1, [0, 0, 1.0, 1, 0, 0, 0, 1.0]), (0, 2, [0, 0, 9.0, 1, 0, 0, 0, 3.0])]
    df = spark.createDataFrame([(m, s, [float(x) for x in q]) for m, s, q in rows], "motion_id long, step long, qpos array<double>")
    found = physics.contacts(df, model)
    out = checks.contact_summary(df.select("motion_id", "step"), found.withColumn("floor", F.col("geom0") == 0), "step", F.col("floor"), F.col("dist"), capacity=1)
    got = {r.step: (round(r.floor_min_dist, 6), r.non_floor_contact_count, r.contact_buffer_saturated) for r in out.collect()}
    assert got == {0: (-0.05, 0, True), 1: (100.0, 1, True), 2: (100.0, 0, False)}
    still = physics.constant_kinematics(df, model).first()
    assert len(still.body_pos_w) == 3 and still.body_quat_w[0] == [1, 0, 0, 0]
    with pytest.raises(ValueError, match="floor"):
        physics.parse_model("<mujoco><worldbody/></mujoco>").floor()


def test_pruning_keeps_the_asked_order():
    assert physics.indices(["a", "b", "c"], ["c", "a"]) == [2, 0]
    with pytest.raises(ValueError, match="x, y"):
        physics.indices(["a"], ["x", "a", "y"])


def test_encoder_and_trainer():
    encoder = learn.Encoder.random(2, (4,), 3, 11, 4.0, 1)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(512, 2, 11))
    assert encoder.latent(x).shape == (512, 3, 11)
    losses = learn.train(x, encoder, epochs=4, rate=0.5)
    assert losses[-1] <= losses[0]


def test_stream_carries_the_last_frame(spark, tmp_path):
    frames(spark, {0: [0, 1, 3], 1: [5]}, ["x"]).repartition(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("motion_id long, step long, x double").parquet(f"{tmp_path}/in")
    out = running_velocity(stream, "motion_id", "step", "x", 10).writeStream.format("memory").queryName("speeds").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    out.awaitTermination()
    assert sorted((r.motion_id, r.step, r.velocity) for r in spark.table("speeds").collect()) == [(0, 0, 0.0), (0, 1, 10.0), (0, 2, 20.0), (1, 0, 0.0)]
