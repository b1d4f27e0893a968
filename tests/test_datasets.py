import pytest
from pyspark.sql import functions as F

from cliploom.functions import sql
from cliploom.operators import learn
from cliploom.operators.datasets import ClipDataset, Router, WindowDataset
from cliploom.sources.clips import is_current


def clips(spark, lengths, base=0):
    rows = [(m, s, float(base + 100 * m + s)) for m, n in enumerate(lengths) for s in range(n)]
    return spark.createDataFrame(rows, "motion_id long, step long, x double")


def asked(spark, rows):
    return spark.createDataFrame(rows, "env long, terminated_t long, rewind boolean, rewind_steps int")


def test_clip_dataset(spark):
    d = ClipDataset(clips(spark, [3, 5, 2]), seed=4)
    first = {r.env: r for r in d.sample(asked(spark, [(e, 0, False, 0) for e in range(30)])).collect()}
    lengths = {0: 3, 1: 5, 2: 2}
    assert len(first) == 30 and all(r.motion_len == lengths[r.motion_id] and 0 <= r.start_t < r.motion_len for r in first.values())
    assert {r.motion_id for r in first.values()} == {0, 1, 2}
    again = {r.env: r for r in d.sample(asked(spark, [(0, 2, True, 5), (1, 4, True, 1), (2, 0, False, 0)])).collect()}
    assert again[0].motion_id == first[0].motion_id and again[0].start_t == 0
    assert again[1].motion_id == first[1].motion_id and again[1].start_t == 3
    out = d.get_slice(spark.createDataFrame([(9, 2, 1)], "env long, motion_id long, start_t long"), [0, 1, 2]).orderBy("offset").collect()
    assert [r.x for r in out] == [201.0, 201.0, 201.0]


def test_window_dataset(spark):
    w = WindowDataset(ClipDataset(clips(spark, [3, 12])), size=4)
    first = w.sample(asked(spark, [(e, 0, False, 0) for e in range(12)])).collect()
    assert all(r.motion_len == 4 and r.start_t == 0 for r in first)
    held = {r.env: (r.motion_id, r.start_t) for r in w.current.collect()}
    assert all(s == 0 if m == 0 else s <= 8 for m, s in held.values())
    again = {r.env: r.start_t for r in w.sample(asked(spark, [(0, 3, True, 2), (1, 0, False, 0)])).collect()}
    assert again == {0: 1, 1: 0}
    now = {r.env: (r.motion_id, r.start_t) for r in w.current.collect()}
    assert len(now) == 12 and all(now[e] == held[e] for e in now if e != 1)
    out = w.get_slice(spark.createDataFrame([(0, 2)], "env long, at int"), [0, 1, 5]).orderBy("offset").collect()
    m, s = now[0]
    top = 2 if m == 0 else 11
    assert [r.x for r in out] == [100.0 * m + min(s + k, top) for k in (2, 3, 3)]


def test_router(spark):
    a, b = ClipDataset(clips(spark, [2])), ClipDataset(clips(spark, [3, 1], 1000))
    r = Router([a, b])
    assert r.spans == [1, 2]
    out = r.get_slice(spark.createDataFrame([(0, 0, 0), (1, 1, 0), (2, 2, 0)], "pos int, motion_id long, start_t long"), [0]).orderBy("pos").collect()
    assert [x.x for x in out] == [0.0, 1000.0, 1100.0]
    with pytest.raises(ValueError, match="same columns"):
        Router([a, ClipDataset(clips(spark, [1]).withColumn("y", F.lit(1)))])


def test_sql_functions(spark):
    sql.register(spark)
    r = spark.sql("SELECT clip_window_length(4.0, 50.0, 5) AS n, clip_resampled_length(13, 120.0, 50.0) AS m, clip_path_stem('a/b.c.npz') AS s, clip_quat_yaw(cos(0.2D), 0, 0, sin(0.2D)) AS y, clip_lerp(1, 3, 0.5D) AS l").first()
    assert (r.n, r.m, r.s, round(r.y, 12), r.l) == (41, 6, "b.c", 0.4, 2.0)
    steps = spark.sql("SELECT * FROM clip_window_steps(12, 3, 2, 4)").collect()
    assert [(x.window_id, x.pos, x.step) for x in steps] == [(0, 0, 0), (0, 1, 2), (0, 2, 4), (1, 0, 4), (1, 1, 6), (1, 2, 8)]
    clips(spark, [6]).withColumn("f", F.col("step") != 2).createOrReplaceTempView("flags")
    assert spark.sql("SELECT clip_longest_run(step, f) AS r FROM flags").first().r == 3


def test_encoder_keeps_its_weights():
    e = learn.Encoder.random(2, (3,), 2, 5, 4.0, 1)
    again = learn.Encoder.from_json(e.to_json())
    assert all((a == b).all() for x, y in zip(e.layers, again.layers, strict=True) for a, b in zip(x, y, strict=True))
    assert is_current({"version": 1, "win": 4}, {"version": 1}) and not is_current({"version": 1}, {"version": 2})
