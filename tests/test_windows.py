"""Windows of frames: the join with the index as the rule to match, and plans that the driver's memory doesn't bound."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cliploom import plans
from cliploom.operators import kinematics


@pytest.mark.parametrize(("size", "downsample", "stride", "fallback"), [(11, 2, 3, False), (11, 2, 4, True), (5, 1, 1, False), (7, 3, 0, True), (1, 1, 2, False), (4, 2, 1, True)])
def test_windows_are_those_of_the_index(spark, size, downsample, stride, fallback):
    rows = [(m, s, float(m * 1000 + s)) for m, n in {1: 1, 2: 20, 3: 21, 4: 22, 5: 67, 6: 2}.items() for s in range(n)]
    rows += [(7, s, float(s)) for s in (0, 1, 1, 5, 6, 7, 8, 9, 10, 11, 12, 30)] + [(None, s, 0.0) for s in range(30)] + [(8, None, 0.0)] + [(8, s, 1.0) for s in range(25)]
    df = spark.createDataFrame(rows, "motion_id long, step long, x double")
    index = kinematics.window_index(kinematics.clip_lengths(df), size, downsample, stride, fallback)
    want = index.join(df, ["motion_id", "step"])
    got = kinematics.windows(df, size, downsample, stride, fallback)
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("name", ["hme_windows", "fft_params", "heading_frame", "mean_embedding", "hme_window_norm", "hme_encode"])
def test_windows_are_never_broadcast(spark, name):
    df = plans.queries()[name](spark, "/root/testdata/sf0.001")
    df.collect()  # adaptive execution chooses joins as it goes
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Generate" in plan
    assert not [x for x in plan.splitlines() if "HashJoin" in x or "MergeJoin" in x]


@pytest.mark.parametrize("name", ["fft_params", "heading_frame", "mean_embedding", "hme_window_norm", "hme_encode"])
def test_clips_are_held_in_tasks_of_their_own(spark, name):
    plan = plans.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Generate ") :]  # the frames, before they find their windows
    assert 0 <= below.index("Exchange ") < below.index("Window ")


def test_a_spectrum_repeats_no_samples(spark):
    rows = spark.createDataFrame([(m, p, float(m * p)) for m in range(3) for p in range(11)], "m long, pos int, x double")
    plan = kinematics.spectrum(rows, ["x"], 11, 4.0, ["m"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    assert plan.count("Aggregate") == 2  # a partial and a final one


@pytest.mark.parametrize(("size", "downsample", "stride", "block"), [(11, 2, 3, 256), (11, 2, 4, 1), (5, 1, 1, 2), (7, 3, 0, 3), (1, 1, 2, 2), (4, 2, 5, 1)])
def test_first_frames_are_those_of_the_windows(spark, size, downsample, stride, block):
    rows = [(m, s, float(m * 1000 + s)) for m, n in {1: 1, 2: 20, 3: 21, 4: 22, 5: 67, 6: 2}.items() for s in range(n)]
    rows += [(7, s, float(s)) for s in (0, 1, 5, 6, 7, 8, 9, 10, 11, 12, 30, 31)] + [(None, s, 0.0) for s in range(30)] + [(8, None, 0.0)] + [(8, s, None) for s in range(-3, 25)]
    df = spark.createDataFrame(rows, "motion_id long, step long, x double")
    first = F.first("x").over(W.partitionBy("motion_id", "window_id").orderBy("pos"))
    want = kinematics.windows(df, size, downsample, stride).withColumn("first_x", first)
    got = kinematics.windows_with_first(df, ["x"], size, downsample, stride, block=block)
    assert got.dtypes == want.dtypes
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(map(tuple, want.collect()), key=order)


def test_windows_of_a_heading_are_never_sorted(spark):
    plan = plans.queries()["heading_frame"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate ")]  # rows that are windows' samples, several of each frame
    assert not [x for x in ("Sort ", "Window ", "Aggregate", "Exchange ") if x in above]


@pytest.mark.parametrize("name", ["heading_frame", "mean_embedding", "hme_window_norm", "hme_encode"])
def test_only_what_events_have_is_moved(spark, name):
    plan = plans.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Generate ") :]
    assert " x#" in below
    assert not [c for c in ("px#", "j0#", "j1#", "qw#") if c in below[below.index("Exchange ") :]]
    assert "props#" not in below[below.index("Exchange ") : below.rindex("Exchange ")]  # the shuffle that deals clips, and all above it


@pytest.mark.parametrize(("size", "downsample", "stride", "block"), [(11, 2, 3, 256), (11, 2, 4, 1), (5, 1, 1, 2), (7, 3, 0, 3), (1, 1, 2, 2)])
def test_packed_windows_are_the_whole_windows(spark, size, downsample, stride, block):
    rows = [(m, s, float((m or 0) * 1000 + s)) for m, n in {1: 1, 2: 20, 3: 21, 4: 22, 5: 67, 6: 2, None: 30}.items() for s in range(n)]
    rows += [(7, s, float(s)) for s in (0, 1, 5, 6, 7, 8, 9, 10, 11, 12, 30, 31)]
    df = spark.createDataFrame(rows, "motion_id long, step long, x double")
    grouped = kinematics.windows(df, size, downsample, stride).groupBy("motion_id", "window_id").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("w"))
    want = grouped.filter(F.size("w") == size).select("motion_id", "window_id", "w.x")
    got = kinematics.packed_windows(df, ["x"], size, downsample, stride, block=block)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_encoded_windows_are_never_grouped(spark):
    plan = plans.queries()["hme_encode"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_samples_of_unlike_lengths_are_refused():
    import pyarrow as pa

    from cliploom.operators.learn import samples

    batch = pa.RecordBatch.from_pydict({"a": [[1.0, 2.0], [3.0, None]], "b": [[5.0, 6.0], [7.0, 8.0]], "c": [[1.0], [2.0, 3.0, 4.0]]})
    got = samples(batch.slice(1), ["a", "b"])
    assert got.shape == (1, 2, 2) and got[0, 1].tolist() == [7.0, 8.0] and got[0, 0, 0] == 3.0 and got[0, 0, 1] != got[0, 0, 1]
    with pytest.raises(ValueError):
        samples(batch, ["a", "c"])
