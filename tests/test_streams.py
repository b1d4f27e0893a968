"""Streams whose rows executors write: the driver holds none."""

from threading import Event

import pytest

from cliploom import plans
from cliploom.streaming import sessions, settled
from cliploom.streaming.clips import KEPT


@pytest.mark.parametrize("name", ["stream_sessions", "stream_late_drop"])
def test_rows_are_read_from_files(spark, name):
    df = plans.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.inputFiles() and df.count()


@pytest.mark.parametrize(("mode", "late", "want"), [("append", "1 minute", [(1, 2), (2, 1)]), ("complete", "400 days", [(1, 1), (1, 2), (2, 1)])])
def test_batches_add_up(spark, tmp_path, mode, late, want):
    times = [("2024-01-01 00:00:00", 1), ("2024-01-01 00:10:00", 1)], [("2024-01-01 05:00:00", 2)], [("2024-01-02 00:00:00", 1)]
    for i, rows in enumerate(times):
        spark.createDataFrame([(t, u, 1) for t, u in rows], "ts string, u long, x long").selectExpr("cast(ts as timestamp) ts", "u", "x").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("ts timestamp, u long, x long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = settled(spark, sessions(stream, "ts", "u", "1 hour", late, "x"), mode)
    assert sorted((r.u, r.n) for r in out.collect()) == want


def test_a_stream_without_rows(spark, tmp_path):
    spark.createDataFrame([], "ts timestamp, u long, x long").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, u long, x long").parquet(f"{tmp_path}/in")
    for mode in ("append", "complete"):
        assert settled(spark, sessions(stream, "ts", "u", "1 hour", "1 day", "x"), mode).count() == 0


def test_no_state_is_kept_in_memory(spark, tmp_path):
    from pyspark.sql.streaming import StreamingQueryListener

    seen, ended = [], Event()

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            seen.extend(event.progress.stateOperators)

        def onQueryTerminated(self, event):
            ended.set()

    for i, time in enumerate(("00:00:00", "05:00:00", "10:00:00")):
        spark.createDataFrame([(f"2024-01-01 {time}", u, 1) for u in range(50)], "ts string, u long, x long").selectExpr("cast(ts as timestamp) ts", "u", "x").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("ts timestamp, u long, x long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    before, listener = spark.conf.get(KEPT), Listener()
    spark.streams.addListener(listener)
    try:
        assert settled(spark, sessions(stream, "ts", "u", "1 hour", "1 minute", "x")).count() == 100
        assert ended.wait(30)
    finally:
        spark.streams.removeListener(listener)
    assert seen and not sum(s.customMetrics["loadedMapCacheHitCount"] for s in seen)
    assert spark.conf.get(KEPT) == before
