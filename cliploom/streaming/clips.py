"""Event-time sessions with late-data limits, and velocities that carry each clip's last frame as state."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.operators.ranges import shared_folder

#: How many batches' state a process keeps in memory.
KEPT = "spark.sql.streaming.maxBatchesToRetainInMemory"


def instants(rows: DataFrame, column: str) -> DataFrame:
    """A zoneless timestamp as an instant, as watermarks need; it is read in the session's zone."""
    return rows.withColumn(column, F.col(column).cast("timestamp"))


def micros(time: Column) -> Column:
    """Microseconds from 1970 on an instant's clock in the session's zone: the inverse of instants, in any zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), time.cast("timestamp_ntz"))


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str, value: str) -> DataFrame:
    """(key, start, end, n, total) of each burst of events less than `gap` apart; later than `late` is dropped."""
    grouped = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key)
    out = grouped.agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def running_velocity(frames: DataFrame, key: str, step: str, value: str, fps: float) -> DataFrame:
    """(key, step, velocity) as frames arrive: differences to the frame before, which is kept as state."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(step)
        last = state.get if state.exists else None
        steps, values = rows[step].to_list(), rows[value].to_list()
        speeds = []
        for s, x in zip(steps, values, strict=True):
            speeds.append((x - last[1]) * fps / (s - last[0]) if last and s > last[0] else 0.0)
            last = (s, x)
        state.update(last)
        yield pd.DataFrame({key: [group[0]] * len(steps), step: steps, "velocity": speeds})

    schema = f"{key} long, {step} long, velocity double"
    return frames.groupBy(key).applyInPandasWithState(update, schema, f"{step} long, {value} double", "append", GroupStateTimeout.NoTimeout)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended; nothing reads the folder any more
        pass


def settled(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now, and return its rows, read back from the cluster's shared folder.

    Executors write them, so the driver holds none; a batch that is run again writes its own folder anew. State and
    progress lie there too, until the stream ends; the rows go at the session's exit. In mode "complete" the last batch
    has the whole result. Each batch reads the state from its files: a process holds that of the partitions at work, not of all.
    """
    root = f"{shared_folder(spark)}/clips-{uuid.uuid4().hex}"
    schema, written = stream.schema, []

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/rows/{batch}")
        written.append(batch)

    begun = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{root}/progress").trigger(availableNow=True)
    before = spark.conf.get(KEPT)
    spark.conf.set(KEPT, "0")
    try:
        query = begun.start()  # takes a copy of the settings
    finally:
        spark.conf.set(KEPT, before)
    query.awaitTermination()
    _delete(spark, f"{root}/progress")
    atexit.register(_delete, spark, root)
    held = sorted(set(written))[-1:] if mode == "complete" else sorted(set(written))
    return spark.read.schema(schema).parquet(*[f"{root}/rows/{b}" for b in held]) if held else spark.createDataFrame([], schema)
