"""Plans that run a stream over the events' file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.plans.registry import plan
from cliploom.plans.views import Views
from cliploom.streaming import instants, micros, sessions, settled


def _events(v: Views) -> DataFrame:
    """The events as a stream; their zoneless times are taken in the session's zone."""
    path = f"{v.sf_dir}/events.parquet"
    schema = v.spark.read.parquet(path).schema
    whole = v.spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    return instants(whole.parquet(f"{v.sf_dir}/events.parquet*"), "ts")


SESSIONS = """SELECT user_id, count(*) AS n, CAST(sum(round(value * 100)) AS BIGINT) AS total, epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) < 3600000000 THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s"""


@plan(f"SELECT user_id, n, total, started FROM ({SESSIONS})")
def stream_sessions(v: Views) -> DataFrame:
    """Sessions of events under an hour apart; at the end of the stream all are complete."""
    cents = _events(v).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    out = settled(v.spark, sessions(cents, "ts", "user_id", "1 hour", "400 days", "cents"), "complete")
    return out.select("user_id", "n", "total", micros(F.col("start")).alias("started"))


@plan(f"SELECT user_id, n, total FROM ({SESSIONS}) WHERE ended + 3600000000 <= (SELECT epoch_us(max(ts)) // 1000 * 1000 FROM events) - 86400000000")
def stream_late_drop(v: Views) -> DataFrame:
    """Sessions that the watermark closed: those that ended a day before the last event; later ones stay open."""
    cents = _events(v).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return settled(v.spark, sessions(cents, "ts", "user_id", "1 hour", "1 day", "cents")).select("user_id", "n", "total")
