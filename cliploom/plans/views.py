"""Clip-shaped views of the general tables, as DataFrames and as SQL."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

FPS = 50

SQL = {
    "v_frames": "SELECT user_id AS motion_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step, value AS x, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "v_lengths": "SELECT motion_id, count(*) AS length FROM v_frames GROUP BY motion_id",
    "v_index": "SELECT motion_id, length, CAST(sum(length) OVER (ORDER BY motion_id) - length AS BIGINT) AS start, CAST(sum(length) OVER (ORDER BY motion_id) AS BIGINT) AS \"end\" FROM v_lengths",
    "v_rigid": "SELECT motion_id, step, x / 10 AS px, k / 10.0 AS py, CAST(0.8 AS DOUBLE) AS pz, cos(x / 100) * cos(k / 200.0) AS qw, -sin(x / 100) * sin(k / 200.0) AS qx, cos(x / 100) * sin(k / 200.0) AS qy, sin(x / 100) * cos(k / 200.0) AS qz, x / 30 AS j0, k / 40.0 AS j1 FROM v_frames",
    "v_steps": "SELECT o_orderkey, o_custkey AS motion_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS step FROM orders",
    "v_bodies": "SELECT s.motion_id, s.step, l.l_orderkey AS frame, row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS body, round(l_quantity / 50, 9) AS z, round(100 * l_discount, 9) AS vx, round(100 * l_tax, 9) AS vy, round(l_extendedprice / 50000 - 1, 9) AS vz FROM v_steps s JOIN lineitem l ON l.l_orderkey = s.o_orderkey",
    "v_contacts": "SELECT l_orderkey AS frame, l_linestatus = 'F' AS is_floor, round(l_discount - 0.05, 9) AS dist FROM lineitem",
    "v_summary": "SELECT s.motion_id, s.step, s.o_orderkey AS frame, coalesce(min(c.dist) FILTER (c.is_floor), 100.0) AS floor_min_dist, count(*) FILTER (NOT c.is_floor AND c.dist < 0) AS non_floor_contact_count, count(c.dist) AS n FROM v_steps s LEFT JOIN v_contacts c ON c.frame = s.o_orderkey GROUP BY ALL",
    "v_feet": "SELECT frame, sum(CASE WHEN z < 0.05 THEN 5 * greatest(sqrt(vx * vx + vy * vy) - 0.10, 0.0) ELSE 0.0 END) AS slide, coalesce(max(21 * vz) FILTER (body = 1), 0.0) AS u0, coalesce(max(31 * vz) FILTER (body = 2), 0.0) AS u1 FROM v_bodies WHERE body <= 2 GROUP BY frame",
    "v_graded": """SELECT *, 0.01 * sqrt(pow((u0 - coalesce(lag(u0) OVER w, u0)) * 50, 2) + pow((u1 - coalesce(lag(u1) OVER w, u1)) * 50, 2)) AS jerk, step - row_number() OVER (PARTITION BY motion_id, air ORDER BY step) AS g
        FROM (SELECT s.*, floor_min_dist > 0.05 AS air, coalesce(slide, 0.0) AS slide, coalesce(u0, 0.0) AS u0, coalesce(u1, 0.0) AS u1 FROM v_summary s LEFT JOIN v_feet USING (frame)) WINDOW w AS (PARTITION BY motion_id ORDER BY step)""",
    "v_scores": """SELECT *, round(greatest(0.0, 100 - 1.70 * foot_sliding - 44.22 * velocity_violation - 0.17 * self_collision - 0.28 * jerk - 216.62 * penetration - 24.19 * floating_frames_ratio), 9) AS score FROM (
        SELECT motion_id, count(*) AS frames, avg(slide) AS foot_sliding, avg((greatest(abs(u0) - 20, 0) + greatest(abs(u1) - 30, 0)) / 2) AS velocity_violation, avg(least(non_floor_contact_count, 10)) AS self_collision,
        avg(jerk) AS jerk, avg(greatest(-floor_min_dist - 0.01, 0.0)) AS penetration, coalesce(any_value(floating), 0) / count(*) AS floating_frames_ratio FROM v_graded JOIN (
        SELECT motion_id, sum(greatest(n - 2, 0)) FILTER (air) AS floating FROM (SELECT motion_id, air, g, count(*) AS n FROM v_graded GROUP BY motion_id, air, g) GROUP BY motion_id) r USING (motion_id) GROUP BY motion_id)""",
    "v_embed": "SELECT vec_id, label, embedding FROM embeddings",
    "v_elements": "SELECT vec_id, label, CAST(unnest(range(64)) AS BIGINT) AS step, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings",
    "v_points": "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings",
    "v_complexity": """SELECT vec_id, CASE WHEN count(*) < 3 THEN 0.0 ELSE avg(q * q) + 0.05 * avg(a * a) END AS complexity FROM (SELECT *, (lead(q) OVER (PARTITION BY vec_id ORDER BY step) - q) * 50 AS a FROM (
        SELECT vec_id, step, coalesce((lead(v) OVER w - v) * 50, (v - lag(v) OVER w) * 50, 0.0) AS q FROM v_elements WINDOW w AS (PARTITION BY vec_id ORDER BY step))) GROUP BY vec_id""",
    "v_ranked": "SELECT vec_id, complexity, CAST(row_number() OVER (ORDER BY round(complexity, 6), vec_id) - 1 AS DOUBLE) / (count(*) OVER () - 1) AS rank_norm FROM v_complexity",
    "v_segments": "SELECT conv_id AS source, turn AS start, turn + 1 AS \"end\" FROM conversations WHERE turn % 5 <> 3",
    "v_catalog": "SELECT doc_id, 'motions/' || lang || '/' || source || '_' || doc_id || '.npz' AS path, source || '_' || doc_id AS stem, lang, source, n_chars AS frames FROM documents",
}


def prelude(sql: str) -> str:
    """sql with the views that it names, and those that these name, as common table expressions."""
    need: set[str] = set()
    queue = [sql]
    while queue:
        for v in set(re.findall(r"\bv_\w+", queue.pop())) & SQL.keys():
            if v not in need:
                need.add(v)
                queue.append(SQL[v])
    parts = [f"{v} AS ({SQL[v]})" for v in SQL if v in need]
    body = sql.strip()
    if m := re.match(r"WITH\s+(RECURSIVE\s+)?", body):
        body = body[m.end() :]
        return f"WITH RECURSIVE {', '.join([*parts, ''])}{body}" if parts else f"WITH RECURSIVE {body}"
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body


def r9(c: Column | str, places: int = 9) -> Column:
    """Rounded far below the data's grid and far above the last bits; never -0.0."""
    return F.round(c, places) + F.lit(0.0)


class Views:
    """The views over the tables in a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def frames(self) -> DataFrame:
        step = F.row_number().over(W.partitionBy("motion_id").orderBy("ts", "event_id")) - 1  # by the new name, so that later windows need no other shuffle
        k = F.get_json_object("props", "$.k").cast("long")
        rows = self.table("events").select(F.col("user_id").alias("motion_id"), "ts", "event_id", F.col("value").alias("x"), k.alias("k"))  # the text itself is never moved, sorted or held
        return rows.select("motion_id", step.cast("long").alias("step"), "x", "k")

    @cached_property
    def lengths(self) -> DataFrame:
        return self.table("events").groupBy(F.col("user_id").alias("motion_id")).agg(F.count("*").alias("length"))

    @cached_property
    def index(self) -> DataFrame:
        from cliploom.operators.segments import clip_index

        return clip_index(self.lengths)

    @cached_property
    def rigid(self) -> DataFrame:
        return self.posed(self.frames)

    def posed(self, frames: DataFrame, prefix: str = "") -> DataFrame:
        """frames with position, rotation and joints in place of x and k (all under the prefix); other columns stay."""
        from cliploom.functions import axis_angle, multiply

        x, k = F.col(f"{prefix}x"), F.col(f"{prefix}k")
        q = multiply(axis_angle("z", x / 50), axis_angle("y", k / 100))
        made = {"px": x / 10, "py": k / 10, "pz": F.lit(0.8)} | {f"q{n}": c for c, n in zip(q, "wxyz", strict=True)} | {"j0": x / 30, "j1": k / 40}
        return frames.select(*[c for c in frames.columns if c not in (f"{prefix}x", f"{prefix}k")], *[c.alias(prefix + n) for n, c in made.items()])

    @cached_property
    def steps(self) -> DataFrame:
        step = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) - 1
        return self.table("orders").select(F.col("o_orderkey").alias("frame"), F.col("o_custkey").alias("motion_id"), step.cast("long").alias("step"))

    @cached_property
    def bodies(self) -> DataFrame:
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
        body = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*order)).cast("long")
        rows = self.table("lineitem").select(
            F.col("l_orderkey").alias("frame"), body.alias("body"), F.round(F.col("l_quantity") / 50, 9).alias("z"), F.round(100 * F.col("l_discount"), 9).alias("vx"),
            F.round(100 * F.col("l_tax"), 9).alias("vy"), F.round(F.col("l_extendedprice") / 50000 - 1, 9).alias("vz"),
        )
        return self.steps.join(rows, "frame")

    @cached_property
    def contacts(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").alias("frame"), (F.col("l_linestatus") == "F").alias("is_floor"), F.round(F.col("l_discount") - 0.05, 9).alias("dist"))

    @cached_property
    def summary(self) -> DataFrame:
        from cliploom.operators.checks import contact_summary

        return contact_summary(self.steps, self.contacts, "frame", F.col("is_floor"), F.col("dist"), capacity=5)

    @cached_property
    def scores(self) -> DataFrame:
        from cliploom.operators.checks import foot_sliding, motion_scores

        pick = lambda body, speed: F.coalesce(F.max(F.when(F.col("body") == body, speed * F.col("vz"))), F.lit(0.0))
        feet = self.bodies.filter("body <= 2").groupBy("frame").agg(F.sum(foot_sliding(F.col("z"), F.col("vx"), F.col("vy"))).alias("slide"), pick(1, 21).alias("u0"), pick(2, 31).alias("u1"))
        rows = self.summary.join(feet, "frame", "left").fillna(0.0, ["slide", "u0", "u1"])
        return motion_scores(rows, {"u0": 20.0, "u1": 30.0}, FPS, seconds=0.06).withColumn("score", F.round("score", 9))

    @cached_property
    def embed(self) -> DataFrame:
        return self.table("embeddings")

    @cached_property
    def elements(self) -> DataFrame:
        return self.embed.select("vec_id", "label", F.posexplode("embedding").alias("step", "v")).select("vec_id", "label", F.col("step").cast("long").alias("step"), F.col("v").cast("double").alias("v"))

    @cached_property
    def points(self) -> DataFrame:
        return self.embed.select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate("xyz")])

    @cached_property
    def complexity(self) -> DataFrame:
        from cliploom.operators.kinematics import complexity, with_velocity

        return complexity(with_velocity(self.elements, ["v"], FPS, key="vec_id"), ["v_vel"], FPS, key="vec_id")

    @cached_property
    def ranked(self) -> DataFrame:
        from cliploom.operators.select import rank_normalize

        rows = self.complexity.withColumn("_c", F.round("complexity", 6))
        return rank_normalize(rows, "_c", "vec_id").drop("_c")

    @cached_property
    def segments(self) -> DataFrame:
        return self.table("conversations").filter("turn % 5 <> 3").select(F.col("conv_id").alias("source"), F.col("turn").alias("start"), (F.col("turn") + 1).alias("end"))

    @cached_property
    def catalog(self) -> DataFrame:
        stem = F.concat_ws("_", "source", F.col("doc_id").cast("string"))
        path = F.concat(F.lit("motions/"), F.col("lang"), F.lit("/"), stem, F.lit(".npz"))
        return self.table("documents").select("doc_id", path.alias("path"), stem.alias("stem"), "lang", "source", F.col("n_chars").alias("frames"))
