"""Plans over v_segments: numbered parts of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.operators import segments
from cliploom.plans.registry import plan
from cliploom.plans.views import Views

RUNS = """SELECT source, run, min(start) AS start, max("end") AS "end", count(*) AS parts FROM (SELECT *, sum(new) OVER (PARTITION BY source ORDER BY start, "end") AS run FROM (
    SELECT *, CASE WHEN lag("end") OVER (PARTITION BY source ORDER BY start, "end") <> start THEN 1 ELSE 0 END AS new FROM v_segments)) GROUP BY source, run"""
SUFFIXED = f'SELECT source, CAST(run AS BIGINT) AS run, start, "end", parts, count(*) OVER (PARTITION BY source) > 1 OR start <> 0 AS use_suffix FROM ({RUNS})'


@plan(SUFFIXED)
def merge_segments(v: Views) -> DataFrame:
    return segments.merge_runs(v.segments, "source", "start", "end")


@plan(f"SELECT CASE WHEN use_suffix THEN 'clip_' || source || '__' || lpad(CAST(start AS VARCHAR), 6, '0') || '_' || lpad(CAST(\"end\" AS VARCHAR), 6, '0') || '.npz' ELSE 'clip_' || source || '.npz' END AS filename FROM ({SUFFIXED})")
def output_name(v: Views) -> DataFrame:
    runs = segments.merge_runs(v.segments, "source", "start", "end")
    stem = F.concat(F.lit("clip_"), F.col("source").cast("string"))
    return runs.select(segments.output_name(stem, F.col("start"), F.col("end"), F.col("use_suffix")).alias("filename"))


@plan("SELECT source, start, CAST(at_ + off AS BIGINT) AS out_step FROM (SELECT source, start, sum(3) OVER (PARTITION BY source ORDER BY start) - 3 AS at_ FROM v_segments) CROSS JOIN (SELECT unnest([0, 1, 2]) AS off)")
def concat_segments(v: Views) -> DataFrame:
    frames = v.segments.select("source", "start", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("step"))
    return segments.concatenated(frames, "source", "start", "step").select("source", "start", "out_step")


NAMED = "SELECT 'clip' || conv_id || CASE WHEN conv_id % 7 = 0 THEN '_take' ELSE '' END || CASE WHEN conv_id % 5 = 0 AND turn = 0 THEN '' ELSE '_' || (turn + 1) END || '.npz' AS name FROM conversations WHERE NOT (conv_id % 4 = 0 AND turn = 1)"


@plan(
    f"""SELECT CASE WHEN base <> '' AND parts > 1 THEN base || '.npz' ELSE name END AS output, parts, base <> '' AND parts > 1 AS is_group, NOT (base <> '' AND parts > 1) OR (low = 1 AND high = parts AND different = parts) AS valid FROM (
    SELECT min(base) AS base, min(name) AS name, count(*) AS parts, min(i) AS low, max(i) AS high, count(DISTINCT i) AS different FROM (
    SELECT name, regexp_extract(name, '^(.+)_([1-9][0-9]*)\\.npz$', 1) AS base, try_cast(regexp_extract(name, '^(.+)_([1-9][0-9]*)\\.npz$', 2) AS BIGINT) AS i FROM ({NAMED})) GROUP BY CASE WHEN base = '' THEN name ELSE base || '#' END)"""
)
def segment_groups(v: Views) -> DataFrame:
    take = F.when(F.col("conv_id") % 7 == 0, "_take").otherwise("")
    part = F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 0), "").otherwise(F.concat(F.lit("_"), (F.col("turn") + 1).cast("string")))
    names = v.table("conversations").filter("not (conv_id % 4 = 0 and turn = 1)").select(F.concat(F.lit("clip"), F.col("conv_id").cast("string"), take, part, F.lit(".npz")).alias("name"))
    return segments.numbered_parts(names, "name")


@plan("SELECT count(DISTINCT role) AS kinds, count(DISTINCT role) = 1 AS consistent, conv_id FROM conversations GROUP BY conv_id")
def meta_consistency(v: Views) -> DataFrame:
    kinds = F.count_distinct("role")
    return v.table("conversations").groupBy("conv_id").agg(kinds.alias("kinds"), (kinds == 1).alias("consistent"))


@plan("SELECT source, i, start, label FROM (SELECT source, row_number() OVER (PARTITION BY source ORDER BY start) - 1 AS i, start FROM v_segments) a JOIN (SELECT conv_id AS source, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, role || turn AS label FROM conversations WHERE turn % 5 <> 3) b USING (source, i)")
def zip_join(v: Views) -> DataFrame:
    starts = v.segments.groupBy("source").agg(F.sort_array(F.collect_list("start")).alias("starts"))
    labels = v.table("conversations").filter("turn % 5 <> 3").groupBy(F.col("conv_id").alias("source")).agg(F.sort_array(F.collect_list(F.struct("turn", F.concat("role", F.col("turn").cast("string")).alias("label")))).alias("l"))
    zipped = starts.join(labels, "source").select("source", F.posexplode(F.arrays_zip("starts", F.col("l.label").alias("label"))).alias("i", "z"))
    return zipped.select("source", F.col("i").cast("long").alias("i"), F.col("z.starts").alias("start"), F.col("z.label").alias("label"))
