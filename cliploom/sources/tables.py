"""Readers of text formats, on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCORES = "details array<struct<motion: string, physical_score: string>>"
MANIFEST = (
    "format_version int, dataset_name string, mjcf string, motions_subdir string, timestep double, fps double, qpos_dim int, qpos_names array<string>, "
    "num_motions long, source string, total_hours double"
)


def parse_scores(text: DataFrame, column: str = "value") -> DataFrame:
    """(motion, physical_score) rows of score reports, one report a row; numbers may be given as text.

    A row without a motion or with a score that isn't a number raises an error.
    """
    rows = text.select(F.from_json(column, SCORES).alias("r")).select(F.inline("r.details"))
    score = rows.physical_score.try_cast("double")
    bad = F.col("motion").isNull() | score.isNull()
    return rows.select(F.when(bad, F.raise_error(F.lit("a score row needs a motion and a number")).cast("string")).otherwise(F.col("motion")).alias("motion"), score.alias("physical_score"))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return parse_scores(spark.read.text(path, wholetext=True))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifests as rows; the free-form source stays JSON text."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True)


def read_positional_csv(spark: SparkSession, path: str, width: int) -> DataFrame:
    """(file, line, values) of headerless numeric files; a row of another width raises an error."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"), F.split("value", ",").alias("raw")).filter("raw[0] <> '' or size(raw) > 1")
    values = F.transform("raw", lambda x: x.cast("double"))
    checked = F.when(F.size("raw") != width, F.raise_error(F.concat(F.lit(f"expected {width} columns in "), F.col("file"))).cast("array<double>")).otherwise(values)
    return text.select("file", "line", checked.alias("values"))


def read_named_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of files with a header; missing ones raise an error that lists them."""
    table = spark.read.csv(path, header=True)
    absent = [c for c in columns if c not in table.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return table.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"), *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])


def walk_csv_to_qpos(rows: DataFrame, values: str = "values") -> DataFrame:
    """36 columns (metres, x y z w, radians) as qpos: position, w x y z, joints."""
    v = F.col(values)
    return rows.withColumn("qpos", F.concat(F.slice(v, 1, 3), F.array(v[6], v[3], v[4], v[5]), F.slice(v, 8, 29)))


def suit_csv_to_qpos(rows: DataFrame, translation: Sequence[str], rotation: Sequence[str], joints: Sequence[str], order: str = "xyz", frame: str = "extrinsic", scale: float = 0.01) -> DataFrame:
    """Centimetres and degrees by name as qpos: scaled position, quaternion of the Euler angles, joints in radians."""
    from cliploom.functions import euler

    q = euler([F.radians(c) for c in rotation], order, frame)
    return rows.withColumn("qpos", F.array(*[F.col(c) * scale for c in translation], *q, *[F.radians(c) for c in joints]))


def frame_slice(rows: DataFrame, step: Column, start: int = 0, end: int = -1, stride: int = 1) -> DataFrame:
    """Frames start <= step < end (to the end if negative), every stride-th."""
    stride = max(1, stride)
    keep = (step >= start) & ((step - start) % stride == 0)
    return rows.filter(keep & (step < end) if end >= 0 else keep)


def read_complexities(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True).select("motion", F.col("complexity_raw").cast("double").alias("complexity_raw"))
