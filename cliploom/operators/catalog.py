"""Catalogs of clips: scans, views, whitelists, unions, name checks, cache keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.scalars import path_stem


def view_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trimmed lines of a list of files, without blank lines and comments."""
    text = F.regexp_replace(column, r"^\s+|\s+$", "")
    return lines.withColumn(column, text).filter((F.col(column) != "") & ~F.col(column).startswith("#"))


def view_path(name: Column, folder: str = "motions") -> Column:
    """A listed name relative to the clips' folder; absolute paths, .. and other endings raise an error."""
    plain = F.regexp_replace(name, f"^{folder}/", "")
    bad = plain.startswith("/") | F.array_contains(F.split(plain, "/"), "..") | ~plain.endswith(".npz")
    return F.when(bad, F.raise_error(F.concat(F.lit("not a clip in the dataset: "), name))).otherwise(plain)


def filenames_view(view: DataFrame, catalog: DataFrame, name: str, position: str, path: str) -> DataFrame:
    """Catalog rows that the view lists, with their place in the view."""
    return view.select(F.col(name).alias(path), position).join(catalog, path)


def duplicates(rows: DataFrame, column: str) -> DataFrame:
    """(column, n) of the values that stand more than once."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def union_paths(*sources: DataFrame) -> DataFrame:
    """The distinct rows of all sources."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    return out.distinct()


def name_token(text: Column) -> Column:
    """A whitelist line's first token (up to a tab, then a space), without folders and ending."""
    return path_stem(F.substring_index(F.substring_index(F.trim(text), "\t", 1), " ", 1))


def kept_by_names(clips: DataFrame, keep: DataFrame, stem: str) -> DataFrame:
    """clips with status: kept if their stem is listed, else rejected, with the reason."""
    listed = keep.select(F.col(stem)).distinct().withColumn("_in", F.lit(True))
    held = clips.join(listed, stem, "left")
    inside = F.col("_in").isNotNull()
    return held.withColumns({"status": F.when(inside, "kept").otherwise("rejected"), "reason": F.when(~inside, "not_in_keep_filenames")}).drop("_in")


def whitelist_coverage(clips: DataFrame, keep: DataFrame, stem: str) -> DataFrame:
    """total, matched and missing names of a whitelist."""
    found = clips.select(stem).distinct().withColumn("_f", F.lit(1))
    held = keep.select(stem).distinct().join(found, stem, "left")
    return held.agg(F.count("*").alias("total"), F.count("_f").alias("matched"), (F.count("*") - F.count("_f")).alias("missing"))


def missing(required: DataFrame, present: DataFrame, column: str) -> DataFrame:
    return required.select(column).distinct().join(present.select(column), column, "left_anti")


def collisions(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def cache_key(version: int, parts: Sequence[Column]) -> Column:
    """The first 16 hex digits of sha256 over the version and the parts."""
    return F.substring(F.sha2(F.concat_ws("|", F.lit(str(version)), *[p.cast("string") for p in parts]), 256), 1, 16)


def manifest_summary(clips: DataFrame, frames: str, timestep: float, by: Sequence[str] = ()) -> DataFrame:
    """num_motions, total_frames and total_hours, per group."""
    return clips.groupBy(*by).agg(F.count("*").alias("num_motions"), F.sum(frames).alias("total_frames"), (F.sum(frames) * timestep / 3600).alias("total_hours"))
