"""Scalar expressions on columns and, where a plan needs the number, on Python values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lerp(a: Column, b: Column, t: Column) -> Column:
    return a * (1 - t) + b * t


def norm(parts: Sequence[Column]) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def window_length(seconds: float, fps: float, downsample: int) -> int:
    """Samples in a window of `seconds`, made odd."""
    n = int(seconds * fps / downsample) + 1
    return n + 1 - n % 2


def resampled_length(length: Column, source: float, target: float) -> Column:
    """Frames after resampling; single frames and equal rates stay as they are."""
    if source <= 0 or target <= 0:
        raise ValueError("rates must be positive")
    if source == target:
        return length.cast("long")
    many = F.floor((length - 1) / F.lit(float(source)) * F.lit(float(target)) + F.lit(1e-9)) + 1
    return F.when(length == 1, 1).otherwise(many).cast("long")


def integer_resampled_length(length: Column, source: int, target: int) -> Column:
    """The same for whole rates, in whole numbers."""
    return (F.floor((length - 1) * target / F.lit(source)) + 1).cast("long")


def degrees_to_radians(angle: Column, unit: str) -> Column:
    if unit not in ("degrees", "radians"):
        raise ValueError(f"unit must be degrees or radians: {unit}")
    return F.radians(angle) if unit == "degrees" else angle


def source_fps(fps: Column, timestep: Column) -> Column:
    """A positive rate wins over the step's inverse."""
    return F.when(fps > 0, fps).otherwise(1 / timestep)


def path_stem(path: Column) -> Column:
    """Name of the last path segment without its last ending."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def hub_reference(uri: Column) -> dict[str, Column]:
    """Parts of scheme://namespace/name[@revision][/path]; the revision defaults to main."""
    pattern = r"^[a-z]+://([^/@?#]+)/([^/@?#]+)(?:@([^/?#]+))?(?:/([^?#]*))?"
    part = lambda i: F.regexp_extract(uri, pattern, i)
    return {"namespace": part(1), "name": part(2), "revision": F.when(part(3) == "", "main").otherwise(part(3)), "path": part(4)}
