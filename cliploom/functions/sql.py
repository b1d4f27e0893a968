"""SQL-callable functions: scalar ones as SQL expressions (no Python), a table function and an aggregate."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCALARS = {
    "quat_yaw": ("w DOUBLE, x DOUBLE, y DOUBLE, z DOUBLE", "DOUBLE", "atan2(2 * (w * z + x * y), w * w + x * x - y * y - z * z)"),
    "quat_angle": ("aw DOUBLE, ax DOUBLE, ay DOUBLE, az DOUBLE, bw DOUBLE, bx DOUBLE, by DOUBLE, bz DOUBLE", "DOUBLE", "2 * acos(least(abs(aw * bw + ax * bx + ay * by + az * bz), 1D))"),
    "lerp": ("a DOUBLE, b DOUBLE, t DOUBLE", "DOUBLE", "a * (1 - t) + b * t"),
    "window_length": ("seconds DOUBLE, fps DOUBLE, downsample INT", "INT", "cast(floor(seconds * fps / downsample) as int) + 2 - (cast(floor(seconds * fps / downsample) as int) + 1) % 2"),
    "resampled_length": ("n BIGINT, source DOUBLE, target DOUBLE", "BIGINT", "if(n = 1 or source = target, n, cast(floor((n - 1) / source * target + 1e-9) as bigint) + 1)"),
    "path_stem": ("path STRING", "STRING", "regexp_replace(substring_index(path, '/', -1), '(?<=.)\\\\.[^.]*$', '')"),
}


class WindowSteps:
    """window_steps(length, size, downsample, stride) -> rows (window_id, pos, step) of the dilated windows."""

    def eval(self, length: int, size: int, downsample: int, stride: int) -> Iterator[tuple[int, int, int]]:
        half = (size - 1) // 2
        for i, centre in enumerate(range(half * downsample, length - half * downsample, max(1, stride))):
            for pos in range(2 * half + 1):
                yield i, pos, centre + (pos - half) * downsample


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL in this session."""
    import pandas as pd

    for name, (arguments, kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION clip_{name}({arguments}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("clip_window_steps", F.udtf(WindowSteps, returnType="window_id int, pos int, step long"))

    def run(step: pd.Series, flag: pd.Series) -> int:
        held = flag.to_numpy()[step.to_numpy().argsort()]
        best = now = 0
        for x in held:
            now = now + 1 if x else 0
            best = max(best, now)
        return best

    run.__annotations__ = {"step": pd.Series, "flag": pd.Series, "return": int}
    spark.udf.register("clip_longest_run", F.pandas_udf(run, "long"))


__all__ = ["WindowSteps", "register"]
