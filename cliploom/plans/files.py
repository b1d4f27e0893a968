"""Plans that write files of a format and read them back: archives, text tables, caches and copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.operators.physics import gmr_to_qpos
from cliploom.plans.registry import plan
from cliploom.plans.rigid import POS, Q
from cliploom.plans.views import FPS, Views, r9
from cliploom.sources import clips, tables

WIDTH = ("px", "py", "pz", "qw", "qx", "qy", "qz", "j0", "j1")
NAME = "'clip_' || lpad(CAST(motion_id AS VARCHAR), 6, '0') || '.npz'"
SINGLE = "unnest([" + ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE)" for c in WIDTH) + "])"


def _named(v: Views) -> DataFrame:
    name = F.concat(F.lit("clip_"), F.lpad(F.col("motion_id").cast("string"), 6, "0"), F.lit(".npz"))
    return v.rigid.select(name.alias("motion"), "step", F.array(*WIDTH).alias("qpos"))


@plan(f"SELECT motion, step, pos, round(value, 4) + 0.0 AS value FROM (SELECT {NAME} AS motion, step, CAST(unnest(range(9)) AS INTEGER) AS pos, {SINGLE} AS value FROM v_rigid)")
def clip_archives(v: Views) -> DataFrame:
    """Every clip written as an archive of single-precision numbers, and read by the data source."""
    root = f"{clips.scratch(v.spark)}/motions"
    clips.write_motions(_named(v), root)
    out = clips.read_motions(v.spark, root).select("motion", "step", F.posexplode(F.col("qpos").cast("array<double>")).alias("pos", "value"))
    return out.withColumn("value", r9("value", 4))


@plan(f"SELECT {NAME} AS motion, count(*) AS frames FROM v_rigid WHERE motion_id % 3 = 1 GROUP BY motion_id")
def subset_copy(v: Views) -> DataFrame:
    """A third of the clips copied with a manifest of them."""
    root, held = clips.scratch(v.spark), _named(v)
    chosen = v.lengths.filter("motion_id % 3 = 1").select(F.concat(F.lit("clip_"), F.lpad(F.col("motion_id").cast("string"), 6, "0"), F.lit(".npz")).alias("motion"))
    told = clips.copy_subset(held, chosen, root, 1 / FPS, dataset_name="subset")
    out = clips.read_motions(v.spark, f"{root}/motions").groupBy("motion").agg(F.count("*").alias("frames"))
    if told["num_motions"] != len(clips.motion_names(f"{root}/motions")):
        raise ValueError("the manifest and the copied clips differ")
    return out


@plan("SELECT motion_id, step, CAST(pos AS INTEGER) AS pos, round(value, 9) + 0.0 AS value FROM (SELECT motion_id, step, unnest(range(9)) AS pos, unnest([px, py, pz, qw, qx, qy, qz, j0, j1]) AS value FROM v_rigid)")
def walk_csv(v: Views) -> DataFrame:
    """Clips as headerless rows of 36 numbers (quaternion last component first) and back; the last two carry the frame."""
    path = f"{clips.scratch(v.spark)}/walk"
    values = [*POS, *Q[1:], Q[0], "j0", "j1", *[F.lit(0.0)] * 25, F.col("motion_id"), F.col("step")]
    v.rigid.select(F.concat_ws(",", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in values]).alias("value")).write.text(path)
    rows = tables.walk_csv_to_qpos(tables.read_positional_csv(v.spark, path, 36))
    out = rows.select(F.col("qpos")[34].cast("long").alias("motion_id"), F.col("qpos")[35].cast("long").alias("step"), F.posexplode(F.slice("qpos", 1, 9)).alias("pos", "value"))
    return out.withColumn("value", r9("value"))


@plan("SELECT motion_id, step, round(x * 0.01, 9) AS px, round(cos(radians(k * 1.0) / 2), 9) + 0.0 AS qw, round(sin(radians(k * 1.0) / 2), 9) + 0.0 AS qz, round(radians(x), 7) + 0.0 AS j0 FROM v_frames")
def suit_csv(v: Views) -> DataFrame:
    """Clips as named columns in centimetres and degrees, read as qpos; the last joints carry the frame."""
    path, zero = f"{clips.scratch(v.spark)}/suit", F.lit(0.0)
    held = v.frames.select(F.col("x").alias("tx"), zero.alias("ty"), zero.alias("tz"), zero.alias("rx"), zero.alias("ry"), F.col("k").cast("double").alias("rz"), F.col("x").alias("hip"), F.degrees(F.col("motion_id").cast("double")).alias("m"), F.degrees(F.col("step").cast("double")).alias("s"))
    held.write.csv(path, header=True)
    rows = tables.read_named_csv(v.spark, path, ["tx", "ty", "tz", "rx", "ry", "rz", "hip", "m", "s"])
    q = F.col("qpos")
    out = tables.suit_csv_to_qpos(rows, ["tx", "ty", "tz"], ["rx", "ry", "rz"], ["hip", "m", "s"])
    return out.select(F.round(q[8]).cast("long").alias("motion_id"), F.round(q[9]).cast("long").alias("step"), r9(q[0]).alias("px"), r9(q[3]).alias("qw"), r9(q[6]).alias("qz"), r9(q[7], 7).alias("j0"))


@plan("SELECT CAST(vec_id AS VARCHAR) AS motion, round(complexity, 6) AS complexity_raw FROM v_complexity")
def complexity_csv(v: Views) -> DataFrame:
    path = f"{clips.scratch(v.spark)}/complexity"
    v.complexity.select(F.col("vec_id").cast("string").alias("motion"), F.col("complexity").alias("complexity_raw")).write.csv(path, header=True)
    return tables.read_complexities(v.spark, path).withColumn("complexity_raw", F.round("complexity_raw", 6))


@plan("SELECT motion_id, length, CAST(b AS INTEGER) AS built FROM v_lengths CROSS JOIN (SELECT unnest([1, 2]) AS b)")
def feature_cache(v: Views) -> DataFrame:
    """A cache is built once for its settings, and again when a setting changes."""
    folder, made = clips.scratch(v.spark), []

    def build() -> DataFrame:
        made.append(1)
        return v.lengths.withColumn("built", F.lit(len(made)))

    settings = {"version": 1, "fps": FPS, "stride": 2}
    first = [clips.cached(v.spark, folder, "a", build, settings) for _ in range(2)][1]
    other = [clips.cached(v.spark, folder, "b", build, settings | {"stride": s}) for s in (2, 2)][1]
    if len(made) != 2 or clips.cache_settings(v.spark, f"{folder}/a") != settings:
        raise ValueError("the cache was built too often")
    return first.unionByName(other)


@plan("SELECT motion_id, step, CAST(pos AS INTEGER) AS pos, round(value, 7) + 0.0 AS value FROM (SELECT motion_id, step, unnest(range(9)) AS pos, unnest([px, py, pz, qw, qx, qy, qz, j0, j1]) AS value FROM v_rigid)")
def segment_archives(v: Views) -> DataFrame:
    """Clips as archives of root position, rotation (w last) and joints, read file by file on the workers."""
    root = f"{clips.scratch(v.spark)}/segments"

    def put(pdf):  # noqa: ANN001, ANN202
        import os

        import numpy as np

        pdf, name = pdf.sort_values("step"), int(pdf["motion_id"].iloc[0])
        os.makedirs(root, exist_ok=True)
        np.savez(f"{root}/{name}.npz", root_pos=pdf[list(POS)].to_numpy(), root_rot=pdf[[*Q[1:], Q[0]]].to_numpy(), dof_pos=pdf[["j0", "j1"]].to_numpy())
        return pdf[["motion_id"]].head(1)

    v.rigid.groupBy("motion_id").applyInPandas(put, "motion_id long").count()
    rows = clips.read_segments(v.spark, root)
    turned = [F.col("root_rot")[i] for i in range(4)]
    out = gmr_to_qpos(rows, [F.col("root_pos")[i] for i in range(3)], turned, [F.col("dof_pos")[i] for i in range(2)])
    out = out.select(F.regexp_extract("motion", r"^([0-9]+)\.npz$", 1).cast("long").alias("motion_id"), "step", F.posexplode("qpos").alias("pos", "value"))
    return out.withColumn("value", r9("value", 7))


@plan("SELECT motion_id, step, round(CAST(CAST(px AS FLOAT) AS DOUBLE), 4) + 0.0 AS x, round(CAST(CAST(j1 AS FLOAT) AS DOUBLE), 4) + 0.0 AS j1, 'legacy' AS kind, 50 AS fps FROM v_rigid")
def legacy_clips(v: Views) -> DataFrame:
    """Clips in the older layout, a folder each with its meta data."""
    root = f"{clips.scratch(v.spark)}/legacy"

    def put(pdf):  # noqa: ANN001, ANN202
        import json
        import os

        import numpy as np

        pdf, folder = pdf.sort_values("step"), f"{root}/{int(pdf['motion_id'].iloc[0])}"
        os.makedirs(folder, exist_ok=True)
        n, place, turn = len(pdf), pdf[list(POS)].to_numpy()[:, None], pdf[list(Q)].to_numpy()[:, None]
        fields = {"body_pos_w": place, "body_lin_vel_w": np.zeros((n, 1, 3)), "body_quat_w": turn, "body_ang_vel_w": np.zeros((n, 1, 3)), "joint_pos": pdf[["j0", "j1"]].to_numpy(), "joint_vel": np.zeros((n, 2))}
        np.savez(f"{folder}/motion.npz", **fields)
        with open(f"{folder}/meta.json", "w") as f:
            json.dump({"fps": FPS, "length": n}, f)
        return pdf[["motion_id"]].head(1)

    v.rigid.groupBy("motion_id").applyInPandas(put, "motion_id long").count()
    rows, meta = clips.read_legacy(v.spark, root)
    single = lambda field, i: r9(F.col(field)[i].cast("double"), 4)
    return rows.select(F.col("motion").cast("long").alias("motion_id"), "step", single("body_pos_w", 0).alias("x"), single("joint_pos", 1).alias("j1"), F.lit(clips.dataset_kind(root)).alias("kind"), F.lit(meta["fps"]).alias("fps"))
