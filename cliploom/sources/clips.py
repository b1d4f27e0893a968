"""Clip archives (.npz) as a data source, and dataset folders: manifests, views, legacy clips, sinks, caches."""

from __future__ import annotations

import atexit
import hashlib
import json
import os
import shutil
import tarfile
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from pathlib import Path, PurePosixPath

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FRAMES = "motion string, step long, qpos array<float>"
PER_PARTITION = 64


def load_motion(path: str) -> np.ndarray:
    """One clip's qpos, float32 [frames, width]; a vector is one frame."""
    with np.load(path) as z:
        if "qpos" not in z:
            raise KeyError(f"no qpos in {path}")
        qpos = np.asarray(z["qpos"], np.float32)
    if qpos.ndim == 1:
        qpos = qpos[None, :]
    if qpos.ndim != 2:
        raise ValueError(f"qpos must have two dimensions in {path}, has {qpos.ndim}")
    return qpos


def save_motion(path: str, qpos: np.ndarray) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    np.savez_compressed(path, qpos=np.asarray(qpos, np.float32))


class _Files(InputPartition):
    def __init__(self, root: str, names: list[str]) -> None:
        self.root, self.names = root, names


class _Reader(DataSourceReader):
    def __init__(self, root: str) -> None:
        self.root = root
        self.names: set[str] | None = None

    def pushFilters(self, filters):  # noqa: ANN001
        """Equality and membership on motion choose the files; all filters are applied by Spark again."""
        for f in filters:
            if getattr(f, "attribute", None) == ("motion",):
                wanted = {f.value} if type(f).__name__ == "EqualTo" else set(f.value) if type(f).__name__ == "In" else None
                if wanted is not None:
                    self.names = wanted if self.names is None else self.names & wanted
            yield f

    def partitions(self) -> list[_Files]:
        names = [n for n in motion_names(self.root) if self.names is None or n in self.names]
        return [_Files(self.root, names[i : i + PER_PARTITION]) for i in range(0, len(names), PER_PARTITION)] or [_Files(self.root, [])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        for name in partition.names:
            qpos = load_motion(f"{partition.root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(qpos)), pa.array(np.arange(len(qpos))), pa.array(list(qpos), pa.list_(pa.float32()))], names=["motion", "step", "qpos"])


class _Writer(DataSourceWriter):
    def __init__(self, root: str) -> None:
        self.root = root

    def write(self, rows) -> WriterCommitMessage:  # noqa: ANN001
        held: dict[str, list] = {}
        for r in rows:
            held.setdefault(r.motion, []).append((r.step, r.qpos))
        for motion, frames in held.items():
            save_motion(f"{self.root}/{motion}", np.array([q for _, q in sorted(frames, key=lambda x: x[0])], np.float32))
        return WriterCommitMessage()


class MotionNpz(DataSource):
    """format("motion_npz"): a folder of .npz clips on a shared file system, as frames (motion, step, qpos).

    Write with the frames of a clip in one partition (repartition by motion).
    """

    @classmethod
    def name(cls) -> str:
        return "motion_npz"

    def schema(self) -> str:
        return FRAMES

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:  # noqa: ANN001
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MotionNpz)


def motion_names(root: str) -> list[str]:
    return sorted(p.relative_to(root).as_posix() for p in Path(root).rglob("*.npz"))


def read_motions(spark: SparkSession, root: str) -> DataFrame:
    """Frames of every clip under a folder; no clip is an error."""
    if not motion_names(root):
        raise FileNotFoundError(f"no .npz clips under {root}")
    register(spark)
    return spark.read.format("motion_npz").load(root)


def write_motions(frames: DataFrame, root: str) -> None:
    register(frames.sparkSession)
    frames.select("motion", F.col("step").cast("long").alias("step"), F.col("qpos").cast("array<float>").alias("qpos")).repartition("motion").write.format("motion_npz").mode("append").save(root)


def find_root(path: str) -> Path:
    """The nearest folder at or above path that holds a manifest."""
    p = Path(path).expanduser().absolute()
    for folder in [p, *p.parents]:
        if (folder / "manifest.json").is_file():
            return folder
    raise FileNotFoundError(f"no manifest.json at or above {path}")


def input_path(base: str, path: str) -> Path:
    p = Path(path).expanduser()
    return p if p.is_absolute() else Path(base) / p


def load_manifest(root: str) -> dict:
    return json.loads((Path(root) / "manifest.json").read_text())


def write_manifest(root: str, clips: DataFrame, frames: str, **known) -> dict:
    """Write the manifest with the number of clips and hours of clips(frames); known: name, mjcf, timestep, ..."""
    total = clips.agg(F.count("*").alias("n"), F.coalesce(F.sum(frames), F.lit(0)).alias("f")).first()
    out = {"format_version": 2, "motions_subdir": "motions", **known, "num_motions": total.n, "total_hours": total.f * known["timestep"] / 3600}
    os.makedirs(root, exist_ok=True)
    (Path(root) / "manifest.json").write_text(json.dumps(out, indent=2) + "\n")
    return out


def view_names(root: str, names: Sequence[str] | None = None, path: str | None = None) -> list[str]:
    """A filenames view: given names, or those of a text file; either one, and not empty."""
    if (names is None) == (path is None):
        raise ValueError("give either names or a path")
    lines = list(names) if names is not None else (Path(root) / path if not Path(path).is_absolute() else Path(path)).read_text().splitlines()
    out = [x.strip() for x in lines if x.strip() and not x.strip().startswith("#")]
    if not out:
        raise ValueError("the view lists no file")
    return out


def resolve_view(root: str, names: Sequence[str], folder: str = "motions") -> list[str]:
    """Names relative to the clips' folder in the given order; escapes, other endings, duplicates and absent
    files are errors. A link may only lead to a blob store beside its snapshot."""
    base, out = Path(root) / folder, []
    for name in names:
        p = PurePosixPath(name)
        if p.is_absolute() or ".." in p.parts or p.suffix != ".npz":
            raise ValueError(f"not a clip in the dataset: {name}")
        rel = p.as_posix().removeprefix(f"{folder}/")
        full = base / rel
        if not full.is_file():
            raise FileNotFoundError(f"no clip {full}")
        real, inside = full.resolve(), base.resolve()
        if inside not in real.parents and not (full.is_symlink() and "blobs" in real.parts and "snapshots" in full.absolute().parts):
            raise ValueError(f"a link leads out of the dataset: {name}")
        if rel in out:
            raise ValueError(f"listed twice: {name}")
        out.append(rel)
    return out


def collect_motions(paths: Sequence[str]) -> list[Path]:
    """The distinct clips of files and folders, sorted; all must lie under one dataset."""
    found: set[Path] = set()
    for p in map(Path, paths):
        found |= {p.absolute()} if p.is_file() else {x.absolute() for x in p.rglob("*.npz")}
    if not found:
        raise FileNotFoundError("no clips")
    if len({find_root(str(p)) for p in found}) > 1:
        raise ValueError("the clips belong to several datasets")
    return sorted(found)


LEGACY = ("body_pos_w", "body_lin_vel_w", "body_quat_w", "body_ang_vel_w", "joint_pos", "joint_vel")


def dataset_kind(path: str) -> str:
    """clips or legacy (motion.npz beside meta.json); a mixture is an error."""
    p = Path(path)
    legacy = any((x.parent / "meta.json").is_file() for x in p.rglob("motion.npz"))
    try:
        find_root(path)
        plain = True
    except FileNotFoundError:
        plain = False
    if legacy and plain:
        raise ValueError("a dataset is either of clips or legacy")
    if not legacy and not plain:
        raise FileNotFoundError(f"no dataset at {path}")
    return "legacy" if legacy else "clips"


def read_legacy(spark: SparkSession, root: str) -> tuple[DataFrame, dict]:
    """Frames (motion, step, the six fields) of legacy clips and their common meta; metas may differ in length only."""
    files = sorted(Path(root).rglob("motion.npz"))
    metas = [json.loads((f.parent / "meta.json").read_text()) for f in files]
    common = [{k: v for k, v in m.items() if k != "length"} for m in metas]
    if not files or any(c != common[0] for c in common):
        raise ValueError("legacy clips must exist and share their meta data")
    names = spark.createDataFrame([(f.parent.relative_to(root).as_posix(), str(f)) for f in files], "motion string, path string").repartition(max(1, len(files) // PER_PARTITION))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for motion, path in zip(b.column("motion").to_pylist(), b.column("path").to_pylist(), strict=True):
                with np.load(path) as z:
                    n = len(z[LEGACY[0]])
                    fields = [pa.array(z[f].reshape(n, -1).astype(np.float32).tolist(), pa.list_(pa.float32())) for f in LEGACY]
                yield pa.RecordBatch.from_arrays([pa.array([motion] * n), pa.array(np.arange(n)), *fields], names=["motion", "step", *LEGACY])

    return names.mapInArrow(run, "motion string, step long, " + ", ".join(f"{f} array<float>" for f in LEGACY)), common[0]


def load_segments_npz(path: str) -> dict[str, np.ndarray]:
    """root_pos [T, 3], root_rot [T, 4] (x, y, z, w), dof_pos [T, D] of equal T."""
    with np.load(path) as z:
        absent = [k for k in ("root_pos", "root_rot", "dof_pos") if k not in z]
        if absent:
            raise KeyError(f"missing in {path}: {', '.join(absent)}")
        out = {k: np.asarray(z[k], np.float64) for k in ("root_pos", "root_rot", "dof_pos")}
    if len({len(x) for x in out.values()}) != 1 or out["root_pos"].shape[1:] != (3,) or out["root_rot"].shape[1:] != (4,):
        raise ValueError(f"shapes don't fit in {path}")
    return out


def read_segments(spark: SparkSession, root: str) -> DataFrame:
    """Frames (motion, step, root_pos, root_rot, dof_pos) of every such archive under a folder, read on the workers."""
    files = motion_names(root)
    if not files:
        raise FileNotFoundError(f"no .npz clips under {root}")
    names = spark.createDataFrame([(f,) for f in files], "motion string").repartition(-(-len(files) // PER_PARTITION))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for motion in b.column("motion").to_pylist():
                held = load_segments_npz(f"{root}/{motion}")
                n = len(held["root_pos"])
                yield pa.RecordBatch.from_arrays([pa.array([motion] * n), pa.array(np.arange(n)), *(pa.array(x.tolist(), pa.list_(pa.float64())) for x in held.values())], names=["motion", "step", *held])

    return names.mapInArrow(run, "motion string, step long, root_pos array<double>, root_rot array<double>, dof_pos array<double>")


RAW_TYPES = {"torch.float16": np.float16, "torch.float32": np.float32, "torch.int32": np.int32, "torch.int64": np.int64}


def load_raw_field(folder: str, name: str) -> np.ndarray:
    """A field of a raw field store: its type and shape from meta.json, its numbers from <name>.memmap."""
    meta = json.loads((Path(folder) / "meta.json").read_text())[name]
    if meta["dtype"] not in RAW_TYPES:
        raise ValueError(f"unsupported type {meta['dtype']}")
    return np.memmap(Path(folder) / f"{name}.memmap", RAW_TYPES[meta["dtype"]], "r", shape=tuple(meta["shape"]))


def safe_extract(archive: str, to: str) -> None:
    """Extract a tar archive without links and without paths that lead out of the folder."""
    inside = Path(to).resolve()
    with tarfile.open(archive) as t:
        for m in t.getmembers():
            if m.issym() or m.islnk() or not (inside / m.name).resolve().is_relative_to(inside):
                raise ValueError(f"unsafe archive member: {m.name}")
        t.extractall(to, filter="data")


def cache_key(root: str, fps: float, files: Sequence[str], model: str = "", version: int = 1) -> str:
    """16 hex digits over the version, the rate, the model's text and each file's size and time."""
    stats = [(f, os.stat(f"{root}/{f}").st_size, os.stat(f"{root}/{f}").st_mtime_ns) for f in files]
    return hashlib.sha256(json.dumps([version, str(root), fps, model, stats], sort_keys=True).encode()).hexdigest()[:16]


def is_current(meta: dict, wanted: dict) -> bool:
    """Whether a cache's recorded settings (version, source key, window, rate, stride, ...) are all as wanted."""
    return all(meta.get(k) == v for k, v in wanted.items())


def scratch(spark: SparkSession) -> str:
    """A new folder in the cluster's shared one (spark.checkpoint.dir), deleted at exit; local sessions may do without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = (shared or tempfile.gettempdir()).removeprefix("file://")
    folder = f"{base}/cliploom-files-{uuid.uuid4().hex[:12]}"
    os.makedirs(folder)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def cache_settings(spark: SparkSession, path: str) -> dict | None:
    """The settings of a published cache; None if there is none."""
    fs, told = _fs(spark, f"{path}/_settings.json")
    if not fs.exists(told):
        return None
    stream = fs.open(told)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def cached(spark: SparkSession, folder: str, key: str, build, settings: dict | None = None) -> DataFrame:  # noqa: ANN001
    """The table under folder/key, built once for its settings.

    A builder writes to a folder of its own and publishes it whole by a rename that fails if another was first; the
    loser reads the winner's table. A cache of other settings is replaced.
    """
    path, settings = f"{folder}/{key}", settings or {}
    there = cache_settings(spark, path)
    if there is not None and is_current(there, settings) and is_current(settings, there):
        return spark.read.parquet(path)
    own = f"{folder}/.{key}-{uuid.uuid4().hex}"
    build().write.parquet(own)
    fs, stage = _fs(spark, own)
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{own}/_settings.json"))
    out.write(bytearray(json.dumps(settings, sort_keys=True).encode()))
    out.close()
    _, final = _fs(spark, path)
    if there is not None:
        fs.delete(final, True)
    options = spark._jvm.org.apache.hadoop.fs.Options
    plain = spark.sparkContext._gateway.new_array(options.Rename, 0)
    try:
        files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        files.rename(fs.makeQualified(stage), fs.makeQualified(final), plain)
    except Py4JJavaError as e:
        fs.delete(stage, True)
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
    return spark.read.parquet(path)


def copy_subset(frames: DataFrame, chosen: DataFrame, root: str, timestep: float, **known) -> dict:
    """Write the chosen clips' frames and a manifest of them; returns the manifest."""
    kept = frames.join(chosen.select("motion"), "motion", "left_semi")
    write_motions(kept, f"{root}/motions")
    return write_manifest(root, kept.groupBy("motion").agg(F.count("*").alias("frames")), "frames", timestep=timestep, **known)


def write_report(clips: DataFrame, folder: str) -> None:
    """Score rows as JSON lines, kept file names as text, totals as JSON; each written by Spark."""
    clips.write.mode("overwrite").json(f"{folder}/scores")
    clips.filter("status = 'kept'").select("motion").write.mode("overwrite").text(f"{folder}/filenames")
    clips.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "kept").alias("kept")).write.mode("overwrite").json(f"{folder}/summary")
