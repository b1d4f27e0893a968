"""Kinematic models from MJCF, forward kinematics, contacts, and frame values that derive from them."""

from __future__ import annotations

import math
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.functions.rotations import normalize, reorder_xyzw

#: Widths of each joint type in positions and velocities.
WIDTH = {"free": (7, 6), "ball": (4, 3), "slide": (1, 1), "hinge": (1, 1)}


@dataclass
class Joint:
    name: str
    kind: str
    body: int
    axis: np.ndarray
    pos: np.ndarray
    qpos: int
    qvel: int


@dataclass
class Geom:
    name: str
    kind: str
    body: int
    size: list[float]
    pos: np.ndarray
    quat: np.ndarray


@dataclass
class Model:
    """Bodies in depth-first order (0 is the world), joints and geoms of an MJCF file."""

    bodies: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    pos: list[np.ndarray] = field(default_factory=list)
    quat: list[np.ndarray] = field(default_factory=list)
    joints: list[Joint] = field(default_factory=list)
    geoms: list[Geom] = field(default_factory=list)
    nq: int = 0
    nv: int = 0

    def body_id(self, name: str) -> int | None:
        return self.bodies.index(name) if name in self.bodies else None

    def hinges(self) -> list[Joint]:
        return [j for j in self.joints if j.kind == "hinge"]

    def qpos_names(self) -> list[str]:
        out = []
        for j in self.joints:
            if j.kind == "free":
                out += [f"{j.name}_{s}" for s in ("tx", "ty", "tz", "qw", "qx", "qy", "qz")]
            elif j.kind == "ball":
                out += [f"{j.name}_{s}" for s in ("qw", "qx", "qy", "qz")]
            else:
                out.append(j.name)
        return out

    def floor(self) -> int:
        """The geom named floor, else the first plane."""
        for i, g in enumerate(self.geoms):
            if g.name == "floor":
                return i
        for i, g in enumerate(self.geoms):
            if g.kind == "plane":
                return i
        raise ValueError("the model has neither a geom named floor nor a plane")

    def with_floor(self) -> Model:
        """This model, with a plane at height 0 if it has none."""
        if not any(g.kind == "plane" for g in self.geoms):
            self.geoms.append(Geom("floor", "plane", 0, [0.0, 0.0, 1.0], np.zeros(3), np.array([1.0, 0, 0, 0])))
        return self

    def tables(self, spark) -> dict[str, DataFrame]:
        """Dimension tables of bodies, joints and geoms."""
        return {
            "bodies": spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate(zip(self.bodies, self.parent, strict=True))], "body int, name string, parent int"),
            "joints": spark.createDataFrame([(i, j.name, j.kind, j.body, j.qpos, j.qvel) for i, j in enumerate(self.joints)], "joint int, name string, kind string, body int, qpos int, qvel int"),
            "geoms": spark.createDataFrame([(i, g.name, g.kind, g.body) for i, g in enumerate(self.geoms)], "geom int, name string, kind string, body int"),
        }


def _numbers(e: ET.Element, name: str, default: Sequence[float]) -> np.ndarray:
    return np.array([float(x) for x in e.get(name).split()] if e.get(name) else default, float)


def parse_model(xml: str) -> Model:
    """A model of nested bodies with free, ball, slide and hinge joints and plane, sphere and capsule geoms."""
    m = Model()

    def geoms(e: ET.Element, body: int) -> None:
        for g in e.findall("geom"):
            m.geoms.append(Geom(g.get("name", f"geom_{len(m.geoms)}"), g.get("type", "sphere"), body, _numbers(g, "size", [0.0]).tolist(), _numbers(g, "pos", [0, 0, 0]), _numbers(g, "quat", [1, 0, 0, 0])))

    def visit(e: ET.Element, parent: int) -> None:
        i = len(m.bodies)
        m.bodies.append(e.get("name", f"body_{i}"))
        m.parent.append(parent)
        m.pos.append(_numbers(e, "pos", [0, 0, 0]))
        m.quat.append(_numbers(e, "quat", [1, 0, 0, 0]))
        for j in [*e.findall("freejoint"), *e.findall("joint")]:
            kind = "free" if j.tag == "freejoint" else j.get("type", "hinge")
            axis = _numbers(j, "axis", [0, 0, 1])
            m.joints.append(Joint(j.get("name", f"joint_{len(m.joints)}"), kind, i, axis / max(np.linalg.norm(axis), 1e-12), _numbers(j, "pos", [0, 0, 0]), m.nq, m.nv))
            m.nq, m.nv = m.nq + WIDTH[kind][0], m.nv + WIDTH[kind][1]
        geoms(e, i)
        for child in e.findall("body"):
            visit(child, i)

    world = ET.fromstring(xml).find("worldbody")
    m.bodies, m.parent, m.pos, m.quat = ["world"], [-1], [np.zeros(3)], [np.array([1.0, 0, 0, 0])]
    geoms(world, 0)
    for b in world.findall("body"):
        visit(b, 0)
    return m


def _mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    aw, av, bw, bv = a[..., :1], a[..., 1:], b[..., :1], b[..., 1:]
    return np.concatenate([aw * bw - (av * bv).sum(-1, keepdims=True), aw * bv + bw * av + np.cross(av, bv)], axis=-1)


def _turn(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    u = q[..., 1:]
    t = 2 * np.cross(u, v)
    return v + q[..., :1] * t + np.cross(u, t)


def _unit(q: np.ndarray) -> np.ndarray:
    return q / np.maximum(np.linalg.norm(q, axis=-1, keepdims=True), 1e-12)


def kinematics(m: Model, qpos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions [frames, bodies, 3] and orientations [frames, bodies, 4] in the world, all frames at once."""
    if qpos.ndim != 2 or qpos.shape[1] != m.nq:
        raise ValueError(f"expected rows of {m.nq} positions, got {qpos.shape}")
    n = len(qpos)
    pos, quat = np.zeros((n, len(m.bodies), 3)), np.zeros((n, len(m.bodies), 4))
    quat[:, 0, 0] = 1
    own: dict[int, list[Joint]] = {}
    for j in m.joints:
        own.setdefault(j.body, []).append(j)
    for b in range(1, len(m.bodies)):
        p = m.parent[b]
        x = pos[:, p] + _turn(quat[:, p], np.broadcast_to(m.pos[b], (n, 3)))
        r = _mul(quat[:, p], np.broadcast_to(_unit(m.quat[b]), (n, 4)))
        for j in own.get(b, ()):
            value = qpos[:, j.qpos : j.qpos + WIDTH[j.kind][0]]
            if j.kind == "free":
                x, r = value[:, :3], _unit(value[:, 3:])
                continue
            anchor = x + _turn(r, np.broadcast_to(j.pos, (n, 3)))
            if j.kind == "slide":
                x = x + _turn(r, value * j.axis)
                continue
            half = value / 2
            turn = _unit(value) if j.kind == "ball" else np.concatenate([np.cos(half), np.sin(half) * j.axis], axis=1)
            r = _mul(r, turn)
            x = anchor - _turn(r, np.broadcast_to(j.pos, (n, 3)))
        pos[:, b], quat[:, b] = x, r
    return pos, quat


def forward_kinematics(frames: DataFrame, model: Model, qpos: str = "qpos", keep: Sequence[str] = ("motion_id", "step")) -> DataFrame:
    """keep columns with body_pos_w, body_quat_w (arrays of arrays) and joint_pos of the hinges.

    The model goes to the workers once with the plan; each Arrow batch is one vectorised pass.
    """
    kept = frames.select(*keep, qpos)
    at = [j.qpos for j in model.hinges()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            q = np.array(b.column(qpos).to_pylist(), np.float64)
            pos, quat = kinematics(model, q)
            nested = pa.list_(pa.list_(pa.float64()))
            columns = [*(b.column(k) for k in keep), pa.array(pos.tolist(), nested), pa.array(quat.tolist(), nested), pa.array(q[:, at].tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "body_pos_w", "body_quat_w", "joint_pos"])

    arrays = T.ArrayType(T.ArrayType(T.DoubleType()))
    schema = T.StructType([*(kept.schema[k] for k in keep), T.StructField("body_pos_w", arrays), T.StructField("body_quat_w", arrays), T.StructField("joint_pos", T.ArrayType(T.DoubleType()))])
    return kept.mapInArrow(run, schema)


def contacts(frames: DataFrame, model: Model, qpos: str = "qpos", keep: Sequence[str] = ("motion_id", "step"), margin: float = 0.0) -> DataFrame:
    """(keep, geom0, geom1, dist): plane-sphere, plane-capsule and sphere-sphere distances up to the margin.

    Geoms of one body, and of a body and its parent, don't touch each other; the world's do.
    """
    kept = frames.select(*keep, qpos)
    pairs = [
        (i, j)
        for i, a in enumerate(model.geoms)
        for j, b in enumerate(model.geoms)
        if (a.kind == "plane" and b.kind in ("sphere", "capsule")) or (i < j and a.kind == b.kind == "sphere" and a.body != b.body and model.parent[a.body] != b.body and model.parent[b.body] != a.body)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pos, quat = kinematics(model, np.array(batch.column(qpos).to_pylist(), np.float64))
            centre = {i: pos[:, g.body] + _turn(quat[:, g.body], np.broadcast_to(g.pos, pos[:, 0].shape)) for i, g in enumerate(model.geoms)}
            turn = {i: _mul(quat[:, g.body], np.broadcast_to(_unit(g.quat), quat[:, 0].shape)) for i, g in enumerate(model.geoms)}
            row, a, b, dist = [], [], [], []
            for i, j in pairs:
                g, h = model.geoms[i], model.geoms[j]
                if g.kind == "plane":
                    up = _turn(turn[i], np.broadcast_to([0.0, 0.0, 1.0], pos[:, 0].shape))
                    d = ((centre[j] - centre[i]) * up).sum(-1) - h.size[0]
                    if h.kind == "capsule":
                        d = d - np.abs((_turn(turn[j], np.broadcast_to([0.0, 0.0, 1.0], pos[:, 0].shape)) * up).sum(-1)) * h.size[1]
                else:
                    d = np.linalg.norm(centre[j] - centre[i], axis=-1) - g.size[0] - h.size[0]
                hit = np.flatnonzero(d <= margin)
                row.append(hit)
                a.append(np.full(len(hit), i))
                b.append(np.full(len(hit), j))
                dist.append(d[hit])
            if row:
                r = pa.array(np.concatenate(row))
                found = [pa.array(np.concatenate(x), t) for x, t in ((a, pa.int32()), (b, pa.int32()), (dist, pa.float64()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(r) for k in keep), *found], names=[*keep, "geom0", "geom1", "dist"])

    schema = T.StructType([*(kept.schema[k] for k in keep), T.StructField("geom0", T.IntegerType()), T.StructField("geom1", T.IntegerType()), T.StructField("dist", T.DoubleType())])
    return kept.mapInArrow(run, schema)


def constant_kinematics(frames: DataFrame, model: Model) -> DataFrame:
    """The same columns as forward_kinematics, all zero (unit orientations): for plans without the model's cost."""
    zero, unit = F.array(*[F.lit(0.0)] * 3), F.array(F.lit(1.0), *[F.lit(0.0)] * 3)
    n = len(model.bodies)
    return frames.withColumns({"body_pos_w": F.array_repeat(zero, n), "body_quat_w": F.array_repeat(unit, n), "joint_pos": F.array_repeat(F.lit(0.0), len(model.hinges()))})


def gmr_to_qpos(frames: DataFrame, position: Sequence[Column], xyzw: Sequence[Column], joints: Sequence[Column]) -> DataFrame:
    """frames with qpos: position, unit (w, x, y, z) and joints; a quaternion of length up to 1e-8 is an error."""
    q = reorder_xyzw(tuple(xyzw))
    size = F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))
    unit = normalize(q)
    checked = F.when(size <= 1e-8, F.raise_error(F.lit("a quaternion has no length")).cast("double")).otherwise(unit[0])
    return frames.withColumn("qpos", F.array(*position, checked, *unit[1:], *joints))


def velocity_limits(joints: DataFrame, name: str, limits: dict[str, float], default: float = 30.0) -> DataFrame:
    """joints with velocity_limit; names without one have the default."""
    table = joints.sparkSession.createDataFrame(list(limits.items()) or [("", default)], f"{name} string, velocity_limit double")
    return joints.join(F.broadcast(table), name, "left").withColumn("velocity_limit", F.coalesce("velocity_limit", F.lit(default)))


def jerk(frames: DataFrame, velocities: Sequence[str], fps: float, key: str = "motion_id", step: str = "step") -> DataFrame:
    """(key, jerk): mean of 0.01 times the length of the velocities' change per second; the first frame counts as 0."""
    from cliploom.operators.kinematics import along

    w = along(key, step)
    change = [((F.col(c) - F.coalesce(F.lag(c).over(w), F.col(c))) * fps) ** 2 for c in velocities]
    rows = frames.select(key, (F.sqrt(sum(change[1:], change[0])) * 0.01).alias("_j"))
    return rows.groupBy(key).agg(F.avg("_j").alias("jerk"))


def indices(names: Sequence[str], wanted: Sequence[str]) -> list[int]:
    """Places of the wanted names, in their order; unknown ones are an error that lists them."""
    unknown = [w for w in wanted if w not in names]
    if unknown:
        raise ValueError(f"unknown names: {', '.join(unknown)}")
    return [list(names).index(w) for w in wanted]


def prune(frames: DataFrame, column: str, names: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """frames with only the wanted channels of an array column, in the wanted order."""
    return frames.withColumn(column, F.array(*[F.col(column)[i] for i in indices(names, wanted)]))


def degrees(qpos: Sequence[float]) -> list[float]:
    return [math.degrees(x) for x in qpos]
