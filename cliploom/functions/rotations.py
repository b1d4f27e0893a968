"""Quaternions (w, x, y, z) as tuples of four Columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Quat = tuple[Column, Column, Column, Column]
Vec = Sequence[Column]


def quat(array: Column) -> Quat:
    """The four elements of an array column."""
    return tuple(array[i] for i in range(4))


def reorder_xyzw(q: Quat) -> Quat:
    """(x, y, z, w) as (w, x, y, z)."""
    return (q[3], q[0], q[1], q[2])


def multiply(a: Quat, b: Quat) -> Quat:
    """Hamilton product."""
    return (
        a[0] * b[0] - a[1] * b[1] - a[2] * b[2] - a[3] * b[3],
        a[0] * b[1] + a[1] * b[0] + a[2] * b[3] - a[3] * b[2],
        a[0] * b[2] - a[1] * b[3] + a[2] * b[0] + a[3] * b[1],
        a[0] * b[3] + a[1] * b[2] - a[2] * b[1] + a[3] * b[0],
    )


def conjugate(q: Quat) -> Quat:
    return (q[0], -q[1], -q[2], -q[3])


def _length(parts: Sequence[Column]) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def normalize(q: Quat, floor: float = 1e-8) -> Quat:
    """Unit quaternion; lengths under `floor` count as `floor`."""
    n = F.greatest(_length(q), F.lit(floor))
    return tuple(p / n for p in q)


def axis_angle(axis: str, angle: Column) -> Quat:
    """Rotation by `angle` about x, y or z."""
    half, zero = angle / 2, F.lit(0.0)
    return (F.cos(half), *(F.sin(half) if a == axis else zero for a in "xyz"))


def euler(angles: Vec, order: str = "xyz", frame: str = "extrinsic") -> Quat:
    """Rotations about the axes of `order`: intrinsic ones multiply on the right, extrinsic ones on the left."""
    if sorted(order) != ["x", "y", "z"] or frame not in ("intrinsic", "extrinsic"):
        raise ValueError(f"order must permute xyz and frame be intrinsic or extrinsic: {order}, {frame}")
    q: Quat = (F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))
    for axis, angle in zip(order, angles, strict=True):
        step = axis_angle(axis, angle)
        q = multiply(q, step) if frame == "intrinsic" else multiply(step, q)
    return normalize(q)


def rotate(q: Quat, v: Vec, inverse: bool = False) -> tuple[Column, Column, Column]:
    """v turned by the unit quaternion of q, or back."""
    q = normalize(q)
    q = conjugate(q) if inverse else q
    turned = multiply(multiply(q, (F.lit(0.0), *v)), conjugate(q))
    return turned[1:]


def yaw(q: Quat) -> Column:
    """Heading of the unit quaternion of q."""
    w, x, y, z = normalize(q)
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def yaw_quat(angle: Column) -> Quat:
    return axis_angle("z", angle)


def rot6d(q: Quat) -> tuple[Column, ...]:
    """The first two columns of the rotation matrix."""
    w, x, y, z = normalize(q)
    return (
        1 - 2 * (y * y + z * z), 2 * (x * y + w * z), 2 * (x * z - w * y),
        2 * (x * y - w * z), 1 - 2 * (x * x + z * z), 2 * (y * z + w * x),
    )


def angular_velocity(q: Quat, after: Quat, fps: float) -> tuple[Column, Column, Column]:
    """Body-frame angular velocity that turns q into `after` in one frame, the short way round."""
    d = multiply(conjugate(q), after)
    sine = _length(d[1:])
    speed = 2 * F.atan2(sine, d[0])
    speed = F.when(speed > math.pi, speed - 2 * math.pi).otherwise(speed) * fps
    still = sine < 1e-15
    return tuple(F.when(still, F.lit(float(i == 0))).otherwise(d[i + 1] / sine) * speed for i in range(3))


def angle_between(a: Quat, b: Quat) -> Column:
    """Geodesic angle of two unit quaternions; q and -q are the same rotation."""
    dot = F.abs(sum((p * q for p, q in zip(a[1:], b[1:], strict=True)), a[0] * b[0]))
    return 2 * F.acos(F.least(dot, F.lit(1.0)))


def slerp(a: Quat, b: Quat, t: Column) -> Quat:
    """Spherical interpolation along the shorter arc; nearly parallel quaternions are interpolated linearly."""
    a, b = normalize(a), normalize(b)
    dot = sum((p * q for p, q in zip(a[1:], b[1:], strict=True)), a[0] * b[0])
    sign = F.when(dot < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    cosine = F.least(F.abs(dot), F.lit(1.0))
    angle = F.acos(cosine)
    sine = F.greatest(F.sin(angle), F.lit(1e-8))
    near = cosine > 0.9995
    wa = F.when(near, 1 - t).otherwise(F.sin((1 - t) * angle) / sine)
    wb = F.when(near, t).otherwise(F.sin(t * angle) / sine) * sign
    return normalize(tuple(p * wa + q * wb for p, q in zip(a, b, strict=True)))
