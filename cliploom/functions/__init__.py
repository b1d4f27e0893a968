"""Scalar functions as Column builders; everything stays inside generated code."""

from cliploom.functions.rotations import (
    angle_between,
    angular_velocity,
    axis_angle,
    conjugate,
    euler,
    multiply,
    normalize,
    quat,
    reorder_xyzw,
    rot6d,
    rotate,
    slerp,
    yaw,
    yaw_quat,
)
from cliploom.functions.scalars import (
    degrees_to_radians,
    hub_reference,
    integer_resampled_length,
    lerp,
    norm,
    path_stem,
    resampled_length,
    source_fps,
    window_length,
)

__all__ = [
    "angle_between", "angular_velocity", "axis_angle", "conjugate", "degrees_to_radians", "euler", "hub_reference", "integer_resampled_length",
    "lerp", "multiply", "norm", "normalize", "path_stem", "quat", "reorder_xyzw", "resampled_length", "rot6d", "rotate", "slerp", "source_fps",
    "window_length", "yaw", "yaw_quat",
]
