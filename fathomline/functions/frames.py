"""Rotations, lever arms, yaw arithmetic: pure column expressions. Angles are degrees unless a name says otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str | float) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(float(x))


def _trig(angle: Column) -> tuple[Column, Column]:
    return F.cos(F.radians(angle)), F.sin(F.radians(angle))


def body_to_inertial(roll, pitch, yaw, x, y, z) -> tuple[Column, Column, Column]:
    """Rotate a body vector by yaw, pitch, roll (Z-Y-X) into north, east, down."""
    roll, pitch, yaw, x, y, z = map(_col, (roll, pitch, yaw, x, y, z))
    (cr, sr), (cp, sp), (cy, sy) = _trig(roll), _trig(pitch), _trig(yaw)
    north = cy * cp * x + (cy * sp * sr - sy * cr) * y + (sy * sr + cy * cr * sp) * z
    east = sy * cp * x + (cy * cr + sr * sp * sy) * y + (sp * sy * cr - cy * sr) * z
    down = cp * sr * y + cp * cr * z - sp * x
    return north, east, down


def inertial_to_body(roll, pitch, yaw, n, e, d, parity: bool = False) -> tuple[Column, Column, Column]:
    """The transpose of ``body_to_inertial``. parity: the third row's coefficient of east as the reference has it (not a rotation)."""
    roll, pitch, yaw, n, e, d = map(_col, (roll, pitch, yaw, n, e, d))
    (cr, sr), (cp, sp), (cy, sy) = _trig(roll), _trig(pitch), _trig(yaw)
    x = cy * cp * n + sy * cp * e - sp * d
    y = (cy * sp * sr - sy * cr) * n + (cy * cr + sr * sp * sy) * e + cp * sr * d
    down_of_east = -cy * sr + sy * sp * (sr if parity else cr)
    z = (sy * sr + cy * cr * sp) * n + down_of_east * e + cp * cr * d
    return x, y, z


def wrap_360(angle: Column) -> Column:
    """One turn up or down if outside [0, 360]."""
    return F.when(angle < 0, angle + 360).when(angle > 360, angle - 360).otherwise(angle)


def wrap_180(angle: Column) -> Column:
    """One turn up or down if outside [-180, 180]."""
    return F.when(angle > 180, angle - 360).when(angle < -180, angle + 360).otherwise(angle)


def clamp_pi(angle: Column) -> Column:
    """Radians into [-pi, pi], any number of turns; both ends stay."""
    turn = F.lit(2 * math.pi)
    inside = angle.between(-math.pi, math.pi)
    return F.when(inside, angle).otherwise(F.pmod(angle + math.pi, turn) - math.pi)


def yaw_between(x: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Yaw at x between two samples, the short way round."""
    from fathomline.operators.interp import linear

    far = F.abs(y1 - y0) > 180
    low = F.when(far & (y0 > y1), y0 - 360).otherwise(y0)
    high = F.when(far & (y1 >= y0), y1 - 360).otherwise(y1)
    return wrap_360(linear(x, x0, x1, low, high))


def lever_arm(speeds: tuple[Column, Column, Column], rates: tuple[Column, Column, Column], arm: tuple[float, float, float]) -> tuple[Column, Column, Column]:
    """Speeds plus (angular rates in rad/s) x (position of the sensor)."""
    (vx, vy, vz), (wx, wy, wz), (x, y, z) = speeds, rates, map(F.lit, arm)
    return vx + wy * z - wz * y, vy - wx * z + wz * x, vz + wx * y - wy * x


def offset_position(roll, pitch, yaw, north, east, depth, origin: tuple[float, float, float], sensor: tuple[float, float, float]) -> tuple[Column, Column, Column]:
    """A position at ``origin`` (surge, sway, heave of the vehicle) moved to ``sensor``."""
    dn, de, dd = body_to_inertial(roll, pitch, yaw, *[s - o for s, o in zip(sensor, origin, strict=True)])
    return _col(north) + dn, _col(east) + de, _col(depth) + dd


def mount_yaw(vector: tuple[Column, Column, Column], heading_offset: float) -> tuple[Column, Column, Column]:
    """Undo a mounting yaw: rotate a vector about z by the offset."""
    return body_to_inertial(F.lit(0.0), F.lit(0.0), F.lit(heading_offset), *vector)


def declined(north: Column, east: Column, declination_rad: Column) -> tuple[Column, Column]:
    """Rotate a position by a magnetic declination."""
    c, s = F.cos(declination_rad), F.sin(declination_rad)
    return north * c - east * s, north * s + east * c


def euler_from_quaternion(x: Column, y: Column, z: Column, w: Column) -> tuple[Column, Column, Column]:
    """Roll, pitch, yaw in radians of a unit quaternion."""
    roll = F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y))
    pitch = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (w * y - z * x))))
    yaw = F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))
    return roll, pitch, yaw


def euler_from_matrix(r: Column) -> tuple[Column, Column, Column]:
    """Roll, pitch, yaw in radians of a row-major 3 x 3 rotation (array of 9); yaw or roll 0 where pitch is a right angle."""
    at = lambda i, j: F.get(r, F.lit(3 * i + j))
    up, down = F.abs(at(2, 0) + 1) < 1e-8, F.abs(at(2, 0) - 1) < 1e-8
    pitch = F.when(up, math.pi / 2).when(down, -math.pi / 2).otherwise(-F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), at(2, 0)))))
    c = F.cos(pitch)
    roll = F.when(up, F.atan2(at(0, 1), at(0, 2))).when(down, F.atan2(-at(0, 1), -at(0, 2))).otherwise(F.atan2(at(2, 1) / c, at(2, 2) / c))
    yaw = F.when(up | down, 0.0).otherwise(F.atan2(at(1, 0) / c, at(0, 0) / c))
    return roll, pitch, yaw


def gaussian_pdf(mu: Column, sigma: Column, x: Column) -> Column:
    return F.exp(-((mu - x) ** 2) / sigma**2 / 2.0) / F.sqrt(2.0 * math.pi * sigma**2)


def std_of(covariance: Column, index: int, size: int = 12) -> Column:
    """Square root of a diagonal entry of a row-major covariance, 0 if it is negative."""
    return F.sqrt(F.greatest(F.lit(0.0), F.get(covariance, F.lit(index * size + index))))
