"""Rigid and affine transforms as column expressions.

A matrix is a tuple of rows of columns (3 x 3, or 4 x 4 for homogeneous ones), a vector a tuple of columns, a quaternion
(w, x, y, z) of length 1. Angles are radians. Nothing leaves the JVM, and a transform differs from row to row. Results are
expressions that repeat their inputs: where one transform goes into the next, put it into columns first.

Euler axes are named as usual: ``s`` or ``r`` for a static or a rotating frame, then the three axes in turn.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, ...]
Matrix = tuple[tuple[Column, ...], ...]


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def vector(*xs) -> Vector:
    return tuple(map(_c, xs))


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        total = total + x * y
    return total


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Sequence[Column]) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Sequence[Column]) -> Vector:
    """Null components for a vector without length."""
    n = norm(a)
    return tuple(F.try_divide(x, n) for x in a)


# -- matrices


def identity(size: int = 3) -> Matrix:
    return tuple(tuple(F.lit(1.0 if i == j else 0.0) for j in range(size)) for i in range(size))


def product(*ms: Matrix) -> Matrix:
    out = ms[0]
    for m in ms[1:]:
        out = tuple(tuple(dot(row, [r[j] for r in m]) for j in range(len(m[0]))) for row in out)
    return out


def transposed(m: Matrix) -> Matrix:
    return tuple(zip(*m, strict=True))


def homogeneous(rotation: Matrix, translation: Sequence | None = None) -> Matrix:
    t = vector(*(translation or (0, 0, 0)))
    return (*((*row, x) for row, x in zip(rotation, t, strict=True)), vector(0, 0, 0, 1))


def translation(direction: Sequence) -> Matrix:
    return homogeneous(identity(), direction)


def about_point(m: Matrix, point: Sequence) -> Matrix:
    """A 3 x 3 matrix as a homogeneous one that leaves a point in its place."""
    p = vector(*point)
    return homogeneous(m, [x - dot(row, p) for x, row in zip(p, m, strict=True)])


def reflection(point: Sequence, normal: Sequence) -> Matrix:
    """Mirror at the plane through a point."""
    n = unit(vector(*normal))
    return about_point(tuple(tuple(_c(i == j) - 2 * n[i] * n[j] for j in range(3)) for i in range(3)), point)


def scaling(factor, origin: Sequence = (0, 0, 0), direction: Sequence | None = None) -> Matrix:
    """By a factor, in all directions or in one."""
    f = _c(factor)
    if direction is None:
        return about_point(tuple(tuple(f if i == j else F.lit(0.0) for j in range(3)) for i in range(3)), origin)
    d = unit(vector(*direction))
    return about_point(tuple(tuple(_c(i == j) + (f - 1) * d[i] * d[j] for j in range(3)) for i in range(3)), origin)


def projection(point: Sequence, normal: Sequence, direction: Sequence | None = None) -> Matrix:
    """On the plane through a point, at right angles or along a direction."""
    n = unit(vector(*normal))
    d = n if direction is None else vector(*direction)
    along = dot(d, n)
    return about_point(tuple(tuple(_c(i == j) - d[i] * n[j] / along for j in range(3)) for i in range(3)), point)


def shear(angle, direction: Sequence, point: Sequence, normal: Sequence) -> Matrix:
    """Along a direction in the plane through a point, by an angle."""
    d, n, t = unit(vector(*direction)), unit(vector(*normal)), F.tan(_c(angle))
    return about_point(tuple(tuple(_c(i == j) + t * d[i] * n[j] for j in range(3)) for i in range(3)), point)


def rotation(angle, direction: Sequence, point: Sequence = (0, 0, 0)) -> Matrix:
    """About an axis through a point."""
    return about_point(from_quaternion(quaternion_about(angle, direction)), point)


def inverse_rigid(m: Matrix) -> Matrix:
    """Of a homogeneous rotation and translation."""
    r = transposed(tuple(row[:3] for row in m[:3]))
    t = [row[3] for row in m[:3]]
    return homogeneous(r, [-dot(row, t) for row in r])


def applied(m: Matrix, point: Sequence) -> Vector:
    p = vector(*point)
    return tuple(dot(row[:3], p) + (row[3] if len(row) == 4 else 0.0) for row in m[:3])


def angle_of(m: Matrix) -> Column:
    """The angle of a rotation, from 0 to pi."""
    half = (m[0][0] + m[1][1] + m[2][2] - 1) / 2
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), half)))


# -- Euler angles


def _elementary(axis: int, angle) -> Matrix:
    c, s = F.cos(_c(angle)), F.sin(_c(angle))
    i, j = (axis + 1) % 3, (axis + 2) % 3
    at = {(axis, axis): F.lit(1.0), (i, i): c, (j, j): c, (i, j): -s, (j, i): s}
    return tuple(tuple(at.get((r, k), F.lit(0.0)) for k in range(3)) for r in range(3))


def _axes(axes: str) -> tuple[bool, list[int]]:
    order = ["xyz".index(a) for a in axes[1:]]
    if axes[0] not in "sr" or len(order) != 3 or order[0] == order[1] or order[1] == order[2]:
        raise ValueError(f"no such axes: {axes}")
    return axes[0] == "s", order


def from_euler(ai, aj, ak, axes: str = "sxyz") -> Matrix:
    static, order = _axes(axes)
    turns = [_elementary(a, v) for a, v in zip(order, (ai, aj, ak), strict=True)]
    return product(*(reversed(turns) if static else turns))


def to_euler(m: Matrix, axes: str = "sxyz") -> Vector:
    """Angles about the axes in turn; where the middle one leaves two of them undetermined, the one that is taken last is 0."""
    static, order = _axes(axes)
    i, j, k = order if static else order[::-1]
    third = 3 - i - j
    even = (j - i) % 3 == 1
    sign = 1.0 if even else -1.0
    clipped = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))
    if i == k:
        b = F.acos(clipped(m[i][i]))
        flat = F.abs(F.sin(b)) < 1e-12
        a = F.when(flat, F.atan2(-sign * m[j][third], m[j][j])).otherwise(F.atan2(m[i][j], sign * m[i][third]))
        c = F.when(flat, 0.0).otherwise(F.atan2(m[j][i], -sign * m[third][i]))
    else:
        b = F.asin(clipped(-sign * m[k][i]))
        flat = F.abs(F.cos(b)) < 1e-12
        a = F.when(flat, F.atan2(-sign * m[j][k], m[j][j])).otherwise(F.atan2(sign * m[k][j], m[k][k]))
        c = F.when(flat, 0.0).otherwise(F.atan2(sign * m[j][i], m[i][i]))
    return (a, b, c) if static else (c, b, a)


# -- quaternions


def quaternion_about(angle, direction: Sequence) -> Vector:
    half = _c(angle) / 2
    return (F.cos(half), *(F.sin(half) * x for x in unit(vector(*direction))))


def multiplied(p: Vector, q: Vector) -> Vector:
    """The turn q, then the turn p."""
    (a, *u), (b, *v) = p, q
    w = cross(tuple(u), tuple(v))
    return (a * b - dot(u, v), *(a * y + b * x + z for x, y, z in zip(u, v, w, strict=True)))


def conjugate(q: Vector) -> Vector:
    return (q[0], *(-x for x in q[1:]))


def inverse(q: Vector) -> Vector:
    n = dot(q, q)
    return tuple(F.try_divide(x, n) for x in conjugate(q))


def from_quaternion(q: Vector) -> Matrix:
    w, x, y, z = q
    return (
        (1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        (2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        (2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
    )


def to_quaternion(m: Matrix) -> Vector:
    """Of a rotation, with w at least 0: sizes from the diagonal, signs from the entries opposite each other."""
    size = lambda a, b, c: F.sqrt(F.greatest(F.lit(0.0), 1 + a + b + c)) / 2
    d = [m[i][i] for i in range(3)]
    w = size(d[0], d[1], d[2])
    x, y, z = size(d[0], -d[1], -d[2]), size(-d[0], d[1], -d[2]), size(-d[0], -d[1], d[2])
    signed = lambda v, s: F.when(s < 0, -v).otherwise(v)
    plain = (w, signed(x, m[2][1] - m[1][2]), signed(y, m[0][2] - m[2][0]), signed(z, m[1][0] - m[0][1]))
    # half a turn: w is 0 and the signs come from the sums
    half = (F.lit(0.0), x, F.when(x > 1e-9, signed(y, m[0][1] + m[1][0])).otherwise(y), F.when(x > 1e-9, signed(z, m[0][2] + m[2][0])).otherwise(signed(z, m[1][2] + m[2][1])))
    return tuple(F.when(w < 1e-9, h).otherwise(p) for h, p in zip(half, plain, strict=True))


def quaternion_from_euler(ai, aj, ak, axes: str = "sxyz") -> Vector:
    static, order = _axes(axes)
    turns = [quaternion_about(v, [float(a == k) for k in range(3)]) for a, v in zip(order, (ai, aj, ak), strict=True)]
    first, second, third = reversed(turns) if static else turns
    return multiplied(multiplied(first, second), third)


def slerp(p: Vector, q: Vector, fraction) -> Vector:
    """Between two turns at a steady rate, the short way round."""
    f = _c(fraction)
    near = dot(p, q)
    q = tuple(F.when(near < 0, -x).otherwise(x) for x in q)
    angle = F.acos(F.least(F.lit(1.0), F.abs(near)))
    straight = angle < 1e-9
    a = F.when(straight, 1 - f).otherwise(F.sin((1 - f) * angle) / F.sin(angle))
    b = F.when(straight, f).otherwise(F.sin(f * angle) / F.sin(angle))
    return tuple(a * x + b * y for x, y in zip(p, q, strict=True))
