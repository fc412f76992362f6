"""Planes, cones, cameras and laser sheets. Distances and angles are expressions, plane fits are sums
(``consensus``); cones are fitted to bounded samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators import consensus


def point_plane(a, b, c, d, x: str = "x", y: str = "y", z: str = "z") -> Column:
    """Distance of a point from the plane a x + b y + c z + d = 0."""
    l = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    a, b, c, d = map(l, (a, b, c, d))
    return F.abs(a * F.col(x) + b * F.col(y) + c * F.col(z) + d) / F.sqrt(a * a + b * b + c * c)


def plane_moments(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums from which a least-squares plane follows; combined before the shuffle."""
    m = {f"s_{p}{q}": F.sum(F.col(p) * F.col(q)) for i, p in enumerate("xyz") for q in "xyz"[i:]}
    return points.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s_{c}") for c in "xyz"], *[v.alias(k) for k, v in m.items()])


def plane_from_moments(r) -> tuple[float, float, float, float]:
    """Unit normal and offset of the plane of least squared distances."""
    mean = np.array([r[f"s_{c}"] for c in "xyz"]) / r["n"]
    cov = np.array([[r["s_" + "".join(sorted(p + q))] for q in "xyz"] for p in "xyz"]) / r["n"] - np.outer(mean, mean)
    normal = np.linalg.eigh(cov)[1][:, 0]
    normal = normal * (1 if normal[np.argmax(np.abs(normal))] > 0 else -1)
    return (*map(float, normal), float(-normal @ mean))


def robust_plane(xyz: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Plane by iterated weights of a soft-L1 loss, with a unit normal."""
    w = np.ones(len(xyz))
    plane = np.zeros(4)
    for _ in range(rounds):
        mean = (w[:, None] * xyz).sum(axis=0) / w.sum()
        normal = np.linalg.svd(np.sqrt(w)[:, None] * (xyz - mean), full_matrices=False)[2][-1]
        normal = normal * (1 if normal[np.argmax(np.abs(normal))] > 0 else -1)
        new = np.array([*normal, -normal @ mean])
        w = 1 / np.sqrt(1 + (xyz @ new[:3] + new[3]) ** 2)
        if np.abs(new - plane).max() < 1e-9:
            break
        plane = new
    return new


def fit_planes(points: DataFrame, by: Sequence[str], inlier: float = 0.05) -> DataFrame:
    """by..., a, b, c, d of robust planes and the number of points within ``inlier``; groups of any size."""
    return consensus.planes_with_inliers(points, by, inlier)


def ransac_planes(points: DataFrame, by: Sequence[str], inlier: float = 0.05, rounds: int = 200, seed: int = 0) -> DataFrame:
    """Planes through random triples; the one with most points within ``inlier``, fitted again to these; groups of any size."""
    return consensus.consensus_planes(points, by, inlier, rounds, seed)


def cone_distance(xyz: np.ndarray, apex: np.ndarray, axis: np.ndarray, theta: float) -> np.ndarray:
    """Distance of points from the surface of a cone with half-angle theta."""
    v = xyz - apex
    along = v @ (axis / np.linalg.norm(axis))
    off = np.sqrt(np.maximum((v * v).sum(axis=1) - along**2, 0))
    return np.abs(off * math.cos(theta) - along * math.sin(theta))


def fit_cones(points: DataFrame, by: Sequence[str], rounds: int = 60) -> DataFrame:
    """Apex, axis and half-angle by damped least squares from the best-fitting plane (a flat cone)."""
    head = ", ".join(f"{k} {points.schema[k].dataType.simpleString()}" for k in by)
    names = ["apex_x", "apex_y", "apex_z", "axis_x", "axis_y", "axis_z", "theta"]

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        xyz = pdf[["x", "y", "z"]].to_numpy(float)
        plane = robust_plane(xyz)
        p = np.array([*(xyz.mean(axis=0) - plane[:3] * (xyz.mean(axis=0) @ plane[:3] + plane[3])), *plane[:3], math.pi / 2 - 0.02])
        cost = lambda q: cone_distance(xyz, q[:3], q[3:6], q[6])
        lam, r = 1e-2, cost(p)
        for _ in range(rounds):
            j = np.stack([(cost(p + h) - r) / 1e-6 for h in np.eye(7) * 1e-6], axis=1)
            step = np.linalg.solve(j.T @ j + lam * np.eye(7), -j.T @ r)
            new = p + step
            new[3:6] /= np.linalg.norm(new[3:6])
            rn = cost(new)
            if rn @ rn < r @ r:
                p, r, lam = new, rn, lam / 3
            else:
                lam *= 4
        return pd.DataFrame([[*key, *p]], columns=[*by, *names])

    return points.groupBy(*by).applyInPandas(fit, head + ", " + ", ".join(f"{n} double" for n in names))


def plane_angles(a: Column, b: Column, c: Column) -> tuple[Column, Column, Column]:
    """Pitch, yaw and total angle in degrees of a plane's normal from the forward axis."""
    size = F.sqrt(a * a + b * b + c * c)
    return F.degrees(F.atan2(c, a)), F.degrees(F.atan2(b, a)), F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), a / size))))


def plane_of_angles(pitch_deg: float, yaw_deg: float, point: Sequence[float]) -> tuple[float, float, float, float]:
    """The plane through a point whose normal has a pitch and a yaw."""
    n = np.array([1.0, math.tan(math.radians(yaw_deg)), math.tan(math.radians(pitch_deg))])
    return (*map(float, n), float(-n @ np.asarray(point, float)))


def plane_of_points(p: Sequence[float], q: Sequence[float], r: Sequence[float]) -> tuple[float, float, float, float]:
    p, q, r = (np.asarray(v, float) for v in (p, q, r))
    n = np.cross(q - p, r - p)
    return (*map(float, n), float(-n @ p))


def ned_from_camera(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Camera axes (right, down, forward) to vehicle axes."""
    return -y, x, z


def triangulated(points: DataFrame, p1: np.ndarray, p2: np.ndarray, cols: Sequence[str] = ("u1", "v1", "u2", "v2")) -> DataFrame:
    """x, y, z of points seen in two cameras with projection matrices p1 and p2: the direct linear transform, row by row in batches."""

    @F.pandas_udf("x double, y double, z double")
    def solve(u1: pd.Series, v1: pd.Series, u2: pd.Series, v2: pd.Series) -> pd.DataFrame:
        a = np.stack([u1.to_numpy()[:, None] * p1[2] - p1[0], v1.to_numpy()[:, None] * p1[2] - p1[1], u2.to_numpy()[:, None] * p2[2] - p2[0], v2.to_numpy()[:, None] * p2[2] - p2[1]], axis=1)
        h = np.linalg.svd(a)[2][:, -1]
        return pd.DataFrame(h[:, :3] / h[:, 3:], columns=["x", "y", "z"])

    p1, p2 = np.asarray(p1, float), np.asarray(p2, float)
    return points.withColumn("_p", solve(*[F.col(c).cast("double") for c in cols])).select("*", "_p.x", "_p.y", "_p.z").drop("_p")


def ray_cone(apex: np.ndarray, axis: np.ndarray, theta: float, ray: np.ndarray) -> np.ndarray | None:
    """Nearest point in front at which a ray from the origin meets a cone; its mirror image behind the apex doesn't count."""
    n, c2 = axis / np.linalg.norm(axis), math.cos(theta) ** 2
    dn, an = ray @ n, apex @ n
    a = dn * dn - c2 * (ray @ ray)
    b = -2 * (dn * an - c2 * (ray @ apex))
    c = an * an - c2 * (apex @ apex)
    if abs(a) < 1e-15:
        roots = [-c / b] if b else []
    else:
        disc = b * b - 4 * a * c
        roots = [] if disc < 0 else [(-b - math.sqrt(disc)) / (2 * a), (-b + math.sqrt(disc)) / (2 * a)]
    ahead = [t for t in roots if t > 0 and (ray * t - apex) @ n >= 0]
    return ray * min(ahead) if ahead else None


def on_cone(ray: tuple[Column, Column, Column], apex: Sequence[float], axis: Sequence[float], theta: float) -> Column:
    """How far along a ray from the origin its nearest point in front on a cone is, in lengths of the ray; null where there is none.

    ``ray_cone`` as an expression: both roots of the quadratic, and of those ahead on the cone itself the lesser. All that is used
    more than once stands outside of branches, so that Spark computes it once and the method it makes is short enough to be compiled."""
    size = math.sqrt(sum(v * v for v in axis))
    n, c2 = [v / size for v in axis], math.cos(theta) ** 2
    dot = lambda v: sum((F.lit(float(x)) * r for x, r in zip(v, ray, strict=True)), F.lit(0.0))
    an, dn, da = sum(x * y for x, y in zip(apex, n, strict=True)), dot(n), dot(apex)
    a = dn * dn - c2 * (ray[0] * ray[0] + ray[1] * ray[1] + ray[2] * ray[2])
    b = -2 * (dn * an - c2 * da)
    c = F.lit(an * an - c2 * sum(x * x for x in apex))
    flat, disc = F.abs(a) < 1e-15, b * b - 4 * a * c
    root = F.sqrt(F.when(disc >= 0, disc))
    ahead = lambda t: F.when((t > 0) & (t * dn - an >= 0), t)
    twice = F.when(~flat, 2 * a)
    return F.least(ahead(F.when(flat, F.try_divide(-c, b))), ahead((-b - root) / twice), ahead((-b + root) / twice))


def sheet_points(images: DataFrame, camera: Sequence[float], apex: Sequence[float], axis: Sequence[float], theta: float, u: str = "u", v: str = "v") -> DataFrame:
    """x, y, z in the camera's axes of pixels on a laser sheet that is a cone; ``camera``: fx, fy, cx, cy. Pixels whose ray misses it have none."""
    fx, fy, cx, cy = camera
    ray = ((F.col(u) - cx) / fx, (F.col(v) - cy) / fy, F.lit(1.0))
    t = on_cone(ray, apex, axis, theta)
    return images.withColumn("_t", t).select(*images.columns, *[(F.col("_t") * r).alias(k) for r, k in zip(ray, "xyz", strict=True)])


def distorted(x: Column, y: Column, d: Sequence[float]) -> tuple[Column, Column]:
    """Normalised image coordinates with k1, k2, p1, p2, k3 applied."""
    k1, k2, p1, p2, k3 = (*d, 0, 0, 0, 0, 0)[:5]
    r2 = x * x + y * y
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    return x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x), y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y


def projected(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column]:
    return fx * x / z + cx, fy * y / z + cy


def uncertainty_planes(points: DataFrame, key: str, least: float, planes: int = 300, min_sine: float = 0.866, seed: int = 0, batch: int = 6_000_000, most: int = 10**10) -> DataFrame:
    """a, b, c, d of ``planes`` planes through random triples of all points, at least ``least`` apart and no flatter than
    ``min_sine`` across the direction of view (in y and z); an error where there are no such triples."""
    return consensus.planes_of_far_triples(points, key, least, planes, min_sine, seed, batch, most)


def triangulated_between(points: DataFrame, matrix: Sequence[Sequence[float]], cols: Sequence[str] = ("u1", "v1", "u2", "v2")) -> DataFrame:
    """x, y, z of points seen in two cameras as the middle of the shortest line between their rays.

    ``cols`` are normalised coordinates; ``matrix`` (3 x 4) takes the first camera's axes to the second's."""
    m = np.asarray(matrix, float)
    r, t = m[:, :3], m[:, 3]
    origin = -r.T @ t  # the second camera in the first one's axes
    d1 = (F.col(cols[0]), F.col(cols[1]), F.lit(1.0))
    second = (F.col(cols[2]), F.col(cols[3]), F.lit(1.0))
    d2 = tuple(sum((F.lit(float(r[j, i])) * second[j] for j in range(3)), F.lit(0.0)) for i in range(3))
    dot = lambda p, q: sum((a * b for a, b in zip(p, q, strict=True)), F.lit(0.0))
    o = tuple(F.lit(float(x)) for x in origin)
    a, b, c, d, e = dot(d1, d1), dot(d1, d2), dot(d2, d2), dot(d1, o), dot(d2, o)
    span = a * c - b * b
    s1, s2 = F.try_divide(d * c - e * b, span), F.try_divide(d * b - e * a, span)
    return points.select("*", *[((s1 * d1[i] + o[i] + s2 * d2[i]) / 2).alias(k) for i, k in enumerate("xyz")])
