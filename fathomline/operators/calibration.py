"""Camera calibration from a table of board corners, mono and stereo.

Corners come as a table: view, x, y, z (on the board, metres), u, v (pixels); a view is one photograph of one board. The
unknowns are the cameras' parameters, which all views share, and a pose a view. Levenberg-Marquardt steps solve the block
normal equations: each view has its own 6 x 6 block, its coupling to the shared parameters and its gradient, all made in the
task that holds the view; views are eliminated there (Schur complement), and what is summed over tasks and reaches the driver
is the shared parameters' small matrix alone. Steps go back to the tasks, where each view works out its own part. Views whose
error is too great are rejected between rounds, and the round with the least error is the result.

A camera has nine parameters: fx, fy, cx, cy, k1, k2, p1, p2, k3. The second camera of a pair has another six: rotation vector
and translation from the first camera's axes to its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.shared import cut

CAMERA = ["fx", "fy", "cx", "cy", "k1", "k2", "p1", "p2", "k3"]
OWN, POSE = len(CAMERA), 6
#: Views that a task works on at a time.
PORTION = 128
#: Pixels: corners that are met so well have nothing left to tell.
EXACT = 1e-7
STATE = "view {view}, corners array<double>, pose array<double>, block array<double>"


@dataclass(frozen=True)
class Calibration:
    """``cameras``: nine parameters each; ``relative``: rotation vector and translation to the second camera; ``rms``: pixels over
    all corners; ``views``: view, rvec, tvec, rms of the views that are left; ``rounds``: views and rms of each round."""

    cameras: list[list[float]]
    relative: list[float] | None
    rms: float
    views: DataFrame
    rounds: list[tuple[int, float]]


def rotation(r: np.ndarray) -> np.ndarray:
    """Matrices of rotation vectors, one a row."""
    angle = np.linalg.norm(r, axis=1)
    k = np.zeros((len(r), 3, 3))
    k[:, 2, 1], k[:, 0, 2], k[:, 1, 0] = r.T
    k -= k.transpose(0, 2, 1)
    small = angle < 1e-8
    a = np.where(small, 1.0, angle)
    s, c = np.where(small, 1 - angle**2 / 6, np.sin(a) / a), np.where(small, 0.5 - angle**2 / 24, (1 - np.cos(a)) / a**2)
    return np.eye(3) + s[:, None, None] * k + c[:, None, None] * (k @ k)


def rotation_vector(m: np.ndarray) -> np.ndarray:
    """The rotation vector of the rotation nearest to a matrix."""
    u, _, vt = np.linalg.svd(m)
    m = u @ np.diag([1, 1, np.linalg.det(u @ vt)]) @ vt
    angle = np.arccos(np.clip((np.trace(m) - 1) / 2, -1, 1))
    axis = np.array([m[2, 1] - m[1, 2], m[0, 2] - m[2, 0], m[1, 0] - m[0, 1]])
    if angle < 1e-9:
        return axis / 2
    if np.pi - angle < 1e-6:  # half a turn: the axis is the column that the rotation keeps
        w, v = np.linalg.eigh((m + m.T) / 2)
        return v[:, np.argmax(w)] * angle
    return axis / (2 * np.sin(angle)) * angle


def projections(shared: np.ndarray, pose: np.ndarray, camera: np.ndarray, xyz: np.ndarray) -> np.ndarray:
    """Pixels of points with the pose of their view, one a row; ``camera`` is 0 or 1."""
    p = (rotation(pose[:, :3]) @ xyz[:, :, None])[:, :, 0] + pose[:, 3:]
    own = shared[:OWN][None, :].repeat(len(p), axis=0)
    if len(shared) > OWN:
        second = camera == 1
        own[second] = shared[OWN : 2 * OWN]
        p[second] = p[second] @ rotation(shared[None, 2 * OWN : 2 * OWN + 3])[0].T + shared[2 * OWN + 3 :]
    fx, fy, cx, cy, k1, k2, p1, p2, k3 = own.T
    x, y = p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]
    r2 = x * x + y * y
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    return np.stack([fx * (x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)) + cx, fy * (y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y) + cy], axis=1)


def turns(r: np.ndarray) -> np.ndarray:
    """How the matrices of rotation vectors change with each of their three numbers: row, number, 3 x 3; central differences."""
    step = 1e-6 * np.eye(3)
    return np.stack([(rotation(r + h) - rotation(r - h)) / 2e-6 for h in step], axis=1)


def slopes(shared: np.ndarray, pose: np.ndarray, view: np.ndarray, corners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each corner how its pixel changes with the shared parameters and with its view's pose, and by how much it is missed."""
    camera, xyz, uv = corners[:, 0], corners[:, 1:4], corners[:, 4:]
    n, own = len(uv), shared[:OWN]
    p = (rotation(pose[:, :3])[view] @ xyz[:, :, None])[:, :, 0] + pose[view, 3:]
    dp = np.zeros((n, 3, POSE))
    dp[:, :, :3] = (turns(pose[:, :3])[view] @ xyz[:, None, :, None])[:, :, :, 0].transpose(0, 2, 1)
    dp[:, :, 3:] = np.eye(3)
    dr = np.zeros((n, 3, len(shared) - 2 * OWN if len(shared) > OWN else 0))
    own, second = np.broadcast_to(own, (n, OWN)), camera == 1
    if len(shared) > OWN:
        own = np.where(second[:, None], shared[OWN : 2 * OWN], own)
        r, by = shared[None, 2 * OWN : 2 * OWN + 3], p[second]
        dr[second, :, :3] = np.einsum("kij,nj->nik", turns(r)[0], by)
        dr[second, :, 3:] = np.eye(3)
        dp[second] = rotation(r)[0] @ dp[second]
        p[second] = by @ rotation(r)[0].T + shared[2 * OWN + 3 :]
    fx, fy, cx, cy, k1, k2, p1, p2, k3 = own.T
    x, y, z = p[:, 0] / p[:, 2], p[:, 1] / p[:, 2], p[:, 2]
    r2 = x * x + y * y
    radial, bend = 1 + r2 * (k1 + r2 * (k2 + r2 * k3)), 2 * (k1 + r2 * (2 * k2 + 3 * r2 * k3))
    a, b = x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x), y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y
    js = np.zeros((n, 2, OWN))
    js[:, 0, 0], js[:, 1, 1], js[:, 0, 2], js[:, 1, 3] = a, b, 1, 1
    for k, (u, v) in {4: (x * r2, y * r2), 5: (x * r2**2, y * r2**2), 6: (2 * x * y, r2 + 2 * y * y), 7: (r2 + 2 * x * x, 2 * x * y), 8: (x * r2**3, y * r2**3)}.items():
        js[:, 0, k], js[:, 1, k] = fx * u, fy * v
    ax, ay = radial + x * x * bend + 2 * p1 * y + 6 * p2 * x, x * y * bend + 2 * p1 * x + 2 * p2 * y
    bx, by_ = ay, radial + y * y * bend + 6 * p1 * y + 2 * p2 * x
    to_pixel = np.stack([np.stack([fx * ax / z, fx * ay / z, -fx * (ax * x + ay * y) / z], axis=1), np.stack([fy * bx / z, fy * by_ / z, -fy * (bx * x + by_ * y) / z], axis=1)], axis=1)
    if len(shared) > OWN:
        js = np.concatenate([np.where(second[:, None, None], 0, js), np.where(second[:, None, None], js, 0), to_pixel @ dr], axis=2)
    return js, to_pixel @ dp, uv - np.stack([fx * a + cx, fy * b + cy], axis=1)


def blocks(shared: np.ndarray, free: np.ndarray, pose: np.ndarray, view: np.ndarray, corners: np.ndarray) -> np.ndarray:
    """Of each view its block (6 x 6), coupling (free x 6), gradient, shared block and gradient, squared error and corners, in a row.

    ``view`` numbers the rows of ``corners`` (camera, x, y, z, u, v), in order."""
    js, jp, miss = slopes(shared, pose, view, corners)
    n = len(free)
    rows = np.concatenate([js[:, :, free], jp, miss[:, :, None]], axis=2)
    edges = [*np.flatnonzero(np.diff(view, prepend=-1)).tolist(), len(view)]
    own = [rows[i:j].reshape(-1, n + POSE + 1) for i, j in zip(edges, edges[1:], strict=False)]
    g = np.stack([m.T @ m for m in own])
    parts = [g[:, n:-1, n:-1], g[:, :n, n:-1], g[:, n:-1, -1], g[:, :n, :n], g[:, :n, -1], g[:, -1, -1], np.diff(edges).astype(float)]
    return np.concatenate([p.reshape(len(g), -1) for p in parts], axis=1)


def unpacked(block: np.ndarray, n: int) -> list[np.ndarray]:
    """What ``blocks`` has in its rows, for n free shared parameters."""
    shapes = [(POSE, POSE), (n, POSE), (POSE,), (n, n), (n,), (), ()]
    edges = np.cumsum([int(np.prod(s)) for s in shapes])
    return [c.reshape(-1, *s) for c, s in zip(np.split(block, edges[:-1], axis=1), shapes, strict=True)]


def damped(u: np.ndarray, by: float) -> np.ndarray:
    return u + by * np.einsum("...ii->...i", u)[..., None] * np.eye(u.shape[-1]) + 1e-12 * np.eye(u.shape[-1])


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Portions of views: the rows, the number of the view of each corner, and the corners."""
    for whole in batches:
        for k in range(0, whole.num_rows, PORTION):
            b = whole.slice(k, PORTION)
            c = b.column(1)
            yield b, np.repeat(np.arange(b.num_rows), c.value_lengths().to_numpy() // 6), c.flatten().to_numpy().reshape(-1, 6)


def packed(b: pa.RecordBatch, pose: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(pa.list_(pa.float64())) for m in (pose, block)]
    return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], names=["view", "corners", "pose", "block"])


def dense(c: pa.Array) -> np.ndarray:
    return c.flatten().to_numpy().reshape(len(c), -1)


class Solver:
    """Views with poses and blocks, and the steps over them. Each step is one narrow pass and one small sum."""

    def __init__(self, shared: np.ndarray, free: Sequence[int], state: DataFrame) -> None:
        self.shared, self.free, self.state = shared, np.asarray(free, int), state
        self.schema = STATE.format(view=dict(state.dtypes)["view"])

    def evaluated(self, state: DataFrame, shared: np.ndarray, step: np.ndarray | None = None, damping: float = 0.0) -> DataFrame:
        """Views moved by their part of a step (of the free shared parameters) and with the blocks there."""
        free = self.free

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, view, corners in batches_of(batches):
                pose = dense(b.column(2))
                if step is not None:
                    u, w, g, *_ = unpacked(dense(b.column(3)), len(free))
                    pose = pose + np.linalg.solve(damped(u, damping), (g - np.einsum("vij,i->vj", w, step))[:, :, None])[:, :, 0]
                yield packed(b, pose, blocks(shared, free, pose, view, corners))

        return cut(state.mapInArrow(run, self.schema))

    def sums(self, state: DataFrame, damping: float) -> tuple[np.ndarray, np.ndarray, float, float]:
        """The shared parameters' matrix and right side without the views, squared error, corners."""
        n = len(self.free)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    u, w, g, v, h, cost, count = unpacked(dense(b.column(0)), n)
                    lead = np.linalg.solve(damped(u, damping), np.concatenate([w.transpose(0, 2, 1), g[:, :, None]], axis=2))
                    s, r = (v - w @ lead[:, :, :n]).sum(axis=0), (h - (w @ lead[:, :, n:])[:, :, 0]).sum(axis=0)
                    total = np.concatenate([s.ravel(), np.einsum("vii->vi", v).sum(axis=0), r, [cost.sum(), count.sum()]])
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "x"])

        rows = state.select("block").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()  # as many as the matrix has entries
        x = np.zeros(n * n + 2 * n + 2)
        for r in rows:
            x[r["i"]] = r["x"]
        s = x[: n * n].reshape(n, n) + damping * np.diag(x[n * n : n * n + n])
        return s, x[n * n + n : n * n + 2 * n], float(x[-2]), float(x[-1])

    def solve(self, steps: int = 40, enough: float = 1e-10) -> float:
        """Steps until the error falls no more; gives the root mean square error."""
        damping, self.state = 1e-3, self.evaluated(self.state, self.shared)
        s, r, cost, n = self.sums(self.state, damping)
        for _ in range(steps):
            step = np.linalg.solve(s + 1e-12 * np.eye(len(s)), r)
            shared = self.shared.copy()
            shared[self.free] += step
            moved = self.evaluated(self.state, shared, step, damping)
            s_new, r_new, new, _ = self.sums(moved, damping / 10)
            if np.isfinite(new) and new <= cost:
                done = cost - new <= enough * cost or new <= EXACT**2 * n
                self.shared, self.state, s, r, cost, damping = shared, moved, s_new, r_new, new, damping / 10
                if done:
                    break
            elif damping > 1e8 or cost - new > -enough * cost:
                break
            else:
                damping *= 10
                s, r, _, _ = self.sums(self.state, damping)
        return float(np.sqrt(cost / max(n, 1)))

    def views(self) -> DataFrame:
        """view, pose, rms"""
        return self.state.select("view", "pose", F.sqrt(F.element_at("block", -2) / F.element_at("block", -1)).alias("rms"))


def gathered(corners: DataFrame) -> DataFrame:
    """One row a view: its corners as camera, x, y, z, u, v one after the other. Views with fewer than four corners are left out."""
    camera = F.col("camera").cast("double") if "camera" in corners.columns else F.lit(0.0)
    # columns of their own, so that what they are computed from is computed once a row; the test is of the finished list
    named = corners.select("view", camera.alias("c0"), *[F.col(k).cast("double").alias(f"c{i}") for i, k in enumerate(("x", "y", "z", "u", "v"), 1)])
    listed = named.groupBy("view").agg(F.sort_array(F.collect_list(F.array(*[F.col(f"c{i}") for i in range(6)]))).alias("all"))
    whole = F.filter("all", lambda c: ~F.exists(c, lambda x: x.isNull() | F.isnan(x)))
    return cut(listed.select("view", F.flatten(whole).alias("corners")).filter(F.size("corners") >= 24))


def homography(corners: np.ndarray) -> np.ndarray:
    """From board to pixels, by the direct linear transform of centred coordinates; the board is flat (z = 0)."""
    def centred(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean, size = p.mean(axis=0), max(float(np.sqrt(((p - p.mean(axis=0)) ** 2).sum(axis=1).mean())), 1e-12)
        return (p - mean) / size, np.array([[1 / size, 0, -mean[0] / size], [0, 1 / size, -mean[1] / size], [0, 0, 1]])

    (p, tp), (q, tq) = centred(corners[:, 1:3]), centred(corners[:, 4:6])
    one, zero = np.ones(len(p)), np.zeros(len(p))
    rows = lambda v, lead: np.stack([*lead, -v * p[:, 0], -v * p[:, 1], -v], axis=1)
    a = np.concatenate([rows(q[:, 0], [p[:, 0], p[:, 1], one, zero, zero, zero]), rows(q[:, 1], [zero, zero, zero, p[:, 0], p[:, 1], one])])
    return np.linalg.inv(tq) @ np.linalg.eigh(a.T @ a)[1][:, 0].reshape(3, 3) @ tp


def first_guess(views: DataFrame, size: tuple[int, int]) -> tuple[np.ndarray, DataFrame]:
    """A camera without distortion, centred in the image, whose focal lengths suit all views' homographies; and views with poses."""
    centre = np.array([[1, 0, -(size[0] - 1) / 2], [0, 1, -(size[1] - 1) / 2], [0, 0, 1]])

    def conditions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the normal equations for 1 / fx^2 and 1 / fy^2: columns of a homography are of one length and at right angles."""
        for b, view, corners in batches_of(batches):
            total = np.zeros((2, 3))
            for v in range(b.num_rows):
                h = centre @ homography(corners[view == v])
                h = h / np.linalg.norm(h)
                for m in (h[:, 0] * h[:, 1], h[:, 0] ** 2 - h[:, 1] ** 2):
                    total += np.outer(m[:2], [m[0], m[1], -m[2]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(6)), pa.array(total.ravel())], names=["i", "x"])

    sums = dict(tuple(r) for r in views.mapInArrow(conditions, "i long, x double").groupBy("i").agg(F.sum("x")).collect())  # six rows
    m = np.array([sums.get(i, 0.0) for i in range(6)]).reshape(2, 3)
    inverse = np.linalg.lstsq(m[:, :2], m[:, 2], rcond=None)[0]
    f = np.where(inverse > 0, 1 / np.sqrt(np.maximum(inverse, 1e-18)), max(size))
    camera = np.array([*f, *(-centre[:2, 2]), 0, 0, 0, 0, 0])
    k = np.array([[f[0], 0, camera[2]], [0, f[1], camera[3]], [0, 0, 1]])

    def posed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, view, corners in batches_of(batches):
            pose = np.zeros((b.num_rows, POSE))
            for v in range(b.num_rows):
                h = np.linalg.inv(k) @ homography(corners[view == v])
                h = h * (2 / (np.linalg.norm(h[:, 0]) + np.linalg.norm(h[:, 1]))) * (1 if h[2, 2] > 0 else -1)
                pose[v] = [*rotation_vector(np.stack([h[:, 0], h[:, 1], np.cross(h[:, 0], h[:, 1])], axis=1)), *h[:, 2]]
            yield packed(b, pose, np.zeros((b.num_rows, 1)))

    return camera, cut(views.mapInArrow(posed, STATE.format(view=dict(views.dtypes)["view"])))


def rounds(solver: Solver, most: int, least: float) -> tuple[float, list[tuple[int, float]]]:
    """Solve, reject views whose error is over mean + 2 deviations (but not under ``least`` pixels), and so on; the best round stays."""
    best, found = None, []
    for i in range(most):
        rms = solver.solve()
        views = solver.views()
        n, spread = views.agg(F.count("*"), F.stddev_pop("rms")).first()
        found.append((n, rms))
        if best is None or rms < best[0]:
            best = (rms, solver.shared, solver.state)
        limit = max(rms + 2 * (spread or 0.0), least)
        kept = cut(solver.state.join(views.filter(F.col("rms") <= limit).select("view"), "view", "left_semi").select("view", "corners", "pose", "block"))
        if kept.count() in (n, 0):
            break
        solver.state = kept
    rms, solver.shared, solver.state = best
    return rms, found


def result(solver: Solver, rms: float, found: list[tuple[int, float]], pair: bool) -> Calibration:
    pose = F.col("pose")
    views = solver.views().select("view", F.slice(pose, 1, 3).alias("rvec"), F.slice(pose, 4, 3).alias("tvec"), "rms")
    cameras = [solver.shared[k : k + OWN].tolist() for k in range(0, OWN * (1 + pair), OWN)]
    return Calibration(cameras, solver.shared[2 * OWN :].tolist() if pair else None, rms, views, found)


def calibrated(corners: DataFrame, size: tuple[int, int], most_rounds: int = 5, least: float = 0.25) -> Calibration:
    """A camera from corners (view, x, y, z = 0, u, v) in images of ``size`` (width, height)."""
    camera, state = first_guess(gathered(corners.drop("camera") if "camera" in corners.columns else corners), size)
    solver = Solver(camera, range(OWN), state)
    rms, found = rounds(solver, most_rounds, least)
    return result(solver, rms, found, pair=False)


def calibrated_pair(corners: DataFrame, size: tuple[int, int], most_rounds: int = 5, least: float = 0.25, fix_cameras: bool = False) -> Calibration:
    """Two cameras and the pose between them, from corners with ``camera`` (0 or 1); views that only one camera has still tell of that one.

    Each camera is calibrated by itself first; the pose between them starts from the mean over views that both have."""
    one, two = (calibrated(corners.filter(F.col("camera") == c), size, most_rounds, least) for c in (0, 1))
    both = one.views.join(two.views.select("view", F.col("rvec").alias("r2"), F.col("tvec").alias("t2")), "view").select("rvec", "tvec", "r2", "t2")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                r1, t1, r2, t2 = (dense(c) for c in b.columns)
                turn = rotation(r2) @ rotation(r1).transpose(0, 2, 1)
                total = np.concatenate([turn.sum(axis=0).ravel(), (t2 - (turn @ t1[:, :, None])[:, :, 0]).sum(axis=0), [len(turn)]])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(13)), pa.array(total)], names=["i", "x"])

    sums = dict(tuple(r) for r in both.mapInArrow(between, "i long, x double").groupBy("i").agg(F.sum("x")).collect())  # 13 rows
    if not sums:
        raise ValueError("no view is left that both cameras have")
    x = np.array([sums[i] for i in range(13)])
    shared = np.array([*one.cameras[0], *two.cameras[0], *rotation_vector(x[:9].reshape(3, 3) / x[12]), *(x[9:12] / x[12])])
    # views start from the first camera's pose, or else from the second's, turned back
    turn, shift = rotation(shared[None, 2 * OWN : 2 * OWN + 3])[0], shared[2 * OWN + 3 :]

    @F.pandas_udf("array<double>")
    def back(pose):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([[*rotation_vector(turn.T @ rotation(np.asarray(p)[None, :3])[0]), *(turn.T @ (np.asarray(p)[3:] - shift))] for p in pose])

    of = lambda c, pose: c.views.select("view", pose.alias("pose"))
    whole = F.concat("rvec", "tvec")
    rest = two.views.join(one.views.select("view"), "view", "left_anti")
    poses = of(one, whole).unionByName(rest.select("view", back(whole).alias("pose")))
    state = cut(gathered(corners).join(poses, "view").select("view", "corners", "pose", F.array(F.lit(0.0)).alias("block")))
    solver = Solver(shared, range(2 * OWN if fix_cameras else 0, len(shared)), state)
    rms, found = rounds(solver, most_rounds, least)
    return result(solver, rms, found, pair=True)
