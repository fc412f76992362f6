"""Made-up cameras are found again from the corners that they would see."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import calibration as cal

SIZE = (1280, 1024)
LEFT = [1400.0, 1390.0, 655.0, 500.0, -0.21, 0.12, 0.0012, -0.0007, -0.03]
RIGHT = [1425.0, 1419.0, 633.0, 521.0, -0.18, 0.08, -0.0004, 0.0009, 0.01]
BETWEEN = [0.02, -0.05, 0.01, -0.3, 0.004, 0.012]


def seen(views, seed=0, noise=0.0):
    """(view, camera, x, y, z, u, v) of a board of 9 x 7 corners in random poses before two cameras."""
    rng = np.random.default_rng(seed)
    grid = np.array([(0.04 * i, 0.04 * j, 0.0) for i in range(9) for j in range(7)])
    out = []
    for v in range(views):
        turn, at = rng.uniform(-0.6, 0.6, 3), [rng.uniform(-0.35, 0.1), rng.uniform(-0.3, 0.1), rng.uniform(0.7, 1.6)]
        pose = np.tile([*turn, *at], (len(grid), 1))
        for c in (0, 1):
            uv = cal.projections(np.array([*LEFT, *RIGHT, *BETWEEN]), pose, np.full(len(grid), c), grid) + rng.normal(0, noise, (len(grid), 2))
            out += [(v, c, *map(float, g), *map(float, p)) for g, p in zip(grid, uv, strict=True)]
    return out


SCHEMA = "view int, camera int, x double, y double, z double, u double, v double"


def test_rotations_and_their_vectors():
    rng = np.random.default_rng(1)
    for r in [*rng.uniform(-1.7, 1.7, (50, 3)), np.zeros(3), np.array([0, np.pi, 0]), np.array([1e-10, 0, 0])]:
        m = cal.rotation(r[None])[0]
        assert np.allclose(m @ m.T, np.eye(3)) and np.allclose(cal.rotation(cal.rotation_vector(m)[None])[0], m, atol=1e-8)


def test_the_schur_step_is_the_step_of_the_whole_system(spark):
    """Against one dense system of all unknowns."""
    rows = [r for r in seen(4, noise=0.5) if r[1] == 0]
    camera, state = cal.first_guess(cal.gathered(spark.createDataFrame(rows, SCHEMA).drop("camera")), SIZE)
    solver = cal.Solver(camera, range(9), state)
    state = solver.evaluated(state, camera)
    s, r, cost, n = solver.sums(state, 0.01)
    got = state.collect()
    assert n == 4 * 63 and cost > 0
    whole, right = np.zeros((9 + 24, 9 + 24)), np.zeros(9 + 24)
    for i, row in enumerate(got):
        u, w, g, v, h, _, _ = (x[0] for x in cal.unpacked(np.array([row["block"]]), 9))
        at = slice(9 + 6 * i, 15 + 6 * i)
        whole[:9, :9] += v
        right[:9] += h
        whole[at, at], whole[:9, at], whole[at, :9], right[at] = u, w, w.T, g
    step = np.linalg.solve(whole + 0.01 * np.diag(np.diag(whole)), right)
    assert np.allclose(np.linalg.solve(s, r), step[:9], rtol=1e-5, atol=1e-8)
    moved = {x["view"]: x["pose"] for x in solver.evaluated(state, camera + step[:9], step[:9], 0.01).collect()}
    assert all(np.allclose(np.array(row["pose"]) + step[9 + 6 * i : 15 + 6 * i], moved[row["view"]], rtol=1e-5, atol=1e-8) for i, row in enumerate(got))


def test_one_camera_from_200_views_without_the_wrong_ones(spark):
    rows = [r for r in seen(200, noise=0.02) if r[1] == 0]
    rng = np.random.default_rng(3)
    wrong = {7, 90}
    rows = [(*r[:5], r[5] + rng.normal(0, 8), r[6] + rng.normal(0, 8)) if r[0] in wrong else r for r in rows]
    rows += [(500, 0, 0.0, 0.0, 0.0, 1.0, 1.0), (501, 0, 0.0, 0.0, 0.0, None, 1.0)]  # too few corners
    found = cal.calibrated(spark.createDataFrame(rows, SCHEMA), SIZE)
    assert np.abs(np.array(found.cameras[0][:4]) / LEFT[:4] - 1).max() < 1e-3 and np.abs(np.array(found.cameras[0][4:8]) - LEFT[4:8]).max() < 1e-2
    left = {r["view"] for r in found.views.collect()}
    assert not left & (wrong | {500, 501}) and len(left) > 150 and found.rms < 0.05
    assert found.rounds[0][0] == 200 and found.rounds[0][1] > found.rms


def test_two_cameras_and_the_pose_between_them(spark):
    rows = [r for r in seen(40, seed=5) if not (r[0] == 3 and r[1] == 1) and not (r[0] == 4 and r[1] == 0)]
    found = cal.calibrated_pair(spark.createDataFrame(rows, SCHEMA), SIZE)
    assert np.allclose(found.cameras, [LEFT, RIGHT], rtol=1e-3, atol=1e-3) and np.allclose(found.relative, BETWEEN, atol=1e-4)
    assert found.views.count() == 40 and found.rms < 1e-3


def test_no_common_view(spark):
    rows = [r for r in seen(16, seed=6) if r[1] == r[0] % 2]
    with pytest.raises(ValueError, match="both cameras"):
        cal.calibrated_pair(spark.createDataFrame(rows, SCHEMA), SIZE)
    assert cal.gathered(spark.createDataFrame(rows, SCHEMA).filter(F.lit(False))).count() == 0
