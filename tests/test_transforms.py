import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.functions import transforms as tf

AXES = ["sxyz", "rzyx", "sxzy", "szxz", "ryxy", "szyx"]


def value(spark, *columns):
    one = spark.range(1)
    return np.array(one.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first(), float)


def turn(axis, a):
    i, j = (axis + 1) % 3, (axis + 2) % 3
    m = np.eye(3)
    m[i, i] = m[j, j] = math.cos(a)
    m[i, j], m[j, i] = -math.sin(a), math.sin(a)
    return m


def flat(m):
    return [c for row in m for c in row]


@pytest.mark.parametrize("axes", AXES)
def test_all_euler_axes(spark, axes):
    angles = np.array([(0.3, -0.7, 1.9), (-2.5, 0.4, 0.1), (0.5, math.pi / 2, 0.2), (0.5, 0.0, 0.2)])
    order = ["xyz".index(a) for a in axes[1:]]
    want = []
    for row in angles:
        turns = [turn(a, v) for a, v in zip(order, row, strict=True)]
        want.append(turns[2] @ turns[1] @ turns[0] if axes[0] == "s" else turns[0] @ turns[1] @ turns[2])
    df = spark.createDataFrame([tuple(map(float, r)) for r in angles], "a double, b double, c double").coalesce(1)
    abc = [F.col(c) for c in "abc"]
    made = df.select(*[c.alias(f"m{i}") for i, c in enumerate(flat(tf.from_euler(*abc, axes)))], *[c.alias(f"q{i}") for i, c in enumerate(tf.quaternion_from_euler(*abc, axes))]).collect()
    assert np.allclose([list(r)[:9] for r in made], np.reshape(want, (-1, 9)), atol=1e-9)
    again = spark.createDataFrame(made).coalesce(1)
    m = tuple(tuple(F.col(f"m{3 * i + j}") for j in range(3)) for i in range(3))
    found = again.select(*[c.alias(n) for n, c in zip("abc", tf.to_euler(m, axes), strict=True)], *[c.alias(f"r{i}") for i, c in enumerate(flat(tf.from_quaternion(tuple(F.col(f"q{i}") for i in range(4)))))]).collect()
    assert np.allclose([list(r)[3:] for r in found], np.reshape(want, (-1, 9)), atol=1e-9)
    back = spark.createDataFrame([tuple(r)[:3] for r in found], "a double, b double, c double").coalesce(1)
    got = back.select(*[c.alias(f"m{i}") for i, c in enumerate(flat(tf.from_euler(*abc, axes)))]).collect()
    assert np.allclose([list(r) for r in got], np.reshape(want, (-1, 9)), atol=1e-7)


def held(spark, columns, prefix):
    """Columns as a table of one row of plain numbers."""
    row = value(spark, *columns)
    return spark.createDataFrame([tuple(map(float, row))], ", ".join(f"{prefix}{i} double" for i in range(len(columns)))).coalesce(1)


def test_quaternions(spark):
    cols = lambda n, k: tuple(F.col(f"{n}{i}") for i in range(k))
    for angle, axis in ((1.2, (1, 2, -0.5)), (math.pi, (0.6, -0.8, 0))):
        d = held(spark, tf.quaternion_about(angle, axis), "q")
        q = cols("q", 4)
        m = np.array(d.select(*[c.alias(f"m{i}") for i, c in enumerate(flat(tf.from_quaternion(q)))]).first(), float)
        e = spark.createDataFrame([tuple(map(float, m))], ", ".join(f"m{i} double" for i in range(9))).coalesce(1)
        matrix = tuple(tuple(F.col(f"m{3 * i + j}") for j in range(3)) for i in range(3))
        back = np.array(e.select(*[c.alias(f"b{i}") for i, c in enumerate(tf.to_quaternion(matrix))], tf.angle_of(matrix).alias("a")).first(), float)
        want = np.array(d.first(), float)
        assert np.allclose(back[:4], want) or np.allclose(back[:4], -want)
        assert back[4] == pytest.approx(angle)
        assert np.allclose(d.select(*[c.alias(f"c{i}") for i, c in enumerate(tf.multiplied(q, tf.inverse(q)))]).first(), [1, 0, 0, 0])
    d = held(spark, (*tf.quaternion_about(1.2, (1, 2, -0.5)), *tf.quaternion_about(0.6, (1, 2, -0.5))), "q")
    q, half = cols("q", 4), np.array(d.first(), float)[4:]
    for turned in (q, tuple(-c for c in q)):
        assert np.allclose(d.select(*[c.alias(f"c{i}") for i, c in enumerate(tf.slerp(tf.vector(1, 0, 0, 0), turned, 0.5))]).first(), half)


def test_affine_matrices(spark):
    p = (1.0, 2.0, 3.0)
    r = held(spark, [c for row in tf.rotation(math.pi / 2, (0, 0, 1), (1, 0, 0)) for c in row], "r")
    m = tuple(tuple(F.col(f"r{4 * i + j}") for j in range(4)) for i in range(4))
    cases = [
        (tf.translation((1, -1, 0.5)), (2, 1, 3.5)), (tf.reflection((0, 0, 1), (0, 0, 2)), (1, 2, -1)), (tf.scaling(2, (1, 1, 1)), (1, 3, 5)), (tf.scaling(2, (0, 0, 0), (0, 1, 0)), (1, 4, 3)),
        (tf.projection((0, 0, 1), (0, 0, 1)), (1, 2, 1)), (tf.projection((0, 0, 0), (0, 0, 1), (1, 0, 1)), (-2, 2, 0)), (tf.shear(math.pi / 4, (1, 0, 0), (0, 0, 0), (0, 0, 1)), (4, 2, 3)),
        (m, (-1, 0, 3)), (tf.product(tf.inverse_rigid(m), m), p),
    ]
    got = r.select(*[c.alias(f"c{k}_{i}") for k, (t, _) in enumerate(cases) for i, c in enumerate(tf.applied(t, p))]).first()
    assert np.allclose(np.reshape(got, (-1, 3)), [w for _, w in cases])
