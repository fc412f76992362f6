import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.functions import frames, geo, text, times


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_rotation_zero_and_inverse(spark):
    r = one(spark, *[c.alias(n) for n, c in zip("abc", frames.body_to_inertial(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(2.0), F.lit(3.0)), strict=True)])
    assert tuple(r) == (1.0, 2.0, 3.0)
    turned = frames.body_to_inertial(F.lit(10.0), F.lit(20.0), F.lit(30.0), F.lit(1.0), F.lit(2.0), F.lit(3.0))
    back = one(spark, *[c.alias(n) for n, c in zip("abc", frames.inertial_to_body(F.lit(10.0), F.lit(20.0), F.lit(30.0), *turned), strict=True)])
    assert np.allclose(tuple(back), (1, 2, 3))


def test_yaw_goes_the_short_way(spark):
    l = F.lit
    y = one(spark, frames.yaw_between(l(5.0), l(0.0), l(10.0), l(350.0), l(20.0)).alias("y"))["y"]
    assert y == pytest.approx(5.0)
    y = one(spark, frames.yaw_between(l(2.0), l(0.0), l(10.0), l(10.0), l(350.0)).alias("y"))["y"]
    assert y == pytest.approx(6.0)


def test_clamp(spark):
    r = one(spark, *[frames.clamp_pi(F.lit(x)).alias(f"c{i}") for i, x in enumerate((math.pi, -math.pi, 3.5 * math.pi, -0.5))])
    assert np.allclose(tuple(r), (math.pi, -math.pi, -0.5 * math.pi, -0.5))


def test_geodesics_near_and_far():
    s, az = geo.inverse(50.936501, -1.404266, 50.936870, -1.396295)
    assert 500 < s < 600 and 85 < az < 90
    s, az = geo.inverse(-33.8559799094, 151.20666584, 35.652832, 139.839478)
    assert 7.5e6 < s < 8.5e6 and -20 < az < 10
    for a, b in (((50.936501, -1.404266), (50.936870, -1.396295)), ((-33.8559799094, 151.20666584), (35.652832, 139.839478))):
        s, az = geo.inverse(*a, *b)
        assert np.allclose(geo.direct(*a, az, s), b, atol=1e-7)
    assert geo.inverse(1.0, 2.0, 1.0, 2.0)[0] == pytest.approx(0)
    s, _ = geo.inverse(0.0, 0.0, 0.2, 179.9)  # nearly opposite: falls back
    assert 1.99e7 < s < 2.01e7


def test_geodesics_in_a_plan(spark):
    g = spark.range(1).select(geo.latlon_to_metres(50.936870, -1.396295, 50.936501, -1.404266).alias("g"))
    n, e = geo.northings_eastings(F.col("g"))
    r = g.select(geo.metres_to_latlon(50.936501, -1.404266, e, n).alias("p")).select("p.*").first()
    assert r["latitude"] == pytest.approx(50.936870) and r["longitude"] == pytest.approx(-1.396295)


def test_degree_strings(spark):
    r = one(spark, geo.degrees_from_minutes(F.lit("5950.89694N")).alias("a"), geo.degrees_from_minutes(F.lit("00123.4W")).alias("b"), geo.degrees_from_dashed(F.lit("12-30.0 S")).alias("c"), geo.degrees_from_dashed(F.lit("12-30.0 S"), parity=True).alias("d"), geo.degrees_from_minutes(F.lit("x")).alias("e"))
    assert r["a"] == pytest.approx(59 + 50.89694 / 60) and r["b"] == pytest.approx(-(1 + 23.4 / 60)) and r["c"] == -12.5 and r["d"] == -11.5 and r["e"] is None


def test_clock_of_day(spark):
    day = times.epoch_from_parts(2018, 11, 19, 0, 0, 0)
    r = one(spark, times.clock_of_day(F.lit("083015.023"), day, 1.0, 10.0).alias("t"), times.clock_of_day(F.lit("083060.0"), day).alias("bad"))
    assert r["t"] == pytest.approx(1542580216.023) and r["bad"] is None


def test_image_names(spark):
    r = one(spark, times.epoch_from_image_name(F.lit("a/PR_20180811_153729_762_RC16.tif"), "acfr").alias("a"), times.epoch_from_image_name(F.lit("20190913_101347_962382_x.tif"), "biocam").alias("b"),
            times.epoch_from_stamp(F.lit("PR_20180811_153729_762_RC16.tif"), "xxxYYYYMMDDxhhmmssxfffxxxxx.xxx").alias("c"))
    assert r["a"] == pytest.approx(1534001849.762) and r["c"] == pytest.approx(1534001849.762) and r["b"] == pytest.approx(1568369627.962382)


def test_checksum(spark):
    good = "$PIXSE,TIME__,083015.023*"
    x = 0
    for c in good[1:-1]:
        x ^= ord(c)
    r = one(spark, text.sentence_ok(F.lit(f"{good}{x:02X}")).alias("a"), text.sentence_ok(F.lit(f"{good}{(x ^ 1):02X}")).alias("b"), text.sentence_ok(F.lit("noise")).alias("c"))
    assert tuple(r) == (True, False, False)


def test_paths(spark):
    r = one(spark, text.stem(F.lit("a/b/c.tar.gz")).alias("a"), text.mirrored(F.lit("/d/raw/x/y.csv"), "processed").alias("b"), text.relative_to(F.lit("/d/raw/x"), "/d/raw").alias("c"))
    assert tuple(r) == ("c.tar", "/d/processed/x/y.csv", "x")


def test_euler(spark):
    q = (0.0, 0.0, math.sin(math.pi / 8), math.cos(math.pi / 8))
    r = one(spark, *[c.alias(f"c{i}") for i, c in enumerate(frames.euler_from_quaternion(*map(F.lit, q)))])
    assert np.allclose(tuple(r), (0, 0, math.pi / 4))
