import math

import pytest
from pyspark.sql import functions as F

from fathomline.config import ImageConfig, Mission, Mount, NavConfig, Sensor, Vehicle
from fathomline.operators.folds import EkfConfig
from fathomline.plans import correction, navigation
from fathomline.sinks import files


@pytest.fixture(scope="module")
def dive(spark):
    """Constant speed north for 60 s at 1 m/s, heading 0, 5 m deep, 3 m above ground."""
    t0 = 1_000_000.0
    mk = lambda rows, s: spark.createDataFrame(rows, s)
    return navigation.Sensors(
        velocity=mk([("a", t0 + i, 1.0, 0.0, 0.0, 0.02, 0.02, 0.02) for i in range(61)], "dive string, t double, x_velocity double, y_velocity double, z_velocity double, x_velocity_std double, y_velocity_std double, z_velocity_std double"),
        orientation=mk([("a", t0 + 0.5 + i * 0.5, 0.0, 0.0, 0.0, 0.1, 0.1, 0.1) for i in range(118)], "dive string, t double, roll double, pitch double, yaw double, roll_std double, pitch_std double, yaw_std double"),
        depth=mk([("a", t0 + i, 5.0, 0.05) for i in range(61)], "dive string, t double, depth double, depth_std double"),
        altitude=mk([("a", t0 - 1 + i, 3.0) for i in range(62)], "dive string, t double, altitude double"),
        usbl=mk([("a", t0 + 2 + 5 * i, 100.0 + 5 * i + 2, 50.0, 5.0, 1.0, 1.0, 0.5) for i in range(11)], "dive string, t double, northings double, eastings double, depth double, northings_std double, eastings_std double, depth_std double"))


def test_navigation(spark, dive):
    out = navigation.run(dive, 50.0, -1.0, Vehicle(), NavConfig(), EkfConfig(mahalanobis=1000.0))
    d = out["dead_reckoning"].orderBy("t").collect()
    assert d[-1]["northings"] - d[0]["northings"] == pytest.approx(d[-1]["t"] - d[0]["t"], abs=1e-6)
    assert d[0]["northings"] == pytest.approx(100.5, abs=0.1) and d[0]["latitude"] == pytest.approx(50.0009, abs=1e-3) and d[0]["depth"] == 5.0
    assert out["seafloor"].orderBy("t").first()["seafloor_depth"] == 8.0
    e = out["ekf"].orderBy(F.col("t").desc()).first()
    assert abs(e["x_velocity"] - 1) < 0.1 and abs(e["depth"] - 5) < 0.2
    cams = spark.createDataFrame([("a", 1_000_010.25, "x.tif"), ("a", 5.0, "early.tif")], "dive string, t double, filename string")
    p = navigation.camera_poses(cams, out["dead_reckoning"], Vehicle({"camera1": Mount(surge=1.0, heave=0.5)})).collect()
    assert len(p) == 1 and p[0]["depth"] == pytest.approx(5.5)


def test_correction(spark):
    data = [(f"i{i}", 0, p, 0.5 * math.exp(-0.3 * alt) + 0.02, alt) for i in range(60) for alt in [2.0 + i / 10 * 0.5] for p in range(4)]
    pixels = spark.createDataFrame(data, "image_id string, channel int, pixel int, value double, altitude double")
    a, s = correction.parameters(pixels, ImageConfig(altitude_min=1.9, altitude_max=6.0, bin_width=0.6))
    assert a.count() == 4
    out = correction.correct(pixels, a, s, ImageConfig()).agg(F.avg("value"), F.min("value"), F.max("value")).first()
    assert 0 <= out[1] <= out[2] <= 255


def test_config_round_trip():
    m = Mission.of({"version": 1, "origin": {"latitude": 1, "longitude": 2, "date": "2020/01/01"}, "velocity": {"format": "phins", "filepath": "nav", "timezone": "jst", "std_factor": 0.1}, "image": {"camera1": "a/b"}})
    assert m.sensors["velocity"] == Sensor("phins", "nav", "", 9.0, 0.0, 0.1) and m.cameras == [{"name": "camera1", "path": "a/b"}]
    assert Mission.of(m.to_dict()) == m
    assert Vehicle.of({"dvl": {"surge_m": 1, "yaw_deg": 45}}).arm("dvl") == (1.0, 0.0, 0.0)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2.0, 1.0, None), ("a", 1.0, 0.0, 3.0), ("b", 1.0, 0.0, 3.0)], "dive string, t double, northings double, depth double")
    files.write_csv(rows, str(tmp_path / "out"), ["dive"])
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 2 and {r["depth [m]"] for r in back.collect()} == {"None", "3.0"}
    j = rows.withColumn("depth_std", F.lit(0.1))
    text = j.select(files.record_json(j, "depth").alias("j")).orderBy("j").first()["j"]
    assert '"category":"depth"' in text and '"data": [' in text
    cov = spark.createDataFrame([([float(i) for i in range(144)],)], "covariance array<double>")
    assert files.covariance_columns(cov).first()["cov_y_x"] == 12.0
    eye = spark.createDataFrame([([2.0 if i % 13 == 0 else 0.0 for i in range(144)],)], "covariance array<double>")
    info = eye.select(files.information().alias("i")).first()["i"]
    assert info[0] == pytest.approx(0.5) and len(info) == 36


def test_stream(spark, tmp_path):
    from fathomline.streaming.tracks import dead_reckoned_stream

    rows = spark.createDataFrame([("a", float(i), 1.0, 2.0) for i in range(10)], "dive string, t double, north_velocity double, east_velocity double").withColumn("ts", F.timestamp_seconds("t"))
    rows.filter("t < 5").write.parquet(str(tmp_path / "in"))
    rows.filter("t >= 5").write.mode("append").parquet(str(tmp_path / "in"))
    s = dead_reckoned_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "in")))
    q = s.writeStream.format("memory").queryName("track").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    end = spark.table("track").orderBy(F.col("t").desc()).first()
    assert end["t"] == 9.0 and end["eastings"] == pytest.approx(2 * end["northings"])
