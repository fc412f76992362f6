"""Operators that no query runs: small inputs with known answers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.functions import geo, times
from fathomline.operators import aggregates, consensus, filters, folds, geometry, graphs, interp, sampling
from fathomline.sinks import files
from fathomline.sources import images, logs, tables
from fathomline.sources.lines import lines_of


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_ransac_mean_leaves_outliers_out(spark):
    d = rows(spark, [("a", 1.0 + 0.01 * (i % 5)) for i in range(50)] + [("a", 9.0)], "g string, v double")
    r = aggregates.ransac_mean(d, ["g"], "v", signed=False).first()
    assert r["mean"] == pytest.approx(1.02, abs=0.01) and r["n"] == 50


@pytest.mark.parametrize("method", ["mean", "mean_trimmed", "median"])
def test_smoothed_bins(spark, method):
    d = rows(spark, [(0, 0, 0, 2.0 + 0.1 * i, float(v)) for i, v in enumerate(range(1, 11))], "bin int, channel int, pixel int, altitude double, value double")
    r = aggregates.smoothed_bins(d, method).first()
    assert r["intensity"] == 5.5 and r["distance"] == pytest.approx(2.45)


def test_capped_bins_and_merged_dives(spark):
    d = rows(spark, [(i % 3, i) for i in range(90)], "b int, k int")
    once, again = (sorted(tuple(r) for r in sampling.capped_bins(d.repartition(n), ["b"], "k", 4).collect()) for n in (2, 5))
    assert once == again and len(once) == 12
    dive = lambda lat: rows(spark, [("origin", lat, 1.0), ("depth", None, None)], "category string, latitude double, longitude double")
    assert sampling.merged_dives(dive(50.0), dive(50.0)).count() == 4
    with pytest.raises(ValueError):
        sampling.merged_dives(dive(50.0), dive(51.0))


def cone(apex, axis, theta, n=400):
    rng = np.random.default_rng(4)
    axis = np.asarray(axis, float) / np.linalg.norm(axis)
    u = np.cross(axis, [0.0, 0.0, 1.0]) / np.linalg.norm(np.cross(axis, [0.0, 0.0, 1.0]))
    w = np.cross(axis, u)
    h, a = rng.uniform(0.05, 0.3, n), rng.uniform(-0.5, 0.5, n)
    side = h * math.tan(theta)
    return np.asarray(apex) + h[:, None] * axis + side[:, None] * (np.cos(a)[:, None] * u + np.sin(a)[:, None] * w)


def test_cones_and_rays(spark):
    points = cone((1.5, 0.0, 0.0), (1, 0, 0), 1.45)
    r = geometry.fit_cones(rows(spark, [("g", *map(float, p)) for p in points], "g string, x double, y double, z double"), ["g"]).first()
    apex, axis = np.array([r["apex_x"], r["apex_y"], r["apex_z"]]), np.array([r["axis_x"], r["axis_y"], r["axis_z"]])
    assert np.abs(geometry.cone_distance(points, apex, axis, r["theta"])).max() < 1e-2
    hit = geometry.ray_cone(np.array([0, 0, 1.0]), np.array([0, 0, 1.0]), math.pi / 4, np.array([0.1, 0, 1.0]))
    assert geometry.cone_distance(hit[None], np.array([0, 0, 1.0]), np.array([0, 0, 1.0]), math.pi / 4)[0] == pytest.approx(0, abs=1e-9)


def test_rays_on_cones_as_expressions(spark):
    rng = np.random.default_rng(3)
    rays = np.column_stack([rng.uniform(-1, 1, (300, 2)), np.ones(300)])
    for apex, axis, theta in (((0.3, -0.1, 0.5), (0.3, 0, 1), 1.2), ((0, 0, 1), (0, 0, 1), math.pi / 4), ((0, 0, 3), (0, 1, -1), 0.5)):
        d = rows(spark, [(i, *map(float, r)) for i, r in enumerate(rays)], "i int, x double, y double, z double")
        got = {r["i"]: r["t"] for r in d.select("i", geometry.on_cone((F.col("x"), F.col("y"), F.col("z")), apex, axis, theta).alias("t")).collect()}
        for i, ray in enumerate(rays):
            want = geometry.ray_cone(np.array(apex, float), np.array(axis, float), theta, ray)
            assert (got[i] is None) == (want is None) and (want is None or np.allclose(ray * got[i], want))
        assert any(t is not None for t in got.values())
    pixels = rows(spark, [(640.0, 512.0), (700.0, 300.0)], "u double, v double")
    for r in geometry.sheet_points(pixels, (1000, 1000, 640, 512), (0.0, 0.0, 1.0), (0.0, 0.0, 1.0), 1.5).collect():
        assert geometry.cone_distance(np.array([[r["x"], r["y"], r["z"]]]), np.array([0, 0, 1.0]), np.array([0, 0, 1.0]), 1.5)[0] < 1e-9


def test_hops_and_paths(spark):
    import random

    rng = random.Random(4)
    edges = {(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(80)} | {("x", "y")}
    e = rows(spark, [*edges, (None, "n1"), ("n1", None)], "a string, b string")
    for directed in (False, True):
        near, want, front, n = {}, {"n1": 0, "n2": 0}, {"n1", "n2"}, 0
        for a, b in edges:
            near.setdefault(a, set()).add(b)
            if not directed:
                near.setdefault(b, set()).add(a)
        while front:
            n += 1
            front = {b for a in front for b in near.get(a, ())} - set(want)
            want |= dict.fromkeys(front, n)
        found = graphs.hops(e, rows(spark, [("n1",), ("n2",), ("n2",), (None,)], "node string"), directed=directed)
        assert {r["node"]: r["hops"] for r in found.collect()} == want
        far = max(want, key=want.get)
        way = graphs.path(found, far)
        assert len(way) == want[far] + 1 and way[0] in ("n1", "n2") and all(b in near[a] for a, b in zip(way, way[1:]))
        assert graphs.path(found, "x") == []


def test_triangulation_both_ways(spark):
    turn = math.radians(10)
    r = np.array([[math.cos(turn), 0, -math.sin(turn)], [0, 1, 0], [math.sin(turn), 0, math.cos(turn)]])
    m = np.hstack([r, [[-0.5], [0.02], [0.01]]])
    world = np.array([[0.3, -0.2, 2.0], [0.0, 0.1, 3.0]])
    second = world @ r.T + m[:, 3]
    data = [(float(a[0] / a[2]), float(a[1] / a[2]), float(b[0] / b[2]), float(b[1] / b[2])) for a, b in zip(world, second, strict=True)]
    d = rows(spark, data, "u1 double, v1 double, u2 double, v2 double")
    for out in (geometry.triangulated(d, np.hstack([np.eye(3), np.zeros((3, 1))]), m), geometry.triangulated_between(d, m)):
        assert np.allclose(sorted((x["x"], x["y"], x["z"]) for x in out.collect()), sorted(map(tuple, world)), atol=1e-9)


def test_uncertainty_planes_come_from_all_points(spark):
    rng = np.random.default_rng(6)
    d = rows(spark, [(i, 1.5, float(y), float(z)) for i, (y, z) in enumerate(rng.random((3000, 2)) * 4)], "k int, x double, y double, z double")
    p = geometry.uncertainty_planes(d, "k", 0.5, planes=20).collect()
    assert len(p) == 20 and all(abs(abs(r["a"]) - 1) < 1e-9 and abs(abs(r["d"]) - 1.5) < 1e-9 for r in p)
    assert p == geometry.uncertainty_planes(d.repartition(7), "k", 0.5, planes=20).collect()
    with pytest.raises(ValueError, match="0 of 5 planes"):
        geometry.uncertainty_planes(d.limit(2), "k", 0.5, planes=5)


def test_uncertainty_planes_are_found_where_hardly_a_triple_fits(spark):
    """Two knots far off among many points in one place: one triple in some 100,000 fits. Depth (x) doesn't count."""
    data = [(i, float(i), 0.001 * (i % 7), 0.001 * (i % 5)) for i in range(400)] + [(1000, 1.0, 10.0, 0.0), (1001, 2.0, 5.0, 9.0)]
    d = rows(spark, data, "k int, x double, y double, z double")
    p = geometry.uncertainty_planes(d, "k", 5.0, planes=300, batch=2_000_000).collect()
    assert len(p) == 300
    for r in p:  # each goes through both knots
        assert abs(r["a"] * 1 + r["b"] * 10 + r["d"]) < 1e-6 and abs(r["a"] * 2 + r["b"] * 5 + r["c"] * 9 + r["d"]) < 1e-6
    with pytest.raises(ValueError, match="too close or too much in line"):
        geometry.uncertainty_planes(d.filter("k < 1000"), "k", 5.0, planes=3, most=200_000)


def plain_plane(xyz, rounds=50):
    w, plane = np.ones(len(xyz)), np.zeros(4)
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


def test_consensus_against_brute_force_over_the_same_hypotheses(spark):
    rng = np.random.default_rng(12)
    groups = {"a": 300, "b": 40, "c": 2, None: 30}
    data = []
    for g, n in groups.items():
        yz = rng.random((n, 2)) * 4
        data += [(g, *map(float, p)) for p in np.column_stack([1.5 + 0.1 * yz[:, 0] + rng.normal(0, 0.03, n), yz])]
        data += [(g, *map(float, p)) for p in rng.random((n // 3, 3)) * 4]
    d = rows(spark, data, "g string, x double, y double, z double").repartition(5)
    tried = {r["g"]: r["planes"] for r in consensus.planes_of_triples(consensus.drawn(d, ["g"], consensus.XYZ, 0), ["g"], 50, 0).collect()}
    found = geometry.ransac_planes(d, ["g"], rounds=50)
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r["g"]: r for r in found.collect()}
    assert set(got) == set(groups)
    for g in groups:
        xyz = np.array([p[1:] for p in data if p[0] == g])
        near = [np.abs(xyz @ np.array([h["a"], h["b"], h["c"]]) + h["d"]) < 0.05 for h in tried[g]]
        best = max(near, key=lambda m: m.sum(), default=np.zeros(len(xyz), bool))
        want = plain_plane(xyz[best] if best.sum() >= 3 else xyz)
        assert got[g]["inliers"] == best.sum()
        if g != "c":
            assert np.allclose([got[g][c] for c in "abcd"], want, atol=1e-6), g
    fitted = {r["g"]: r for r in geometry.fit_planes(d.filter("g <> 'c'"), ["g"]).collect()}
    for g in ("a", "b"):
        xyz = np.array([p[1:] for p in data if p[0] == g])
        want = plain_plane(xyz)
        assert np.allclose([fitted[g][c] for c in "abcd"], want, atol=1e-6) and fitted[g]["inliers"] == (np.abs(xyz @ want[:3] + want[3]) < 0.05).sum()


@pytest.mark.parametrize("signed", [True, False])
def test_consensus_means_against_brute_force(spark, signed):
    rng = np.random.default_rng(13)
    data = [(g, float(v)) for g in range(4) for v in [*rng.normal(g, 0.04, 60), *rng.random(15) * 9]] + [(9, 3.0), (7, None)]
    d = rows(spark, data, "g int, v double").repartition(4)
    got = {r["g"]: r for r in aggregates.ransac_mean(d, ["g"], "v", rounds=200, signed=signed).collect()}
    assert set(got) == {0, 1, 2, 3, 9}
    for g in got:
        v = np.sort([x for k, x in data if k == g])
        guesses = v[np.random.default_rng(0).integers(0, len(v), (200, 2))].mean(axis=1)
        scores = [((v[m] - q).sum() if signed else np.abs(v[m] - q).mean(), q, m) for q in guesses for m in [np.abs(v - q) < 0.1] if m.any()]
        keep = v[min(scores, key=lambda s: s[:2])[2]]
        assert got[g]["n"] == len(keep) and got[g]["mean"] == pytest.approx(keep.mean()) and got[g]["std"] == pytest.approx(keep.std())


def test_ransac_planes(spark):
    rng = np.random.default_rng(7)
    data = [("g", 2.0, float(y), float(z)) for y, z in rng.random((100, 2))] + [("g", float(x), 0.5, 0.5) for x in rng.random(20)]
    p = geometry.ransac_planes(rows(spark, data, "g string, x double, y double, z double"), ["g"]).first()
    assert abs(abs(p["a"]) - 1) < 1e-6


def test_deviations_and_places(spark):
    d = rows(spark, [(60.0, 100.0)], "lat double, far double")
    s = geo.usbl_stds(F.col("far"), 1.0, 0.1, F.col("lat"))
    r = d.select(*[v.alias(k) for k, v in s.items()]).first()
    assert r["northings_std"] == 11.0 and r["longitude_std"] == pytest.approx(2 * r["latitude_std"])
    t = d.select(filters.std_model(F.lit(-2.0), F.lit(9.0), "linear", 1.0, 0.5, signed=False).alias("a"), filters.std_model(F.lit(-2.0), F.lit(9.0), "sensor").alias("b")).first()
    assert tuple(t) == (2.0, 9.0)
    z = d.select(times.named_zone_to_epoch(F.to_timestamp_ntz(F.lit("2020-07-01 12:00:00")), "Europe/London").alias("t")).first()["t"]
    assert z == 1593601200.0


def test_covariances(spark):
    d = rows(spark, [("a", 1.0, [1.0, 2.0]), ("a", 2.0, [3.0, 4.0])], "dive string, t double, covariance array<double>")
    assert [r["covariance"] for r in folds.relative_covariances(d, ["dive"], "t").orderBy("t").collect()] == [[0.0, 0.0], [4.0, 6.0]]
    both = rows(spark, [(1.5, (1.0, [0.0, 2.0]), (2.0, [4.0, 4.0]))], "x double, lo struct<t: double, covariance: array<double>>, hi struct<t: double, covariance: array<double>>")
    assert both.select(interp.blended_covariance(F.col("x"), F.col("lo"), F.col("hi")).alias("c")).first()["c"] == [2.0, 3.0]


def test_edges_and_images(spark, tmp_path):
    c = np.eye(12) * 4.0
    d = rows(spark, [(0, 1.0, 2.0, 3.0, 0.1, 0.2, 0.3, c.ravel().tolist())], "i int, d_northings double, d_eastings double, d_depth double, d_yaw double, d_pitch double, d_roll double, covariance array<double>")
    line = d.withColumn("information", files.information()).select(files.edges(d).alias("line")).first()["line"].split()
    assert line[:3] == ["EDGE3", "0", "1"] and len(line) == 9 + 21 and float(line[9]) == 0.25
    image = rows(spark, [("a.raw", 1, 2, 3, [0.0, 0.5, 1.0, 1.0, 0.0, 0.2])], "image_id string, height int, width int, channels int, data array<float>")
    files.write_images(image, str(tmp_path)).collect()
    assert (tmp_path / "a.ppm").read_bytes() == b"P6\n2 1\n255\n" + bytes([0, 127, 255, 255, 0, 51])
    back = images.decoded(spark.read.format("binaryFile").load(str(tmp_path / "a.ppm")), "pnm").first()
    assert (back["height"], back["width"], back["channels"]) == (1, 2, 3)


def test_point_clouds_and_pose_lists(spark, tmp_path):
    d = rows(spark, [(i, float(i), 0.5, -1.0) for i in range(3)], "k int, x double, y double, z double")
    files.ply_lines(d, "k").coalesce(1).sortWithinPartitions("place").select("line").write.text(str(tmp_path / "c.ply"))
    assert [(r["x"], r["y"], r["z"]) for r in tables.ply(spark, str(tmp_path / "c.ply")).orderBy("seq").collect()] == [(0.0, 0.5, -1.0), (1.0, 0.5, -1.0), (2.0, 0.5, -1.0)]
    p = rows(spark, [("d", 5.0, 1.0, "b.tif"), ("d", 4.0, 2.0, "a.tif")], "dive string, t double, northings double, path string")
    assert [tuple(r) for r in files.pose_list(p).orderBy("image_number").collect()] == [(0, 2.0, 4.0, "a.tif"), (1, 1.0, 5.0, "b.tif")]


def test_camera_times_by_index(spark):
    stamps = rows(spark, [("7", "20200201", "1", "5")], "index string, date string, time string, ms string")
    t = tables.camera_times(stamps, {"index": "iiiiiii", "date": "YYYYMMDD", "time": "hhmmss", "ms": "fff"})
    files_ = rows(spark, [("/a/x0000007.raw",), ("/a/x0000008.raw",)], "path string")
    assert [(r["path"], r["t"]) for r in images.by_index(files_, t).collect()] == [("/a/x0000007.raw", 1580515201.005)]


def test_position_sentences(spark):
    line = "01/02/2020 00:00:01\t$GPGGA,000001.500,5030.0,N,00115.0,W,1,8,1.0,-12.5,M,0,M,,0007*00"
    r = logs.noc_nmea(lines_of(spark, {"f": [line, line.replace("0007", "0008")]}), 7).collect()
    assert [(x["t"], x["latitude"], x["longitude"], x["depth"]) for x in r] == [(1580515201.5, 50.5, -1.25, 12.5)]
