import json

import pytest
from pyspark.sql import functions as F

from fathomline.sources import interchange, logs, tables
from fathomline.sources.lines import lines_of, read_lines


def sentence(body):
    x = 0
    for c in body[1:]:
        x ^= ord(c)
    return f"{body}*{x:02X}"


def test_phins(spark):
    ls = [sentence("$PIXSE,TIME__,083015.023"), sentence("$HEHDT,90.0,T"), sentence("$PIXSE,STDHRP,0.1,0.2,0.3"), sentence("$PIXSE,ATITUD,1.0,2.0"), sentence("$PIXSE,LOGIN_,0.2,0.03,0.1,0,083015.500"), "$PIXSE,DEPIN_,5,083015*00", sentence("$PIXSE,SPEED_,0.2,0.03,0.1")]
    s = logs.phins(lines_of(spark, {"/x/20181119.log": ls}), tz_hours=10.0, offset_s=1.0).cache()
    v = s.filter(F.col("x_velocity").isNotNull()).first()
    assert (v["x_velocity"], v["y_velocity"], v["z_velocity"]) == (0.2, -0.03, -0.1) and v["t"] == pytest.approx(1542580216.023)
    assert s.filter(F.col("depth").isNotNull()).count() == 0  # wrong checksum
    e = s.filter(F.col("east_velocity").isNotNull()).first()
    assert (e["east_velocity"], e["north_velocity"], e["down_velocity"]) == (0.2, 0.03, -0.1)
    o = logs.phins_orientation(s).first()
    assert (o["roll"], o["pitch"], o["yaw"]) == (-1.0, -2.0, 90.0)


def test_rdi(spark):
    ls = [":SA,1,2,3", ":TS,18081115372950,35,5,0,1500,0", ":SA, 1.0, 2.0, 3.0", ":BI,100,200,300,5,A", ":BD,0,0,0,7.5,0", ":TS,18081115373050,35,5,0,1500,0", ":BI,100,200,300,5,V", ":BD,0,0,0,9.5,0"]
    got = logs.rdi(lines_of(spark, {"f": ls})).orderBy("ensemble").collect()
    assert len(got) == 2 and got[0]["t"] == pytest.approx(1534001849.5)
    assert (got[0]["x_velocity"], got[0]["altitude"], got[0]["pitch"]) == (pytest.approx(0.1), 7.5, 1.0)
    assert got[1]["x_velocity"] is None and got[1]["altitude"] is None


def test_tides(spark):
    head = ["h"] * 6
    t = logs.tide_polpred(lines_of(spark, {"f": [*head, " 6/ 9/2019  00:00       0.74      0.14       51"]}), factor=0.1).first()
    assert t["height"] == 0.74 and t["t"] == 1567728000.0
    t = logs.tide_cti(lines_of(spark, {"f": [*head, "2022-07-09T00:15:00Z,1.13467,0.16603,78"]})).first()
    assert t["height"] == 1.13467 and t["t"] == 1657325700.0


def test_mrt_and_dump(spark):
    ls = ["HeadingObs,1,2, 3,4"] + ["skip"] * 35 + ["DepthObs,a,b, c,d", "other,1"]
    got = [tuple(r) for r in logs.mrt(lines_of(spark, {"f": ls})).select("type", "values").orderBy("type").collect()]
    assert got == [("DepthObs", ["a", "b, c", "d"]), ("HeadingObs", ["1", "2, 3", "4"])]
    more = ["Event," + ",".join("abcdef") + ",2020-01-01 00:00:01.5,,7,kind,text, with comma", "Alarm,x", "JobData,x", "Time,a,b,c,d", "DepthObs," + ",".join(str(i) for i in range(1500))]
    r = logs.mrt(lines_of(spark, {"f": ["skip"] * 36 + more})).cache()
    assert {x["type"] for x in r.collect()} == {"Event", "Alarm", "Time", "DepthObs"}
    assert len(r.filter("type = 'DepthObs'").first()["values"]) == 1500
    e = logs.mrt_observations(r, "Event").first()
    assert (e["t"], e["event_type"], e["message"], e["fix_number"]) == (1577836801.5, "kind", "text, with comma", "7")
    d = "2018-11-19,08:30:15,AUV,x,x,x,12-30.0 N,010-15.0 W,d=5.5,l=1,b=2,s=30"
    r = logs.usbl_dump(lines_of(spark, {"f": [d, d.replace("AUV", "SHIP")]}), "AUV", std=(0.1, 1.0)).first()
    assert (r["latitude"], r["longitude"], r["depth"], r["distance_std"]) == (12.5, -10.25, 5.5, 4.0)


def test_mrt_fixes_take_the_next_ship_position(spark):
    base = lambda source, s: f"u,s,{source},p,n,a,2020-01-01 00:00:{s:02d}.000,f,1"
    pos = lambda source, s, lat: f"LatLongObs,{base(source, s)},{lat},10,-5,True,True,True"
    hdg = lambda s, h: f"PitchRollHeadingObs,{base('MRT-USBL', s)},0,0,{h},True,True,True"
    ls = ["skip"] * 36 + [pos("AUV 1", 5, 50.5), pos("AUV 1", 30, 50.6), pos("GNSS 1", 0, 50.0), pos("GNSS 1", 10, 50.1), pos("GNSS 1", 20, 50.2), hdg(4, 1.0), hdg(7, 2.0)]
    got = [tuple(r) for r in logs.mrt_fixes(logs.mrt(lines_of(spark, {"f": ls}))).orderBy("t").select("latitude", "depth", "ship_latitude", "ship_heading").collect()]
    assert got == [(50.5, 5.0, 50.1, 2.0), (50.6, 5.0, 50.2, 2.0)]


def test_gga_dialects(spark):
    fill = lambda n, **at: [at.get(f"f{i}", str(i)) for i in range(n)]
    undated = {"f1": "08:30:15.500", "f5": "5030.0000", "f6": "S", "f7": "00115.0000", "f8": "W"}
    dated = {"f0": "2020/02/03", "f1": "08:30:15.500", "f8": "5030.0000", "f9": "N", "f10": "00115.0000", "f11": "E"}
    rows = {1: fill(11, **undated, f9="7"), 2: fill(21, **dated, f19="7"), 3: fill(22, **dated, f20="7"), 4: fill(19, **undated, f17="7")}
    for k, fields in rows.items():
        text = ",".join(fields)
        other = ",".join("8" if i == logs.GGA[k]["id"] else f for i, f in enumerate(fields))
        got = logs.gga(lines_of(spark, {"/d/20200203_log.txt": [text, other, "bad", text.replace("5030.0000", "x")]}), 7, k).collect()
        sign = -1 if k in (1, 4) else 1
        assert [(r["t"], r["latitude"], r["longitude"]) for r in got] == [(1580718615.5, sign * 50.5, sign * 1.25)], k


def test_poll_times(spark):
    r = logs.poll_times(lines_of(spark, {"f": ["poll_time:,1000,a,b,c,5500,d,3000,e", "other,1,2", "poll_time:,x"]})).collect()
    assert [(x["t"], x["other"]) for x in r] == [(2.0, 5.5)]


def test_eiva(spark):
    p = "P  D  " + "   7" + " 2020:01:01:00:00:01.500 a b -12.5 50.25 -1.5"
    r = logs.eiva_fixes(lines_of(spark, {"f": [p, p.replace("   7", "   8"), "P  D"]}), 7).collect()
    assert [(x["t"], x["latitude"], x["longitude"], x["depth"]) for x in r] == [(1577836801.5, 50.25, -1.5, 12.5)]
    d = "D     7  19  1 2020:01:01:00:00:02.250 33.5 x"
    r = logs.eiva_depths(lines_of(spark, {"f": [d, d.replace("D     7", "D     8")]}), 7, 0.1).collect()
    assert [(x["t"], x["depth"], x["depth_std"]) for x in r] == [(1577836802.25, 33.5, pytest.approx(3.35))]


def test_18_bit_images(spark, tmp_path):
    import numpy as np

    from fathomline.sources import images

    want = [1, 2**18 - 1, 131072, 70000, 5, 6, 7, 8]
    raw = b""
    for k in range(0, len(want), 4):
        straight = b"".join(v.to_bytes(3, "big") for v in want[k : k + 4])
        raw += b"".join(straight[i : i + 4][::-1] for i in (0, 4, 8))
    (tmp_path / "a.raw").write_bytes(raw)
    r = images.decoded(spark.read.format("binaryFile").load(str(tmp_path / "a.raw")), "packed18", 2, 4).first()
    assert (r["height"], r["width"]) == (2, 4) and np.allclose(r["data"], np.array(want) / 2**18)


def test_states_pair_their_own_files(spark):
    poses = spark.createDataFrame([(f, i, f"{f}{i}.tif") for f in ("/a/x.csv", "/a/y.csv") for i in (1, 2)], "file string, seq long, relative_path string")
    cov = spark.createDataFrame([(f, i, float(10 * k + i)) for k, f in enumerate(("/a/x_cov.csv", "/a/y_cov.csv")) for i in (1, 2)], "file string, seq long, cov_x_x double")
    got = {r["relative_path"]: r["cov_x_x"] for r in tables.states(poses, cov).collect()}
    assert got == {"/a/x.csv1.tif": 1.0, "/a/x.csv2.tif": 2.0, "/a/y.csv1.tif": 11.0, "/a/y.csv2.tif": 12.0}


def test_gaps_brackets_the_ship(spark):
    ship = lambda s, lat: f"$PTSAG,#1,0000{s:02d}.000,01,01,2020,0,{lat},N,00100.0000,E,F,0,1,0*00"
    hdt = lambda h: f"$HEHDT,{h},T*00"
    fix = "$PTSAG,#1,000005.000,01,01,2020,3,5000.0000,N,00100.0000,E,F,12.5,1,9*00"
    r = logs.gaps(lines_of(spark, {"f": [ship(0, "5000.0000"), hdt(350), fix, ship(10, "5000.6000"), hdt(10)]}), "3").first()
    assert r["ship_latitude"] == pytest.approx(50 + 0.3 / 60) and r["ship_heading"] in (pytest.approx(0), pytest.approx(360)) and r["depth"] == 12.5


def test_acfr_stereo(spark):
    ls = ["% comment", "ORIGIN_LATITUDE 1", "1141 1.5 50.0 -1.0 1 2 3 0.1 0.2 0.3 l.tif r.tif 2.0 1.0 0", "1142 bad"]
    r = tables.acfr_fields(lines_of(spark, {"f": ls}), stereo=True).collect()
    assert len(r) == 1 and r[0]["id"] == 1141 and r[0]["roll"] == pytest.approx(5.729578) and r[0]["left"] == "l.tif"


def test_csv_logs(spark, tmp_path):
    (tmp_path / "a.csv").write_text("epoch_timestamp,AUV_roll,AUV_pitch,AUV_heading,AUV_depth\n1,0.1,0.2,0.3,5\n1,0.2,0.2,0.3,NaN\n2,NaN,0.2,0.3,6\n3,0.1,0.1,0.1,7\n")
    df = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert [r["roll"] for r in tables.alr(df, "orientation").orderBy("t").collect()] == [pytest.approx(11.459156), pytest.approx(5.729578)]
    assert [r["depth"] for r in tables.alr(df, "depth").orderBy("t").collect()] == [5.0, 6.0, 7.0]
    (tmp_path / "b.csv").write_text("i,stamp,dvl_validBottom,dvl_surgeVelBottom,dvl_swayVelBottom,dvl_heaveVelBottom,Depth\n1,2018/11/19 08:30:15.5,1,100,200,300,1\n2,2018/11/19 08:30:16.5,0,1,1,1,1\n3,2018/11/19 08:30:17.5,1,1,1,1,2\n")
    b = tables.read_csv(spark, str(tmp_path / "b.csv"))
    assert tables.ae2000(b, "velocity").orderBy("t").first()["x_velocity"] == 0.1 and tables.ae2000(b, "velocity").count() == 2
    assert [r["depth"] for r in tables.ae2000(b, "depth").orderBy("t").collect()] == [1.0, 2.0]


def test_interchange(spark, tmp_path):
    recs = [{"epoch_timestamp": 5.0, "frame": "body", "category": "velocity", "epoch_timestamp_dvl": 5.1, "data": [{"x_velocity": 1.0, "x_velocity_std": 0.1}, {"y_velocity": 2.0}, {"z_velocity": 3.0}]},
            {"epoch_timestamp": 6.0, "frame": "body", "category": "image", "camera1": [{"epoch_timestamp": 6.1, "filename": "a.tif"}], "camera2": [{"epoch_timestamp": 6.2, "filename": "b.tif"}]},
            {"epoch_timestamp": 7.0, "frame": "inertial", "category": "usbl", "data_target": [{"latitude": 1.0}, {"longitude": 2.0}, {"northings": 3.0}, {"eastings": 4.0}, {"depth": 5.0}, {"distance_to_ship": ""}]}]
    (tmp_path / "n.json").write_text(json.dumps(recs))
    r = interchange.read(spark, str(tmp_path / "n.json"))
    v = interchange.category(r, "velocity_body").first()
    assert (v["x_velocity"], v["y_velocity"], v["z_velocity"], v["t_dvl"]) == (1.0, 2.0, 3.0, 5.1)
    assert sorted((x["camera"], x["filename"]) for x in interchange.cameras(r).collect()) == [("camera1", "a.tif"), ("camera2", "b.tif")]
    u = interchange.usbl(r).first()
    assert (u["northings"], u["depth"], u["distance_to_ship"]) == (3.0, 5.0, None)


def test_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "l.txt").write_text("\n".join(str(i) for i in range(500)))
    got = [r["line"] for r in read_lines(spark, str(tmp_path / "l.txt"), skip=10).orderBy("seq").collect()]
    assert got == [str(i) for i in range(10, 500)]


def mat_file(fields):
    """A level-5 file with one struct of structs of double vectors, by the published layout."""
    import struct
    import zlib

    def element(kind, body):
        return struct.pack("<II", kind, len(body)) + body + b"\0" * (-len(body) % 8)

    def head(kind, n, name):
        return element(6, struct.pack("<II", kind, 0)) + element(5, struct.pack("<ii", 1, n)) + element(1, name)

    def node(name, content):
        if isinstance(content, dict):
            keys = b"".join(k.encode().ljust(32, b"\0") for k in content)
            return element(14, head(2, 1, name) + struct.pack("<HHi", 5, 4, 32) + element(1, keys) + b"".join(node(b"", v) for v in content.values()))
        return element(14, head(6, len(content), name) + element(9, struct.pack(f"<{len(content)}d", *content)))

    packed = zlib.compress(node(b"missionData", fields))
    return b"x" * 124 + b"\0\1IM" + struct.pack("<II", 15, len(packed)) + packed


def test_autosub(spark, tmp_path):
    from fathomline.sources import matlab, registry

    adcp = {"eTime": [1.0, 2.0, 2.0], "Vnorth0": [10.0, 20.0, 30.0], "Veast0": [1.0] * 3, "Vdown0": [2.0] * 3, "Verr0": [3.0] * 3}
    (tmp_path / "m.mat").write_bytes(mat_file({"ADCPbin00": adcp, "DepCtlNode": {"eTime": [5.0], "DepCtldepth": [7.0]}}))
    v = registry.read(spark, "velocity", "autosub", str(tmp_path / "m.mat")).orderBy("t").collect()
    assert [(r["t"], r["x_velocity"], r["x_velocity_std"]) for r in v] == [(1.0, pytest.approx(-0.01), pytest.approx(0.003)), (2.0, pytest.approx(-0.03), pytest.approx(0.003))]
    d = matlab.autosub(matlab.read(spark, str(tmp_path / "m.mat")), "depth", 0.1).first()
    assert (d["t"], d["depth"], d["depth_std"]) == (5.0, 7.0, pytest.approx(0.7))


def test_hybis(spark, tmp_path):
    from fathomline.sources import rov

    head = "Date , Time, Roll, Pitch, Heading, Pressure, Altitude, Hybis Long, Hybis Lat\n"
    row = "01/02/2020, 00:00:{s:02d}, 1, 2, 90, {d}, 5, 00115.00000W, 5030.00000N\n"
    (tmp_path / "n.csv").write_text(head + row.format(s=0, d=10) + row.format(s=1, d=0) + row.format(s=2, d=0) + row.format(s=4, d=20) + row.format(s=5, d=30).replace("00115.00000W", "x"))
    p = rov.hybis_positions(spark, str(tmp_path / "n.csv")).orderBy("t").collect()
    # the first zero: between 10 before it and 0 after it; the second: between that and 20
    assert [r["depth"] for r in p] == [10.0, 5.0, pytest.approx(5 + 15 / 3), 20.0] and (p[0]["latitude"], p[0]["longitude"]) == (50.5, -1.25)
    images = spark.createDataFrame([("", p[0]["t"] + 3.0, "a.tif")], "dive string, t double, path string")
    got = rov.hybis_poses(images, rov.hybis_positions(spark, str(tmp_path / "n.csv")), 50.5, -1.25).first()
    assert (got["depth"], got["heading"], got["northings"], got["path"]) == (pytest.approx(15.0), 90.0, pytest.approx(0.0, abs=1e-6), "a.tif")


def test_koyo20(spark, tmp_path):
    from fathomline.config import Mount, Vehicle
    from fathomline.sources import rov

    def row(s, depth, lat=50.5, date="20-02-01"):
        c = [""] * 33
        c[2], c[3], c[23], c[24], c[31], c[32] = date, f"00:00:{s:02d}", str(depth), "5", str(lat), "-1.25"
        return ",".join(c)

    (tmp_path / "p.csv").write_text("\n".join([row(0, 1), row(1, 10), row(1, 99), row(2, 20), row(3, 77, 60.0), row(4, 40)]) + "\n")
    (tmp_path / "r.csv").write_text("index,date(YYYYMMDD),time(hhmmss),time_ms(iiii),heading(degrees),pitch(degrees),roll(degrees)\n1,20200201,1,0,0,0,0\n2,20200201,4,0,0,0,0\n,20200201,5,0,9,9,9\n")
    (tmp_path / "i.csv").write_text("index,date,time,ms\n7,20200201,000001,500\n8,20200201,000009,0\n")
    pos, rot, img = rov.koyo20_positions(spark, str(tmp_path / "p.csv")), rov.koyo20_attitudes(spark, str(tmp_path / "r.csv")), rov.koyo20_images(spark, str(tmp_path / "i.csv"))
    assert [r["depth"] for r in pos.orderBy("t").collect()] == [10.0, 20.0, 77.0, 40.0]
    vehicle = Vehicle({"camera1": Mount(1.0, 2.0, 3.0)})
    got = rov.koyo20_poses(img, pos, rot, vehicle, "camera1", 50.5, -1.25).collect()
    assert [(r["index"], round(r["depth"], 6), round(r["altitude"], 6), round(r["northings"], 4), round(r["eastings"], 4)) for r in got] == [(7, 18.0, 2.0, 1.0, 2.0)]


def test_image_listings(spark):
    from fathomline.sources import images

    files = spark.createDataFrame([("/d/image0000007.raw",), ("/d/image0000009.raw",)], "path string")
    stamps = spark.createDataFrame([("0000007", "20200201", "000001", "500"), ("0000008", "20200201", "000002", "0")], "index string, date string, time string, ms string")
    assert [(r["path"], r["t"]) for r in images.seaxerocks(files, stamps, offset_s=1.0).collect()] == [("/d/image0000007.raw", 1580515202.5)]
    pairs = spark.createDataFrame([("1.5", "a.jpg", "b.jpg"), ("2.5", "a.jpg", "none.jpg")], "epoch string, file_left string, file_right string")
    one = lambda n: spark.createDataFrame([(f"/x/{n}",)], "path string")
    assert [tuple(r) for r in images.gopro_pairs(pairs, one("a.jpg"), one("b.jpg")).collect()] == [(1.5, "a.jpg", "b.jpg")]
    stills = spark.createDataFrame([("/s/ESC_stills_xxx_PPS_20200201T000001.tif",), ("/s/ESC_stills_xxx_SYS_20200201T000002.tif",)], "path string")
    fmt = "x" * 19 + "YYYYMMDDxhhmmss"
    assert [r["t"] for r in images.voyis(stills, fmt, fmt).orderBy("t").collect()] == [1580515201.0, 1580515202.0]
