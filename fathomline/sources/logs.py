"""Instrument logs to measurement tables: (file, seq, t, ...) with degrees, metres and metres a second.

Each reader takes ordered lines (``lines.read_lines``). What the reference does as a state machine over lines is a window here:
a time that holds for all that follows is a forward fill, a message of several lines is a numbered run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.functions import geo, times
from fathomline.functions.frames import mount_yaw, wrap_360
from fathomline.functions.text import fixed, plain_number, sentence_ok
from fathomline.operators.interp import brackets, linear, next_observation
from fathomline.operators.windows import forward_filled
from fathomline.sources.lines import name_of, num, part

#: Sentence headers of the inertial unit.
PHINS = {"time": "TIME__", "heading": "$HEHDT", "attitude": "ATITUD", "attitude_std": "STDHRP", "dvl": "LOGIN_", "speed": "SPEED_", "speed_std": "STDSPD", "depth": "DEPIN_", "altitude": "LOGDVL"}


def day_of(file: str = "file") -> Column:
    """Epoch of the day that a file's name starts with (yyyymmdd)."""
    n = name_of(file)
    return times.epoch_from_parts(F.substring(n, 1, 4).try_cast("int"), F.substring(n, 5, 2).try_cast("int"), F.substring(n, 7, 2).try_cast("int"), 0, 0, 0)


def phins(lines: DataFrame, tz_hours: float = 0.0, offset_s: float = 0.0, heading_offset: float = 0.0, std: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Sentences with a right checksum, each with the time of the last time sentence before it and the values it brings."""
    ok = lines.filter(F.col("line").rlike(r"^\s*\$(PIXSE|HEHDT),") & sentence_ok(F.col("line")))
    body = F.regexp_replace(F.trim("line"), r"\*.*$", "")
    s = ok.select("file", "seq", body.alias("s")).withColumn("tag", F.when(part("s", 0) == PHINS["heading"], PHINS["heading"]).otherwise(part("s", 1)))
    clock = lambda text: times.clock_of_day(text, day_of(), offset_s, tz_hours)
    is_ = lambda k: F.col("tag") == PHINS[k]
    x, y, z = mount_yaw((num("s", 2), num("s", 3), num("s", 4)), heading_offset)
    factor, offset = std
    size = lambda v: F.abs(v) * factor + offset
    out = s.select(
        "file", "seq", "tag", F.when(is_("time"), clock(part("s", 2))).alias("t"),
        F.when(is_("heading"), num("s", 1)).alias("heading"),
        F.when(is_("attitude"), -num("s", 2)).alias("roll"), F.when(is_("attitude"), -num("s", 3)).alias("pitch"),
        F.when(is_("attitude_std"), num("s", 2)).alias("yaw_std"), F.when(is_("attitude_std"), num("s", 3)).alias("roll_std"), F.when(is_("attitude_std"), num("s", 4)).alias("pitch_std"),
        F.when(is_("dvl"), x).alias("x_velocity"), F.when(is_("dvl"), -y).alias("y_velocity"), F.when(is_("dvl"), -z).alias("z_velocity"),
        F.when(is_("dvl"), size(x)).alias("x_velocity_std"), F.when(is_("dvl"), size(y)).alias("y_velocity_std"), F.when(is_("dvl"), size(z)).alias("z_velocity_std"),
        F.when(is_("dvl"), clock(part("s", 6))).alias("t_dvl"),
        F.when(is_("speed"), num("s", 2)).alias("east_velocity"), F.when(is_("speed"), num("s", 3)).alias("north_velocity"), F.when(is_("speed"), -num("s", 4)).alias("down_velocity"),
        F.when(is_("depth"), num("s", 2)).alias("depth"), F.when(is_("depth"), clock(part("s", 3))).alias("t_depth"),
        F.when(is_("altitude"), num("s", 4)).alias("altitude"), F.when(is_("altitude"), num("s", 2)).alias("sound_velocity"), F.when(is_("altitude"), num("s", 3)).alias("sound_velocity_correction"),
    )
    return forward_filled(out, ["file"], ["seq"], ["t"])


def phins_speed(token: Column) -> tuple[Column, Column, Column]:
    """East, north, down from the three numbers of a speed sentence (up is positive there)."""
    return num(token, 2), num(token, 3), -num(token, 4)


def phins_orientation(sentences: DataFrame, heading_offset: float = 0.0) -> DataFrame:
    """Orientation at each attitude sentence, with the last heading and deviations before it."""
    f = forward_filled(sentences, ["file"], ["seq"], ["heading", "roll_std", "pitch_std", "yaw_std"])
    a = f.filter(F.col("roll").isNotNull() & F.col("heading").isNotNull() & F.col("t").isNotNull() & F.col("roll_std").isNotNull())
    r, p, y = mount_yaw((F.col("roll"), F.col("pitch"), F.col("heading")), heading_offset)
    return a.select("file", "seq", "t", r.alias("roll"), p.alias("pitch"), wrap_360(y).alias("yaw"), "roll_std", "pitch_std", "yaw_std")


def rdi(lines: DataFrame, offset_s: float = 0.0, yaw: float = 0.0, altitude_factor: float = 0.0, century: str = "20", parity: bool = False) -> DataFrame:
    """Ensembles: a time line opens one; attitude, velocity (status A) and range (only with a velocity) lines fill it.

    parity: attitudes in radians and the mounting yaw read as radians, as the reference has them."""
    tag = part("line", 0)
    s = lines.filter(tag.isin(":TS", ":SA", ":BI", ":BD")).withColumn("tag", tag).withColumn("n", F.size(F.split("line", ",", -1)))
    s = s.filter(((F.col("tag") == ":TS") & (F.col("n") == 7)) | ((F.col("tag") == ":SA") & (F.col("n") == 4)) | (F.col("tag").isin(":BI", ":BD") & (F.col("n") == 6)))
    s = s.withColumn("ensemble", F.sum((F.col("tag") == ":TS").cast("int")).over(W.partitionBy("file").orderBy("seq").rowsBetween(W.unboundedPreceding, 0))).filter("ensemble > 0")
    d = part("line", 1)
    two = lambda a: F.substring(d, a, 2).try_cast("int")
    stamp = times.epoch_from_parts(F.concat(F.lit(century), F.substring(d, 1, 2)).try_cast("int"), two(3), two(5), two(7), two(9), two(11)) + two(13) / 100 + offset_s
    of = lambda k, v: F.max(F.when(F.col("tag") == k, v))
    lock = (F.col("tag") == ":BI") & (F.trim(part("line", 5)) == "A")
    turn = (lambda v: F.radians(v)) if parity else (lambda v: v)
    c, sn = F.cos(F.lit(yaw) if parity else F.radians(F.lit(yaw))), F.sin(F.lit(yaw) if parity else F.radians(F.lit(yaw)))
    e = s.groupBy("file", "ensemble").agg(
        of(":TS", stamp).alias("t"), of(":TS", num("line", 5)).alias("sound_velocity"),
        turn(of(":SA", num("line", 1))).alias("pitch"), turn(of(":SA", num("line", 2))).alias("roll"), turn(of(":SA", num("line", 3))).alias("yaw"),
        F.max(F.when(lock, num("line", 1))).alias("_x"), F.max(F.when(lock, num("line", 2))).alias("_y"), F.max(F.when(lock, num("line", 3))).alias("_z"), F.max(F.when(lock, num("line", 4))).alias("_e"),
        of(":BD", num("line", 4)).alias("_a"))
    x, y = F.col("_x") * 0.001, F.col("_y") * 0.001
    alt = F.when(F.col("_x").isNotNull(), F.col("_a"))
    return e.select("file", "ensemble", "t", F.col("t").alias("t_dvl"), "roll", "pitch", "yaw", (x * c - y * sn).alias("x_velocity"), (x * sn + y * c).alias("y_velocity"), (F.col("_z") * 0.001).alias("z_velocity"),
                    *[(F.col("_e") * 0.001).alias(f"{k}_velocity_std") for k in "xyz"], alt.alias("altitude"), (alt * altitude_factor).alias("altitude_std"), "sound_velocity")


def gaps(lines: DataFrame, beacon: str, tz_hours: float = 0.0, offset_s: float = 0.0) -> DataFrame:
    """Fixes of a beacon with the ship's position and heading at their time, interpolated between the ship's own fixes around them."""
    body = F.regexp_replace(F.trim("line"), r"\*.*$", "")
    s = lines.select("file", "seq", body.alias("s")).withColumn("tag", part("s", 0))
    two = lambda a: F.substring(part("s", 2), a, 2).try_cast("int")
    stamp = times.epoch_from_parts(part("s", 5).try_cast("int"), part("s", 4).try_cast("int"), part("s", 3).try_cast("int"), two(1), two(3), two(5), tz_hours) + F.substring(part("s", 2), 8, 3).try_cast("int") / 1000 + offset_s
    fine = (two(5) < 60) & (two(3) < 60) & (two(1) < 24)
    deg = lambda i, n: F.when(part("s", i + 1).isin("S", "W"), -1).otherwise(1) * (F.substring(part("s", i), 1, n).try_cast("double") + F.substring(part("s", i), n + 1, 8).try_cast("double") / 60)
    fixes = s.filter(F.col("tag").contains("PTSAG") & fine).select("file", "seq", stamp.alias("t"), part("s", 6).alias("id"), deg(7, 2).alias("latitude"), deg(9, 3).alias("longitude"), num("s", 12).alias("depth"), part("s", 11).alias("state"), part("s", 13).alias("valid"))
    heading = s.filter(F.col("tag").contains("HDT")).select("file", "seq", num("s", 1).alias("heading"))
    ship = fixes.filter("id = '0'").select("file", "seq", "t", F.col("latitude").alias("ship_latitude"), F.col("longitude").alias("ship_longitude"))
    w = W.partitionBy("file").orderBy(F.col("seq").desc()).rowsBetween(W.unboundedPreceding, 0)
    # a ship fix's heading is the next heading line
    both = ship.unionByName(heading, allowMissingColumns=True).withColumn("heading", F.last("heading", ignorenulls=True).over(w)).filter(F.col("t").isNotNull() & F.col("heading").isNotNull())
    target = fixes.filter((F.col("id") == str(beacon)) & (F.col("state") == "F") & (F.col("valid") == "1"))
    b = brackets(target, both, ["file"], "t", ["ship_latitude", "ship_longitude", "heading"], extrapolate=False).filter(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    at = lambda c: linear(F.col("t"), F.col("lo.t"), F.col("hi.t"), F.col(f"lo.{c}"), F.col(f"hi.{c}"))
    from fathomline.functions.frames import yaw_between

    turn = yaw_between(F.col("t"), F.col("lo.t"), F.col("hi.t"), F.col("lo.heading"), F.col("hi.heading"))
    return b.select("file", "seq", "t", "latitude", "longitude", "depth", at("ship_latitude").alias("ship_latitude"), at("ship_longitude").alias("ship_longitude"), turn.alias("ship_heading"))


def usbl_dump(lines: DataFrame, label: str, tz_hours: float = 0.0, offset_s: float = 0.0, std: tuple[float, float] = (0.0, 0.0), parity: bool = False) -> DataFrame:
    """Fixes of a label: ``date,time,label,...,dd-mm.mm N,...`` with ``name=value`` fields."""
    value = lambda i: F.regexp_extract(part("line", i), r"=\s*(-?[0-9.]+)", 1).try_cast("double")
    when = F.concat_ws(" ", part("line", 0), part("line", 1))
    s = lines.filter((part("line", 2) == label) & (F.coalesce(part("line", 6), F.lit("")) != ""))
    factor, offset = std
    return s.select("file", "seq", (times.string_to_epoch(when, "yyyy-MM-dd HH:mm:ss", tz_hours) + offset_s).alias("t"), geo.degrees_from_dashed(part("line", 6), parity).alias("latitude"), geo.degrees_from_dashed(part("line", 7), parity).alias("longitude"),
                    value(8).alias("depth"), value(9).alias("lateral_distance"), value(10).alias("bearing"), value(11).alias("distance_to_ship"), (value(11) * factor + offset).alias("distance_std"))


def noc_nmea(lines: DataFrame, beacon: int, tz_hours: float = 0.0, offset_s: float = 0.0) -> DataFrame:
    """Fixes of a beacon (reference station of a GGA sentence) in a tab-separated log that starts with dd/mm/yyyy."""
    g = part("line", 1, "\t")
    two = lambda a: F.substring(part(g, 1), a, 2).try_cast("int")
    d = lambda a, n: F.substring("line", a, n).try_cast("int")
    deg = lambda i, n: F.when(part(g, i + 1).isin("S", "W"), -1).otherwise(1) * (F.substring(part(g, i), 1, n).try_cast("double") + F.substring(part(g, i), n + 1, 12).try_cast("double") / 60)
    t = times.epoch_from_parts(d(7, 4), d(4, 2), d(1, 2), two(1), two(3), two(5), tz_hours) + F.coalesce(F.substring(part(g, 1), 8, 3).try_cast("double"), F.lit(0.0)) / 1000 + offset_s
    station = F.regexp_extract(part(g, 14), r"^(\d+)", 1).try_cast("int")
    return lines.filter(station == beacon).select("file", "seq", t.alias("t"), deg(2, 2).alias("latitude"), deg(4, 3).alias("longitude"), (-num(g, 9)).alias("depth"))


def tide_polpred(lines: DataFrame, tz_hours: float = 0.0, offset_s: float = 0.0, factor: float = 0.0) -> DataFrame:
    """Fixed-width tides: ``dd/mm/yyyy  HH:MM  level``; the first six lines are a header."""
    n = lambda a, k: fixed(F.col("line"), a, k).try_cast("int")
    h = plain_number(fixed(F.col("line"), 23, 6))
    t = times.epoch_from_parts(n(7, 4), n(4, 2), n(1, 2), n(13, 2), n(16, 2), 0, tz_hours) + offset_s
    return lines.filter((F.col("seq") > 6) & h.isNotNull()).select("file", "seq", t.alias("t"), h.alias("height"), (h * factor).alias("height_std"))


def tide_cti(lines: DataFrame, tz_hours: float = 0.0, offset_s: float = 0.0, factor: float = 0.0) -> DataFrame:
    """Comma-separated tides with ISO times; the first six lines are a header."""
    h = num("line", 1)
    t = times.string_to_epoch(F.substring("line", 1, 19), "yyyy-MM-dd'T'HH:mm:ss", tz_hours) + offset_s
    return lines.filter((F.col("seq") > 6) & h.isNotNull()).select("file", "seq", t.alias("t"), h.alias("height"), (h * factor).alias("height_std"))


def eiva_attitude(lines: DataFrame, heading_offset: float = 0.0) -> DataFrame:
    """Roll, pitch, heading from $PRDID sentences of R132 lines."""
    s = lines.filter(F.col("line").startswith("R132  4") & F.col("line").contains("$PRDID"))
    p = lambda i: F.get(F.split("line", r"\s+"), F.lit(i))
    v = lambda i: F.regexp_replace(part(p(3), i), r"\*.*$", "").try_cast("double")
    r, pt, y = mount_yaw((v(2), v(1), v(3)), heading_offset)
    return s.select("file", "seq", times.string_to_epoch(p(2), "yyyy:MM:dd:HH:mm:ss[.SSSSSS][.SSS]").alias("t"), r.alias("roll"), pt.alias("pitch"), wrap_360(y).alias("yaw")).filter(F.col("roll").isNotNull())


def _navipac(i: int) -> Column:
    """i-th field between blanks."""
    return F.get(F.split(F.trim("line"), r"\s+"), F.lit(i))


def _navipac_time(i: int) -> Column:
    return times.string_to_epoch(_navipac(i), "yyyy:MM:dd:HH:mm:ss[.SSSSSS][.SSS]")


def eiva_fixes(lines: DataFrame, beacon: int) -> DataFrame:
    """Fixes of a beacon from its position lines; heights become depths."""
    ours = lines.filter(F.col("line").startswith("P  D") & (F.trim(F.substring("line", 7, 4)).try_cast("int") == beacon))
    n = lambda i: _navipac(i).try_cast("double")
    out = ours.select("file", "seq", _navipac_time(3).alias("t"), n(7).alias("latitude"), n(8).alias("longitude"), (-n(6)).alias("depth"))
    return out.filter(F.col("t").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def eiva_depths(lines: DataFrame, beacon: int, factor: float = 0.0) -> DataFrame:
    """Depths of a beacon from its depth lines."""
    head = f"D     {beacon}  19  1"
    ours = lines.filter(F.substring("line", 1, 14) == head)
    d = _navipac(5).try_cast("double")
    out = ours.select("file", "seq", _navipac_time(4).alias("t"), d.alias("depth"), (d * factor).alias("depth_std"))
    return out.withColumn("t_depth", F.col("t")).filter(F.col("t").isNotNull() & F.col("depth").isNotNull())


#: The fields that all records of an observation log have after their type, and each type's own after those.
MRT_BASE = ["obs_uid", "source_uid", "source_name", "parent_uid", "parent_name", "assoc_uid", "time_stamp", "filter_uid", "fix_number"]
MRT_TYPES = {
    "AccelerationObs": ["x_acceleration", "y_acceleration", "z_acceleration", "x_valid", "y_valid", "z_valid"],
    "PitchRollObs": ["pitch", "roll", "pitch_valid", "roll_valid"],
    "PitchRollHeadingObs": ["pitch", "roll", "heading", "pitch_valid", "roll_valid", "heading_valid"],
    "DisplacementObs": ["surge", "heave", "sway", "surge_valid", "heave_valid", "sway_valid"],
    "DepthObs": ["depth", "valid"],
    "HeadingObs": ["heading", "valid"],
    "GPSLatLongObs": ["latitude", "longitude", "altitude", "latitude_valid", "longitude_valid", "altitude_valid", "quality", "hdop", "satellites", "utc_time", "geoidal_separation"],
    "LatLongObs": ["latitude", "longitude", "altitude", "latitude_valid", "longitude_valid", "altitude_valid"],
    "GridPositionObs": ["x", "y", "z", "valid_x", "valid_y", "valid_z", "horizontal_position_sd", "vertical_position_sd", "utm_zone"],
    "USBLVectorObs": ["jx", "jy", "jz", "valid_jx", "valid_jy", "valid_jz", "frequency", "qj_sum", "n_good_samples", "direction_sd"],
    "USBLRangeObs": [],
    "VelocityObs": ["velocity_x", "velocity_y", "velocity_z", "validity_x", "validity_y", "validity_z"],
    "Event": ["event_type", "message"],
    "EstimateTrackerMetrics": ["estimate_type", "estimate_uid", "filter_uid2", "weight", "predicted", "mde", "w_test"],
    "Time": [],
    "Alarm": ["type_id", "severity", "state", "summary", "description", "url", "origin", "category"],
    "AlarmStateChange": ["alarm_uid", "alarm_type_id", "severity", "prev_state", "new_state", "owner", "purged"],
}
#: Fields that are text; those with "valid" in their names are flags, all others numbers.
MRT_TEXT = {"utm_zone", "event_type", "message", "estimate_type", "estimate_uid", "filter_uid2", "type_id", "severity", "state", "summary", "description", "url", "origin", "category", "alarm_uid", "alarm_type_id", "prev_state", "new_state", "owner", "purged"}


def mrt(lines: DataFrame) -> DataFrame:
    """Records of the known types: type and values. A field that starts with a space belongs to the one before; lines 2 to 36 are a header."""
    v = F.split(F.rtrim("line"), ",(?! )", -1)
    return lines.filter((F.col("seq") == 1) | (F.col("seq") > 36)).select("file", "seq", F.get(v, F.lit(0)).alias("type"), F.slice(v, F.lit(2), F.size(v)).alias("values")).filter(F.col("type").isin(list(MRT_TYPES)))


def mrt_observations(records: DataFrame, kind: str) -> DataFrame:
    """Records of one type with typed columns: those that all have, t, and the type's own."""
    at = lambda i: F.get("values", F.lit(i))

    def own(i: int, name: str) -> Column:
        v = at(len(MRT_BASE) + i)
        if name in MRT_TEXT:
            return v.alias(name)
        return (F.lower(F.trim(v)).isin("true", "1") if "valid" in name else F.trim(v).try_cast("double")).alias(name)

    stamp = times.string_to_epoch(at(MRT_BASE.index("time_stamp")), "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]")
    return records.filter(F.col("type") == kind).select("file", "seq", *[at(i).alias(n) for i, n in enumerate(MRT_BASE)], stamp.alias("t"), *[own(i, n) for i, n in enumerate(MRT_TYPES[kind])])


def mrt_fixes(records: DataFrame, target: str = "AUV 1", ship: str = "GNSS 1", compass: str = "MRT-USBL", offset_s: float = 0.0, by: str = "dive") -> DataFrame:
    """Fixes of the target with the ship's position and heading, each the first at or after the fix (past the end, the last).

    All files of ``records`` are one log unless they have a column ``by``."""
    rows = records if by in records.columns else records.withColumn(by, F.lit(""))
    grouped = lambda kind: mrt_observations(rows, kind).join(rows.select("file", "seq", by), ["file", "seq"])
    at = grouped("LatLongObs")
    fixes = at.filter(F.col("source_name") == target).select(by, "file", "seq", "t", "latitude", "longitude", (-F.col("altitude")).alias("depth"))
    ships = at.filter(F.col("source_name") == ship).select(by, "t", F.col("latitude").alias("ship_latitude"), F.col("longitude").alias("ship_longitude"))
    headings = grouped("PitchRollHeadingObs").filter(F.col("source_name") == compass).select(by, "t", F.col("heading").alias("ship_heading"))
    near = next_observation(fixes.filter("t IS NOT NULL"), ships.filter("t IS NOT NULL"), [by], "t", ["ship_latitude", "ship_longitude"]).drop("sample_t")
    out = next_observation(near, headings.filter("t IS NOT NULL"), [by], "t", ["ship_heading"]).drop("sample_t")
    return out.filter(F.col("ship_latitude").isNotNull() & F.col("ship_heading").isNotNull()).withColumn("t", F.col("t") + offset_s)


#: Places of beacon, latitude and longitude in the four dialects of GGA logs (hemispheres follow their values);
#: "dated" logs have their date in field 0 and their time in field 1, the others only the time in field 1.
GGA = {1: {"id": 9, "lat": 5, "lon": 7, "dated": 0}, 2: {"id": 19, "lat": 8, "lon": 10, "dated": 1}, 3: {"id": 20, "lat": 8, "lon": 10, "dated": 1}, 4: {"id": 17, "lat": 5, "lon": 7, "dated": 0}}


def gga(lines: DataFrame, beacon: int, dialect: int = 1, places: dict[str, int] | None = None) -> DataFrame:
    """Fixes of a beacon; undated logs have the day in the file's name; rows that don't parse are left out."""
    at = places or GGA[dialect]
    f = lambda i: F.get(F.split("line", r"[, *]", -1), F.lit(i))
    # hemispheres other than S and W count as N and E
    deg = lambda i, n, minus: F.when(f(i + 1) == minus, -1).otherwise(1) * (F.substring(f(i), 1, n).try_cast("double") + F.substring(f(i), n + 1, 20).try_cast("double") / 60)
    if at.get("dated"):
        n = lambda i, a, k: F.substring(f(i), a, k).try_cast("int")
        fraction = F.concat(F.lit("0."), F.substring(f(1), 10, 6)).try_cast("double")
        t = times.epoch_from_parts(n(0, 1, 4), n(0, 6, 2), n(0, 9, 2), n(1, 1, 2), n(1, 4, 2), n(1, 7, 2)) + F.coalesce(fraction, F.lit(0.0))
    else:
        t = times.clock_of_day(F.regexp_replace(f(1), ":", ""), day_of())
    out = lines.filter(f(at["id"]).try_cast("int") == beacon).select("file", "seq", t.alias("t"), deg(at["lat"], 2, "S").alias("latitude"), deg(at["lon"], 3, "W").alias("longitude"))
    fixed = {"latitude_std": 1e-4, "longitude_std": 1e-4, "northings_std": 5.0, "eastings_std": 5.0, "depth": 0.0}
    return out.filter(F.col("t").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select("*", *[F.lit(v).alias(k) for k, v in fixed.items()])


def poll_times(lines: DataFrame) -> DataFrame:
    """Pairs of clocks from ``poll_time:`` lines, in seconds: t is the mean of the camera's clock before and after the vehicle's answer, ``other`` the vehicle's."""
    ms = lambda i: num("line", i) / 1000
    rows = lines.filter(F.col("line").contains("poll_time:")).select("file", "seq", ((ms(1) + ms(7)) / 2).alias("t"), ms(5).alias("other"), ms(1).alias("asked"), ms(7).alias("answered"))
    return rows.filter(F.col("t").isNotNull() & F.col("other").isNotNull())
