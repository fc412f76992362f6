"""The navigation job: sensors of many dives in, geo-referenced poses out.

One lazy plan. Sensors meet by bracket joins on (dive, time); everything up to the dead-reckoned track is an expression or
a window partitioned by dive. Only the folds (Kalman and particle filters) and the geodesics leave the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.config import NavConfig, Vehicle
from fathomline.functions import frames, geo
from fathomline.operators import aggregates, filters, folds, interp, windows

BY = ["dive"]
T = "t"


@dataclass
class Sensors:
    """Tables with ``dive`` and ``t``: velocity (x, y, z and deviations, t_dvl), orientation, depth, altitude, usbl, cameras."""

    velocity: DataFrame
    orientation: DataFrame
    depth: DataFrame
    altitude: DataFrame
    usbl: DataFrame | None = None


def seafloor(s: Sensors) -> DataFrame:
    """Altitudes with the depth of the seafloor; before the first depth, the next value."""
    at = interp.interpolated(s.altitude, s.depth.select(*BY, T, "depth"), BY, T, ["depth"], extrapolate=False)
    floor = at.withColumn("seafloor_depth", F.col("depth") + F.col("altitude")).drop("depth")
    return windows.back_filled(floor, BY, [T], ["seafloor_depth"])


def filtered_usbl(s: Sensors, c: NavConfig) -> DataFrame:
    """Fixes while depths are measured, whose depth agrees, and which are continuous."""
    u = filters.during(s.usbl, s.depth, BY, T)
    u = filters.depth_gate(u, s.depth.select(*BY, T, "depth", "depth_std"), BY, T, c.usbl_sigma)
    return windows.continuous_fixes(u, BY, T, "northings", "eastings", "northings_std", "eastings_std", c.usbl_sigma, c.usbl_max_speed)


def dead_reckoning(s: Sensors, vehicle: Vehicle = Vehicle(), c: NavConfig = NavConfig()) -> DataFrame:
    """Poses at each orientation sample: speeds are interpolated, corrected for the instrument's arm, turned and integrated."""
    cols = ["x_velocity", "y_velocity", "z_velocity", "x_velocity_std", "y_velocity_std", "z_velocity_std"]
    o = filters.time_range(s.orientation, BY, T, c.start, c.finish)
    rated = windows.angular_rates(o, BY, T, ["roll", "pitch", "yaw"])
    v = interp.forward_interpolated(rated, s.velocity.select(*BY, T, *cols), BY, T, cols)
    arm = tuple(d - x for d, x in zip(vehicle.arm("dvl"), vehicle.arm("origin"), strict=True))
    rates = tuple(F.radians(f"{a}_rate") for a in ("roll", "pitch", "yaw"))
    speeds = frames.lever_arm((F.col("x_velocity"), F.col("y_velocity"), F.col("z_velocity")), rates, tuple(-a for a in arm))
    n, e, d = frames.body_to_inertial("roll", "pitch", "yaw", *speeds)
    ns, es, ds = frames.body_to_inertial("roll", "pitch", "yaw", "x_velocity_std", "y_velocity_std", "z_velocity_std")
    inertial = v.select(*v.columns, n.alias("north_velocity"), e.alias("east_velocity"), d.alias("down_velocity"), F.abs(ns).alias("north_velocity_std"), F.abs(es).alias("east_velocity_std"), F.abs(ds).alias("down_velocity_std"))
    deep = interp.interpolated(inertial, s.depth.select(*BY, T, "depth"), BY, T, ["depth"])
    high = interp.interpolated(deep, s.altitude.select(*BY, T, "altitude"), BY, T, ["altitude"])
    return windows.dead_reckoned(high, BY, T, {"north_velocity": "northings", "east_velocity": "eastings"})


def anchored(track: DataFrame, fixes: DataFrame | None, latitude: float, longitude: float) -> DataFrame:
    """The track moved by its mean offset to the fixes (one small row a dive), with latitudes and longitudes."""
    if fixes is not None:
        offset = aggregates.mean_offset(track.select(*BY, T, "northings", "eastings"), fixes.select(*BY, T, "northings", "eastings"), BY, T).select(*BY, "north_offset", "east_offset")
        moved = track.join(offset, BY, "left")
        track = moved.withColumn("northings", F.col("northings") + F.coalesce("north_offset", F.lit(0.0))).withColumn("eastings", F.col("eastings") + F.coalesce("east_offset", F.lit(0.0))).drop("north_offset", "east_offset")
    return track.withColumn("_p", geo.metres_to_latlon(latitude, longitude, F.col("eastings"), F.col("northings"))).select(*track.columns, "_p.latitude", "_p.longitude")


def camera_poses(cameras: DataFrame, track: DataFrame, vehicle: Vehicle = Vehicle(), camera: str = "camera1") -> DataFrame:
    """Poses at image times, within the track, at the camera's place."""
    cols = ["northings", "eastings", "depth", "altitude", "roll", "pitch", "yaw"]
    at = interp.interpolated(cameras, track.select(*BY, T, *cols), BY, T, cols, yaw=["yaw"], extrapolate=False).filter(F.col("northings").isNotNull())
    n, e, d = frames.offset_position("roll", "pitch", "yaw", "northings", "eastings", "depth", vehicle.arm("origin"), vehicle.arm(camera))
    return at.select(*[c for c in at.columns if c not in ("northings", "eastings", "depth")], n.alias("northings"), e.alias("eastings"), d.alias("depth"))


def measurements(s: Sensors, queries: DataFrame | None = None) -> DataFrame:
    """Sensors as one long table for the folds; ``queries`` are times at which states are wanted."""
    none = F.lit(None).cast("double")

    def rows(df: DataFrame, kind: str, values: tuple[str, ...], stds: tuple[str, ...]) -> DataFrame:
        pick = lambda cs, i: F.col(cs[i]).cast("double") if i < len(cs) and cs[i] in df.columns else none
        return df.select(*BY, T, F.lit(kind).alias("kind"), *[pick(values, i).alias(n) for i, n in enumerate("abc")], *[pick(stds, i).alias(f"{n}_std") for i, n in enumerate("abc")])

    u = rows(s.orientation, "orientation", ("roll", "pitch", "yaw"), ("roll_std", "pitch_std", "yaw_std"))
    u = u.unionByName(rows(s.velocity, "velocity", ("x_velocity", "y_velocity", "z_velocity"), ("x_velocity_std", "y_velocity_std", "z_velocity_std")))
    u = u.unionByName(rows(s.depth, "depth", ("depth",), ("depth_std",)))
    if s.usbl is not None:
        u = u.unionByName(rows(s.usbl, "usbl", ("northings", "eastings", "depth"), ("northings_std", "eastings_std", "depth_std")))
    return u.unionByName(rows(queries, "query", (), ())) if queries is not None else u


def run(s: Sensors, latitude: float, longitude: float, vehicle: Vehicle = Vehicle(), c: NavConfig = NavConfig(), ekf: folds.EkfConfig = folds.EkfConfig()) -> dict[str, DataFrame]:
    """All tables of a run by name; nothing is computed before it is read."""
    out: dict[str, DataFrame] = {"seafloor": seafloor(s)}
    fixes = filtered_usbl(s, c) if s.usbl is not None and c.usbl_filter else s.usbl
    if c.dead_reckoning:
        out["dead_reckoning"] = anchored(dead_reckoning(s, vehicle, c), fixes, latitude, longitude)
    m = measurements(Sensors(s.velocity, s.orientation, s.depth, s.altitude, fixes))
    if c.ekf:
        # kept on disk once computed: states and report are one pass
        steps = folds.ekf_steps(m, BY, ekf).persist(StorageLevel.DISK_ONLY)
        out["ekf"] = anchored(interp.interpolated(steps.drop("covariance", "report"), s.altitude.select(*BY, T, "altitude"), BY, T, ["altitude"]), None, latitude, longitude)
        out["ekf_report"] = aggregates.accepted(folds.report_of(steps, BY), BY)
    if c.particle_filter:
        out["particle_filter"] = folds.particle_filter(m, BY, c.particles)
    return out
