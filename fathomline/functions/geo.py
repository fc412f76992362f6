"""WGS84 geodesics and degree strings.

The inverse and direct problems are solved by Vincenty's series in numpy, vectorised over Arrow batches. Where the
inverse doesn't converge (nearly opposite points) it falls back to a great circle on the mean sphere.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

A, INV_F = 6378137.0, 298.257223563
FLAT = 1 / INV_F
B = A * (1 - FLAT)
#: Metres of a degree that the reference uses for standard deviations.
DEGREE = 111111.0


def _series(u2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    b = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    return a, b


def _delta(b: np.ndarray, ss: np.ndarray, cs: np.ndarray, c2m: np.ndarray) -> np.ndarray:
    return b * ss * (c2m + b / 4 * (cs * (2 * c2m**2 - 1) - b / 6 * c2m * (4 * ss**2 - 3) * (4 * c2m**2 - 3)))


def inverse(lat1, lon1, lat2, lon2) -> tuple[np.ndarray, np.ndarray]:
    """Distance in metres and azimuth in degrees (-180 to 180) at the first point."""
    lat1, lon1, lat2, lon2 = (np.asarray(v, float) for v in np.broadcast_arrays(lat1, lon1, lat2, lon2))
    u1, u2 = (np.arctan((1 - FLAT) * np.tan(np.radians(v))) for v in (lat1, lat2))
    l = np.radians((lon2 - lon1 + 540) % 360 - 180)
    lam = l.copy()
    with np.errstate(all="ignore"):
        for _ in range(200):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(np.cos(u2) * sl, np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * cl)
            cs = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * cl
            sig = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0, np.cos(u1) * np.cos(u2) * sl / np.where(ss == 0, 1, ss))
            ca2 = 1 - sa**2
            c2m = np.where(ca2 < 1e-15, 0, cs - 2 * np.sin(u1) * np.sin(u2) / np.where(ca2 < 1e-15, 1, ca2))
            c = FLAT / 16 * ca2 * (4 + FLAT * (4 - 3 * ca2))
            new = l + (1 - c) * FLAT * sa * (sig + c * ss * (c2m + c * cs * (2 * c2m**2 - 1)))
            done = np.abs(new - lam) < 1e-13
            lam = new
            if np.all(done | ~np.isfinite(new)):
                break
        a, b = _series(ca2 * (A**2 - B**2) / B**2)
        s = B * a * (sig - _delta(b, ss, cs, c2m))
        azi = np.degrees(np.arctan2(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam)))
        bad = ~done & np.isfinite(l)
        if bad.any():
            p1, p2 = np.radians(lat1), np.radians(lat2)
            h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(l / 2) ** 2
            s = np.where(bad, 2 * (2 * A + B) / 3 * np.arcsin(np.sqrt(np.clip(h, 0, 1))), s)
            azi = np.where(bad, np.degrees(np.arctan2(np.sin(l) * np.cos(p2), np.cos(p1) * np.sin(p2) - np.sin(p1) * np.cos(p2) * np.cos(l))), azi)
    return s, azi


def direct(lat, lon, azimuth, distance) -> tuple[np.ndarray, np.ndarray]:
    """Latitude and longitude reached from a point."""
    lat, lon, azimuth, distance = (np.asarray(v, float) for v in np.broadcast_arrays(lat, lon, azimuth, distance))
    a1 = np.radians(azimuth)
    tu = (1 - FLAT) * np.tan(np.radians(lat))
    cu = 1 / np.sqrt(1 + tu**2)
    su = tu * cu
    s1 = np.arctan2(tu, np.cos(a1))
    sa = cu * np.sin(a1)
    ca2 = 1 - sa**2
    a, b = _series(ca2 * (A**2 - B**2) / B**2)
    sig = distance / (B * a)
    for _ in range(100):
        c2m = np.cos(2 * s1 + sig)
        new = distance / (B * a) + _delta(b, np.sin(sig), np.cos(sig), c2m)
        done = np.abs(new - sig) < 1e-13
        sig = new
        if np.all(done | ~np.isfinite(sig)):
            break
    c2m = np.cos(2 * s1 + sig)
    ss, cs = np.sin(sig), np.cos(sig)
    x = su * ss - cu * cs * np.cos(a1)
    out_lat = np.arctan2(su * cs + cu * ss * np.cos(a1), (1 - FLAT) * np.hypot(sa, x))
    lam = np.arctan2(ss * np.sin(a1), cu * cs - su * ss * np.cos(a1))
    c = FLAT / 16 * ca2 * (4 + FLAT * (4 - 3 * ca2))
    l = lam - (1 - c) * FLAT * sa * (sig + c * ss * (c2m + c * cs * (2 * c2m**2 - 1)))
    return np.degrees(out_lat), (lon + np.degrees(l) + 540) % 360 - 180


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


@F.pandas_udf(_doubles("distance", "azimuth"))
def _inverse_udf(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.DataFrame:
    s, a = inverse(lat1, lon1, lat2, lon2)
    return pd.DataFrame({"distance": s, "azimuth": a})


@F.pandas_udf(_doubles("latitude", "longitude"))
def _direct_udf(lat: pd.Series, lon: pd.Series, east: pd.Series, north: pd.Series) -> pd.DataFrame:
    la, lo = direct(lat, lon, np.degrees(np.arctan2(east, north)), np.hypot(east, north))
    return pd.DataFrame({"latitude": la, "longitude": lo})


def _double(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("double")


def latlon_to_metres(lat, lon, lat_ref, lon_ref) -> Column:
    """struct(distance, azimuth) from the reference point to a point."""
    return _inverse_udf(*map(_double, (lat_ref, lon_ref, lat, lon)))


def metres_to_latlon(lat_ref, lon_ref, eastings, northings) -> Column:
    """struct(latitude, longitude) of a point given by eastings and northings."""
    return _direct_udf(*map(_double, (lat_ref, lon_ref, eastings, northings)))


def northings_eastings(geodesic: Column) -> tuple[Column, Column]:
    """From struct(distance, azimuth)."""
    return geodesic["distance"] * F.cos(F.radians(geodesic["azimuth"])), geodesic["distance"] * F.sin(F.radians(geodesic["azimuth"]))


def usbl_stds(distance: Column, offset: float, factor: float, latitude: Column, parity: bool = True) -> dict[str, Column]:
    """Standard deviations of a fix that grow with its distance. parity: latitude's from eastings', longitude's from northings'."""
    n = e = F.abs(distance) * factor + offset
    cos = F.cos(F.radians(latitude))
    return {"northings_std": n, "eastings_std": e, "latitude_std": F.abs((e if parity else n) / DEGREE), "longitude_std": F.abs((n if parity else e) / (DEGREE * cos))}


def nmea_stds(depth: Column, offset: float, factor: float, latitude: Column) -> dict[str, Column]:
    """Standard deviations of a fix from a position sentence: they grow with its depth; longitude's is latitude's times the cosine, as the reference has it."""
    metres = depth * factor + offset
    lat = depth / 111111.0
    return {"northings_std": metres, "eastings_std": metres, "depth_std": metres, "latitude_std": lat, "longitude_std": lat * F.cos(F.radians(latitude))}


def degrees_from_minutes(text: Column) -> Column:
    """Decimal degrees of ``5950.89694N``: whole degrees, two-digit minutes with decimals, hemisphere. Null if it isn't one."""
    p = r"^\s*(\d{1,3})(\d{2}(?:\.\d+)?)\s*([NSEWnsew])\s*$"
    part = lambda i: F.regexp_extract(text, p, i)
    value = part(1).try_cast("double") + part(2).try_cast("double") / 60
    return F.when(F.upper(part(3)).isin("S", "W"), -value).otherwise(value)


def degrees_from_dashed(text: Column, parity: bool = False) -> Column:
    """Decimal degrees of ``dd-mm.mm H``. parity: the minutes of southern and western places are added, not subtracted."""
    p = r"^\s*(\d+)-(\d+(?:\.\d+)?)\s*([NSEWnsew])\s*$"
    part = lambda i: F.regexp_extract(text, p, i)
    d, m = part(1).try_cast("double"), part(2).try_cast("double") / 60
    return F.when(F.upper(part(3)).isin("S", "W"), -d + m if parity else -(d + m)).otherwise(d + m)


def degrees_minutes(deg: Column) -> Column:
    """``d m.mmmm``: whole degrees and minutes of decimal degrees."""
    whole = F.floor(F.abs(deg))
    return F.concat(F.when(deg < 0, "-").otherwise(""), whole.cast("string"), F.lit(" "), F.format_number((F.abs(deg) - whole) * 60, "0.0000"))


def speed_between(lat0: Column, lon0: Column, lat1: Column, lon1: Column, dt: Column) -> Column:
    """Metres a second by degrees on a sphere, as the outlier filter has it."""
    return F.lit(111139.0) * F.sqrt((lat1 - lat0) ** 2 + (lon1 - lon0) ** 2) / dt


def depth_of_pressure(pascal: Column, density: float = 1030.0, gravity: float = 9.80665) -> Column:
    """Metres of sea water that weigh as much."""
    return pascal / (density * gravity)


def mean_radius() -> float:
    return math.sqrt((2 * A * A + B * B) / 3)
