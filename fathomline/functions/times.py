"""Clocks: parts, strings and file names to epoch seconds (double, UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hours east of UTC of the zone labels that missions use.
ZONES = {"utc": 0.0, "cet": 0.0, "bst": 1.0, "jst": 9.0}
#: Letters of a camera's stamp format: what each run of a letter means.
STAMP = {"Y": "year", "M": "month", "D": "day", "h": "hour", "m": "minute", "s": "second", "f": "fraction", "u": "microsecond", "i": "index", "e": "epoch"}


def zone_hours(label: str | float, parity: bool = True) -> float:
    """Hours of a zone label or number. parity: CET is 0, as one of the two readers has it; else 1."""
    if isinstance(label, str) and (found := ZONES.get(label.strip().lower())) is not None:
        return found if parity or label.strip().lower() != "cet" else 1.0
    return float(label)


def epoch_of(ts: Column) -> Column:
    """Seconds of a timestamp (with or without zone; sessions are in UTC)."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def epoch_from_parts(year, month, day, hour, minute, second, tz_hours: float = 0.0, micros: Column | None = None) -> Column:
    """Seconds from date parts in a zone that is ``tz_hours`` ahead of UTC; null for an impossible date."""
    c = lambda x: x if isinstance(x, Column) else F.lit(x)
    days = F.datediff(F.try_to_date(F.concat_ws("-", F.lpad(c(year).cast("string"), 4, "0"), F.lpad(c(month).cast("string"), 2, "0"), F.lpad(c(day).cast("string"), 2, "0")), "yyyy-MM-dd"), F.lit("1970-01-01").cast("date"))
    seconds = days.cast("double") * 86400 + c(hour).cast("double") * 3600 + c(minute).cast("double") * 60 + c(second).cast("double")
    return seconds + (micros.cast("double") / 1e6 if micros is not None else F.lit(0.0)) - tz_hours * 3600


def string_to_epoch(text: Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", tz_hours: float = 0.0) -> Column:
    return epoch_of(F.try_to_timestamp(text, F.lit(fmt))) - tz_hours * 3600


def epoch_to_text(t: Column, fmt: str = "yyyyMMddHHmmss") -> Column:
    return F.date_format(F.timestamp_micros((t * 1e6).cast("long")), fmt)


def epoch_to_day(t: Column) -> Column:
    return epoch_to_text(t, "yyyy-MM-dd")


def named_zone_to_epoch(naive: Column, zone: str) -> Column:
    """Seconds of a local wall clock in a named zone."""
    return epoch_of(F.to_utc_timestamp(naive, zone))


def clock_of_day(text: Column, day_epoch: Column | float, offset_s: float = 0.0, tz_hours: float = 0.0) -> Column:
    """Seconds of ``hhmmss.sss`` on a day; null where the seconds are 60 or more."""
    hh, mm, ss = (F.substring(text, 1, 2).try_cast("double"), F.substring(text, 3, 2).try_cast("double"), F.substring(text, 5, 20).try_cast("double"))
    day = day_epoch if isinstance(day_epoch, Column) else F.lit(float(day_epoch))
    return F.when(ss < 60, day + hh * 3600 + mm * 60 + ss - tz_hours * 3600 + offset_s)


def parts_of_stamp(fmt: str) -> dict[str, list[tuple[int, int]]]:
    """Where each part stands in a name: ``xxxYYYYMMDDxhhmmss`` -> {year: [(4, 4)], ...} (1-based start, length)."""
    found: dict[str, list[tuple[int, int]]] = {}
    i = 0
    while i < len(fmt):
        j = i
        while j < len(fmt) and fmt[j] == fmt[i]:
            j += 1
        if fmt[i] in STAMP:
            found.setdefault(STAMP[fmt[i]], []).append((i + 1, j - i))
        i = j
    return found


def epoch_from_stamp(name: Column, fmt: str, tz_hours: float = 0.0) -> Column:
    """Seconds from a file name by a stamp format; a fraction's unit follows from its number of digits."""
    parts = parts_of_stamp(fmt)
    text = lambda k: F.concat(*[F.substring(name, a, n) for a, n in parts[k]])
    num = lambda k, default: text(k).try_cast("double") if k in parts else F.lit(float(default))
    if "epoch" in parts:
        t = num("epoch", 0)
    else:
        t = epoch_from_parts(num("year", 1970).cast("int"), num("month", 1).cast("int"), num("day", 1).cast("int"), num("hour", 0), num("minute", 0), num("second", 0), tz_hours)
    if "fraction" in parts:
        t = t + num("fraction", 0) / 10.0 ** sum(n for _, n in parts["fraction"])
    if "microsecond" in parts:
        t = t + num("microsecond", 0) / 1e6
    return t


def epoch_from_image_name(path: Column, style: str, tz_hours: float = 0.0) -> Column:
    """Seconds from the names that cameras give: ``acfr`` PR_yyyymmdd_hhmmss_mmm_…, ``biocam`` yyyymmdd_hhmmss_uuuuuu_…"""
    stem = F.regexp_extract(path, r"([^/]+)$", 1)
    p = {"acfr": r"^[^_]*_(\d{8})_(\d{6})_(\d{3})", "biocam": r"^(\d{8})_(\d{6})_(\d{6})", "ntnu": r"(\d{8})[_-](\d{6})[_.](\d{1,6})"}[style]
    d, c, f = (F.regexp_extract(stem, p, i) for i in (1, 2, 3))
    part = lambda s, a, n: F.substring(s, a, n).try_cast("int")
    whole = epoch_from_parts(part(d, 1, 4), part(d, 5, 2), part(d, 7, 2), part(c, 1, 2), part(c, 3, 2), part(c, 5, 2), tz_hours)
    t = whole + f.try_cast("double") / F.pow(F.lit(10.0), F.length(f))
    return F.when(part(d, 1, 4) < 2000, 0.0).otherwise(t) if style == "biocam" else t
