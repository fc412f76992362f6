"""Readers by category and format: the place to add one. A reader takes a session and a path (and options) and returns a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.sources import bags, images, logs, matlab, rov, tables
from fathomline.sources.lines import read_lines

Reader = Callable[..., DataFrame]
_READERS: dict[tuple[str, str], Reader] = {}


def register(category: str, fmt: str) -> Callable[[Reader], Reader]:
    def add(f: Reader) -> Reader:
        _READERS[category, fmt] = f
        return f

    return add


def read(spark: SparkSession, category: str, fmt: str, path: str, **options) -> DataFrame:
    if (category, fmt) not in _READERS:
        raise KeyError(f"no reader for {category} in format {fmt}; there are {sorted(_READERS)}")
    return _READERS[category, fmt](spark, path, **options)


def formats() -> list[tuple[str, str]]:
    return sorted(_READERS)


def _from_lines(f: Callable[..., DataFrame]) -> Reader:
    return lambda spark, path, **o: f(read_lines(spark, path), **o)


def _from_csv(f: Callable[..., DataFrame], category: str, sep: str = ",") -> Reader:
    return lambda spark, path, **o: f(tables.read_csv(spark, path, sep), category, **o)


register("velocity", "phins")(_from_lines(lambda ls, **o: (s := logs.phins(ls, **o)).filter(s.x_velocity.isNotNull() & s.t.isNotNull())))
register("orientation", "phins")(_from_lines(lambda ls, heading_offset=0.0, **o: logs.phins_orientation(logs.phins(ls, heading_offset=heading_offset, **o), heading_offset)))
register("depth", "phins")(_from_lines(lambda ls, **o: (s := logs.phins(ls, **o)).filter(s.depth.isNotNull() & s.t.isNotNull())))
register("altitude", "phins")(_from_lines(lambda ls, **o: (s := logs.phins(ls, **o)).filter(s.altitude.isNotNull() & s.t.isNotNull())))
for _c in ("velocity", "orientation", "altitude"):
    register(_c, "rdi")(_from_lines(logs.rdi))
for _c in ("velocity", "orientation", "depth", "altitude"):
    register(_c, "ae2000")(_from_csv(tables.ae2000, _c))
for _c in ("velocity", "orientation", "depth", "altitude", "usbl"):
    register(_c, "alr")(_from_csv(tables.alr, _c))
    register(_c, "koyo21rov")(_from_csv(tables.koyo21, _c))
for _c in ("velocity", "altitude"):
    register(_c, "ntnu_dvl")(_from_csv(tables.ntnu_dvl, _c, "\t"))
for _c in ("usbl", "depth"):
    register(_c, "gaps")(_from_lines(logs.gaps))
register("usbl", "usbl_dump")(_from_lines(logs.usbl_dump))
register("usbl", "NOC_nmea")(_from_lines(logs.noc_nmea))
for _d in (1, 2, 3, 4):
    register("usbl", f"sonardyne_gga{_d if _d > 1 else ''}")(_from_lines(lambda ls, beacon, _d=_d: logs.gga(ls, beacon, _d)))
register("usbl", "sonardyne_mrt")(_from_lines(lambda ls, **o: logs.mrt_fixes(logs.mrt(ls), **o)))
register("clock", "alr_biocam")(_from_lines(logs.poll_times))
register("tide", "NOC_polpred")(_from_lines(logs.tide_polpred))
register("tide", "tide_CTI")(_from_lines(logs.tide_cti))
register("orientation", "eiva_navipac")(_from_lines(logs.eiva_attitude))
register("usbl", "eiva_navipac")(_from_lines(logs.eiva_fixes))
register("depth", "eiva_navipac")(_from_lines(logs.eiva_depths))
for _s in ("acfr", "biocam", "ntnu", "mtime"):
    register("image", _s)(lambda spark, path, _s=_s, **o: images.camera_listing(images.listing(spark, path), _s, **o))
register("image", "seaxerocks_3")(lambda spark, path, file_time, **o: images.seaxerocks(images.listing(spark, path), spark.read.option("header", True).csv(file_time), **o))
register("image", "stereo_gopro")(lambda spark, path, left, right: images.gopro_pairs(spark.read.option("header", True).csv(path), images.listing(spark, left), images.listing(spark, right)))
register("image", "voyis")(lambda spark, path, **o: images.voyis(images.listing(spark, path, "*.tif"), **o))
for _c in ("velocity", "orientation", "depth", "altitude"):
    register(_c, "autosub")(lambda spark, path, _c=_c, **o: matlab.autosub(matlab.read(spark, path), _c, **o))
register("position", "koyo20rov")(rov.koyo20_positions)
register("orientation", "koyo20rov")(rov.koyo20_attitudes)
register("image", "koyo20rov")(rov.koyo20_images)
register("position", "hybis")(rov.hybis_positions)
register("message", "rosbag")(bags.read)
register("orientation", "rosbag")(bags.attitudes)
register("depth", "rosbag")(bags.depths)
register("position", "rosbag")(bags.positions)
