"""Missions, vehicles and camera systems from YAML; configurations stay on the driver and become literals in plans."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from fathomline.functions.times import zone_hours


def load_yaml(path: str | Path) -> dict[str, Any]:
    import yaml

    return yaml.safe_load(Path(path).read_text()) or {}


@dataclass(frozen=True)
class Mount:
    """A sensor's place and angles on the vehicle: forward, right, down in metres; degrees."""

    surge: float = 0.0
    sway: float = 0.0
    heave: float = 0.0
    roll: float = 0.0
    pitch: float = 0.0
    yaw: float = 0.0

    @property
    def arm(self) -> tuple[float, float, float]:
        return self.surge, self.sway, self.heave

    @staticmethod
    def of(d: dict[str, Any]) -> Mount:
        # old files call the axes x, y, z or have _m and _deg in the names
        pick = lambda *names: float(next((d[n] for n in names if n in d), 0.0))
        return Mount(pick("surge_m", "surge", "x"), pick("sway_m", "sway", "y"), pick("heave_m", "heave", "z"), pick("roll_deg", "roll"), pick("pitch_deg", "pitch"), pick("yaw_deg", "yaw"))


@dataclass(frozen=True)
class Vehicle:
    mounts: dict[str, Mount] = field(default_factory=dict)

    @staticmethod
    def of(d: dict[str, Any]) -> Vehicle:
        return Vehicle({k: Mount.of(v) for k, v in d.items() if isinstance(v, dict)})

    def arm(self, sensor: str) -> tuple[float, float, float]:
        return self.mounts.get(sensor, Mount()).arm


@dataclass(frozen=True)
class Sensor:
    """How one category of a mission is recorded."""

    format: str = ""
    filepath: str = ""
    filename: str = ""
    tz_hours: float = 0.0
    offset_s: float = 0.0
    std_factor: float = 0.0
    std_offset: float = 0.0
    label: str = ""
    options: dict[str, Any] = field(default_factory=dict)

    @staticmethod
    def of(d: dict[str, Any]) -> Sensor:
        known = {"format", "filepath", "filename", "timezone", "timeoffset_s", "timeoffset", "offset_s", "std_factor", "std_offset", "label", "id"}
        return Sensor(str(d.get("format", "")), str(d.get("filepath", "")), str(d.get("filename", "")), zone_hours(d.get("timezone", 0)), float(d.get("timeoffset_s", d.get("offset_s", d.get("timeoffset", 0.0)))),
                      float(d.get("std_factor", 0.0)), float(d.get("std_offset", 0.0)), str(d.get("label", d.get("id", ""))), {k: v for k, v in d.items() if k not in known})


@dataclass(frozen=True)
class Mission:
    version: int = 1
    latitude: float = 0.0
    longitude: float = 0.0
    crs: str = "wgs84"
    date: str = ""
    sensors: dict[str, Sensor] = field(default_factory=dict)
    cameras: list[dict[str, Any]] = field(default_factory=list)

    @staticmethod
    def of(d: dict[str, Any]) -> Mission:
        o = d.get("origin", {})
        image = d.get("image", {}) or {}
        cameras = image.get("cameras") or [{"name": k, **(v if isinstance(v, dict) else {"path": v})} for k, v in sorted(image.items()) if k.startswith("camera")]
        names = ("velocity", "orientation", "depth", "altitude", "usbl", "tide", "dead_reckoning")
        return Mission(int(d.get("version", 0)), float(o.get("latitude", 0.0)), float(o.get("longitude", 0.0)), str(o.get("coordinate_reference_system", "wgs84")), str(o.get("date", "")), {k: Sensor.of(d[k]) for k in names if isinstance(d.get(k), dict)}, cameras)

    def to_dict(self) -> dict[str, Any]:
        return {"version": self.version, "origin": {"latitude": self.latitude, "longitude": self.longitude, "coordinate_reference_system": self.crs, "date": self.date},
                **{k: {"format": s.format, "filepath": s.filepath, "filename": s.filename, "timezone": s.tz_hours, "timeoffset_s": s.offset_s, "std_factor": s.std_factor, "std_offset": s.std_offset, "label": s.label, **s.options} for k, s in self.sensors.items()},
                "image": {"cameras": self.cameras}}


@dataclass(frozen=True)
class NavConfig:
    """Switches of a navigation run."""

    start: float | None = None
    finish: float | None = None
    usbl_filter: bool = True
    usbl_sigma: float = 2.0
    usbl_max_speed: float = 2.0
    dead_reckoning: bool = True
    ekf: bool = True
    particle_filter: bool = False
    particles: int = 300


@dataclass(frozen=True)
class ImageConfig:
    """Switches of an image-correction run."""

    altitude_min: float = 1.0
    altitude_max: float = 10.0
    bin_width: float = 0.1
    smoothing: str = "mean"
    target_mean: float = 30.0
    target_std: float = 5.0
    gamma: bool = True


#: How a camera's pixels may be laid out.
CAMERA_TYPES = ("grayscale", "rgb", "bgr", "rggb", "grbg", "bggr", "gbrg")


@dataclass(frozen=True)
class Camera:
    """One camera of a system: how its images are laid out, where they are, and how their names give the time."""

    name: str
    type: str
    path: str = ""
    extension: str = ""
    bit_depth: int = 8
    topic: str = ""
    filename_to_date: str = ""
    timestamp_file: str = ""
    columns: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(d: dict[str, Any]) -> Camera:
        if d["type"] not in CAMERA_TYPES:
            raise ValueError(f"{d['type']} is no camera type; there are {CAMERA_TYPES}")
        name = d["name"][1:].replace("/", "_") if "/" in d["name"] else d["name"]
        listed = d.get("columns") or {}
        columns = listed if isinstance(listed, dict) else {c["name"]: c["content"] for c in listed}
        return Camera(name, d["type"], str(d.get("path", "")), str(d.get("extension", "")), int(d.get("bit_depth", 8)), d["name"], str(d.get("filename_to_date") or ""), str(d.get("timestamp_file") or ""), columns)


@dataclass(frozen=True)
class CameraSystem:
    name: str
    cameras: tuple[Camera, ...]

    @staticmethod
    def of(d: dict[str, Any]) -> CameraSystem:
        for k in ("camera_system", "cameras"):
            if k not in d:
                raise ValueError(f"a camera system needs {k}")
        return CameraSystem(str(d["camera_system"]), tuple(map(Camera.of, d["cameras"])))

    @staticmethod
    def load(path: str | Path) -> CameraSystem:
        return CameraSystem.of(load_yaml(path))


def load_calibration(path: str | Path) -> dict[str, Any]:
    """A calibration file: its first line and matrix tags are OpenCV's; a matrix becomes rows of numbers."""
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    def matrix(loader: Any, node: Any) -> list[list[float]]:
        m = loader.construct_mapping(node, deep=True)
        data = [float(x) for x in m["data"]]
        return [data[i * m["cols"] : (i + 1) * m["cols"]] for i in range(m["rows"])]

    Loader.add_constructor("tag:yaml.org,2002:opencv-matrix", matrix)
    text = Path(path).read_text()
    return yaml.load("\n".join(x for x in text.splitlines() if not x.startswith("%")), Loader) or {}  # noqa: S506 (a safe loader)


@dataclass(frozen=True)
class MonoCamera:
    """A calibrated camera: size in pixels, camera matrix, distortion, rectification and projection."""

    name: str
    width: int
    height: int
    k: list[list[float]]
    d: list[float]
    r: list[list[float]]
    p: list[list[float]]

    @staticmethod
    def of(node: dict[str, Any], ratio: float = 1.0) -> MonoCamera:
        """``ratio`` scales the image."""
        scaled = lambda m: [[v * ratio for v in row] for row in m]
        return MonoCamera(
            str(node.get("camera_name", "")), int(node["image_width"] * ratio), int(node["image_height"] * ratio),
            scaled(node["camera_matrix"]), [v for row in node["distortion_coefficients"] for v in row], node.get("rectification_matrix") or [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]], scaled(node.get("projection_matrix") or []))

    def to_text(self) -> str:
        """As a calibration file."""
        def matrix(name: str, rows: list[list[float]]) -> str:
            return f"{name}: !!opencv-matrix\n  rows: {len(rows)}\n  cols: {len(rows[0])}\n  dt: d\n  data: [{', '.join(repr(float(v)) for row in rows for v in row)}]\n"

        head = f"%YAML:1.0\nimage_width: {self.width}\nimage_height: {self.height}\ncamera_name: {self.name}\n"
        return head + matrix("camera_matrix", self.k) + "distortion_model: plumb_bob\n" + matrix("distortion_coefficients", [self.d]) + matrix("rectification_matrix", self.r) + (matrix("projection_matrix", self.p) if self.p else "")


@dataclass(frozen=True)
class StereoCamera:
    """Two calibrated cameras and the turn and shift from the first one's axes to the second's."""

    left: MonoCamera
    right: MonoCamera
    r: list[list[float]]
    t: list[float]

    @staticmethod
    def load(path: str | Path) -> StereoCamera:
        d = load_calibration(path)
        ex = d.get("extrinsics", d)
        return StereoCamera(MonoCamera.of(d["left"]), MonoCamera.of(d["right"]), ex["rotation_matrix"], [v for row in ex["translation_vector"] for v in row])

    @property
    def matrix(self) -> list[list[float]]:
        """Rows of turn and shift, as ``geometry.triangulated_between`` takes them."""
        return [[*row, t] for row, t in zip(self.r, self.t, strict=True)]
