import pytest

from fathomline.config import CameraSystem, MonoCamera, StereoCamera, load_calibration


def test_camera_system():
    s = CameraSystem.of({"camera_system": "biocam", "cameras": [{"name": "/cam/a", "type": "bggr", "path": "image/a", "extension": "raw", "bit_depth": 18, "columns": [{"name": "date", "content": "YYYYMMDD"}]}, {"name": "b", "type": "rgb"}]})
    assert [c.name for c in s.cameras] == ["cam_a", "b"] and s.cameras[0].columns == {"date": "YYYYMMDD"} and s.cameras[0].topic == "/cam/a"
    for bad in ({"cameras": []}, {"camera_system": "x"}, {"camera_system": "x", "cameras": [{"name": "a", "type": "cmyk"}]}):
        with pytest.raises(ValueError):
            CameraSystem.of(bad)


def test_calibration_files_come_back(tmp_path):
    camera = MonoCamera("a", 640, 480, [[500.0, 0.0, 320.0], [0.0, 500.0, 240.0], [0.0, 0.0, 1.0]], [0.1, -0.2, 0.0, 0.0, 0.01], [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]], [[500.0, 0.0, 320.0, 0.0], [0.0, 500.0, 240.0, 0.0], [0.0, 0.0, 1.0, 0.0]])
    (tmp_path / "c.yaml").write_text(camera.to_text())
    assert MonoCamera.of(load_calibration(tmp_path / "c.yaml")) == camera
    half = MonoCamera.of(load_calibration(tmp_path / "c.yaml"), 0.5)
    assert (half.width, half.height, half.k[0][0], half.p[1][2]) == (320, 240, 250.0, 120.0)


def test_stereo(tmp_path):
    one = "  image_width: 4\n  image_height: 3\n  camera_name: x\n  camera_matrix: !!opencv-matrix\n    rows: 3\n    cols: 3\n    dt: d\n    data: [1, 0, 0, 0, 1, 0, 0, 0, 1]\n  distortion_coefficients: !!opencv-matrix\n    rows: 1\n    cols: 2\n    dt: d\n    data: [0, 0]\n"
    ex = "extrinsics:\n  rotation_matrix: !!opencv-matrix\n    rows: 3\n    cols: 3\n    dt: d\n    data: [1, 0, 0, 0, 1, 0, 0, 0, 1]\n  translation_vector: !!opencv-matrix\n    rows: 3\n    cols: 1\n    dt: d\n    data: [-0.5, 0, 0]\n"
    (tmp_path / "s.yaml").write_text("%YAML:1.0\nleft:\n" + one + "right:\n" + one + ex)
    s = StereoCamera.load(tmp_path / "s.yaml")
    assert s.matrix[0] == [1.0, 0.0, 0.0, -0.5] and s.left.width == 4
