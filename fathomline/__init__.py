"""fathomline: a PySpark-native analytics engine for underwater-vehicle surveys."""

__version__ = "0.1.0"
