"""Dead reckoning as a stream: each dive's last sample and position are its state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def dead_reckoned_stream(rows: DataFrame, key: str = "dive", lateness: str = "10 minutes", idle_s: float = 86400.0) -> DataFrame:
    """(dive, t, northings, eastings) as samples arrive. ``rows``: dive, ts (timestamp), t, north_velocity, east_velocity.

    A sample older than its dive's last one comes too late for its place in the integral and is left out. The state of a dive
    goes when the watermark is ``idle_s`` past its last sample; what comes after that starts from nothing."""
    out = f"{key} {rows.schema[key].dataType.simpleString()}, t double, northings double, eastings double"
    state = "t double, v_n double, v_e double, n double, e double"

    def step(k: tuple, batches: Iterator[pd.DataFrame], s: GroupState) -> Iterator[pd.DataFrame]:
        if s.hasTimedOut:
            s.remove()
            return
        new = pd.concat(list(batches)).sort_values("t", kind="stable")
        last = s.get if s.exists else None
        t, v_n, v_e = (new[c].to_numpy(float) for c in ("t", "north_velocity", "east_velocity"))
        later = np.diff(t, prepend=-np.inf if last is None else last[0]) > 0
        later &= t > (-np.inf if last is None else last[0])
        t, v_n, v_e = t[later], v_n[later], v_e[later]
        if len(t):
            t0, a, b, n0, e0 = last or (t[0], v_n[0], v_e[0], 0.0, 0.0)
            dt = np.diff(t, prepend=t0)
            n, e = (start + np.cumsum(dt * (np.concatenate([[before], v[:-1]]) + v) / 2) for start, before, v in ((n0, a, v_n), (e0, b, v_e)))
            s.update((float(t[-1]), float(v_n[-1]), float(v_e[-1]), float(n[-1]), float(e[-1])))
            yield pd.DataFrame({key: [k[0]] * len(t), "t": t, "northings": n, "eastings": e})
        if s.exists:
            seen = int(new["ts"].max().timestamp() * 1000)
            s.setTimeoutTimestamp(max(seen, s.getCurrentWatermarkMs()) + max(1, int(idle_s * 1000)))

    return rows.withWatermark("ts", lateness).groupBy(key).applyInPandasWithState(step, out, state, "append", GroupStateTimeout.EventTimeTimeout)


def period_counts(rows: DataFrame, key: str = "dive", window: str = "10 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Records of each category in windows of event time."""
    from pyspark.sql import functions as F

    return rows.withWatermark("ts", lateness).groupBy(F.window("ts", window).alias("w"), key, "category").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "category", "n")
