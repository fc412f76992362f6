"""Sequential filters over dives' time-ordered measurements.

The filters step through many dives side by side: rows come partitioned and sorted by dive, a task takes as many whole dives
as ``CELLS`` allows, and each step is one array operation over all of them. The Kalman filter keeps the states that its
smoother needs, the particle filter only who descends from whom. The speed filter takes a dive as one group. A dive is bounded
by how long a vehicle can stay down, so it fits a worker; partitions run in parallel.

Measurements are one long table: by..., t, kind (orientation, usbl, depth, velocity, query), a, b, c, a_std, b_std, c_std:
  orientation: roll, pitch, yaw in degrees; usbl: northings, eastings, depth; depth: a; velocity: x, y, z of the body.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.shared import cut, dealt

N = 12
POSITION, ANGLES, SPEEDS, RATES = slice(0, 3), slice(3, 6), slice(6, 9), slice(9, 12)
#: Order in which measurements of one moment are taken in.
ORDER = {"orientation": 0, "usbl": 1, "depth": 2, "velocity": 3, "query": 4}
KINDS = list(ORDER)
STATE = ["northings", "eastings", "depth", "roll", "pitch", "yaw", "x_velocity", "y_velocity", "z_velocity", "vroll", "vpitch", "vyaw"]


@dataclass(frozen=True)
class StdModel:
    """offset + factor x value, where a measurement brings no deviation of its own."""

    offset: float = 0.0
    factor: float = 0.0


@dataclass(frozen=True)
class EkfConfig:
    initial_covariance: Sequence[float] = tuple([1e-6] * N)
    process_noise: Sequence[float] = (0.05, 0.05, 0.06, 0.03, 0.03, 0.06, 0.025, 0.025, 0.04, 0.01, 0.01, 0.02)
    mahalanobis: float = 3.0
    smooth: bool = True
    #: "as_coded": the gain of the smoother is a product element by element, as the reference has it; "matrix": as the books do.
    smoother_mode: str = "matrix"
    usbl_to_dvl: Sequence[float] = (0.0, 0.0, 0.0)
    depth_to_dvl: Sequence[float] = (0.0, 0.0, 0.0)
    stds: dict[str, StdModel] = field(default_factory=lambda: {k: StdModel(0.1, 0.01) for k in ("orientation", "usbl", "depth", "velocity")})


_SPIN = np.array([[[0, 0, 0], [0, 0, -1], [0, 1, 0]], [[0, 0, 1], [0, 0, 0], [-1, 0, 0]], [[0, -1, 0], [1, 0, 0], [0, 0, 0]]], float)
#: Dives times steps that are filtered at a time (144 numbers of covariance each).
CELLS = 1 << 16


def rotations(angles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotations about x, y and z for rows of roll, pitch, yaw in radians; their product z y x takes the body to north, east, down."""
    out = []
    for k, (i, j) in enumerate(((1, 2), (2, 0), (0, 1))):
        m = np.zeros((len(angles), 3, 3))
        c, s = np.cos(angles[:, k]), np.sin(angles[:, k])
        m[:, k, k], m[:, i, i], m[:, j, j], m[:, i, j], m[:, j, i] = 1, c, c, -s, s
        out.append(m)
    return out[0], out[1], out[2]


def motion(x: np.ndarray, dt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transition matrices at states (one a row), and the Jacobians of transition-times-state."""
    rx, ry, rz = rotations(x[:, ANGLES])
    zy = rz @ ry
    turn = zy @ rx
    roll, pitch = x[:, 3], x[:, 4]
    cr, sr, cp, tp = np.cos(roll), np.sin(roll), np.cos(pitch), np.tan(pitch)
    one, zero = np.ones(len(x)), np.zeros(len(x))
    stack = lambda rows: np.array(rows).transpose(2, 0, 1)
    rates = stack([[one, sr * tp, cr * tp], [zero, cr, -sr], [zero, sr / cp, cr / cp]])
    f = np.tile(np.eye(N), (len(x), 1, 1))
    f[:, POSITION, SPEEDS], f[:, ANGLES, RATES] = turn * dt[:, None, None], rates * dt[:, None, None]
    j = f.copy()
    v, w, by = x[:, SPEEDS, None], x[:, RATES, None], dt[:, None]
    for k, d in enumerate((turn @ _SPIN[0], zy @ _SPIN[1] @ rx, rz @ _SPIN[2] @ ry @ rx)):
        j[:, POSITION, 3 + k] += (d @ v)[:, :, 0] * by
    by_roll = stack([[zero, cr * tp, -sr * tp], [zero, -sr, -cr], [zero, cr / cp, -sr / cp]])
    by_pitch = stack([[zero, sr / cp**2, cr / cp**2], [zero, zero, zero], [zero, sr * tp / cp, cr * tp / cp]])
    j[:, ANGLES, 3] += (by_roll @ w)[:, :, 0] * by
    j[:, ANGLES, 4] += (by_pitch @ w)[:, :, 0] * by
    return f, j


def wrapped(angle: np.ndarray) -> np.ndarray:
    """Radians into [-pi, pi]; what is inside stays as it is."""
    return np.where(np.abs(angle) <= np.pi, angle, (angle + np.pi) % (2 * np.pi) - np.pi)


def measured(kind: int, v: np.ndarray, s: np.ndarray, x: np.ndarray, c: EkfConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state indices, values, variances) of measurements of a kind, one a row."""
    model = c.stds[KINDS[kind]]
    own = s[:, :1] > 0

    def turned(arm: Sequence[float]) -> np.ndarray:
        rx, ry, rz = rotations(x[:, ANGLES])
        return (rz @ ry @ rx) @ np.asarray(arm, float)

    if kind == ORDER["orientation"]:
        return np.array([3, 4, 5]), np.radians(v), np.radians(np.where(own, s, model.offset + v * model.factor)) ** 2
    if kind == ORDER["usbl"]:
        far = np.sqrt(np.nansum(v**2, axis=1))[:, None]
        return np.array([0, 1]), v[:, :2] + turned(c.usbl_to_dvl)[:, :2], np.where(own, s[:, :2], model.offset + model.factor * far) ** 2
    if kind == ORDER["depth"]:
        return np.array([2]), v[:, :1] + turned(c.depth_to_dvl)[:, 2:], np.where(own, s[:, :1], model.offset + v[:, :1] * model.factor) ** 2
    return np.array([6, 7, 8]), v, np.where(own, s, model.offset + np.abs(v) * model.factor) ** 2


def _square(of: Sequence) -> np.ndarray:
    return np.diag(of).astype(float) if np.ndim(of) == 1 else np.asarray(of, float)


def update(x: np.ndarray, p: np.ndarray, at: np.ndarray, z: np.ndarray, r: np.ndarray, c: EkfConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States and covariances after measurements of the state's entries ``at``, and which of them the gate let through."""
    pht = p[:, :, at]
    inv = np.linalg.inv(pht[:, at] + r[:, :, None] * np.eye(len(at)))
    gain, miss = pht @ inv, z - x[:, at]
    angle = (at >= 3) & (at < 6)
    miss[:, angle] = wrapped(miss[:, angle])
    ok = np.einsum("di,dij,dj->d", miss, inv, miss) < c.mahalanobis**2
    new = x + (gain @ miss[:, :, None])[:, :, 0]
    new[:, ANGLES] = wrapped(new[:, ANGLES])
    rest = np.tile(np.eye(N), (len(x), 1, 1))
    rest[:, :, at] -= gain
    cov = rest @ p @ rest.transpose(0, 2, 1) + (gain * r[:, None, :]) @ gain.transpose(0, 2, 1)
    return np.where(ok[:, None], new, x), np.where(ok[:, None, None], cov, p), ok


@dataclass
class Steps:
    """Filtered dives side by side: for each step, which dives take it (``live``), and their times, states and covariances; what was measured in it."""

    live: list[np.ndarray]
    t: list[np.ndarray]
    x: list[np.ndarray]
    p: list[np.ndarray]
    #: (step, dive, kind, taken)
    report: list[tuple[int, np.ndarray, int, np.ndarray]]


def filter_dives(dive: np.ndarray, t: np.ndarray, kind: np.ndarray, v: np.ndarray, s: np.ndarray, t0: np.ndarray, x0: np.ndarray, c: EkfConfig, covariances: bool = True) -> Steps:
    """The forward pass. ``dive`` numbers the dives from 0 on; ``t0`` and ``x0`` have one row a dive; events after t0 count."""
    events = pd.DataFrame({"d": dive, "t": t, "k": kind, "i": np.arange(len(t))})
    # measurements of one kind and moment come in one after the other, each after a step of its own
    events["turn"] = events.groupby(["d", "t", "k"]).cumcount()
    events = events[t > t0[dive]].sort_values(["d", "t", "turn", "k", "i"], kind="stable")
    d, at, turn, k, i = (events[n].to_numpy() for n in ("d", "t", "turn", "k", "i"))
    new = np.ones(len(d), bool)
    new[1:] = (np.diff(d) != 0) | (np.diff(at) != 0) | (np.diff(turn) != 0)
    number = np.cumsum(new)
    first = np.zeros(len(t0), np.int64)
    first[d[::-1]] = number[::-1]  # the first step of each dive
    step = number - first[d] + 1 if len(d) else number
    by = np.argsort(step, kind="stable")
    d, at, k, i, step = d[by], at[by], k[by], i[by], step[by]
    q, p0 = _square(c.process_noise), _square(c.initial_covariance)
    x, p, now = x0.astype(float).copy(), np.tile(p0, (len(t0), 1, 1)), t0.astype(float).copy()
    out = Steps([np.arange(len(t0))], [now.copy()], [x.copy()], [p.copy()], [])
    edge = np.searchsorted(step, np.arange(1, (int(step[-1]) if len(step) else 0) + 2))
    for n in range(len(edge) - 1):
        span = slice(edge[n], edge[n + 1])
        live, where = np.unique(d[span], return_index=True)
        dt = at[span][where] - now[live]
        f, j = motion(x[live], dt)
        xl = (f @ x[live][:, :, None])[:, :, 0]
        pl = j @ p[live] @ j.transpose(0, 2, 1) + np.abs(dt)[:, None, None] * q
        xl[:, ANGLES] = wrapped(xl[:, ANGLES])
        for kk in range(ORDER["query"]):
            rows = np.flatnonzero(k[span] == kk)
            if not len(rows):
                continue
            who = np.searchsorted(live, d[span][rows])
            idx, z, r = measured(kk, v[i[span][rows]], s[i[span][rows]], xl[who], c)
            r = np.maximum(np.abs(r), 1e-9)
            keep = ~np.isnan(z)
            for pattern in np.unique(keep, axis=0):  # entries that are missing are left out
                if not pattern.any():
                    continue
                same = np.flatnonzero((keep == pattern).all(axis=1))
                w = who[same]
                xl[w], pl[w], ok = update(xl[w], pl[w], idx[pattern], z[same][:, pattern], r[same][:, pattern], c)
                out.report.append((n + 1, live[w], kk, ok))
        x[live], p[live], now[live] = xl, pl, at[span][where]
        out.live.append(live)
        out.t.append(now[live])
        out.x.append(xl)
        if covariances:
            out.p.append(pl)
    return out


def smooth_dives(steps: Steps, c: EkfConfig) -> None:
    """Rauch-Tung-Striebel pass from the last states back, in place."""
    q = _square(c.process_noise)
    for n in range(len(steps.live) - 2, -1, -1):
        on = steps.live[n + 1]  # a dive that takes a step has taken the one before
        here = np.searchsorted(steps.live[n], on)
        x, p, dt = steps.x[n][here], steps.p[n][here], steps.t[n + 1] - steps.t[n][here]
        f, j = motion(x, dt)
        ahead = j @ p @ j.transpose(0, 2, 1) + q * dt[:, None, None]
        inv = np.linalg.pinv(ahead)
        back = j.transpose(0, 2, 1)
        gain = p * back * inv if c.smoother_mode == "as_coded" else p @ back @ inv
        miss = steps.x[n + 1] - (f @ x[:, :, None])[:, :, 0]
        miss[:, ANGLES] = np.arctan2(np.sin(miss[:, ANGLES]), np.cos(miss[:, ANGLES]))
        steps.x[n][here] = x + (gain @ miss[:, :, None])[:, :, 0]
        steps.p[n][here] = p + gain @ (steps.p[n + 1] - ahead) @ gain.transpose(0, 2, 1)


def _schema(rows: DataFrame, by: Sequence[str], more: str) -> T.StructType:
    head = T.StructType([rows.schema[c] for c in by])
    for f in T._parse_datatype_string(more).fields:
        head = head.add(f)
    return head


def start_of(t: np.ndarray, kind: np.ndarray, v: np.ndarray) -> tuple[float, np.ndarray]:
    """Start of a dive: the first moment by which each kind of measurement (fixes aside) has been seen, from the latest of each."""
    main = [ORDER[k] for k in ("orientation", "depth", "velocity")]
    t0 = max((t[kind == k].min() for k in main if (kind == k).any()), default=t.min())
    x = np.zeros(N)

    def last(k: str) -> np.ndarray | None:
        at = np.flatnonzero((kind == ORDER[k]) & (t <= t0))
        return v[at[np.flatnonzero(t[at] == t[at].max())[-1]]] if len(at) else None

    for k, at, width in (("orientation", ANGLES, 3), ("velocity", SPEEDS, 3), ("depth", slice(2, 3), 1), ("usbl", slice(0, 2), 2)):
        if (got := last(k)) is not None:
            x[at] = np.radians(got) if k == "orientation" else got[:width]
    return float(t0), x


def _initial(pdf: pd.DataFrame) -> tuple[float, np.ndarray]:
    t, kind, v, _ = _arrays(pdf)
    return start_of(t, np.array([ORDER[k] for k in kind]), v)


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    return pdf.t.to_numpy(float), pdf.kind.to_numpy(), pdf[["a", "b", "c"]].to_numpy(float), pdf[["a_std", "b_std", "c_std"]].fillna(0.0).to_numpy(float)


def side_by_side(f: Callable[[pd.DataFrame], Iterator[pd.DataFrame]], by: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For mapInPandas over rows that are sorted by dive: ``f`` gets whole dives, in portions of at most CELLS dives times steps."""
    by = list(by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        cells = 0
        for pdf in batches:
            held.append(pdf)
            cells += len(pdf)
            if cells >= CELLS:  # all dives but the last are whole
                both = pd.concat(held, ignore_index=True)
                number = both.groupby(by, sort=False, dropna=False).ngroup().to_numpy()
                whole = number < number[-1]
                if whole.any():
                    yield from portions(both[whole], number[whole])
                held = [both[~whole]]
                cells = len(held[0]) if whole.any() else 0  # a dive that is longer than CELLS is waited for
        if held and len(both := pd.concat(held, ignore_index=True)):
            yield from portions(both, both.groupby(by, sort=False, dropna=False).ngroup().to_numpy())

    def portions(part: pd.DataFrame, number: np.ndarray) -> Iterator[pd.DataFrame]:
        begin = [*np.flatnonzero(np.diff(number, prepend=-1)).tolist(), len(part)]
        a, longest = 0, 0
        for k in range(len(begin) - 1):
            longest = max(longest, begin[k + 1] - begin[k])
            if k > a and longest * (k - a + 1) > CELLS:
                yield from f(part.iloc[begin[a] : begin[k]].reset_index(drop=True))
                a, longest = k, begin[k + 1] - begin[k]
        yield from f(part.iloc[begin[a] :].reset_index(drop=True))

    return run


def ekf_steps(rows: DataFrame, by: Sequence[str], config: EkfConfig = EkfConfig(), starts: DataFrame | None = None, covariance: bool = True, asked_only: bool = False) -> DataFrame:
    """States of the (smoothed) extended Kalman filter: by..., t, the twelve states (angles in degrees), covariance (144), and
    report: type and valid (did the gate let it through?) of the measurements that the state took in. Without ``covariance``
    none leave the worker; with ``asked_only`` only states at the times of queries do.

    ``starts``: by..., start_t, start (the twelve states) of each dive that is to be filtered; else each starts by itself."""
    deg = np.array([1, 1, 1, *[180 / math.pi] * 3, 1, 1, 1, *[180 / math.pi] * 3])
    by = list(by)

    given = starts is not None

    def filtered(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Whole dives, sorted by dive."""
        key = part.groupby(by, sort=False, dropna=False).ngroup().to_numpy()
        t, names, v, s = _arrays(part)
        kind = np.array([ORDER[k] for k in names])
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        if not given:
            first = [start_of(t[a:b], kind[a:b], v[a:b]) for a, b in zip(begin, [*begin[1:], len(key)], strict=True)]
        else:
            first = [(part.start_t.iloc[a], np.asarray(part.start.iloc[a]) / deg) for a in begin]
        steps = filter_dives(key, t, kind, v, s, np.array([x[0] for x in first]), np.array([x[1] for x in first]), config, covariance or config.smooth)
        taken: dict[tuple[int, int], list[dict]] = {}
        for n, who, k, ok in steps.report:
            for d, o in zip(who.tolist(), ok.tolist(), strict=True):
                taken.setdefault((d, n), []).append({"type": KINDS[k], "valid": o})
        if config.smooth:
            smooth_dives(steps, config)
        d = np.concatenate(steps.live)
        n = np.repeat(np.arange(len(steps.live)), [len(x) for x in steps.live])
        order, when = np.lexsort((n, d)), np.concatenate(steps.t)
        if asked_only:
            asked, moments = kind == ORDER["query"], np.unique(t)
            of = lambda dive, at: dive * len(moments) + np.minimum(np.searchsorted(moments, at), len(moments) - 1)
            known = moments[np.minimum(np.searchsorted(moments, when), len(moments) - 1)] == when
            order = order[(known & np.isin(of(d, when), of(key[asked], t[asked])))[order]]
            if not len(order):
                return  # nobody asks in this portion; Arrow can't tell what an empty frame's reports would be
        out = part.iloc[begin[d[order]]][by].reset_index(drop=True)
        out["t"] = when[order]
        out[STATE] = (np.concatenate(steps.x) * deg)[order]
        if covariance:
            out["covariance"] = list(np.concatenate(steps.p)[order].reshape(-1, N * N))
        out["report"] = [taken.get((a, b), []) for a, b in zip(d[order].tolist(), n[order].tolist(), strict=True)]
        yield out

    more = "t double, " + ", ".join(f"{c} double" for c in STATE) + (", covariance array<double>" if covariance else "") + ", report array<struct<type: string, valid: boolean>>"
    needed = rows.select(*by, "t", "kind", "a", "b", "c", "a_std", "b_std", "c_std")
    if starts is not None:
        needed = needed.join(starts.select(*by, "start_t", "start"), by)
    return dealt(needed, by).sortWithinPartitions(*by, "t", "kind", "a").mapInPandas(side_by_side(filtered, by), _schema(rows, by, more))


def ekf(rows: DataFrame, by: Sequence[str], config: EkfConfig = EkfConfig(), covariance: bool = True) -> DataFrame:
    """States of the (smoothed) extended Kalman filter: by..., t, the twelve states (angles in degrees), covariance (144)."""
    return ekf_steps(rows, by, config, covariance=covariance).drop("report")


def relative_ekf(rows: DataFrame, by: Sequence[str], images: DataFrame, config: EkfConfig = EkfConfig()) -> DataFrame:
    """Uncertainty of each image's pose relative to the first image of its dive: states and covariances at the times of
    ``images`` (by..., t) of a filter that starts again a microsecond before the first image, from the state that a first
    run has there, and with no uncertainty of position and angles. Dives without images are left out."""
    by = list(by)
    at = images.select(*by, "t").distinct()
    asked = rows.filter(F.col("kind") != "query").unionByName(at.withColumn("kind", F.lit("query")), allowMissingColumns=True)
    known = ekf_steps(asked, by, config, covariance=False, asked_only=True)
    starts = cut(known.groupBy(*by).agg((F.min("t") - 1e-6).alias("start_t"), F.min_by(F.array(*STATE), "t").alias("start")))
    certain = _square(config.initial_covariance)
    certain[:6, :6] = 0
    last = at.groupBy(*by).agg(F.max("t").alias("end_t"))
    needed = asked.join(last, by).filter(F.col("t") <= F.col("end_t")).drop("end_t")
    return ekf_steps(needed, by, replace(config, initial_covariance=certain), starts, asked_only=True).drop("report")


def report_of(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    """by..., t, type, valid: each measurement that ``ekf_steps`` took in and whether the gate let it through."""
    return steps.select(*by, "t", F.inline("report"))


def ekf_report(rows: DataFrame, by: Sequence[str], config: EkfConfig = EkfConfig()) -> DataFrame:
    return report_of(ekf_steps(rows, by, replace(config, smooth=False), covariance=False), by)


class Descent:
    """Which particles stem from which, drawing by drawing, without branches that have died out: lines meet a few drawings back,
    so that a dive with many drawings holds little more than one particle for each."""

    def __init__(self) -> None:
        self.steps: list[int] = []
        #: for each drawing the particles before it that still have descendants, and where in that list each of the next drawing's
        #: (at the last one: each present particle) comes from; both ascend
        self.alive: list[np.ndarray] = []
        self.up: list[np.ndarray] = []
        #: the dive's draws (step, angles and speeds, particle, 3), where they are held
        self.noise: np.ndarray | None = None

    def draw(self, step: int, parents: np.ndarray) -> None:
        """``parents`` ascend, as evenly spaced places draw them."""
        ids, up = self.different(parents)
        if self.up:
            self.up[-1] = self.up[-1][ids]
        self.steps.append(step)
        self.alive.append(ids.astype(np.int32))
        self.up.append(up)
        for n in range(len(self.up) - 2, -1, -1):
            used, up = self.different(self.up[n])
            if len(used) == len(self.alive[n]):
                break
            self.alive[n], self.up[n] = self.alive[n][used], up
            if n:
                self.up[n - 1] = self.up[n - 1][used]

    @staticmethod
    def different(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different values, and which of them each value is."""
        new = np.empty(len(ascending), bool)
        new[:1] = True
        np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
        return ascending[new], np.cumsum(new, dtype=np.int32) - np.int32(1)

    def line(self, particle: int, steps: int) -> np.ndarray:
        """The ancestor of a present particle at each of so many steps; a drawing's step has the particle after it."""
        out, end, at = np.empty(steps, np.int32), steps, particle
        name = particle
        for n in range(len(self.steps) - 1, -1, -1):
            out[self.steps[n] : end] = name
            at, end = int(self.up[n][at]), self.steps[n]
            name = int(self.alive[n][at])
        out[:end] = name
        return out

    def __len__(self) -> int:
        return sum(len(a) + len(u) for a, u in zip(self.alive, self.up, strict=True))


@dataclass(frozen=True)
class ParticleModel:
    particles: int
    seed: int
    velocity: StdModel
    angle: StdModel
    fix: StdModel
    gain: float

    def spread(self, value: np.ndarray, model: StdModel) -> np.ndarray:
        return (np.abs(value) * model.factor + model.offset) * self.gain


#: Bytes of draws that are held for the dives that are stepped through together; those of a longer dive are made again.
HELD = 1 << 24


def turned(mean: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines and sines of mean (dive) + off (dive, particle) radians: small offsets by their series, to the last digit."""
    if not (off.size and max(off.max(), -off.min()) < 0.1):
        return np.cos(mean[:, None] + off), np.sin(mean[:, None] + off)
    z = off * off
    small = [np.ones_like(z), off.copy()]  # cosine, sine of the offset
    for out, places in zip(small, ((90, 56, 30, 12, 2), (72, 42, 20, 6)), strict=True):
        series = z * (-1 / places[0])
        for place in places[1:]:
            series += 1
            series *= z
            series *= -1 / place
        series += 1
        out *= series
    c, s = np.cos(mean)[:, None], np.sin(mean)[:, None]
    return c * small[0] - s * small[1], s * small[0] + c * small[1]


def drift(m: ParticleModel, dt: np.ndarray, angles: np.ndarray, speeds: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """How far particles (north or east, dive, particle) get in ``dt`` by speeds of the body at angles in degrees (dive, 3) with noise."""
    wide, fast = m.spread(angles, m.angle), m.spread(speeds, m.velocity)
    (cr, sr), (cp, sp), (cy, sy) = (turned(np.radians(angles[:, k]), noise[:, 0, :, k] * np.radians(wide[:, k, None])) for k in range(3))
    u, v, w = (noise[:, 1, :, k] * fast[:, k, None] + speeds[:, k, None] for k in range(3))
    ahead, aside = cp * u + sp * (sr * v + cr * w), cr * v - sr * w
    return np.stack([cy * ahead - sy * aside, sy * ahead + cy * aside]) * dt[:, None]


def latest(t0: np.ndarray, x0: np.ndarray, t: np.ndarray, kind: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, ...]:
    """At each step (dive, step): the time since the one before, and the angles in degrees, speeds and depth that were last measured."""
    at = np.arange(t.shape[1])

    def of(name: str, start: np.ndarray) -> np.ndarray:
        last = np.maximum.accumulate(np.where(kind == ORDER[name], at, -1), axis=1)
        values = v[np.arange(len(t))[:, None], np.maximum(last, 0), : start.shape[1]]
        return np.where((last >= 0)[:, :, None], values, start[:, None])

    return np.diff(t, axis=1, prepend=t0[:, None]), of("orientation", np.degrees(x0[:, ANGLES])), of("velocity", x0[:, SPEEDS]), of("depth", x0[:, 2:3])[:, :, 0]


def run_particles(m: ParticleModel, t0: np.ndarray, x0: np.ndarray, count: np.ndarray, t: np.ndarray, kind: np.ndarray, v: np.ndarray, s: np.ndarray, lines: list[np.ndarray] | None = None, descent: list[Descent] | None = None):
    """One pass of the particles of dives side by side: ``t``, ``kind`` (dive, step), ``v`` (dive, step, 3), ``s``.

    Without ``lines``: who stems from whom, and the last weights; particles move as far as a dive's last fix. With ``lines`` (a
    particle for each step of a dive) the states of these particles alone are found from the draws of ``descent``, which are
    made again where they aren't held; so no pass holds more than the present particles and HELD bytes."""
    n = m.particles
    known = latest(t0, x0, t, kind, v)
    if lines is not None:
        descent = descent or run_particles(m, t0, x0, count, t, kind, v, s)[0]
        return [retraced(m, x0[d], int(c), *[k[d] for k in known], lines[d], descent[d]) for d, c in enumerate(count)]
    fixed = (kind == ORDER["usbl"]) & (np.arange(t.shape[1]) < count[:, None])
    reach = np.where(fixed.any(axis=1), t.shape[1] - np.argmax(fixed[:, ::-1], axis=1), 0)
    order = np.argsort(-reach, kind="stable")
    dt, angles, speeds, depth, fixed, v, s, x0, reach, count = (a[order] for a in (*known, fixed, v, s, x0, reach, count))
    sigma = np.where(s > 0, s, m.fix.offset + m.fix.factor * np.hypot(v[:, :, 0], v[:, :, 1]))
    rng, descent = [np.random.default_rng(m.seed) for _ in order], [Descent() for _ in order]
    x, w = np.empty((2, len(order), n)), np.full((len(order), n), 1 / n)
    for d, r in enumerate(rng):
        x[:, d] = (x0[d, :2] + r.normal(0, m.fix.offset, (n, 2))).T
    held = t.size * 6 * n * 8 <= HELD
    noise = np.empty((len(order), t.shape[1] if held else 1, 2, n, 3))
    for step in range(int(reach.max(initial=0))):
        live = int(np.searchsorted(-reach, -step, side="left"))  # dives that have a fix at this step or later
        now = noise[:live, step if held else 0]
        for r, out in zip(rng, now, strict=False):
            r.standard_normal(out=out)
        x[:, :live] += drift(m, dt[:live, step], angles[:live, step], speeds[:live, step], now)
        here = np.flatnonzero(fixed[:live, step])
        if not len(here):
            continue
        fix = v[here, step, :, None]
        far = np.hypot(x[0, here] - fix[:, 0], x[1, here] - fix[:, 1])
        deep = ~np.isnan(fix[:, 2, 0])
        far[deep] = np.hypot(far[deep], depth[here[deep], step, None] - fix[deep, 2])
        likely = w[here] * np.exp(-0.5 * (far / sigma[here, step, None]) ** 2) + 1e-300
        w[here] = likely = likely / likely.sum(axis=1, keepdims=True)
        for d in here[1 / (likely**2).sum(axis=1) < n / 2].tolist():
            places = (np.arange(n) + rng[d].random()) / n
            drawn = np.minimum(np.searchsorted(np.cumsum(w[d]), places), n - 1)
            x[:, d], w[d] = x[:, d, drawn], 1 / n
            descent[d].draw(step + 1, drawn)
    for d, own in enumerate(descent if held else []):
        own.noise = noise[d, : count[d]]
        rng[d].standard_normal(out=own.noise[reach[d] :])
    back = np.argsort(order)
    return [descent[d] for d in back], w[back]


def retraced(m: ParticleModel, x0: np.ndarray, count: int, dt: np.ndarray, angles: np.ndarray, speeds: np.ndarray, depth: np.ndarray, line: np.ndarray, descent: Descent) -> np.ndarray:
    """The states (step, 9) of a line of particles of one dive, from the start on."""
    rng, n = np.random.default_rng(m.seed), m.particles
    start = x0[:9].copy()
    start[:2] += rng.normal(0, m.fix.offset, (n, 2))[line[0]]
    if descent.noise is not None:
        noise = descent.noise[np.arange(count), :, line[:count]]
    else:
        noise, a = np.empty((count, 2, 3)), 0
        for end in [*descent.steps, count]:
            for a in range(a, end, 64):  # noqa: B020
                b = min(a + 64, end)
                noise[a:b] = rng.standard_normal((b - a, 2, n, 3))[np.arange(b - a), :, line[a:b]]
            a = end
            rng.random()  # what the drawing took
    dt, angles, speeds, depth = dt[:count], angles[:count], speeds[:count], depth[:count]
    out = np.empty((count + 1, 9))
    out[0], out[1:, :2], out[1:, 2] = start, drift(m, dt, angles, speeds, noise[:, :, None])[:, :, 0].T, depth
    out[:, :2] = np.cumsum(out[:, :2], axis=0)
    out[1:, 3:6] = np.radians(angles + noise[:, 0] * m.spread(angles, m.angle))
    out[1:, 6:] = speeds + noise[:, 1] * m.spread(speeds, m.velocity)
    return out


def particle_filter(rows: DataFrame, by: Sequence[str], particles: int = 300, seed: int = 0, velocity: StdModel = StdModel(0.05, 0.02), angle: StdModel = StdModel(0.1, 0.0), fix: StdModel = StdModel(5.0, 0.01), gain: float = 1.0) -> DataFrame:
    """Whole trajectory of the best particle: by..., t, northings, eastings, depth, roll, pitch, yaw, x/y/z_velocity, weight.

    Particles move by noisy measured speeds and angles; a fix weighs them by a Gaussian of their distance, and they are drawn
    anew when the effective number falls under half. Draws depend on the seed alone. Some dives at a time are stepped through
    side by side: first for who the best particle's ancestors are, then for the states of these alone."""
    names, by = STATE[:9], list(by)
    model = ParticleModel(particles, seed, velocity, angle, fix, gain)

    def filtered(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        part = part.assign(_dive=part.groupby(by, sort=False, dropna=False).ngroup()).sort_values(["_dive", "t", "kind", "a"], kind="stable").reset_index(drop=True)
        t, names_, v, s = _arrays(part)
        kind = np.array([ORDER[k] for k in names_])
        begin = [*np.flatnonzero(np.diff(part._dive.to_numpy(), prepend=-1)).tolist(), len(part)]
        dives = []
        for a, b in zip(begin, begin[1:], strict=False):
            t0, x0 = start_of(t[a:b], kind[a:b], v[a:b])
            if len(g := np.flatnonzero(kind[a:b] == ORDER["usbl"])):
                x0[:2] = v[a + g[0], :2]
            dives.append((a, t0, x0, a + np.flatnonzero((t[a:b] > t0) & (kind[a:b] != ORDER["query"]))))
        dives.sort(key=lambda d: -len(d[3]))
        done: list[tuple[int, np.ndarray, np.ndarray, float]] = []
        while len(done) < len(dives):
            wide = max(1, len(dives[len(done)][3]))
            some = dives[len(done) : len(done) + max(1, HELD // (wide * 6 * particles * 8))]
            count = np.array([len(d[3]) for d in some])
            when, what, value, std = np.zeros((len(some), wide)), np.zeros((len(some), wide), np.int8), np.zeros((len(some), wide, 3)), np.zeros((len(some), wide))
            for d, (*_, at) in enumerate(some):
                when[d, : len(at)], what[d, : len(at)], value[d, : len(at)], std[d, : len(at)] = t[at], kind[at], v[at], s[at, 0]
            given = (model, np.array([d[1] for d in some]), np.array([d[2] for d in some]), count, when, what, value, std)
            descent, w = run_particles(*given)
            best = np.argmax(w, axis=1)
            track = run_particles(*given, lines=[descent[d].line(int(best[d]), int(count[d]) + 1) for d in range(len(some))], descent=descent)
            done += [(some[d][0], np.array([some[d][1], *when[d, : count[d]]]), track[d], float(w[d, best[d]])) for d in range(len(some))]
        done.sort(key=lambda d: d[0])
        size = [len(d[1]) for d in done]
        out = part.iloc[np.repeat([d[0] for d in done], size)][by].reset_index(drop=True)
        out["t"] = np.concatenate([d[1] for d in done])
        out[names] = np.concatenate([d[2] for d in done])
        out[["roll", "pitch", "yaw"]] = np.degrees(out[["roll", "pitch", "yaw"]])
        out["weight"] = np.repeat([d[3] for d in done], size)
        yield out

    more = "t double, " + ", ".join(f"{c} double" for c in names) + ", weight double"
    needed = rows.select(*by, "t", "kind", "a", "b", "c", "a_std", "b_std", "c_std")
    return dealt(needed, by).sortWithinPartitions(*by).mapInPandas(side_by_side(filtered, by), _schema(rows, by, more))


def speed_filtered(rows: DataFrame, by: Sequence[str], t: str, lat: str, lon: str, most: float = 20.0) -> DataFrame:
    """Rows reached from the last accepted row at no more than ``most`` metres a second (on a sphere of 111139 m a degree)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t, kind="stable")
        keep, at = [], None
        for r in pdf[[t, lat, lon]].itertuples(index=False):
            ok = at is None or 111139 * math.hypot(r[1] - at[1], r[2] - at[2]) <= most * (r[0] - at[0])
            keep.append(ok)
            at = r if ok else at
        return pdf[keep]

    return rows.groupBy(*by).applyInPandas(run, rows.schema)


def relative_covariances(states: DataFrame, by: Sequence[str], t: str) -> DataFrame:
    """Covariances relative to the first row: the first is zero, the rest have the first's added, as the reference has it."""
    first = states.groupBy(*by).agg(F.min(F.struct(F.col(t), F.col("covariance"))).alias("_f"))
    both = states.join(first, list(by))
    added = F.zip_with("covariance", F.col("_f.covariance"), lambda a, b: a + b)
    zero = F.transform("covariance", lambda a: a * 0.0)
    return both.withColumn("covariance", F.when(F.col(t) == F.col(f"_f.{t}"), zero).otherwise(added)).drop("_f")


def latest_since(rows: DataFrame, by: Sequence[str], order: Sequence[str], emits: str, cols: Sequence[str]) -> DataFrame:
    """Rows where ``emits`` is true, with the latest non-null ``cols`` since the one before; null if there was none."""
    from fathomline.operators.windows import over, upto

    cut = rows.withColumn("_e", F.coalesce(F.lag(emits).over(over(by, *order)), F.lit(False)).cast("int"))
    cut = cut.withColumn("_run", F.sum("_e").over(upto(over(by, *order))))
    w = upto(over([*by, "_run"], *order))
    filled = cut.select(*[c for c in rows.columns if c not in cols], "_run", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in cols])
    return filled.filter(F.col(emits)).drop("_run")
