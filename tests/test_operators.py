import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import aggregates, filters, folds, geometry, images, interp, joins, sampling, windows


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_interpolation(spark):
    l = F.lit
    assert spark.range(1).select(interp.linear(l(150.0), l(100.0), l(200.0), l(100.0), l(200.0)).alias("v")).first()["v"] == 150.0
    q = rows(spark, [("a", t) for t in (0.0, 1.0, 1.5, 3.0, 9.0)], "dive string, t double")
    s = rows(spark, [("a", 1.0, 10.0), ("a", 2.0, 20.0), ("a", 4.0, 0.0)], "dive string, t double, v double")
    got = {r["t"]: r["v"] for r in interp.interpolated(q, s, ["dive"], "t", ["v"]).collect()}
    assert got == {0.0: 0.0, 1.0: 10.0, 1.5: 15.0, 3.0: 10.0, 9.0: -50.0}
    got = {r["t"]: r["v"] for r in interp.interpolated(q, s, ["dive"], "t", ["v"], extrapolate=False).collect()}
    assert got == {0.0: None, 1.0: 10.0, 1.5: 15.0, 3.0: 10.0, 9.0: None}
    assert {r["t"] for r in interp.forward_interpolated(q, s, ["dive"], "t", ["v"]).collect()} == {1.5, 3.0}


def test_dead_reckoning_of_a_circle(spark):
    n, w = 2000, 2 * math.pi / 200.0
    data = [("a", i * 0.1, math.cos(w * i * 0.1), math.sin(w * i * 0.1)) for i in range(n + 1)]
    d = windows.dead_reckoned(rows(spark, data, "dive string, t double, vn double, ve double"), ["dive"], "t", {"vn": "n", "ve": "e"})
    end = d.orderBy(F.col("t").desc()).first()
    assert end["n"] == pytest.approx(0, abs=1e-3) and end["e"] == pytest.approx(0, abs=1e-3)
    far = d.agg(F.max("e")).first()[0]
    assert far == pytest.approx(2 / w, rel=1e-4)


def test_nearest_with_ties(spark):
    l = rows(spark, [("a", 1.0, 1), ("a", 5.0, 2)], "g string, t double, k int")
    r = rows(spark, [("a", 0.98, 7), ("a", 1.02, 6), ("a", 5.06, 8)], "g string, t double, k int")
    got = {x["k"]: x["matched_k"] for x in joins.nearest(l, r, ["g"], "t", 0.05, "k", "k").collect()}
    assert got == {1: 7} or got == {1: 6}  # both are 0.02 away, but for rounding
    got = {x["k"]: x["matched_k"] for x in joins.nearest(l, r, ["g"], "t", 0.0625, "k", "k").collect()}
    assert got[2] == 8


def test_monotone_and_marks(spark):
    d = rows(spark, [("a", i, t, str(i)) for i, t in enumerate((1.0, 2.0, 2.0, 1.5, 3.0))], "dive string, seq int, t double, name string")
    assert [r["seq"] for r in windows.monotone(d, ["dive"], "seq", "t").orderBy("seq").collect()] == [0, 3, 4]
    assert [r["seq"] for r in filters.between_marks(d, ["dive"], "seq", "name", "1", "3").orderBy("seq").collect()] == [1, 2, 3]


def test_latest_since(spark):
    d = rows(spark, [("a", 1, False, 1.0), ("a", 2, True, None), ("a", 3, True, None), ("a", 4, False, 4.0), ("a", 5, True, None)], "dive string, seq int, e boolean, v double")
    got = {r["seq"]: r["v"] for r in folds.latest_since(d, ["dive"], ["seq"], "e", ["v"]).collect()}
    assert got == {2: 1.0, 3: None, 5: 4.0}


def test_clipped_running_stats_against_a_loop(spark):
    rng = np.random.default_rng(1)
    v = rng.random((50, 3))
    data = [(i, p, float(v[i, p])) for i in range(50) for p in range(3)]
    got = {r["pixel"]: r for r in aggregates.clipped_running_stats(rows(spark, data, "image_id int, pixel int, value double"), ["pixel"], "image_id", clip=0.9).collect()}
    for p in range(3):
        n, mean, m2 = 0, 0.0, 0.0
        for x in v[:, p]:
            x = mean if x > 0.9 else x
            n += 1
            new = mean + (x - mean) / n
            m2, mean = m2 + (x - mean) * (x - new), new
        assert got[p]["mean"] == pytest.approx(mean) and got[p]["std"] == pytest.approx(math.sqrt(m2 / n))


def measurements(spark, n=602, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        t = 1000.0 + i * 0.1
        out += [("a", t, "orientation", *rng.normal(0, 0.1, 3).tolist(), 0.1, 0.1, 0.1), ("a", t, "depth", float(rng.normal(5, 0.05)), None, None, 0.05, None, None),
                ("a", t, "velocity", *(np.array([0.1, 0.1, 0.0]) + rng.normal(0, 0.01, 3)).tolist(), 0.01, 0.01, 0.01)]
    return rows(spark, out, "dive string, t double, kind string, a double, b double, c double, a_std double, b_std double, c_std double")


@pytest.mark.parametrize("mode", ["matrix", "as_coded"])
def test_ekf_holds_a_steady_course(spark, mode):
    states = folds.ekf(measurements(spark), ["dive"], folds.EkfConfig(mahalanobis=30.0, smoother_mode=mode, smooth=mode == "matrix"))
    end = states.orderBy(F.col("t").desc()).first()
    assert abs(end["northings"] - 6.01) < 0.45 and abs(end["eastings"] - 6.01) < 0.45 and abs(end["depth"] - 5) < 0.2
    assert len(end["covariance"]) == 144
    report = {r["type"]: r for r in aggregates.accepted(folds.ekf_report(measurements(spark), ["dive"]), ["dive"]).collect()}
    assert report["velocity"]["total"] == 601 and report["velocity"]["dropped"] < 60


def test_motion_jacobian_is_the_derivative():
    x = np.array([1, 2, 3, 0.2, -0.3, 1.0, 0.5, -0.4, 0.3, 0.1, 0.05, -0.2])
    one = lambda y: folds.motion(y[None], np.array([0.7]))[0][0] @ y
    j = folds.motion(x[None], np.array([0.7]))[1][0]
    for k in range(12):
        h = np.zeros(12)
        h[k] = 1e-6
        assert np.allclose((one(x + h) - one(x - h)) / 2e-6, j[:, k], atol=1e-6)


def moved(x, dt):
    """The process model, spelt out: speeds are turned from the body to the earth, rates to angle rates."""
    r, p, y = x[3:6]
    about = lambda a, i, j: np.array([[1.0 if m == n and m not in (i, j) else math.cos(a) if m == n else -math.sin(a) if (m, n) == (i, j) else math.sin(a) if (m, n) == (j, i) else 0.0 for n in range(3)] for m in range(3)])
    turn = about(y, 0, 1) @ about(p, 2, 0) @ about(r, 1, 2)
    rates = np.array([[1, math.sin(r) * math.tan(p), math.cos(r) * math.tan(p)], [0, math.cos(r), -math.sin(r)], [0, math.sin(r) / math.cos(p), math.cos(r) / math.cos(p)]])
    out = x.copy()
    out[:3] += turn @ x[6:9] * dt
    out[3:6] += rates @ x[9:] * dt
    return out


def slope(x, dt):
    h = 1e-6 * np.eye(12)
    return np.array([(moved(x + e, dt) - moved(x - e, dt)) / 2e-6 for e in h]).T


def filtered_by_hand(events, t0, x0, c, smooth):
    """One measurement after the other: (t, kind, values, deviations), sorted; the textbook's formulas with numeric slopes."""
    wrap = lambda a: a if abs(a) <= math.pi else (a + math.pi) % (2 * math.pi) - math.pi
    q, p, x, now = np.diag(c.process_noise), np.array(c.initial_covariance), x0.copy(), t0
    p = np.diag(p) if p.ndim == 1 else p
    seen, states, report = {}, [(t0, x.copy(), p.copy())], []
    turns = []
    for t, kind, v, s in events:
        seen[t, kind] = seen.get((t, kind), -1) + 1
        turns.append((t, seen[t, kind], folds.ORDER[kind], kind, v, s))
    for (t, _), group in itertools.groupby(sorted((e for e in turns if e[0] > t0), key=lambda e: e[:3]), key=lambda e: e[:2]):
        j = slope(x, t - now)
        x, p, now = moved(x, t - now), j @ p @ j.T + (t - now) * q, t
        x[3:6] = [wrap(a) for a in x[3:6]]
        for *_, kind, v, s in group:
            if kind == "query":
                continue
            at = {"orientation": [3, 4, 5], "usbl": [0, 1], "depth": [2], "velocity": [6, 7, 8]}[kind]
            z = [math.radians(a) for a in v] if kind == "orientation" else list(v)
            sd = [math.radians(a) for a in s] if kind == "orientation" else list(s)
            use = [i for i in range(len(at)) if not math.isnan(z[i])]
            if not use:
                continue
            h = np.eye(12)[[at[i] for i in use]]
            r = np.diag([max(sd[i] ** 2, 1e-9) for i in use])
            gap = np.array([wrap(z[i] - x[at[i]]) if kind == "orientation" else z[i] - x[at[i]] for i in use])
            inv = np.linalg.inv(h @ p @ h.T + r)
            ok = gap @ inv @ gap < c.mahalanobis**2
            report.append((t, kind, bool(ok)))
            if ok:
                gain = p @ h.T @ inv
                x, p = x + gain @ gap, (np.eye(12) - gain @ h) @ p
                x[3:6] = [wrap(a) for a in x[3:6]]
        states.append((t, x.copy(), p.copy()))
    if smooth:
        for i in range(len(states) - 2, -1, -1):
            (t, x, p), (t1, xs, ps) = states[i], states[i + 1]
            j = slope(x, t1 - t)
            ahead = j @ p @ j.T + (t1 - t) * q
            gain = p @ j.T @ np.linalg.inv(ahead)
            gap = xs - moved(x, t1 - t)
            gap[3:6] = [math.atan2(math.sin(a), math.cos(a)) for a in gap[3:6]]
            states[i] = (t, x + gain @ gap, p + gain @ (ps - ahead) @ gain.T)
    return states, report


@pytest.mark.parametrize(("smooth", "cells"), [(False, 1 << 19), (True, 1 << 19), (True, 40)])
def test_filter_and_smoother_against_brute_force(spark, monkeypatch, smooth, cells):
    monkeypatch.setattr(folds, "CELLS", cells)
    rng = random.Random(5)
    nan = float("nan")
    dives = {"a": 60, "b": 7, "c": 25, "d": 1}
    data = []
    for d, n in dives.items():
        data += [(d, 10.0, "orientation", 1.0, 2.0, 170.0, 0.5, 0.5, 0.5), (d, 10.0, "velocity", 0.1, 0.0, 0.0, 0.1, 0.1, 0.1), (d, 10.0, "depth", 5.0, None, None, 0.2, None, None)]
        for i in range(n):
            t = 10.0 + rng.choice([0.5, 1.0, 1.5]) * (1 + i // 2)  # several at a moment
            kind = rng.choice(["orientation", "velocity", "depth", "usbl", "query"])
            v = {"orientation": [rng.gauss(0, 2), rng.gauss(0, 2), rng.choice([175.0, -175.0]) + rng.gauss(0, 2)], "velocity": [rng.gauss(0.3, 0.1), rng.gauss(0, 0.1), rng.choice([0.0, nan])], "depth": [rng.gauss(5, 0.3), None, None], "usbl": [rng.gauss(0, 1), rng.choice([rng.gauss(0, 1), 500.0]), 5.0], "query": [None] * 3}[kind]
            data.append((d, t, kind, *v, 0.5, 0.6, 0.7))
    df = rows(spark, data, "dive string, t double, kind string, a double, b double, c double, a_std double, b_std double, c_std double")
    c = folds.EkfConfig(smooth=smooth, initial_covariance=[0.1] * 12)
    got = {}
    for r in folds.ekf_steps(df, ["dive"], c).collect():
        got.setdefault(r["dive"], []).append(r)
    for d in dives:
        order = lambda e: (e[0], e[1], -math.inf if e[2][0] is None else e[2][0])
        events = sorted(((t, k, [nan if x is None else x for x in v][: 2 if k == "usbl" else 1 if k == "depth" else 3], s) for dd, t, k, *v, s1, s2, s3 in data if dd == d for s in [[s1, s2, s3]]), key=order)
        x0 = np.zeros(12)
        x0[2], x0[3:6], x0[6] = 5.0, np.radians([1.0, 2.0, 170.0]), 0.1
        states, report = filtered_by_hand(events, 10.0, x0, c, smooth)
        mine = sorted(got[d], key=lambda r: r["t"])
        assert len(mine) == len(states)
        deg = np.array([1, 1, 1, *[180 / math.pi] * 3, 1, 1, 1, *[180 / math.pi] * 3])
        steps = [(r["t"], np.array([r[n] for n in folds.STATE]) / deg, np.array(r["covariance"]).reshape(12, 12)) for r in got[d]]
        for (t, x, p), (t1, x1, p1) in zip(states, steps, strict=True):
            assert t == t1 and np.allclose(x, x1, atol=1e-5) and np.allclose(p, p1, atol=1e-5)
        flat = [(r["t"], m["type"], m["valid"]) for r in got[d] for m in r["report"]]
        assert flat == report


def particles_by_hand(events, particles, seed, velocity=(0.05, 0.02), angle=(0.1, 0.0), fix=(5.0, 0.01)):
    """One dive (t, kind, values, deviation), in order, with the whole history of every particle."""
    rng = np.random.default_rng(seed)
    t0, x0 = folds.start_of(np.array([e[0] for e in events]), np.array([folds.ORDER[e[1]] for e in events]), np.array([e[2] for e in events], float))
    if fixes := [e for e in events if e[1] == "usbl"]:
        x0[:2] = fixes[0][2][:2]
    x = np.repeat(x0[None, :9], particles, axis=0)
    x[:, :2] += rng.normal(0, fix[0], (particles, 2))
    history, times, w = x[None].copy(), [t0], np.full(particles, 1 / particles)
    now = {"orientation": np.degrees(x0[3:6]), "velocity": x0[6:9], "depth": x0[2:3]}
    for t, kind, v, s in events:
        if t <= t0 or kind == "query":
            continue
        now[kind] = np.array(v, float)
        r, p, y = np.radians(now["orientation"] + rng.normal(size=(particles, 3)) * (np.abs(now["orientation"]) * angle[1] + angle[0])).T
        vel = now["velocity"] + rng.normal(size=(particles, 3)) * (np.abs(now["velocity"]) * velocity[1] + velocity[0])
        for i in range(particles):
            rx = np.array([[1, 0, 0], [0, math.cos(r[i]), -math.sin(r[i])], [0, math.sin(r[i]), math.cos(r[i])]])
            ry = np.array([[math.cos(p[i]), 0, math.sin(p[i])], [0, 1, 0], [-math.sin(p[i]), 0, math.cos(p[i])]])
            rz = np.array([[math.cos(y[i]), -math.sin(y[i]), 0], [math.sin(y[i]), math.cos(y[i]), 0], [0, 0, 1]])
            x[i, :2] += (t - times[-1]) * (rz @ ry @ rx @ vel[i])[:2]
        x[:, 2], x[:, 3:6], x[:, 6:9] = now["depth"][0], np.stack([r, p, y], 1), vel
        history = np.concatenate([history, x[None]])
        times.append(t)
        if kind == "usbl":
            d = np.sqrt(((x[:, :2] - v[:2]) ** 2).sum(axis=1) + (0 if math.isnan(v[2]) else (x[:, 2] - v[2]) ** 2))
            w = w * np.exp(-0.5 * (d / (s if s > 0 else fix[0] + fix[1] * math.hypot(*v[:2]))) ** 2) + 1e-300
            w = w / w.sum()
            if 1 / (w**2).sum() < particles / 2:
                drawn = np.minimum(np.searchsorted(np.cumsum(w), (np.arange(particles) + rng.random()) / particles), particles - 1)
                history, w = history[:, drawn], np.full(particles, 1 / particles)
                x = history[-1].copy()
    return times, history[:, int(np.argmax(w))]


@pytest.mark.parametrize("cells", [1 << 16, 40])
def test_particle_filter_against_whole_histories(spark, monkeypatch, cells):
    monkeypatch.setattr(folds, "CELLS", cells)
    rng = random.Random(9)
    nan, data = float("nan"), []
    for d, n in {"a": 70, "b": 12, "c": 40, "d": 0}.items():
        data += [(d, 10.0, "depth", 5.0, None, None, None), (d, 10.0, "orientation", 1.0, 2.0, 70.0, None), (d, 10.0, "velocity", 0.5, 0.0, 0.0, None)]
        for i in range(n):
            kind = rng.choice(["orientation", "velocity", "depth", "usbl", "usbl", "query"])
            v = {"orientation": [1.0, 2.0, rng.gauss(70, 9)], "velocity": [rng.gauss(0.5, 0.1), 0.0, 0.0], "depth": [5.0, None, None], "usbl": [0.2 * i, 0.4 * i, rng.choice([5.0, None])], "query": [None] * 3}[kind]
            data.append((d, 11.0 + i, kind, *v, rng.choice([1.0, None])))
    df = rows(spark, [(*r, None, None) for r in data], "dive string, t double, kind string, a double, b double, c double, a_std double, b_std double, c_std double")
    got = {}
    for r in folds.particle_filter(df.repartition(5), ["dive"], particles=50, seed=4).collect():
        got.setdefault(r["dive"], []).append(r)
    for d in "abcd":
        events = [(t, k, [nan if x is None else x for x in v], s or 0.0) for dd, t, k, *v, s in data if dd == d]
        times, track = particles_by_hand(events, 50, 4)
        assert [r["t"] for r in got[d]] == times
        assert np.allclose([[r[c] for c in folds.STATE[:3]] + [math.radians(r[c]) for c in folds.STATE[3:6]] + [r[c] for c in folds.STATE[6:9]] for r in got[d]], track, atol=1e-9)


def test_dead_branches_are_pruned():
    rng = np.random.default_rng(1)
    d, whole = folds.Descent(), []
    for i in range(3000):
        parents = np.sort(rng.integers(0, 300, 300))
        d.draw(3 * i + 1, parents)
        whole.append(parents)
    assert len(d) < 3000 * 2 + 300 * 300  # of 2 x 900,000
    line, at = d.line(17, 9001), 17
    for i in range(2999, -1, -1):
        assert (line[3 * i + 1 : 3 * i + 4] == at).all()
        at = whole[i][at]
    assert line[0] == at


def test_the_memory_of_a_long_dive_holds_no_histories():
    """Bytes held while 20,000 measurements pass: 500,000 take 25 times that, or less than 500 MB."""
    import tracemalloc

    n = 20_000
    t = 10.0 + np.arange(n)
    kind = np.where(np.arange(n) % 10 == 0, folds.ORDER["usbl"], folds.ORDER["velocity"])
    v = np.stack([0.5 * np.arange(n), np.zeros(n), np.full(n, np.nan)], 1)
    v[kind == folds.ORDER["velocity"]] = [0.5, 0.0, 0.0]
    model = folds.ParticleModel(300, 0, folds.StdModel(0.05, 0.02), folds.StdModel(0.1, 0.0), folds.StdModel(5.0, 0.01), 1.0)
    given = (model, np.array([9.0]), np.zeros((1, 12)), np.array([n]), t[None], kind[None], v[None], np.full((1, n), 1.0))
    tracemalloc.start()
    descent, w = folds.run_particles(*given)
    track = folds.run_particles(*given, lines=[descent[0].line(int(np.argmax(w[0])), n + 1)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak * 25 < 500e6 and len(descent[0].steps) > 100 and track[0].shape == (n + 1, 9)
    assert abs(track[0][-1, 0] - 0.5 * n) < 20


def test_poses_relative_to_the_first_image(spark):
    rng = random.Random(2)
    nan, data, images_ = float("nan"), [], []
    for d, n in {"a": 60, "b": 30, "c": 20}.items():
        data += [(d, 10.0, "orientation", 1.0, 2.0, 30.0, 0.5, 0.5, 0.5), (d, 10.0, "velocity", 0.1, 0.0, 0.0, 0.1, 0.1, 0.1), (d, 10.0, "depth", 5.0, None, None, 0.2, None, None)]
        for i in range(n):
            kind = rng.choice(["orientation", "velocity", "depth"])
            v = {"orientation": [rng.gauss(0, 2), rng.gauss(0, 2), rng.gauss(30, 2)], "velocity": [rng.gauss(0.3, 0.1), 0.0, 0.0], "depth": [5.0, None, None]}[kind]
            data.append((d, 11.0 + i, kind, *v, 0.5, 0.6, 0.7))
        if d != "c":
            images_ += [(d, 20.5 + k) for k in range(0, n - 15, 3)]
    schema = "dive string, t double, kind string, a double, b double, c double, a_std double, b_std double, c_std double"
    df, images_df = rows(spark, data, schema), rows(spark, images_, "dive string, t double")
    for smooth in (False, True):
        c = folds.EkfConfig(smooth=smooth, initial_covariance=[0.1] * 12)
        got = {}
        for r in folds.relative_ekf(df, ["dive"], images_df, c).collect():
            got.setdefault(r["dive"], []).append(r)
        assert set(got) == {"a", "b"}
        for d in got:
            order = lambda e: (e[0], e[1])
            own = [t for dd, t in images_ if dd == d]
            events = sorted([(t, k, [nan if x is None else x for x in v][: 1 if k == "depth" else 3], s) for dd, t, k, *v, s1, s2, s3 in data if dd == d for s in [[s1, s2, s3]]] + [(t, "query", [nan] * 3, [0.0] * 3) for t in own], key=order)
            x0 = np.zeros(12)
            x0[2], x0[3:6], x0[6] = 5.0, np.radians([1.0, 2.0, 30.0]), 0.1
            states, _ = filtered_by_hand(events, 10.0, x0, c, smooth)
            begin = next(x for t, x, _ in states if t == own[0])
            p0 = np.diag([0.0] * 6 + [0.1] * 6)
            again = folds.EkfConfig(smooth=smooth, initial_covariance=p0)
            states, _ = filtered_by_hand([e for e in events if e[0] <= own[-1]], own[0] - 1e-6, begin, again, smooth)
            want = {t: (x, p) for t, x, p in states}
            assert [r["t"] for r in got[d]] == own
            for r in got[d]:
                assert np.allclose(np.array(r["covariance"]).reshape(12, 12), want[r["t"]][1], atol=1e-5) and abs(r["northings"] - want[r["t"]][0][0]) < 1e-5
            spread = [np.trace(np.array(r["covariance"]).reshape(12, 12)[:2, :2]) for r in got[d]]
            assert spread[0] < 1e-6 and spread[-1] > spread[1] > spread[0]


def test_particle_filter_follows_fixes(spark):
    m = measurements(spark, 200)
    fixes = rows(spark, [("a", 1000.0 + 2 * i, "usbl", 0.2 * i, 0.2 * i, 5.0, 0.1, 0.1, 0.1) for i in range(10)], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in m.schema))
    p = folds.particle_filter(m.unionByName(fixes), ["dive"], particles=200, seed=3)
    end = p.orderBy(F.col("t").desc()).first()
    assert abs(end["northings"] - 2.0) < 0.6 and abs(end["eastings"] - 2.0) < 0.6
    again = folds.particle_filter(m.unionByName(fixes), ["dive"], particles=200, seed=3).orderBy(F.col("t").desc()).first()
    assert end["northings"] == again["northings"]


def test_exponential_fit_finds_its_curve(spark):
    data = [(0, p, d / 10, (0.5 + p / 10) * math.exp(-0.4 * d / 10) + 0.05) for p in range(3) for d in range(5, 60)]
    got = images.fit_attenuation(rows(spark, data, "channel int, pixel int, distance double, intensity double")).orderBy("pixel").collect()
    for p, r in enumerate(got):
        assert r["a"] == pytest.approx(0.5 + p / 10, rel=0.05) and r["b"] == pytest.approx(-0.4, rel=0.1) and abs(r["c"] - 0.05) < 0.02


def plain_fit(d, v):
    """The curve of one key, its samples side by side with all decays of a grid."""
    def curves(b):
        e, w, top = np.exp(b[:, None] * d), np.ones((len(b), len(d))), float(v.min())
        for _ in range(8):
            s, sx, sy = w.sum(axis=1), (w * e).sum(axis=1), (w * v).sum(axis=1)
            sxx, sxy = (w * e * e).sum(axis=1), (w * e * v).sum(axis=1)
            det = s * sxx - sx * sx
            flat = det <= 1e-12
            c = np.clip(np.where(flat, 0.0, (sxx * sy - sx * sxy) / np.where(flat, 1, det)), 0.0, top)
            a = np.maximum((sxy - c * sx) / np.maximum(sxx, 1e-300), 1e-6)
            w = 1 / np.sqrt(1 + (v - a[:, None] * e - c[:, None]) ** 2)
        return a, c, (2 * (np.sqrt(1 + (v - a[:, None] * e - c[:, None]) ** 2) - 1)).sum(axis=1)

    grid = np.concatenate([-np.geomspace(10, 1e-3, 40), [0.0]])
    for _ in range(4):
        a, c, cost = curves(grid)
        i = int(np.argmin(cost))
        best = float(a[i]), float(grid[i]), float(c[i])
        grid = np.linspace(grid[max(i - 1, 0)], grid[min(i + 1, len(grid) - 1)], 21)
    return best


@pytest.mark.parametrize("hot", [100_000, 40])
def test_exponential_fit_on_sums_is_the_plain_one(spark, monkeypatch, hot):
    monkeypatch.setattr(images, "HOT", hot)
    rng = np.random.default_rng(5)
    truth = {0: (0.8, -0.3, 0.05), 1: (3.0, -1.2, 0.2), 2: (0.4, -0.02, 0.1)}
    data = [(0, p, float(d), float(a * np.exp(b * d) + c + rng.normal() * 0.005)) for p, (a, b, c) in truth.items() for d in rng.uniform(0.5, 8, 120)]
    data += [(0, 0, 3.0, 20.0)] * 3  # far off, and repeated
    used = [r for r in data if r[3] > 0]
    data += [(0, 0, None, 1.0), (0, 1, 2.0, None), (0, 2, 2.0, float("nan")), (0, 2, -1.0, 5.0), (0, 3, 1.0, -1.0), (None, 0, 1.0, 1.0)]
    samples = rows(spark, data, "channel int, pixel int, distance double, intensity double")
    out = images.fit_attenuation(samples)
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString() and "Python" not in out._jdf.queryExecution().toString()
    got = {r["pixel"]: (r["a"], r["b"], r["c"]) for r in out.collect()}
    assert set(got) == {0, 1, 2, 3} and got[3] == (1.0, 0.0, 0.0)
    for p in truth:
        d, v = (np.array([r[i] for r in used if r[1] == p]) for i in (2, 3))
        a, b, c = plain_fit(d, v)
        near = np.linspace(0.5, 8, 50)
        assert np.abs((got[p][0] * np.exp(got[p][1] * near) + got[p][2]) - (a * np.exp(b * near) + c)).max() < 1e-4
        assert got[p] == pytest.approx((a, b, c), abs=2e-3)
    assert images.fit_attenuation(samples.limit(0)).count() == 0


def test_planes(spark):
    rng = np.random.default_rng(2)
    yz = rng.random((200, 2)) * 4
    data = [("a", float(1.58 + 0.01 * y), float(y), float(z)) for y, z in yz]
    p = geometry.fit_planes(rows(spark, data, "g string, x double, y double, z double"), ["g"]).first()
    n = np.array([p["a"], p["b"], p["c"]])
    assert abs(n[0]) > 0.99 and p["inliers"] == 200
    d = rows(spark, data, "g string, x double, y double, z double").select(geometry.point_plane(p["a"], p["b"], p["c"], p["d"]).alias("d")).agg(F.max("d")).first()[0]
    assert d < 1e-6
    m = geometry.plane_from_moments(geometry.plane_moments(rows(spark, data, "g string, x double, y double, z double"), ["g"]).first())
    assert np.allclose(np.abs(m[:3]), np.abs(n), atol=1e-6)
    r = rows(spark, [(0.9, 0.0, 0.1)], "a double, b double, c double").select(geometry.plane_angles(F.col("a"), F.col("b"), F.col("c"))[0].alias("p")).first()["p"]
    assert r == pytest.approx(6.34019174590991)


def test_samples(spark):
    d = rows(spark, [("a", i, i / 100) for i in range(1000)], "g string, k int, z double")
    s = sampling.z_stratified(d, ["g"], "z", "k", bins=10, most=3)
    assert s.count() == 30 and sorted(s.collect()) == sorted(sampling.z_stratified(d, ["g"], "z", "k", bins=10, most=3).collect())
    e = [r["k"] for r in sampling.evenly_spaced(d, ["g"], "k", 10).orderBy("k").collect()]
    assert len(e) == 10 and max(np.diff(e)) <= 101
    assert sampling.evenly_spaced(d.limit(5), ["g"], "k", 10).count() == 5


def test_images(spark):
    mosaic = np.array([[240, 120, 240], [120, 60, 120], [60, 30, 60]], np.float32)[:, :, None] / 255
    out = images.debayer(mosaic, "rggb")
    assert out.shape == (3, 3, 3) and out[1, 1, 2] == pytest.approx(60 / 255, abs=1e-3)
    small = images.rescale(np.zeros((1000, 1000, 3)), 1.0, 1000.0, 1000.0, 0.03)
    assert small.shape[:2] == (33, 33)
    assert images.rescale(np.zeros((100, 100, 1)), 1.0, 1000.0, 1000.0, 0.03, True).shape[:2] == (100, 100)
    flat = np.random.default_rng(0).random((20, 30, 1))
    assert np.allclose(images.undistort(flat, np.array([[50, 0, 15], [0, 50, 10], [0, 0, 1.0]]), [0, 0, 0, 0, 0]), flat)


def test_debayer_follows_edges():
    mosaic = np.array([[240, 120, 240], [120, 60, 120], [60, 30, 60]], np.float32)[:, :, None] / 255
    for pattern, want in {"rggb": (150, 120, 60), "bggr": (60, 120, 150), "grbg": (75, 60, 120), "gbrg": (120, 60, 75)}.items():
        assert np.allclose(images.debayer(mosaic, pattern)[1, 1] * 255, want) and np.allclose(images.debayer(mosaic, pattern.upper())[1, 1] * 255, want)
    step = np.where(np.arange(8) < 5, 0.2, 0.9)[None, :].repeat(8, axis=0)[:, :, None]  # an upright edge of grey
    for pattern in ("rggb", "grbg", "bggr", "gbrg"):
        sharp, soft = images.debayer(step, pattern)[:, :, 1], images.debayer(step, pattern, edges=False)[:, :, 1]
        assert np.allclose(sharp[1:-1, 1:-1], step[1:-1, 1:-1, 0]) and not np.allclose(soft[1:-1, 1:-1], step[1:-1, 1:-1, 0])
    with pytest.raises(ValueError, match="no Bayer"):
        images.debayer(mosaic, "rgbg")


KERNELS = ["bicubic", "bilinear", "nearest_neighbour", "lanczos"]


@pytest.mark.parametrize("method", KERNELS)
def test_rescaling_kernels(method):
    rng = np.random.default_rng(8)
    image = rng.random((40, 30, 3))
    assert images.rescale(np.zeros((1000, 1000, 3)), 1.0, 1000.0, 1000.0, 0.03, method=method).shape == (33, 33, 3)
    assert images.rescale(np.zeros((1000, 1000, 3)), 1.0, 1000.0, 1000.0, 0.03, True, method).shape == (1000, 1000, 3)
    assert np.allclose(images.resized(image, 40, 30, method), image)  # the same size is the same image
    flat = np.full((17, 23, 2), 0.7)
    for h, w in ((5, 6), (50, 60), (1, 1), (17, 3)):
        assert np.allclose(images.resized(flat, h, w, method), 0.7)
    # against a plain sum over all samples
    k = {"bilinear": lambda x: max(1 - abs(x), 0), "bicubic": lambda x: 1.5 * abs(x) ** 3 - 2.5 * x * x + 1 if abs(x) < 1 else -0.5 * abs(x) ** 3 + 2.5 * x * x - 4 * abs(x) + 2 if abs(x) < 2 else 0,
         "lanczos": lambda x: 1 if x == 0 else math.sin(math.pi * x) / (math.pi * x) * math.sin(math.pi * x / 3) / (math.pi * x / 3) if abs(x) < 3 else 0}
    for m in (13, 95):
        if method == "nearest_neighbour":
            assert np.array_equal(images.resized(image, 40, m, method), image[:, [int((i + 0.5) * (30 / m)) for i in range(m)]])
            continue
        wide = max(30 / m, 1)
        weight = np.array([[k[method]((j + 0.5 - (i + 0.5) * (30 / m)) / wide) for j in range(30)] for i in range(m)])
        reach = {"bilinear": 1, "bicubic": 2, "lanczos": 3}[method] * wide
        weight *= [[int(max((i + 0.5) * (30 / m) - reach + 0.5, 0)) <= j < int((i + 0.5) * (30 / m) + reach + 0.5) for j in range(30)] for i in range(m)]
        assert np.allclose(images.resized(image, 40, m, method), np.einsum("ij,hjc->hic", weight / weight.sum(axis=1, keepdims=True), image))
    closer = images.rescale(image, 2.0, 10.0, 10.0, 0.1, True, method)  # twice as fine: the middle half fills the image
    assert closer.shape == image.shape and np.allclose(closer, images.resized(image[10:30, 7:23], 40, 30, method))


def test_unknown_kernels_are_refused():
    with pytest.raises(ValueError, match="no kernel"):
        images.resized(np.zeros((3, 3, 1)), 2, 2, "box")


def test_speed_filter_compares_with_the_last_accepted(spark):
    d = rows(spark, [("a", 0.0, 0.0, 0.0), ("a", 1.0, 1.0, 0.0), ("a", 2.0, 0.0001, 0.0), ("a", 3.0, 0.0002, 0.0)], "dive string, t double, lat double, lon double")
    assert folds.speed_filtered(d, ["dive"], "t", "lat", "lon").count() == 3


def test_rejected_views(spark):
    v = rows(spark, [(0.1,)] * 30 + [(5.0,)], "e double")
    assert filters.rejected_views(v, "e").count() == 30
