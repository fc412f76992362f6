"""Each query with SQL must give the same rows in DuckDB."""

import glob
import os

import pytest

from fathomline.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def norm(rows, cols):
    show = lambda v: f"{v + 0.0:.6f}".replace("-0.000000", "0.000000") if isinstance(v, float) else str(v)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not glob.glob(f"{SF}/*"), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = duck.execute(ORACLE_SQL[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(got.fetchall(), cols)


def test_the_particle_query_has_as_many_particles_as_the_operator(monkeypatch):
    from inspect import signature

    from fathomline import queries as q

    seen = {}
    default = signature(q.folds.particle_filter).parameters["particles"].default
    monkeypatch.setattr(q, "measurements", lambda spark, sf_dir: None)
    monkeypatch.setattr(q.folds, "particle_filter", lambda rows, by, particles=default: seen.update(n=particles))
    q.QUERIES["particle"](None, "")
    assert seen == {"n": 300}
