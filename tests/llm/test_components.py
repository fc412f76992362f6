import random

import pytest

from fathomline.llm import components as c


def brute(edges):
    root = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = root[a], root[b]
        root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    return root


@pytest.mark.parametrize("portion", [10, 50_000])
def test_portions(spark, monkeypatch, portion):
    """A graph of one portion takes no round; any number of portions gives the same roots."""
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(-12, 12)] + [(rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(15)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges if a != b] + [(2**63 - 1, -(2**63))]
    rng.shuffle(edges)
    rounds = []
    monkeypatch.setattr(c, "PORTION", portion)
    monkeypatch.setattr(c, "swept", lambda _: rounds.append(1))
    got = [tuple(r) for r in c.components(spark.createDataFrame([*edges, (500, 500)], "a long, b long")).collect()]
    assert dict(got) == brute(edges) and len(got) == len(brute(edges))
    assert bool(rounds) == (portion == 10)
    assert c.components(spark.createDataFrame([], "a long, b long")).count() == 0
