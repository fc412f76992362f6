import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fathomline.llm import exact_dedup
from tests.llm.helpers import HARD, SCHEMA, hard


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, "" if i is None else i))
    out = []
    for i, text in rows:
        n = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        _, none, least = min(groups[n])
        out.append((i, None if none else least, len(groups[n]), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def run(docs, **more):
    rows = exact_dedup.exact_duplicates(docs, **more).collect()
    kept = {}
    for r in rows:
        kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert all(v == 1 for v in kept.values())
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str)


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1]) for r in HARD] + [(20 + i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_against_brute_force(docs, rows):
    assert run(docs) == brute(rows)


@pytest.mark.parametrize("waves", [1, 5])
def test_state_carries_over_between_batches(docs, rows, waves):
    assert run(docs, waves=waves) == brute(rows)


@pytest.mark.parametrize("waves", [1, 4])
def test_colliding_digests_are_split_by_bytes(docs, rows, waves):
    assert run(docs, waves=waves, digest=lambda sha: F.substring(sha, 1, 1)) == brute(rows)


def test_many_hits_and_hot_digests(docs, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 2)
    assert run(docs) == brute(rows)
    assert run(docs, digest=lambda sha: F.substring(sha, 1, 1)) == brute(rows)
    monkeypatch.undo()
    monkeypatch.setattr(exact_dedup, "HOT", 3)
    assert run(docs) == brute(rows)
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 2)  # more hot digests than are broadcast
    assert run(docs) == brute(rows)


def test_clashing_columns_and_other_types_of_id(spark):
    rows = [(r[0], r[1]) for r in HARD]
    assert run(hard(spark)) == brute(rows)
    words = [(None if i is None else f"id{i}", t) for i, t in rows]
    text = spark.createDataFrame(words, "doc_id string, text string")
    got = run(text)
    assert got == brute(words)


def test_runs_add_up_and_stopped_runs_go_on(spark, rows, tmp_path, monkeypatch):
    at = str(tmp_path / "state")
    df = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    first, second = rows[:30], rows[30:]
    assert run(df(first), state_dir=at, run="a") == brute(first)
    # the second run stops in the middle of its first wave, twice in different places
    for name in ("settle", "stream_wave"):
        def broken(*_, **__):
            raise RuntimeError("stopped")

        monkeypatch.setattr(exact_dedup, name, broken)
        with pytest.raises(Exception):
            exact_dedup.exact_duplicates(df(second), state_dir=at, run="b")
        monkeypatch.undo()
    assert run(df(second), state_dir=at, run="b") == brute(rows)
    assert run(df(second), state_dir=at, run="b") == brute(rows)  # nothing twice


def test_nothing_is_left_behind(spark, docs):
    from fathomline.llm.common import exists, shared_dir

    before = exists(spark, f"{shared_dir(spark)}/dedup-*")
    run(docs)
    assert exists(spark, f"{shared_dir(spark)}/dedup-*") == before


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_earlier_waves_are_read_by_locator(spark, monkeypatch, tmp_path):
    """Of twenty waves, each reads the files of its own rows and those that hold what its hits were first."""
    read = []
    plain = exact_dedup.Store.rows
    monkeypatch.setattr(exact_dedup.Store, "rows", lambda self, reader, *files: read.append(files) or plain(self, reader, *files))
    # text i comes in run i and again in run i + 1; nothing else repeats
    at, every = str(tmp_path / "state"), []
    for i in range(20):
        part = [(100 * i + k, f"own {i} {k}") for k in range(5)] + [(100 * i + 50, f"shared {i}"), (100 * i + 51, f"shared {i - 1}")]
        every += part
        store = exact_dedup.Store(spark, at, spark.createDataFrame(part, "doc_id long, text string").schema[0].dataType)
        exact_dedup.ingest(spark.createDataFrame(part, "doc_id long, text string").coalesce(1), store, run=str(i), waves=1)
    found = exact_dedup.groups(store).collect()
    assert sorted(((r["id"], r["keep_id"], r["n"], r["sha"]) for r in found), key=str) == brute(every)
    earlier = [f for f in read if f]
    assert len(earlier) == 19 and all(len(f) == 1 for f in earlier)  # a file each, however many waves there have been
