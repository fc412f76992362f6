import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from fathomline.llm.pieces import Encoder, encoded
from tests.llm.helpers import LONG, SCHEMA, hard

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return Encoder(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def split(ids, begin):
    return [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)]


def test_against_the_library(both):
    e, sp = both
    rng = random.Random(8)
    texts = ["", None, " ", "   ", "a", "Hello  world", " lead", "trail ", "a\nb\tc\r\n", "▁x ▁▁", "\0a b\0\0c", "<s>x</s><0x41>", "ﬁ Å é", "日本語テスト😀 𝒳", "\U0010ffff", "a" * 3000, LONG]
    texts += ["".join(rng.choice("aeinrst hTé.,1 ") for _ in range(rng.randrange(1, 300))) for _ in range(300)]
    ids, begin = e.encode(texts)
    for t, got, back in zip(texts, split(ids, begin), e.decode(ids, begin), strict=True):
        assert got == sp.encode(t or ""), t
        assert back == sp.decode(got)
        assert back == (t or "").replace("▁", " ")


def test_long_words_are_indexed_by_windows(both, monkeypatch):
    from fathomline.llm import pieces

    e, sp = both
    monkeypatch.setattr(pieces, "INDEXED", 40)
    e.forget()
    rng = random.Random(9)
    texts = ["".join(rng.choice("aeinrsthTé1日") for _ in range(n)) for n in (39, 40, 41, 80, 81, 500, 4000)] + ["the" * 100, "a" * 1000]
    ids, begin = e.encode(texts)
    for t, got in zip(texts, split(ids, begin), strict=True):
        assert got == sp.encode(t), t


def test_portions_hold_all_rows(monkeypatch):
    import pyarrow as pa

    from fathomline.llm import pieces

    monkeypatch.setattr(pieces, "CHARACTERS", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n if n >= 0 else None for n in (3, 30, 0, -1, 5, 5, 1, 12, 12)]})
    parts = [b.column(0).to_pylist() for b in pieces.portions(batch, 0)]
    assert sum(parts, []) == batch.column(0).to_pylist()
    assert all(len(x) == 1 or sum(len(t or "") for t in x) <= 10 for x in parts)
    assert list(pieces.portions(batch.slice(0, 0), 0)) == []


def test_forgetting_words_changes_nothing(both):
    e, sp = both
    a = split(*e.encode(["some words here", "and there"]))
    e.forget()
    assert split(*e.encode(["some words here", "and there"])) == a == [sp.encode("some words here"), sp.encode("and there")]


def test_all_pieces_are_found_by_the_index(both):
    e, _ = both
    start, end, ids, place, begin, lens = e.edges(["banana", "nab"])
    text = "banana\0nab"
    want = {(i, i + len(p), e.v.score[p][1]) for p in e.v.score for i in range(len(text)) if text.startswith(p, i)}
    assert set(zip(start.tolist(), end.tolist(), ids.tolist(), strict=True)) == want
    assert np.all(np.diff(place) >= 0)


def test_rows(spark, both):
    df = hard(spark)
    out = encoded(df, MODEL)
    rows = out.collect()
    assert len(rows) == df.count() and out.columns[: len(df.columns)] == df.columns and out.columns[-3:] == ["n_pieces", "piece_ids", "round_trip"]
    assert all(r["round_trip"] and r["n_pieces"] == len(r["piece_ids"]) for r in rows)
    assert encoded(spark.createDataFrame([], SCHEMA), MODEL, ["doc_id"]).count() == 0
    taken = encoded(df.withColumnRenamed("size", "n_pieces"), MODEL)
    assert taken.columns[-3] == "n_pieces_"
