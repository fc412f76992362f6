import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fathomline.llm.token_counts import Counter, count_tokens
from tests.llm.helpers import HARD, LONG, SCHEMA, hard

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return Counter(VOCABULARY), Tokenizer.from_file(VOCABULARY)


def test_against_the_library(both):
    c, t = both
    rng = random.Random(9)
    texts = ["", " ", "<|endoftext|>a<|startoftext|>", "<|ENDOFTEXT|> <|endoftext", "İΣΣ σς ΑΣ", "é ́a", "x²½ ٣", "DON'T i'LL'd", "\x1c\x1fa\x85b​", "日本語テスト", "a" * 5000, LONG]
    texts += ["".join(rng.choice("aeinrst hTé.,1'\n") for _ in range(rng.randrange(1, 400))) for _ in range(500)]
    assert [c.text(x) for x in texts] == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_every_character_against_the_library(both):
    c, t = both
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for form in ("{0}", "a{0}b"):
        for k in range(0, len(points), 100_000):
            texts = [form.format(x) for x in points[k : k + 100_000]]
            want = [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
            assert [(x, c.text(x), n) for x, n in zip(texts, want, strict=True) if c.text(x) != n] == []


def test_rows(spark, both):
    df = hard(spark)
    rows = count_tokens(df, VOCABULARY).collect()
    assert len(rows) == len(HARD)
    got = {r["doc_id"]: r for r in rows}
    assert (got[2]["n_bytes"], got[2]["n_tokens"], got[2]["over_limit"]) == (0, 0, False)
    assert got[7]["over_limit"] and got[7]["n_bytes"] == len(LONG)
    assert count_tokens(spark.createDataFrame([], SCHEMA), VOCABULARY).count() == 0
