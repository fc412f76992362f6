import numpy as np

from fathomline.llm import toxicity as tx


def test_words_are_judged_once(monkeypatch):
    """Plain words are searched for double letters once, and words without a weight are looked up once; results stay."""
    searched, doubled, looked, features = [], tx.DOUBLED, [], tx.features

    class Counting:
        def search(self, run):
            searched.append(run)
            return doubled.search(run)

    monkeypatch.setattr(tx, "DOUBLED", Counting())
    monkeypatch.setattr(tx, "features", lambda word: looked.append(word) or features(word))
    model = tx.language_model(np.zeros(tx.SIZE**4))
    r, c = tx.Restorer(model), tx.Classifier({"idiot.": 2.0, "pat": 1.0}, -1.0)
    text = "an idiot sat there patiently with a pathetic letter"
    first = r.words(text)
    scored = c.score(first)
    times, lookups = len(searched), len(looked)
    assert r.words(text) == first == set(text.split()) | r.words("letter") and len(searched) == times
    assert c.score(first) == scored == float(1 / (1 + np.exp(-(-1.0 + 2.0 + 2.0)))) and len(looked) == lookups == len(first)
    assert len(c.silent) == len(first) - 3
    # a bound on what is remembered changes nothing
    monkeypatch.setattr(tx, "REMEMBERED", 2)
    r, c = tx.Restorer(model), tx.Classifier({"idiot.": 2.0, "pat": 1.0}, -1.0)
    assert r.words(text) == first and c.score(first) == scored and len(r.plain) <= 2 and len(c.of) + len(c.silent) <= 2
