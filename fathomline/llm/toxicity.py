"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Words may be disguised: signs for letters (leetspeak), letters spaced out, letters repeated. Any run that holds such a
sign or a doubled letter, and any passage of three single letters or more, becomes a lattice: each may be read as itself or as the letters its sign stands for, a separator
between single letters may be nothing, a repeated letter may be nothing. The best path by channel costs and a character
language model is found by Viterbi decoding; states are the last three characters. All other text has one reading, numbers too.
Runs that have double letters only, and spaced passages, count as they are written as well.

The language model (four characters) is counted over all documents, whole. The classifier is a logistic regression on
the words of a restored text and their beginnings (how many different words have each, up to ``TIMES``). An L1 penalty
first finds those that others don't explain; weights are then fitted to these alone. It is fitted on at most ``SAMPLE``
labelled ids, those with the least hash of their id, each with one text (the least, if rows repeat the id), and its
words and beginnings are at most ``WORDS``: both bound the classifier, whatever the input. Nothing else is sampled.
Labels of held-out rows, languages, sources and ids never reach a score.

Defined results: null and empty texts get the score of a text without words; repeated rows score alike; rows without a
doc_id aren't held out; an id that labels repeat is toxic if one of its labels says so; without any toxic label nothing is predicted toxic; an empty table gives an empty result. Other
columns don't matter, whatever their names; ``rejected_toxic`` keeps all columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import cut, packed, picked, small_or_not, tidied

#: Labelled ids that the classifier is fitted on, and words and beginnings that it knows, at most.
SAMPLE = 20_000
WORDS = 400
#: Words and beginnings that take part must be in this many toxic sampled texts.
SEEN = 3
#: Lengths of beginnings.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
TIMES = 3
#: Runs and words that a task remembers.
REMEMBERED = 150_000

# What signs may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = " .-_*/"
#: Costs in nats of the channel: a sign for a letter, a sign as itself, a separator left out, a repetition left out, a
#: second letter of a kind kept, a third or later one kept.
AS_LETTER, AS_SIGN, NO_SPACE, NO_REPEAT, DOUBLE, REPEAT = 0.7, 4.0, 1.0, 0.7, 0.2, 3.0

#: The model's alphabet: 0 is anything that parts words, 1 to 26 letters, 27 any other letter.
SIZE = 28
_PARTS = bytes(0 if b in b" \t\n\r\v\f" else b - 96 if 97 <= b <= 122 else 27 if b == 0x7F else 0 for b in range(256))
_LETTER = {chr(97 + i): i + 1 for i in range(26)}


def codes(text: str) -> np.ndarray:
    """The model's characters of a text. Letters outside a-z are one character."""
    low = text.lower()
    if not low.isascii():
        low = re.sub(r"[^\W\d_a-z]", "\x7f", low)
    return np.frombuffer(low.encode("ascii", "replace").translate(_PARTS), np.uint8)


def count_characters(docs: DataFrame) -> np.ndarray:
    """Counts of four characters in a row over all texts; each task sends one row per combination it has seen."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**4, np.int64)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                texts = [t for t in b.column(0).slice(k, 256).to_pylist() if t]
                if texts:
                    c = codes("\n" * 3 + "\n\n\n".join(texts) + "\n").astype(np.int32)
                    total += np.bincount(((c[:-3] * SIZE + c[1:-2]) * SIZE + c[2:-1]) * SIZE + c[3:], minlength=SIZE**4)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["code", "n"])

    out = np.zeros(SIZE**4)
    sums = picked(docs, text="text").mapInArrow(tidied(counted), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    for code, n in sums.collect():  # at most SIZE ** 4 rows, whatever the input
        out[code] = n
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a character after three: each order is smoothed with the one below."""
    four = counts.reshape(SIZE, SIZE, SIZE, SIZE)
    p = np.full(SIZE, 1 / SIZE)
    for k in (3, 2, 1, 0):
        n = four.sum(axis=tuple(range(k)))
        p = (n + 5.0 * p) / (n.sum(axis=-1, keepdims=True) + 5.0)
    return np.log(p).astype(np.float32)


def readings(segment: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each character what it may be read as ('' for nothing) and the cost of that."""
    out: list[list[tuple[str, float]]] = []
    for i, c in enumerate(segment):
        if c in SIGNS:
            options = [(x, AS_LETTER) for x in SIGNS[c]] + [(" ", AS_SIGN)]
        elif c in SEPARATORS:
            options = [(" ", 0.0), ("", NO_SPACE)]
        elif c.isalpha():
            again = i > 0 and segment[i - 1] == c
            keep = 0.0 if not again else REPEAT if i > 1 and segment[i - 2] == c else DOUBLE
            options = [(c, keep)] + ([("", NO_REPEAT)] if again else [])
        else:
            options = [(" ", 0.0)]
        if i > 0 and c == segment[i - 1] and c in SIGNS:
            options.append(("", NO_REPEAT))
        out.append(options)
    return out


class After(dict):
    """The model's numbers after three characters, as a list: made when first asked for, as reading an array's items is slow."""

    def __init__(self, model: np.ndarray) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, state: tuple[int, int, int]) -> list[float]:
        self[state] = found = self.model[state].tolist()
        return found


def decode(segment: str, model: np.ndarray | After, beam: int | None = None) -> str:
    """The best reading of a lower-case segment of any length that stands between spaces; exact unless ``beam`` bounds the states."""
    rows = model if isinstance(model, After) else After(model)
    paths: dict[tuple[int, int, int], tuple[float, tuple]] = {(0, 0, 0): (0.0, ())}
    for options in [*readings(segment), [(" ", 0.0)]]:
        then: dict[tuple[int, int, int], tuple[float, tuple]] = {}
        said_as = [(said, price, _LETTER.get(said, 27 if said.isalpha() else 0)) for said, price in options]
        for at, (cost, path) in paths.items():
            after = rows[at]
            for said, price, d in said_as:
                if not said:
                    state, total, way = at, cost + price, path
                else:
                    state, total, way = (at[1], at[2], d), cost + price - after[d], (path, said)
                if (old := then.get(state)) is None or total < old[0]:
                    then[state] = (total, way)
        if beam is not None and len(then) > beam:
            then = dict(sorted(then.items(), key=lambda x: x[1][0])[:beam])
        paths = then
    way, said = min(paths.values(), key=lambda x: x[0])[1], []
    while way:
        way, c = way
        said.append(c)
    return "".join(reversed(said))[:-1]


_single = r"[^\W_]|[@$!|+(]"
#: Single letters or signs with one to three separators between them, three at least.
SPACED = re.compile(rf"(?<![^\W_])(?:{_single})(?:[ .\-_*/]{{1,3}}(?:{_single})(?![^\W_])){{2,}}")
_sign = "[" + re.escape("".join(SIGNS)) + "]"
#: A sign in a run that has a letter, or a sign that is no digit: numbers have one reading.
SIGNED = re.compile(rf"(?=.*(?:[^\W\d_]|(?!\d){_sign})).*?{_sign}", re.DOTALL)
DOUBLED = re.compile(r"([^\W\d_])\1")
REPEATED = re.compile(r"([^\W\d_])\1\1")
LETTERS = re.compile(r"[^\W\d_]+").findall


class Restorer:
    """The words of texts after deobfuscation. Decoded runs are remembered."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = After(model)
        self.runs: dict[str, tuple[str, ...]] = {}
        self.plain: set[str] = set()

    def run(self, run: str) -> tuple[str, ...]:
        """The words that a run of characters between white space is read as."""
        if (found := self.runs.get(run)) is None:
            plain = run.rstrip("!?.,;:*#%&$)\"'")
            signed = SIGNED.match(plain)
            if signed or DOUBLED.search(plain):
                found = tuple(LETTERS(decode(plain, self.model)))
                if not signed and not REPEATED.search(plain):  # words have double letters, too
                    found += tuple(LETTERS(run))
            else:
                found = tuple(LETTERS(run))
            if any(c in SIGNS for c in run[len(plain) :]):  # the signs at the end may be letters
                found += tuple(LETTERS(decode(run, self.model)))
            if len(self.runs) >= REMEMBERED:
                self.runs.clear()
            self.runs[run] = found
        return found

    def words(self, text: str | None) -> set[str]:
        if not text:
            return set()
        low = unicodedata.normalize("NFKC", text).lower() if not text.isascii() else text.lower()
        runs = set(low.split())
        plain = runs & self.plain
        for r in runs - plain:
            if (found := self.runs.get(r)) is not None:
                plain.update(found)
            elif r.isalpha() and not DOUBLED.search(r):
                if len(self.plain) >= REMEMBERED:
                    self.plain.clear()
                self.plain.add(r)
                plain.add(r)
            else:
                plain.update(self.run(r))
        for m in SPACED.finditer(low):
            plain.update(LETTERS(decode(m.group(), self.model)))
        return plain


def in_training(doc_id: Column) -> Column:
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def features(word: str) -> list[str]:
    """The word (with an end mark) and its beginnings."""
    return [word + ".", *[word[:k] for k in BEGINNINGS if len(word) >= k]]


class Classifier:
    """Weights of words and beginnings, and a bias."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.of: dict[str, tuple[str, ...]] = {}
        self.silent: set[str] = set()  # words without a weight

    def known(self, word: str) -> tuple[str, ...]:
        """Those of a word's features that have a weight; remembered."""
        if (found := self.of.get(word)) is None:
            found = tuple(f for f in features(word) if f in self.weights)
            if len(self.of) + len(self.silent) >= REMEMBERED:
                self.of.clear()
                self.silent.clear()
            if found:
                self.of[word] = found
            else:
                self.silent.add(word)
        return found

    def counts(self, words: set[str]) -> dict[str, int]:
        n: dict[str, int] = {}
        for fs in map(self.known, words - self.silent):
            for f in fs:
                n[f] = n.get(f, 0) + 1
        return n

    def score(self, words: set[str]) -> float:
        z = self.bias + sum(self.weights[f] * min(n, TIMES) for f, n in sorted(self.counts(words).items()))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit_logistic(x: np.ndarray, y: np.ndarray, l1: float = 0.0, l2: float = 0.0, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated proximal gradient steps; the bias has no penalty."""
    n = max(len(y), 1)
    rate = 4.0 / (float((x * x).sum(axis=1).max(initial=0)) + 1)
    w, b = np.zeros(x.shape[1]), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        miss = (1 / (1 + np.exp(-np.clip(x @ v + c, -30, 30))) - y) / n
        new = v - rate * (x.T @ miss + l2 * v)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        bias = c - rate * miss.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t2 * (new - w), bias + (t - 1) / t2 * (bias - b)
        w, b, t = new, bias, t2
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE) -> Classifier:
    """The classifier, from labelled training rows among ``docs``."""
    known = picked(labels, doc_id="doc_id", toxic="toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    chosen = cut(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # one text an id, so that the bound on ids is one on rows
    texts = picked(docs, doc_id="doc_id", text="text").join(small_or_not(chosen.withColumnRenamed("doc_id", "d")), F.col("doc_id") == F.col("d")).groupBy("d").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE ** 4 numbers, whatever the input

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Restorer(shared.value)
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                words = [sorted(r.words(t)) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(words, pa.list_(pa.string()))], names=["toxic", "words"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                toxic, of = Counter(), Counter()
                for y, words in zip(b.column(0).slice(k, 1024).to_pylist(), b.column(1).slice(k, 1024).to_pylist(), strict=True):
                    fs = {f for w in words for f in features(w)}
                    of.update(fs)
                    if y:
                        toxic.update(fs)
                yield pa.RecordBatch.from_arrays([pa.array(list(of), pa.string()), pa.array([toxic[f] for f in of], pa.int64()), pa.array(list(of.values()), pa.int64())], names=["f", "t", "n"])

    rows = cut(texts.mapInArrow(tidied(restored), "toxic int, words array<string>"))
    n, bad = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not bad:
        return Classifier({}, -10.0)
    share = bad / n
    seen = rows.mapInArrow(tidied(counted), "f string, t long, n long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).filter((F.col("t") >= SEEN) & (F.col("t") > F.col("n") * share))
    gain = (F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1e-9)
    best = seen.orderBy(gain.desc(), "f").limit(8 * WORDS).collect()
    # of a word and beginnings that are in the same texts, the longest
    longer = {(f[:k].rstrip("."), r[1], r[2]) for r in best for f in [r[0]] for k in range(1, len(f))}
    chosen_features = [r[0] for r in best if (r[0], r[1], r[2]) not in longer][:WORDS]
    number = {f: i for i, f in enumerate(chosen_features)}
    finder = Classifier(dict.fromkeys(chosen_features, 1.0), 0.0)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [finder.counts(set(words)) for words in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([[number[f] for f in c] for c in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], names=["toxic", "at", "times"])

    x, y = np.zeros((n, len(number)), np.float32), np.zeros(n)
    sampled = rows.mapInArrow(tidied(vectors), "toxic int, at array<int>, times array<int>").collect()  # at most the sample
    for i, (toxic, at, times) in enumerate(sorted(sampled, key=lambda r: (r[0], sorted(zip(r[1], r[2], strict=True))))):
        y[i] = toxic
        x[i, at] = np.minimum(times, TIMES)
    w, _ = fit_logistic(x, y, l1=1e-3)
    some = np.flatnonzero(w > 1e-6)
    w, b = fit_logistic(x[:, some], y, l2=1e-6, steps=5000)
    return Classifier({chosen_features[i]: float(v) for i, v in zip(some, w, strict=True)}, b)


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Classifier]:
    model = language_model(count_characters(docs))
    return model, train(docs, labels, model, sample)


def shared_scorer(docs: DataFrame, labels: DataFrame, sample: int) -> Broadcast:
    """The model's SIZE ** 4 numbers, at most WORDS weights and the bias: a size that doesn't grow with the input."""
    model, classifier = fitted(docs, labels, sample)
    return docs.sparkSession.sparkContext.broadcast((model, classifier.weights, classifier.bias))


def scorer(parts: tuple[np.ndarray, dict[str, float], float]) -> Callable[[str | None], float]:
    """A task's own scorer: what it remembers goes with the task."""
    model, weights, bias = parts
    r, classifier = Restorer(model), Classifier(weights, bias)
    return lambda text: classifier.score(r.words(text))


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = shared_scorer(docs, labels, sample)
    kind = dict(docs.dtypes)["doc_id"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for b in batches:
            out = [score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    row, at = packed(docs)
    return row.select(at["doc_id"].alias("doc_id"), at["text"].alias("text")).mapInArrow(tidied(scored), f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def rejected_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents with a score under 0.5, with all columns."""
    shared = shared_scorer(docs, labels, sample)

    # only texts go to Python and only scores come back
    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from tidied(lambda parts: (pa.array([score(t.as_py()) for t in part], pa.float64()) for score in [scorer(shared.value)] for part in parts))(texts)

    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return flat.filter(scored(F.col(f"c{docs.columns.index('text')}")) < 0.5).toDF(*docs.columns)
