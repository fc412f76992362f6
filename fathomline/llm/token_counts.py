"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a doubly linked list; its adjacent pairs that have a merge sit in a heap by rank and place. The
lowest is popped again and again and its pair is merged; pairs that are out of date when popped are skipped. The count
is the number of initial symbols less the merges made: no identifiers are looked up or emitted.

The vocabulary file is that of a tokenizers-library BPE with word ends: text is brought to NFC, white space is dropped,
case is folded, words are split by the file's pattern, and each word's last byte carries the end mark. Strings of the
file's special tokens inside a text are one token each, found before all else, as the library has them by default.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows count alike; an empty table gives an
empty result; words of any length are merged in n log n steps. Counts of words are remembered, at most ``REMEMBERED`` at
a time. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from fathomline.llm.common import packed, tidied

REMEMBERED = 700_000
#: Longer words are counted anew each time.
LONGEST = 64
BITS = 20
MASK = (1 << BITS) - 1
END = "</w>"


# Letters that the library folds otherwise than Python does: sigma without regard to its place, and two that
# are newer than Python's tables.
FOLDED = {"\u03a3": "\u03c3", "\ua7cb": "\u0264", "\ua7dc": "\u019b"}
# Unassigned characters that the regex module takes for letters.
NO_LETTERS = "\U00032808\U0003285c\U00032988\U0003d808\U0003d85c\U0003d988\U0003e808\U0003e85c\U0003e988\U0003f808\U0003f85c\U0003f988"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if it is a visible Latin-1 character, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merges:
    """The ranks of a vocabulary file, over small integers that stand for symbols."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        number: dict[str, int] = {}
        name = lambda s: number.setdefault(s, len(number))
        stand = byte_symbols()
        self.inner = [name(s) for s in stand]
        self.final = [name(s + END) for s in stand]
        #: pair of symbols, packed -> rank and merged symbol, packed
        self.rank: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[name(a) << BITS | name(b)] = r << BITS | name(a + b)
        if len(number) >> BITS:
            raise ValueError("the vocabulary has too many symbols")
        self.special = [t["content"] for t in spec["added_tokens"] if t.get("special")]

    def count(self, word: str) -> int:
        """Initial symbols minus merges."""
        raw = word.encode("utf-8", "replace")
        n = len(raw)
        symbol = [self.inner[b] for b in raw]
        symbol[-1] = self.final[raw[-1]]
        find = self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found >> BITS) * n + i for i in range(n - 1) if (found := find(symbol[i] << BITS | symbol[i + 1])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            r, i = divmod(heappop(heap), n)
            j = after[i]
            if symbol[i] < 0 or j >= n or (found := find(symbol[i] << BITS | symbol[j])) is None or found >> BITS != r:
                continue  # the pair has gone since
            symbol[i], symbol[j] = made, _ = found & MASK, -1
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (right := find(made << BITS | symbol[k])) is not None:
                    heappush(heap, (right >> BITS) * n + i)
            if (h := before[i]) >= 0 and (left := find(symbol[h] << BITS | made)) is not None:
                heappush(heap, (left >> BITS) * n + h)
        return n - merges


class Words(dict):
    """Remembered counts of single words; a word that is missing is merged."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges

    def __missing__(self, word: str) -> int:
        n = self.merges.count(word)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= LONGEST:
            self[word] = n
        return n


class Counter(dict):
    """Remembered counts of what stands between white space; one that is missing is split into words."""

    def __init__(self, path: str) -> None:
        import regex

        merges = Merges(path)
        self.of = Words(merges)
        # fixed pattern of the vocabulary file: contractions, letters, single digits, other signs
        self.words = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{NO_LETTERS}]]+|[\p{{N}}]|[[^\s\p{{L}}\p{{N}}]||[{NO_LETTERS}]]+").findall
        #: str.split takes these for white space; the pattern doesn't
        self.odd = regex.compile("[\x1c-\x1f]").search
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None
        self.mark = [s[:2] for s in merges.special]

    def __missing__(self, run: str) -> int:
        n = sum(map(self.of.__getitem__, self.words(run)))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(run) <= LONGEST:
            self[run] = n
        return n

    def plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            for upper, lower in FOLDED.items():
                text = text.replace(upper, lower)
        text = text.lower()
        if self.odd(text):
            return sum(map(self.of.__getitem__, self.words(text)))
        return sum(map(self.__getitem__, text.split()))

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not any(m in text for m in self.mark):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per Python worker."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. ``vocabulary``: a path that every executor has (installed with the library)."""
    row, at = packed(docs)
    kind = dict(docs.dtypes)["doc_id"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for b in batches:
            sizes, tokens = [], []
            for t in b.column(1):
                s = t.as_py()
                sizes.append(len(s.encode("utf-8", "surrogatepass")) if s else 0)
                tokens.append(c.text(s))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return row.select(at["doc_id"].alias("doc_id"), at["text"].alias("text")).mapInArrow(tidied(counted), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
