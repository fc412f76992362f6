"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct words (a word with the spaces before it; no piece crosses such an edge) are joined into one text, and
the text's suffixes are sorted by as many characters as the longest piece has. Every piece of the vocabulary is found in
them by binary search at once: its occurrences are a range of the suffix array. Each occurrence is an edge from its
start to its end; edges are sorted by where they end in their word and relaxed in that order, all words side by side. A
state of the relaxation is the last piece of a prefix's encoding; an edge extends a prefix if its piece stays whole next
to that last piece, which is so for exactly one edge into each place. (Merges of a byte-pair model only depend on what
is next to each other, so pieces that stay whole two by two stay whole all together.) Pairs are judged once and
remembered. Characters without a piece become byte pieces.

Defined results: null and empty texts have no pieces and decode to an empty text; repeated rows encode alike; an empty
table gives an empty result; words of any length are taken whole. A text that itself holds the space mark U+2581 comes
back with spaces there, as in the library. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fathomline.llm.common import free_name, tidied

MARK = "▁"
#: Distinct words that a Python worker remembers, and pieces that it keeps for them.
REMEMBERED = 400_000
STORED = 4_000_000
#: Characters that are indexed at a time: bounds the arrays (about 800 bytes a character, edges included). A longer word is
#: indexed window by window, and relaxed from each window to the next.
INDEXED = 100_000
#: Characters of the texts that are encoded at a time (one text is never split), and their number.
CHARACTERS = 500_000
TEXTS = 1024
NONE, UNREACHED = -1, -(2**31)


class Vocabulary:
    """Pieces, scores and byte pieces of a model file. The library only reads the file: it doesn't encode here."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(size)]
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown = sp.unk_id()
        self.score: dict[str, tuple[float, int]] = {}
        for i in range(size):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[self.piece[i]] = (sp.get_score(i), i)
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("pieces that cross words are not supported")
        self.longest = max(map(len, self.score))

    def merged(self, text: str) -> list[str]:
        """Plain byte-pair merging of a short text: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                if (s := self.score.get(parts[i] + parts[i + 1])) is not None and (best is None or s[0] > best):
                    best, at = s[0], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def whole(self, left: int, right: int) -> bool:
        """Do two pieces stay whole next to each other? left NONE: does the piece alone? Characters without a piece do."""
        a, b = (self.piece[left] if left >= 0 else ""), self.piece[right]
        return self.merged(a + b) == ([a, b] if a else [b])


class Judged:
    """What is known of pairs of pieces: an open hash table in arrays, asked for many pairs at a time."""

    BITS = 22

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.pair = np.full(1 << self.BITS, -1, np.int64)
        self.good = np.zeros(1 << self.BITS, bool)
        self.size = 0

    def slots(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def get(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(answers, places of pairs without one)"""
        at = self.slots(pair)
        seen = self.pair[at]
        good = self.good[at]
        off = np.flatnonzero(seen != pair)
        missing = []
        while len(off):
            empty = seen[off] == -1
            missing.append(off[empty])
            off = off[~empty]
            at[off] = (at[off] + 1) & ((1 << self.BITS) - 1)
            seen[off] = self.pair[at[off]]
            good[off] = self.good[at[off]]
            off = off[seen[off] != pair[off]]
        return good, np.concatenate(missing) if missing else off

    def put(self, pair: int, good: bool) -> None:
        at = (pair * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - self.BITS
        while self.pair[at] != -1:
            at = (at + 1) & ((1 << self.BITS) - 1)
        self.pair[at], self.good[at] = pair, good
        self.size += 1


class Encoder:
    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        self.v = Vocabulary(path)
        names = list(self.v.score)
        self.ids = np.array([self.v.score[p][1] for p in names], np.int64)
        self.lengths = np.array([len(p) for p in names], np.int64)
        self.depth = -(-self.v.longest // 4)
        #: characters of all pieces, one piece a row, 0 past its end
        self.spelt = np.zeros((len(names), 4 * self.depth), np.uint32)
        inside = np.arange(4 * self.depth) < self.lengths[:, None]
        self.spelt[inside] = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        self.single = np.unique(self.spelt[self.lengths == 1, 0])
        self.codes, spelt = np.unique(self.spelt, return_inverse=True)
        self.code_at = spelt.reshape(self.spelt.shape)
        # the bytes that each piece stands for: a byte piece for itself, the space mark for a space
        said = [bytes([self.v.byte_of[i]]) if i in self.v.byte_of else p.replace(MARK, " ").encode() for i, p in enumerate(self.v.piece)]
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_len = np.array([len(x) for x in said], np.int64)
        self.said_at = np.cumsum(self.said_len) - self.said_len
        self.judged = Judged()
        self.forget()
        self.surface = np.array([p.replace(MARK, " ") for p in self.v.piece], object)
        self.is_byte = np.zeros(len(self.v.piece), bool)
        self.is_byte[list(self.v.byte_of)] = True

    # -- index and edges

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """start, end, piece, place in the word of every occurrence of every piece (or of a character without one), by place."""
        depth = self.depth
        text = "\0".join(words) + "\0"
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        lens = np.array([len(w) for w in words], np.int64)
        begin = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
        n = len(code)
        first = np.repeat(begin, lens + 1)
        word_end = np.repeat(begin + lens, lens + 1)
        # characters as dense numbers from 2 on; 1 stands for the end of a word, 0 pads
        alphabet, dense = np.unique(code, return_inverse=True)
        dense = dense.astype(np.int64) + 2
        dense[code == 0] = 1
        bits = int(dense.max()).bit_length()
        four = lambda at: (at[..., 0] << 3 * bits) | (at[..., 1] << 2 * bits) | (at[..., 2] << bits) | at[..., 3]
        padded = np.concatenate([dense, np.zeros(4 * depth + 4, np.int64)])
        key = four(np.lib.stride_tricks.sliding_window_view(padded, 4)[: n + 4 * depth])
        # the suffix array: by four characters, then by ranks four, eight characters on
        span, rank = 4, np.unique(key[:n], return_inverse=True)[1].astype(np.int64)
        order = np.argsort(rank)
        while span < 4 * depth:
            on = np.zeros(n, np.int64)
            on[: max(n - span, 0)] = rank[span:] + 1
            both = rank * (n + 1) + on
            order = np.argsort(both)
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(both[order]) != 0)])
            span *= 2
        # pieces whose characters all occur, as keys of four characters: lowest and highest with that beginning
        slot = np.minimum(np.searchsorted(alphabet, self.codes), len(alphabet) - 1)
        known = np.where(alphabet[slot] == self.codes, slot + 2, 0)
        known[self.codes == 0] = 1
        which = np.flatnonzero(known[self.code_at].all(axis=1))
        rows, past = known[self.code_at[which]], self.spelt[which] == 0
        low, high = (four(np.where(past, x, rows).reshape(len(which), depth, 4)) for x in (0, (1 << bits) - 1))

        def bound(want: np.ndarray, after: bool) -> np.ndarray:
            lo, hi = np.zeros(len(want), np.int64), np.full(len(want), n, np.int64)
            while (open_ := lo < hi).any():
                mid = np.where(open_, (lo + hi) // 2, 0)
                at = order[mid]
                less, same = np.zeros(len(want), bool), np.ones(len(want), bool)
                for k in range(depth):
                    x = key[at + 4 * k]
                    less |= same & (x < want[:, k])
                    same &= x == want[:, k]
                go = less | (same & after)
                lo, hi = np.where(open_ & go, mid + 1, lo), np.where(open_ & ~go, mid, hi)
            return lo

        start_of, stop_of = bound(low, False), bound(high, True)
        count = stop_of - start_of
        piece = np.repeat(which, count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = order[np.repeat(start_of, count) + offset]
        end, ids = start + self.lengths[piece], self.ids[piece]
        single = np.isin(code, self.single)
        lone = np.flatnonzero(~single & (code != 0))  # characters without a piece
        start, end, ids = (np.concatenate(x) for x in ((start, lone), (end, lone + 1), (ids, -2 - code[lone])))
        inside = end <= word_end[start]
        start, end, ids = start[inside], end[inside], ids[inside]
        place = end - first[start]
        by = np.argsort(place.astype(np.uint16) if len(place) and place.max() < 1 << 16 else place, kind="stable")
        return start[by], end[by], ids[by], place[by], begin, lens

    # -- relaxation

    def relax(self, words: list[str], at: int, own: int | None, last: np.ndarray, back: np.ndarray) -> None:
        """Relax all edges of words that stand from ``at`` on (of a window only those from its ``own`` first characters)."""
        start, end, ids, place, _, _ = self.edges(words)
        if own is not None:
            inside = start < own
            start, end, ids, place = start[inside], end[inside], ids[inside], place[inside]
        start, end = start + at, end + at
        steps = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
        for k in range(len(steps) - 1):
            s = slice(steps[k], steps[k + 1])
            from_, piece = start[s], ids[s]
            ok = self.fits(last[from_], piece)
            last[end[s][ok]], back[end[s][ok]] = piece[ok], from_[ok]

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of a last piece and a next one: do they stay whole?"""
        if self.judged.size > 1 << Judged.BITS - 1:
            self.judged.clear()
        size = len(self.v.piece) + 1
        pair = (left.astype(np.int64) + 1) * size + right
        plain = (left >= NONE) & (right >= 0)
        pair[~plain] = 0
        good, todo = self.judged.get(pair)
        for p in np.unique(pair[todo]).tolist():
            self.judged.put(p, self.v.whole(p // size - 1, p % size))
        if len(todo):
            good[todo] = self.judged.get(pair[todo])[0]
        return good | ~plain

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all words one after the other, and where each word's begin (and the last one's end)."""
        lens = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(lens + 1) - lens - 1
        last = np.full(int(begin[-1] + lens[-1] + 1), UNREACHED, np.int32)
        last[begin] = NONE
        back = np.zeros(len(last), np.int32 if len(last) < 1 << 31 else np.int64)
        if len(words) > 1 or lens[0] <= INDEXED:
            self.relax(words, 0, None, last, back)
        else:  # edges from a window's own characters; they may end in the next one
            for at in range(0, int(lens[0]), INDEXED):
                self.relax([words[0][at : at + INDEXED + self.v.longest]], at, INDEXED, last, back)
        # walk back from the ends of all words together
        at, out, live = begin + lens, [], np.arange(len(words))
        while len(live):
            out.append((live, last[at]))
            at = back[at]
            go = at > begin[live]
            live, at = live[go], at[go]
        word = np.concatenate([w for w, _ in out])
        piece = np.concatenate([p for _, p in out])
        turn = len(out) - 1 - np.repeat(np.arange(len(out)), [len(w) for w, _ in out])
        by = np.argsort(word * len(out) + turn)
        word, piece = word[by], piece[by]
        if len(odd := np.flatnonzero(piece < NONE)):  # characters without a piece
            spelt = [self.fallback(chr(-2 - c)) for c in piece[odd].tolist()]
            many = np.ones(len(piece), np.int64)
            many[odd] = [len(x) for x in spelt]
            word, at, piece = np.repeat(word, many), (np.cumsum(many) - many)[odd], np.repeat(piece, many)
            for a, x in zip(at.tolist(), spelt, strict=True):
                piece[a : a + len(x)] = x
        return piece.astype(np.int32), np.searchsorted(word, np.arange(len(words) + 1))

    def fallback(self, c: str) -> list[int]:
        return [self.v.byte[b] for b in c.encode("utf-8")] if self.v.byte else [self.v.unknown]

    # -- texts

    def forget(self) -> None:
        self.number: dict[str, int] = {}  # of a word
        self.begin = np.zeros(1, np.int64)  # of its pieces in
        self.store = np.zeros(0, np.int32)

    def learn(self, words: list[str]) -> None:
        """Add words' pieces to the store. NUL has no piece of its own, so nothing merges across it: words are cut there."""
        parts, nul = [], []
        for w in words:
            if "\0" in w:
                nul.append(w)
            else:
                parts.append(w)
        for w in nul:
            parts += [x for x in dict.fromkeys(w.split("\0")) if x and x not in self.number]
        parts = list(dict.fromkeys(parts))
        if parts:
            self.add(parts, *self.encode_words(parts))
        for w in nul:
            ids: list[int] = []
            for i, x in enumerate(w.split("\0")):
                ids += self.fallback("\0") if i else []
                ids += self.of(x).tolist() if x else []
            self.add([w], np.array(ids, np.int32), np.array([0, len(ids)]))

    def add(self, words: list[str], ids: np.ndarray, begin: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.store) + begin[1:]])
        self.store = np.concatenate([self.store, ids])

    def of(self, word: str) -> np.ndarray:
        i = self.number[word]
        return self.store[self.begin[i] : self.begin[i + 1]]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all texts one after the other, and where each text's begin (and the last one's end)."""
        split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        cut = [split((" " + t).replace(" ", MARK)) if t else [] for t in texts]
        if len(self.number) > self.remembered or len(self.store) > STORED:
            self.forget()
        new: set[str] = set()
        for words in cut:
            new.update(words)
        new.difference_update(self.number)
        batch, size = [], 0
        for w in new:
            if batch and size + len(w) >= INDEXED:
                self.learn(batch)
                batch, size = [], 0
            batch.append(w)
            size += len(w) + 1
        if batch:
            self.learn(batch)
        many = np.array([len(words) for words in cut], np.int64)
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, many.sum())
        sizes = self.begin[at + 1] - self.begin[at]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.store[np.arange(upto[-1]) + np.repeat(self.begin[at] - upto[:-1], sizes)]
        return ids, upto[np.concatenate([[0], np.cumsum(many)])]

    # -- decoding

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> list[str]:
        """The texts of pieces (laid out as ``encode`` does): their bytes, read as UTF-8, less the space that encoding adds."""
        sizes = self.said_len[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.said[np.arange(upto[-1]) + np.repeat(self.said_at[ids] - upto[:-1], sizes)].tobytes()
        cuts = upto[begin].tolist()
        return [raw[x:y].decode("utf-8", "replace").removeprefix(" ") for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One per Python worker."""
    if (path, remembered) not in _encoders:
        _encoders[path, remembered] = Encoder(path, remembered)
    return _encoders[path, remembered]


def portions(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``TEXTS`` rows and, unless it is one row, ``CHARACTERS`` bytes of text."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    k = 0
    while k < batch.num_rows:
        to = int(np.searchsorted(upto, (upto[k - 1] if k else 0) + CHARACTERS, "right"))
        to = min(max(to, k + 1), k + TEXTS)
        yield batch.slice(k, to - k)
        k = to


def encoded(docs: DataFrame, model: str, columns: list[str] | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """``docs`` (or some of its columns) with n_pieces, piece_ids, round_trip: does decoding give the text back?

    ``remembered``: distinct words that a Python worker keeps; fewer cost time, not results."""
    keep = docs.columns if columns is None else columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = [docs.columns.index(c) for c in keep] if columns is not None else list(range(len(keep)))
    chosen = flat.select(*[flat[f"c{i}"].alias(f"k{j}") for j, i in enumerate(at)], flat[f"c{docs.columns.index('text')}"].alias("text"))
    width = len(at)
    schema = ", ".join([f"k{j} {chosen.schema[j].dataType.simpleString()}" for j in range(width)] + ["n_pieces long", "piece_ids array<int>", "round_trip boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model, remembered)
        for whole in batches:
            for b in portions(whole, width):
                texts = b.column(width).to_pylist()
                ids, begin = e.encode(texts)
                same = [d == (t or "").replace(MARK, " ") for d, t in zip(e.decode(ids, begin), texts, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(np.diff(begin)), lists, pa.array(same, pa.bool_())], names=[*[f"k{j}" for j in range(width)], "n_pieces", "piece_ids", "round_trip"])

    out = chosen.mapInArrow(tidied(run), schema)
    names = list(keep)
    for extra in ("n_pieces", "piece_ids", "round_trip"):
        names.append(free_name(names, extra))
    return out.toDF(*names)
