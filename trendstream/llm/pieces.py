"""Byte-level BPE over Arrow batches: split a batch into pre-tokens, look them up, encode the misses.

The tokenizer library spends its time per call and per pre-token, and texts
repeat their pre-tokens.  ``split`` finds the pre-tokens of many texts at once
with numpy (character classes, run boundaries), each pre-token becomes a pair
of 64-bit hashes, and a table of fixed size returns what the library gave for it
earlier.  Only misses reach the library's BPE model, and a newer entry replaces
an older one in its slot, so memory is fixed.

Pre-tokens are those of the byte-level BPE pattern (contractions, an optional
space before a run of letters, digits or other marks, white space without the
last character before a word).  BPE never merges across them, so a text's ids
are its pre-tokens' ids in order.  A text that holds a special string goes to
the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTER, DIGIT, MARK, WHITE, END = range(5)
# Unicode White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
SENTINEL = 0x110000
SEGMENT = 1 << 20
NO_IDS = -1
_SAFE_CUT = re.compile(r"(?<=\S)[ \t\n]")
_tables: dict = {}


def _classes() -> np.ndarray:
    if "classes" not in _tables:
        kinds = {"L": LETTER, "N": DIGIT}
        t = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], MARK) for i in range(SENTINEL)),
                        dtype=np.uint8, count=SENTINEL)
        t[WHITE_SPACE] = WHITE
        _tables["classes"] = np.append(t, np.uint8(END))
    return _tables["classes"]


def _multipliers(n: int) -> np.ndarray:
    """Two rows of fixed random odd 64-bit numbers, at least n columns."""
    m = _tables.get("multipliers")
    if m is None or m.shape[1] < n:
        size = 1 << max(12, (n - 1).bit_length())
        m = np.stack([np.random.default_rng(seed).integers(0, 2 ** 63, size, dtype=np.uint64) * np.uint64(2)
                      + np.uint64(1) for seed in (11, 12)])
        _tables["multipliers"] = m
    return m


def segments(text: str) -> list[str]:
    """A text in parts of about SEGMENT characters, cut where a pre-token always starts."""
    if len(text) <= SEGMENT:
        return [text]
    out, at = [], 0
    while len(text) - at > SEGMENT:
        m = _SAFE_CUT.search(text, at + SEGMENT)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts (SENTINEL after each), start and end of every
    pre-token and of every sentinel, in order."""
    cp = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), dtype="<u4").astype(np.int32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))) - 1
    cp[ends] = SENTINEL
    kind = _classes()[cp]
    change = np.empty(len(cp), dtype=bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    runs = np.flatnonzero(change)
    white = kind[runs] == WHITE
    first = runs[white]                                   # white runs [first, after)
    after = runs[np.flatnonzero(white) + 1]
    start = change & (kind != WHITE)
    start[1:] &= cp[:-1] != 0x20                          # a word takes the space before it
    start[first] = True
    start[(after - 1)[kind[after] != END]] = True         # the last white character goes with what follows
    start[ends] = True
    start[ends[:-1] + 1] = True
    quote = np.flatnonzero(start & (cp == 0x27))
    if len(quote):
        one, two = cp[quote + 1], cp[np.minimum(quote + 2, len(cp) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e"))
                | (one == ord("l")) & (two == ord("l")))
        hit = short | long
        start[quote[hit] + 1] = False
        start[quote[hit] + np.where(short[hit], 2, 3)] = True
    starts = np.flatnonzero(start)
    return cp, starts, np.append(starts[1:], len(cp))


def hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lens = ends - starts
    place = np.arange(len(cp)) - np.repeat(starts, lens)
    m = _multipliers(int(lens.max()))
    value = cp.astype(np.uint64) + np.uint64(1)
    return (np.add.reduceat(value * m[0][place], starts), np.add.reduceat(value * m[1][place], starts))


class Slots:
    """Table of 2**bits slots, two possible ones for each hash pair: -> (size, first) of a value.

    A new entry goes to an empty slot of its two, else replaces the first.
    """

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        n = 1 << bits
        self.h1, self.h2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.size, self.first = np.zeros(n, np.int32), np.zeros(n, np.int64)

    def find(self, h1, h2):
        """(slot, found) of each pair."""
        at, other = h1 >> self.shift, h2 >> self.shift
        hit = self._is(at, h1, h2)
        at = np.where(hit, at, other)
        hit |= self._is(other, h1, h2)
        return at, hit

    def _is(self, at, h1, h2):
        return (self.h1[at] == h1) & (self.h2[at] == h2) & (self.size[at] > 0)

    def put(self, h1, h2, size, first):
        at, other = h1 >> self.shift, h2 >> self.shift
        at = np.where((self.size[at] > 0) & (self.size[other] == 0), other, at)
        self.h1[at], self.h2[at], self.size[at], self.first[at] = h1, h2, size, first

    def clear(self):
        self.size[:] = 0


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Token counts or ids of texts as the tokenizer file at ``path`` gives them.

    ``frequent``: a read-only Slots of lengths shared by all workers.
    """

    def __init__(self, path: str, bits: int = 21, pool: int = 1 << 23, frequent: Slots | None = None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.frequent, self.cache = frequent, Slots(bits)
        self.pool, self.used, self.want = np.zeros(1 << 16, np.uint32), 0, pool
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> list[int]:
        """Ids of one pre-token: the library's BPE model on its byte-level letters."""
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]

    def _misses(self, cp, starts, ends, h1, h2, at):
        """Encode each distinct pre-token of the tokens ``at`` once; (sizes, firsts) by token."""
        _, one, back = np.unique(h1[at], return_index=True, return_inverse=True)
        pick = at[one]
        got = [self._piece(cp[s:e].astype("<u4").tobytes().decode("utf-32-le"))
               for s, e in zip(starts[pick], ends[pick])]
        return pick, back, got

    def _prepare(self, texts):
        cp, starts, ends = split(texts)
        h1, h2 = hashes(cp, starts, ends)
        real = cp[starts] != SENTINEL
        text_of = np.cumsum(~real) - ~real
        return cp, starts[real], ends[real], h1[real], h2[real], text_of[real]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for which, parts, whole in self._batches(texts):
            if whole:
                out[which[0]] = len(self._whole(parts[0]))
                continue
            cp, starts, ends, h1, h2, text_of = self._prepare(parts)
            if not len(starts):
                continue
            size = np.zeros(len(starts), np.int64)
            todo = np.arange(len(starts))
            for table in (self.frequent, self.cache):
                if table is not None and len(todo):
                    at, hit = table.find(h1[todo], h2[todo])
                    size[todo[hit]] = table.size[at[hit]]
                    todo = todo[~hit]
            if len(todo):
                pick, back, got = self._misses(cp, starts, ends, h1, h2, todo)
                n = np.fromiter(map(len, got), np.int64, count=len(got))
                self.cache.put(h1[pick], h2[pick], n, NO_IDS)
                size[todo] = n[back]
            np.add.at(out, which, np.bincount(text_of, weights=size, minlength=len(parts)).astype(np.int64))
        return out

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (uint32)."""
        out: list[list] = [[] for _ in texts]
        for which, parts, whole in self._batches(texts):
            if whole:
                out[which[0]].append(np.array(self._whole(parts[0]), dtype=np.uint32))
                continue
            cp, starts, ends, h1, h2, text_of = self._prepare(parts)
            if not len(starts):
                continue
            if self.used > self.want:
                self.cache.clear()
                self.used = 0
            at, hit = self.cache.find(h1, h2)
            size, first = self.cache.size[at].astype(np.int64), self.cache.first[at]
            hit &= first != NO_IDS
            todo = np.flatnonzero(~hit)
            if len(todo):
                pick, back, got = self._misses(cp, starts, ends, h1, h2, todo)
                n = np.fromiter(map(len, got), np.int64, count=len(got))
                f = self.used + np.cumsum(n) - n
                self._store(np.fromiter(chain.from_iterable(got), np.uint32, count=int(n.sum())))
                self.cache.put(h1[pick], h2[pick], n, f)
                size[todo], first[todo] = n[back], f[back]
            total = int(size.sum())
            before = np.cumsum(size) - size
            flat = self.pool[np.repeat(first - before, size) + np.arange(total)]
            cuts = np.cumsum(np.bincount(text_of, weights=size, minlength=len(parts)).astype(np.int64))
            for i, part in zip(which, np.split(flat, cuts[:-1])):
                out[i].append(part)
        return [p[0] if len(p) == 1 else np.concatenate(p) if p else np.zeros(0, np.uint32) for p in out]

    def _store(self, values: np.ndarray) -> None:
        need = self.used + len(values)
        if need > len(self.pool):
            grown = np.zeros(max(need, 2 * len(self.pool)), np.uint32)
            grown[:self.used] = self.pool[:self.used]
            self.pool = grown
        self.pool[self.used:need] = values
        self.used = need

    def _batches(self, texts: list[str]):
        """(positions, parts, whole): parts of about SEGMENT characters; whole: for the library as they are."""
        which, parts, n = [], [], 0
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                yield np.array([i]), [t], True
                continue
            for part in segments(t):
                which.append(i)
                parts.append(part)
                n += len(part) + 1
                if n >= SEGMENT:
                    yield np.array(which), parts, False
                    which, parts, n = [], [], 0
        if parts:
            yield np.array(which), parts, False


def worker_encoder(path: str, key: str = "", **options) -> Encoder:
    """One encoder for each worker process and key, kept between tasks."""
    at = (path, key)
    if at not in _tables:
        _tables[at] = Encoder(path, **options)
    return _tables[at]
