"""Token ids and token counts of whole texts, exactly as the tokenizers library gives them.

A text is cut at safe boundaries: between a character that is no white space and the blank or
line end that follows it, and in front of a full stop or comma that ends such a stretch after
a letter. No token of a byte-pair tokenizer that splits words first reaches over such a
boundary, so a text's ids are the ids of its units in a row. Units are cut out of the Arrow
buffer in place and Arrow finds the distinct ones of a slice; a worker asks the library once
for each and remembers the answer in flat arrays, so a unit takes some forty bytes. When the
memory is full the half that was met least goes. Tokenizer files for which the boundaries do
not hold are found out when they are loaded (their splitting step is looked at), and then
whole texts go to the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from scrutiny.llm.common import held

TOGETHER = 64  # plain words the library gets in one string
UNIT_BYTES = 64  # longer units are not remembered
REMEMBERED = 1_000_000  # units
FACTORS = np.cumprod(np.full(UNIT_BYTES, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


class Column:
    """Numbers that are appended in parts."""

    def __init__(self, kind: type, size: int = 1 << 16):
        self.held, self.used = np.empty(size, kind), 0

    def add(self, values: np.ndarray) -> None:
        while self.used + len(values) > len(self.held):
            self.held = np.concatenate([self.held, np.empty_like(self.held)])
        self.held[self.used:self.used + len(values)] = values
        self.used += len(values)

    @property
    def all(self) -> np.ndarray:
        return self.held[:self.used]


class Memory:
    """Units and their ids. A hash proposes where a unit is; its bytes decide."""

    def __init__(self):
        self.hash, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bytes, self.start, self.size = Column(np.uint8), Column(np.int64), Column(np.int64)
        self.ids, self.first, self.n_ids = Column(np.int32), Column(np.int64), Column(np.int64)
        self.hits = Column(np.int32)

    def find(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each unit (-1: unknown) and its hash."""
        data, start, size = bytes_of(units)
        place = np.arange(len(data)) - np.repeat(start, size)
        mixed = (data.astype(np.uint64) + np.uint64(1)) * FACTORS[place % UNIT_BYTES]
        h = np.add.reduceat(mixed, start) if len(start) else np.zeros(0, np.uint64)
        out = np.full(len(start), -1, np.int64)
        if len(self.hash):
            spot = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            like = self.number[spot]
            maybe = np.flatnonzero((self.hash[spot] == h) & (self.size.all[like] == size))
            if len(maybe):
                n = size[maybe]
                same = (data[slots(start[maybe], n)]
                        == self.bytes.all[slots(self.start.all[like[maybe]], n)])
                good = maybe[np.logical_and.reduceat(same, np.cumsum(n) - n)]
                out[good] = like[good]
                self.hits.all[like[good]] += 1
        return out, h

    def learn(self, units: pa.Array, h: np.ndarray, ids: np.ndarray, n_ids: np.ndarray) -> np.ndarray:
        """Remember units with their ids (all in a row); their numbers."""
        data, start, size = bytes_of(units)
        number = np.arange(self.size.used, self.size.used + len(size))
        self.start.add(self.bytes.used + start)
        self.first.add(self.ids.used + np.cumsum(n_ids) - n_ids)
        self.bytes.add(data)
        self.ids.add(ids)
        self.size.add(size)
        self.n_ids.add(n_ids)
        self.hits.add(np.zeros(len(size), np.int32))
        keep = np.flatnonzero(size <= UNIT_BYTES)
        order = keep[np.argsort(h[keep], kind="stable")]
        at = np.searchsorted(self.hash, h[order])
        self.hash = np.insert(self.hash, at, h[order])
        self.number = np.insert(self.number, at, number[order])
        return number

    def forget(self) -> None:
        """Keep the half of the remembered units that was met in most slices."""
        left = self.number[np.argsort(-self.hits.all[self.number], kind="stable")]
        left = np.sort(left[:len(left) // 2])
        old = Memory()
        old.__dict__, self.__dict__ = self.__dict__, old.__dict__
        known = np.isin(old.number, left)
        self.hash, self.number = old.hash[known], np.searchsorted(left, old.number[known])
        for start, size, pool in (("start", "size", "bytes"), ("first", "n_ids", "ids")):
            a, n = getattr(old, start).all[left], getattr(old, size).all[left]
            getattr(self, pool).add(getattr(old, pool).all[slots(a, n)])
            getattr(self, start).add(np.cumsum(n) - n)
            getattr(self, size).add(n)
        self.hits.add(old.hits.all[left] // 2)


class UnitEncoder:
    """Encodes texts of one tokenizer file; remembers units."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.splits = splits_at_spaces(spec)
        self.folds = self.splits and folds(spec)
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.memory = Memory()
        self.edge = self._edges() if self.splits else None

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _edges(self) -> tuple[np.ndarray, bool] | None:
        """For each id whether it is the first (or the last) of a word, and which of the two.

        Lets many plain words go to the library in one string. None if a trial differs.
        """
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        trial = ["the", "Hello", "ÀÉöÿß", "reading", "NEVERTHELESS", "a", "zxqjw"]
        want = self._library([f" {w}" for w in trial])
        ids = np.array(self._library(["".join(f" {w}" for w in trial)])[0])
        for at_end in (False, True):
            edge = np.array([n.endswith("</w>") if at_end else n.startswith("Ġ") for n in names])
            found = cut_at(ids, edge, at_end)
            if len(found) == len(want) and all(a.tolist() == b for a, b in zip(found, want)):
                return edge, at_end
        return None

    def _learned(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new units in a row, and how many each has."""
        n = np.zeros(len(units), np.int64)
        plain = np.flatnonzero(plain_words(units)) if self.edge else np.zeros(0, np.int64)
        flat, counts = self._together(units.take(pa.array(plain)))
        n[plain] = counts
        rest = np.flatnonzero(n == 0)  # not plain, or not told apart
        found = self._library([u.decode() for u in units.take(pa.array(rest)).to_pylist()])
        n[rest] = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.empty(int(n.sum()), np.int32)
        first = np.cumsum(n) - n
        known = plain[counts > 0]
        ids[slots(first[known], n[known])] = flat
        ids[slots(first[rest], n[rest])] = np.fromiter(
            chain.from_iterable(found), np.int32, int(n[rest].sum()))
        return ids, n

    def _together(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, many in one string, and how many each has (0: not told apart)."""
        data, start, size = bytes_of(words)
        heads = np.arange(0, len(words), TOGETHER)
        text = data.tobytes()
        cuts = np.append(start[heads], len(data)).tolist()
        found = self._library([text[a:b].decode() for a, b in zip(cuts, cuts[1:])])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        if not len(flat):
            return flat, np.zeros(len(words), np.int64)
        edge, at_end = self.edge
        marks = edge[flat]
        group = np.repeat(np.arange(len(found)), sizes)
        words_in = np.minimum(TOGETHER, len(words) - heads)
        good = np.bincount(group, marks, len(found)) == words_in
        keep = good[group]
        where = np.flatnonzero(marks[keep])
        ends = where + 1 if at_end else np.append(where[1:], int(keep.sum()))[:len(where)]
        counts = np.zeros(len(words), np.int64)
        counts[np.repeat(good, words_in)] = np.diff(ends, prepend=0)
        return flat[keep], counts

    def _numbered(self, texts: pa.Array | Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all units of all texts, and how many each text has."""
        if len(self.memory.number) > REMEMBERED or self.memory.ids.used > 16 * REMEMBERED:
            self.memory.forget()
        data, start, size = bytes_of(as_binary(texts))
        if self.folds:
            data = self._folded(data)
        cuts = boundaries(data, start, size) if self.splits else start[size > 0]
        counts = np.diff(np.searchsorted(cuts, np.append(start, len(data))))
        if not len(cuts):
            return np.zeros(0, np.int64), counts
        units = pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [
            None, pa.py_buffer(np.append(cuts, len(data)).astype(np.int32)), pa.py_buffer(data)])
        coded = units.dictionary_encode()
        number, h = self.memory.find(coded.dictionary)
        new = np.flatnonzero(number < 0)
        if len(new):
            some = coded.dictionary.take(pa.array(new))
            number[new] = self.memory.learn(some, h[new], *self._learned(some))
        return number[coded.indices.to_numpy()], counts

    def _folded(self, data: np.ndarray) -> np.ndarray:
        """Capitals and line ends as the tokenizer itself sees them.

        Not in front of what may be a combining mark, and not if that spelled a special token.
        """
        after = np.append(data[1:], 0)
        capital = (data >= 65) & (data <= 90) & ((after < 128) | (after == 0xC3))
        out = np.where(capital, data + np.uint8(32), data)
        out[data == 10] = 32
        whole = out.tobytes()
        return data if any(t in whole for t in self.added) else out

    def lengths(self, texts: pa.Array | Sequence[str]) -> np.ndarray:
        found, counts = self._numbered(texts)
        return summed(self.memory.n_ids.all[found], counts)

    def ids(self, texts: pa.Array | Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many belong to each text."""
        found, counts = self._numbered(texts)
        sizes = self.memory.n_ids.all[found]
        flat = self.memory.ids.all[slots(self.memory.first.all[found], sizes)]
        return flat, summed(sizes, counts)


def as_binary(texts: pa.Array | Sequence[str]) -> pa.Array:
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.string())
    return pc.fill_null(texts, "").cast(pa.binary())


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a column without nulls in a row, and where each value begins and its size."""
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends.astype(np.int64) - int(ends[0])
    return data, ends[:-1], np.diff(ends)


def plain_words(units: pa.Array) -> np.ndarray:
    """True for a blank with a word of ASCII or Latin-1 letters, which every rule leaves whole."""
    data, start, size = bytes_of(units)
    if not len(start):
        return np.zeros(0, bool)
    low = data | 32
    good = (low >= 97) & (low <= 122)
    lead = data == 0xC3
    tail = np.append(False, lead[:-1]) & (data >= 128) & (data != 0x97) & (data != 0xB7)
    good |= tail | (lead & np.append(tail[1:], False))
    good[start] = data[start] == 32
    return np.logical_and.reduceat(good, start) & (size > 1)


def boundaries(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where units begin: with each text, at safe white space, and at marks after words."""
    n = len(data)
    flag = np.zeros(n + 1, bool)
    gap = (data == 32) | (data == 10)
    at = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    last = data[at - 1]
    flag[at[(last > 32) & (last < 127)]] = True
    wide = at[last >= 128]
    flag[wide[~_white_before(data, wide)]] = True
    first = start[size > 0]
    begins = np.zeros(n + 1, bool)
    begins[first] = begins[n] = True
    mark = np.flatnonzero((data == 46) | (data == 44))
    mark = mark[~begins[mark]]
    mark = mark[np.append(gap, True)[mark + 1] | begins[mark + 1]]
    low = data[mark - 1] | 32
    letter = (low >= 97) & (low <= 122)
    end = data[mark - 1]
    letter |= (data[mark - 2] == 0xC3) & (end >= 128) & (end != 0x97) & (end != 0xB7)
    flag[mark[letter]] = True
    flag[first] = True
    return np.flatnonzero(flag[:n])


def _white_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where the character of several bytes before a place is white space."""
    c, b, a = data[at - 1], data[at - 2], data[at - 3]
    return (((b == 0xC2) & ((c == 0x85) | (c == 0xA0)))
            | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE1) & (b == 0xA0) & (c == 0x8E))
            | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)))


def cut_at(ids: np.ndarray, edge: np.ndarray, at_end: bool) -> list[np.ndarray]:
    """Ids of a row of words, word by word, from their first or last ids."""
    where = np.flatnonzero(edge[ids]) if len(ids) else np.zeros(0, np.int64)
    return np.split(ids, where[:-1] + 1 if at_end else where[1:])


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` values (a run may be empty)."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``pool[start:start+size]`` in a row."""
    return pool[slots(starts, sizes)]


def slots(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start+size-1`` of each slice in a row."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def splits_at_spaces(spec: dict) -> bool:
    """True if the file splits words before it joins bytes, and no token holds or ends at what
    the units are cut at (white space, full stop, comma)."""
    found = json.dumps([spec.get("pre_tokenizer"), spec.get("normalizer")])
    kinds = set(re.findall(r'"type": "(\w+)"', found))
    step = spec.get("pre_tokenizer") or {}
    steps = step.get("pretokenizers", [step])
    by_regex = any(s.get("type") == "ByteLevel" and s.get("use_regex") for s in steps)
    odd = [t for t in spec.get("added_tokens", [])
           if re.search(r"[\s.,]", t["content"]) or re.fullmatch(r"\w+", t["content"])
           or t.get("lstrip") or t.get("rstrip")]
    prefix = any(s.get("add_prefix_space") for s in steps)
    return ((by_regex or _by_words(steps)) and not odd and not prefix
            and not spec.get("truncation") and not spec.get("padding")
            and kinds <= {"Sequence", "NFC", "Replace", "Lowercase", "Split", "ByteLevel"})


def _by_words(steps: list[dict]) -> bool:
    return any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
               and r"[^\s\p{L}\p{N}]+" in json.dumps(s).replace("\\\\", "\\") for s in steps)


def folds(spec: dict) -> bool:
    """True if the file itself lowers letters and drops white space."""
    step = spec.get("pre_tokenizer") or {}
    return (_by_words(step.get("pretokenizers", [step]))
            and '"Lowercase"' in json.dumps(spec.get("normalizer")))


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder for a tokenizer file."""
    return held(("encoder", path), lambda: UnitEncoder(path))
