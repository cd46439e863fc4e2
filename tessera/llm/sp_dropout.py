"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Pieces are merged by an agenda, best score first; a keyed hash of the seed, the
document, the segment's place in it and the candidate says whether a merge is
skipped, so every occurrence of a segment draws its own skips and the same key
always gives the same segmentation on any executor. Kept of a segment are its
candidates and ids without any skip; occurrences with a skip go through the
agenda, many at a time in arrays.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .rows import map_texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
NORMAL, BYTE = 1, 6
M64, M32 = (1 << 64) - 1, (1 << 32) - 1
#: Segments whose ids are kept, segments looked at together, and the longest that goes through the arrays. All three only bound memory.
CACHE, GROUP, LONG = 300_000, 1 << 18, 40
#: Segments that go through the arrays at once.
BLOCK = 1 << 14


def _varint(data: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = {5: 4, 1: 8}[kind]
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Pieces:
    """The vocabulary of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str = MODEL):
        self.text: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        data = open(path, "rb").read()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.text.append(piece[1].decode())
                self.score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kind.append(piece.get(3, NORMAL))
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k == NORMAL}
        self.byte = [0] * 256
        for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)):
            if k == BYTE:
                self.byte[int(t[3:5], 16)] = i
        self.raw = [bytes([int(t[3:5], 16)]) if k == BYTE else t.replace(SPACE, " ").encode() if k == NORMAL else b"" for t, k in zip(self.text, self.kind, strict=True)]
        #: Whether ids rank pieces, but for runs of spaces, as their scores do.
        ranked = [self.score[i] for t, i in self.ids.items() if len(t) > 1 and t.strip(SPACE)]
        self.ordered = all(a > b for a, b in zip(ranked, ranked[1:]))
        #: Whether a merge can cross from a word to the space after it; where none can, segments are encoded one by one.
        self.crossing = any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.ids)
        self.cut = re.compile("(?s).+" if self.crossing else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def skipped(key: int, left: int, found: int, skip: int) -> bool:
    """Whether the merge to piece ``found`` that begins at symbol ``left`` is skipped: its hash under ``key`` is below ``skip`` of 2^32."""
    return ((key ^ left * 0x85EBCA77 ^ found * 0xC2B2AE3D) & M32) * 0x9E3779B97F4A7C15 >> 32 & M32 < skip


def merge_short(vocabulary: Pieces, segment: str, key: int, skip: int) -> list[str]:
    """As ``merge_long``, with the agenda as a plain list: quicker for few symbols."""
    get, none = vocabulary.ids.get, len(vocabulary.text)
    symbol, place = list(segment), list(range(len(segment)))
    agenda = [get(a + b, none) for a, b in zip(symbol, symbol[1:])]
    while agenda:
        found = min(agenda)
        if found == none:
            break
        i = agenda.index(found)
        if skip and ((key ^ place[i] * 0x85EBCA77 ^ found * 0xC2B2AE3D) & M32) * 0x9E3779B97F4A7C15 >> 32 & M32 < skip:
            agenda[i] = none
            continue
        symbol[i] += symbol[i + 1]
        del symbol[i + 1], place[i + 1], agenda[i]
        if i < len(agenda):
            agenda[i] = get(symbol[i] + symbol[i + 1], none)
        if i:
            agenda[i - 1] = get(symbol[i - 1] + symbol[i], none)
    return symbol


def merge_long(vocabulary: Pieces, segment: str, key: int, skip: int) -> list[str]:
    """The symbols that are left when every candidate merge, best score and leftmost first, was made or skipped."""
    n, ids, score = len(segment), vocabulary.ids, vocabulary.score
    symbol: list[str] = list(segment)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[float, int, int, int]] = []

    def propose(left: int, right: int) -> None:
        if left >= 0 and right < n and (found := ids.get(symbol[left] + symbol[right])) is not None:
            heapq.heappush(agenda, (-score[found], left, right, found))

    for i in range(n - 1):
        propose(i, i + 1)
    while agenda:
        _, left, right, found = heapq.heappop(agenda)
        if not symbol[left] or after[left] != right or vocabulary.text[found] != symbol[left] + symbol[right]:
            continue
        if skip and skipped(key, left, found, skip):
            continue
        symbol[left] += symbol[right]
        symbol[right] = ""
        after[left] = after[right]
        if after[right] < n:
            before[after[right]] = left
        propose(before[left], left)
        propose(left, after[left])
    return [s for s in symbol if s]


def merge(vocabulary: Pieces, segment: str, key: int, skip: int) -> tuple[int, ...]:
    """Ids of one segment; symbols that are no piece become byte pieces."""
    return piece_ids(vocabulary, (merge_short if len(segment) <= 24 and vocabulary.ordered and segment[1:2] != SPACE else merge_long)(vocabulary, segment, key, skip))


def piece_ids(vocabulary: Pieces, symbols: list[str]) -> tuple[int, ...]:
    out: list[int] = []
    for s in symbols:
        found = vocabulary.ids.get(s)
        if found is not None:
            out.append(found)
        else:
            out += [vocabulary.byte[b] for b in s.encode()]
    return tuple(out)


class Agenda:
    """The agenda of many short segments at once, in arrays: every round takes each segment's best candidate, leftmost at a tie, and makes or skips it."""

    NONE = 1 << 30

    def __init__(self, vocabulary: Pieces):
        v, self.base = vocabulary, len(vocabulary.text)
        self.vocabulary = v
        self.char = np.arange(0x110000, dtype=np.int32) + self.base  # characters that are no piece have numbers of their own
        for t, i in v.ids.items():
            if len(t) == 1:
                self.char[ord(t)] = i
        self.by_rank = np.array(sorted(v.ids.values(), key=lambda i: (-v.score[i], i)), np.int64)
        rank = np.zeros(self.base, np.int64)
        rank[self.by_rank] = np.arange(len(self.by_rank))
        #: Whether of merged pieces, but for runs of spaces, none have equal scores; only then does a rank order candidates as scores do.
        merged = [v.score[i] for t, i in v.ids.items() if len(t) > 1 and t.strip(SPACE)]
        self.exact = len(set(merged)) == len(merged)
        number = lambda t: v.ids.get(t) if len(t) > 1 else int(self.char[ord(t)])
        pairs = {}
        for t, i in v.ids.items():
            for cut in range(1, len(t)):
                a, b = number(t[:cut]), number(t[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = int(rank[i])
        bits = max(4, (8 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.value = np.full(1 << bits, -1, np.int64), np.full(1 << bits, self.NONE, np.int64)
        todo = np.array(list(pairs), np.int64)
        value, at = np.array(list(pairs.values()), np.int64), self._slot(todo)
        while len(todo):
            free = np.flatnonzero(self.key[at] == -1)
            first = free[np.unique(at[free], return_index=True)[1]]
            self.key[at[first]], self.value[at[first]] = todo[first], value[first]
            left = np.setdiff1d(np.arange(len(todo)), first)
            todo, value, at = todo[left], value[left], at[left] + 1 & self.mask

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the piece that symbols a and b make, NONE where they make none or one of them is missing (-1)."""
        pair = a.astype(np.int64) << 32 | b
        at = self._slot(pair)
        out = self.value[at]
        wrong = np.flatnonzero(self.key[at] != pair)
        out[wrong] = self.NONE
        while len(wrong):
            wrong = wrong[self.key[at[wrong]] != -1]
            at[wrong] = at[wrong] + 1 & self.mask
            hit = self.key[at[wrong]] == pair[wrong]
            out[wrong[hit]] = self.value[at[wrong[hit]]]
            wrong = wrong[~hit]
        return out

    def symbols(self, segments: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol of each character, rank of what it and the next one of its segment make) of all segments."""
        symbol = self.char[np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)]
        rank = np.full(len(symbol), self.NONE, np.int32)
        last = np.zeros(len(symbol), bool)
        last[(np.cumsum(size) - 1)[size > 0]] = True
        joint = np.flatnonzero(~last)
        for at in range(0, len(joint), BLOCK):
            some = joint[at : at + BLOCK]
            rank[some] = self.ranks(symbol[some], symbol[some + 1])
        return symbol, rank

    def run(self, symbols: np.ndarray, ranks: np.ndarray, size: np.ndarray, keys: np.ndarray | None, skip: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids of all segments, ids of each, candidates: segment, left, piece in the order they came up); symbols and ranks as ``symbols`` gives them."""
        n, width = len(size), int(size.max(initial=1))
        stride = width + 2  # one place after the last symbol, one before the first
        at = gather(np.arange(n) * stride, size)
        symbol, rank = np.full(n * stride, -1, np.int32), np.full(n * stride, self.NONE, np.int32)
        symbol[at], rank[at] = symbols, ranks
        after, before = np.tile(np.arange(1, stride + 1, dtype=np.int16), n), np.tile(np.arange(-1, stride - 1, dtype=np.int16), n)
        before[::stride] = width + 1
        table, live, seen = rank.reshape(n, stride), np.arange(n), []
        while len(live):
            now = table[live]
            j = now.argmin(1)
            r = now[np.arange(len(live)), j]
            going = np.flatnonzero(r < self.NONE)
            live, j = live[going], j[going]
            found = self.by_rank[r[going]]
            if keys is None:
                seen.append((live, j, found))
                l, at = live, live * stride + j
            else:
                mixed = (keys[live] ^ (j * 0x85EBCA77 ^ found * 0xC2B2AE3D).astype(np.uint64)) & np.uint64(M32)
                dropped = (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) < np.uint64(skip)
                rank[live[dropped] * stride + j[dropped]] = self.NONE
                made = np.flatnonzero(~dropped)
                l, j, found = live[made], j[made], found[made]
                at = l * stride + j
            own = l * stride
            right = own + after[at]
            then = after[right]
            symbol[at], symbol[right], rank[right], after[at] = found, -2, self.NONE, then
            then = own + then
            before[then] = j
            rank[at] = self.ranks(found, symbol[then])
            prior = own + before[at]
            rank[prior] = self.ranks(symbol[prior], found)
        grid = symbol.reshape(n, stride)[:, :width]
        there = grid >= 0
        ids, count = self._bytes(grid[there], there.sum(1))
        each = tuple(np.concatenate(x) if seen else np.zeros(0, np.int64) for x in (zip(*seen, strict=True) if seen else ((), (), ())))
        return ids, count, each

    def _bytes(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece become byte pieces."""
        odd = np.flatnonzero(ids >= self.base)
        if not len(odd):
            return ids, count
        raw = {c: [self.vocabulary.byte[b] for b in chr(c - self.base).encode("utf-8", "surrogatepass")] for c in np.unique(ids[odd]).tolist()}
        owner, times = np.repeat(np.arange(len(count)), count), np.ones(len(ids), np.int64)
        times[odd] = [len(raw[c]) for c in ids[odd].tolist()]
        out = np.repeat(ids, times)
        first = np.cumsum(times) - times
        for i in odd.tolist():
            out[first[i] : first[i] + times[i]] = raw[int(ids[i])]
        return out, np.bincount(owner, times, len(count)).astype(np.int64)


@lru_cache(2)
def agenda(path: str) -> Agenda:
    return Agenda(pieces(path))


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each slice, one slice after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


WIDTHS = (6, 8, 10, 12, 16, 24, LONG)


def batches(size: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of segments, those of about equal length together, BLOCK at a time, so that their arrays stay in the processor's cache."""
    kind = np.searchsorted(WIDTHS, size)
    order = np.argsort(kind, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
        for at in range(0, len(some), BLOCK):
            yield some[at : at + BLOCK]


class Known:
    """Segments' symbols, what they become if no candidate is skipped, and their candidates; all in flat arrays. Emptied when it has CACHE segments."""

    def __init__(self, own: Agenda):
        self.agenda = own
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {b"": 0}
        self.ids, self.candidates = np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.symbols, self.ranks = np.zeros(0, np.int32), np.zeros(0, np.int32)
        #: Where the symbols, ids and candidates of each segment begin and the last one's end.
        self.bounds = [np.zeros(2, np.int64) for _ in range(3)]

    def add(self, names: list[bytes], segments: list[str]) -> np.ndarray:
        """The places of new segments, which are kept by name."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        groups = list(batches(size))
        order = np.concatenate(groups)
        segments, size = [segments[i] for i in order.tolist()], size[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(self.place), len(self.place) + len(order))
        self.place.update(zip(names, place.tolist()))
        symbols, ranks = self.agenda.symbols(segments, size)
        ends = np.concatenate([[0], np.cumsum(size)])
        ids, mixed, counts, seen, at = [self.ids], [self.candidates], [], [], 0
        for some in map(len, groups):
            flat = slice(ends[at], ends[at + some])
            made, count, (row, left, found) = self.agenda.run(symbols[flat], ranks[flat], size[at : at + some], None, 0)
            ids.append(made.astype(np.int32))
            counts.append(count)
            mixed.append(((left * 0x85EBCA77 ^ found * 0xC2B2AE3D) & M32).astype(np.uint32)[np.argsort(row, kind="stable")])
            seen.append(np.bincount(row, minlength=some))
            at += some
        self.ids, self.candidates = np.concatenate(ids), np.concatenate(mixed)
        self.symbols, self.ranks = np.concatenate([self.symbols, symbols]), np.concatenate([self.ranks, ranks])
        sizes = (size, np.concatenate(counts), np.concatenate(seen))
        self.bounds = [np.concatenate([b, b[-1] + np.cumsum(c)]) for b, c in zip(self.bounds, sizes, strict=True)]
        return place


class Encoder:
    """Encodes whole texts; the same seed, key and text always give the same ids."""

    def __init__(self, path: str = MODEL, dropout: float = 0.1, seed: int = 0):
        if not 0 <= dropout < 1:
            raise ValueError("dropout is a probability under 1")
        self.vocabulary, self.seed = pieces(path), seed
        self.skip = int(dropout * (1 << 32))
        self.agenda = agenda(path)
        self.known = Known(self.agenda)
        raw = self.vocabulary.raw
        self.raw, self.raw_size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size

    def keys(self, key: int, n: int, first: int = 0) -> np.ndarray:
        """The skip keys of ``n`` places of a document from the ``first``, 32 bits each."""
        at = np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 0xC2B2AE3D27D4EB4F + self.seed * 0x165667B19E3779F9) & M64)
        at = (at ^ at >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        at = (at ^ at >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return (at ^ at >> np.uint64(31)) & np.uint64(M32)

    def segment_ids(self, segment: str, place: int, key: int = 0) -> tuple[int, ...]:
        """Ids of a segment at a place of a document, one candidate after the other."""
        return merge(self.vocabulary, segment, int(self.keys(key, place + 1)[place]), self.skip)

    def encode(self, text: str, key: int | None = 0) -> list[int]:
        """Ids of a text. A space is put before it, as the model expects; one written U+2581 stays what it is by byte pieces."""
        return self.encode_all([text], [key or 0])[0].tolist()

    def encode_all(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each)."""
        parts: list[tuple[bytes, int]] = []
        marks = [0] * len(texts)
        mark = [self.vocabulary.byte[b] for b in SPACE.encode()]
        owners: list[int] = []
        for d, (text, key) in enumerate(zip(texts, keys, strict=True)):
            if text:
                # the mark for a space, where a text has it itself, is encoded by its bytes
                for i, part in enumerate((" " + text).encode("utf-8", "surrogatepass").split(SPACE.encode())):
                    marks[d] = i
                    parts.append((part, key + i))
                    owners.append(d)
        done, sizes = [], []
        for ids, size in self._parts(parts):
            done.append(ids)
            sizes.append(size)
        flat, size = np.concatenate([np.zeros(0, np.int64), *done]), np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)
        if any(marks):
            owner = np.array(owners)
            later = np.append(False, owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, bool)
            out, at = [], 0
            for n, more in zip(size.tolist(), later.tolist(), strict=True):
                out.append(np.concatenate([np.array(mark if more else [], np.int64), flat[at : at + n]]))
                at += n
            flat, size = np.concatenate(out), size + later * len(mark)
        return flat, np.bincount(np.array(owners, np.int64), size, len(texts)).astype(np.int64)

    def _parts(self, parts: list[tuple[bytes, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids of each) of some of the parts (text without U+2581, key) after the other, about GROUP segments at a time."""
        some, total = [], 0
        for part in parts:
            some.append(part)
            total += len(part[0])
            if total >= 8 * GROUP:
                yield self._ids(some)
                some, total = [], 0
        if some:
            yield self._ids(some)

    def _ids(self, parts: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(text for text, _ in parts), np.uint8)
        length = np.array([len(text) for text, _ in parts], np.int64)
        ends = np.concatenate([[0], np.cumsum(length)])
        # as ``cut`` does: a segment is a run of spaces with what follows it, or what a part has before its first space
        space = data == 32
        first = space & (not self.vocabulary.crossing)
        first[1:] &= ~space[:-1]
        first[ends[:-1][length > 0]] = True
        bounds = np.append(np.flatnonzero(first), len(data))
        at = np.searchsorted(bounds[:-1], ends)
        keys = np.concatenate([self.keys(key, n) for (_, key), n in zip(parts, np.diff(at).tolist(), strict=True)])
        ids, size, held = [], [], pa.py_buffer(data)
        for i in range(0, len(keys), GROUP):
            n = min(GROUP, len(keys) - i)
            segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds[i : i + n + 1].copy()), held])
            made, count = self._group(segments, keys[i : i + n])
            ids.append(made)
            size.append(count)
        size = np.concatenate([np.zeros(0, np.int64), *size])
        return np.concatenate([np.zeros(0, np.int64), *ids]), np.diff(np.concatenate([[0], np.cumsum(size)])[at])

    def _group(self, segments: pa.LargeBinaryArray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, and how many each has."""
        known, own = self.known, {}
        coded = segments.dictionary_encode()
        index, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        spell = lambda i: names[i].decode("utf-8", "surrogatepass").replace(" ", SPACE)
        place = np.fromiter(map(known.place.get, names, repeat(-1)), np.int64, len(names))
        new, far = {}, {}
        for i in np.flatnonzero(place < 0).tolist():
            x = spell(i)
            # what is known already isn't far
            (far if len(x) > LONG or x[1:2] == SPACE or not self.agenda.exact else new)[i] = x
        if len(known.place) + len(new) > CACHE:
            known.clear()
            new = {i: new[i] if i in new else spell(i) for i in range(len(names)) if i not in far}
        if new:
            place[list(new)] = known.add([names[i] for i in new], list(new.values()))
        if far:
            place[list(far)] = 0  # the empty segment
            apart = np.zeros(len(names), bool)
            apart[list(far)] = True
            own = {j: np.array(merge(self.vocabulary, far[int(index[j])], int(keys[j]), self.skip), np.int64) for j in np.flatnonzero(apart[index]).tolist()}
        place = place[index]
        (low, start, first), (high, stop, last) = (b[place] for b in known.bounds), (b[place + 1] for b in known.bounds)
        size, store = stop - start, [known.ids]
        if self.skip:
            below, todo = np.uint64(self.skip << 32), []
            for at in range(0, len(place), BLOCK):
                own_first = first[at : at + BLOCK]
                n = last[at : at + BLOCK] - own_first
                mixed = known.candidates[gather(own_first, n)] ^ np.repeat(keys[at : at + BLOCK].astype(np.uint32), n)
                hit = np.flatnonzero(mixed * np.uint64(0x9E3779B97F4A7C15) < below)
                here = np.searchsorted(np.cumsum(n), hit, "right")
                todo.append(at + here[np.diff(here, prepend=-1) > 0])
            todo = np.concatenate(todo)
            low, length = low[todo], (high - low)[todo]
            base = len(known.ids)
            for group in batches(length):
                some, flat = todo[group], gather(low[group], length[group])
                ids, count, _ = self.agenda.run(known.symbols[flat], known.ranks[flat], length[group], keys[some], self.skip)
                store.append(ids.astype(np.int32))
                start[some], size[some] = base + np.cumsum(count) - count, count
                base += len(ids)
        else:
            base = len(known.ids)
        for i, ids in own.items():
            store.append(ids)
            start[i], size[i] = base, len(ids)
            base += len(ids)
        return np.concatenate(store)[gather(start, size)].astype(np.int64), size

    def spelled(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, one after the other."""
        return self.raw[gather(self.raw_start[ids], self.raw_size[ids])].tobytes()

    def decode(self, ids: list[int]) -> str:
        """The text that ``ids`` were made from, exactly."""
        return self.spelled(np.array(ids, np.int64))[1:].decode(errors="replace")


@lru_cache(1)
def encoder(path: str, dropout: float, seed: int) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path, dropout, seed)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = MODEL, dropout: float = 0.1, seed: int = 0, extra: list[str] = (), keep_ids: bool = True) -> DataFrame:
    """(key, *extra, ids, n_pieces, n_byte_pieces, ids_digest, lossless) of every whole text.

    ids_digest is the XXH64 of the ids as little-endian 32-bit numbers, in hex;
    lossless says that decoding gave the text back. Null and empty texts have
    no ids and are lossless. Copies of a text under other keys or another seed
    are cut differently; an empty table gives no rows; other columns are ignored. ``path`` must be readable on every executor.
    """

    def run(texts: list, keys: list) -> dict[str, pa.Array]:
        e = encoder(path, dropout, seed)
        low, high = min(e.vocabulary.byte), max(e.vocabulary.byte)
        raw = [t or b"" for t in texts]
        flat, size = e.encode_all([t.decode() for t in raw], [xxhash.xxh64_intdigest(t, xxhash.xxh64_intdigest(str(k), seed & M64)) for t, k in zip(raw, keys, strict=True)])
        ends = np.concatenate([[0], np.cumsum(size)])
        by_byte = np.concatenate([[0], np.cumsum((flat >= low) & (flat <= high))])
        small = flat.astype("<i4")
        digest = [xxhash.xxh64_hexdigest(small[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
        spelled, at = e.spelled(flat), np.concatenate([[0], np.cumsum(e.raw_size[flat])])[ends].tolist()
        same = [spelled[a:b] == (b" " + t if t else t) for t, a, b in zip(raw, at, at[1:])]
        cols = {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(small))} if keep_ids else {}
        return cols | {"n_pieces": pa.array(size, pa.int64()), "n_byte_pieces": pa.array(np.diff(by_byte[ends]), pa.int64()), "ids_digest": pa.array(digest, pa.string()), "lossless": pa.array(same, pa.bool_())}

    schema = ("ids array<int>, " if keep_ids else "") + "n_pieces long, n_byte_pieces long, ids_digest string, lossless boolean"
    return map_texts(df, key, text, run, schema, list(extra), keyed=True)


def op5_sentencepiece_dropout(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
