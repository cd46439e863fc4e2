"""Benchmark decontamination by q-gram filtering on diagonals.

An item occurs in a document if the item aligns with some part of it within an
edit budget. By the q-gram lemma, such an alignment of an item of n characters
within k edits keeps n + 1 - q - k q of the item's q-grams on at most 2 k + 1
neighbouring diagonals. Shared q-grams are counted in overlapping diagonal
bands of a document against each item; bands that reach the bound are regions,
and each region is verified by a banded alignment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .rows import give_back, numbered
from .shared import materialise

#: Edits allowed per hundred characters of a normalised item.
BUDGET = 10
#: Benchmark characters searched for in one pass; a larger benchmark takes more passes.
PASS_CHARS = 4_000_000
#: Characters of documents and shared q-grams held at a time; both only bound memory.
BATCH_CHARS, HITS = 250_000, 500_000
Q_MOST = 8
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and whether a letter or digit, of the code points below 65536."""
    if not _TABLES:
        chars = [chr(c) for c in range(65536)]
        _TABLES["low"] = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars], np.uint32)
        _TABLES["word"] = np.array([c.isalnum() for c in chars])
    return _TABLES["low"], _TABLES["word"]


def normalise(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(code points, places): lower-cased letters and digits, one space for anything between them; places are where they stand in the text."""
    c = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    low, word = _tables()
    base = c < 65536
    small = np.minimum(c, 65535)
    is_word = word[small] | ~base
    keep = is_word.copy()
    keep[1:] |= is_word[:-1]  # the first of what stands between two words becomes a space
    at = np.flatnonzero(keep)
    out = np.where(is_word[at], np.where(base[at], low[small[at]], c[at]), 32)
    if len(out) and out[-1] == 32:
        out, at = out[:-1], at[:-1]
    return out.astype(np.uint32), at


def budget(n: int, rate: int = BUDGET) -> int:
    return n * rate // 100


def gram_size(n: int, rate: int = BUDGET, most: int = Q_MOST, least_kept: int = 4) -> int:
    """The largest q of up to ``most`` of which an occurrence keeps ``least_kept`` q-grams or more; at least 1."""
    k = budget(n, rate)
    return max([q for q in range(1, most + 1) if n + 1 - q - k * q >= least_kept], default=1)


def grams(x: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit code of the q characters from each place on."""
    n = max(0, len(x) - q + 1)
    code = np.zeros(n, np.uint64)
    for i in range(q):
        code = code * np.uint64(0x100000001B3) ^ x[i : i + n].astype(np.uint64)
    code ^= code >> np.uint64(29)
    return code * np.uint64(0x9E3779B97F4A7C15)


def banded_distance(item: np.ndarray, part: np.ndarray, limit: int, shift: int = 0, width: int | None = None) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of all of ``item`` with a part of ``part``, or None above ``limit``.

    Only diagonals from ``shift`` to ``shift + width`` are computed. The least
    edits win, then the earliest end.
    """
    n, m = len(item), len(part)
    width = m if width is None else width
    big = n + m + 1
    cols = np.arange(width + 1)
    j = shift + cols  # how many characters of part are used before row 0, on each diagonal
    cost = np.where((j >= 0) & (j <= m), 0, big)
    start = j.copy()
    for i in range(1, n + 1):
        j = j + 1
        ok = (j >= 1) & (j <= m)
        match = np.zeros(width + 1, bool)
        match[ok] = part[j[ok] - 1] == item[i - 1]
        step = cost + ~match
        step[~ok] = big
        down = np.append(cost[1:] + 1, big)  # a character of the item without a counterpart
        down[(j < 0) | (j > m)] = big
        use = down < step
        best, origin = np.where(use, down, step), np.where(use, np.append(start[1:], 0), start)
        run = np.minimum.accumulate(best - cols)  # characters of the part without a counterpart
        ahead = run + cols
        first = np.maximum.accumulate(np.where(best - cols == run, np.where(np.append(True, run[1:] < run[:-1]), cols, 0), 0))
        origin = np.where(ahead < best, origin[first], origin)
        cost, start = np.minimum(best, ahead), origin
        cost[(j < 0) | (j > m)] = big
        if cost.min() > limit:
            return None
    at = int(cost.argmin())
    return int(cost[at]), int(start[at]), int(j[at])


class Index:
    """The q-grams of benchmark items, by q and sorted by code, with a bitmap for a first look."""

    def __init__(self, items: list[tuple[int, str | None]], rate: int = BUDGET):
        self.ids, self.texts, self.rate, self.by_q = [], [], rate, {}
        for item, text in items:
            x, _ = normalise(text)
            if len(x):
                self.ids.append(item)
                self.texts.append(x)
        size = np.array([len(x) for x in self.texts], np.int64)
        self.before = int(size.max(initial=0)) + 2  # bands that may lie before a text's first character
        qs = np.array([gram_size(n, rate) for n in size])
        self.k = np.array([budget(n, rate) for n in size], np.int64)
        self.need = np.maximum(1, size + 1 - qs - self.k * qs)
        for q in sorted(set(qs.tolist())):
            own = np.flatnonzero(qs == q)
            code = np.concatenate([grams(self.texts[i], q) for i in own])
            item = np.concatenate([np.full(max(0, size[i] - q + 1), i) for i in own])
            place = np.concatenate([np.arange(max(0, size[i] - q + 1)) for i in own])
            order = np.argsort(code, kind="stable")
            bits = min(24, 6 + int(np.ceil(np.log2(max(2, len(code))))))
            seen = np.zeros(1 << bits, bool)
            seen[code >> np.uint64(64 - bits)] = True
            self.by_q[q] = (code[order], item[order], place[order], seen, np.uint64(64 - bits))

    def regions(self, x: np.ndarray, doc: np.ndarray, offset: np.ndarray) -> set[tuple[int, int, int, int]]:
        """(document, item, first diagonal, number of diagonals) of bands that reach their item's bound."""
        found = set()
        wide = (len(x) + 2 * self.before + 2).bit_length()  # so that any band of the texts at hand has a number
        for q, (code, item, place, seen, shift) in self.by_q.items():
            own = grams(x, q)
            at = np.flatnonzero(seen[own >> shift])
            if not len(at):
                continue
            lo, hi = np.searchsorted(code, own[at], "left"), np.searchsorted(code, own[at], "right")
            times = hi - lo
            at, lo, times = at[times > 0], lo[times > 0], times[times > 0]
            counted = []
            for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(times) // HITS)) + 1):
                if len(part):
                    counted.append(self._bands(doc, offset, at[part], lo[part], times[part], item, place, wide))
            if not counted:
                continue
            code, count = np.concatenate([c[0] for c in counted]), np.concatenate([c[1] for c in counted])
            if len(counted) > 1:
                code, back = np.unique(code, return_inverse=True)
                count = np.bincount(back, count)
            who, i = np.divmod(code >> wide + 1, len(self.ids))
            good = np.flatnonzero(count >= self.need[i])
            for d, i, side, b in zip(who[good].tolist(), i[good].tolist(), (code[good] >> wide & 1).tolist(), (code[good] & (1 << wide) - 1).tolist(), strict=True):
                w = int(2 * self.k[i] + 1)
                found.add((d, i, (b - self.before) * 2 * w - side * w, 2 * w))
        return found

    def _bands(self, doc: np.ndarray, offset: np.ndarray, at: np.ndarray, lo: np.ndarray, times: np.ndarray, item: np.ndarray, place: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
        """(code, count): q-grams shared by (document, item, side, band), all four in one number. Bands are twice as wide as an occurrence; those of the
        two sides overlap by half, so that one band holds all of it."""
        source = np.repeat(at, times)
        hit = np.repeat(lo - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(len(source))
        it, diagonal = item[hit], source - place[hit]
        half, owner = 2 * self.k[it] + 1, doc[source]
        diagonal -= offset[owner]
        code = (owner * len(self.ids) + it) << wide + 1
        codes = np.concatenate([code | side << wide | ((diagonal + side * half) // (2 * half) + self.before) for side in (0, 1)])
        spot = np.concatenate([place[hit]] * 2)
        order = np.lexsort((spot, codes))
        codes, spot = codes[order], spot[order]
        once = np.append(True, (codes[1:] != codes[:-1]) | (spot[1:] != spot[:-1]))  # each of the item's q-grams counts once
        return np.unique(codes[once], return_counts=True)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(row, item id, start, end, edits) of the best occurrence of each item in each text; start and end are characters."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        todo, size = [], 0
        for row, t in enumerate(texts):
            x, at = normalise(t)
            if todo and size + len(x) > BATCH_CHARS:
                self._batch(todo, best)
                todo, size = [], 0
            todo.append((row, x, at))
            size += len(x)
        self._batch(todo, best)
        return [(row, self.ids[i], s, e, k) for (row, i), (k, s, e) in sorted(best.items())]

    def _batch(self, todo: list, best: dict) -> None:
        gap = np.zeros(Q_MOST, np.uint32)
        whole = np.concatenate([y for _, x, _ in todo for y in (x, gap)]) if todo else gap
        offset = np.cumsum([0] + [len(x) + Q_MOST for _, x, _ in todo])
        doc = np.repeat(np.arange(len(todo)), np.diff(offset))
        for d, i, diagonal, width in sorted(self.regions(whole, doc, offset)):
            row, x, at = todo[d]
            item, k = self.texts[i], int(self.k[i])
            first = diagonal - k
            lo = max(0, first)
            part = x[lo : max(lo, first + width + 2 * k + len(item) + k)]
            if (row, i) in best and best[row, i][0] == 0:
                continue
            exact = part.tobytes().find(item.tobytes())
            if exact >= 0 and exact % 4 == 0:
                got = (0, exact // 4, exact // 4 + len(item))
            else:
                got = banded_distance(item, part, k, first - lo, width + 2 * k)
            if got is not None:
                e = (got[0], int(at[lo + got[1]]) if got[1] < len(part) else 0, int(at[lo + got[2] - 1]) + 1)
                if (row, i) not in best or e < best[row, i]:
                    best[row, i] = e


def contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", rate: int = BUDGET, pass_chars: int = PASS_CHARS) -> DataFrame:
    """(key, item, start, end, edits): each benchmark item that occurs in a document, at its best place.

    An item occurs where all its letters and digits, lower-cased, with one space
    for whatever stands between words, align with a part of the document within
    ``rate`` edits per hundred characters. start and end are characters of the
    document's own text. Items without letters and digits occur nowhere; null
    and empty texts hold nothing; repeated rows and repeated items give repeated
    rows; empty tables give none; other columns are ignored.

    The benchmark is searched for in passes of at most ``pass_chars``
    characters (one item more at most), one after the other; each is sent to the
    executors as one index and taken back, so what is sent at a time is bounded
    however large the benchmark is. Each pass reads the documents.
    """
    kind, item_kind = documents.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema[item].dataType)
    total = benchmark.agg(F.sum(F.char_length(item_text))).first()[0] or 0
    passes = max(1, -(-total * 5 // (4 * pass_chars))) if total > pass_chars else 1
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = None
    for n in range(passes):
        own = benchmark.where(F.pmod(F.xxhash64(item, item_text), F.lit(passes)) == n).select(item, item_text)
        index = Index(sorted(((r[0], r[1]) for r in own.collect()), key=str), rate)
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    found = shared.value.search(part.column(1).to_pylist())
                    cols = list(zip(*found, strict=True)) or [[]] * 5
                    owner = part.column(0).take(pa.array(cols[0], pa.int64()))
                    yield pa.RecordBatch.from_arrays([owner, pa.array(cols[1], item_type), *(pa.array(c, pa.int64()) for c in cols[2:])], ["key", "item", "start", "end", "edits"])
            give_back()

        got = materialise(rows.mapInArrow(run, f"key {kind}, item {item_kind}, start long, end long, edits long"), "occurrences")
        shared.destroy()
        out = got if out is None else out.union(got)
    return out.withColumnsRenamed({"key": key, "item": item})


def decontaminate(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents in which no benchmark item occurs.

    Rows without a key and null and empty texts stay; all rows of a key go if an
    item occurs in one of them; all columns stay, whatever their names; an empty
    benchmark or table changes nothing.
    """
    d = numbered(documents)
    own = d.columns[documents.columns.index(key)]
    found = contaminated(d.where(F.col(own).isNotNull()), benchmark, own, d.columns[documents.columns.index(text)], **options).select(F.col(own).alias("found")).distinct()
    found = materialise(found, "contaminated")  # of known size, so that Spark can broadcast it where it is small
    return d.join(found, d[own] == F.col("found"), "left_anti").toDF(*documents.columns)


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
