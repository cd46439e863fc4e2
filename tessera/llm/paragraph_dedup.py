"""Substring deduplication by paragraphs, MinHash bands and anchors.

Texts are cut into paragraphs where their words say so, so equal passages are
cut alike wherever they stand. Paragraphs that collide in a MinHash band of
five-word shingles are verified by their exact edit distance in words (a fifth
may differ) and clustered by components. A paragraph is compared with the first of its class,
with its own first occurrence and, once for each link, with the paragraph it is linked to. As a passage of little over 50
words need not hold a whole paragraph, anchors add what paragraphs can't see:
of every 13 neighbouring runs of 12 words the one with the least hash, so texts
that agree over 24 words share one. Paragraphs and anchors say which two texts
to compare and at which shift; there they are compared word by word, and
stretches that agree are joined over changes while the whole keeps 0.8. The
first occurrence stays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .crowds import crowd_links
from .graph import connected_components
from .rows import give_back, numbered
from .shared import discard, materialise, release

SHINGLE, SIMILARITY = 5, 0.8
#: Words between the cuts of paragraphs: over REACH, at most LONGEST; about 2 * REACH + 1 on average.
REACH, LONGEST = 28, 160
#: MinHashes in a band, and how sure a pair of the least similarity is to share a band.
ROWS, RECALL = 4, 0.95
#: Words of an anchor; of so many neighbours one is an anchor; so far beyond an anchor texts are compared.
ANCHOR, WINDOW, RADIUS = 12, 13, 48
#: Words of the least passage that is reported.
MIN_WORDS = 40
#: Words of a text that are kept together for comparing, and how many different codes words have there: UTF-16 characters that stand alone.
CHUNK, CODES = 128, np.uint64(0xD800)
#: SQL: 256 bits over the characters of ``own``, each with how often it was there before: a bit is 1 if an odd number of them has it.
SKETCH = (
    "aggregate(array_sort(split(own, '')), named_struct('g', '', 'c', 0, 'w', array(0L, 0L, 0L, 0L)), (s, g) -> transform(array(if(g = s.g, s.c + 1, 0)), c -> "
    "transform(array(pmod(xxhash64(g, c), 256)), p -> named_struct('g', g, 'c', c, 'w', transform(s.w, (x, k) -> if(k = p div 64, x ^ shiftleft(1L, cast(p % 64 as int)), x))))[0])[0], s -> s.w)"
)
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
TOP = np.uint64((1 << 64) - 1)
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def bands_for(similarity: float, recall: float, rows: int = 1) -> int:
    """Bands of ``rows`` MinHashes that find a pair at ``similarity`` with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * B
    x = (x ^ (x >> np.uint64(27))) * C
    return x ^ (x >> np.uint64(31))


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each slice, one slice after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the lower-cased words of a text."""
    words = (text or b"").lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours of ``x``."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def cuts(h: np.ndarray, reach: int = REACH, longest: int = LONGEST) -> np.ndarray:
    """First words of the paragraphs of a text with word hashes ``h``; at least ``reach`` + 1 words apart, at most ``longest``."""
    n = len(h)
    pair = mix(h ^ np.append(h[1:], np.uint64(0)) * A)
    around = np.full(n + 2 * reach, TOP)
    around[reach : reach + n] = pair
    least = least_of(around, reach)  # of the words before at i, of those after at i + reach + 1
    at = np.flatnonzero((pair < least[:n]) & (pair <= least[reach + 1 : reach + 1 + n]))
    at = np.unique(np.append(0, at)) if n else at
    gaps = np.diff(np.append(at, n))
    if len(gaps) and gaps.max() > longest:
        at = np.concatenate([np.arange(a, a + g, longest) for a, g in zip(at, gaps)])
    return at


def shingle_hashes(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of the ``size`` words from each word on."""
    n = max(0, len(h) - size + 1)
    s = h[:n].copy()
    for k in range(1, size):
        s *= A
        s += h[k : k + n]
    return mix(s)


def minima(h: np.ndarray, at: np.ndarray, n: np.ndarray, content: np.ndarray, bands: int, rows: int = 1) -> list[np.ndarray]:
    """A hash of ``rows`` MinHashes of each paragraph (first words ``at``, lengths ``n``) for each band. A paragraph under a shingle's length has itself as its only shingle.

    One pass deals the shingles to as many parts as there are minima; a part without any takes the next one's least.
    """
    if not len(at):
        return [np.zeros(0, np.uint64)] * bands
    held, count = np.maximum(n - SHINGLE + 1, 1), bands * rows
    s = np.append(shingle_hashes(h), np.zeros(min(len(h), SHINGLE - 1), np.uint64))
    s[at[n < SHINGLE]] = content[n < SHINGLE]
    owner = np.repeat(np.arange(len(at)), held)
    s = mix(s[gather(at, held)] ^ A)
    part = owner * count + ((s >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
    least = np.full(len(at) * count, TOP)
    np.minimum.at(least, part, mix(s))
    least = least.reshape(-1, count)
    places = np.arange(2 * count)
    there = np.where(np.tile(least != TOP, 2), places, 2 * count)
    following = np.minimum.accumulate(there[:, ::-1], axis=1)[:, ::-1][:, :count]
    far = (following - places[:count]).astype(np.uint64)
    least = np.take_along_axis(least, following % count, axis=1) + far * C
    out = []
    for k in range(bands):
        band = np.full(len(at), k, np.uint64)
        for r in range(rows):
            band = mix(band * A + least[:, k * rows + r])
        out.append(band)
    return out


class Paragraphs:
    """The paragraphs of a sequence of word hashes: first words, lengths, content hashes, MinHashes and, on demand, shingles."""

    def __init__(self, text: bytes | None = None, h: np.ndarray | None = None):
        if h is None:
            begin, end, h = word_spans(text)
        self.h = h
        self.at = at = cuts(h)
        self.n = np.diff(np.append(at, len(h)))
        if text is not None:
            self.start, self.end = begin[at], end[at + self.n - 1] if len(at) else at
        raw, digest = h.tobytes(), xxhash.xxh64_intdigest
        self.content = np.array([digest(raw[8 * a : 8 * (a + n)]) for a, n in zip(at.tolist(), self.n.tolist())], np.uint64)

    def minima(self, bands: int, rows: int = 1) -> list[np.ndarray]:
        return minima(self.h, self.at, self.n, self.content, bands, rows)

    def shingles(self, i: int) -> np.ndarray:
        h = self.h[self.at[i] : self.at[i] + self.n[i]]
        return np.unique(shingle_hashes(h)) if len(h) >= SHINGLE else self.content[i : i + 1]


def paragraphs(df: DataFrame, key: str, text: str, bands: int, rows: int = 1) -> DataFrame:
    """(key, unit, start, stop, n_words, content, m0, m1, ...) of every paragraph; start and stop are byte offsets in the text as UTF-8."""
    kind = df.schema[key].dataType.simpleString()
    names = ["key", "unit", "start", "stop", "n_words", "content", *(f"m{k}" for k in range(bands))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [Paragraphs(t or b"") for t in part.column(1).to_pylist()]
                owner = np.repeat(np.arange(len(found)), [len(p.at) for p in found])
                cols = [[np.arange(len(p.at)), p.start, p.end, p.n, p.content.view(np.int64), *(m.view(np.int64) for m in p.minima(bands, rows))] for p in found]
                made = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*cols, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *made], names)

    texts = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"key {kind}, " + ", ".join(f"{n} long" for n in names[1:]))


def wanted_shingles(df: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(content, shingles) of the paragraphs in ``wanted`` (key, content), cut again from their documents."""
    by_key = wanted.groupBy("key").agg(F.collect_set("content").alias("want"))
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).join(by_key, "key").select("text", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                content, sets = [], []
                for t, want in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    p, left = Paragraphs(t), set(want)
                    for i, c in enumerate(p.content.view(np.int64).tolist()):
                        if c in left:
                            left.discard(c)
                            content.append(c)
                            sets.append(p.shingles(i).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(content, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["content", "shingles"])

    return rows.mapInArrow(run, "content long, shingles array<long>").dropDuplicates(["content"])


def near_links(df: DataFrame, groups: DataFrame, key: str, text: str, bands: int, similarity: float = SIMILARITY, hot: int = 64, held: Callable[[DataFrame], DataFrame] | None = None, close: str | None = None, screen: tuple[dict[str, str], str] | None = None) -> DataFrame:
    """(a, b): contents of verified similarity, a written table; ``groups`` has (content, key, m0, ...), a content once.

    Contents that ``held`` doesn't give have no links.

    Buckets of up to ``hot`` contents give their pairs; larger ones are linked
    by leaders, which gives the same components without all their pairs.
    ``held`` gives (content, own) of contents (key, content), and ``close`` says
    in SQL whether ``x`` and ``y`` of two contents are similar. Unless given,
    these are five-word shingles, cut again from the texts of ``df``, and their
    Jaccard similarity. ``screen`` has columns in SQL over ``own``, and in SQL
    over these and their namesakes with ``_b`` what all similar contents fulfil.
    """
    held = held or (lambda wanted: wanted_shingles(df, wanted, key, text))
    close = close or f"(1 + {similarity}) * size(array_intersect(x, y)) >= {similarity} * (size(x) + size(y)) - 1e-9"
    minima = F.array(*(F.struct(F.lit(k).alias("band"), F.col(f"m{k}").alias("m")) for k in range(bands)))
    rows = groups.select("content", F.explode(minima).alias("x")).select("content", F.xxhash64("x.band", "x.m").alias("bucket"))
    sizes = materialise(rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    shared = materialise(rows.join(sizes, "bucket"), "buckets")
    discard(sizes)
    if not shared.take(1):
        return shared.select(F.col("content").alias("a"), F.col("content").alias("b"))
    wanted = shared.select("content").distinct().join(groups.select("content", "key"), "content")
    sets = materialise(held(wanted), "held")
    columns, near = screen or ({}, "true")
    known = materialise(shared.join(sets.select("content", *(F.expr(x).alias(c) for c, x in columns.items())), "content"), "buckets")
    discard(shared)
    shared = known

    def verify(pairs: DataFrame) -> DataFrame:
        return pairs.select("a", "b").distinct().join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").where(close).select("a", "b")

    small = shared.where(F.col("size") <= hot).drop("size")
    others = small.withColumnsRenamed({"content": "b"} | {c: f"{c}_b" for c in columns})
    pairs = small.withColumnRenamed("content", "a").join(others, "bucket").where("a < b").where(near).select("a", "b")
    links = materialise(verify(pairs), "links")
    crowded = materialise(shared.where(F.col("size") > hot).drop("size").withColumnRenamed("content", "id"), "crowded")
    if crowded.take(1):
        links = crowd_links(crowded, links, verify, list(columns), near=near)
    discard(shared, sets, crowded)
    return links


def word_spans(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes, ends and hashes of the words of a text."""
    text = text or b""
    space = np.ones(len(text) + 2, bool)
    space[1:-1] = SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2], word_hashes(text)


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of ANCHOR words each: the least of every WINDOW neighbours, so equal stretches of ANCHOR + WINDOW - 1 words share one."""
    s = shingle_hashes(h, ANCHOR)
    if not len(s):
        return np.zeros(0, np.int64), s
    width = min(WINDOW, len(s))
    at = np.unique(np.lib.stride_tricks.sliding_window_view(s, width).argmin(1) + np.arange(len(s) - width + 1))
    a = s[at]
    # of an anchor that follows itself, as in text that repeats one word, every WINDOW-th is enough: any of them shows the same
    fresh = np.append(True, a[1:] != a[:-1])
    nth = np.arange(len(a)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    keep = (nth % WINDOW == 0) | np.append(fresh[1:], True)
    return at[keep], a[keep]


def index(df: DataFrame, key: str, text: str, bands: int, rows: int) -> DataFrame:
    """One row per text: (key, words, anchor_pos, anchor, para_pos, para_n, para, bands).

    words: 16 bits for each word, from its hash. anchor_pos, anchor: places and hashes of
    anchors, ``~place`` for one that the text had before. para_pos, para_n, para: first words,
    lengths and contents of paragraphs; bands: their band hashes, ``bands`` each.
    """
    kind = df.schema[key].dataType.simpleString()
    ints = lambda arrays, k: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, k), *arrays]).astype(k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hs = [word_hashes(t) for t in part.column(1).to_pylist()]
                words, pos, anchor, found = [], [], [], [Paragraphs(h=h) for h in hs]
                for h in hs:
                    words.append((h % CODES).astype("<u2").tobytes())
                    a, s = anchors(h)
                    before = np.ones(len(s), bool)
                    before[np.unique(s, return_index=True)[1]] = False
                    pos.append(np.where(before, ~a, a))
                    anchor.append(s.view(np.int64))
                start, size, content = [p.at for p in found], [p.n for p in found], [p.content for p in found]
                first = np.cumsum([0, *map(len, hs)])
                whole = [np.concatenate([np.zeros(0, k), *x]) for x, k in ((hs, np.uint64), ([a + f for a, f in zip(start, first)], np.int64), (size, np.int64), (content, np.uint64))]
                least, ends = np.column_stack([np.zeros((len(whole[1]), 0), np.uint64), *minima(*whole, bands, rows)]).view(np.int64), np.cumsum([0, *map(len, start)])
                bands_of = [least[a:b].ravel() for a, b in zip(ends, ends[1:])]
                content = [c.view(np.int64) for c in content]
                made = [pa.array(words, pa.binary()), ints(pos, np.int32), ints(anchor, np.int64), ints(start, np.int32), ints(size, np.int32), ints(content, np.int64), ints(bands_of, np.int64)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], ["key", "words", "anchor_pos", "anchor", "para_pos", "para_n", "para", "bands"])
        give_back()

    texts = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"key {kind}, words binary, anchor_pos array<int>, anchor array<long>, para_pos array<int>, para_n array<int>, para array<long>, bands array<long>")


def over_texts(df: DataFrame, lists: DataFrame, key: str, text: str, f, schema: str) -> DataFrame:
    """``f`` gets each text and the list that ``lists`` (key, items) has for its key, and returns rows."""
    rows = lists.join(df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")), "key").select("key", "text", "items")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [f(t, items) for t, items in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
                columns = list(zip(*(r for x in found for r in x), strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["key", *names])
        give_back()

    kind = rows.schema["key"].dataType
    kinds = [_ARROW.get(x.split()[1]) or pa.string() for x in schema.split(", ")]
    return rows.mapInArrow(run, f"key {kind.simpleString()}, {schema}")


_ARROW = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}


def chains(runs: list[tuple[int, int, int]], similarity: float = SIMILARITY) -> list[tuple[int, int, int, int]]:
    """(first, end, first there, end there) of the passages that exact ``runs`` (first, end, first there) make up.

    Neighbouring runs are joined as far as the whole keeps its Jaccard
    similarity, the longest first.
    """
    found, runs = [], sorted(runs)
    groups: list[list[tuple[int, int, int]]] = []
    for r in runs:
        last = groups[-1][-1] if groups else None
        if last and -SHINGLE < r[0] - last[1] <= RADIUS and -SHINGLE < r[2] - last[2] - last[1] + last[0] <= RADIUS:
            groups[-1].append(r)
        else:
            groups.append([r])
    todo = groups
    while todo:
        g, best = todo.pop(), None
        common = np.cumsum([0, *(max(0, e - b - SHINGLE + 1) for b, e, _ in g)])
        for i in range(len(g)):
            for j in range(len(g) - 1, i - 1, -1):
                here, there = g[j][1] - g[i][0], g[j][2] + g[j][1] - g[j][0] - g[i][2]
                if best and here <= best[0]:
                    break
                c = int(common[j + 1] - common[i])
                if here >= MIN_WORDS and c >= similarity * (here + there - 2 * (SHINGLE - 1) - c):
                    best = (here, there, i, j)
                    break
        if best:
            here, there, i, j = best
            found.append((g[i][0], g[i][0] + here, g[i][2], g[i][2] + there))
            todo += [x for x in (g[:i], g[j + 1 :]) if x]
    return found


def passages(words: bytes, items: list[dict]) -> list[tuple]:
    """(first, end, first_key, first there, end there) in words: the passages that this text shares with first occurrences.

    items: first_key, the lines (lo, hi, shift) on which the two texts are to be
    compared, and the chunks (chunk, words) of the other text that this takes.
    """
    own, found = np.frombuffer(words, "<u2"), []
    for x in items:
        chunks, runs = {c["chunk"]: np.frombuffer(c["words"], "<u2") for c in x["chunks"]}, []
        if not chunks:
            continue
        least = min(chunks)
        there, known = np.zeros((max(chunks) - least + 1) * CHUNK, "<u2"), np.zeros((max(chunks) - least + 1) * CHUNK, bool)
        for c, w in chunks.items():
            there[(c - least) * CHUNK : (c - least) * CHUNK + len(w)] = w
            known[(c - least) * CHUNK : (c - least) * CHUNK + len(w)] = True
        base = least * CHUNK
        lines: dict[int, tuple[int, int]] = {}
        for line in x["lines"]:
            lo, hi = lines.get(line["shift"], (line["lo"], line["hi"]))
            lines[line["shift"]] = min(lo, line["lo"]), max(hi, line["hi"])
        for shift, (lo, hi) in lines.items():
            lo, hi = max(0, lo - RADIUS, shift + base), min(len(own), hi + ANCHOR + RADIUS, shift + base + len(there))
            if hi - lo < SHINGLE:
                continue
            same = np.zeros(hi - lo + 2, bool)
            other = slice(lo - shift - base, hi - shift - base)
            same[1:-1] = (own[lo:hi] == there[other]) & known[other]
            edge = np.flatnonzero(same[1:] != same[:-1])
            runs += [(int(a) + lo, int(b) + lo, int(a) + lo - shift) for a, b in zip(edge[::2], edge[1::2], strict=True) if b - a >= SHINGLE]
        found += [(a, b, x["first_key"], c, d) for a, b, c, d in chains(runs)]
    return found


def text_hash(text: bytes | None) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text or b"")).view(np.int64))


def byte_spans(text: bytes, items: list[dict]) -> list[tuple]:
    """Spans of words as spans of bytes; those of one kind that touch are one."""
    begin, end, _ = word_spans(text)
    out, kinds, of = [], {}, text_hash(text)
    for x in items:
        kinds.setdefault((x["first_key"], x["removed"]), []).append((x["start"], x["stop"]))
    for (first, removed), spans in kinds.items():
        joined: list[list[int]] = []
        for a, b in sorted(spans):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        out += [(int(begin[a]), int(end[b - 1]), b - a, first, removed, of) for a, b in joined]
    return out


def paragraph_lines(found: DataFrame, bands: int, similarity: float, hot: int) -> DataFrame:
    """(key, first_key, shift, lo, hi): where paragraphs say that two texts are to be compared. ``found`` is the index."""
    own = F.posexplode(F.arrays_zip("para_pos", "para_n", "para"))
    units = found.select("key", "bands", own.alias("i", "x")).select("key", F.col("x.para_pos").alias("pos"), F.col("x.para_n").alias("n"), F.col("x.para").alias("content"), F.slice("bands", F.col("i") * bands + 1, bands).alias("m"))
    firsts = units.groupBy("content").agg(F.min(F.struct("key", "pos", "n")).alias("x"), F.max("key").alias("last"), F.first("m").alias("m"))
    firsts = materialise(firsts.select("content", "x.*", (F.col("x.key") < F.col("last")).alias("again"), *(F.col("m")[k].alias(f"m{k}") for k in range(bands))), "paragraphs")
    release(found.sparkSession)

    def held(wanted: DataFrame) -> DataFrame:
        """The words that the index has, one character each."""
        rows = wanted.select("content").join(firsts.select("content", "key", "pos", "n"), "content").join(found.select("key", "words"), "key")
        return rows.select("content", F.decode(F.substring("words", 2 * F.col("pos") + 1, 2 * F.col("n")), "UTF-16LE").alias("own")).dropDuplicates(["content"])

    # similar: all but a fifth of the words stay, the others put in, left out or changed
    allowed = lambda a, b: f"cast(floor({1 - similarity:.6f} * greatest({a}, {b}) + 1e-6) as int)"
    close = f"levenshtein(x, y, {allowed('length(x)', 'length(y)')}) >= 0"
    columns = {"n": "length(own)", "w": SKETCH}
    # of k edits each that puts a word in or leaves one out turns at most one bit, one that changes a word two; the difference in length takes those of the first kind
    near = " + ".join(f"bit_count(w[{k}] ^ w_b[{k}])" for k in range(4)) + f" <= 2 * {allowed('n', 'n_b')} - abs(n - n_b)"
    links = near_links(found, firsts, "key", "words", bands, similarity, hot, held, close, (columns, near))
    roots = connected_components(links)
    classes = firsts.join(roots.toDF("content", "root"), "content", "left").where("again or root is not null").withColumn("root", F.coalesce("root", "content"))
    classes = materialise(classes.select("content", "root", "key", "pos", "n"), "classes")
    least = classes.groupBy("root").agg(F.min(F.struct("key", "pos", "n")).alias("x"))
    there = ["first_key", "first_pos", "first_n"]
    of_class = classes.join(least, "root").select("content", *(F.col(f"x.{c}").alias(t) for c, t in zip(["key", "pos", "n"], there)))
    # a class reaches further than its links: what is unlike its first paragraph is compared with its own first occurrence, and that along each link
    of_own = classes.select("content", *(F.col(c).alias(t) for c, t in zip(["key", "pos", "n"], there)))
    wanted = materialise(of_class.union(of_own).distinct(), "wanted")
    ends = [firsts.select(F.col("content").alias(c), F.struct("key", "pos", "n").alias(f"at_{c}")) for c in "ab"]
    linked = links.join(ends[0], "a").join(ends[1], "b").select(F.greatest("at_a", "at_b").alias("x"), F.least("at_a", "at_b").alias("y"))
    linked = materialise(linked.select("x.*", *(F.col(f"y.{c}").alias(t) for c, t in zip(["key", "pos", "n"], there))).where("key <> first_key").distinct(), "linked")
    discard(firsts, links, roots, classes)
    release(found.sparkSession)
    hits = units.select("key", "pos", "n", "content").join(wanted, "content").where("key <> first_key")
    hits = hits.select("key", "pos", "n", *there).union(linked)
    # from the two first words on and, where lengths differ, back from the two last
    shifts = F.array_distinct(F.array(F.col("pos") - F.col("first_pos"), F.col("pos") + F.col("n") - F.col("first_pos") - F.col("first_n")))
    return materialise(hits.select("key", "first_key", F.explode(shifts).alias("shift"), F.col("pos").alias("lo"), F.greatest("pos", F.col("pos") + F.col("n") - ANCHOR).alias("hi")), "paragraph-lines")


def anchor_lines(found: DataFrame) -> DataFrame:
    """As ``paragraph_lines``, by anchors."""
    rows = found.select("key", F.explode(F.arrays_zip("anchor_pos", "anchor")).alias("x")).select("key", F.col("x.anchor_pos").alias("place"), F.col("x.anchor").alias("anchor"))
    first = rows.groupBy("anchor").agg(F.min("key").alias("first_key"), F.max("key").alias("last"), F.min_by("place", F.when(F.col("place") >= 0, F.col("key"))).alias("first_pos")).where("first_key < last")
    first = materialise(first.select("anchor", "first_key", "first_pos"), "first")
    release(found.sparkSession)
    hits = rows.join(first, "anchor").where("key <> first_key").withColumn("pos", F.expr("if(place < 0, ~place, place)"))
    lines = materialise(hits.groupBy("key", "first_key", (F.col("pos") - F.col("first_pos")).alias("shift")).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")), "anchor-lines")
    discard(first)
    release(found.sparkSession)
    return lines


def shared_passages(found: DataFrame, lines: DataFrame) -> DataFrame:
    """(key, start, stop, first_key, there, until) in words, a written table: what comparing the texts of the index along ``lines`` finds."""
    kind = found.schema["key"].dataType.simpleString()
    pairs = lines.groupBy("key", "first_key").agg(F.collect_set(F.struct("lo", "hi", "shift")).alias("lines"))
    pairs = materialise(pairs, "pairs")
    spans = f"transform(lines, x -> sequence(cast(greatest(0, x.lo - x.shift - {RADIUS}) div {CHUNK} as int), cast(greatest(0, x.hi - x.shift + {ANCHOR + RADIUS}) div {CHUNK} as int)))"
    wanted = pairs.select("key", "first_key", F.explode(F.array_distinct(F.flatten(F.expr(spans)))).alias("chunk"))
    asked = pairs.select(F.col("first_key").alias("key")).distinct()
    texts = found.join(asked, "key", "left_semi").select("key", "words", F.explode(F.expr(f"sequence(0, cast((octet_length(words) - 1) div {2 * CHUNK} as int))")).alias("chunk"))
    texts = texts.select(F.col("key").alias("first_key"), "chunk", F.substring("words", F.col("chunk") * 2 * CHUNK + 1, F.lit(2 * CHUNK)).alias("words"))
    got = materialise(wanted.join(texts, ["first_key", "chunk"]), "chunks")
    release(found.sparkSession)
    chunks = got.groupBy("key", "first_key").agg(F.collect_list(F.struct("chunk", "words")).alias("chunks"))
    items = pairs.join(chunks, ["key", "first_key"]).groupBy("key").agg(F.collect_list(F.struct("first_key", "lines", "chunks")).alias("items"))
    shared = materialise(over_texts(found, items, "key", "words", passages, f"start long, stop long, first_key {kind}, there long, until long"), "shared")
    discard(pairs, got)
    release(found.sparkSession)
    return shared


def repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text", rows: int = ROWS, similarity: float = SIMILARITY, recall: float = RECALL, hot: int = 32) -> DataFrame:
    """One row per repeated passage of a document: (key, start_byte, end_byte, n_words, first_key, removed).

    A passage is at least MIN_WORDS words long and found in another document
    too, word by word or, where stretches that agree are near each other, with
    a Jaccard similarity of 0.8 or more over five-word shingles; it ends where
    the texts stop agreeing. Spans are bytes of the text as UTF-8. first_key is
    a document with a smaller key that has the words it was found by and keeps
    them there; a passage found in several has a row for each. All others are marked removed. Documents
    without repeated passages have no row. Rows without a key and null or empty
    texts have no passages; rows that repeat a key count as one document, with
    the least of their texts; an empty table gives no rows; other columns are
    ignored. Case is ignored.
    Paragraph MinHashes come in bands of ``rows``, as many as ``recall`` takes
    at ``similarity``.
    """
    return _repeated(df, key, text, rows, similarity, recall, hot).drop("of")


def _repeated(df: DataFrame, key: str, text: str, rows: int = ROWS, similarity: float = SIMILARITY, recall: float = RECALL, hot: int = 32) -> DataFrame:
    """As ``repeated_passages``, with the hash ``of`` the text that the spans are of."""
    kind, bands = df.schema[key].dataType.simpleString(), bands_for(similarity, recall, rows)
    df = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    if df.where("key is not null").groupBy("key").count().where("count > 1").take(1):
        df = df.groupBy("key").agg(F.min("text").alias("text"))
    found = materialise(index(df, "key", "text", bands, rows), "index")
    by_anchor, by_paragraph = anchor_lines(found), paragraph_lines(found, bands, similarity, hot)
    shared = shared_passages(found, by_anchor.unionByName(by_paragraph))
    discard(found, by_anchor, by_paragraph)
    here = shared.select("key", "start", "stop", "first_key", F.lit(True).alias("removed"))
    there = shared.select(F.col("first_key").alias("key"), F.col("there").alias("start"), F.col("until").alias("stop"), "first_key", F.lit(False).alias("removed")).distinct()
    spans = materialise(here.union(there).groupBy("key").agg(F.collect_set(F.struct("start", "stop", "first_key", "removed")).alias("items")), "spans")
    discard(shared)
    release(df.sparkSession)
    out = over_texts(df, spans, "key", "text", byte_spans, f"start_byte long, end_byte long, n_words long, first_key {kind}, removed boolean, of long")
    return out.withColumnRenamed("key", key)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """``df`` with the removed passages cut out of its texts and ``length`` counted anew; rows left without a word go.

    Nothing else changes: rows without a key, null and empty texts and all other
    columns, whatever their names, stay as they are. Of rows that repeat a key
    those with the least of their texts are cut, and an empty table stays empty.
    """
    names, d = df.columns, numbered(df)
    schema, at, k = d.schema, names.index(text), f"c{names.index(key)}"
    spans = _repeated(d, k, f"c{at}", **options).where("removed").groupBy(F.col(k).alias("key")).agg(F.first("of").alias("of"), F.sort_array(F.collect_set(F.struct("start_byte", "end_byte"))).alias("spans"))
    spans = materialise(spans, "spans")
    release(df.sparkSession)
    rows = d.join(spans, d[k] == F.col("key"), "left").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, changed, cut, gone = batch.column(at).to_pylist(), [], [], []
            for t, of, spans in zip(texts, batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                raw, parts, last = (t or "").encode(), [], 0
                cut.append(bool(spans) and text_hash(raw) == of)
                for s in spans if cut[-1] else ():
                    parts.append(raw[last : s["start_byte"]])
                    last = max(last, s["end_byte"])
                left = b"".join([*parts, raw[last:]])
                changed.append(left.decode() if cut[-1] else t)
                gone.append(cut[-1] and not left.strip())
            columns = list(batch.columns[:-2])
            columns[at] = pa.array(changed, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.bool_()), pa.array(gone, pa.bool_())], [*batch.schema.names[:-2], "cut", "gone"])
        give_back()

    done = rows.mapInArrow(run, T.StructType([*schema.fields, T.StructField("cut", T.BooleanType()), T.StructField("gone", T.BooleanType())])).where("not gone")
    if length in names:
        n = f"c{names.index(length)}"
        done = done.withColumn(n, F.when(F.col("cut"), F.char_length(f"c{at}").cast(schema[n].dataType)).otherwise(F.col(n)))
    return done.drop("cut", "gone").toDF(*names)


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
