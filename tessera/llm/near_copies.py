"""Near copies: SimHash first, then every pair of the exact Jaccard similarity of word shingles.

Texts whose SimHash fingerprints of five-word shingles differ in three bits or
fewer are verified and joined. At a Jaccard similarity of 0.8 fingerprints
differ in some ten bits, which no grid finds, so the rest is found by shingles:
those of a text are ordered by hash, the common ones last, and two texts of
similarity ``s`` or more share one of their first ``n - ceil(s n) + 1``, so
buckets of these find every pair. Sizes and places bound the similarity of a
pair from above, then parity sketches: bits that differ never exceed the
shingles that differ. Pairs that are left are verified by their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crowds import crowd_links
from .graph import connected_components
from .paragraph_dedup import shingle_hashes, word_hashes
from .rows import give_back
from .shared import discard, materialise, release
from .simhash import CHUNK, hamming_links, keep_rows, majority

SHINGLE, SIMILARITY = 5, 0.8
SKETCH = 16
SLACK = 1e-6
#: Shingles that are put last, at most: those of most texts. Any set of them gives the same result; it is sent to all executors.
COMMON = 1 << 17


def shingle_set(text: bytes | None, size: int = SHINGLE) -> tuple[int, np.ndarray]:
    """A hash of the words of a text, and the hashes of its distinct shingles in order; a text of fewer words is one shingle."""
    h = word_hashes(text)
    content = xxhash.xxh64_intdigest(h.tobytes())
    if len(h) < size:
        return content, np.array([content], np.uint64)
    return content, np.unique(shingle_hashes(h, size))


def sketch(s: np.ndarray) -> np.ndarray:
    """For each of 64 x SKETCH classes of shingles whether their number is odd."""
    odd = np.bincount((s & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def index(df: DataFrame, key: str, text: str, size: int, similarity: float, common: np.ndarray | None = None) -> DataFrame:
    """(key, content, n, fp, sketch, prefix) of each row; the prefix holds the least shingle hashes, those of ``common`` (in order) after all others."""
    kind = df.schema[key].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(common) if common is not None and len(common) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                content, n, fps, sketches, prefix = [], [], [], [], []
                for t in part.column(1).to_pylist():
                    c, s = shingle_set(t, size)
                    content.append(c)
                    n.append(len(s))
                    fps.append(majority(s[i : i + CHUNK] for i in range(0, len(s), CHUNK)))
                    sketches.append(sketch(s))
                    if sent is not None:
                        known = sent.value
                        last = known[np.minimum(np.searchsorted(known, s), len(known) - 1)] == s
                        s = np.concatenate([s[~last], s[last]])
                    prefix.append(s[: len(s) - int(np.ceil(similarity * len(s) - SLACK)) + 1].view(np.int64))
                numbers = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (content, n, fps)]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, pa.array(sketches, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))], ["key", "content", "n", "fp", "sketch", "prefix"])
        give_back()

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, content long, n long, fp long, sketch array<long>, prefix array<long>")


def set_rows(df: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(content, shingles) of the texts in ``wanted`` (key, content); rows that repeat a key and a text give it again."""
    by_key = wanted.groupBy("key").agg(F.collect_set("content").alias("want"))
    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("text")).join(by_key, F.col("_key").eqNullSafe(F.col("key"))).select("text", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                content, sets = [], []
                for t, want in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    c, s = shingle_set(t, size)
                    signed = int(np.uint64(c).view(np.int64))
                    if signed in want:
                        content.append(signed)
                        sets.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(content, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["content", "shingles"])
        give_back()

    return rows.mapInArrow(run, "content long, shingles array<long>")


def possible(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): those ``pairs`` (a, b, na, nb, pa, pb) that sizes, places and sketches allow.

    At the first shingle that two texts have in common, all others follow it in both.
    """
    pairs = pairs.where(f"least(na - pa, nb - pb) >= {similarity / (1 + similarity)} * (na + nb) - {SLACK}").select("a", "b", "na", "nb").distinct()
    for x in "ab":
        pairs = pairs.join(texts.select(F.col("content").alias(x), F.col("sketch").alias(f"s{x}")), x)
    apart = "aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    return pairs.where(f"{apart} <= {(1 - similarity) / (1 + similarity)} * (na + nb) + {SLACK}").select("a", "b")


def verified(df: DataFrame, pairs: DataFrame, texts: DataFrame, key: str, text: str, size: int, similarity: float) -> DataFrame:
    """(a, b): those ``pairs`` whose sets have the similarity. A written table."""
    pairs = materialise(pairs.select("a", "b").distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("content")).distinct().join(texts.select("content", "key"), "content")
    sets = materialise(set_rows(df, wanted, key, text, size), "sets")
    release(df.sparkSession)
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    links = materialise(both.where(F.col("common") >= similarity * (F.size("sa") + F.size("sb") - F.col("common")) - SLACK).select("a", "b").distinct(), "links")
    discard(pairs, sets)
    release(df.sparkSession)
    return links


def simhash_pairs(texts: DataFrame, limit: int) -> DataFrame:
    """(a, b): texts with one fingerprint, each with the least of them, and the least ones of fingerprints that differ in ``limit`` bits or fewer."""
    low = materialise(texts.groupBy("fp").agg(F.min("content").alias("low")), "fingerprints")
    links = hamming_links(low.select("fp"), limit)
    near = links.join(low.toDF("a", "x"), "a").join(low.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return near.union(texts.join(low, "fp").where("content <> low").select("low", "content"))


def jaccard_links(df: DataFrame, texts: DataFrame, prefixes: DataFrame, key: str, text: str, size: int, similarity: float, hot: int, limit: int) -> DataFrame:
    """(a, b): links between the contents of ``texts`` (content, key, n, fp, sketch), enough that components are exact.

    prefixes: (content, n, prefix) of the same texts, discarded when it has been read.

    Buckets of up to ``hot`` texts give their pairs, larger ones are linked by
    leaders; what SimHash has joined already isn't compared there again.
    """
    rows = prefixes.select("content", "n", F.posexplode("prefix").alias("pos", "bucket"))
    sizes = materialise(rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    release(df.sparkSession)
    shared = materialise(rows.join(sizes, "bucket"), "buckets")
    discard(sizes, prefixes)
    release(df.sparkSession)
    side = lambda t, x: t.select("bucket", F.col("content").alias(x), *(F.col(c).alias(f"{c[0]}{x}") for c in ("n", "pos")))
    small = shared.where(F.col("size") <= hot)
    pairs = materialise(possible(side(small, "a").join(side(small, "b"), "bucket").where("a < b"), texts, similarity).union(simhash_pairs(texts, limit)), "pairs")
    release(df.sparkSession)
    links = verified(df, pairs, texts, key, text, size, similarity)
    discard(pairs)
    crowded = shared.where(F.col("size") > hot).select("bucket", "content", "n", "pos").join(texts.select("content", "sketch"), "content")
    crowded = materialise(crowded.withColumnRenamed("content", "id"), "crowded")
    discard(shared)
    release(df.sparkSession)
    if crowded.take(1):

        def verify(found: DataFrame) -> DataFrame:
            return verified(df, found, texts, key, text, size, similarity)

        apart = " + ".join(f"bit_count(sketch[{i}] ^ sketch_b[{i}])" for i in range(SKETCH))
        near = f"least(n - pos, n_b - pos_b) >= {similarity / (1 + similarity)} * (n + n_b) - {SLACK} and {apart} <= {(1 - similarity) / (1 + similarity)} * (n + n_b) + {SLACK}"
        # the fewer shingles come before a common one, the nearer is a text to what the others were made from
        links = crowd_links(crowded, links, verify, ["n", "pos", "sketch"], "pos", near)
    discard(crowded)
    return links


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY, hot: int = 64, limit: int = 3) -> DataFrame:
    """One row per row of ``df``: (key, component_id), linked where the Jaccard similarity of texts is ``similarity`` or more.

    Case and spaces are ignored. component_id is the smallest key reachable
    over links, its own included; null and empty texts are copies of each
    other; a null key takes part but is the id only of a component without
    other keys. Repeated rows give repeated rows, an empty table none; other
    columns are ignored.
    """
    rows = materialise(index(df, key, text, size, similarity), "index")
    again = rows.select("content", "prefix").dropDuplicates(["content"]).select(F.explode("prefix").alias("x")).groupBy("x").count().where(F.col("count") > hot)
    common = again.orderBy(F.desc("count"), "x").limit(COMMON).select("x").toArrow()["x"].to_numpy()  # at most COMMON numbers
    if len(common):
        discard(rows)
        release(df.sparkSession)
        rows = materialise(index(df, key, text, size, similarity, np.sort(common.view(np.uint64))), "index")
    texts = rows.groupBy("content").agg(F.min("key").alias("key"), *(F.first(c).alias(c) for c in ("n", "fp", "sketch", "prefix")))
    prefixes = materialise(texts, "prefixes")
    texts = materialise(prefixes.drop("prefix"), "texts")
    own = materialise(rows.select("key", "content"), "keys")
    discard(rows)
    release(df.sparkSession)
    links = jaccard_links(df, texts, prefixes, key, text, size, similarity, hot, limit)
    roots = connected_components(links)
    placed = texts.select("content", "key").join(roots.withColumnRenamed("node", "content"), "content", "left").withColumn("root", F.coalesce("root", "content"))
    lowest = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    of = materialise(placed.join(lowest, "root").select("content", "component_id"), "components")
    discard(texts, links, roots)
    release(df.sparkSession)
    return own.join(of, "content").select(F.col("key").alias(key), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row of ``df`` for each group of near copies, as ``simhash.keep_one`` does for fingerprints."""
    return keep_rows(df, near_copies(df, key, **options), key)
