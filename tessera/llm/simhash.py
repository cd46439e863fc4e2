"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is cut into segments; its embedding is the vector of bit
counts per segment. The Manhattan distance of two embeddings never exceeds the
Hamming distance of their fingerprints, so pairs farther apart than the limit
are discarded without being compared bit by bit. The vector is split into
``parts``; of a pair within ``limit`` at least one part differs by at most
``limit // parts``, so a grid over each part, probed within that radius, finds
every pair. Survivors are verified by exact bit comparison.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .crowds import crowd_links
from .graph import connected_components
from .rows import give_back, numbered
from .shared import discard, materialise, release

SEED = 42
CHUNK = 255 * 256


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of a whole UTF-8 text: majority over the XXH64 of its word shingles, repeats included."""
    words = (text or b"").lower().split()  # bytes: only A-Z and only \\x20\\x09-\\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    whole = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    return majority(np.array([digest(whole[i : j - 1], SEED) for i, j in zip(starts[at : at + CHUNK], starts[at + shingle : at + shingle + CHUNK])], "<u8") for at in range(0, n, CHUNK))


def majority(hashes: Iterable[np.ndarray]) -> int:
    """The number whose bits are set where over half the hashes, which come in arrays of up to CHUNK, have them set."""
    ones, n = np.zeros(64, np.int64), 0
    for h in hashes:
        bits = np.unpackbits(h.astype("<u8", copy=False).view(np.uint8), bitorder="little").reshape(-1, 64)
        full = len(bits) // 255 * 255
        if full:
            ones += np.add.reduce(bits[:full].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(0, dtype=np.int64)
        ones += bits[full:].sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp): the fingerprint of each row as a signed 64-bit integer. Null and empty texts have zero."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()) if not pa.types.is_binary(b.column(1).type) else b.column(1)
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["key", "fp"])
        give_back()

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {kind.simpleString()}, fp long").withColumnRenamed("key", key)


def manhattan(a: str, b: str, bits: int) -> Column:
    """Manhattan distance of the embeddings of fingerprint columns ``a`` and ``b``: a lower bound of their Hamming distance."""
    mask = (1 << bits) - 1
    one = "bit_count(shiftrightunsigned({}, i * {}) & {}L)"
    return F.expr(f"aggregate(sequence(0, {64 // bits - 1}), 0, (d, i) -> d + abs({one.format(a, bits, mask)} - {one.format(b, bits, mask)}))")


def grid_cells(fps: DataFrame, bits: int, parts: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Cells that a fingerprint lies in, and cells that it probes.

    A cell is one vector of counts of one part, written as a number. Distances
    are symmetric, so of two vectors only one probes the other: the one with
    the smaller total, or either at equal vectors and radius 1 needs no more.
    """
    if radius > 1:
        raise ValueError("take more parts: a grid is probed within radius 0 or 1")
    lanes, base = 64 // bits // parts, (1 << bits.bit_length()) if bits > 1 else 2
    if base**lanes * parts >= 1 << 63:
        raise ValueError("a part's counts don't fit a 64-bit cell number: take more parts")
    counts = f"transform(sequence(0, {64 // bits - 1}), i -> bit_count(shiftrightunsigned(fp, i * {bits}) & {(1 << bits) - 1}L))"
    rows = fps.select("fp", F.expr(counts).alias("v")).select("fp", "v", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    rows = rows.withColumn("v", F.expr(f"slice(v, part * {lanes} + 1, {lanes})"))
    rows = rows.withColumn("cell", F.expr(f"aggregate(v, cast(part as bigint), (s, x) -> s * {base} + x)"))
    steps = ", ".join(f"if(v[{k}] < {bits}, cell + {base ** (lanes - 1 - k)}L, null)" for k in range(lanes))
    own = rows.select("cell", "fp")
    near = rows.select(F.explode(F.expr(f"filter(array({steps}), x -> x is not null)")).alias("cell"), "fp") if radius else None
    return own, near


def hamming_links(fps: DataFrame, limit: int = 3, bits: int = 2, parts: int = 2, hot: int = 2000) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp``, enough that components are exact. The links are a written table.

    Cells of up to ``hot`` members are joined. Fingerprints of larger cells are
    dealt anew by segments of one bit, which tell 2^32 vectors of a half apart;
    what is crowded even then is linked by leaders, so no cell emits all its
    pairs.
    """
    own, near = grid_cells(fps, bits, parts, limit // parts)
    own = materialise(own, "cells")
    probes = own.select("cell", F.col("fp").alias("b"), F.lit(True).alias("same"))
    if near is not None:
        probes = probes.union(near.select("cell", F.col("fp").alias("b"), F.lit(False).alias("same")))
    sizes = own.select("cell").union(near.select("cell")) if near is not None else own.select("cell")
    crowded = materialise(sizes.groupBy("cell").count().where(F.col("count") > hot).select("cell"), "crowded")
    some = bool(crowded.take(1))
    calm, calm_probes = own, probes
    if some:
        calm, calm_probes = own.join(crowded, "cell", "left_anti"), probes.join(crowded, "cell", "left_anti")
    close = f"bit_count(a ^ b) <= {limit}"
    pairs = calm.withColumnRenamed("fp", "a").join(calm_probes, "cell").where("(not same or a < b)")
    pairs = materialise(pairs.where(manhattan("a", "b", bits) <= limit).where(close).select("a", "b"), "links")
    if some:
        members = materialise(probes.join(crowded, "cell", "left_semi").select(F.col("cell").alias("bucket"), F.col("b").alias("id")), "members")
        if bits > 1:
            finer = hamming_links(members.select(F.col("id").alias("fp")).distinct(), limit, 1, parts, hot)
            both = materialise(pairs.union(finer), "links")
            discard(pairs, finer)
            pairs = both
        else:
            pairs = crowd_links(members, pairs, lambda found: found.where(close))
        discard(members)
    discard(own, crowded)
    return pairs


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 3, shingle: int = 3, bits: int = 2, parts: int = 2) -> DataFrame:
    """One row per row of ``df``: (key, fingerprint, component_id).

    Fingerprints link at ``limit`` or fewer differing bits; component_id is the
    smallest key reachable over links, its own included. Copies share a
    fingerprint and are never paired. Null and empty texts have fingerprint
    zero and link like any other; a null key takes part but is the id only of a
    component without other keys; repeated rows give repeated rows; an empty
    table gives none. Other columns of ``df`` are ignored.
    """
    fps = materialise(fingerprints(df, key, text, shingle).select(F.col(key).alias("key"), "fp"), "fingerprints")
    distinct = materialise(fps.groupBy("fp").agg(F.min("key").alias("low")), "distinct")
    links = hamming_links(distinct.select("fp"), limit, bits, parts)
    roots = connected_components(links)
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    of = materialise(placed.join(lowest, "root").select("fp", "component_id"), "components")
    discard(distinct, links, roots)
    release(df.sparkSession)
    return fps.join(of, "fp").select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` whose key is the id of their component; of rows that repeat a key, the least.

    Rows without a key can't be told apart and all stay.
    """
    return keep_rows(df, near_duplicates(df, key, **options).select(key, "component_id"), key)


def keep_rows(df: DataFrame, classes: DataFrame, key: str = "doc_id") -> DataFrame:
    """As ``keep_one``, with ``classes`` (key, component_id) for the rows of ``df``. All columns stay, whatever their names."""
    d = numbered(df)
    own = d[d.columns[df.columns.index(key)]]
    kept = classes.toDF("kept", "low").where("kept = low").groupBy("kept").agg(F.count("*").alias("n"))
    rows = d.join(kept, own == F.col("kept"))
    once = rows.where("n = 1").select(*d.columns)
    again = rows.where("n > 1").groupBy("kept").agg(F.min(F.struct(*d.columns)).alias("row")).select("row.*")
    return once.union(again).union(d.where(own.isNull())).toDF(*df.columns)


def op1_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
