"""Bounded samples of labelled rows, and Python functions over whole texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def give_back() -> None:
    """Return the memory that this worker has freed to the system: workers outlive a stage."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_texts(df: DataFrame, key: str, text: str, f: Callable[[list], dict[str, pa.Array]], schema: str, extra: list[str] = (), keyed: bool = False) -> DataFrame:
    """(key, *extra, *schema): ``f`` gets a batch's texts as bytes (None for null), and their keys if ``keyed``, and returns columns."""
    names = ["key", *(f"x{i}" for i in range(len(extra)))]
    rows = df.select(F.col(key).alias("key"), *(F.col(c).alias(n) for c, n in zip(extra, names[1:], strict=True)), F.col(text).cast("binary").alias("text"))
    kinds = [rows.schema[n].dataType.simpleString() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = part.column(part.num_columns - 1).to_pylist()
                made = f(texts, part.column(0).to_pylist()) if keyed else f(texts)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made.values()], [*names, *made])
            del b, part, texts, made
            give_back()

    out = rows.mapInArrow(run, ", ".join([*(f"{n} {k}" for n, k in zip(names, kinds, strict=True)), schema]))
    return out.withColumnsRenamed({"key": key} | dict(zip(names[1:], extra, strict=True)))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ..., so that none has the name of one that is added."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def labelled_sample(labels: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """(key, label, weight): up to ``per_class`` rows of each label, those with the least hash of their key.

    Repeated keys count once, with their largest label; null keys and labels
    are left out. weight says how many labelled rows a row stands for.
    """
    once = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    classes = {r["label"]: r["count"] for r in once.groupBy("label").count().orderBy("label").collect()}  # a number for each label, of which there are few
    parts = [once.where(F.col("label") == c).orderBy(F.xxhash64("key"), "key").limit(per_class).withColumn("weight", F.lit(n / min(n, per_class))) for c, n in classes.items()]
    out = once.limit(0).withColumn("weight", F.lit(1.0))
    for p in parts:
        out = out.union(p)
    return out.withColumnRenamed("key", key)
