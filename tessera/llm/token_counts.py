"""Token counts of sections, from one encoding of the whole document.

A document is encoded once. Each token covers a span of the text's bytes; the
spans of tokens and of sections are joined as intervals, both being sorted, and
a token that crosses a boundary is allocated by an explicit rule.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary cuts a text before it merges. A fixed value: the published pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
RULES = ("start", "end", "majority", "split")
PART = 64


@lru_cache(2)
def encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The tokenizer, and the number of bytes of each token."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def line_sections(text: bytes) -> np.ndarray:
    """Starts of the sections of a text: each line with the line end that closes it."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.concatenate([[0], ends[ends < len(text)]])


def allocate(ends: np.ndarray, starts: np.ndarray, size: int, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing) of each section.

    ends: where each token ends; tokens follow each other from 0 to ``size``.
    starts: where each section begins, from 0; a section ends where the next begins.
    rule: a token that crosses boundaries counts for the section in which it
    starts or ends; for that which holds most of its bytes, the first at a tie
    (majority); or in parts of its bytes for each (split). crossing: tokens
    that lie in the section and in another.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    n, tokens = len(starts), np.zeros(len(starts))
    begin = np.concatenate([[0], ends[:-1]])
    first, last = np.searchsorted(starts, begin, "right") - 1, np.searchsorted(starts, ends - 1, "right") - 1
    inside = first == last
    tokens += np.bincount(first[inside], minlength=n)
    crossing = np.zeros(n, np.int64)
    stops = np.append(starts[1:], size)
    for b, e, i, j in zip(begin[~inside], ends[~inside], first[~inside], last[~inside], strict=True):
        held = np.minimum(stops[i : j + 1], e) - np.maximum(starts[i : j + 1], b)
        crossing[i : j + 1] += 1
        if rule == "split":
            tokens[i : j + 1] += held / (e - b)
        else:
            tokens[{"start": i, "end": j, "majority": i + int(held.argmax())}[rule]] += 1
    return tokens, crossing


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", rule: str = "majority", path: str = VOCABULARY, sections: Callable[[bytes], np.ndarray] = line_sections) -> DataFrame:
    """One row per section of each row of ``df``: (key, section, start_char, n_chars, n_tokens, n_crossing).

    The n_tokens of a document's sections add up to its tokens. A null or empty
    text has one empty section without tokens; every line end closes a section,
    so an empty line is one; repeated rows give repeated rows; an empty table
    none; other columns are ignored. ``path`` must be readable on every
    executor.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, size = encoding(path)
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                owner, columns = [], [[] for _ in range(5)]
                for row, t in enumerate(part.column(1).to_pylist()):
                    t = t or b""
                    starts = sections(t)
                    ids = np.array(enc.encode_ordinary(t.decode()), np.int64)
                    tokens, crossing = allocate(np.cumsum(size[ids]), starts, len(t), rule) if len(ids) else (np.zeros(len(starts)), np.zeros(len(starts), np.int64))
                    chars = np.concatenate([[0], np.cumsum((np.frombuffer(t, np.uint8) & 0xC0) != 0x80)])  # code points before each byte
                    first = chars[starts]
                    owner += [row] * len(starts)
                    for column, values in zip(columns, (np.arange(len(starts)), first, np.diff(np.append(first, chars[-1])), tokens, crossing), strict=True):
                        column.append(values)
                made = [np.concatenate(c) if c else np.zeros(0) for c in columns]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner, pa.int64())), *(pa.array(m.astype(k.to_pandas_dtype())) for m, k in zip(made, kinds, strict=True))], ["key", "section", "start_char", "n_chars", "n_tokens", "n_crossing"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, section long, start_char long, n_chars long, n_tokens double, n_crossing long").withColumnRenamed("key", key)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
