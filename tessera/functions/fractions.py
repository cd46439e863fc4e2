"""Reproducible fractions in [0, 1) from a row's own values."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def payload(seed: Column | int, level: Column | str, *parts: Column) -> Column:
    """Values joined by '|', null as 'None'."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("None")) for c in (lit(seed), lit(level), *parts)))


def hash_fraction(text: Column) -> Column:
    """52 bits of SHA-256 as a fraction: the same to the last bit in every engine."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint") / F.lit(4503599627370496.0)


@F.pandas_udf(T.DoubleType())
def mersenne_fraction(text: pd.Series) -> pd.Series:
    """The first draw of Python's generator seeded by 64 bits of SHA-256, for points that must equal earlier outputs."""
    import hashlib

    return text.map(lambda s: random.Random(int(hashlib.sha256(s.encode()).hexdigest()[:16], 16)).random())
