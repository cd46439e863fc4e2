"""Cutting long plans by reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder named by ``spark.checkpoint.dir``; one of our own only where it is unset.

    Plans that use a result many times are compiled and run once for it, and a
    lost executor costs no more than a read.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        root = "file://" + tempfile.mkdtemp(prefix="tessera-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    return df.checkpoint()
