"""Delimited tables as existing tools write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A comma-separated table with a header, quotes doubled, line ends within quotes and a byte order mark or none."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """One table of part files, each with a header; with ``bom`` each begins with a byte order mark, as spreadsheets expect."""
    names = [("﻿" if bom and i == 0 else "") + c for i, c in enumerate(df.columns)]
    df.toDF(*names).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_batch(df: DataFrame, path: str, job: str = "job_key") -> None:
    """Replace the partitions of the jobs in ``df`` and leave all others: a batch that is run again counts once."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(job).parquet(path)


def cached_or_build(spark: SparkSession, path: str, build, rebuild: bool = False) -> DataFrame:
    """The table at ``path``, built and written first where it is missing or ``rebuild`` asks for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if rebuild or not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def roads_in_box(roads: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Roads whose box meets a box: four comparisons that Parquet row groups are skipped by."""
    return roads.where((F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny))
