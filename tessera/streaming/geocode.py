"""Facilities geocoded as files of them arrive, each row once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.results import resume
from ..schema import FACILITY
from ..sources.tables import write_batch


def facilities(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of facility rows from Parquet files that land in ``folder``."""
    return spark.readStream.schema(FACILITY).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def geocode_stream(rows: DataFrame, geocode: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run ``geocode`` over each batch and write it under ``out``, one partition per batch.

    A batch that is run again after a failure replaces its own partition, so
    its rows count once; rows that an earlier batch has written are left out.
    """

    def one(batch: DataFrame, number: int) -> None:
        from pyspark.sql import functions as F

        spark, todo = batch.sparkSession, batch.dropDuplicates(["source_row"])
        path = spark._jvm.org.apache.hadoop.fs.Path(out)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            todo = resume(todo, spark.read.parquet(out).where(F.col("batch") != number))
        write_batch(geocode(todo).withColumn("batch", F.lit(number)), out, "batch")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
