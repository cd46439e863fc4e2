"""Tables that outlive a stage, kept in the folder that all executors share.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``: the files are
read back by any executor, so losing one never loses a result.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from .rows import give_back


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where it is unset and there is one machine only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is deleted when the session's JVM ends."""
    path = f"{shared_root(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    p, fs = _hadoop(spark, path)
    fs.deleteOnExit(p)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame that reads it."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialised tables that nothing will read again."""
    for t in tables:
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            p, fs = _hadoop(t.sparkSession, folder)
            fs.delete(p, True)


def trim(spark: SparkSession) -> bool:
    """Have the driver's JVM return native memory that it has freed, as its compiler threads do, to the system; False where it can't (before JDK 17.0.9)."""
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    try:
        beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        name, called = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), jvm.java.lang.Class.forName
        kinds, given = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[k] = called(kind)
        given[0], given[1] = name, "systemTrimNativeHeap"
        # the server's own class isn't open to py4j, the interface is
        called("javax.management.MBeanServerConnection").getMethod("invoke", kinds).invoke(beans, given)
    except Py4JError:
        return False
    return True


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing refers to any more, rather than when the driver next happens to collect its garbage.

    The driver, its JVM and its Python return the memory that they have freed.
    """
    gc.collect()
    give_back()
    spark.sparkContext._jvm.System.gc()
    trim(spark)
