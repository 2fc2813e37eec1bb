"""Written tables between jobs, in the folder that the whole cluster shares."""

from __future__ import annotations

import ctypes
import gc
import re
import time
import uuid
from contextlib import suppress

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset: one under the warehouse in local mode (tests), else an error.

    On a cluster a folder of one machine would lose tables, so none is chosen silently.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: the lineage is cut and lost executors lose no rows.

    Shuffle files of the job that made the table are released as soon as the driver no longer refers to it.
    """
    path = f"{shared_dir(df.sparkSession)}/sievework-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._sievework_path = path
    return out


def release(spark: SparkSession) -> None:
    """Let the context cleaner remove the shuffle files of jobs that are over.

    Objects that Python has let go are let go in the JVM about once a second; only then does a
    collection there find what held the shuffles unused, and the next one the shuffles.
    """
    trim()
    time.sleep(1.2)
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.5)
    spark.sparkContext._jvm.System.gc()
    trim_native(spark)


def trim() -> None:
    """Give memory that Python has let go back to the machine; Arrow's pool and the C library would keep it for the driver's life."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trim_native(spark: SparkSession) -> bool:
    """Let the driver's JVM give native memory that it has freed back to the machine; whether it can.

    Spark starts a thread for each exchange, and the C library keeps what these have freed, more with each job.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    try:
        # By the interface: the server's own class is not open to reflection.
        strings, objects, name = jvm.String, jvm.Object, jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        found = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods()
        call = next(m for m in found if m.getName() == "invoke")
        arguments = gateway.new_array(objects, 4)
        arguments[0], arguments[1] = name, "systemTrimNativeHeap"
        arguments[2], arguments[3] = gateway.new_array(objects, 0), gateway.new_array(strings, 0)
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), arguments)
    except (Py4JError, StopIteration):
        return False
    return True


def drop(df: DataFrame) -> None:
    """Delete a table made by :func:`stored` that no later plan reads."""
    if path := getattr(df, "_sievework_path", None):
        target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
