"""Session and the hand-over of tables between steps of a job."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def session(name: str = "newsloom", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Only a local session may do without: it gets a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if spark.conf.get("spark.master", "").partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="newsloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def handover(df: DataFrame, name: str = "handover") -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows and bytes that an Arrow batch may hold: texts are long, and two tasks share an executor's memory.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}


def give_back() -> None:
    """Free buffers go back to the system after a task, since Python workers live on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def batched(df: DataFrame, run, schema) -> DataFrame:
    """mapInArrow with bounded batches: a bound that the session has set itself is left as it is."""
    spark = df.sparkSession
    own = spark.conf.getAll
    for k, v in BATCH.items():
        if k not in own:
            spark.conf.set(k, v)

    def whole(batches):
        yield from run(batches)
        give_back()

    return df.mapInArrow(whole, schema)
