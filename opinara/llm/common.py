"""What the operators share: table paths, splits by id, lineage cutting, Arrow batches."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Hold Arrow batches to a bound that long texts cannot break."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def in_part(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text leaves ``part``; a null key is in no part."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir")
        if shared is None:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="opinara-llm-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def keep(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, in files of the shared folder, and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffled(df: DataFrame) -> DataFrame:
    """Mark the side of a join that shall never be broadcast: a broadcast is a job of its own and passes through the driver."""
    return df.hint("merge")


def in_few_files(df: DataFrame) -> DataFrame:
    """Deal a table of short rows anew before it is kept: tasks that leave a little each would leave a file each.

    A file costs more than its bytes: where Hadoop's native library is missing, a local file system starts a child process
    to set the rights of the file and another for its checksum.
    """
    return df.hint("rebalance")


def keep_table(df: DataFrame) -> DataFrame:
    """The same as ``keep`` in Parquet files, half as large; they stay in the shared folder until it is cleared."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def send(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcast a value of our own classes; workers need no copy of this package to read it."""
    return spark.sparkContext.broadcast([cloudpickle.dumps(value)])


def receive(sent: Broadcast) -> Any:
    """The value of ``send``; a worker unpacks it once and keeps what the value itself keeps."""
    box = sent.value
    if isinstance(box[0], bytes):
        box[0] = pickle.loads(box[0])
    return box[0]
