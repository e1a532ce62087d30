"""A table fed to a stream by batches, and a stream run to its end."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from crashlake.session import checkpoint_dir


def stream_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{checkpoint_dir(spark)}/streams/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def heartbeat(df: DataFrame, ts: str, at: str) -> DataFrame:
    """One row of nothing but a time: it moves the watermark and counts for nothing else."""
    empty = [(F.lit(at) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.sparkSession.range(1).select(*empty)


def replay(df: DataFrame, name: str, ts: str, batches: int = 4, by: str = "uuid", until: str = "2100-01-01") -> DataFrame:
    """Stream of a table's rows in about so many batches, in no order of time, and a last heartbeat.

    Rows are dealt by the hash of an id, so every batch holds rows of the whole period. A batch
    has as many files as the cluster's shuffles have partitions for it: one task neither writes
    nor reads a batch alone.
    """
    spark = df.sparkSession
    path = stream_folder(spark, name)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    df.repartition(batches * math.ceil(tasks / batches), by).write.parquet(path)
    files = len(spark.read.schema(df.schema).parquet(path).inputFiles())
    heartbeat(df, ts, until).coalesce(1).write.mode("append").parquet(path)
    per_batch = max(1, math.ceil(files / batches))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Append a stream's rows to files until it has nothing left to read, and read them back."""
    spark = stream.sparkSession
    path = stream_folder(spark, name)
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/rows")
             .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
