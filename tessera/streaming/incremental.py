"""Resumable intake: files that arrive in a folder are read once each, and keys seen before are passed over.

The stream runs until it has read what is there (availableNow) and goes on from its checkpoint when run again, after a crash
or with new files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_documents(spark: SparkSession, folder: str, schema: T.StructType, key: Column, out: str, checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Appends documents of new keys to ``out`` and returns all of it. The keys are the stream's state, kept for good.

    Which of equal documents is kept within a batch is not fixed, so ``out`` should hold what follows from the key.
    """
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    rows = stream.parquet(folder).withColumn("doc_sha256", key).dropDuplicates(["doc_sha256"])
    query = rows.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out)


def running_accounts(spark: SparkSession, folder: str, schema: T.StructType, reason: Column, out: str, checkpoint: str) -> DataFrame:
    """Counts and bytes by reason of each batch, appended as partials; their sums are the totals.

    A batch that is run again after a crash writes its own number again, and only one copy of it is summed.
    """

    def write(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("documents"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))
        sums.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    partial = spark.read.parquet(out)
    return partial.groupBy("reason").agg(F.sum("documents").alias("documents"), F.sum("bytes").alias("bytes"))


def until_target(spark: SparkSession, folder: str, schema: T.StructType, size: Column, target: int, out: str, checkpoint: str, files_per_batch: int = 1) -> int:
    """Appends files' rows to ``out`` batch by batch while the total of size is below target; returns the total.

    A batch is written under its number, and the total is read back from what is written, so a run after a crash goes on
    where it stopped. The batch that crosses the target is in; later ones are passed over.
    """

    def total() -> int:
        try:
            return spark.read.parquet(out).agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
        except AnalysisException:  # nothing written yet
            return 0

    def write(batch: DataFrame, number: int) -> None:
        if total() < target:
            batch.withColumn("_size", size).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return total()
