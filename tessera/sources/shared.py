"""Tables between the steps of one query, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under spark.checkpoint.dir; a local folder only for a local master, an error on a cluster without the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the rows of an Arrow batch, where it has Spark's default of 10,000: a row is a whole text, and a worker holds a batch
    several times, as Arrow, as strings and as what is made of them."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, str(rows))


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written once and read again: what follows neither computes it anew nor loses it with an executor."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
