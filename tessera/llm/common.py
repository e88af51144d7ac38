"""What the operators of this subpackage share: words, hashes and tables in the shared folder."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A word: a run of anything but space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; set here only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tessera-shared-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", f"file://{root}")
        root = f"file://{root}"
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/tessera-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written as a table in the shared folder and read again: later reads neither recompute it nor lose it."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of input that one partition of a wide exchange takes, where the session's number of partitions is smaller.
PARTITION_BYTES = 256 << 20


def partitions_for(df: DataFrame, n_bytes: Column) -> int:
    """How many partitions an exchange of df takes: the session's number, more where the summed bytes ask for it."""
    total = df.agg(F.coalesce(F.sum(n_bytes.cast("long")), F.lit(0))).first()[0]
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_BYTES))


def seeded_key(seed: int, column: Column) -> Column:
    """60 bits of an MD5 over seed and value: one shuffle order for Spark and for plain SQL."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 15), 16, 10).cast("long")


def row_name(id_col: str, text_col: str) -> Column:
    """What a row is shuffled by: its id, or a hash of its text where it has none, so that such rows spread too."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def sql_seeded_key(seed: int, id_col: str, text_col: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || coalesce({id_col}::varchar, 't' || md5(coalesce({text_col}, '')))), 1, 15))::bigint"


def named(column: str) -> Column:
    """A string column as a key that never is null and keeps null apart from the empty string."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column)))


#: CRC-32 of a string's UTF-8 bytes in DuckDB: the table of 256 entries, then one step a byte.
SQL_CRC = """
crc_step AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)
"""


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the rows of an Arrow batch, where it has Spark's default of 10,000: a row here is a whole text, and a batch is
    held in the JVM's direct memory and in Python at once."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, str(rows))


def release_memory() -> None:
    """Hands freed memory back to the system: a worker process lives on after its task, beside the next ones."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def map_slices(df: DataFrame, fn, ddl: str, rows: int = 1000, gather: int = 1) -> DataFrame:
    """mapInPandas over slices of the Arrow batches, so that only ``rows`` rows are Python objects at a time.

    Batches are gathered first until they have ``gather`` rows, for narrow rows that are handled as arrays.

    Long columns arrive as nullable integers: a null does not turn its neighbours into floats.
    """
    small_batches(df.sparkSession)
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches):
        held: list[pa.RecordBatch] = []

        def slices():
            table = pa.Table.from_batches(held) if held else None
            held.clear()
            for at in range(0, table.num_rows if table is not None else 0, rows):
                yield table.slice(at, rows).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)

        def parts():
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= gather:
                    yield from slices()
            yield from slices()

        for out in fn(parts()):
            yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)
        release_memory()

    return df.mapInArrow(run, ddl)
