"""Readers: column-pruned scans that fail at planning time if a needed column is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.shared import small_batches


class MissingColumn(ValueError):
    """A column that a scan cannot do without is not in its table."""


def scan(spark: SparkSession, path, columns: list[str] | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """A Parquet scan of the columns that exist; a required one that does not is an error."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise MissingColumn(f"{path}: no column {', '.join(lacking)}")
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return scan(spark, f"{sf_dir}/{name}.parquet")


def with_place(df: DataFrame) -> DataFrame:
    """Adds the file each row came from, for sources whose order matters."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, required: tuple[str, ...] = ("text",)) -> DataFrame:
    """(Gzipped) JSON lines under an explicit schema; rows without a required value end the job."""
    df = spark.read.schema(schema).json(path)
    for c in required:
        df = df.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"missing {c}"))).otherwise(F.col(c)))
    return df


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def removal_list(spark: SparkSession, path: str) -> DataFrame:
    """One hash a line; blank lines and spaces around are passed over."""
    return spark.read.text(path).select(F.trim("value").alias("doc_sha256")).where("doc_sha256 <> ''")


def head_per_source(df: DataFrame, source: str, order: str, n: int) -> DataFrame:
    from tessera.operators.prefix import least_per_key

    return least_per_key(df, [source], n, [F.col(order)])


def shard_number(name):
    """The number in a name such as ``train-00012-of-00880.parquet``; another name is an error."""
    number = F.regexp_extract(name, r"train-(\d{5})-of-\d{5}\.parquet$", 1)
    return F.when(number == "", F.raise_error(F.concat(F.lit("unrecognised shard "), name)).cast("int")).otherwise(number.cast("int"))


def checked(df: DataFrame, digest: str, text: str = "text") -> DataFrame:
    """Rows whose stored SHA-256 is their text's; any other row ends the job."""
    same = F.sha2(F.col(text), 256) == F.col(digest)
    return df.withColumn(digest, F.when(same, F.col(digest)).otherwise(F.raise_error(F.concat(F.lit("hash mismatch "), F.col(digest)))))


def hit_file(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """The hits of one language from JSON lines (lang, doc_sha256, ngram_hits, url, chars)."""
    return spark.read.schema("lang string, doc_sha256 string, ngram_hits long, url string, chars long").json(path).where(F.col("lang") == lang)


def metrics_log(spark: SparkSession, path: str) -> DataFrame:
    """A run's log of JSON lines, its columns as found; lines that are no JSON are left out."""
    df = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return df.where(F.col("_bad").isNull()).drop("_bad") if "_bad" in df.columns else df


def splits(parts: dict[str, DataFrame], order: str, most: int | None = None) -> DataFrame:
    """All splits in one table with a column ``split``, up to ``most`` rows of each by order."""
    from tessera.operators.budget import in_order

    rows = in_order(parts, "split").drop("split_ord")
    return head_per_source(rows, "split", order, most) if most is not None else rows


def row_text(df: DataFrame, sep: str = "\n"):
    """One text of a row whose columns are not known before: all string values that are not blank, in the order of columns."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return F.concat_ws(sep, *[F.when(F.trim(n) != "", F.col(n)) for n in names])


def read_specs(readers: dict) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(tables, failures) of named readers without arguments: one that fails is recorded, and the others are read."""
    found, failed = {}, {}
    for name, reader in readers.items():
        try:
            found[name] = reader()
        except Exception as e:  # noqa: BLE001 - whatever a source raises is what there is to record
            failed[name] = f"{type(e).__name__}: {e}".splitlines()[0]
    return found, failed


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of small files, which are read whole."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def token_pool(spark: SparkSession, path: str, langs: list[str] | None = None) -> DataFrame:
    """A pool that sinks.token_pool wrote; only the folders of the languages asked for are read."""
    df = spark.read.parquet(path)
    return df.where(F.col("lang").isin(*langs)) if langs is not None else df


def register_views(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> None:
    """Temporary views of the tables, for plain SQL over them."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
