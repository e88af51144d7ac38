"""Writers. All commit through Spark's committer: readers see whole outputs or none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOCS_PER_SHARD = 200_000


def json_shards(df: DataFrame, path: str, per_file: int = DOCS_PER_SHARD) -> None:
    """Gzipped JSON lines of at most per_file rows a file; an output that is there already is an error."""
    df.write.mode("errorifexists").option("maxRecordsPerFile", per_file).option("compression", "gzip").json(path)


def samples(df: DataFrame, path: str, *keys: str) -> None:
    """One folder for each combination of keys."""
    df.write.mode("errorifexists").partitionBy(*keys).json(path)


def lines(df: DataFrame, column: str, path: str) -> None:
    """Sorted lines of one column, in ascending part files."""
    df.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("errorifexists").text(path)


def token_pool(df: DataFrame, path: str, lang: str = "lang") -> None:
    """(doc, tokens, offset) by language, so that a mixture reads only the languages it needs."""
    df.write.mode("errorifexists").partitionBy(lang).parquet(path)


def by_fate(df: DataFrame, fate: str, paths: dict[str, str]) -> None:
    """Writes the rows of each fate to its own path from one evaluation of df."""
    df.persist()
    try:
        for name, path in paths.items():
            df.where(F.col(fate) == name).drop(fate).write.mode("errorifexists").json(path)
    finally:
        df.unpersist()


def manifest(df: DataFrame, path: str) -> None:
    """One JSON document of an aggregate's only row."""
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("errorifexists").text(path)


def gram_index(df: DataFrame, path: str) -> None:
    """(benchmark, gram) as Parquet, sorted within files: a reader of one benchmark skips the row groups of the others."""
    df.repartitionByRange("benchmark", "gram").sortWithinPartitions("benchmark", "gram").write.mode("errorifexists").parquet(path)


def exact_lines(df: DataFrame, path: str, n: int) -> None:
    """JSON lines of exactly n rows; another number is an error before anything is written."""
    from tessera.operators.budget import require_count

    require_count(df, n).write.mode("errorifexists").json(path)
