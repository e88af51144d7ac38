"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded key within their source; a row of rank r among n gets the fractional rank
(r - 1/2) / n. Sorted by that, every stretch of the table holds the sources in the mixture's proportions, and
the table is cut into stretches whose row counts differ by one at most (law ``rows``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SQL_CRC, named, row_name, seeded_key, sql_seeded_key, stored
from tessera.llm.ranking import buckets_for, key_bucket, running

SEED = 17
SHARDS = 8


def stratified_shards(
    docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """(id, source, size, text_crc32, position, shard, slot) of every row of docs.

    A null text has size 1 and checksum 0; null sources form a source of their own; rows without an
    id are shuffled by their text. Rows that repeat an id keep separate slots. An empty table gives no rows. Other columns
    are not read, so their names cannot clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        named(source_col).alias("stratum"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        seeded_key(seed, row_name(id_col, text_col)).alias("key"),
    )
    rows = stored(rows, "shard-rows")
    n = rows.count()
    buckets = buckets_for(docs.sparkSession, n)
    ties = [F.col(c) for c in ("key", "doc_id", "text_crc32", "size")]
    rows = rows.withColumn("bucket", key_bucket(F.col("key"), buckets))
    ranked = running(rows, "bucket", ties, F.lit(1), "rank", group="stratum")
    ranked = ranked.withColumn("fraction", (F.col("rank") - F.lit(0.5)) / F.col("rank_total")).drop("bucket")
    ranked = stored(ranked.withColumn("bucket", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)).cast("int")), "shard-ranks")
    placed = running(ranked, "bucket", [F.col("fraction"), F.col("stratum"), *ties], F.lit(1), "place")
    position = F.col("place") - 1
    shard = F.expr(f"((place - 1) * {n_shards}) div {max(n, 1)}")
    return placed.select("doc_id", "source", "size", "text_crc32", position.alias("position"), shard.cast("int").alias("shard")).withColumn(
        "slot", F.col("position") - F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")
    )


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return stratified_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def oracle() -> str:
    return f"""
WITH {SQL_CRC.strip()},
rows AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS stratum,
    strlen(coalesce(text, '')) + 1 AS size,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
    {sql_seeded_key(SEED, "doc_id", "text")} AS key
  FROM documents, crc_step),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, text_crc32, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS fraction FROM rows),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, key, doc_id, text_crc32, size) - 1 AS position, count(*) OVER () AS n FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, ((position * {SHARDS}) // n)::INTEGER AS shard,
  (position - (((position * {SHARDS}) // n) * n + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""
