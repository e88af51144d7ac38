"""Mixing sources to target weights by weighted fair queueing.

Each shuffled document is served at the virtual finish time (tokens of its source up to and with it) / (the
source's target); a source whose target exceeds its size is queued again, epoch after epoch. One global order by
finish time, truncated at the total budget, is the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, named, row_name, seeded_key, sql_seeded_key, stored
from tessera.llm.ranking import buckets_for, key_bucket, running

SEED = 29
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: What tells rows of one source and key apart.
ROW = ("doc_id", "size", "text_hash")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(stratum, source, source_size, target) of a table (stratum, source, source_size).

    Targets share the total of all sizes by weight; none exceeds max_epochs times its size, and what it cannot
    take is shared again by weight. Solved at once: sources fill up in the order of limit / weight, so the level of
    the rest follows from the sums before each. One row a source; no rows without sources. The
    windows over all sources run in one task: meant for sources as names of collections (up to a few million), not of documents.
    """
    # By code point, null last; 'n' for null sorts before 's', so nullness is its own sort column.
    place = Window.partitionBy().orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("limit", F.col("source_size") * max_epochs)
    fill = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    rows = rows.withColumns(
        {
            "total": F.sum("source_size").over(every),
            "filled": F.coalesce(F.sum("limit").over(before), F.lit(0)),
            "open_weight": F.sum("weight").over(rest),
            "at": F.row_number().over(fill),
        }
    )
    over = F.col("weight") * (F.col("total") - F.col("filled")) / F.col("open_weight") > F.col("limit")
    rows = rows.withColumn("over", over)
    # The first source that fits its share ends the filling; its sums give the level for all after it.
    first = F.min(F.when(~F.col("over"), F.col("at"))).over(every)
    rows = rows.withColumn("first", first)
    rows = rows.withColumn("left", F.max(F.when(F.col("at") == F.col("first"), F.col("total") - F.col("filled"))).over(every))
    rows = rows.withColumn("share", F.max(F.when(F.col("at") == F.col("first"), F.col("open_weight"))).over(every))
    fits = F.col("at") >= F.col("first")
    target = F.when(fits, F.col("weight") * F.col("left") / F.col("share")).otherwise(F.col("limit").cast("double"))
    return rows.select("stratum", "source", "source_size", target.alias("target"))


def text_hash(text_col: str) -> F.Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")


def fair_mix(docs: DataFrame, size: F.Column | None = None, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, text_hash, source_size, target, epochs) of every row: epochs is how often the mix takes it.

    A null text has size 0 and is taken 0 times, as is an empty one; a null source is a source, the last; rows without
    an id are shuffled by their text; rows that repeat an id are separate documents, told apart by their text_hash (rows that repeat
    both are interchangeable). An empty table gives no rows. Only the three named
    columns are read. The budget is the sum of all sizes, and the document that crosses it is not taken.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long") if size is None else size
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), named(source_col).alias("stratum"), words.alias("size"), text_hash(text_col), seeded_key(seed, row_name(id_col, text_col)).alias("key"))
    rows = stored(rows, "mix-rows")
    buckets = buckets_for(docs.sparkSession, rows.count())
    targets = source_targets(rows.groupBy("stratum", "source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    targets = stored(targets.select("stratum", "source_size", "target"), "mix-targets")
    rows = rows.withColumn("bucket", key_bucket(F.col("key"), buckets))
    queued = running(rows, "bucket", [F.col(c) for c in ("key", *ROW)], F.col("size"), "served", group="stratum").drop("bucket", "served_total")
    queued = stored(queued.join(targets, "stratum"), "mix-queue")
    turns = queued.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    turns = turns.withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("served")) / F.col("target"))
    # Finish times reach from 0 to far beyond 1; f / (1 + f) keeps them apart at both ends.
    spread = F.floor(F.col("finish") / (1 + F.col("finish")) * F.lit(2 * buckets)).cast("int")
    turns = turns.select("stratum", "key", *ROW, "epoch", "finish", spread.alias("bucket"))
    order = [F.col(c) for c in ("finish", "stratum", "key", *ROW)]
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cut = running(turns, "bucket", order, F.col("size"), "spent").where(F.col("spent") <= budget)
    counts = cut.groupBy("stratum", "key", *ROW).agg(F.count("*").alias("turns"))
    # Of rows alike in all of these the first in the queue take the larger shares of their turns.
    alike = Window.partitionBy("stratum", "key", *ROW)
    queued = queued.withColumns({"copy": F.row_number().over(alike.orderBy("served")), "copies": F.count("*").over(alike)})
    joined = queued.alias("q").join(counts.alias("c"), [F.col(f"q.{k}").eqNullSafe(F.col(f"c.{k}")) for k in ("stratum", "key", *ROW)], "left")
    epochs = shared_out(F.coalesce(F.col("turns"), F.lit(0)), F.col("copies"), F.col("copy"))
    return joined.select("q.doc_id", "q.source", "q.size", "q.text_hash", "q.source_size", "q.target", epochs.cast("int").alias("epochs"))


def shared_out(total: F.Column, copies: F.Column, copy: F.Column) -> F.Column:
    """The part of total that copy number 1, 2, ... gets: parts differ by one at most, the first are the larger."""
    return F.floor(total / copies) + F.when(copy <= total % copies, 1).otherwise(0)


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fair_mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"))


def oracle() -> str:
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return f"""
WITH rows AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS stratum,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, {sql_seeded_key(SEED, "doc_id", "text")} AS key
  FROM documents),
sizes AS (SELECT stratum, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM rows GROUP BY stratum),
weighed AS (
  SELECT *, ({weights})[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} + 1]::BIGINT AS weight, source_size * {MAX_EPOCHS} AS cap FROM sizes),
filling AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
    coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS filled,
    sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open_weight,
    row_number() OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, source) AS place
  FROM weighed),
level AS (SELECT * FROM filling WHERE weight * (total - filled) / open_weight <= cap ORDER BY place LIMIT 1),
targets AS (
  SELECT f.stratum, f.source_size, CASE WHEN f.place >= l.place THEN f.weight * (l.total - l.filled) / l.open_weight ELSE f.cap::DOUBLE END AS target
  FROM filling f, level l),
queued AS (
  SELECT r.*, source_size, target, sum(size) OVER (PARTITION BY stratum ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING)::DOUBLE AS served
  FROM rows r JOIN targets USING (stratum)),
turns AS (
  SELECT *, (epoch * source_size + served) / target AS finish FROM queued, (SELECT unnest(range({MAX_EPOCHS})) AS epoch) WHERE size > 0),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish, stratum, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS spent FROM turns),
taken AS (SELECT doc_id, count(*) AS epochs FROM cut WHERE spent <= (SELECT sum(size) FROM rows) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, (size * coalesce(epochs, 0))::BIGINT AS taken FROM queued LEFT JOIN taken USING (doc_id)
"""
