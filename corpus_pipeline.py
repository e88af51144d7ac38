"""From documents to training ids: STAGES in order, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import mixing, quality, sentencepiece_sampling, simhash, substring
from tessera.llm.common import stored


def _named(found: DataFrame, docs: DataFrame, **own) -> DataFrame:
    """found's columns under the names of docs: its own for those given, else those carried as kept_<name>."""
    return found.select(*[own.get(c, F.col(f"kept_{c}") if f"kept_{c}" in found.columns else F.col(c)).alias(c) for c in docs.columns])


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in ("doc_id", "text"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = quality.score(docs, model, keep=_others(docs), with_text=True)
    return _named(judged.where("kept"), docs)


def _hash() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _same(left: DataFrame, right: DataFrame) -> F.Column:
    """Rows of one id (or none) and one text."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["_hash"] == right["_hash"])


def _copies(docs: DataFrame) -> F.Column:
    """The number, from 1, of a row among those of its id and text, by its other columns."""
    return F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy(*_others(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: that of the least id, a row with an id before rows without.

    Of rows of that id the one of the least fingerprint and text hash stays; rows that repeat an id with texts that nothing
    links are groups of their own and all stay.
    """
    found = stored(simhash.near_duplicates(docs), "near")
    # One row a group and map task: a group that holds a third of all rows is combined before it is shuffled.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp", "text_hash")).alias("first")
    heads = found.groupBy("root").agg(first).select("first.doc_id", F.col("first.text_hash").alias("_hash"))
    marked = docs.withColumn("_hash", _hash())
    kept = marked.join(heads, _same(marked, heads), "left_semi")
    if not found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        kept = kept.withColumn("_copy", _copies(docs)).where("_copy = 1")
    return kept.select(docs.columns)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; those that lose every word go."""
    found = substring.remove_repeats(docs, keep=_others(docs), layout=True).where("n_removed = 0 or n_removed < n_words")
    length = F.length("kept").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return _named(found, docs, text=F.col("kept"), **({"n_chars": length} if length is not None else {}))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those that it does not take go."""
    mix = mixing.fair_mix(docs).groupBy("doc_id", F.col("text_hash").alias("_hash")).agg(F.sum("epochs").alias("_turns"), F.count("*").alias("_copies"))
    marked = docs.withColumn("_hash", _hash())
    taken = mix.where("_turns > 0")
    turns = marked.join(taken, _same(marked, taken)).select(marked["*"], "_turns", "_copies").withColumn("_copy", _copies(docs))
    epochs = mixing.shared_out(F.col("_turns"), F.col("_copies"), F.col("_copy")).cast("int")
    return turns.withColumn("_epochs", epochs).where("_epochs > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(1), "_epochs"))).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document's whole text: (doc_id, source, turn, sample, ids, log_prob, inclusion).

    A document that the mix took several times is sampled anew in each turn.
    """
    turns = docs.withColumn("_hash", _hash()).withColumn("turn", _copies(docs))
    found = sentencepiece_sampling.sample_encode(turns, keep=("source", "turn"), turn_col="turn")
    return found.select("doc_id", F.col("kept_source").alias("source"), F.col("kept_turn").alias("turn"), "sample", "ids", "log_prob", "inclusion")


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_passages),
    ("mix_to_target_weights", mix_sources),
    ("sentencepiece_encode", encode_pieces),
]

#: Trees, fingerprints and sampled paths have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
