"""Queries that check outputs again, and the resumable intake."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as t
from tessera.operators import audit, budget
from tessera.plans.clean_plans import _CASCADE, cascade
from tessera.plans.text_plans import HASH, NUMBER, hashed
from tessera.sources.shared import shared_path
from tessera.sources.tables import table
from tessera.streaming.incremental import new_documents


def verify_report(spark, sf_dir):
    docs = hashed(spark, sf_dir)
    checks = {"empty": F.length("text") == 0, "heldout": t.is_heldout(F.col("doc_sha256")), "length_mismatch": F.length("text") != F.col("n_chars")}
    return audit.verify(docs, "doc_sha256", checks)


def reconcile_totals(spark, sf_dir):
    """Totals by language against a manifest of the same, off in one language and with one too many."""
    observed = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("documents"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))
    off = F.when(F.col("lang") == "de", 1).otherwise(0)
    claimed = observed.select("lang", (F.col("documents") + off).alias("documents"), "bytes").where("lang <> 'fr'")
    claimed = claimed.unionByName(spark.createDataFrame([("th", 1, 2)], "lang string, documents long, bytes long"))
    return audit.reconcile(claimed, observed, "lang", ["documents", "bytes"])


def frozen_integrity(spark, sf_dir):
    """Texts whose stored hash is not theirs; every hundredth stored hash is spoilt on purpose."""
    stored = F.when(F.col("doc_id") % 100 == 7, F.lit("0")).otherwise(F.sha2("text", 256))
    return table(spark, sf_dir, "documents").select("doc_id", "text", stored.alias("stored")).where(F.sha2("text", 256) != F.col("stored")).select("doc_id")


def mixture_violations(spark, sf_dir):
    """Languages whose share of kept tokens is off a target by over three points, or over a cap."""
    kept = cascade(spark, sf_dir).where("drop_reason is null")
    shares = budget.shares(kept.withColumnRenamed("bytes", "tokens"), "lang", "tokens")
    targets = spark.createDataFrame([("de", 30.0), ("en", 30.0), ("es", 20.0), ("fr", 20.0)], "lang string, wanted double")
    return shares.join(targets, "lang", "right").select("lang", F.coalesce("percent", F.lit(0.0)).alias("percent"), (F.abs(F.coalesce("percent", F.lit(0.0)) - F.col("wanted")) > 3).alias("off_target"), (F.coalesce("percent", F.lit(0.0)) > 35).alias("over_cap"))


def incremental_dedup(spark, sf_dir):
    """The hashes that a stream over the documents' files keeps: those of exact_dedup."""
    schema = table(spark, sf_dir, "documents").schema
    found = new_documents(spark, f"{sf_dir}/documents.parque[t]", schema, t.doc_hash(F.col("text")), shared_path(spark, "intake"), shared_path(spark, "intake-state"))
    return found.select("doc_sha256")


def bits_per_byte(spark, sf_dir):
    """Sum of nats over ln 2 times the bytes, by language; the nats here are the word count, for want of a model's."""
    nats = F.regexp_count("text", F.lit(f"[^{t.WS}]+"))
    rows = table(spark, sf_dir, "documents").select("lang", nats.alias("nats"), F.octet_length("text").alias("b"))
    return rows.groupBy("lang").agg(F.round(F.sum("nats") / (F.ln(F.lit(2.0)) * F.sum("b")), 6).alias("bits_per_byte"))


def throughput_stats(spark, sf_dir):
    """Median, mean, p90, relative spread and maximum of a metric by kind, as a run's log is summed up."""
    rows = table(spark, sf_dir, "events").select("event_type", F.round("value", 3).alias("value"))
    exact = audit.floor_percentiles(rows, "event_type", "value", {"p90": 0.9})
    aggs = rows.groupBy("event_type").agg(F.median("value").alias("median"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value") / F.avg("value"), 6).alias("cv"), F.max("value").alias("most"))
    return aggs.join(exact, "event_type")


def weighted_accuracy(spark, sf_dir):
    """Accuracy over parts, weighted by their sizes, from labels as right and wrong answers."""
    parts = table(spark, sf_dir, "labels").groupBy((F.col("doc_id") % 5).alias("part")).agg(F.avg("quality").alias("acc"), F.count("*").alias("n"))
    return parts.agg(F.round(F.sum(F.col("acc") * F.col("n")) / F.sum("n"), 6).alias("accuracy"), F.sum("n").alias("n"))


QUERIES = {f.__name__: f for f in (verify_report, reconcile_totals, frozen_integrity, mixture_violations, incremental_dedup, bits_per_byte, throughput_stats, weighted_accuracy)}

ORACLE = {
    "verify_report": f"""
WITH h AS (SELECT *, {HASH} AS h, {NUMBER} AS n FROM documents), c AS (SELECT count(*) AS documents, count(*) FILTER (length(text) = 0) AS empty, count(*) FILTER (n % 100 = 0) AS heldout,
  count(*) FILTER (length(text) <> n_chars) AS length_mismatch, (count(*) - count(DISTINCT h))::BIGINT AS duplicates FROM h)
SELECT *, CASE WHEN empty + heldout + length_mismatch + duplicates = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM c""",
    "reconcile_totals": """
WITH o AS (SELECT lang, count(*) AS documents, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY lang),
c AS (SELECT lang, documents + CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS documents, bytes FROM o WHERE lang <> 'fr' UNION ALL SELECT 'th', 1, 2)
SELECT coalesce(o.lang, c.lang) AS lang, c.documents AS documents_claimed, c.bytes AS bytes_claimed, o.documents AS documents_observed, o.bytes AS bytes_observed,
  c.documents IS NOT DISTINCT FROM o.documents AND c.bytes IS NOT DISTINCT FROM o.bytes AS agrees FROM c FULL JOIN o ON c.lang = o.lang""",
    "frozen_integrity": "SELECT doc_id FROM documents WHERE doc_id % 100 = 7",
    "mixture_violations": f"""
WITH {_CASCADE}, s AS (SELECT lang, round(sum(bytes)::DOUBLE / (SELECT sum(bytes) FROM cascade WHERE drop_reason IS NULL) * 100, 6) AS p FROM cascade WHERE drop_reason IS NULL GROUP BY lang),
w AS (SELECT * FROM (VALUES ('de', 30.0::DOUBLE), ('en', 30.0), ('es', 20.0), ('fr', 20.0)) AS v(lang, wanted))
SELECT lang, coalesce(p, 0) AS percent, abs(coalesce(p, 0) - wanted) > 3 AS off_target, coalesce(p, 0) > 35 AS over_cap FROM w LEFT JOIN s USING (lang)""",
    "incremental_dedup": f"SELECT DISTINCT {HASH} AS doc_sha256 FROM documents",
    "bits_per_byte": f"SELECT lang, round(sum(len(regexp_extract_all(text, '[^{t.SQL_WS}]+')))::DOUBLE / (ln(2.0::DOUBLE) * sum(strlen(text))), 6) AS bits_per_byte FROM documents GROUP BY lang",
    "throughput_stats": """
WITH r AS (SELECT event_type, round(value, 3) AS value FROM events), l AS (SELECT event_type, list_sort(list(value)) AS v, count(*) AS n FROM r GROUP BY event_type)
SELECT event_type, median(value) AS median, round(avg(value), 6) AS mean, round(stddev_pop(value) / avg(value), 6) AS cv, max(value) AS most, any_value(v[floor(0.9::DOUBLE * n)::BIGINT + 1]) AS p90 FROM r JOIN l USING (event_type) GROUP BY event_type""",
    "weighted_accuracy": "SELECT round(avg(quality), 6) AS accuracy, count(*) AS n FROM labels",
}
