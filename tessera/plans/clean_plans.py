"""Queries of the cleaning cascade, exact duplicates, accounts and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.functions import text as t
from tessera.operators import audit, dedup
from tessera.operators.prefix import least_per_key
from tessera.plans.text_plans import HASH, NUMBER, hashed

MIN_CHARS, MAX_CHARS, MIN_RATIO = 500, 100_000, 0.5
#: Patterns for the synthetic documents, in the place of the Thai ones of functions.rules.
PATTERNS = {"shouting": "!! [^ ]+!!", "symbols": "[#*$%&]{3}", "table": r" \| [^ ]+ \| "}
SAMPLE = 5


def cascade(spark, sf_dir):
    """Documents with doc_sha256, ratio, duplicate and drop_reason: the first rule that holds; null is kept."""
    docs = hashed(spark, sf_dir).withColumn("ratio", t.script_ratio(F.col("text"), "A-z"))
    before = [
        ("heldout_bucket", t.is_heldout(F.col("doc_sha256"))),
        ("too_short", F.length("text") < MIN_CHARS),
        ("too_long", F.length("text") > MAX_CHARS),
        ("low_script_ratio", F.col("ratio") < MIN_RATIO),
        *rules.pattern_rules(F.col("text"), PATTERNS, "spam_"),
    ]
    docs = docs.select("doc_id", "lang", "source", "doc_sha256", F.octet_length("text").cast("long").alias("bytes"), rules.first_rule(before).alias("early"))
    # Duplicates are told among the rows that no rule before has dropped; texts stay out of the shuffle.
    docs = rules.mark_repeats(docs, "doc_sha256", "doc_id", F.col("early").isNull(), "duplicate")
    return docs.withColumn("drop_reason", F.coalesce("early", F.when(F.col("duplicate"), "exact_duplicate"))).drop("early", "duplicate")


def clean_drop_reason(spark, sf_dir):
    return cascade(spark, sf_dir).select("doc_id", F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason"))


def drop_accounting(spark, sf_dir):
    return audit.accounts(cascade(spark, sf_dir), "drop_reason", "bytes")


def drop_accounting_by_source(spark, sf_dir):
    """Shard partials and their totals by language in one pass."""
    rows = cascade(spark, sf_dir).withColumn("reason", F.coalesce("drop_reason", F.lit("kept")))
    sums = rows.rollup("lang", "source", "reason").agg(F.count("*").alias("documents"), F.sum("bytes").alias("bytes"), F.grouping_id().alias("level"))
    return sums.where("level in (0, 3)").select("lang", F.coalesce("source", F.lit("*")).alias("source"), F.coalesce("reason", F.lit("*")).alias("reason"), "documents", "bytes")


def exact_dedup(spark, sf_dir):
    return dedup.exact_survivors(hashed(spark, sf_dir).select("doc_id", "doc_sha256"), "doc_sha256", "doc_id").select("doc_id", "doc_sha256")


def first_matching_rule(spark, sf_dir):
    docs = hashed(spark, sf_dir)
    return docs.select("doc_id", F.coalesce(rules.first_rule(rules.pattern_rules(F.col("text"), PATTERNS)), F.lit("none")).alias("rule"))


def pattern_flags(spark, sf_dir):
    docs = hashed(spark, sf_dir)
    return docs.select("doc_id", *[F.col("text").rlike(p).alias(name) for name, p in PATTERNS.items()])


def corpus_audit(spark, sf_dir):
    docs = hashed(spark, sf_dir).withColumn("ratio", t.script_ratio(F.col("text"), "A-z"))
    return audit.corpus_audit(docs, "doc_sha256", "ratio", {name: F.col("text").rlike(p) for name, p in PATTERNS.items()})


def length_percentiles(spark, sf_dir):
    docs = hashed(spark, sf_dir).select("lang", F.length("text").alias("chars"))
    return audit.floor_percentiles(docs, "lang", "chars", {"p10": 0.1, "median": 0.5, "p90": 0.9, "p99": 0.99, "most": 1.0})


def drop_samples(spark, sf_dir):
    """Of each reason the documents of the least audit keys."""
    rows = cascade(spark, sf_dir).where("drop_reason is not null")
    rows = rows.withColumn("key", F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), "doc_sha256", "drop_reason"), 256))
    return least_per_key(rows, ["drop_reason"], SAMPLE, [F.col("key")]).select("drop_reason", "key", "doc_id")


def replay_fate(spark, sf_dir):
    """The cascade of a pool with licences: each document's licence is dealt from a fixed list by its id."""
    docs = hashed(spark, sf_dir).withColumn("licence", F.element_at(F.array(*[F.lit(x) for x in LICENCES]), (F.col("doc_id") % len(LICENCES) + 1).cast("int")))
    before = [
        ("missing_text", F.col("text").isNull() | (F.col("text") == "")),
        ("heldout_bucket", t.is_heldout(F.col("doc_sha256"))),
        ("too_short", F.length("text") < 200),
        ("too_long", F.length("text") > MAX_CHARS),
        ("disallowed_license", ~t.licence_key(F.col("licence")).isin(*t.CODE_LICENCES)),
    ]
    docs = docs.select("doc_id", "doc_sha256", rules.first_rule(before).alias("early"))
    docs = rules.mark_repeats(docs, "doc_sha256", "doc_id", F.col("early").isNull(), "duplicate")
    return docs.select("doc_id", F.coalesce("early", F.when(F.col("duplicate"), "exact_duplicate"), F.lit("kept")).alias("fate"))


LICENCES = ("MIT", "apache_2.0", "gpl-3.0")

QUERIES = {
    f.__name__: f
    for f in (clean_drop_reason, drop_accounting, drop_accounting_by_source, exact_dedup, first_matching_rule, pattern_flags, corpus_audit, length_percentiles, drop_samples, replay_fate)
}

_MATCH = {name: f"regexp_matches(text, '{p}')" for name, p in PATTERNS.items()}
_RATIO = "CASE WHEN length(text) = 0 THEN 0 ELSE length(regexp_replace(text, '[^A-z]', '', 'g'))::DOUBLE / length(text) END"
_CASCADE = f"""
early AS (SELECT doc_id, lang, source, {HASH} AS doc_sha256, strlen(text) AS bytes, CASE WHEN {NUMBER} % 100 = 0 THEN 'heldout_bucket' WHEN length(text) < {MIN_CHARS} THEN 'too_short'
  WHEN length(text) > {MAX_CHARS} THEN 'too_long' WHEN {_RATIO} < {MIN_RATIO} THEN 'low_script_ratio' {" ".join(f"WHEN {m} THEN 'spam_{n}'" for n, m in _MATCH.items())} END AS early FROM documents),
cascade AS (SELECT *, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY early IS NULL, doc_sha256 ORDER BY doc_id) > 1 THEN 'exact_duplicate' END) AS drop_reason FROM early)"""
ORACLE = {
    "clean_drop_reason": f"WITH {_CASCADE} SELECT doc_id, coalesce(drop_reason, 'kept') AS drop_reason FROM cascade",
    "drop_accounting": f"WITH {_CASCADE} SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS documents, sum(bytes)::BIGINT AS bytes FROM cascade GROUP BY 1",
    "drop_accounting_by_source": f"""WITH {_CASCADE} SELECT lang, source, coalesce(drop_reason, 'kept') AS reason, count(*) AS documents, sum(bytes)::BIGINT AS bytes FROM cascade GROUP BY ALL
UNION ALL SELECT lang, '*', '*', count(*), sum(bytes)::BIGINT FROM cascade GROUP BY lang""",
    "exact_dedup": f"SELECT min(doc_id) AS doc_id, {HASH} AS doc_sha256 FROM documents GROUP BY 2",
    "first_matching_rule": f"SELECT doc_id, CASE {' '.join(f'WHEN {m} THEN {chr(39)}{n}{chr(39)}' for n, m in _MATCH.items())} ELSE 'none' END AS rule FROM documents",
    "pattern_flags": f"SELECT doc_id, {', '.join(f'{m} AS {chr(34)}{n}{chr(34)}' for n, m in _MATCH.items())} FROM documents",
    "corpus_audit": f"""
WITH d AS (SELECT *, {HASH} AS h, {_RATIO} AS ratio, strlen(text) AS b FROM documents), c AS (SELECT sum(n - 1) AS copies, sum((n - 1) * b) AS copy_bytes FROM (SELECT h, count(*) AS n, max(b) AS b FROM d GROUP BY h))
SELECT count(*) AS documents, sum(b)::BIGINT AS bytes, round(avg(length(text)))::BIGINT AS mean_chars, round(count(*) FILTER (length(text) < 500)::DOUBLE / count(*), 4) AS short_rate,
  round(avg(ratio), 4) AS script_mean, round(count(*) FILTER (ratio < 0.5)::DOUBLE / count(*), 4) AS script_under_half,
  {", ".join(f"round(count(*) FILTER ({m})::DOUBLE / count(*), 4) AS {n}_docs, round(coalesce(sum(b) FILTER ({m}), 0)::DOUBLE / sum(b), 4) AS {n}_bytes" for n, m in _MATCH.items())},
  round((SELECT copies FROM c)::DOUBLE / count(*), 4) AS duplicate_rate, round((SELECT copy_bytes FROM c)::DOUBLE / sum(b), 4) AS duplicate_bytes FROM d""",
    "length_percentiles": """
WITH l AS (SELECT lang, list_sort(list(length(text))) AS v, count(*) AS n FROM documents GROUP BY lang)
SELECT lang, v[floor(0.1::DOUBLE * n)::BIGINT + 1]::INTEGER AS p10, v[floor(0.5::DOUBLE * n)::BIGINT + 1]::INTEGER AS median, v[floor(0.9::DOUBLE * n)::BIGINT + 1]::INTEGER AS p90,
  v[floor(0.99::DOUBLE * n)::BIGINT + 1]::INTEGER AS p99, v[n]::INTEGER AS most FROM l""",
    "drop_samples": f"""WITH {_CASCADE}, k AS (SELECT drop_reason, doc_id, sha256(doc_id || ':' || doc_sha256 || ':' || drop_reason) AS key FROM cascade WHERE drop_reason IS NOT NULL)
SELECT drop_reason, key, doc_id FROM k QUALIFY row_number() OVER (PARTITION BY drop_reason ORDER BY key) <= {SAMPLE}""",
    "replay_fate": f"""
WITH early AS (SELECT doc_id, {HASH} AS h, CASE WHEN text IS NULL OR text = '' THEN 'missing_text' WHEN {NUMBER} % 100 = 0 THEN 'heldout_bucket' WHEN length(text) < 200 THEN 'too_short'
  WHEN length(text) > {MAX_CHARS} THEN 'too_long' WHEN doc_id % 3 = 2 THEN 'disallowed_license' END AS early FROM documents)
SELECT doc_id, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY early IS NULL, h ORDER BY doc_id) > 1 THEN 'exact_duplicate' END, 'kept') AS fate FROM early""",
}
