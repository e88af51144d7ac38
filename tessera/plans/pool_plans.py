"""Queries of imports and raw candidates, token pools and streams, shard verification, and plain SQL over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import detectors, rules
from tessera.functions import text as t
from tessera.functions.tokens import token_counts
from tessera.operators import audit, budget
from tessera.operators.prefix import least_per_key, running_sum
from tessera.plans.budget_plans import SEED, _shuffled
from tessera.plans.clean_plans import LICENCES, MAX_CHARS
from tessera.plans.detect_plans import _CLEAN
from tessera.plans.text_plans import HASH, NUMBER, hashed
from tessera.sources.shared import stored
from tessera.sources.tables import register_views, table

MIN_CHARS = 200
SHARD_TARGET, SCAN_CAP, HELD_PER_LANG, POOL_TARGET = 800_000, 150, 3, 1_000
LANGS = ("fr", "de", "es", "en")
SEQ, END = 4096, "\x03"
RECOUNT = 20


def _licence():
    return F.element_at(F.array(*[F.lit(x) for x in LICENCES]), (F.col("doc_id") % len(LICENCES) + 1).cast("int"))


def _allowed():
    return t.licence_key(_licence()).isin(*t.CODE_LICENCES)


def import_fate(spark, sf_dir):
    """Documents scanned before, taken over: a stored hash that is not the text's ends the job, then held-out, licence, duplicate."""
    docs = hashed(spark, sf_dir).withColumn("claimed", F.col("doc_sha256"))
    true = F.when(F.col("claimed") == F.col("doc_sha256"), F.col("claimed")).otherwise(F.raise_error(F.concat(F.lit("hash mismatch "), "claimed")))
    early = [("heldout", t.is_heldout(F.col("doc_sha256"))), ("disallowed_license", ~_allowed())]
    rows = docs.select("doc_id", true.alias("doc_sha256"), rules.first_rule(early).alias("early"))
    rows = rules.mark_repeats(rows, "doc_sha256", "doc_id", F.col("early").isNull(), "again")
    return rows.select("doc_id", F.coalesce("early", F.when(F.col("again"), "exact_duplicate"), F.lit("imported")).alias("fate"))


def candidate_fate(spark, sf_dir):
    """Raw candidates: the rules of a pool, secrets, personal data, and the rules after redaction.

    Only the hash after redaction is remembered. So a second raw copy of a text that redaction changes is no exact
    duplicate, but one after redaction; a copy of a text that it does not change is an exact one.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", detectors.scanned(F.col("text")).alias("s"))
    early = [
        ("missing_text", F.coalesce(F.col("text"), F.lit("")) == ""),
        ("heldout", t.is_heldout(F.col("s.before"))),
        ("too_short", F.length("text") < MIN_CHARS),
        ("too_long", F.length("text") > MAX_CHARS),
        ("disallowed_license", ~_allowed()),
    ]
    late = [("private_key_document", F.col("s.dropped")), ("post_redaction_heldout", F.col("s.changed") & t.is_heldout(F.col("s.after"))), ("zero_tokens", F.col("s.bytes") <= 0)]
    rows = stored(docs.select("doc_id", "s.before", "s.after", rules.first_rule(early).alias("early"), rules.first_rule(late).alias("late")), "candidates")
    kept = rows.where("early is null and late is null").groupBy(F.col("after").alias("_k")).agg(F.min("doc_id").alias("_first"))
    for column, out in (("before", "known"), ("after", "known_after")):
        rows = rows.join(kept, rows[column] == kept["_k"], "left").withColumn(out, F.coalesce(F.col("_first") < F.col("doc_id"), F.lit(False))).drop("_k", "_first")
    exact = F.when(F.col("known"), "exact_duplicate")
    again = F.when((F.col("before") != F.col("after")) & F.col("known_after"), "post_redaction_exact_duplicate")
    first = F.when(F.col("late") != "zero_tokens", F.col("late"))
    return rows.select("doc_id", F.coalesce("early", exact, first, again, "late", F.lit("kept")).alias("fate"))


def verify_shards(spark, sf_dir):
    """Every shard (here a source) checked again in full: hashes, held-out texts, tokens, origin, licence, copies and totals.

    The claims are true but for some spoilt on purpose: hashes, revisions, and the first shard's number of documents.
    """
    docs = hashed(spark, sf_dir)
    spoilt = F.when(F.col("doc_id") % 100 == 7, F.lit("0")).otherwise(F.col("doc_sha256"))
    revision = F.when(F.col("doc_id") % 50 == 3, F.lit("r0")).otherwise(F.lit("r1"))
    checks = {"hash_mismatch": spoilt != F.col("doc_sha256"), "heldout": t.is_heldout(F.col("doc_sha256")), "no_tokens": F.octet_length("text") <= 0, "wrong_revision": revision != "r1", "bad_licence": ~_allowed()}
    totals = {"documents": F.lit(1), "bytes": F.octet_length("text").cast("long")}
    claimed = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.octet_length("text")).alias("bytes"))
    first = claimed.agg(F.min("source").alias("first"))
    claimed = claimed.crossJoin(F.broadcast(first)).select("source", (F.col("documents") + (F.col("source") == F.col("first")).cast("int")).alias("documents"), "bytes")
    return audit.verify_shards(docs, ["source"], "doc_sha256", checks, "doc_id", totals, claimed)


def rederived_totals(spark, sf_dir):
    """Totals of each language derived anew from all rows: documents, tokens, copies, held-out leaks, flagged share, largest source."""
    rows = hashed(spark, sf_dir).select("lang", "source", "doc_sha256", F.octet_length("text").cast("long").alias("tokens"), F.col("text").contains("!!").alias("flagged"))
    rows = stored(rows, "rederived")
    sums = rows.groupBy("lang").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.count_if(t.is_heldout(F.col("doc_sha256"))).alias("leaks"), F.round(F.count_if("flagged") / F.count("*"), 6).alias("flagged_rate"))
    copies = rows.groupBy("lang", "doc_sha256").agg(F.count("*").alias("n")).groupBy("lang").agg(F.sum(F.col("n") - 1).alias("copies"))
    largest = rows.groupBy("lang", "source").agg(F.sum("tokens").alias("n")).groupBy("lang").agg(F.max("n").alias("n"))
    joined = sums.join(copies, "lang").join(largest, "lang")
    return joined.select("lang", "documents", "tokens", "copies", "leaks", "flagged_rate", F.round(100 * F.col("n") / F.col("tokens"), 3).alias("largest_source"), F.when(F.col("copies") + F.col("leaks") == 0, "PASS").otherwise("FAIL").alias("verdict"))


def token_recount(spark, sf_dir):
    """Recorded token counts of a sample of each language, counted again; every tenth record is off on purpose."""
    docs = table(spark, sf_dir, "documents").withColumn("key", F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("doc_id").cast("string")), 256))
    recorded = token_counts(F.col("text"), "words") + F.when(F.col("doc_id") % 10 == 0, 1).otherwise(0)
    chosen = least_per_key(docs.select("lang", "key", "doc_id"), ["lang"], RECOUNT, [F.col("key")])
    sample = docs.join(chosen.select("doc_id"), "doc_id", "left_semi").withColumn("recorded", recorded)
    return audit.recount(sample, "lang", "recorded", token_counts(F.col("text"), "words"))


def token_pool(spark, sf_dir):
    """Documents that pass the removal and held-out guards as tokens with an end mark: offset in the language's pool, and a hash."""
    docs = hashed(spark, sf_dir).where(~t.is_heldout(F.col("doc_sha256")))
    ended = F.concat("text", F.lit(END))
    rows = docs.select("lang", "doc_id", token_counts(ended, "characters").alias("tokens"), F.sha2(ended, 256).alias("tokens_sha256"))
    return running_sum(rows, "tokens", ["doc_id"], "offset", ["lang"]).select("lang", "doc_id", "offset", "tokens", "tokens_sha256")


def packed_stream(spark, sf_dir):
    """The packed training stream, a hash of every sequence's tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(END)).alias("ended"))
    keyed = docs.select("doc_id", token_counts(F.col("ended"), "characters").alias("tokens"), F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("doc_id").cast("string")), 256).alias("key"))
    parts = budget.packed(stored(keyed, "stream-docs"), "tokens", ["key"], SEQ).select("seq_id", "start_in_seq", "n", "from_token", "doc_id")
    cut = parts.join(docs, "doc_id").select("seq_id", "start_in_seq", F.substring("ended", F.col("from_token") + 1, F.col("n")).alias("part"))
    # A sequence has SEQ tokens, so its parts are few.
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_in_seq", "part"))), lambda p: p["part"]), "")
    return cut.groupBy("seq_id").agg(F.sha2(whole, 256).alias("tokens_sha256"))


def shards_until_target(spark, sf_dir):
    """Sources fetched one by one until their tokens reach a target."""
    totals = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text")).cast("long").alias("tokens"))
    return budget.shards_until(totals, "tokens", SHARD_TARGET, ["source"])


def scan_cap(spark, sf_dir):
    """The first documents of the scan, up to its cap, in the order of language and id."""
    return budget.scan_cap(table(spark, sf_dir, "documents").select("lang", "doc_id"), ["lang", "doc_id"], SCAN_CAP)


def exact_heldout(spark, sf_dir):
    """A held-out set of an exact number of documents a language; fewer end the job."""
    docs = _shuffled(spark, sf_dir)
    n = docs.select("lang").distinct().count()
    return budget.require_count(least_per_key(docs, ["lang"], HELD_PER_LANG, [F.col("key")]).select("lang", "doc_id"), n * HELD_PER_LANG)


def pool_met(spark, sf_dir):
    """Languages whose documents reach a target; a language that runs out ends the job."""
    docs = _shuffled(spark, sf_dir)
    targets = docs.select("lang").distinct().withColumn("target", F.lit(POOL_TARGET))
    used = budget.take_until(budget.require_met(docs, "tokens", targets, "lang"), "tokens", F.lit(POOL_TARGET), ["key"], ["lang"])
    return used.groupBy("lang").agg(F.sum("tokens").alias("tokens"))


def sources_in_order(spark, sf_dir):
    """The pools one after the other in a fixed order, and each document's place in it."""
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id")
    every = budget.in_order({lang: docs.where(F.col("lang") == lang) for lang in LANGS})
    return running_sum(every.withColumn("one", F.lit(1)), "one", ["pool_ord", "doc_id"], "place").select("pool", "doc_id", "place")


def assembled_manifest(spark, sf_dir):
    """One manifest of three: documents and bytes by language, duplicates, and held-out documents."""
    rows = stored(hashed(spark, sf_dir).select("lang", "doc_sha256", F.octet_length("text").cast("long").alias("bytes")), "manifest-rows")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("documents"), F.sum("bytes").alias("bytes"))
    copies = rows.groupBy("lang", "doc_sha256").agg(F.count("*").alias("n")).where("n > 1").groupBy("lang").agg(F.sum(F.col("n") - 1).alias("copies"))
    held = rows.where(t.is_heldout(F.col("doc_sha256"))).groupBy("lang").agg(F.count("*").alias("heldout"))
    joined = sizes.join(copies, "lang", "left").join(held, "lang", "left")
    return joined.select("lang", "documents", "bytes", F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("heldout", F.lit(0)).alias("heldout"))


def rows_by_bucket(spark, sf_dir):
    """Of each language and hash bucket of ten its documents in order, a bounded list of each, for evaluation in groups."""
    rows = hashed(spark, sf_dir).select("lang", (t.bucket(F.col("doc_sha256")) % 10).alias("bucket"), "doc_id")
    some = least_per_key(rows, ["lang", "bucket"], 25, [F.col("doc_id")])
    return some.groupBy("lang", "bucket").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("documents"))


TERMS = "[#*$%&]{3}"


def review_terms(spark, sf_dir):
    """What a pattern matched in each document that it drops, and a preview."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike(TERMS))
    return docs.select("doc_id", F.concat_ws(" ", rules.matched_terms(F.col("text"), TERMS)).alias("terms"), t.preview(F.col("text")).alias("preview"))


def sql_totals(spark, sf_dir):
    """Plain SQL over registered views."""
    register_views(spark, sf_dir, ("documents", "labels"))
    return spark.sql(SQL_TOTALS)


SQL_TOTALS = "SELECT lang, count(*) AS documents, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang HAVING count(*) > 1"

QUERIES = {
    f.__name__: f
    for f in (
        import_fate, candidate_fate, verify_shards, rederived_totals, token_recount, token_pool, packed_stream, shards_until_target, scan_cap, exact_heldout,
        pool_met, sources_in_order, assembled_manifest, rows_by_bucket, review_terms, sql_totals,
    )
}

_KEY = f"sha256('{SEED}:' || doc_id)"
_BAD_LICENCE = "doc_id % 3 = 2"
_H = f"h AS (SELECT *, {HASH} AS d, {NUMBER} % 100 = 0 AS held FROM documents)"
_WORDS = f"len(regexp_extract_all(text, '[^{t.SQL_WS}]+'))"
ORACLE = {
    "import_fate": f"""
WITH {_H}, e AS (SELECT *, CASE WHEN held THEN 'heldout' WHEN {_BAD_LICENCE} THEN 'disallowed_license' END AS early FROM h)
SELECT doc_id, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY early IS NULL, d ORDER BY doc_id) > 1 THEN 'exact_duplicate' END, 'imported') AS fate FROM e""",
    "candidate_fate": f"""
WITH {_CLEAN}, e AS (SELECT *, CASE WHEN raw = '' THEN 'missing_text' WHEN ('0x' || substr(source_doc_sha256, 1, 8))::BIGINT % 100 = 0 THEN 'heldout' WHEN length(raw) < {MIN_CHARS} THEN 'too_short'
  WHEN length(raw) > {MAX_CHARS} THEN 'too_long' WHEN {_BAD_LICENCE} THEN 'disallowed_license' END AS early, CASE WHEN changed AND ('0x' || substr(doc_sha256, 1, 8))::BIGINT % 100 = 0 THEN 'post_redaction_heldout' END AS late FROM h),
k AS (SELECT doc_sha256 AS k, min(doc_id) AS first FROM e WHERE early IS NULL AND late IS NULL GROUP BY doc_sha256)
SELECT doc_id, coalesce(early, CASE WHEN a.first < doc_id THEN 'exact_duplicate' END, late, CASE WHEN source_doc_sha256 <> doc_sha256 AND b.first < doc_id THEN 'post_redaction_exact_duplicate' END, 'kept') AS fate
FROM e LEFT JOIN k a ON a.k = source_doc_sha256 LEFT JOIN k b ON b.k = doc_sha256""",
    "verify_shards": f"""
WITH {_H}, r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY doc_id) > 1 AS copy FROM h), s AS (SELECT source, count(*) FILTER (doc_id % 100 = 7) AS hash_mismatch, count(*) FILTER (held) AS heldout,
  count(*) FILTER (strlen(text) <= 0) AS no_tokens, count(*) FILTER (doc_id % 50 = 3) AS wrong_revision, count(*) FILTER ({_BAD_LICENCE}) AS bad_licence, count(*) FILTER (copy) AS copies FROM r GROUP BY source),
o AS (SELECT *, (source = (SELECT min(source) FROM s))::BIGINT AS totals_off FROM s)
SELECT *, CASE WHEN hash_mismatch + heldout + no_tokens + wrong_revision + bad_licence + copies + totals_off = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM o""",
    "rederived_totals": f"""
WITH {_H}, l AS (SELECT lang, max(n) AS n FROM (SELECT lang, source, sum(strlen(text)) AS n FROM documents GROUP BY lang, source) GROUP BY lang),
s AS (SELECT lang, count(*) AS documents, sum(strlen(text))::BIGINT AS tokens, (count(*) - count(DISTINCT d))::BIGINT AS copies, count(*) FILTER (held) AS leaks, round(count(*) FILTER (contains(text, '!!'))::DOUBLE / count(*), 6) AS flagged_rate FROM h GROUP BY lang)
SELECT lang, documents, tokens, copies, leaks, flagged_rate, round(100 * n::DOUBLE / tokens, 3) AS largest_source, CASE WHEN copies + leaks = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM s JOIN l USING (lang)""",
    "token_recount": f"""
WITH k AS (SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_KEY}) <= {RECOUNT})
SELECT lang, count(*) AS sampled, count(*) FILTER (doc_id % 10 = 0) AS mismatches FROM k GROUP BY lang""",
    "token_pool": f"""
WITH {_H} SELECT lang, doc_id, (sum(length(text) + 1) OVER (PARTITION BY lang ORDER BY doc_id) - length(text) - 1)::BIGINT AS offset, (length(text) + 1)::BIGINT AS tokens, sha256(text || chr(3)) AS tokens_sha256 FROM h WHERE NOT held""",
    "packed_stream": f"""
WITH s AS (SELECT string_agg(text || chr(3), '' ORDER BY {_KEY}) AS s FROM documents), q AS (SELECT s, unnest(range(0, length(s) // {SEQ})) AS seq_id FROM s)
SELECT seq_id, sha256(substr(s, seq_id * {SEQ} + 1, {SEQ})) AS tokens_sha256 FROM q""",
    "shards_until_target": f"""
WITH s AS (SELECT source, sum(strlen(text))::BIGINT AS tokens FROM documents GROUP BY source), c AS (SELECT *, (sum(tokens) OVER (ORDER BY source) - tokens)::BIGINT AS tokens_before FROM s) SELECT * FROM c WHERE tokens_before < {SHARD_TARGET}""",
    "scan_cap": f"SELECT lang, doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS place FROM documents QUALIFY place < {SCAN_CAP}",
    "exact_heldout": f"SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_KEY}) <= {HELD_PER_LANG}",
    "pool_met": f"""
WITH c AS (SELECT lang, strlen(text) AS n, sum(strlen(text)) OVER (PARTITION BY lang ORDER BY {_KEY}) - strlen(text) AS before FROM documents) SELECT lang, sum(n)::BIGINT AS tokens FROM c WHERE before < {POOL_TARGET} GROUP BY lang""",
    "sources_in_order": f"SELECT lang AS pool, doc_id, row_number() OVER (ORDER BY list_position({list(LANGS)}, lang), doc_id) - 1 AS place FROM documents WHERE lang IN {LANGS}",
    "assembled_manifest": f"WITH {_H} SELECT lang, count(*) AS documents, sum(strlen(text))::BIGINT AS bytes, (count(*) - count(DISTINCT d))::BIGINT AS copies, count(*) FILTER (held) AS heldout FROM h GROUP BY lang",
    "rows_by_bucket": f"""
WITH r AS (SELECT lang, {NUMBER} % 100 % 10 AS bucket, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang, bucket ORDER BY doc_id) <= 25)
SELECT lang, bucket, string_agg(doc_id, ',' ORDER BY doc_id) AS documents FROM r GROUP BY lang, bucket""",
    "review_terms": f"""
SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{TERMS}')))[1:5], ' ') AS terms, substr(text, 1, 400) AS preview FROM documents WHERE regexp_matches(text, '{TERMS}')""",
    "sql_totals": SQL_TOTALS,
}
