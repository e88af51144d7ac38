"""Queries of held-out sets, review samples, stream addressing and comparisons between runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.functions import text as t
from tessera.operators import budget
from tessera.operators.prefix import least_per_key, running_sum
from tessera.plans.budget_plans import SEED, _shuffled
from tessera.plans.clean_plans import _CASCADE, cascade
from tessera.plans.text_plans import HASH, NUMBER, hashed
from tessera.sources.tables import table

HELD = tuple(range(10))
FIRST = 4
STEPS, WORLD, BATCH = 3, 2, 8
SMOKE_SEQ, SMOKE_N = 512, 7
#: Fixed value: bytes a token in the published pools.
BYTES_PER_TOKEN = 5.0468


def heldout_build(spark, sf_dir):
    """The inverse cascade: rows must be in a held-out bucket, then long, short, in script, and first of their text."""
    docs = hashed(spark, sf_dir)
    before = [
        ("not_heldout", ~t.is_heldout(F.col("doc_sha256"), HELD)),
        ("too_short", F.length("text") < 200),
        ("too_long", F.length("text") > 20_000),
        ("wrong_script", t.script_ratio(F.col("text"), "A-z") < 0.7),
    ]
    docs = docs.select("doc_id", "doc_sha256", rules.first_rule(before).alias("early"))
    docs = rules.mark_repeats(docs, "doc_sha256", "doc_id", F.col("early").isNull(), "again")
    return docs.select("doc_id", F.coalesce("early", F.when(F.col("again"), "duplicate"), F.lit("selected")).alias("fate"))


def first_per_rule(spark, sf_dir):
    """The first documents that each rule drops, in scan order, for reading."""
    rows = cascade(spark, sf_dir).where("drop_reason is not null")
    return least_per_key(rows, ["drop_reason"], FIRST, [F.col("doc_id")]).select("drop_reason", "doc_id")


def batch_addresses(spark, sf_dir):
    """Which document of the shuffled order each rank reads at each step, around the end and on."""
    order = running_sum(_shuffled(spark, sf_dir).withColumn("one", F.lit(1)), "one", ["key"], "place").select("place", "doc_id")
    n = order.count()
    slots = [(s, r, i, ((s * WORLD + r) * BATCH + i + n - 20) % n) for s in range(STEPS) for r in range(WORLD) for i in range(BATCH)]
    return spark.createDataFrame(slots, "step int, rank int, slot int, place long").join(order, "place").select("step", "rank", "slot", "doc_id")


def smoke_stream(spark, sf_dir):
    """The first sequences of a short stream, cut without regard to documents."""
    parts = budget.packed(_shuffled(spark, sf_dir), "tokens", ["key"], SMOKE_SEQ).where(F.col("seq_id") < SMOKE_N)
    return parts.select("seq_id", "start_in_seq", "n", "doc_id")


def pool_estimate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(F.octet_length("text")).cast("long").alias("bytes"))
    return rows.select("lang", "bytes", F.floor(F.col("bytes") / F.lit(BYTES_PER_TOKEN)).alias("tokens"))


def baseline_ratio(spark, sf_dir):
    """Each condition's mean as a share of the baseline's, the first by name."""
    means = table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg("value").alias("mean"))
    base = means.orderBy("event_type").limit(1).select(F.lit(1).alias("one"), F.col("mean").alias("base"))
    return means.withColumn("one", F.lit(1)).join(F.broadcast(base), "one").select("event_type", F.round(F.col("mean") / F.col("base"), 6).alias("ratio"))


TASKS, HARNESS = ["thaiexam", "m3exam", "mmlu", "unknown"], [("thaiexam", "thaiexam_all"), ("m3exam", "m3exam_th"), ("mmlu", "mmlu")]


def task_map(spark, sf_dir):
    """Every task and its name in the harness; those without one are told."""
    tasks = spark.createDataFrame([(x,) for x in TASKS], "task string")
    names = spark.createDataFrame(HARNESS, "task string, harness string")
    return tasks.join(F.broadcast(names), "task", "left").select("task", F.coalesce("harness", F.lit("UNMAPPED")).alias("harness"))


def merged_counters(spark, sf_dir):
    """Counters kept as a map by source, merged to one total for each key."""
    cells = cascade(spark, sf_dir).groupBy("source", F.coalesce("drop_reason", F.lit("kept")).alias("k")).agg(F.count("*").alias("n"))
    maps = cells.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("counters"))
    return maps.select(F.explode("counters").alias("counter", "n")).groupBy("counter").agg(F.sum("n").alias("n"))


QUERIES = {f.__name__: f for f in (heldout_build, first_per_rule, batch_addresses, smoke_stream, pool_estimate, baseline_ratio, task_map, merged_counters)}

_T = "t AS (SELECT doc_id, lang, source, strlen(text)::BIGINT AS tokens FROM documents)"
_K = f"k AS (SELECT *, sha256('{SEED}:' || doc_id) AS key FROM t)"
ORACLE = {
    "heldout_build": f"""
WITH early AS (SELECT doc_id, {HASH} AS h, CASE WHEN {NUMBER} % 100 > 9 THEN 'not_heldout' WHEN length(text) < 200 THEN 'too_short' WHEN length(text) > 20000 THEN 'too_long'
  WHEN length(regexp_replace(text, '[^A-z]', '', 'g'))::DOUBLE / length(text) < 0.7::DOUBLE THEN 'wrong_script' END AS early FROM documents)
SELECT doc_id, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY early IS NULL, h ORDER BY doc_id) > 1 THEN 'duplicate' END, 'selected') AS fate FROM early""",
    "first_per_rule": f"WITH {_CASCADE} SELECT drop_reason, doc_id FROM cascade WHERE drop_reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY drop_reason ORDER BY doc_id) <= {FIRST}",
    "batch_addresses": f"""
WITH {_T}, {_K}, o AS (SELECT row_number() OVER (ORDER BY key) - 1 AS place, doc_id, count(*) OVER () AS n FROM k),
s AS (SELECT s::INTEGER AS step, r::INTEGER AS rank, i::INTEGER AS slot FROM range({STEPS}) a(s), range({WORLD}) b(r), range({BATCH}) c(i))
SELECT step, rank, slot, doc_id FROM s JOIN o ON place = ((step * {WORLD} + rank) * {BATCH} + slot + n - 20) % n""",
    "smoke_stream": f"""
WITH {_T}, {_K}, p AS (SELECT doc_id, tokens, (sum(tokens) OVER (ORDER BY key) - tokens)::BIGINT AS s FROM k), e AS (SELECT *, unnest(range(s // {SMOKE_SEQ}, (s + tokens - 1) // {SMOKE_SEQ} + 1)) AS seq_id FROM p WHERE tokens > 0)
SELECT seq_id, greatest(s, seq_id * {SMOKE_SEQ}) - seq_id * {SMOKE_SEQ} AS start_in_seq, least(s + tokens, (seq_id + 1) * {SMOKE_SEQ}) - greatest(s, seq_id * {SMOKE_SEQ}) AS n, doc_id FROM e WHERE seq_id < {SMOKE_N}""",
    "pool_estimate": f"SELECT lang, sum(strlen(text))::BIGINT AS bytes, floor(sum(strlen(text))::DOUBLE / {BYTES_PER_TOKEN}::DOUBLE)::BIGINT AS tokens FROM documents GROUP BY lang",
    "baseline_ratio": "WITH m AS (SELECT event_type, avg(value) AS mean FROM events GROUP BY event_type) SELECT event_type, round(mean / (SELECT mean FROM m ORDER BY event_type LIMIT 1), 6) AS ratio FROM m",
    "task_map": f"SELECT task, coalesce(harness, 'UNMAPPED') AS harness FROM (VALUES {', '.join(f'({x!r})' for x in TASKS)}) AS t(task) LEFT JOIN (VALUES {', '.join(map(str, HARNESS))}) AS h(task, harness) USING (task)",
    "merged_counters": f"WITH {_CASCADE} SELECT coalesce(drop_reason, 'kept') AS counter, count(*) AS n FROM cascade GROUP BY 1",
}
