"""Instruction data: conversations paired into turns, filtered by an ordered cascade, decontaminated and split."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.functions import text as t
from tessera.operators import ngrams
from tessera.sources.tables import table

MIN_OUTPUT = 8
#: Dealt to pairs by conversation, in the place of a licence and a rating column.
LICENCES = ("cc-by-4.0", "mit", "cc-by-nc-4.0", "Apache-2.0")
MIN_RATING = 3


def pairs(spark, sf_dir):
    """A user's turn and the assistant's turn right after it; the system's text of the conversation is the input."""
    turns = table(spark, sf_dir, "conversations")
    by = Window.partitionBy("conv_id").orderBy("turn")
    marked = turns.select("conv_id", "turn", "role", "text", F.lead("role").over(by).alias("next_role"), F.lead("text").over(by).alias("output"))
    users = marked.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("instruction"), "output")
    licence = F.element_at(F.array(*[F.lit(x) for x in LICENCES]), (F.col("conv_id") % len(LICENCES) + 1).cast("int"))
    return users.withColumns({"licence": licence, "rating": F.when(F.col("conv_id") % 7 != 6, F.col("conv_id") % 7)})


def fates(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    text = t.render_turns(F.col("instruction"), F.col("output"))
    rows = rows.withColumns({"text": text, "doc_sha256": t.doc_hash(text), "place": F.struct("conv_id", "turn")})
    before = [
        ("dropped_licence", ~t.instruction_licence_allowed(F.col("licence"))),
        ("dropped_rating", F.col("rating").isNull() | (F.col("rating") < MIN_RATING)),
        ("dropped_empty", (F.coalesce(F.trim("instruction"), F.lit("")) == "") | (F.length(F.coalesce("output", F.lit(""))) < MIN_OUTPUT)),
    ]
    rows = rules.mark_repeats(rows.withColumn("early", rules.first_rule(before)), "doc_sha256", "place", F.col("early").isNull(), "again")
    index = ngrams.gram_index(table(spark, sf_dir, "benchmark"), F.col("text"), F.lit("all"))
    hits = ngrams.window_hits(rows, index, "place", F.col("text"), stride=1, cap=None)
    rows = rows.join(hits, "place")
    late = [("dropped_dup", F.col("again")), ("dropped_decon", F.col("hits") >= 1), ("kept_heldout", t.is_heldout(F.col("doc_sha256")))]
    return rows.withColumn("fate", F.coalesce("early", rules.first_rule(late), F.lit("kept_train")))


def sft_fate(spark, sf_dir):
    return fates(spark, sf_dir).select("conv_id", "turn", "doc_sha256", "fate")


def sft_licences(spark, sf_dir):
    return pairs(spark, sf_dir).groupBy("licence").agg(F.count("*").alias("rows"))


QUERIES = {f.__name__: f for f in (sft_fate, sft_licences)}

_PAIRS = f"""
p AS (SELECT conv_id, turn, text AS instruction, output, ({list(LICENCES)})[conv_id % {len(LICENCES)} + 1] AS licence, CASE WHEN conv_id % 7 <> 6 THEN conv_id % 7 END AS rating FROM (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS output FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')"""
ORACLE = {
    "sft_licences": f"WITH {_PAIRS} SELECT licence, count(*) AS rows FROM p GROUP BY licence",
    "sft_fate": f"""
WITH {_PAIRS},
r AS (SELECT *, concat_ws(chr(10) || chr(10), nullif(trim(instruction), ''), nullif(trim(output), '')) AS text FROM p),
h AS (SELECT *, sha256(trim(regexp_replace(nfc_normalize(text), '[{t.SQL_WS}]+', ' ', 'g'))) AS doc_sha256, CASE WHEN licence = 'cc-by-nc-4.0' THEN 'dropped_licence'
  WHEN rating IS NULL OR rating < {MIN_RATING} THEN 'dropped_rating' WHEN trim(instruction) = '' OR length(output) < {MIN_OUTPUT} THEN 'dropped_empty' END AS early FROM r),
f AS (SELECT *, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS s, row_number() OVER (PARTITION BY early IS NULL, doc_sha256 ORDER BY conv_id, turn) AS n FROM h),
items AS (SELECT DISTINCT unnest(list_transform(range(0, length(f) - 63), lambda i: substr(f, i + 1, 64))) AS g FROM (SELECT trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS f FROM benchmark)),
w AS (SELECT DISTINCT conv_id, turn FROM (SELECT conv_id, turn, unnest(list_transform(range(0, length(s) - 63), lambda i: substr(s, i + 1, 64))) AS g FROM f) WHERE g IN (SELECT g FROM items))
SELECT f.conv_id, f.turn, doc_sha256, coalesce(early, CASE WHEN n > 1 THEN 'dropped_dup' WHEN w.conv_id IS NOT NULL THEN 'dropped_decon' WHEN ('0x' || substr(doc_sha256, 1, 8))::BIGINT % 100 = 0 THEN 'kept_heldout' END, 'kept_train') AS fate
FROM f LEFT JOIN w ON f.conv_id = w.conv_id AND f.turn = w.turn""",
}
