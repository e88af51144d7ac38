"""Queries of n-grams, decontamination, near duplicates and removal."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tessera.functions import text as t
from tessera.operators import dedup, ngrams
from tessera.plans.text_plans import HASH, NUMBER, hashed
from tessera.sources.shared import stored
from tessera.sources.tables import table

GROUPS = 4
SIZES, STRIDES, THRESHOLDS = (32, 50, 64), (1, 8), (1, 2, 5, 10, 20, 50)


def _name():
    return F.concat(F.lit("bench"), (F.col("item_id") % GROUPS).cast("string"))


def _index(spark, sf_dir):
    """The benchmark's index, written as a table and read from it."""
    return stored(ngrams.gram_index(table(spark, sf_dir, "benchmark"), F.col("text"), _name()), "gram-index")


def _hits(spark, sf_dir, index):
    docs = table(spark, sf_dir, "documents")
    return ngrams.window_hits(docs, index, "doc_id", F.col("text"), cap=None).where(F.col("hits") >= ngrams.MIN_HITS)


def char_ngrams(spark, sf_dir):
    grams = ngrams.hashes(F.col("text"), cap=None)
    return table(spark, sf_dir, "documents").select("doc_id", grams.alias("g")).select("doc_id", F.size("g").alias("windows"), F.size(F.array_distinct("g")).alias("different"))


def benchmark_index(spark, sf_dir):
    return ngrams.index_summary(table(spark, sf_dir, "benchmark"), F.col("text"), _name())


def decon_hits(spark, sf_dir):
    return _hits(spark, sf_dir, _index(spark, sf_dir))


def decon_attribution(spark, sf_dir):
    """Of each flagged document the benchmark with the most windows (of equals the first by name), and all its windows."""
    index = _index(spark, sf_dir)
    flagged = table(spark, sf_dir, "documents").join(_hits(spark, sf_dir, index).select("doc_id"), "doc_id", "left_semi")
    by = ngrams.attribution(flagged, index, "doc_id", F.col("text"), cap=None)
    best = F.min_by("benchmark", F.struct(-F.col("hits"), F.col("benchmark")))
    return by.groupBy("doc_id").agg(best.alias("benchmark"), F.max("hits").alias("hits"), F.sum("hits").alias("all_hits"))


def flagged_texts(spark, sf_dir):
    """Flagged hashes back to their documents, with the hit columns: language, hash, hits and the text's first 200 characters."""
    index = _index(spark, sf_dir)
    docs = hashed(spark, sf_dir)
    hits = stored(docs.select("doc_sha256", "doc_id").join(_hits(spark, sf_dir, index), "doc_id").select("doc_sha256", "hits").distinct(), "hit-list")
    return docs.join(hits, "doc_sha256").select("doc_id", "lang", "doc_sha256", "hits", F.substring("text", 1, 200).alias("preview"))


def decon_by_language(spark, sf_dir):
    """Flagged documents and their windows by language, and each language's share of them."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(_hits(spark, sf_dir, _index(spark, sf_dir)), "doc_id")
    sums = rows.groupBy("lang").agg(F.count("*").alias("documents"), F.sum("hits").alias("hits"))
    total = sums.agg(F.sum("documents").alias("all"))
    return sums.crossJoin(F.broadcast(total)).select("lang", "documents", "hits", F.round(F.col("documents") / F.col("all"), 6).alias("share"))


def decon_sensitivity(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return ngrams.sensitivity(docs, items, "doc_id", F.col("text"), F.col("text"), SIZES, STRIDES, THRESHOLDS, cap=None)


def _facts(spark, sf_dir, with_hits: bool):
    """(doc_id, lang, bytes, doc_sha256, hits, signature) of every document, from one pass over its text, as a table."""
    count = ngrams.hit_counter(_index(spark, sf_dir)) if with_hits else None
    docs = table(spark, sf_dir, "documents")

    @F.pandas_udf("doc_sha256 string, hits long, signature array<long>")
    def facts(texts: pd.Series) -> pd.DataFrame:
        forms = map(t.search_text, texts)
        rows = [(t.digest_of(x), count(form) if count else 0, dedup.signature_of(form or "")) for x, form in zip(texts, forms, strict=True)]
        return pd.DataFrame(rows, columns=["doc_sha256", "hits", "signature"])

    made = docs.select("doc_id", "lang", F.octet_length("text").cast("long").alias("bytes"), facts.asNondeterministic()(F.col("text")).alias("f"))
    rows = stored(made.select("doc_id", "lang", "bytes", "f.*"), "facts")
    if with_hits and count is None:
        # An index too large to send: its hits come from a join.
        rows = rows.drop("hits").join(ngrams.window_hits(docs, _index(spark, sf_dir), "doc_id", F.col("text"), cap=None), "doc_id")
    return rows


def _near(facts):
    return dedup.shared_bands(dedup.exact_survivors(facts.select("doc_id", "doc_sha256", "signature"), "doc_sha256", "doc_id"), "doc_id")


def near_dup(spark, sf_dir):
    return _near(_facts(spark, sf_dir, False))


def _removal(facts):
    near = facts.join(_near(facts).select("doc_id"), "doc_id", "left_semi").select("doc_sha256")
    return facts.where(F.col("hits") >= ngrams.MIN_HITS).select("doc_sha256").union(near).distinct()


def removal_list(spark, sf_dir):
    return _removal(_facts(spark, sf_dir, True))


def apply_removal(spark, sf_dir):
    facts = _facts(spark, sf_dir, True)
    left = facts.join(_removal(facts), "doc_sha256", "left_anti").where(~t.is_heldout(F.col("doc_sha256")))
    return left.groupBy("lang").agg(F.count("*").alias("documents"), F.sum("bytes").alias("bytes"))


def removal_guards(spark, sf_dir):
    """What keeps a document from being tokenized: the removal list, then the held-out guard; counts of each and of the rest."""
    facts = _facts(spark, sf_dir, True)
    marked = facts.join(_removal(facts).withColumn("listed", F.lit(True)), "doc_sha256", "left")
    guard = F.when(F.col("listed"), "removal_list").when(t.is_heldout(F.col("doc_sha256")), "heldout_guard").otherwise("tokenized")
    return marked.groupBy(guard.alias("guard")).agg(F.count("*").alias("documents"), F.sum("bytes").alias("bytes"))


def heldout_leakage(spark, sf_dir):
    """Held-out texts that a corpus still holds: the documents of the first source are held out, the others are the corpus.

    What the held-out set is comes from its own rows, not from a hash, so a text that stands in both is found.
    """
    docs = hashed(spark, sf_dir).select("source", "doc_sha256")
    rows = stored(docs, "hashes")
    first = rows.agg(F.min("source").alias("first"))
    sides = rows.crossJoin(F.broadcast(first)).select("doc_sha256", (F.col("source") == F.col("first")).alias("held"))
    # One row a hash, combined before the shuffle: a text that both sides have many times is no hot key.
    both = sides.groupBy("doc_sha256").agg(F.count_if("held").alias("held"), F.count_if(~F.col("held")).alias("corpus"))
    return both.where("held > 0").agg(F.count("*").alias("heldout"), F.count_if(F.col("corpus") > 0).alias("leaked"), F.coalesce(F.sum("corpus"), F.lit(0)).alias("leaked_documents"))


QUERIES = {
    f.__name__: f
    for f in (char_ngrams, benchmark_index, decon_hits, decon_attribution, flagged_texts, decon_by_language, decon_sensitivity, near_dup, removal_list, apply_removal, removal_guards, heldout_leakage)
}

_N, _S = ngrams.N, ngrams.STRIDE
_DOC = _ITEM = "trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))"


def _grams(name, table_, columns, form, n, stride):
    return f"{name} AS (SELECT {columns}, unnest(list_transform(range(0, length(f) - {n} + 1, {stride}), lambda i: substr(f, i + 1, {n}))) AS g FROM (SELECT *, {form} AS f FROM {table_}) WHERE length(f) >= {n})"


_INDEX = _grams("items", "benchmark", "'bench' || (item_id % 4) AS benchmark", _ITEM, _N, 1)
_WINDOWS = _grams("windows", "documents", "doc_id", _DOC, _N, _S)
_HITS = f"{_INDEX}, {_WINDOWS}, hits AS (SELECT doc_id, count(*) AS hits FROM windows WHERE g IN (SELECT g FROM items) GROUP BY doc_id HAVING count(*) >= {ngrams.MIN_HITS})"
_ROWS = dedup.HASHES // dedup.BANDS
_MINS = ", ".join(f"min(({a}::BIGINT * h + {b}) % {dedup.PRIME}) AS m{i}" for i, (a, b) in enumerate(zip(dedup.A, dedup.B, strict=True)))
_KEYS = ", ".join(f"{{'band': {b}, 'key': [{', '.join(f'm{b * _ROWS + k}' for k in range(_ROWS))}]}}" for b in range(dedup.BANDS))


def _power(base: int, exponent: str) -> str:
    """base ** exponent modulo the prime, for exponents below 2 ** 24, as products of its squares."""
    out = "1::BIGINT"
    for bit in range(24):
        out = f"({out} * CASE WHEN {exponent} & {1 << bit} <> 0 THEN {pow(base, 1 << bit, dedup.PRIME)} ELSE 1 END % {dedup.PRIME})"
    return out


_NEAR = f"""
survivors AS (SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY {HASH} ORDER BY doc_id) = 1),
chars AS (SELECT doc_id, unnest(string_split(f, '')) AS ch, generate_subscripts(string_split(f, ''), 1) - 1 AS i FROM (SELECT doc_id, {_DOC} AS f FROM survivors) WHERE length(f) >= {_N}),
terms AS (SELECT doc_id, i, unicode(ch) * {_power(dedup.BASE, "i")} % {dedup.PRIME} AS term FROM chars),
sums AS (SELECT doc_id, i, sum(term) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {_N - 1} FOLLOWING) AS total, count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {_N - 1} FOLLOWING) AS n FROM terms),
sh AS (SELECT doc_id, (total % {dedup.PRIME})::BIGINT * {_power(pow(dedup.BASE, -1, dedup.PRIME), "i")} % {dedup.PRIME} AS h FROM sums WHERE n = {_N}),
sig AS (SELECT doc_id, {_MINS} FROM sh GROUP BY doc_id),
bands AS (SELECT doc_id, unnest([{_KEYS}]) AS k FROM sig),
firsts AS (SELECT doc_id, k.band AS band, min(doc_id) OVER (PARTITION BY k) AS first FROM bands),
near AS (SELECT doc_id, min_by(first, band) AS duplicate_of FROM firsts WHERE first < doc_id GROUP BY doc_id)"""
_REMOVAL = f"{_HITS}, {_NEAR}, removal AS (SELECT DISTINCT {HASH} AS doc_sha256 FROM documents WHERE doc_id IN (SELECT doc_id FROM hits UNION SELECT doc_id FROM near))"


def _sensitivity():
    parts = []
    for n in SIZES:
        for s in STRIDES:
            counts = ", ".join(f"count(*) FILTER (hits >= {k}) AS at_least_{k}" for k in THRESHOLDS)
            parts.append(
                f"SELECT {n}::INTEGER AS gram, {s}::INTEGER AS stride, count(*) AS docs, {counts} FROM (WITH {_grams('i', 'benchmark', '1 AS one', _ITEM, n, 1)}, {_grams('w', 'documents', 'doc_id', _DOC, n, s)}, "
                "h AS (SELECT doc_id, count(*) AS hits FROM w WHERE g IN (SELECT g FROM i) GROUP BY doc_id) SELECT coalesce(hits, 0) AS hits FROM documents LEFT JOIN h USING (doc_id))"
            )
    return " UNION ALL ".join(parts)


ORACLE = {
    "char_ngrams": f"WITH {_WINDOWS} SELECT doc_id, count(g)::INTEGER AS windows, count(DISTINCT g)::INTEGER AS different FROM documents LEFT JOIN windows USING (doc_id) GROUP BY doc_id",
    "benchmark_index": f"""
WITH {_INDEX}, long AS (SELECT 'bench' || (item_id % 4) AS benchmark, count(*) FILTER (length({_ITEM}) >= {_N}) AS items FROM benchmark GROUP BY 1)
SELECT benchmark, items, count(DISTINCT g) AS grams FROM long LEFT JOIN items USING (benchmark) GROUP BY ALL
UNION ALL SELECT 'all', (SELECT sum(items) FROM long)::BIGINT, count(DISTINCT g) FROM items""",
    "decon_hits": f"WITH {_HITS} SELECT doc_id, hits FROM hits",
    "decon_attribution": f"""
WITH {_HITS}, {_grams("every", "documents", "doc_id", _DOC, _N, 1)}, uniq AS (SELECT DISTINCT benchmark, g FROM items),
by_ AS (SELECT doc_id, benchmark, count(*) AS n FROM every JOIN uniq USING (g) WHERE doc_id IN (SELECT doc_id FROM hits) GROUP BY ALL)
SELECT doc_id, first(benchmark ORDER BY n DESC, benchmark) AS benchmark, max(n) AS hits, sum(n)::BIGINT AS all_hits FROM by_ GROUP BY doc_id""",
    "decon_sensitivity": _sensitivity(),
    "near_dup": f"WITH {_NEAR} SELECT doc_id, duplicate_of FROM near",
    "removal_list": f"WITH {_REMOVAL} SELECT doc_sha256 FROM removal",
    "apply_removal": f"WITH {_REMOVAL} SELECT lang, count(*) AS documents, sum(strlen(text))::BIGINT AS bytes FROM documents WHERE {HASH} NOT IN (SELECT doc_sha256 FROM removal) AND {NUMBER} % 100 <> 0 GROUP BY lang",
    "flagged_texts": f"""
WITH {_HITS}, h AS (SELECT DISTINCT {HASH} AS doc_sha256, hits FROM documents JOIN hits USING (doc_id)), d AS (SELECT doc_id, lang, {HASH} AS doc_sha256, substr(text, 1, 200) AS preview FROM documents)
SELECT doc_id, lang, doc_sha256, hits, preview FROM d JOIN h USING (doc_sha256)""",
    "decon_by_language": f"""
WITH {_HITS} SELECT lang, count(*) AS documents, sum(hits)::BIGINT AS hits, round(count(*)::DOUBLE / (SELECT count(*) FROM hits), 6) AS share FROM hits JOIN documents USING (doc_id) GROUP BY lang""",
    "removal_guards": f"""
WITH {_REMOVAL}, g AS (SELECT strlen(text) AS b, CASE WHEN {HASH} IN (SELECT doc_sha256 FROM removal) THEN 'removal_list' WHEN {NUMBER} % 100 = 0 THEN 'heldout_guard' ELSE 'tokenized' END AS guard FROM documents)
SELECT guard, count(*) AS documents, sum(b)::BIGINT AS bytes FROM g GROUP BY guard""",
    "heldout_leakage": f"""
WITH d AS (SELECT {HASH} AS h, source = (SELECT min(source) FROM documents) AS held FROM documents), s AS (SELECT DISTINCT h FROM d WHERE held), c AS (SELECT h, count(*) AS n FROM d WHERE NOT held GROUP BY h)
SELECT count(*) AS heldout, count(c.n) AS leaked, coalesce(sum(c.n), 0)::BIGINT AS leaked_documents FROM s LEFT JOIN c USING (h)""",
}
