"""Queries of scalar text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as t
from tessera.operators import audit
from tessera.sources.tables import table

NORM = f"trim(regexp_replace(nfc_normalize(text), '[{t.SQL_WS}]+', ' ', 'g'))"
HASH = f"sha256({NORM})"
NUMBER = f"('0x' || substr({HASH}, 1, 8))::BIGINT"
RATE = 4


def hashed(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("doc_sha256", t.doc_hash(F.col("text")))


def normalise_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.normalise(F.col("text")).alias("normalised"))


def doc_hash(spark, sf_dir):
    return hashed(spark, sf_dir).select("doc_id", "doc_sha256")


def heldout_split(spark, sf_dir):
    digest = F.col("doc_sha256")
    return hashed(spark, sf_dir).select("doc_id", t.bucket(digest).alias("bucket"), t.is_heldout(digest).alias("heldout"))


def doc_lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"))


def script_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.script_ratio(F.col("text"), "A-z").alias("ratio"))


def hash_sample(spark, sf_dir):
    return hashed(spark, sf_dir).where(t.in_sample(F.col("doc_sha256"), RATE)).select("doc_id", "doc_sha256")


def set_fingerprint(spark, sf_dir):
    return audit.tree_fingerprint(hashed(spark, sf_dir), "doc_sha256", ["lang"])


def heldout_fingerprint(spark, sf_dir):
    return audit.streamed_fingerprint(hashed(spark, sf_dir).where(t.is_heldout(F.col("doc_sha256"))), "doc_sha256", ["lang"])


def top_domains(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(t.url_host(F.col("url")).alias("domain"), "page_id")
    counts = pages.groupBy("domain").agg(F.count("*").alias("pages"), F.min("page_id").alias("first"))
    return counts.orderBy(F.desc("pages"), "first").limit(20).select("domain", "pages")


def code_group(spark, sf_dir):
    names = ["Python", "JavaScript", "TypeScript", "Java", "C", "C++", "cpp", "C#", "c sharp", "cs", "Markdown", "HTML", "CSS", "Dockerfile", "YAML", "Go", "Rust", "J_S-O.N", "", None]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "place int, language string")
    return frame.select("place", t.code_group(F.col("language")).alias("code_group"))


LICENCES = ["MIT", " mit ", "Apache-2.0", "apache_2.0", "cc-by-nc-4.0", "CC-BY-4.0", "cc0-1.0", "gpl-3.0", "bsd-3-clause", "", None]


def licences(spark, sf_dir):
    frame = spark.createDataFrame(list(enumerate(LICENCES)), "place int, licence string")
    key = t.licence_key(F.col("licence"))
    return frame.select("place", key.alias("licence_key"), key.isin(*t.CODE_LICENCES).alias("code_ok"), t.instruction_licence_allowed(F.col("licence")).alias("instruction_ok"))


NUMBERS = ["4111 1111 1111 1111", "4111111111111112", "0000000000000000", "378282246310005", "30569309025904", "1234", "5555-5555-5555-4444", "1101700230705", "x"]


def luhn_valid(spark, sf_dir):
    frame = spark.createDataFrame(list(enumerate(NUMBERS)), "place int, value string")
    return frame.select("place", t.luhn_valid(F.col("value")).alias("card"), t.thai_id_valid(F.col("value")).alias("thai_id"))


ANSWERS = [(["1. a", "2. b", "3. c"], "2"), (["3) x", "1) y"], "1"), (["a", "b"], "2"), (["a", "b"], "5"), (["a", "b"], "x"), (["a", ""], "1"), ([], "1"), (["a", "b"], None)]


def answer_index(spark, sf_dir):
    frame = spark.createDataFrame([(i, o, a) for i, (o, a) in enumerate(ANSWERS)], "place int, options array<string>, answer string")
    keys = F.array(*[F.lit(str(k)) for k in range(1, 6)])
    return frame.select("place", t.answer_index(F.col("options"), F.col("answer")).alias("target"), F.coalesce(t.complete_options(F.col("options"), F.col("answer"), keys), F.lit(False)).alias("complete"))


def fertility_by_lang(spark, sf_dir):
    words = F.regexp_count("text", F.lit(f"[^{t.WS}]+")).cast("long")
    rows = table(spark, sf_dir, "documents").select("lang", F.octet_length("text").alias("b"), F.length("text").alias("c"), words.alias("w"))
    n = F.sum("w")
    return rows.groupBy("lang").agg(F.round(F.sum("b") / n, 6).alias("bytes_per_token"), F.round(F.sum("c") / n, 6).alias("chars_per_token"), F.round(n / F.count("*"), 6).alias("tokens_per_doc"))


def _values(rows):
    quote = lambda v: "NULL" if v is None else f"'{v}'"
    return "(VALUES " + ", ".join(f"({i}, {quote(v)})" for i, v in enumerate(rows)) + ")"


_CODE = " ".join("WHEN regexp_replace(lower(trim(coalesce(language, ''))), '[\\s_.#-]+', '', 'g') IN (" + ", ".join(f"'{n}'" for n in names) + f") THEN '{g}'" for g, names in t.CODE_GROUPS.items())
_CODE_NAMES = ["Python", "JavaScript", "TypeScript", "Java", "C", "C++", "cpp", "C#", "c sharp", "cs", "Markdown", "HTML", "CSS", "Dockerfile", "YAML", "Go", "Rust", "J_S-O.N", "", None]
_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_D = "list_transform(string_split(d, ''), lambda c: TRY_CAST(c AS INTEGER))"

QUERIES = {
    f.__name__: f
    for f in (normalise_text, doc_hash, heldout_split, doc_lengths, script_ratio, hash_sample, set_fingerprint, heldout_fingerprint, top_domains, code_group, licences, luhn_valid, answer_index, fertility_by_lang)
}
ORACLE = {
    "normalise_text": f"SELECT doc_id, {NORM} AS normalised FROM documents",
    "doc_hash": f"SELECT doc_id, {HASH} AS doc_sha256 FROM documents",
    "heldout_split": f"SELECT doc_id, {NUMBER} % 100 AS bucket, {NUMBER} % 100 = 0 AS heldout FROM documents",
    "doc_lengths": "SELECT doc_id, length(text)::INTEGER AS chars, strlen(text)::INTEGER AS bytes FROM documents",
    "script_ratio": "SELECT doc_id, CASE WHEN length(text) = 0 THEN 0 ELSE length(regexp_replace(text, '[^A-z]', '', 'g'))::DOUBLE / length(text) END AS ratio FROM documents",
    "hash_sample": f"SELECT doc_id, {HASH} AS doc_sha256 FROM documents WHERE {NUMBER} % {RATE} = 0",
    "set_fingerprint": f"""
WITH h AS (SELECT lang, {HASH} AS d FROM documents), lines AS (SELECT lang, d, count(*) AS n FROM h GROUP BY lang, d),
leaves AS (SELECT lang, substr(d, 1, {audit.PREFIX}) AS p, sum(n) AS n, sha256(string_agg(d || ':' || n, chr(10) ORDER BY d || ':' || n)) AS h FROM lines GROUP BY lang, substr(d, 1, {audit.PREFIX}))
SELECT lang, sum(n)::BIGINT AS documents, sha256(string_agg(p || ':' || h, chr(10) ORDER BY p || ':' || h)) AS fingerprint FROM leaves GROUP BY lang""",
    "heldout_fingerprint": f"""
WITH h AS (SELECT lang, {HASH} AS d FROM documents WHERE {NUMBER} % 100 = 0)
SELECT lang, count(*) AS documents, sha256(string_agg(d, '' ORDER BY d)) AS fingerprint FROM h GROUP BY lang""",
    "top_domains": """
WITH d AS (SELECT regexp_replace(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), '^[w.]+', '') AS domain, page_id FROM pages)
SELECT domain, pages FROM (SELECT domain, count(*) AS pages, min(page_id) AS first FROM d GROUP BY domain ORDER BY pages DESC, first LIMIT 20)""",
    "code_group": f"SELECT place, CASE WHEN lower(trim(language)) IN ('c#', 'c sharp', 'c-sharp') THEN 'csharp' {_CODE} ELSE 'long_tail' END AS code_group FROM {_values(_CODE_NAMES)} AS v(place, language)",
    "licences": f"""
WITH v AS (SELECT place, replace(lower(trim(coalesce(licence, ''))), '_', '-') AS licence_key, lower(trim(coalesce(licence, ''))) AS k FROM {_values(LICENCES)} AS v(place, licence))
SELECT place, licence_key, licence_key IN ('mit', 'apache-2.0', 'bsd-2-clause', 'bsd-3-clause') AS code_ok,
  k NOT LIKE '%nc%' AND k NOT LIKE '%non-commercial%' AND k IN ('cc-by-sa-4.0', 'cc-by-4.0', 'apache-2.0', 'mit', 'cc0-1.0') AS instruction_ok FROM v""",
    "luhn_valid": f"""
WITH v AS (SELECT place, value, {_DIGITS} AS d FROM {_values(NUMBERS)} AS v(place, value)),
l AS (SELECT place, value, d, CASE WHEN length(d) BETWEEN 13 AND 19 THEN list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN ({_D})[length(d) - i]
  WHEN 2 * ({_D})[length(d) - i] > 9 THEN 2 * ({_D})[length(d) - i] - 9 ELSE 2 * ({_D})[length(d) - i] END)) % 10 = 0 AND len(list_distinct(string_split(d, ''))) > 1 ELSE false END AS card FROM v)
SELECT place, card, CASE WHEN regexp_full_match(value, '[1-9][0-9]{{12}}') THEN (11 - list_sum(list_transform(range(12), lambda i: ({_D})[i + 1] * (13 - i))) % 11) % 10 = ({_D})[13] ELSE false END AS thai_id FROM l""",
    "answer_index": """
SELECT * FROM (VALUES (0, 1, true), (1, 1, true), (2, 1, true), (3, -1, true), (4, -1, false), (5, 0, false), (6, -1, true), (7, -1, false)) AS v(place, target, complete)""",
    "fertility_by_lang": f"""
WITH r AS (SELECT lang, strlen(text) AS b, length(text) AS c, len(regexp_extract_all(text, '[^{t.SQL_WS}]+')) AS w FROM documents)
SELECT lang, round(sum(b)::DOUBLE / sum(w), 6) AS bytes_per_token, round(sum(c)::DOUBLE / sum(w), 6) AS chars_per_token, round(sum(w)::DOUBLE / count(*), 6) AS tokens_per_doc FROM r GROUP BY lang""",
}
