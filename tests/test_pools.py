import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.functions import text as t
from tessera.functions import tokens as tk
from tessera.operators import audit, budget, ngrams
from tessera.operators.prefix import running_sum
from tessera.sources import shared, sinks, tables
from tessera.streaming.incremental import until_target


def test_targets():
    assert budget.parse_targets(["math=123", "en=5"]) == {"math": 123, "en": 5}
    for bad in ("code=0", "code", "=5", "code=-1", "code=x", "code="):
        with pytest.raises(ValueError):
            budget.parse_targets([bad])
    with pytest.raises(ValueError):
        budget.parse_targets(["a=1", "a=2"])


def test_shard_orders():
    assert budget.stratified_order(14, 5)[:5] == [0, 3, 6, 10, 13]
    for n in range(12):
        for anchors in range(5):
            assert sorted(budget.stratified_order(n, anchors)) == list(range(n))
    assert budget.spread_sample([f"f{i:02d}" for i in range(20)], 6) == ["f00", "f03", "f06", "f09", "f12", "f15"]
    assert budget.spread_sample(["b", "a"], 6) == ["a", "b"]


def test_running_out_and_exact_counts_are_errors(spark):
    df = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1)], "g string, n long")
    targets = spark.createDataFrame([("a", 12)], "g string, target long")
    assert budget.require_met(df, "n", targets, "g").count() == 3
    with pytest.raises(ValueError, match="b lacks 4"):
        budget.require_met(df, "n", spark.createDataFrame([("a", 1), ("b", 5)], "g string, target long"), "g")
    assert budget.require_count(df, 3) is df
    with pytest.raises(ValueError):
        budget.require_count(df, 4)


def test_running_sums_do_not_hang_on_how_ranges_are_drawn(spark):
    df = spark.range(30_000).select((F.col("id") * 7919 % 30_000).alias("k"), F.lit("x" * 50).alias("wide"), F.lit(1).alias("one"))
    for parts in (3, 7):
        got = running_sum(df, "one", ["k"], "place", parts=parts)
        assert got.where("place <> k").count() == 0 and got.count() == 30_000


def test_tokenizers_plug_in(spark):
    class Halves:
        def __call__(self, texts):
            return [[len(x) // 2, len(x) - len(x) // 2] if x else [] for x in texts]

    df = spark.createDataFrame([(1, "añ b"), (2, None), (3, "")], "i int, s string")
    got = df.select("i", *[tk.token_counts(F.col("s"), n).alias(n) for n in tk.NATIVE], tk.token_counts(F.col("s"), Halves).alias("own"), tk.token_ids(F.col("s"), Halves, 9).alias("ids")).orderBy("i").collect()
    assert [tuple(r) for r in got] == [(1, 5, 4, 2, 2, [2, 2, 9]), (2, None, None, None, None, None), (3, 0, 0, 0, 0, [9])]


def test_byte_level_vocabularies():
    assert tk.byte_level_surface("Ġthe") == " the" and tk.byte_level_surface("à¸ģ") == "ก" and tk.byte_level_surface("à¸") is None and tk.byte_level_surface("日") is None
    assert tk.vocabulary_counts(["a", "à¸ģ", "à¸"], "฀", "๿") == (3, 2, 1)


def test_small_functions(spark):
    df = spark.createDataFrame([(" BSD_3 ", "b2 a1 b2 c3")], "l string, s string")
    row = df.select(t.licence_plain(F.col("l")), rules.matched_terms(F.col("s"), "[a-z][0-9]", 2), t.preview(F.col("s"), 4)).first()
    assert tuple(row) == ("bsd_3", ["a1", "b2"], "b2 a")
    assert t.spec_hash({"b": 1, "a": "é"}) == hashlib.sha256('{"a":"é","b":1}'.encode()).hexdigest() == t.spec_hash({"a": "é", "b": 1})


def test_readers(spark, tmp_path):
    (tmp_path / "hits.jsonl").write_text("\n".join(json.dumps({"lang": lang, "doc_sha256": lang * 2, "ngram_hits": 3}) for lang in ("en", "th")))
    assert [r.doc_sha256 for r in tables.hit_file(spark, f"{tmp_path}/hits.jsonl", "th").collect()] == ["thth"]
    (tmp_path / "log.jsonl").write_text('{"step": 1, "loss": 2.5}\nno json\n{"step": 2, "loss": 2.0}\n')
    assert [r.step for r in tables.metrics_log(spark, f"{tmp_path}/log.jsonl").orderBy("step").collect()] == [1, 2]
    part = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "i int, s string")
    both = tables.splits({"train": part, "test": part.where("i < 1")}, "i", 2)
    assert sorted((r.split, r.i) for r in both.collect()) == [("test", 0), ("train", 0), ("train", 1)]
    mixed = spark.createDataFrame([("q", 1, " ", "a"), (None, 2, "x", "")], "one string, n int, two string, three string")
    assert [r[0] for r in mixed.select(tables.row_text(mixed)).collect()] == ["q\na", "x"]
    found, failed = tables.read_specs({"good": lambda: part, "bad": lambda: tables.scan(spark, f"{tmp_path}/absent")})
    assert list(found) == ["good"] and list(failed) == ["bad"]
    digests = {r.path.rsplit("/", 1)[1]: r.sha256 for r in tables.file_digests(spark, f"{tmp_path}/*.jsonl").collect()}
    assert digests["log.jsonl"] == hashlib.sha256((tmp_path / "log.jsonl").read_bytes()).hexdigest()


def test_pools_indexes_and_exact_files(spark, tmp_path):
    pool = spark.createDataFrame([("th", "a", [1, 2], 0), ("en", "b", [3], 0)], "lang string, doc string, tokens array<int>, offset long")
    sinks.token_pool(pool, f"{tmp_path}/pool")
    assert [r.doc for r in tables.token_pool(spark, f"{tmp_path}/pool", ["th"]).collect()] == ["a"]
    index = ngrams.gram_index(spark.createDataFrame([("x" * 40 + "y" * 40,)], "s string"), F.col("s"), F.lit("b"))
    sinks.gram_index(index, f"{tmp_path}/index")
    assert spark.read.parquet(f"{tmp_path}/index").count() == index.count() == 17
    with pytest.raises(ValueError):
        sinks.exact_lines(pool, f"{tmp_path}/lines", 3)
    sinks.exact_lines(pool, f"{tmp_path}/lines", 2)
    assert spark.read.json(f"{tmp_path}/lines").count() == 2


def test_samples_merge_and_sources_keep_their_order(spark):
    rows = spark.createDataFrame([("k", i) for i in range(20)], "kind string, key int")
    a, b = rows.where("key % 3 = 0"), rows.where("key % 3 <> 0")
    first = budget.merged_bottom(a.limit(0), a, ["kind"], 4, [F.col("key")])
    assert sorted(r.key for r in budget.merged_bottom(first, b, ["kind"], 4, [F.col("key")]).collect()) == [0, 1, 2, 3]
    ordered = budget.in_order({"z": a, "a": b})
    assert [r[0] for r in ordered.groupBy("pool").agg(F.first("pool_ord").alias("o")).orderBy("o").collect()] == ["z", "a"]


def test_intake_stops_at_its_target(spark, tmp_path):
    for i in range(5):
        (tmp_path / "in").mkdir(exist_ok=True)
        spark.createDataFrame([(f"text {i}",)], "text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda target: until_target(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, F.length("text").cast("long"), target, f"{tmp_path}/out", f"{tmp_path}/state")
    assert run(13) == 18
    assert run(13) == 18  # nothing is new, and nothing is lost


def test_verification_finds_what_is_off(spark):
    df = spark.createDataFrame([("a", 1, "h1", 5), ("a", 2, "h2", 0), ("b", 3, "h1", 5)], "shard string, i int, h string, n long")
    claimed = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "shard string, documents long")
    got = audit.verify_shards(df, ["shard"], "h", {"no_tokens": F.col("n") <= 0}, "i", {"documents": F.lit(1)}, claimed)
    assert {tuple(r) for r in got.collect()} == {("a", 1, 0, 0, "FAIL"), ("b", 0, 1, 1, "FAIL"), ("c", 0, 0, 1, "FAIL")}
    sample = spark.createDataFrame([("a", 2, "x y"), ("a", 3, "x y"), ("b", None, "x")], "g string, recorded long, s string")
    assert {tuple(r) for r in audit.recount(sample, "g", "recorded", tk.token_counts(F.col("s"), "words")).collect()} == {("a", 2, 1), ("b", 1, 1)}


def test_workers_hold_few_texts_at_a_time(spark, sf):
    before = spark.conf.get(shared.ARROW_ROWS)
    try:
        spark.conf.set(shared.ARROW_ROWS, "10000")
        tables.table(spark, sf, "documents")
        assert spark.conf.get(shared.ARROW_ROWS) == "1000"
        spark.conf.set(shared.ARROW_ROWS, "250")
        tables.table(spark, sf, "documents")
        assert spark.conf.get(shared.ARROW_ROWS) == "250"
    finally:
        spark.conf.set(shared.ARROW_ROWS, before)


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError):
        shared.shared_path(Session(), "x")
