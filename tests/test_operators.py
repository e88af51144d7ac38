import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import rules
from tessera.functions import text as t
from tessera.operators import audit, budget, dedup, ngrams
from tessera.operators.prefix import running_sum
from tessera.plans import clean_plans, gram_plans, instruct_plans, text_plans
from tessera.sources import sinks, tables
from tessera.streaming.incremental import new_documents, running_accounts


def test_running_sums_over_groups(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaaab"), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, g string, v long").repartition(7)
    for groups in ([], ["g"]):
        got = {r.i: r.s for r in running_sum(df, "v", ["i"], "s", groups, parts=5).collect()}
        sums = {}
        for i, g, v in rows:
            key = g if groups else ""
            assert got[i] == sums.get(key, 0)
            sums[key] = sums.get(key, 0) + v


def test_budgets_take_the_row_that_crosses(spark):
    df = spark.createDataFrame([(i, "a", 10) for i in range(5)], "i long, g string, n long")
    assert budget.take_until(df, "n", F.lit(25), ["i"], ["g"]).count() == 3
    assert budget.take_until(df, "n", F.lit(30), ["i"], ["g"]).count() == 3
    assert budget.take_until(df, "n", F.lit(0), ["i"], ["g"]).count() == 0


def test_round_robin_and_quotas(spark):
    rows = [(0, "x"), (1, "x"), (2, "x"), (3, "y"), (4, "z"), (5, "z")]
    df = spark.createDataFrame([(i, "g", f) for i, f in rows], "i long, g string, f string")
    turns = budget.round_robin(df, "g", "f", "i").orderBy("turn", "f").collect()
    assert [r.i for r in turns] == [0, 3, 4, 1, 5, 2]
    quotas = budget.file_quotas(df.select("f").distinct(), "f", 5)
    assert {r.f: r.quota for r in quotas.collect()} == {"x": 2, "y": 2, "z": 1}
    assert sorted(r.i for r in budget.within_quota(df, quotas, "f", "i").collect()) == [0, 1, 3, 4]


def test_packing_covers_all_but_the_tail(spark):
    rng = random.Random(2)
    sizes = [rng.choice([0, 1, 5, 40]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i long, n long")
    parts = budget.packed(df, "n", ["i"], 16).collect()
    stream = [(i, k) for i, n in enumerate(sizes) for k in range(n)]
    full = len(stream) // 16
    got = {}
    for p in parts:
        for k in range(p.n):
            got[p.seq_id * 16 + p.start_in_seq + k] = (p.i, p.from_token + k)
    assert got == dict(enumerate(stream[: full * 16]))


def test_shard_orders():
    assert budget.stratified_order(14, 5)[:5] == [0, 3, 6, 10, 13]
    for n in range(30):
        assert sorted(budget.stratified_order(n)) == list(range(n))
    used = [0, 110, 220, 330, 440, 550, 660, 770, 879]
    order = budget.farthest_first(used, 880)
    assert sorted([*order, *used]) == list(range(880)) and order[0] == 55
    assert budget.farthest_first([], 3) == [0, 2, 1]


def test_mixture_ratios_must_sum_to_one():
    assert budget.mixture_targets({"a": 0.25, "b": 0.75}, 10) == {"a": 2, "b": 8}
    with pytest.raises(ValueError):
        budget.mixture_targets({"a": 0.5}, 10)


def test_rules_are_ordered_and_duplicates_come_last(spark):
    rows = [(1, "x", True), (2, "x", False), (3, "x", False), (4, "y", False)]
    df = spark.createDataFrame(rows, "i long, k string, bad boolean")
    got = rules.mark_repeats(df, "k", "i", ~F.col("bad"), "again")
    assert {r.i: r.again for r in got.collect()} == {1: False, 2: False, 3: True, 4: False}
    first = df.select("i", rules.first_rule([("a", F.col("i") > 2), ("b", F.col("i") > 1)]).alias("r"))
    assert {r.i: r.r for r in first.collect()} == {1: None, 2: "b", 3: "a", 4: "a"}


def test_the_cascade_evaluates_each_text_once(spark, sf):
    plan = clean_plans.cascade(spark, sf)._jdf.queryExecution().toString()
    assert "text#" not in plan and "ArrowEvalPython" not in plan
    share = spark.createDataFrame([("a b",)], "s string").select(t.script_ratio(F.col("s"), "A-z"))
    assert "regexp_extract_all" not in share._jdf.queryExecution().toString()


def test_thai_patterns_match(spark):
    rows = spark.createDataFrame([("เล่นคาสิโนที่นี่",), ("สมัครสมาชิก วันนี้ เครดิตฟรี",), ("เลขท้าย 2 ตัว",), ("ปกติ",)], "s string")
    got = rows.select(rules.first_rule(rules.pattern_rules(F.col("s"), rules.THAI_SPAM)).alias("r")).collect()
    assert [r.r for r in got] == ["gambling", "gambling", "lottery", None]


def test_hits_count_windows_by_either_way(spark):
    bench = "the quick brown fox jumps over the lazy dog and runs away from it all, far and wide"
    docs = [(1, "x" * 8 + bench + bench), (2, "nothing of it"), (3, None), (4, bench[:64]), (5, bench[:63])]
    df = spark.createDataFrame(docs, "i long, s string")
    index = ngrams.gram_index(spark.createDataFrame([(bench,)], "s string"), F.col("s"), F.lit("b"))
    assert index.count() == len(bench) - 63
    grams = {bench[k : k + 64] for k in range(len(bench) - 63)}
    want = {i: sum((s or "")[k : k + 64] in grams for k in range(0, len(s or "") - 63, 8)) for i, s in docs}
    for sent in (10**6, 0):
        got = {r.i: r.hits for r in ngrams.window_hits(df, index, "i", F.col("s"), sent_bytes=sent, bloom_bits=1 << 16).collect()}
        assert got == want and want[1] > 2 and want[4] == 1 and want[5] == 0


def test_bloom_filter_passes_all_members_and_few_others(spark):
    rng = np.random.default_rng(2)
    grams = rng.integers(-(2**63), 2**63, 5_000, dtype=np.int64)
    table = ngrams.bloom(spark.createDataFrame([(int(g),) for g in grams], "gram long"), 1 << 17)
    assert ngrams.passes(table, grams).all()
    assert ngrams.passes(table, rng.integers(-(2**63), 2**63, 20_000, dtype=np.int64)).mean() < 0.02


def test_sensitivity_looks_a_size_up_once_for_all_strides(spark, monkeypatch):
    bench = "the quick brown fox jumps over the lazy dog and runs away from it all, far and wide"
    docs = [(1, "x" * 5 + bench), (2, "nothing of it"), (3, None), (4, bench[:64]), (5, bench[3:40] * 2)]
    df, items = spark.createDataFrame(docs, "i long, s string"), spark.createDataFrame([(bench,)], "b string")
    labels, stored = [], ngrams.stored
    monkeypatch.setattr(ngrams, "stored", lambda rows, label: labels.append(label) or stored(rows, label))
    sizes, strides, most = (16, 32, 64), (1, 6, 4), (1, 2, 5)
    got = {(r.gram, r.stride): tuple(r)[2:] for r in ngrams.sensitivity(df, items, "i", F.col("s"), F.col("b"), sizes, strides, most).collect()}
    for n in sizes:
        grams = {bench[k : k + n] for k in range(len(bench) - n + 1)}
        for stride in strides:
            hits = [sum((s or "")[k : k + n] in grams for k in range(0, len(s or "") - n + 1, stride)) for _, s in docs]
            assert got[n, stride] == (len(docs), *[sum(h >= k for h in hits) for k in most])
    assert labels == ["grams"] * len(sizes)


def test_minima_are_those_of_all_values():
    rng = np.random.default_rng(3)
    some = rng.integers(0, dedup.PRIME, 30_011)
    worst = [(dedup.PRIME - b) * pow(a, -1, dedup.PRIME) % dedup.PRIME for a, b in zip(dedup.A, dedup.B, strict=True)]
    for h in (some, some[:1], some[:512], some[:4_097], np.sort(some)[:900], np.repeat(some[:1], 700), np.arange(5_000), np.array([*worst, *some[:2_000], dedup.PRIME - 1])):
        assert dedup.minima(h.astype(np.int64)).tolist() == [int(((h * a + b) % dedup.PRIME).min()) for a, b in zip(dedup.A, dedup.B, strict=True)]


def test_window_hashes_match_their_definition():
    text, n = "añb😀" * 40, 64
    want = [sum(ord(c) * pow(dedup.BASE, j, dedup.PRIME) for j, c in enumerate(text[i : i + n])) % dedup.PRIME for i in range(0, len(text) - n + 1, 3)]
    assert dedup.window_hashes(text, n, 3).tolist() == want


def test_near_duplicates_form_a_chain(spark):
    rng = random.Random(4)
    words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randint(0, 99)) for _ in range(400)]
    near = [*words]
    near[399] = "changed"
    df = spark.createDataFrame([(5, " ".join(words)), (3, " ".join(near)), (9, "short"), (8, "entirely other words " * 30)], "i long, s string")
    assert [tuple(r) for r in dedup.near_duplicates(df, "i", F.col("s")).collect()] == [(5, 3)]


def test_near_duplicates_survive_a_shift(spark):
    rng = random.Random(8)
    words = " ".join(str(rng.randint(10**6, 10**7)) for _ in range(300))
    df = spark.createDataFrame([(1, words), (2, "odd " + words)], "i long, s string")
    assert [tuple(r) for r in dedup.near_duplicates(df, "i", F.col("s")).collect()] == [(2, 1)]
    assert dedup.near_duplicates(df, "i", F.col("s"), stride=8).count() == 0


def test_percentiles_take_the_element_at_the_floor(spark):
    df = spark.createDataFrame([("a", v) for v in range(10)] + [("b", 7)], "g string, v long")
    got = {r.g: (r.m, r.t) for r in audit.floor_percentiles(df, "g", "v", {"m": 0.5, "t": 1.0}).collect()}
    assert got == {"a": (5, 9), "b": (7, 7)}


def test_fingerprints(spark):
    a = spark.createDataFrame([("x", f"{i:064x}") for i in range(50)], "g string, h string")
    b = a.repartition(5)
    assert audit.tree_fingerprint(a, "h", ["g"]).collect() == audit.tree_fingerprint(b, "h", ["g"]).collect()
    assert audit.tree_fingerprint(a, "h", ["g"]).first().fingerprint != audit.tree_fingerprint(a.union(a.limit(1)), "h", ["g"]).first().fingerprint
    with pytest.raises(Exception, match="too many documents"):
        audit.flat_fingerprint(a, "h", ["g"], most=10).collect()


def test_readers_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", "ab"[i % 2]) for i in range(10)], "i long, text string, fate string")
    sinks.json_shards(df.coalesce(1), f"{tmp_path}/j", per_file=4)
    assert len(list(tmp_path.glob("j/*.json.gz"))) == 3
    back = tables.json_lines(spark, f"{tmp_path}/j", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.json_shards(df, f"{tmp_path}/j")
    sinks.lines(df, "text", f"{tmp_path}/l")
    assert tables.removal_list(spark, f"{tmp_path}/l").count() == 10
    sinks.by_fate(df, "fate", {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"})
    assert spark.read.json(f"{tmp_path}/a").count() == 5
    sinks.token_pool(df.select(F.col("fate").alias("lang"), F.array("i").alias("tokens")), f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").where("lang = 'a'").count() == 5
    df.write.parquet(f"{tmp_path}/q")
    with pytest.raises(tables.MissingColumn):
        tables.scan(spark, f"{tmp_path}/q", required=("code",))
    (tmp_path / "bad.json").write_text('{"i": 1}\n')
    with pytest.raises(Exception, match="missing text"):
        tables.json_lines(spark, f"{tmp_path}/bad.json", df.schema).collect()


def test_intake_reads_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("text", T.StringType())])
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    run = lambda: sorted(r.text for r in new_documents(spark, folder, schema, t.doc_hash(F.col("text")), out, state).collect())
    spark.createDataFrame([("a",), ("b",), ("a",)], schema).write.parquet(folder)
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    spark.createDataFrame([("b",), ("c",)], schema).write.mode("append").parquet(folder)
    assert run() == ["a", "b", "c"]
    counts = running_accounts(spark, folder, schema, F.when(F.col("text") == "a", "is_a"), f"{tmp_path}/acc", f"{tmp_path}/acc-state")
    assert {r.reason: r.documents for r in counts.collect()} == {"is_a": 2, "kept": 3}


def test_queries_read_whole_texts(spark, tmp_path):
    rng = random.Random(6)
    filler = lambda size: " ".join(str(rng.randint(10**6, 10**7)) for _ in range(size // 8))[: size - 1] + "."
    bench, shared = "passage " * 3 + filler(200), filler(300_000)
    texts = {1: filler(41_000) + bench, 2: filler(40_000) + shared, 3: filler(40_000) + shared, 4: filler(500)}
    rows = [(i, s, "en", "web", len(s)) for i, s in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = lambda name: gram_plans.QUERIES[name](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.windows for r in run("char_ngrams")} == {i: (len(s) - 64) // 8 + 1 for i, s in texts.items()}
    assert [r.doc_id for r in run("decon_hits")] == [1]
    assert [(r.doc_id, r.benchmark, r.all_hits) for r in run("decon_attribution")] == [(1, "bench0", len(bench) - 63)]
    assert {r.at_least_1 for r in run("decon_sensitivity")} == {1}
    assert [tuple(r) for r in run("near_dup")] == [(3, 2)]
    assert len(run("removal_list")) == 2
    assert sum(r.documents for r in run("apply_removal")) == 2


def test_answers_are_decontaminated_whole(spark, tmp_path):
    rng = random.Random(7)
    filler = lambda size: " ".join(str(rng.randint(10**6, 10**7)) for _ in range(size // 8))
    bench = filler(200)
    answers = {1: filler(21_000) + " " + bench, 2: filler(21_000)}
    rows = [(i, k, role, s) for i, answer in answers.items() for k, (role, s) in enumerate((("user", f"question {i}"), ("assistant", answer)))]
    rows = [(28 * i + 4, *rest) for i, *rest in rows]  # an allowed licence and rating
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.conv_id: r.fate for r in instruct_plans.sft_fate(spark, str(tmp_path)).collect()}
    assert got[32] == "dropped_decon" and got[60] in ("kept_train", "kept_heldout")


def test_streamed_fingerprints_have_no_bound(spark, monkeypatch):
    rows = [(random.Random(i).choice(["x", "y", None]), None if i % 50 == 0 else f"{i % 90:064x}") for i in range(300)]
    a = spark.createDataFrame(rows, "g string, h string")
    for groups in ([], ["g"]):
        for df in (a, a.limit(0)):
            got, want = (sorted(map(str, f(df, "h", groups).collect())) for f in (audit.streamed_fingerprint, audit.flat_fingerprint))
            assert got == want
    many = [f"{i:064x}" for i in range(100_001)]
    held = spark.range(100_001).select(F.lit("en").alias("lang"), F.lpad(F.lower(F.hex("id")), 64, "0").alias("doc_sha256"))
    monkeypatch.setattr(text_plans, "hashed", lambda *_: held)
    assert [tuple(r) for r in text_plans.heldout_fingerprint(spark, "").collect()] == [("en", 100_001, hashlib.sha256("".join(many).encode()).hexdigest())]
