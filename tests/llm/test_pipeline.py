from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from tessera.llm import quality, sentencepiece_sampling
from tessera.llm.lattice import Vocabulary
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_substring import brute


@pytest.fixture(scope="module")
def steps(spark, sf):
    """What each stage returned, the documents first."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in c.STAGES:
        out.append(c.stored(stage(spark, out[-1], sf), name))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_order(steps):
    assert [n for n, _ in c.STAGES] == ["quality_rules", "simhash_near_dedup", "substring_dedup", "mix_to_target_weights", "sentencepiece_encode"]
    assert all(s.dtypes == steps[0].dtypes for s in steps[1:-1])


def test_quality_stage_keeps_what_the_rules_keep(spark, sf, steps):
    model = quality.train(steps[0], spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {}
    for i, r in rows(steps[0]).items():
        base, x = quality._features([r.text])
        if base[0, 0] >= 50 and 100 * base[0, 4] <= 50 * base[0, 0] and model.probability(x)[0] >= 0.5:
            kept[i] = r
    assert rows(steps[1]) == kept and len(kept) > 100


def test_near_dedup_stage(steps):
    before = rows(steps[1])
    groups = slow_components(list(before), [slow_fingerprint(r.text) for r in before.values()])
    assert rows(steps[2]) == {i: r for (i, r), g in zip(before.items(), groups) if i == g}


def test_substring_stage(steps):
    before = rows(steps[2])
    want = brute(sorted((i, r.text) for i, r in before.items()))
    after = rows(steps[3])
    assert set(after) == {i for i, (n, gone, _) in want.items() if gone == 0 or gone < n}
    for i, r in after.items():
        n, gone, _ = want[i]
        assert len(r.text.split()) == n - gone and r.n_chars == len(r.text)
        assert gone or r.text == before[i].text


def test_mixing_stage(steps):
    before = rows(steps[3])
    turns = Counter(r.doc_id for r in steps[4].collect())
    size = {i: len(r.text.split()) for i, r in before.items()}
    assert set(turns) <= set(before) and max(turns.values()) <= 3
    total, sources = sum(size.values()), sorted({r.source for r in before.values()})
    own = Counter()
    for i, r in before.items():
        own[r.source] += size[i]
    weights, target = dict(zip(sources, [5, 2, 1] * len(sources))), dict.fromkeys(sources, 0.0)
    full = set()
    while True:
        left = total - sum(3 * own[s] for s in full)
        share = {s: 3 * own[s] if s in full else weights[s] * left / sum(weights[t] for t in sources if t not in full) for s in sources}
        over = {s for s in sources if share[s] > 3 * own[s]}
        if not over:
            break
        full |= over
    target = share
    taken = Counter()
    for i, n in turns.items():
        taken[before[i].source] += n * size[i]
    longest = max(size.values())
    assert sum(taken.values()) <= total
    assert all(abs(taken[s] - target[s]) <= 2 * longest for s in sources)
    assert all(turns[i] >= 0 and r == before[r.doc_id] for i, r in rows(steps[4]).items())


def test_encoding_stage(steps):
    vocabulary = Vocabulary(public_tokenizers.path(sentencepiece_sampling.MODEL), sentencepiece_sampling.ALPHA)
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    turns = Counter(r.doc_id for r in steps[4].collect())
    got = steps[5].collect()
    assert Counter(r.doc_id for r in got) == {i: n * sentencepiece_sampling.K for i, n in turns.items()}
    assert all(sentencepiece_sampling.decode_ids(r.ids, vocabulary) == texts[r.doc_id] for r in got)


def test_turns_of_a_document_are_sampled_apart(steps):
    turns, seen = Counter(r.doc_id for r in steps[4].collect()), {}
    for r in steps[5].collect():
        seen.setdefault(r.doc_id, {}).setdefault(r.turn, []).append(tuple(r.ids))
    assert {i: len(t) for i, t in seen.items()} == turns
    several = [t for t in seen.values() if len(t) > 1]
    assert several and all(len({tuple(sorted(x)) for x in t.values()}) == len(t) for t in several if len(next(iter(t.values()))[0]) > 50)


def test_rows_that_repeat_an_id_stay_if_nothing_links_them(spark):
    one, two = " ".join(f"w{i}" for i in range(80)), " ".join(f"v{i * i}" for i in range(90))
    rows = [(1, one, "a"), (1, two, "a"), (2, one, "b"), (None, two, "c"), (None, one + " x y", "c"), (None, "a text of its own that nothing else here has", "d"), (1, one, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = {tuple(r) for r in c.drop_near_duplicates(spark, docs, "").collect()}
    assert {r[:2] for r in first} == {(1, one), (1, two), (None, rows[5][1])} or {r[:2] for r in first} == {(1, one), (1, two), (None, rows[4][1]), (None, rows[5][1])}
    for _ in range(2):
        again = c.drop_near_duplicates(spark, docs.orderBy(F.rand()).repartition(3), "").collect()
        assert len(again) == len(first) and {tuple(r) for r in again} == first
    mixed = Counter(tuple(r) for r in c.mix_sources(spark, docs.dropDuplicates(), "").collect())
    assert max(mixed.values()) <= 3


def test_odd_rows_pass_all_stages(spark, tmp_path):
    good = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(90))
    docs = [(1, good, "en", "a", 1, 5), (1, good, "en", "a", 1, 5), (None, other, None, None, None, 5), (None, other, None, None, None, 5), (3, None, "en", "b", 0, 5), (4, "", "en", "b", 0, 5)]
    path = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, kept int").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert {r.doc_id for r in c.run(spark, path).collect()} <= {1, None}
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/empty/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/empty/labels.parquet")
    assert c.run(spark, f"{path}/empty").count() == 0
