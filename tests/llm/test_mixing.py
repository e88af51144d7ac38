import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, ranking


def slow_targets(sizes, weights=mixing.WEIGHTS, epochs=3):
    """sizes: {source: words}; targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: epochs * sizes[s] if s in full else weight[s] * left / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > epochs * sizes[s]}
        if not over:
            return target
        full |= over


def slow_mix(rows):
    """rows: (doc_id, source, words) of distinct ids: how often each is taken."""
    sizes = defaultdict(int)
    for _, s, w in rows:
        sizes[s] += w
    target = slow_targets(sizes)
    key = lambda i: int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:15], 16)
    turns, served = [], defaultdict(int)
    for i, s, w in sorted(rows, key=lambda r: (key(r[0]), r[0])):
        served[s] += w
        if w:
            turns += [((e * sizes[s] + served[s]) / target[s], "n" if s is None else "s" + s, key(i), i, w) for e in range(3)]
    spent, out = 0, Counter()
    for *_, i, w in sorted(turns):
        spent += w
        if spent > sum(sizes.values()):
            break
        out[i] += 1
    return out, target


def test_query_matches_brute_force_and_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(r.doc_id, r.source, len(r.text.split())) for r in docs]
    taken, target = slow_mix(rows)
    query = mixing.op9_mixing(spark, sf)
    got = query.collect()
    assert {r.doc_id: r.taken for r in got} == {i: taken[i] * w for i, _, w in rows}
    by_id = {r.doc_id: r.source for r in docs}
    assert all(r.target == pytest.approx(target[by_id[r.doc_id]], rel=1e-12) for r in got)
    sums = Counter()
    for r in got:
        assert r.taken <= 3 * r.size
        sums[by_id[r.doc_id]] += r.taken
    assert all(abs(sums[s] - target[s]) <= 2 * max(w for *_, w in rows) for s in target)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(mixing.oracle()).select(", ".join(query.columns)).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_targets_fill_up_and_null_comes_last(spark):
    sizes = {"a": 1, "b": 2, "é": 1000, "z": 50, None: 3, "zz": 0}
    rows = [("n" if s is None else "s" + s, s, n) for s, n in sizes.items()]
    got = mixing.source_targets(spark.createDataFrame(rows, "stratum string, source string, source_size long")).collect()
    want = slow_targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == want
    assert sum(r.target for r in got) == pytest.approx(sum(sizes.values()))


def test_odd_rows_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 7)
    rows = [(i, "hot" if i % 3 else f"s{i % 4}", "w " * (i % 20)) for i in range(300)]
    plain = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken, _ = slow_mix([(i, s, len(t.split())) for i, s, t in rows])
    assert {r.doc_id: r.epochs for r in mixing.fair_mix(plain).collect()} == {i: taken[i] for i, *_ in rows}
    odd = [*rows, (None, None, "a b c"), (None, None, "a b c"), (7, "hot", None), (8, "hot", ""), (1, "hot", "w "), (1, "hot", "w ")]
    df = spark.createDataFrame(odd, "doc_id long, source string, text string").withColumn("epoch", F.lit(9))
    first, again = (sorted(map(str, mixing.fair_mix(df).collect())) for _ in range(2))
    assert first == again and len(first) == len(odd)
    assert all(r.epochs == 0 for r in mixing.fair_mix(df).where("size = 0").collect())
    total = mixing.fair_mix(df).agg(F.sum(F.col("epochs") * F.col("size")), F.sum("size")).first()
    assert total[0] <= total[1] and total[0] >= 0.9 * total[1]
    assert mixing.fair_mix(df.where(F.lit(False))).count() == 0
