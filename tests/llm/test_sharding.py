import hashlib
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tessera.llm import ranking, sharding


def slow_shards(rows, n_shards=8, seed=sharding.SEED):
    """rows: (doc_id, source, text); the (size, crc, shard, slot) of each, by rank within the source and then by fraction."""
    key = lambda i: int(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:15], 16)
    full = [(i, s, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, s, t in rows]
    order = lambda r: (key(r[0]), r[0] is not None, r[0] or 0, r[3], r[2])
    fraction = []
    for s in {r[1] for r in full}:
        mine = sorted((r for r in full if r[1] == s), key=order)
        fraction += [((k + 0.5) / len(mine), "n" if s is None else "s" + s, order(r), r) for k, r in enumerate(mine)]
    fraction.sort(key=lambda f: f[:3])
    n, out = len(fraction), []
    for place, (*_, r) in enumerate(fraction):
        shard = place * n_shards // n
        out.append((r[0], r[1], r[2], r[3], shard, place - (shard * n + n_shards - 1) // n_shards))
    return sorted(map(str, out))


def found(df, **options):
    return sorted(str(tuple(r)) for r in sharding.stratified_shards(df, **options).select("doc_id", "source", "size", "text_crc32", "shard", "slot").collect())


def test_query_matches_brute_force_and_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found(docs) == slow_shards([(r.doc_id, r.source, r.text) for r in docs.collect()])
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    query = sharding.op2_sharding(spark, sf)
    assert sorted(map(str, map(tuple, query.collect()))) == sorted(map(str, con.sql(sharding.oracle()).select(", ".join(query.columns)).fetchall()))


def test_laws_hold_with_a_hot_source_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 10)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "x" * (i % 50)) for i in range(1001)] + [(None, None, None), (None, None, None), (5, "hot", "again"), (5, "hot", "again")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("rank", F.lit("a clashing name"))
    got = sharding.stratified_shards(df).collect()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s])) for s in sizes)
    mix = Counter((r.shard, r.source) for r in got)
    whole = Counter(r[1] for r in rows)
    assert all(abs(mix[s, k] - whole[k] / 8) <= 2 for s in range(8) for k in whole)
    assert found(df) == slow_shards(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert sharding.stratified_shards(empty).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, source string, text string")
    assert [tuple(r) for r in sharding.stratified_shards(one).select("doc_id", "size", "text_crc32", "shard", "slot").collect()] == [(None, 1, 0, 0, 0)]
