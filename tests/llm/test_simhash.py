import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            groups[find(i)] = min(groups.get(find(i), ids[i]), ids[i])
    return [groups.get(find(i)) for i in range(len(ids))]


def test_fingerprint_matches_definition():
    for text in [None, "", " \n", "one", "One TWO", "a b c", "a b c d e É é", "x " * 70_000 + "y z", "a b c d"]:
        assert simhash.fingerprint(text) % 2**64 == slow_fingerprint(text)


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [slow_fingerprint(d.text) for d in docs]
    want = slow_components([d.doc_id for d in docs], fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op3_simhash(spark, sf).collect()}
    assert got == {d.doc_id: (f"{f:016x}", w) for d, f, w in zip(docs, fps, want)}


def test_hot_buckets_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(-(2**63), 2**63, 4)]
    fps = set(base)
    for b in base:
        for _ in range(60):
            flip = sum(1 << int(i) for i in rng.choice(64, int(rng.integers(1, 7)), replace=False))
            fps.add(int(np.int64(np.uint64(b % 2**64) ^ np.uint64(flip))))
    fps = sorted(fps)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = slow_components(fps, [f % 2**64 for f in fps])
    for most in (128, 1):
        roots = {r.node: r.root for r in simhash.components(simhash.near_links(table, max_bucket=most)).collect()}
        assert [roots.get(f, f) for f in fps] == want


def test_nulls_ties_and_extra_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "", "z"), (4, "a b c d", "w"), (4, "a b c d", "w"), (None, "q r s t u", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((str(r.doc_id), r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect())
    a, q = (simhash.fingerprint(t) for t in ("a b c d", "q r s t u"))
    assert got == sorted([("1", 0, 1), ("2", 0, 1), ("None", 0, 1), ("4", a, 4), ("4", a, 4), ("None", q, None)])
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0


def test_chains_stay_whole_in_any_order(spark):
    beside = [(1000 + 2 * i, 1001 + 2 * i) for i in range(30)]
    # Orders that split when rounds ended while a node still hung from two roots.
    tables = [([(2, 3), (3, 4), (4, 5), (5, 1)], 5)]
    for size, seed in ((5, 3), (6, 21), (8, 10), (12, 47)):
        nodes = list(range(1, size + 1))
        random.Random(seed).shuffle(nodes)
        tables.append((list(zip(nodes, nodes[1:])), size))
    for links, size in tables:
        for more in ([], beside):
            edges = spark.createDataFrame(links + more, "a long, b long")
            got = {r.node: r.root for r in simhash.components(edges).collect()}
            assert got == {i: 1 for i in range(1, size + 1)} | {n: a for a, b in more for n in (a, b)}


def test_pivots_discard_no_near_pair_and_most_others(spark):
    rng = random.Random(11)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for fp in list(fps)[:60]:
        fps.add(fp ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    for fp in list(fps)[:40]:  # share three runs, and differ in many other bits
        fps.add(fp ^ (rng.getrandbits(30) << 33))
    fps = sorted(fp - (1 << 64) if fp >= 1 << 63 else fp for fp in fps)
    table = spark.createDataFrame([(fp,) for fp in fps], "fp long")
    report = simhash.pair_report(table).first()
    near = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert {tuple(sorted(r)) for r in simhash.near_links(table).collect()} == near
    assert report.verified >= len(near) and report.looked_at >= report.discarded + report.verified and report.discarded > 0
