import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import boosting, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def test_base_columns_match_definition(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += [None, "", "\n\n", "a", "a a", "a a a", "a a a a", "a b a b a b a", "x\ny\nx\nx\n \n \n", "É|é <b> $1\x0b2\x0c3", "a b c d"]
    for text in texts:
        assert quality.statistics(text)[0] == slow_base(text)


def test_held_out_accuracy_and_base_rules(spark, sf):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    model = quality.train(docs, train)
    got = quality.score(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), model, keep=("quality",)).where("not base_failed")
    right = got.agg(F.avg((F.col("kept") == (F.col("kept_quality") == 1)).cast("double"))).first()[0]
    assert right > 0.97
    assert quality.score(docs, model).where("base_failed and kept").count() == 0


def test_trees_keep_monotonic_constraints():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] - x[:, 1] + np.sin(4 * x[:, 0]) + rng.normal(size=3000) > 0).astype(float)
    model = boosting.fit(x, y, [1, -1, 0])
    grid = np.linspace(-3, 3, 50)
    for row in x[:40]:
        for j, sign in ((0, 1), (1, -1)):
            line = np.repeat(row[None], 50, axis=0)
            line[:, j] = grid
            assert np.all(sign * np.diff(model.margin(line)) >= -1e-9)
    assert ((model.probability(x) > 0.5) == (y > 0.5)).mean() > 0.8


def test_nulls_empty_tables_and_one_class(spark):
    good = "word " * 3 + " ".join(f"w{i}" for i in range(80))
    rows = [(1, good, "a"), (1, good, "b"), (None, good, "c"), (3, None, "d"), (4, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs, empty)
    got = sorted((str(r.doc_id), r.base_failed, r.kept) for r in quality.score(docs, model).collect())
    assert got == [("1", False, True), ("1", False, True), ("3", True, False), ("4", True, False), ("None", False, True)]
    one = spark.createDataFrame([(1, 0, 0), (None, 1, 0), (9, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.train(docs, one)).where("kept").count() == 0
    assert quality.score(docs.limit(0), model).count() == 0
