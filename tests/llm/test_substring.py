import hashlib
import random
import re

from pyspark.sql import functions as F

from tessera.llm import spans, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    """docs: (doc_id, text) in order of doc_id."""
    seen, out = set(), {}
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check(spark, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substring.remove_repeats(table).collect()}
    assert got == brute(sorted(docs, key=lambda d: d[0]))


def test_query_matches_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.op4_substring(spark, sf).collect()}
    want = brute(sorted(docs))
    assert got == want and any(w[1] for w in want.values())


def test_branching_passages(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    passages = [[word() for _ in range(rng.randint(15, 60))] for _ in range(6)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 6)):
            part = list(rng.choice(passages))
            a = rng.randint(0, 10)
            part = part[a : len(part) - rng.randint(0, 10)]
            if rng.random() < 0.4 and part:
                part[rng.randrange(len(part))] = "x"
            words += part + [word() for _ in range(rng.randint(0, 5))]
        docs.append((i * 7 % 120, rng.choice([" ", "\n", " \t"]).join(words)))
    docs += [(200, None), (201, ""), (202, "la " * 50), (203, "la " * 19), (204, "é ü " * 30)]
    check(spark, docs)


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(6)
    body = [rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(700)]
    monkeypatch.setattr(spans, "PIECE_WORDS", 100)
    lines = list(spans.pieces([" ".join(body)], 19))
    assert sum(len(p[0]) for p in lines) == 7
    import numpy as np
    import pandas as pd

    text = " ".join(body + body[100:400])
    frame = pd.DataFrame({"doc": [1], "tag": [0], "text": [text]})
    rows = pd.concat(substring._emit_paths(iter([frame]))).sort_values(list(substring._PATH_KEY))
    n = (rows["place"] & 31)[rows.kind != substring.MARK].sum()
    assert n == 1000 - 19
    assert np.all(rows["doc"][rows.kind != substring.MARK] == 1)


def test_settling_does_not_depend_on_batches():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    deal = np.sort(rng.integers(0, 12, 300))
    rows = pd.DataFrame({"deal": deal, "one": deal * 10 + rng.integers(0, 3, 300) * (deal % 3), "two": rng.integers(0, 2, 300), "doc": rng.integers(0, 99, 300)})
    rows = rows.assign(tag=rng.integers(0, 2, 300), place=rng.integers(0, 9, 300) * 32, source=0, kind=np.zeros(300, np.int8)).sort_values(list(substring._PATH_KEY), ignore_index=True)
    whole = pd.concat(substring._settle_paths(iter([rows])))
    key = lambda d: sorted(map(tuple, d.to_numpy().tolist()))
    assert {True, False} == set(whole.branch) and whole.source_start[~whole.branch].max() > 0
    for size in (1, 2, 7, 50):
        parts = pd.concat(substring._settle_paths(iter([rows[i : i + size] for i in range(0, 300, size)])))
        assert key(parts) == key(whole)


def test_words_that_polynomial_hashes_confuse_are_told_apart(spark):
    """A Thue-Morse word and its complement share every polynomial hash modulo 2**64 with an odd base."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    lead = " ".join(f"w{i}" for i in range(30))
    import numpy as np

    words = spans.Words([[word.encode()], [other.encode()]])
    assert np.unique(words.span(np.arange(2), np.arange(2))).size == 1
    check(spark, [(1, f"{lead} {word} {lead}"), (2, f"{lead} {other} {lead}"), (3, f"{lead} {word} {lead}")])


def test_spans_are_verified_at_their_source(spark):
    """A span whose source does not hold its words ends the job."""
    import pandas as pd
    import pytest

    words = [f"w{i}" for i in range(30)]
    digest = substring._digest([w.encode() for w in words], 0, 25)
    row = {"doc_id": [2], "text": [" ".join(words)], "found": [[{"start": 0, "length": 25, "digest": digest}]]}
    out = next(substring._cut(iter([pd.DataFrame(row)]), False))
    assert out.n_removed[0] == 25 and out.kept[0] == " ".join(words[25:])
    row["found"][0][0]["start"] = 1
    with pytest.raises(substring.UnverifiedSpan):
        next(substring._cut(iter([pd.DataFrame(row)]), False))


def test_many_spans_of_one_source(spark, monkeypatch):
    monkeypatch.setattr(substring, "SPANS_PER_ROW", 3)
    rng = random.Random(8)
    source = [f"w{i}" for i in range(400)]
    docs = [(0, " ".join(source))]
    for i in range(1, 40):
        a = rng.randrange(300)
        docs.append((i, " ".join([f"x{i}", *source[a : a + rng.randint(20, 90)], f"y{i}"])))
    check(spark, docs)


def test_rows_that_repeat_an_id(spark):
    """Other texts under one id are documents of their own."""
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, text), (1, text + " z"), (1, "short one"), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert got in ([(1, 2, 0), (1, 25, 0), (1, 26, 25), (2, 25, 25)], [(1, 2, 0), (1, 25, 25), (1, 26, 0), (2, 25, 25)])


def test_query_matches_sql(spark, sf):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = {tuple(r) for r in substring.op4_substring(spark, sf).collect()}
    assert got == set(db.execute(substring.oracle()).fetchall())


def test_nulls_repeats_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(1, text, "x"), (1, text, "y"), (2, text, "z"), (None, text, "n"), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert got == [("1", 25, 25), ("1", 25, 25), ("2", 25, 25), ("3", 0, 0), ("None", 25, 0)]
    assert substring.remove_repeats(docs.where(F.lit(False))).count() == 0
