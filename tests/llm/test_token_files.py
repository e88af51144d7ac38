import io
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import token_files as tf

HARD = [None, "", "  ", "Hello  WORLD\nit's 12 o'clock", "a<|endoftext|>b <|startoftext|> c", "é́  x y\x1cz　ΑΣ Σ", "don't'll 've x'S", "日本語 テスト", "\u0000​", "word " * 3000, "İ ŉ ǰ", "< |endoftext|>"]


def want(texts):
    t = Tokenizer.from_file(public_tokenizers.path(tf.TOKENIZER))
    return [[*e.ids, 2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_words_give_the_ids_of_whole_texts(spark, sf):
    texts = HARD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    encoder = tf.WordEncoder(public_tokenizers.path(tf.TOKENIZER), max_words=500)
    got = [[*x.tolist(), 2] for a in range(0, len(texts), 7) for x in encoder.encode(texts[a : a + 7])]
    assert got == want(texts)


def test_marks_and_capitals_make_no_new_words():
    encoder = tf.WordEncoder(public_tokenizers.path(tf.TOKENIZER))
    texts = ["Word word, word. (word) WORD! \"word\"; word-word wORD", "été Été, (été) ÉTÉ."]
    assert [[*x.tolist(), 2] for x in encoder.encode(texts)] == want(texts)
    assert {w for w in encoder.number if w.decode("utf-8").isalpha()} == {b"word", "été".encode()}


def test_cuts_at_marks_keep_the_ids_of_whole_texts():
    path = public_tokenizers.path(tf.TOKENIZER)
    rng = random.Random(8)
    parts = [*"aAsStTlLeEK09 \t\x1c\x7f'',.<>|=_(", *"éÉß×÷Þİſ½ก日", "\u0301", "\u0307", "\u0331", "\u0338", "\xa0", "<|endoftext|>", "<|ENDOFTEXT|>", "'Ll"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(20))) for _ in range(4000)]
    encoder = tf.WordEncoder(path)
    assert encoder.marks and encoder.lower
    runs = [(0, 1000), *((i, i + 3) for i in range(1000, 4000, 3))]
    assert [[*x.tolist(), 2] for a, b in runs for x in encoder.encode(texts[a:b])] == want(texts)


@pytest.mark.parametrize("change", [{"pre_tokenizer": {"type": "WhitespaceSplit"}}, {"normalizer": {"type": "NFC"}}, {"normalizer": {"type": "NFKC"}}])
def test_other_tokenizers_keep_their_own_rules(tmp_path, change):
    with open(public_tokenizers.path(tf.TOKENIZER), encoding="utf-8") as f:
        setup = json.load(f) | change
    (tmp_path / "t.json").write_text(json.dumps(setup), encoding="utf-8")
    texts = [*HARD, "Word word, (WORD) it's IT'S", "été Été, ①,a"]
    whole = Tokenizer.from_file(str(tmp_path / "t.json")).encode_batch([t or "" for t in texts], add_special_tokens=False)
    encoder = tf.WordEncoder(str(tmp_path / "t.json"))
    assert not encoder.lower
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in whole]


def test_runs_cover_all_texts(monkeypatch):
    monkeypatch.setattr(tf, "ENCODE_CHARS", 10)
    texts = ["a" * 4, None, "b" * 6, "c", "d" * 30, "e" * 30, ""]
    assert list(tf._runs(texts)) == [(0, 3), (3, 4), (4, 5), (5, 6), (6, 7)]
    assert list(tf._runs([])) == [] and list(tf._runs([""])) == [(0, 1)]
    long = ["it's ONE text,\x0band (long) ; " * 9, "", None, "nothing-to-cut-at-in-this", " " * 25, "a" * 10]
    assert all("".join(tf._stretches(t)) == t for t in long if t)
    encoder = tf.WordEncoder(public_tokenizers.path(tf.TOKENIZER))
    assert [[*x.tolist(), 2] for x in encoder.encode(long)] == want(long)
    assert encoder.encode([]) == []


def test_query_matches_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
    start, rows = 0, {}
    for d, ids in zip(docs, want([d.text for d in docs])):
        rows[d.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tf.op8_token_files(spark, sf).collect()}
    assert got == rows


def test_round_trip_random_access_and_nulls(spark, tmp_path):
    rows = [(5, "b c", 1), (None, "null id", 2), (3, None, 3), (5, "a", 4), (9, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    files = tf.write_tokens(docs, f"file://{tmp_path}/t")
    got = sorted(tf.read_tokens(files).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(5))
    assert [r.doc_id for r in got] == [None, 3, 5, 5, 9]
    assert [r.start for r in got] == list(np.cumsum([0] + [len(r.ids) for r in got[:-1]]))
    assert got[1].ids == [2] and got[4].ids == [2]
    for f in files.collect():
        back = tf.read_at(f.file, f.index_file, list(range(f.n_docs))[::-1])[::-1]
        assert [b[0] for b in back] == [r.doc_id for r in got if f.first_doc <= r.position < f.first_doc + f.n_docs]
    # Files of two records, stretches of one.
    small = tf.write_tokens(docs, f"file://{tmp_path}/s", file_bytes=60, stretch_bytes=1)
    assert sorted(map(str, tf.read_tokens(small).collect())) == sorted(map(str, got))
    stretches = small.collect()
    assert len(stretches) == 5 and all(f.n_docs == 1 for f in stretches) and len({f.file for f in stretches}) >= 3
    for f in stretches:
        assert tf.read_at(f.file, f.index_file, [f.first_record])[0][0] == got[f.first_doc].doc_id
    empty = tf.write_tokens(docs.where(F.lit(False)), f"file://{tmp_path}/e")
    assert tf.read_digests(empty).count() == 0


def test_damage_is_found():
    data = tf.frame(b"abc") + tf.frame(b"") + tf.frame(bytes(100))
    assert list(tf.frames(io.BytesIO(data))) == [b"abc", b"", bytes(100)]
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 4
        with pytest.raises(tf.CorruptRecord):
            list(tf.frames(io.BytesIO(bytes(bad))))
    with pytest.raises(tf.CorruptRecord):
        list(tf.frames(io.BytesIO(data[:-1])))
