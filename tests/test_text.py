import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as t

SPACES = [chr(c) for c in range(0x10FFFF) if chr(c).isspace()]
HARD = ["", " a  b ", "é x", "\x1c\x1f a\x85", "ﬁ Ⅳ ①", "ก่ข　x", "a​b", None, "".join(SPACES) + "x"]


def test_normalise_is_nfc_and_collapsed_white_space(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(HARD)], "i int, s string")
    got = rows.select("i", t.normalise(F.col("s")), t.search_form(F.col("s")), t.doc_hash(F.col("s"))).collect()
    for i, plain, search, digest in got:
        s = HARD[i]
        if s is None:
            assert plain is None and digest is None
            continue
        want = " ".join(unicodedata.normalize("NFC", s).split())
        assert plain == want and digest == hashlib.sha256(want.encode()).hexdigest()
        assert search == " ".join(unicodedata.normalize("NFKC", s).lower().split())


def test_heldout_and_samples_follow_the_hash(spark):
    texts = [f"text {i}" for i in range(500)]
    rows = spark.createDataFrame([(s,) for s in texts], "s string").withColumn("h", t.doc_hash(F.col("s")))
    for s, b, held, sampled in rows.select("s", t.bucket(F.col("h")), t.is_heldout(F.col("h")), t.in_sample(F.col("h"), 7)).collect():
        n = int(hashlib.sha256(s.encode()).hexdigest()[:8], 16)
        assert (b, held, sampled) == (n % 100, n % 100 == 0, n % 7 == 0)


def test_script_ratio_includes_what_lies_between_the_cases(spark):
    rows = spark.createDataFrame([("ab[1 ",), ("",), ("ไทย",)], "s string")
    assert [r[0] for r in rows.select(t.script_ratio(F.col("s"), "A-z")).collect()] == [3 / 5, 0.0, 0.0]


@pytest.mark.parametrize(
    "name, group",
    [("Python", "python"), ("C#", "csharp"), ("C Sharp", "csharp"), ("C++", "c_cpp"), ("c", "c_cpp"), ("TypeScript", "javascript_typescript"), ("Java", "java"), ("Dockerfile", "css_config"), ("Rust", "long_tail"), (None, "long_tail"), ("HTML", "html")],
)
def test_code_groups(spark, name, group):
    assert spark.createDataFrame([(name,)], "s string").select(t.code_group(F.col("s"))).first()[0] == group


def test_hosts_lose_any_leading_w_and_dot(spark):
    urls = {"http://www.Example.com:80/x": "example.com:80", "https://web.com": "eb.com", "https://u@h.org/?a": "u@h.org", "no url": "", "//x": ""}
    rows = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {u: h for u, h in rows.select("u", t.url_host(F.col("u"))).collect()} == urls


def test_luhn_and_thai_id(spark):
    rows = spark.createDataFrame([("4111-1111-1111-1111",), ("4111111111111112",), ("0" * 16,), ("123",), ("1101700230708",)], "s string")
    got = rows.select("s", t.luhn_valid(F.col("s")), t.thai_id_valid(F.col("s"))).collect()
    assert [r[1] for r in got][:4] == [True, False, False, False]
    total = sum(int("110170023070"[i]) * (13 - i) for i in range(12))
    assert got[4][2] == ((11 - total % 11) % 10 == 8)


def test_turns_and_answers(spark):
    row = spark.createDataFrame([("  a ", "", "b", ["2) x", "1) y"], "1")], "i string, c string, o string, opts array<string>, ans string")
    got = row.select(t.render_turns(F.col("i"), F.col("c"), F.col("o")), t.answer_index(F.col("opts"), F.col("ans"))).first()
    assert tuple(got) == ("a\n\nb", 1)


def test_white_space_class_is_pythons():
    assert len(SPACES) == 29
    assert all(re.fullmatch(f"[{t.WS}]", c) for c in SPACES)
