"""Scalar functions of texts as Column expressions; Python only where Spark has no built-in (normal forms)."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The 29 characters that count as white space, for a Java character class.
WS = r"\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same for RE2.
SQL_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

HELDOUT_BUCKETS = 100
HELDOUT = (0,)


def _normal_form(form: str):
    @F.pandas_udf(T.StringType())
    def normal(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else unicodedata.normalize(form, t) for t in texts], dtype=object)

    # Marked so that the optimizer never makes two calls of one: a text is put in form once a query.
    return normal.asNondeterministic()


def normal_form(text: Column, form: str) -> Column:
    """The text in a Unicode normal form. ASCII rows reach Python as nulls only: they are in every form already."""
    return F.coalesce(_normal_form(form)(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def hashed_text(text: str | None) -> str | None:
    """normalise() in Python, for workers that hold the text already."""
    return None if text is None else " ".join(unicodedata.normalize("NFC", text).split())


def search_text(text: str | None) -> str | None:
    """search_form() in Python."""
    return None if text is None else " ".join(unicodedata.normalize("NFKC", text).lower().split())


def digest_of(text: str | None) -> str | None:
    """doc_hash() of one text."""
    return None if text is None else hashlib.sha256(hashed_text(text).encode("utf-8", "surrogatepass")).hexdigest()


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none at either end."""
    return F.trim(F.regexp_replace(text, f"[{WS}]+", " "))


def normalise(text: Column) -> Column:
    """The form that is hashed: NFC, collapsed white space."""
    return collapse(normal_form(text, "NFC"))


def search_form(text: Column) -> Column:
    """The form in which n-grams are compared: NFKC, lower case, collapsed white space."""
    return collapse(F.lower(normal_form(text, "NFKC")))


@F.pandas_udf(T.StringType())
def _digest(texts: pd.Series) -> pd.Series:
    return pd.Series([digest_of(t) for t in texts], dtype=object)


def doc_hash(text: Column) -> Column:
    """SHA-256 of normalise(text); a text is read once and only its digest comes back from the worker."""
    return _digest.asNondeterministic()(text)


def hash_number(digest: Column) -> Column:
    """The first 32 bits of a hex digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def bucket(digest: Column) -> Column:
    return hash_number(digest) % HELDOUT_BUCKETS


def is_heldout(digest: Column, buckets=HELDOUT) -> Column:
    """Held-out documents are known by their hash alone, so every stage can tell them without a list."""
    return bucket(digest).isin(*buckets)


def in_sample(digest: Column, rate: int) -> Column:
    return hash_number(digest) % rate == 0


def script_ratio(text: Column, chars: str) -> Column:
    """Share of characters in a class such as ``A-z``; 0 for an empty text."""
    # What is left when runs of others go: regexp_count would hold a string for each character that it counts.
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(text, f"[^{chars}]+", "")) / F.length(text))


def licence_key(value: Column) -> Column:
    return F.translate(F.lower(F.trim(F.coalesce(value.cast("string"), F.lit("")))), "_", "-")


#: Licences of code, and of instruction data, that may be used.
CODE_LICENCES = ("mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause")
INSTRUCTION_LICENCES = ("cc-by-sa-4.0", "cc-by-4.0", "apache-2.0", "mit", "cc0-1.0")


def instruction_licence_allowed(value: Column) -> Column:
    """Known licences only, and none whose name holds ``nc``; no licence allows nothing."""
    key = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return ~key.contains("nc") & ~key.contains("non-commercial") & key.isin(*INSTRUCTION_LICENCES)


#: Groups of programming languages by normalised name.
CODE_GROUPS = {
    "python": ["python"],
    "javascript_typescript": ["javascript", "typescript"],
    "java": ["java"],
    "c_cpp": ["c", "c++", "cpp"],
    "csharp": ["csharp", "cs"],
    "markdown": ["markdown"],
    "html": ["html"],
    "css_config": ["css", "makefile", "dockerfile", "yaml", "yml", "toml", "cmake", "json", "xml", "ini", "hcl", "nix", "gradle", "properties"],
}
CSHARP_SPELLINGS = ("c#", "c sharp", "c-sharp")


def language_key(value: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), rf"[{WS}_.#-]+", "")


def code_group(value: Column) -> Column:
    out = F.when(F.lower(F.trim(value)).isin(*CSHARP_SPELLINGS), F.lit("csharp"))
    for group, names in CODE_GROUPS.items():
        out = out.when(language_key(value).isin(*names), F.lit(group))
    return out.otherwise(F.lit("long_tail"))


def url_host(url: Column) -> Column:
    """The network location in lower case without any leading run of ``w`` and ``.`` (so ``web.com`` gives ``eb.com``)."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)), r"^[w.]+", "")


def render_turns(*parts: Column) -> Column:
    """Trimmed parts that are not empty, parted by a blank line."""
    return F.concat_ws("\n\n", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def luhn_valid(value: Column) -> Column:
    """13 to 19 digits, not all the same, with a valid check digit; other characters are passed over."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.length(digits).between(13, 19) & (F.size(F.array_distinct(F.split(digits, ""))) > 1) & F.call_function("luhn_check", digits)


def thai_id_valid(value: Column) -> Column:
    """13 digits, the first not 0, the last a weighted check digit of the others."""
    digit = lambda i: F.substring(value, i + 1, 1).cast("int")
    total = sum((digit(i) * (13 - i) for i in range(1, 12)), digit(0) * 13)
    return F.when(value.rlike("^[1-9][0-9]{12}$"), (11 - total % 11) % 10 == digit(12)).otherwise(False)


def answer_index(options: Column, answer: Column) -> Column:
    """The option an answer names, from 0: by the number it begins with, else by position; -1 if none."""
    key = F.trim(F.coalesce(answer, F.lit("")))
    number = F.when(key.rlike("^[0-9]{1,9}$"), key.cast("int"))
    leading = F.transform(options, lambda o: F.regexp_extract(o, rf"^[{WS}]*([0-9]+)", 1))
    named = F.array_position(leading, key)
    return F.when(number.isNull(), -1).when(named > 0, named - 1).when(number.between(1, F.size(options)), number - 1).otherwise(-1).cast("int")


def complete_options(options: Column, answer: Column, keys: Column) -> Column:
    return F.forall(options, lambda o: F.coalesce(F.trim(o), F.lit("")) != "") & F.array_contains(keys, F.trim(answer))


def licence_plain(value: Column) -> Column:
    """The held-out sets' form of a licence: trimmed and lower case, underscores left alone."""
    return F.lower(F.trim(F.coalesce(value.cast("string"), F.lit(""))))


def preview(text: Column, most: int = 400) -> Column:
    """The first characters of a text, for reading."""
    return F.substring(text, 1, most)


def spec_hash(spec: object) -> str:
    """SHA-256 of a specification as JSON with sorted keys and no spaces, so that equal ones hash alike."""
    return hashlib.sha256(json.dumps(spec, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
