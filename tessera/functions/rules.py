"""Ordered rules: the first that holds names why a row is dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.shared import stored


def first_rule(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds; null if none does (a rule that is null does not hold)."""
    out = None
    for name, test in rules:
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def pattern_rules(text: Column, patterns: Mapping[str, str], prefix: str = "") -> list[tuple[str, Column]]:
    return [(prefix + name, text.rlike(pattern)) for name, pattern in patterns.items()]


#: Topic and spam patterns of the Thai web pools; cleaning, then the audit's own.
THAI_SPAM = {
    "gambling": r"(?iu)บาคาร่า|คาสิโน|สล็อต|แทงบอล|เว็บพนัน|ufabet|สมัครสมาชิก[^\n]{0,30}เครดิตฟรี|ฝากถอน[^\n]{0,20}ออโต้|เครดิตฟรี",
    "lottery": r"หวย|เลขเด็ด|ตรวจสลากกินแบ่ง|เลขท้าย[^\n]{0,10}ตัว",
    "adult": r"(?iu)หนังโป๊|คลิปหลุด|หีสวย|xxx[\t-\r\x1c-\x20\x85\u00a0]*ไทย",
}
THAI_AUDIT = {
    "gambling": THAI_SPAM["gambling"],
    "lottery": THAI_SPAM["lottery"],
    "adult": r"(?iu)หนังโป๊|คลิปหลุด|หีสวย|เย็ด|xxx[\t-\r\x1c-\x20\x85\u00a0]*ไทย",
    "seo_spam": r"(?iu)รับทำ[\t-\r\x1c-\x20]*seo|โปรโมทเว็บ|ซื้อขาย[\t-\r\x1c-\x20]*backlink|รับจ้างเขียนบทความ",
    "boilerplate": r"ข้ามไปยังเนื้อหา|เมนูหลัก|ลิขสิทธิ์[^\n]{0,20}สงวนไว้|คุกกี้[^\n]{0,30}ยอมรับ",
}


def matched_terms(text: Column, pattern: str, most: int = 5) -> Column:
    """The first different matches of a pattern, sorted."""
    return F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))), 1, most)


def mark_repeats(df: DataFrame, key: str, order: str, among: Column, out: str) -> DataFrame:
    """Adds out: true for rows of ``among`` whose key an earlier row of ``among`` has (order must be unique).

    The first of each key comes from an aggregate that combines before the shuffle, so one key of very many rows is
    one row by the time it meets the others. The rows are written first: each side reads the columns it needs from that
    table, and what df computes (often from whole texts) is computed once.
    """
    rows = stored(df.withColumn("_among", F.coalesce(among, F.lit(False))), "marked")
    first = rows.where("_among").groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    joined = rows.join(first, rows[key] == first["_key"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_among") & (F.col(order) > F.col("_first")), F.lit(False))).drop("_key", "_first", "_among")
