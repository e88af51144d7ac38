import hashlib
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import media


def want(text):
    data = (text or "").encode()
    full = data + b" " * (192 - len(data) % 192 if len(data) % 192 or not data else 0)
    image = media.encode_png(full, len(data))
    assert media.decode_png(image) == (full, len(data))
    return (len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]), len(image), hashlib.sha256(image).hexdigest(), media.feature(full))


def test_query_is_an_exact_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r[0]: tuple(r)[1:] for r in media.op5_media(spark, sf).collect()}
    assert got == {d.doc_id: want(d.text) for d in docs}


def test_ranges_cover_each_member_once(spark, tmp_path):
    texts = [None, "", "x", "y" * 191, "z" * 192, "é" * 96, "ü" * 97, "long " * 20_000]
    rows = [(i, t, "p") for i, t in enumerate(texts)] + [(None, "no id", "p"), (3, "again", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, payload string").repartition(2)
    path = f"file://{tmp_path}/m"
    assert media.write_media(docs, path, archive_bytes=3000) >= 3
    for size in (512, 700, 1 << 20):
        got = media.media_features(media.read_media(spark, path, range_bytes=size)).collect()
        assert sorted((str(r.doc_id), bytes(r.samples).rstrip(b" ").decode()) for r in got) == sorted((str(i), (t or "").rstrip(" ")) for i, t, _ in rows)
    for name in tmp_path.glob("m/*.tar"):
        with tarfile.open(name) as t:
            assert all(m.name.endswith(".png") for m in t.getmembers())
    assert media.write_media(docs.where(F.lit(False)), f"file://{tmp_path}/e") == 0
    assert media.read_media(spark, f"file://{tmp_path}/e").count() == 0


def test_one_bad_member_costs_one_row(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string").coalesce(1)
    path = f"file://{tmp_path}/m"
    media.write_media(docs, path)
    first = next(tmp_path.glob("m/*.tar"))
    data = bytearray(first.read_bytes())
    offset = media.read_media(spark, path).orderBy("offset").collect()[2].offset
    data[offset : offset + 512] = bytes(512)
    first.write_bytes(data)
    rows = media.read_media(spark, path, wait_s=0).orderBy("offset").collect()
    assert [r.error is None for r in rows] == [True, True, False, True, True]


def test_damaged_images_are_found():
    image = media.encode_png(b"a" * 192, 5)
    for bad in (image[:-13], image[1:], image.replace(b"IDAT", b"IDAX")):
        with pytest.raises((ValueError, AttributeError)):
            media.decode_png(bad)
