"""WARC archives, index first: records are found by a table of file, offset, length, URL and digest, and read by
sorted byte ranges that are coalesced where they lie close.

Every record is a gzip member of its own. Of records with equal payloads the one with the largest page id is the
response; the others are revisit records that refer to it. Payloads below a size are always stored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_slices, partitions_for, shared_path, stored
from tessera.llm.files import attempt_name, coalesced, filesystem, make_dir

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
READ_GAP, READ_BYTES = 64 << 10, 8 << 20
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    http = _HTTP % len(payload)
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _record_id(page_id), "WARC-Date": date}
    if url is not None:
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head["WARC-Payload-Digest"] = f"sha1:{digest}"
    block = http if revisit else http + payload
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = _record_id(refers_to)
    head["Content-Type"] = "application/http;msgtype=response"
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(b"WARC/1.1\r\n" + lines.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def parse(member: bytes) -> dict:
    """page_id, url, type, refers_to, digest and size (both of the full payload) and payload (None for a revisit)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    page = lambda v: None if v in (None, "<urn:x-page:null>") else int(v[len("<urn:x-page:") : -1])
    out = {"page_id": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "type": fields["warc-type"], "refers_to": page(fields.get("warc-refers-to"))}
    if out["type"] == "revisit":
        size = int(re.search(rb"(?im)^content-length: (\d+)", http)[1])
        return out | {"payload": None, "size": size, "digest": fields["warc-payload-digest"].removeprefix("sha1:")}
    digest = hashlib.sha1(body).hexdigest()
    if fields["warc-payload-digest"] != f"sha1:{digest}":
        raise ValueError("the payload does not match its digest")
    return out | {"payload": body, "size": len(body), "digest": digest}


def write_warc(pages: DataFrame, out: str, min_revisit: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes a record for every row of pages to files in ``out`` and returns the index, a stored table.

    A null html is an empty payload; a null url gives a record without target; a null page id is written as such, never
    is the one referred to while its group has another, and a group of null ids alone is stored as responses. Rows that
    repeat the largest page id of a group are all responses. An empty table gives an empty index. Only the three named
    columns are read.
    """
    make_dir(out)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html").cast("long")})
    groups = rows.where(F.col("size") >= min_revisit).groupBy("digest", "size")
    leads = groups.agg(F.max("page_id").alias("lead"), F.count("*").alias("n")).where("n > 1 and lead is not null").drop("n")
    rows = rows.join(leads, ["digest", "size"], "left")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, folder = filesystem(out)
        stream, name, at, number = None, "", 0, 0
        try:
            for batch in batches:
                found = []
                for page_id, url, body, digest, lead in zip(batch["page_id"], batch["url"], batch["html"], batch["digest"], batch["lead"], strict=True):
                    page_id = None if pd.isna(page_id) else int(page_id)
                    lead = None if pd.isna(lead) else int(lead)
                    revisit = lead is not None and page_id != lead
                    if stream is None or at >= file_bytes:
                        if stream is not None:
                            stream.close()
                        name, at, number = attempt_name("pages", f"-{number}.warc.gz"), 0, number + 1
                        stream = where.open_output_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20)
                    member = record(page_id, url, body.encode("utf-8"), digest, lead, revisit)
                    stream.write(member)
                    found.append((f"{out}/{name}", at, len(member), page_id, url, digest, "revisit" if revisit else "response"))
                    at += len(member)
                yield pd.DataFrame(found, columns=[c.split()[0] for c in INDEX.split(", ")]).astype({"page_id": "Int64"})
        finally:
            if stream is not None:
                stream.close()

    return stored(map_slices(rows.select("page_id", "url", "html", "digest", "lead"), write, INDEX, rows=500), "warc-index")


def read_warc(index: DataFrame, with_payload: bool = True, gap: int = READ_GAP, most: int = READ_BYTES) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of the index rows given.

    The rows are sorted by file and offset; neighbours at most ``gap`` bytes apart share a read of up to ``most`` bytes.
    A revisit's payload is null.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, part in batch.groupby("file", sort=False):
                where, path = filesystem(file)
                part = part.sort_values("offset")
                with where.open_input_file(path) as stream:
                    for begin, end, group in coalesced(zip(part["offset"].tolist(), part["length"].tolist(), part["url"].tolist(), strict=True), gap, most):
                        data = stream.read_at(end - begin, begin)
                        found = []
                        for offset, length, url in group:
                            r = parse(data[offset - begin : offset - begin + length])
                            found.append((r["page_id"], url, r["size"], r["digest"], r["type"], r["refers_to"], *([r["payload"]] if with_payload else [])))
                        yield pd.DataFrame(found, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    names = [c.split()[0] for c in schema.split(", ")]
    n = partitions_for(index, F.col("length"))
    some = index.select("file", "offset", "length", "url").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    return map_slices(some, read, schema, rows=10_000)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    index = write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_path(spark, "warc"))
    return read_warc(index, with_payload=False).drop("url")


def oracle() -> str:
    return f"""
WITH rows AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
sized AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM rows),
led AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS lead FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id < lead THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id < lead THEN lead END AS refers_to
FROM led
"""
