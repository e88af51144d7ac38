"""Media columns: images in archives, read by a data source of Spark's Python API.

Archives are uncompressed tar files with a sidecar of member offsets; ``_manifest.json`` lists those that count. The
source plans byte ranges over the archives of a directory; a range owns the members whose headers begin in it, hands
their bytes on in Arrow batches, and retries each member by its own offset, so that one bad read costs one member.
"""

from __future__ import annotations

import json
import struct
import tarfile
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.llm.common import SQL_CRC, map_slices, shared_path, stored
from tessera.llm.files import attempt_name, filesystem, make_dir

WIDTH = 192
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 32 << 20
#: Ranges that are planned at most, beside one for each archive.
MAX_RANGES = 100_000
BATCH_BYTES = 4 << 20
BLOCK = 512
_MAGIC = b"\x89PNG\r\n\x1a\n"
_ENTRY = np.dtype([("offset", "<u8"), ("data", "<u8"), ("length", "<u8")])


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, n_bytes: int, level: int = 1) -> bytes:
    """An 8-bit greyscale image of WIDTH columns whose samples are the payload; n_bytes is kept as a text chunk."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return b"".join((_MAGIC, _chunk(b"IHDR", head), _chunk(b"tEXt", b"n_bytes\0%d" % n_bytes), _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)), _chunk(b"IEND", b"")))


def decode_png(data: bytes) -> tuple[bytes, int]:
    """(payload, n_bytes) of an image of encode_png; a damaged one raises ValueError."""
    if data[:8] != _MAGIC:
        raise ValueError("no PNG signature")
    at, parts, text, head = 8, [], b"", None
    while at < len(data):
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        if len(data) < at + 12 + n or zlib.crc32(kind + body) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            raise ValueError(f"damaged chunk {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"tEXt":
            text = body
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit greyscale image")
    try:
        lines = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(head[1], head[0] + 1)
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if lines[:, 0].any():
        raise ValueError("filtered rows")
    return lines[:, 1:].tobytes(), int(text.removeprefix(b"n_bytes\0"))


def padded(text: str | None) -> tuple[bytes, int]:
    """The text's UTF-8 bytes with spaces up to a positive multiple of WIDTH, and how many there were before."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b" " * ((-len(data)) % WIDTH if data else WIDTH), len(data)


def feature(payload: bytes) -> str:
    """Height, sum, sum of squares, number of steps along rows, distinct samples and mode of the image."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    counts = np.bincount(image.reshape(-1), minlength=256)
    level = np.arange(256)
    steps = int(np.count_nonzero(image[:, 1:] != image[:, :-1]))
    return f"h{len(image)} s{int(counts @ level)} q{int(counts @ (level * level))} e{steps} d{int((counts > 0).sum())} m{int(counts.argmax())}"


def write_media(docs: DataFrame, out: str, archive_bytes: int = ARCHIVE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Writes each row's text as an image member named by its id to archives in ``out``; returns their number.

    A null text is an empty one; a null id gives a member named ``null``; rows that repeat an id are members of
    their own. Archives of lost attempts are not in the manifest and so are never read.
    """
    make_dir(out)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, folder = filesystem(out)
        stream, entries, at, number, name = None, [], 0, 0, ""

        def close():
            stream.write(b"\0" * (2 * BLOCK))
            stream.close()
            with where.open_output_stream(f"{folder}/{name}.idx") as side:
                side.write(np.array(entries, dtype=_ENTRY).tobytes())
            return pd.DataFrame({"name": [name], "bytes": [at], "members": [len(entries)]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if stream is not None and at >= archive_bytes:
                    yield close()
                    stream = None
                if stream is None:
                    name, entries, at, number = attempt_name("media", f"-{number}.tar"), [], 0, number + 1
                    stream = where.open_output_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20)
                image = encode_png(*padded(text))
                info = tarfile.TarInfo("null.png" if pd.isna(doc_id) else f"{int(doc_id)}.png")
                info.size = len(image)
                head = info.tobuf(tarfile.USTAR_FORMAT)
                stream.write(head + image + b"\0" * (-len(image) % BLOCK))
                entries.append((at, at + len(head), len(image)))
                at += len(head) + len(image) + -len(image) % BLOCK
        if stream is not None:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    archives = stored(map_slices(rows, write, "name string, bytes long, members long"), "media-archives")
    # One entry an archive of archive_bytes, not one a row.
    listed = sorted((r.asDict() for r in archives.collect()), key=lambda r: r["name"])
    where, folder = filesystem(out)
    with where.open_output_stream(f"{folder}/_manifest.json") as stream:
        stream.write(json.dumps(listed).encode())
    return len(listed)


@dataclass
class ByteRange(InputPartition):
    """Bytes [begin, end) of an archive."""

    archive: str
    begin: int
    end: int


class MediaArchives(DataSource):
    """``spark.read.format("media_archives").load(directory)``: (member, offset, payload, error).

    Options: range_bytes, the size of a planned byte range; attempts, reads of a member before its row says in
    ``error`` why it has no payload; wait_s, seconds before the second attempt, doubled for each that follows.
    """

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return "member string, offset long, payload binary, error string"

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options)


class MediaReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", 3))
        self.wait_s = float(options.get("wait_s", 0.2))

    def partitions(self) -> list[ByteRange]:
        where, folder = filesystem(self.path)
        listed = json.loads(where.open_input_stream(f"{folder}/_manifest.json").read())
        # The driver holds one entry a range: over many archives ranges grow, their number does not.
        size = max(self.range_bytes, -(-sum(r["bytes"] for r in listed) // MAX_RANGES))
        ranges = [ByteRange(r["name"], at, min(at + size, r["bytes"])) for r in listed for at in range(0, r["bytes"], size)]
        return ranges or [ByteRange("", 0, 0)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.archive:
            return
        where, folder = filesystem(self.path)
        path = f"{folder}/{part.archive}"
        entries = self._entries(where, f"{path}.idx", part)
        stream, rows, load = None, [], 0
        for offset, data, length in entries.tolist():
            payload, member, error = None, None, None
            for attempt in range(self.attempts):
                try:
                    if stream is None:
                        stream = where.open_input_file(path)
                    member, payload = self._member(stream, offset, data, length)
                    error = None
                    break
                except (OSError, ValueError, tarfile.TarError) as e:
                    stream, error = None, f"{type(e).__name__}: {e}"
                    if attempt + 1 < self.attempts:
                        time.sleep(self.wait_s * 2**attempt)
            rows.append((member, offset, payload, error))
            load += length
            if load >= BATCH_BYTES:
                yield self._batch(rows)
                rows, load = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _entries(where, path: str, part: ByteRange) -> np.ndarray:
        """The members whose headers begin in the range, found by bisection in the sorted sidecar."""
        with where.open_input_file(path) as side:
            n = side.size() // _ENTRY.itemsize

            def first(bound: int) -> int:
                low, high = 0, n
                while low < high:
                    mid = (low + high) // 2
                    offset = np.frombuffer(side.read_at(_ENTRY.itemsize, mid * _ENTRY.itemsize), _ENTRY)["offset"][0]
                    low, high = (mid + 1, high) if offset < bound else (low, mid)
                return low

            a, b = first(part.begin), first(part.end)
            return np.frombuffer(side.read_at((b - a) * _ENTRY.itemsize, a * _ENTRY.itemsize), _ENTRY)

    @staticmethod
    def _member(stream, offset: int, data: int, length: int) -> tuple[str, bytes]:
        raw = stream.read_at(data - offset + length, offset)
        if len(raw) != data - offset + length:
            raise OSError("short read")
        info = tarfile.TarInfo.frombuf(raw[:BLOCK], "utf-8", "surrogateescape")
        if info.size != length:
            raise ValueError("the header and the index differ in length")
        return info.name, raw[data - offset :]

    @staticmethod
    def _batch(rows: list) -> pa.RecordBatch:
        member, offset, payload, error = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(member, pa.string()), pa.array(offset, pa.int64()), pa.array(payload, pa.binary()), pa.array(error, pa.string())], names=["member", "offset", "payload", "error"])


def read_media(spark, path: str, **options) -> DataFrame:
    """(member, offset, payload, error) of every member of the archives of a directory."""
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").options(**{k: str(v) for k, v in options.items()}).load(path)


def media_features(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, samples, feature, payload) of stored images; payload is the stored form; one that stays unreadable ends the job."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for member, data, error in zip(batch["member"], batch["payload"], batch["error"], strict=True):
                if error is not None:
                    raise OSError(f"member {member}: {error}")
                payload, n_bytes = decode_png(data)
                stem = member.removesuffix(".png")
                rows.append((None if stem == "null" else int(stem), n_bytes, payload, feature(payload)))
            made = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "samples", "feature"]).astype({"doc_id": "Int64"})
            yield made.assign(payload=batch["payload"].to_numpy())

    return map_slices(media.select("member", "payload", "error"), decode, "doc_id long, n_bytes long, samples binary, feature string, payload binary", rows=500)


def op5_media(spark, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "media")
    write_media(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    found = media_features(read_media(spark, path))
    return found.select(
        "doc_id",
        "n_bytes",
        F.octet_length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -16, 16)).alias("tail_crc32"),
        F.octet_length("payload").cast("long").alias("media_bytes"),
        F.sha2("payload", 256).alias("media_sha256"),
        "feature",
    )


def media_payloads(spark, sf_dir: str) -> DataFrame:
    """The columns of op5_media that do not hang on the image format, for plain SQL."""
    return op5_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")


def payload_oracle() -> str:
    return f"""
WITH {SQL_CRC.strip()}, d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, n, text || repeat(' ', CASE WHEN n = 0 THEN {WIDTH} ELSE ({WIDTH} - n % {WIDTH}) % {WIDTH} END) AS payload FROM d),
h AS (SELECT doc_id, n, payload, right(hex(encode(payload)), 32) AS tail FROM p)
SELECT doc_id, n::BIGINT AS n_bytes, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_sha256,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(tail, '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS tail_crc32 FROM h, crc_step
"""
