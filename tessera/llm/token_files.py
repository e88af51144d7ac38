"""Token ids in length-delimited binary records, with an offset index beside each file.

A record is: length (uint64), masked CRC-32 of these eight bytes (uint32), body, masked CRC-32 of the body (uint32), all
little-endian. A body is: document id (int64), flags (uint8: 1 if the id is null), bytes per token id (uint8: 2
or 4), ids. ``<file>.idx`` holds the offset of every record (uint64), for reads in any order. The mask is
rotate-right by 15 plus 0xA282EAD8 modulo 2**32, so that checksums of data that hold checksums stay apart.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, map_slices, partitions_for, shared_path, stored
from tessera.llm.files import attempt_name, filesystem, make_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
READ_BYTES = 8 << 20
#: A file's bytes, and those of a run of records that one reader takes.
FILE_BYTES = 512 << 20
STRETCH_BYTES = 32 << 20
STRETCHES_PER_TASK = 4
#: Characters that are encoded at once; longer texts are cut at white space.
ENCODE_CHARS = 4 << 20
STRETCHES = "part int, stretch int, file string, index_file string, begin long, end long, first_record long, n_docs long, n_tokens long"
_HEAD, _BODY = struct.Struct("<QI"), struct.Struct("<qBB")


class CorruptRecord(ValueError):
    """A record's length or body does not match its checksum, or the file ends within it."""


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    length = struct.pack("<Q", len(body))
    return b"".join((length, struct.pack("<I", masked_crc(length)), body, struct.pack("<I", masked_crc(body))))


def frames(stream) -> Iterator[bytes]:
    """The bodies of all records of a binary stream, each checked."""
    buffer, at = b"", 0

    def need(n: int) -> bool:
        nonlocal buffer, at
        if len(buffer) - at < n:
            buffer, at = buffer[at:] + stream.read(max(READ_BYTES, n)), 0
        while len(buffer) < n:
            more = stream.read(n - len(buffer))
            if not more:
                return False
            buffer += more
        return True

    while need(_HEAD.size):
        length, crc = _HEAD.unpack_from(buffer, at)
        if masked_crc(buffer[at : at + 8]) != crc:
            raise CorruptRecord("length")
        if not need(_HEAD.size + length + 4):
            raise CorruptRecord("end of file")
        body = buffer[at + _HEAD.size : at + _HEAD.size + length]
        if masked_crc(body) != struct.unpack_from("<I", buffer, at + _HEAD.size + length)[0]:
            raise CorruptRecord("body")
        at += _HEAD.size + length + 4
        yield body
    if len(buffer) > at:
        raise CorruptRecord("end of file")


def pack(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return _BODY.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def unpack(body: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = _BODY.unpack_from(body)
    return None if null else doc_id, np.frombuffer(body, f"<u{width}", offset=_BODY.size)


#: The pattern of pre-tokenizers that end a piece wherever an ASCII letter or digit meets an ASCII mark.
MARK_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _ALNUM, _UPPER, _MARK, _OPENS = 1, 2, 4, 8, 16
#: First byte of U+00C0 to U+00FF, which are letters but for two whose second byte is 0x97 or 0xB7; capitals come 0x20 before small ones.
LATIN_LEAD = 0xC3
_WHITE = re.compile(f"[{ASCII_SPACE.decode()}]")


def _flags(marks: bool, lower: bool) -> np.ndarray:
    """What each byte is: white space, letter or digit, capital to lower, mark, mark that no letter after it can belong to."""
    flags = np.zeros(256, np.uint8)
    flags[list(ASCII_SPACE)] = _SPACE
    for c in range(33, 127) if marks else ():
        flags[c] = _ALNUM if chr(c).isalnum() else _MARK if c == ord("'") else _MARK | _OPENS
    for c in range(ord("A"), ord("Z") + 1) if lower else ():
        flags[c] |= _UPPER
    return flags


def _rules(setup: dict) -> tuple[bool, bool]:
    """Whether words may be cut at marks, and lowered, before a tokenizer of this setup sees them.

    A cut between an ASCII mark and a letter or digit (ASCII, or one of LATIN_LEAD) is one that MARK_PATTERN makes too, unless the
    mark is an apostrophe with a letter after it; no normal form joins the two. NFC joins a letter to combining marks alone.
    """

    def steps(part: str, inner: str) -> list[dict]:
        whole = setup.get(part) or {}
        return whole[inner] if whole.get("type") == "Sequence" else [whole] if whole else []

    normal, cut = steps("normalizer", "normalizers"), steps("pre_tokenizer", "pretokenizers")
    marks = (
        all(n["type"] in ("NFC", "Lowercase") or (n["type"], n.get("pattern"), n.get("content")) == ("Replace", {"Regex": r"\s+"}, " ") for n in normal)
        and [c["type"] for c in cut] == ["Split", "ByteLevel"]
        and (cut[0]["pattern"], cut[0]["behavior"], cut[0]["invert"]) == ({"Regex": MARK_PATTERN}, "Removed", True)
        and not cut[1]["add_prefix_space"]
        and not cut[1]["use_regex"]
        and all(t["content"].isascii() and not (t["normalized"] or t["lstrip"] or t["rstrip"]) for t in setup["added_tokens"])
    )
    return marks, marks and any(n["type"] == "Lowercase" for n in normal)


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts to encode at once: ENCODE_CHARS characters, or one text of more."""
    begin = held = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > begin and held + n > ENCODE_CHARS:
            yield begin, i
            begin, held = i, 0
        held += n
    if texts:
        yield begin, len(texts)


def _stretches(text: str) -> Iterator[str]:
    """A text's stretches of ENCODE_CHARS characters and what is left of the word that they end in."""
    begin = 0
    while begin < len(text):
        found = _WHITE.search(text, begin + ENCODE_CHARS)
        end = found.start() if found else len(text)
        yield text[begin:end]
        begin = end


class WordEncoder:
    """Encodes texts through the ids of their words, each of which the tokenizer sees once while the table has room.

    Valid for tokenizers whose pieces never reach across ASCII white space and that drop it, as this one's. Where the tokenizer's
    own rules allow it (_rules), words are cut at ASCII marks and lowered first, so that ``Word,`` and ``(word`` are one entry
    beside their marks; texts that hold an added token, in whatever case, keep their words whole. New words are
    encoded many to a line and told apart by their places in it; beyond max_words they are encoded anew each time.
    """

    LINE = 64

    def __init__(self, path: str, max_words: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.max_words = Tokenizer.from_file(path), max_words
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        setup = json.loads(self.tokenizer.to_str())
        self.marks, self.lower = _rules(setup)
        self.flags = _flags(self.marks, self.lower)
        self.added = [t["content"].lower().encode("utf-8") for t in setup["added_tokens"]]
        self.number: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.at = np.zeros(1, np.int64)

    def _ids_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some words, and how many each word has."""
        plain = [w.decode("utf-8") for w in words]
        lines = [plain[i : i + self.LINE] for i in range(0, len(plain), self.LINE)]
        found = self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)
        # Places in all lines, each of which has one character more than its words and the spaces between them.
        ends = np.cumsum([len(w) + 1 for w in plain])
        sizes = [len(got.ids) for got in found]
        ids = np.fromiter(chain.from_iterable(got.ids for got in found), np.uint32, sum(sizes))
        starts = np.fromiter(chain.from_iterable(chain.from_iterable(got.offsets for got in found)), np.int64, 2 * len(ids))[::2]
        starts = starts + np.repeat(np.append(0, ends)[: len(plain) : self.LINE], sizes)
        return ids, np.bincount(np.searchsorted(ends, starts, side="right"), minlength=len(plain))

    def _words(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and how many of them lie before the end of each text."""
        lines = [(t or "").encode("utf-8") for t in texts]
        # A space after each text: it ends the last word, and the first one's left neighbour is the last byte.
        joined = b" ".join([*lines, b""])
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(x) + 1 for x in lines])
        flags = self.flags[data]
        if self.marks:
            leads = np.flatnonzero(data == LATIN_LEAD)
            trails = data[leads + 1]
            leads, trails = leads[trails & 0xDF != 0x97], trails[trails & 0xDF != 0x97]
            flags[leads] |= _ALNUM
            flags[leads + 1] |= np.where(trails < 0x9F, _ALNUM | (_UPPER if self.lower else 0), _ALNUM).astype(np.uint8)
            folded = joined.lower()
            for i in range(len(lines)) if any(a in folded for a in self.added) else ():
                begin = ends[i] - len(lines[i]) - 1
                if any(folded.find(a, begin, ends[i]) >= 0 for a in self.added):
                    flags[begin : ends[i]] &= _SPACE
        inside = (flags & _SPACE) == 0
        before = np.roll(flags, 1)
        # Flags of a byte met with those of the byte before it: the first of a word, a mark after a letter, a letter after a mark.
        first = inside & ((before & _SPACE) != 0)
        if self.marks:
            first |= ((before & _ALNUM) << 2) & flags != 0
            first |= ((before & _OPENS) >> 3) & flags != 0
        if self.lower:
            # What follows is ASCII or one of the letters above: a capital before a combining mark is the tokenizer's to compose.
            after = np.roll(data, -1)
            capital = ((flags & _UPPER) != 0) & ((after < 128) | (after == LATIN_LEAD))
            data = data | (capital.view(np.uint8) << 5)
        n_inside = np.cumsum(inside)
        starts = np.flatnonzero(first)
        offsets = np.append(n_inside[starts] - 1, n_inside[-1:]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        return words, np.searchsorted(starts, ends)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out = []
        for a, b in _runs(texts):
            if b - a == 1 and len(texts[a] or "") > ENCODE_CHARS:
                out.append(np.concatenate([self._encode([part])[0] for part in _stretches(texts[a])]))
            else:
                out.extend(self._encode(texts[a:b]))
        return out

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        words, upto = self._words(texts)
        found = words.dictionary_encode()
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        ids, at = self.ids, self.at
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            more, counts = self._ids_of(new)
            first = len(at) - 1
            ids, at = np.concatenate([ids, more]), np.concatenate([at, at[-1] + np.cumsum(counts)])
            codes[missing] = np.arange(first, first + len(new))
            if first + len(new) <= self.max_words:
                self.ids, self.at = ids, at
                self.number.update(zip(new, range(first, first + len(new)), strict=True))
        places = found.indices.to_numpy()
        begin, size = at[codes][places], (at[codes + 1] - at[codes])[places]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.repeat(begin - (ends - size), size) + np.arange(total)]
        cuts = np.where(upto > 0, ends[np.maximum(upto - 1, 0)] if len(ends) else 0, 0)
        return np.split(flat, cuts[:-1])


_encoders: dict[str, WordEncoder] = {}


def encoder_for(path: str) -> WordEncoder:
    """One encoder a worker process: what a task has learned serves the next."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_tokens(
    docs: DataFrame, out: str, tokenizer_path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES, stretch_bytes: int = STRETCH_BYTES
) -> DataFrame:
    """Writes every row of docs in ascending order of id to files in ``out``; returns the table of their stretches.

    (part, stretch, file, index_file, begin, end, first_record, n_docs, n_tokens, first_doc, first_token): a stretch is a run of
    records of one file, bytes begin to end, of about stretch_bytes; files roll at file_bytes. Parts and stretches ascend with
    the ids. A null text is an empty one and holds the end id alone; null ids come first; rows that repeat an id are all written,
    ordered by a hash of their text. An empty table writes no records. Only the two named columns are read.
    """
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    make_dir(out)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        where, folder = filesystem(out)
        encoder, part = encoder_for(path), TaskContext.get().partitionId()
        stream, name, number, stretch = None, "", 0, 0
        offsets: list[int] = []
        at = begin = first = n_tokens = 0

        def end_stretch() -> pd.DataFrame:
            nonlocal stretch, begin, first, n_tokens
            row = (part, stretch, f"{out}/{name}", f"{out}/{name}.idx", begin, at, first, len(offsets) - first, n_tokens)
            stretch, begin, first, n_tokens = stretch + 1, at, len(offsets), 0
            return pd.DataFrame([row], columns=[c.split()[0] for c in STRETCHES.split(", ")])

        def end_file() -> None:
            stream.close()
            with where.open_output_stream(f"{folder}/{name}.idx") as side:
                side.write(np.array(offsets, "<u8").tobytes())

        try:
            for batch in batches:
                ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
                texts = batch["text"].tolist()
                for a, b in _runs(texts):
                    for doc_id, tokens in zip(ids[a:b], encoder.encode(texts[a:b]), strict=True):
                        if stream is None:
                            name, number, offsets, at = attempt_name("tokens", f"-{number}.rec"), number + 1, [], 0
                            begin = first = 0
                            stream = where.open_output_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20)
                        record = frame(pack(doc_id, np.append(tokens, end_id), encoder.width))
                        stream.write(record)
                        offsets.append(at)
                        at += len(record)
                        n_tokens += len(tokens) + 1
                        if at - begin >= stretch_bytes or at >= file_bytes:
                            yield end_stretch()
                        if at >= file_bytes:
                            end_file()
                            stream = None
            if stream is not None:
                end_file()
                stream = None
                if n_tokens:
                    yield end_stretch()
        finally:
            if stream is not None:
                stream.close()

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = F.col("doc_id").asc_nulls_first()
    dealt = rows.repartitionByRange(partitions_for(docs, F.octet_length(text)), order).sortWithinPartitions(order, F.xxhash64("text"))
    found = stored(map_slices(dealt, write, STRETCHES), "token-files")
    # One row a stretch of STRETCH_BYTES: a window over all of them is small beside the corpus.
    before = Window.partitionBy().orderBy("part", "stretch").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumns({f"first_{k}": F.coalesce(F.sum(f"n_{k}s").over(before), F.lit(0)).cast("long") for k in ("doc", "token")})


def _read_stretches(files: DataFrame, make, rows_at_once: int, ddl: str) -> DataFrame:
    """The rows that make(body, number of the document, its first token) gives for every record, stretch by stretch."""
    names = [c.split()[0] for c in ddl.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for f in batch.itertuples():
                where, path = filesystem(f.file)
                rows, held, number, start = [], 0, f.first_doc, f.first_token
                with where.open_input_file(path) as stream:
                    for body in frames(stream.get_stream(f.begin, f.end - f.begin)):
                        doc_id, ids = unpack(body)
                        rows.append(make(doc_id, ids, number, start))
                        number, start, held = number + 1, start + len(ids), held + len(ids)
                        if len(rows) >= rows_at_once or held > 1 << 20:
                            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    stretches = stored(files.select("file", "begin", "end", "first_doc", "first_token"), "stretches")
    n = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stretches.count() // STRETCHES_PER_TASK))
    return map_slices(stretches.repartition(n), read, ddl)


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, position, start, ids) of every record of the stretches that write_tokens returned."""
    return _read_stretches(files, lambda doc_id, ids, number, start: (doc_id, number, start, ids.astype("<u4")), 20_000, "doc_id long, position long, start long, ids array<long>")


def read_digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, without handing the ids on."""
    return _read_stretches(files, lambda doc_id, ids, number, start: (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), 20_000, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_at(file: str, index_file: str, numbers: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """The records of the given numbers of one file, in the order asked for, found by the offset index."""
    where, path = filesystem(index_file)
    offsets = np.frombuffer(where.open_input_file(path).read(), "<u8")
    where, path = filesystem(file)
    out = []
    with where.open_input_file(path) as stream:
        for k in numbers:
            stream.seek(int(offsets[k]))
            length, _ = _HEAD.unpack(head := stream.read(_HEAD.size))
            if masked_crc(head[:8]) != _HEAD.unpack(head)[1]:
                raise CorruptRecord("length")
            body, crc = stream.read(length), stream.read(4)
            if masked_crc(body) != struct.unpack("<I", crc)[0]:
                raise CorruptRecord("body")
            out.append(unpack(body))
    return out


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_digests(write_tokens(docs, shared_path(spark, "tokens")))
