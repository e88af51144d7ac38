"""Removal of repeated passages over a compacted De Bruijn graph of word k-mers.

The edges of the graph are the windows of k words. Every window belongs to the least-hashed m-mer within it, and
consecutive windows of one such m-mer form a path (k to k + 15 words) that travels as one row: a 128-bit BLAKE2 of its
words, and the coordinate (document, first word) at which it stands. The paths are dealt by their m-mer:

* of equal paths only the one at the first coordinate stays; the others repeat, and keep its coordinate as their source;
* an m-mer whose first paths are all one path does not branch, and nothing more can repeat in it;
* where several different paths share an m-mer the graph branches; only there are paths opened into single windows,
  by a join with their texts, and of equal windows the one at the first coordinate stays.

Repeated edges compact: those that follow each other both in their document and in their source are one long span. Joins by
source coordinate then verify every span: the SHA-256 of its words is taken at both places, and a span whose two
differ ends the job instead of removing words that do not repeat.

Rows of one m-mer that repeat within an Arrow batch are settled before the shuffle, and an m-mer with many
different paths in a batch is dealt by path instead and marked as branching, so no m-mer gathers in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, map_slices, partitions_for, stored
from tessera.llm.spans import Words, pieces

K = 20
#: Words in the m-mer that places a window; K - M + 1 must be a power of two.
M = 5
#: Different paths of one m-mer in a batch from which the m-mer counts as branching at once.
HOT_PATHS = 8
#: Spans of one source document that are verified in one row; a source of more is dealt to several.
SPANS_PER_ROW = 4096

PATH, HOT, MARK, REPEAT = 0, 1, 2, 3
_NO_PATH = np.iinfo(np.int64).min
#: A place: first word, then five bits for the number of windows.
_N_BITS = 5
_N_MASK = (1 << _N_BITS) - 1
_COORDINATE = ("doc", "tag", "place")
_PATH_KEY = ("deal", "one", "two", *_COORDINATE)
_REPEATS = "doc long, tag long, place long, branch boolean, source_doc long, source_tag long, source_start long"


class UnverifiedSpan(ValueError):
    """A span does not hold the words of its source."""


def _starts_new(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any column; true for the first."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _keys(words: Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """128-bit keys, as two columns of longs, of the words first to last (included)."""
    line, make = words.line, hashlib.blake2b
    raw = b"".join([make(line[s:e], digest_size=16).digest() for s, e in zip(words.starts[first].tolist(), words.ends[last].tolist(), strict=True)])
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


def _paths(ids: np.ndarray, tags: np.ndarray, texts: list) -> list[np.ndarray]:
    """(m-mer, one, two, doc, tag, place) of all paths of some texts."""
    out: list[tuple[np.ndarray, ...]] = []
    for rows, offsets, words in pieces(texts, K - 1):
        n = len(words.starts)
        if n < K:
            continue
        at = np.arange(n - M + 1)
        value = words.span(at, at + M - 1)
        least, where, step = value, at, 1
        while step < K - M + 1:
            later = least[step:] < least[:-step]
            least = np.where(later, least[step:], least[:-step])
            where = np.where(later, where[step:], where[:-step])
            step *= 2
        line = np.repeat(np.arange(len(rows)), np.diff(words.first))
        window = np.flatnonzero(line[: n - K + 1] == line[K - 1 :])
        if not len(window):
            continue
        of = where[window]
        begin = np.flatnonzero(_starts_new(of))
        first, last = window[begin], window[np.append(begin[1:], len(window)) - 1]
        owner = line[first]
        start = first - words.first[owner] + offsets[owner]
        key = _keys(words, first, last + K - 1)
        row = rows[owner]
        out.append((value[of[begin]].view(np.int64), key[:, 0], key[:, 1], ids[row], tags[row], (start << _N_BITS) | (last - first + 1)))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 6


def _emit_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = _paths(batch["doc"].to_numpy(np.int64), batch["tag"].to_numpy(np.int64), batch["text"].tolist())
        if not len(found[0]):
            continue
        order = np.lexsort(found[::-1])
        mmer, one, two, doc, tag, place = (x[order] for x in found)
        new_mmer = _starts_new(mmer)
        first = _starts_new(mmer, one, two)
        hot = np.bincount(np.cumsum(new_mmer) - 1, weights=first)[np.cumsum(new_mmer) - 1] >= HOT_PATHS
        # Repeats are settled here; they are only carried on, spread by document.
        lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        keep = first | (doc != doc[lead]) | (tag != tag[lead]) | (place != place[lead])
        marks = mmer[new_mmer & hot]
        none = np.zeros(len(marks), np.int64)
        columns = {
            "deal": (marks, np.where(first, np.where(hot, one, mmer), doc * 0x9E3779B1 + (place >> 9))),
            "one": (none + _NO_PATH, np.where(first, one, doc[lead])),
            "two": (none + _NO_PATH, np.where(first, two, tag[lead])),
            "doc": (none, doc),
            "tag": (none, tag),
            "place": (none, place),
            # Of a repeat its source's first word.
            "source": (none, np.where(first, 0, place[lead] >> _N_BITS)),
            "kind": (none + MARK, np.where(first, np.where(hot, HOT, PATH), REPEAT)),
        }
        made = pd.DataFrame({name: np.concatenate([mark, rest[keep]]) for name, (mark, rest) in columns.items()})
        yield made.astype({"kind": np.int8})


def _settle_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (deal, path, coordinate), marks first: what repeats, with its source, and the first paths that branch.

    Between batches it keeps one path, one coordinate and at most one waiting row.
    """
    deal0 = path0 = lead0 = waiting = None
    open0 = False  # the current group is known to branch

    def out(coordinate, branch: bool, source=None):
        doc, tag, place = coordinate
        none = np.zeros(len(doc), np.int64)
        source = source or (none, none, none)
        return pd.DataFrame({"doc": doc, "tag": tag, "place": place, "branch": branch, "source_doc": source[0], "source_tag": source[1], "source_start": source[2]})

    for batch in batches:
        done = batch["kind"].to_numpy() == REPEAT
        if done.any():
            some = [batch[c].to_numpy(np.int64)[done] for c in (*_COORDINATE, "one", "two", "source")]
            yield out(some[:3], False, tuple(some[3:]))
            batch = batch[~done]
        if not len(batch):
            continue
        deal, one, two, doc, tag, place, kind = (batch[c].to_numpy(np.int64) for c in (*_PATH_KEY, "kind"))
        at = np.arange(len(deal))
        new, first = _starts_new(deal), _starts_new(deal, one, two)
        if deal0 is not None and deal[0] == deal0:
            new[0] = False
            first[0] = (one[0], two[0]) != path0
        mark = kind == MARK
        lead = np.maximum.accumulate(np.where(first, at, -1))
        inside = lead >= 0
        leads = [np.where(inside, x[lead], old) for x, old in zip((doc, tag, place), lead0 or (0, 0, 0), strict=True)]
        again = ~first & ~mark & ~((doc == leads[0]) & (tag == leads[1]) & (place == leads[2]))
        if again.any():
            yield out((doc[again], tag[again], place[again]), False, (leads[0][again], leads[1][again], leads[2][again] >> _N_BITS))
        chosen = first & ~mark
        group = np.cumsum(new)  # 0: continues the group of the batch before
        n = int(group[-1]) + 1
        opened = np.bincount(group, weights=mark | (kind == HOT), minlength=n) > 0
        count = np.bincount(group, weights=chosen, minlength=n)
        if not new[0]:
            opened[0] |= open0
            count[0] += waiting is not None
        branch = opened | (count >= 2)
        if waiting is not None:
            if not new[0] and branch[0]:
                yield out(waiting, True)
            if new[0] or branch[0]:
                waiting = None
            # else: the group of one path goes on, or ends below
        show = chosen & branch[group]
        if show.any():
            yield out((doc[show], tag[show], place[show]), True)
        last = n - 1
        if last > 0:
            waiting = None
        open0 = bool(branch[last])
        if not open0:
            mine = np.flatnonzero(chosen & (group == last))
            if len(mine):
                waiting = (doc[mine], tag[mine], place[mine])
        deal0, path0 = deal[-1], (one[-1], two[-1])
        lead0 = tuple(x[-1] for x in leads)


def _emit_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The single windows of the branching paths of each text; repeats within a batch are settled here, and name their source."""
    for batch in batches:
        found = []
        docs, tags, lists = batch["doc"].to_numpy(np.int64), batch["tag"].to_numpy(np.int64), batch["places"].tolist()
        for rows, offsets, words in pieces(batch["text"].tolist(), K - 1):
            for i, row in enumerate(rows):
                place = np.asarray(lists[row], dtype=np.int64)
                start, n = place >> _N_BITS, place & _N_MASK
                starts = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                local = starts - offsets[i]
                mine = (local >= 0) & (local + K <= words.first[i + 1] - words.first[i])
                local, starts = local[mine] + words.first[i], starts[mine]
                if len(local):
                    key = _keys(words, local, local + K - 1)
                    found.append((key[:, 0], key[:, 1], np.full(len(local), docs[row]), np.full(len(local), tags[row]), starts))
        if not found:
            continue
        found = [np.concatenate(x) for x in zip(*found, strict=True)]
        order = np.lexsort(found[::-1])
        one, two, doc, tag, start = (x[order] for x in found)
        first = _starts_new(one, two)
        lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        keep = first | (doc != doc[lead]) | (tag != tag[lead]) | (start != start[lead])
        # A repeat is dealt by its own coordinate, beside no other window.
        frame = {"one": np.where(first, one, doc), "two": np.where(first, two, start), "doc": doc, "tag": tag, "start": start, "again": ~first}
        frame |= {"lead_doc": doc[lead], "lead_tag": tag[lead], "lead_start": start[lead]}
        yield pd.DataFrame({name: x[keep] for name, x in frame.items()})


def _digest(words: list[bytes], start: int, length: int) -> bytes:
    return hashlib.sha256(b" ".join(words[start : start + length])).digest()


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _source_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each span that a source document is asked for the SHA-256 of its words."""
    for batch in batches:
        rows = []
        for doc, tag, text, spans in zip(batch["doc"], batch["tag"], batch["text"], batch["spans"], strict=True):
            words = _words(text)
            rows += [(doc, tag, s["start"], s["length"], _digest(words, s["start"], s["length"])) for s in spans]
        yield pd.DataFrame(rows, columns=["source_doc", "source_tag", "source_start", "length", "digest"])


def _cut(batches: Iterator[pd.DataFrame], layout: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text, found in zip(batch["doc_id"], batch["text"], batch["found"], strict=True):
            words = _words(text)
            depth = np.zeros(len(words) + 1, np.int64)
            for s in found if found is not None else ():
                if _digest(words, s["start"], s["length"]) != s["digest"]:
                    raise UnverifiedSpan(f"document {doc}, words {s['start']} and {s['length']} on")
                depth[s["start"]] += 1
                depth[s["start"] + s["length"]] -= 1
            gone = np.cumsum(depth)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
            left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if spans else words
            kept = text or "" if layout and not spans else b" ".join(left).decode("utf-8", "surrogatepass")
            rows.append((len(words), len(words) - len(left), kept, spans))
        made = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept", "spans"])
        yield pd.concat([batch.drop(columns=["text", "found"]).reset_index(drop=True), made], axis=1)


def _compacted(repeats: DataFrame) -> DataFrame:
    """(doc, tag, start, length, source_doc, source_tag, source_start): repeated edges glued to spans, lengths in words.

    An edge goes on where the one before it in its document ends, if its source goes on there as well.
    """
    along = Window.partitionBy("doc", "tag").orderBy("start", "source_doc", "source_tag", "source_start")
    source = F.struct("source_doc", "source_tag", F.col("start") - F.col("source_start"))
    before = F.lag(F.struct(source.alias("source"), (F.col("start") + F.col("n")).alias("end"), F.col("start").alias("start"))).over(along)
    marked = repeats.withColumns({"before": before, "source": source})
    goes_on = (F.col("before.source") == F.col("source")) & ((F.col("before.end") == F.col("start")) | (F.col("before.start") == F.col("start")))
    marked = marked.withColumn("run", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(along))
    spans = marked.groupBy("doc", "tag", "run").agg(
        F.min("start").alias("start"),
        (F.max(F.col("start") + F.col("n")) - F.min("start") + (K - 1)).alias("length"),
        *[F.min(c).alias(c) for c in ("source_doc", "source_tag", "source_start")],
    )
    return spans.drop("run")


def _verified(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, tag, found): each document's spans with the digest that their source coordinates have."""
    key = ["source_doc", "source_tag", "source_start", "length"]
    asked = spans.select(*key).distinct()
    many = F.count("*").over(Window.partitionBy("source_doc", "source_tag"))
    rows = F.ceil(many / SPANS_PER_ROW)
    asked = asked.withColumn("row", F.pmod(F.xxhash64("source_start", "length"), rows))
    asked = asked.groupBy(F.col("source_doc").alias("doc"), F.col("source_tag").alias("tag"), "row").agg(F.collect_list(F.struct(F.col("source_start").alias("start"), "length")).alias("spans"))
    digests = map_slices(texts.join(asked.drop("row"), ["doc", "tag"]), _source_digests, "source_doc long, source_tag long, source_start long, length long, digest binary", rows=500)
    # Rows that repeat both id and text give one digest twice.
    digests = digests.groupBy(*key).agg(F.min("digest").alias("digest"))
    # A left join: a source that no row has cannot be verified, and fails as any other.
    found = spans.join(digests, key, "left")
    return found.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "length", F.coalesce("digest", F.lit(b"")).alias("digest"))).alias("found"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), layout: bool = False) -> DataFrame:
    """(doc_id[, kept columns], n_words, n_removed, kept, spans) of every row; kept: its words joined by single spaces, without
    those in windows of K words that also start earlier; spans: the word ranges [start, end) removed.

    Windows are judged on the input. A null text is an empty one. Null ids come before all others. Rows that repeat both id and text are one
    document and get equal results; rows that repeat an id with other texts are documents in the order of a
    64-bit hash of their text. Texts of fewer than K words lose nothing. An empty table gives no rows. ``keep`` names
    columns carried along as kept_<name>; others are not read. With ``layout`` a text that loses nothing is left as it is.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_PATH))
    again = not docs.groupBy(doc.alias("doc")).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        doc.alias("doc"),
        (F.xxhash64(text) if again else F.lit(0).cast("long")).alias("tag"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
        text.alias("text"),
    )
    paths = map_slices(rows.select("doc", "tag", "text"), _emit_paths, "deal long, one long, two long, doc long, tag long, place long, source long, kind byte")
    dealt = paths.repartition(partitions_for(docs, F.octet_length(text)), "deal").sortWithinPartitions(*_PATH_KEY)
    found = stored(map_slices(dealt, _settle_paths, _REPEATS, rows=1 << 20, gather=20_000), "paths")
    branching = found.where("branch").groupBy("doc", "tag").agg(F.collect_list("place").alias("places"))
    # All columns, needed or not: so all joins read the one exchange of the texts.
    windows = map_slices(rows.join(branching, ["doc", "tag"]), _emit_windows, "one long, two long, doc long, tag long, start long, again boolean, lead_doc long, lead_tag long, lead_start long")
    # A key has a row for each Arrow batch that holds it, at most; the first of them is the source of the others.
    order = Window.partitionBy("again", "one", "two").orderBy("doc", "tag", "start")
    leads = F.struct(*[F.col(f"lead_{c}").alias(c) for c in ("doc", "tag", "start")])
    source = F.when(F.col("again"), leads).otherwise(F.first(F.struct("doc", "tag", "start")).over(order))
    later = windows.withColumn("source", source).where("source.doc <> doc or source.tag <> tag or source.start <> start")
    names = ["doc", "tag", "start", "n", "source_doc", "source_tag", "source_start"]
    wide = found.where("not branch").select("doc", "tag", F.shiftright("place", _N_BITS).alias("start"), F.col("place").bitwiseAND(F.lit(_N_MASK)).alias("n"), *names[4:])
    single = later.select("doc", "tag", "start", F.lit(1).cast("long").alias("n"), *[F.col(f"source.{c}").alias(f"source_{c}") for c in ("doc", "tag", "start")])
    # One exchange of the edges, read by both sides of the verification.
    spans = _compacted(wide.unionByName(single).repartition("doc", "tag"))
    full = rows.join(_verified(spans, rows), ["doc", "tag"], "left").drop("doc", "tag")
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.schema.fields if f.name not in ("text", "found"))
    return map_slices(full, partial(_cut, layout=layout), f"{head}, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>", rows=500)


def op4_substring(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """Windows one by one, for documents of different ids."""
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + {K - 1}], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - {K - 2})) AS i FROM d)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {K})) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
