"""SentencePiece encoding by Gumbel top-k without replacement, and decoding.

Segmentations of a text are paths through its piece lattice. Each has a perturbed log-probability (its own plus Gumbel
noise), and the k largest are k distinct draws without replacement. They are found best first, as in A* sampling: the
maximum over all paths is drawn at once, and its path exactly; what is left falls into the sets of paths that leave it
at each of its edges, every set with the maximum of its own, drawn from a Gumbel truncated at the maximum above it; the
best set is opened next, and so on. The largest value not taken, kappa, gives each path's inclusion score.

All randomness is a hash of the seed, the row's key and the place in the search: a row's draws do not depend on
the rows around it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_slices
from tessera.llm.lattice import Lattice, Vocabulary
from tessera.llm.spans import mix

MODEL = "piece_bpe_32k.model"
SEED = 53
ALPHA = 0.5
K = 2
#: Characters whose lattices are held at once; a longer text is taken alone.
BATCH_CHARS = 1 << 16
#: Characters whose rows are handed on in one frame.
FRAME_CHARS = 1 << 22
DIGESTS = ("n_pieces", "ids_crc32", "decoded_sha256")
_U = np.uint64
_loaded: dict = {}


def _vocabulary(path: str, alpha: float) -> Vocabulary:
    if (path, alpha) not in _loaded:
        _loaded[path, alpha] = Vocabulary(path, alpha)
    return _loaded[path, alpha]


def _uniform(key: np.ndarray, stream: int, a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Uniform in (0, 1) for each (key, stream, a, b)."""
    x = mix(key + _U(stream * 0x9E3779B97F4A7C15 % 2**64))
    x = mix(x ^ (np.asarray(a).astype(_U) * _U(0xC2B2AE3D27D4EB4F) + np.asarray(b).astype(_U)))
    return ((x >> _U(11)).astype(np.float64) + 0.5) / 2.0**53


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _truncated(free: float, top: float) -> float:
    """A Gumbel value, drawn freely, given that it is at most top; -inf for -inf. It grows with the free one."""
    with np.errstate(over="ignore"):
        return -np.inf if np.isneginf(free) else float(-np.logaddexp(-top, -free))


def _walk(lattice: Lattice, nodes: np.ndarray, keys: np.ndarray, units: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws from each node to its unit's end: the edges in order, and which start each belongs to."""
    active, now = np.arange(len(nodes)), nodes
    done = lattice.last[now]
    active, now = active[~done], now[~done]
    edges, owners, step = [], [], 0
    while len(active):
        edge = lattice.draw(now, _uniform(keys[active], stream, units[active], step))
        edges.append(edge)
        owners.append(active)
        now, step = lattice.end[edge], step + 1
        go = ~lattice.last[now]
        active, now = active[go], now[go]
    if not edges:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge, owner = np.concatenate(edges), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return edge[order], owner[order]


class _Round:
    """One new path of each of some texts: its edges from where it leaves the path it forks from, in one array.

    ``open`` holds, for each edge, the largest value, drawn freely, among paths that go with this one up to it, and no
    further; truncated at this path's value it is their perturbed one, in the same order. position: of a text's first new edge in its whole path; before: the log-probability up to there.
    """

    def __init__(self, lattice: Lattice, number: int, docs: np.ndarray, edges: np.ndarray, units: np.ndarray, owner: np.ndarray, position: np.ndarray, before: np.ndarray, value: np.ndarray, barred: list[list[int]], keys: np.ndarray):
        self.docs, self.edges, self.units, self.position, self.value, self.barred = docs, edges, units, position, value, barred
        self.bounds = np.searchsorted(owner, np.arange(len(docs) + 1))
        first = self.bounds[:-1]
        steps = lattice.log_p[edges]
        sums = np.concatenate([[0.0], np.cumsum(steps)])
        at = sums[:-1] - (sums[first] - before)[owner]
        self.at = at
        self.log_p = sums[self.bounds[1:]] - sums[first] + before
        away = 1 - lattice.p[edges]
        node = lattice.begin[edges]
        others = lattice.head[node + 1] - lattice.head[node] - 1
        for i in np.flatnonzero([bool(x) for x in barred]).tolist():
            away[first[i]] -= lattice.p[barred[i]].sum()
            others[first[i]] -= len(barred[i])
        mass = np.where((others <= 0) | (away <= 0), -np.inf, at + np.log(np.maximum(away, 1e-300)))
        place = np.arange(len(edges)) - (first - position)[owner]
        self.open = mass + _gumbel(_uniform(keys[docs[owner]], number, place, 1 << 40))
        self.best = np.full(len(docs), -np.inf)
        self.where = np.zeros(len(docs), np.int64)
        full = np.flatnonzero(np.diff(self.bounds) > 0)
        if len(full):
            self.best[full] = np.maximum.reduceat(self.open, first[full])
            top = np.flatnonzero(self.open == self.best[owner])
            self.where[owner[top[::-1]]] = top[::-1]
        self.row = {d: i for i, d in enumerate(docs.tolist())}

    def top(self, i: int) -> float:
        """The best open value of text i."""
        return _truncated(self.best[i], self.value[i])

    def take(self, i: int) -> tuple[float, int]:
        """The best open value of text i and its place; the next best takes its stead."""
        value, k = self.top(i), int(self.where[i])
        self.open[k] = -np.inf
        a, z = self.bounds[i], self.bounds[i + 1]
        self.where[i] = a + int(self.open[a:z].argmax())
        self.best[i] = self.open[self.where[i]]
        return value, k


def _sample(texts: list[str], keys: np.ndarray, vocabulary: Vocabulary, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k (ids, log-probability, perturbed value, inclusion score), largest value first."""
    lattice = Lattice(texts, vocabulary)
    n = len(texts)
    n_units = np.bincount(lattice.doc, minlength=n)
    first_unit = np.cumsum(n_units) - n_units
    rank = np.arange(len(lattice.doc)) - first_unit[lattice.doc]
    tops = _gumbel(_uniform(keys, 0, np.zeros(n, np.int64), 1 << 41))
    edges, owner = _walk(lattice, lattice.root, keys[lattice.doc], rank, 1)
    zeros = np.zeros(n)
    rounds = [_Round(lattice, 1, np.arange(n), edges, rank[owner] if len(owner) else owner, lattice.doc[owner] if len(owner) else owner, zeros.astype(np.int64), zeros, tops, [[]] * n, keys)]
    ids = [_Ids(lattice, vocabulary, edges)]
    # Of each text its paths so far: (ids, log-probability, value).
    out: list[list] = [[(ids[0].part(a, z), p, v)] for a, z, p, v in zip(rounds[0].bounds[:-1], rounds[0].bounds[1:], rounds[0].log_p.tolist(), tops.tolist(), strict=True)]
    starts: list[dict[int, np.ndarray]] = [{}]
    for number in range(2, k + 1):
        forks = []
        for d in range(n):
            if len(out[d]) < number - 1:
                continue
            mine = [r for r in range(len(rounds)) if d in rounds[r].row]
            r = mine[0] if len(mine) == 1 else max(mine, key=lambda r: rounds[r].top(rounds[r].row[d]))
            source, i = rounds[r], rounds[r].row[d]
            if np.isneginf(source.best[i]):
                continue
            value, at = source.take(i)
            head = int(source.bounds[i])
            edge = int(source.edges[at])
            barred = [edge, *(source.barred[i] if at == head else [])]
            node = int(lattice.begin[edge])
            options = [e for e in range(int(lattice.head[node]), int(lattice.head[node + 1])) if e not in barred]
            share = np.cumsum(lattice.p[options])
            forks.append((d, r, i, at, value, barred, options, share))
        if not forks:
            break
        docs, places = np.array([f[0] for f in forks]), np.array([f[3] for f in forks])
        position = np.array([rounds[r].position[i] + at - rounds[r].bounds[i] for _, r, i, at, *_ in forks])
        draws = _uniform(keys[docs], number, position, 1 << 42)
        forced = np.array([o[min(int(np.searchsorted(s, u * s[-1], side="right")), len(o) - 1)] for (*_, o, s), u in zip(forks, draws.tolist(), strict=True)])
        unit = np.array([rounds[r].units[at] for _, r, _, at, *_ in forks])
        # One walk for the rests of all texts: the forked unit from its new edge on, and all units after it.
        counts = n_units[docs] - unit
        which = np.repeat(np.arange(len(forks)), counts)
        begin = np.cumsum(counts) - counts
        u = np.arange(counts.sum()) - begin[which] + unit[which]
        nodes = lattice.root[first_unit[docs[which]] + u]
        nodes[begin] = lattice.end[forced]
        edges, owner = _walk(lattice, nodes, keys[docs[which]], u, number)
        fork_of = which[owner] if len(owner) else owner
        # The forced edges go before what follows them.
        ahead = np.searchsorted(fork_of, np.arange(len(forks)))
        edges = np.insert(edges, ahead, forced)
        units = np.insert(u[owner] if len(owner) else owner, ahead, unit)
        fork_of = np.insert(fork_of, ahead, np.arange(len(forks)))
        before = np.array([rounds[r].at[at] for _, r, _, at, *_ in forks])
        values = np.array([f[4] for f in forks])
        new = _Round(lattice, number, docs, edges, units, fork_of, position, before, values, [f[5] for f in forks], keys)
        made = _Ids(lattice, vocabulary, edges)
        starts.append({})
        for j, (d, r, i, at, value, *_) in enumerate(forks):
            lead = ids[r].part(int(rounds[r].bounds[i]), at)
            if r:
                lead = np.concatenate([starts[r][d], lead])
            starts[-1][d] = lead
            out[d].append((np.concatenate([lead, made.part(int(new.bounds[j]), int(new.bounds[j + 1]))]), float(new.log_p[j]), value))
        rounds.append(new)
        ids.append(made)
    done = []
    for d, some in enumerate(out):
        kappa = max((r.top(r.row[d]) for r in rounds if d in r.row), default=-np.inf) if len(some) == k else -np.inf
        with np.errstate(over="ignore"):
            done.append([(x, p, v, 1.0 if np.isneginf(kappa) else float(-np.expm1(-np.exp(p - kappa)))) for x, p, v in some])
    return done


class _Ids:
    """The piece ids of many edges, with bytes in the place of edges that no piece has."""

    def __init__(self, lattice: Lattice, vocabulary: Vocabulary, edges: np.ndarray):
        pieces = lattice.piece[edges]
        bare = np.flatnonzero(pieces < 0)
        counts = np.ones(len(pieces), np.int64)
        if len(bare):
            codes, which = np.unique(pieces[bare], return_inverse=True)
            spelled = [vocabulary.byte_id[list(chr(-c - 1).encode("utf-8", "surrogatepass"))] for c in codes.tolist()]
            counts[bare] = np.array([len(x) for x in spelled])[which]
        self.at = np.concatenate([[0], np.cumsum(counts)])
        self.ids = np.repeat(pieces, counts).astype(np.int32)
        if len(bare):
            self.ids[self.ids < 0] = np.concatenate([spelled[w] for w in which.tolist()])

    def part(self, a: int, z: int) -> np.ndarray:
        return self.ids[self.at[a] : self.at[z]]


def row_key(seed: int, key: int | None, text: str, turn: int = 0) -> int:
    """64 bits of seed, row key and turn; a row without a key is known by its text. Turn 0 is that of a row without turns."""
    data = text.encode("utf-8", "surrogatepass") if key is None else int(key).to_bytes(8, "little", signed=True)
    return xxhash.xxh64_intdigest(data + (turn.to_bytes(8, "little") if turn else b""), seed)


def sample_encode(
    docs: DataFrame, k: int = K, seed: int = SEED, alpha: float = ALPHA, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), digest: bool = False, batch_chars: int = BATCH_CHARS, turn_col: str | None = None
) -> DataFrame:
    """(doc_id, sample, ids, log_prob, perturbed, inclusion[, kept columns]): up to k distinct segmentations of every whole text.

    ``sample`` counts from 0 in falling order of the perturbed value; a text of fewer segmentations than k gives them
    all, with inclusion 1. A null or empty text has one segmentation, of no pieces. Rows that repeat an id draw from the same
    stream (equal texts, equal draws), unless ``turn_col`` names a column of small whole numbers that tells them apart (null: 0); rows
    without an id are keyed by their text. Any character is encoded, by bytes
    where no piece has it. An empty table gives no rows. ``keep`` names columns carried along; others are not read.

    With ``digest`` the ids stay in the worker that drew them: in their place come n_pieces, ids_crc32 (of the ids as
    little-endian 32-bit integers) and decoded_sha256 (of the text that they decode to). ``batch_chars`` trades memory for time: more texts
    share one lattice of their units.
    """
    path = model_file or public_tokenizers.path(MODEL)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = _vocabulary(path, alpha)
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"].tolist()]
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            turns = batch["_turn"].tolist() if turn_col else [0] * len(ids)
            keys = np.array([row_key(seed, i, t, n) for i, t, n in zip(ids, texts, turns, strict=True)], dtype=_U)
            carried = batch.drop(columns=["text", "_turn"] if turn_col else "text")
            at, rows, held = 0, [], 0
            while at < len(texts):
                upto, load = at + 1, len(texts[at])
                while upto < len(texts) and load + len(texts[upto]) <= batch_chars:
                    load += len(texts[upto])
                    upto += 1
                for i, some in enumerate(_sample([f" {t}" if t else "" for t in texts[at:upto]], keys[at:upto], vocabulary, k), at):
                    rows += [(i, n, *(_digests(x, vocabulary) if digest else (x,)), *scores) for n, (x, *scores) in enumerate(some)]
                at, held = upto, held + load
                if at == len(texts) or held > FRAME_CHARS:
                    frame = pd.DataFrame(rows, columns=["row", "sample", *(DIGESTS if digest else ("ids",)), "log_prob", "perturbed", "inclusion"])
                    yield pd.concat([carried.iloc[frame["row"]].reset_index(drop=True), frame.drop(columns="row")], axis=1)
                    rows, held = [], 0

    turn = [F.coalesce(F.col(turn_col).cast("int"), F.lit(0)).alias("_turn")] if turn_col else []
    carried = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.col(c).alias(f"kept_{c}") for c in keep], *turn, F.col(text_col).alias("text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields if f.name not in ("_turn", "text"))
    what = "n_pieces long, ids_crc32 long, decoded_sha256 string" if digest else "ids array<int>"
    return map_slices(carried, encode, f"{head}, sample int, {what}, log_prob double, perturbed double, inclusion double", rows=1000)


def _digests(ids: np.ndarray, vocabulary: Vocabulary) -> tuple[int, int, str]:
    return len(ids), zlib.crc32(ids.astype("<i4").tobytes()), hashlib.sha256(decode_ids(ids.tolist(), vocabulary).encode("utf-8")).hexdigest()


def decode_ids(ids, vocabulary: Vocabulary) -> str:
    """The text of some ids: pieces and bytes joined, without the space put before a text; stray bytes become U+FFFD."""
    table = vocabulary.bytes_
    data = b"".join(map(table.__getitem__, ids))
    return data.removeprefix(b" ").decode("utf-8", "replace")


def decode(ids, model_file: str | None = None):
    """A string column: the text of an array column of ids; null for null."""
    path = model_file or public_tokenizers.path(MODEL)

    @F.pandas_udf(T.StringType())
    def texts(column: pd.Series) -> pd.Series:
        vocabulary = _vocabulary(path, ALPHA)
        return pd.Series([None if x is None else decode_ids(x.tolist(), vocabulary) for x in column], dtype=object)

    return texts(ids)


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sample_encode(docs, digest=True)
