"""Piece lattices of many texts at once, as flat numpy arrays.

A text is cut where no piece reaches across: before a space that follows something else, around line feeds, and in units
that are long by themselves wherever no piece of the vocabulary matches across the place. No other cut is made, so a
run that pieces cover without a gap is one unit, however long; its memory is about 350 bytes a character. Each different unit of a batch has its lattice built once: a node a character, an edge a piece, byte fallback where no
piece matches. Backward sums over a node's edges give the probability of an edge once its node is reached, so walking from
left to right draws a segmentation exactly.
"""

from __future__ import annotations

import numpy as np

from tessera.llm.spans import mix, powers

_U = np.uint64
#: Characters up to which a unit's backward sums cannot underflow; longer ones are looked through for gaps.
LONG_UNIT = 24
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Sums:
    """Prefix sums over code points: the hash of any stretch of them."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        values = mix(points.astype(_U) + _U(1)) * powers(_BASE, self.n)[: self.n]
        self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * powers(_BACK, self.n)[start]


class Vocabulary:
    """The pieces of a SentencePiece model as edges: piece i weighs -alpha * log(2 + rank of i) in nats."""

    def __init__(self, model_file: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.vocab_size()
        self.bytes_: list[bytes] = [b""] * n
        self.byte_id = np.zeros(256, np.int32)
        by_length: dict[int, list[tuple[str, int]]] = {}
        ranks = np.zeros(n)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.bytes_[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain = piece.replace("▁", " ")
                self.bytes_[i] = plain.encode("utf-8")
                by_length.setdefault(len(plain), []).append((plain, i))
                ranks[i] = max(-model.get_score(i), 0) if model.get_score(i) > -1e8 else n
        self.weight = -alpha * np.log(2 + np.minimum(ranks, n))
        self.byte_weight = -alpha * float(np.log(2 + n))
        self.longest = max(by_length)
        self.tables = {}
        longer: list[str] = [p for some in by_length.values() for p, _ in some]
        for length in range(1, self.longest + 1):
            some = by_length.get(length, [])
            points = code_points("".join(p for p, _ in some))
            at = np.arange(len(some)) * length
            one = Sums(points).of(at, at + length)
            order = np.argsort(one)
            longer = [p for p in longer if len(p) > length]
            heads = code_points("".join(sorted({p[:length] for p in longer})))
            at = np.arange(0, len(heads), length)
            # Bit 0: a piece of this length may hash so; bit 1: so may the beginning of a longer one.
            maybe = np.zeros(1 << 20, np.uint8)
            maybe[_slot(one)] |= 1
            maybe[_slot(Sums(heads).of(at, at + length))] |= 2
            ends = points.reshape(-1, length)[order][:, [0, -1]]
            # Of each slot the place of its first piece in the order of hashes.
            first = np.concatenate([[0], np.cumsum(np.bincount(_slot(one), minlength=1 << 20))]).astype(np.int32 if len(some) >= 1 << 15 else np.int16)
            self.tables[length] = (one[order], ends, np.array([i for _, i in some], np.int32)[order], maybe, first)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(44)).astype(np.int64)


def _matches(points: np.ndarray, left: np.ndarray, v: Vocabulary):
    """(length, places, pieces) of all pieces that match, by rising length; none reaches over the left characters of a place."""
    one = Sums(points)
    at = np.arange(len(points))
    for length in range(1, v.longest + 1):
        at = at[left[at] >= length]
        if not len(at):
            return
        hashes, ends, ids, maybe, first = v.tables[length]
        h = one.of(at, at + length)
        slot = _slot(h)
        what = maybe[slot]
        some = np.flatnonzero(what & 1)
        if len(some):
            wanted, k = h[some], first[slot[some]].astype(np.int64)
            later = np.flatnonzero(hashes[k] < wanted)
            while len(later):
                k[later] += 1
                later = later[(k[later] < len(hashes) - 1) & (hashes[np.minimum(k[later], len(hashes) - 1)] < wanted[later])]
            k = np.minimum(k, len(hashes) - 1)
            hit = hashes[k] == wanted
            some, k = some[hit], k[hit]
            hit = (ends[k, 0] == points[at[some]]) & (ends[k, 1] == points[at[some] + length - 1])
            yield length, at[some[hit]], ids[k[hit]]
        at = at[(what & 2) > 0]


def _inside(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all characters of some units in a row: the unit and the place in it."""
    unit = np.repeat(np.arange(len(size)), size)
    return unit, np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)


def _gaps(points: np.ndarray, start: np.ndarray, size: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The places within some units that no piece reaches across: every segmentation has an end there."""
    unit, offset = _inside(start, size)
    place = start[unit] + offset
    across = np.zeros(len(place) + 1, np.int64)
    for length, here, _ in _matches(points[place], size[unit] - offset, v):
        if length > 1:
            across[here + 1] += 1
            across[here + length] -= 1
    return place[(np.cumsum(across[:-1]) == 0) & (offset > 0)]


class Lattice:
    """The lattices of the units of some texts.

    Of unit occurrence u of all texts: root[u] is its first node and doc[u] its text. Of edge e: begin[e], end[e], piece[e]
    (below 0: the bytes of code point -piece[e] - 1), p[e]. last[node] says whether a node ends its unit.
    Edges of a node are head[node] to head[node + 1] - 1.
    """

    def __init__(self, texts: list[str], vocabulary: Vocabulary):
        lines = [code_points(t) for t in texts]
        sizes = np.array([len(x) for x in lines], np.int64)
        points = np.concatenate([*lines, np.zeros(0, np.uint32)])
        first = np.cumsum(sizes) - sizes
        n = len(points)
        cut = np.zeros(n + 1, bool)
        cut[first[sizes > 0]] = True
        if n:
            space, feed = points == 32, points == 10
            cut[1:n] |= (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
        start = np.flatnonzero(cut[:n])
        size = np.diff(np.append(start, n))
        if len(size) and size.max() > LONG_UNIT:
            start = np.union1d(start, _gaps(points, start[size > LONG_UNIT], size[size > LONG_UNIT], vocabulary))
            size = np.diff(np.append(start, n))
        self.doc = np.searchsorted(first, start, side="right") - 1 if len(start) else start
        # Texts without characters share their first character with the next one; the last of them owns it.
        sums = Sums(points)
        _, kept, which = np.unique(sums.of(start, start + size), return_index=True, return_inverse=True)
        if len(start):
            same = (size == size[kept][which]).all()
            if same:
                offset = np.arange(n) - np.repeat(start, size)
                same = (points == points[np.repeat(start[kept][which], size) + offset]).all()
            if not same:
                kept, which = np.arange(len(start)), np.arange(len(start))
        self._build(points, start[kept], size[kept], vocabulary)
        self.root = self.node_of[which] if len(start) else np.zeros(0, np.int64)

    def _build(self, all_points: np.ndarray, start: np.ndarray, size: np.ndarray, v: Vocabulary) -> None:
        total = int(size.sum())
        unit, offset = _inside(start, size)
        points = all_points[start[unit] + offset]
        self.node_of = np.cumsum(size) - size + np.arange(len(size))
        node = np.arange(total) + unit
        left = size[unit] - offset
        self.last = np.zeros(total + len(size), bool)
        self.last[self.node_of + size] = True
        found = [m for m in _matches(points, left, v) if len(m[1])]
        n_nodes, wide = total + len(size), found[-1][0] if found else 1
        # Row: the node an edge begins at; column: the longest edges' first, for they are the likeliest as a rule and
        # most draws end at a node's first edge.
        piece = np.empty(n_nodes * wide, np.int32)
        used = np.zeros(n_nodes * wide, bool)
        covered = np.zeros(total, bool)
        for length, here, ids in found:
            cells = node[here] * wide + (wide - length)
            piece[cells] = ids
            used[cells] = True
            if length == 1:
                covered[here] = True
        bare = np.flatnonzero(~covered)
        cells = node[bare] * wide + (wide - 1)
        piece[cells] = -points[bare].astype(np.int32) - 1
        used[cells] = True
        cells = np.flatnonzero(used)
        self.begin, column = np.divmod(cells, wide)
        self.end, self.piece = self.begin + wide - column, piece[cells]
        self.head = np.concatenate([[0], np.cumsum(np.bincount(self.begin, minlength=n_nodes))])
        log_weight = v.weight[self.piece]
        bare = np.flatnonzero(self.piece < 0)
        code = -self.piece[bare] - 1
        log_weight[bare] = v.byte_weight * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        # Backward sums, by distance from the unit's end; as plain products where no unit is long enough to underflow.
        order = np.argsort(left.astype(np.int16 if size.max(initial=0) < 1 << 15 else np.int64), kind="stable")
        long = size[unit] > LONG_UNIT
        log_beta = np.zeros(n_nodes)
        for many, logs in ((order[~long[order]], False), (order[long[order]], True)):
            if not len(many):
                continue
            here = node[many]
            counts = self.head[here + 1] - self.head[here]
            ends = np.cumsum(counts)
            begins = ends - counts
            edge = np.repeat(self.head[here] - begins, counts) + np.arange(ends[-1])
            weight, to = log_weight[edge] if logs else np.exp(log_weight[edge]), self.end[edge]
            bounds = np.searchsorted(left[many], np.arange(1, int(left[many[-1]]) + 2)).tolist()
            beta = log_beta if logs else np.ones(n_nodes)
            for a, z in zip(bounds[:-1], bounds[1:], strict=True):
                if a == z:
                    continue
                x, y = begins[a], ends[z - 1]
                first = begins[a:z] - x
                if logs:
                    value = weight[x:y] + beta[to[x:y]]
                    most = np.maximum.reduceat(value, first)
                    beta[here[a:z]] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, counts[a:z])), first))
                else:
                    beta[here[a:z]] = np.add.reduceat(weight[x:y] * beta[to[x:y]], first)
            if not logs:
                log_beta[here] = np.log(beta[here])
        self.log_p = np.minimum(log_weight + log_beta[self.end] - log_beta[self.begin], 0.0)
        self.p = np.exp(self.log_p)
        run = np.cumsum(self.p)
        self.upto = (run - np.concatenate([[0.0], run])[self.head[self.begin]]).astype(np.float32)
        final = self.head[1:][self.head[1:] > self.head[:-1]] - 1
        self.upto[final] = np.inf

    def draw(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge out of each node, for u in [0, 1)."""
        edge = self.head[nodes]
        on = np.flatnonzero(self.upto[edge] < u)
        while len(on):
            edge[on] += 1
            on = on[self.upto[edge[on]] < u[on]]
        return edge
