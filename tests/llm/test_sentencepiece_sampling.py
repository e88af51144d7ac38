import math
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import lattice as lattice_module
from tessera.llm import sentencepiece_sampling as s
from tessera.llm.lattice import Lattice, Vocabulary

MODEL = public_tokenizers.path(s.MODEL)
HARD = ["", " ", "  a", "a", "Hello  world\n\n it's", "日本 ▁x▁", "\x00\r\n\t é", "😀 ok", "x" * 3000, " tail ", "\n", "naïve café"]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL, s.ALPHA)


def all_paths(text, vocabulary):
    """Every segmentation with its weight, straight from the model's pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    n = model.vocab_size()
    known = {model.id_to_piece(i).replace("▁", " "): i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}

    def weight(i):
        rank = -model.get_score(i) if model.get_score(i) > -1e8 else n
        return -s.ALPHA * math.log(2 + min(max(rank, 0), n))

    def rest(at):
        if at == len(text):
            yield (), 0.0
            return
        for z in range(at + 1, len(text) + 1):
            i = known.get(text[at:z])
            if i is not None:
                for tail, w in rest(z):
                    yield (i, *tail), w + weight(i)
        if text[at] not in known:
            raw = text[at].encode()
            for tail, w in rest(at + 1):
                yield (*(3 + b for b in raw), *tail), w - s.ALPHA * math.log(2 + n) * len(raw)

    found = dict(rest(0))
    total = math.log(sum(map(math.exp, found.values())))
    return {k: w - total for k, w in found.items()}


def test_all_segmentations_come_out_with_their_probabilities(vocabulary):
    for text in [" the cat", " ab\ncd", " é日x"]:
        want = all_paths(text, vocabulary)
        got = s._sample([text], np.array([7], np.uint64), vocabulary, len(want) + 3)[0]
        assert {tuple(ids.tolist()) for ids, *_ in got} == set(want)
        for ids, log_p, _, inclusion in got:
            assert log_p == pytest.approx(want[tuple(ids.tolist())], abs=1e-5) and inclusion == 1
        values = [v for _, _, v, _ in got]
        assert values == sorted(values, reverse=True)


def test_draws_follow_sampling_without_replacement(vocabulary):
    text, n = " the a", 20_000
    want = all_paths(text, vocabulary)
    keys = np.array([s.row_key(1, i, "") for i in range(n)], np.uint64)
    pairs = Counter(tuple(tuple(ids.tolist()) for ids, *_ in some) for some in s._sample([text] * n, keys, vocabulary, 2))
    p = {k: math.exp(v) for k, v in want.items()}
    for a, b in permutations(want, 2):
        q = p[a] * p[b] / (1 - p[a])
        assert abs(pairs[a, b] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-4
    # Inclusion scores weigh the draws back to the distribution: their inverse estimates one for each path.
    weight = Counter()
    for some in s._sample([text] * n, keys, vocabulary, 2):
        for ids, log_p, _, inclusion in some:
            weight[tuple(ids.tolist())] += math.exp(log_p) / inclusion / n
    for path in want:
        assert weight[path] == pytest.approx(p[path], rel=0.15, abs=5e-3)


def log_total(text, vocabulary):
    """The log of the summed weights of all segmentations, one character after the other."""
    known = {vocabulary.bytes_[i].decode(): vocabulary.weight[i] for i in range(len(vocabulary.bytes_)) if vocabulary.bytes_[i] and i >= 259}
    sums = [0.0]
    for z in range(1, len(text) + 1):
        some = [sums[a] + known[text[a:z]] for a in range(max(0, z - vocabulary.longest), z) if text[a:z] in known]
        some = some or [sums[z - 1] + vocabulary.byte_weight * len(text[z - 1].encode())]
        top = max(some)
        sums.append(top + math.log(sum(math.exp(x - top) for x in some)))
    return sums[-1]


def test_a_span_without_boundary_is_not_cut(vocabulary):
    """5,000 characters that pieces cover without a gap, and a piece that crosses any given place."""
    text = " " + "".join(np.random.default_rng(4).choice(list("etaoinsr"), 5_000))
    one = Lattice([text], vocabulary)
    assert len(one.root) < 200 and one.last.sum() == len(one.root)
    n = 60
    keys = np.array([s.row_key(3, i, "") for i in range(n)], np.uint64)
    crossing, total = Counter(), log_total(text, vocabulary)
    for some in s._sample([text] * n, keys, vocabulary, 2):
        for ids, log_p, *_ in some:
            pieces = [vocabulary.bytes_[i].decode() for i in ids.tolist()]
            assert "".join(pieces) == text
            assert log_p == pytest.approx(sum(vocabulary.weight[i] for i in ids.tolist()) - total, abs=1e-3)
            ends = set(np.cumsum([len(p) for p in pieces]).tolist())
            crossing.update(k for k in (1024, 2048, 3072, 4096) if k not in ends)
    # Every 1,024th character lies within a piece in some draws.
    assert all(crossing[k] for k in (1024, 2048, 3072, 4096))


def test_cuts_at_gaps_change_no_probability(vocabulary, monkeypatch):
    text = " 日本語の文章は長く続き、空白がないので一つの単位になるが、切れ目はある" + "qzx" * 9
    total = log_total(text, vocabulary)
    units = {}
    for long in (4, 10_000):
        monkeypatch.setattr(lattice_module, "LONG_UNIT", long)
        units[long] = len(Lattice([text], vocabulary).root)
        for ids, log_p, *_ in s._sample([text], np.array([9], np.uint64), vocabulary, 4)[0]:
            weight = sum(vocabulary.weight[i] if i >= 259 else vocabulary.byte_weight for i in ids.tolist())
            assert log_p == pytest.approx(weight - total, abs=1e-6)
    assert units[4] > units[10_000] == 1


def test_turns_draw_anew(spark):
    text = "the quick brown fox jumps over the lazy dog and goes on to the next field, " * 5
    docs = spark.createDataFrame([(1, text, 1), (1, text, 2), (1, text, None), (1, text, 0), (None, text, 1), (None, text, 2)], "doc_id long, text string, turn int")
    got = s.sample_encode(docs, turn_col="turn", keep=("turn",)).collect()
    first = Counter(tuple(r.ids) for r in got if r["sample"] == 0)
    assert sorted(first.values()) == [1, 1, 1, 1, 2]  # null and 0 are one turn


def test_decoding_gives_back_every_text(vocabulary):
    keys = np.arange(len(HARD)).astype(np.uint64)
    for text, some in zip(HARD, s._sample([f" {t}" if t else "" for t in HARD], keys, vocabulary, 3)):
        assert len({tuple(ids.tolist()) for ids, *_ in some}) == len(some) >= 1
        for ids, *_ in some:
            assert s.decode_ids(ids.tolist(), vocabulary) == text
    # The library's own encoding is one of the paths: its ids decode alike.
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in HARD:
        if "▁" not in text:
            assert s.decode_ids(model.encode(text), vocabulary) == text


def test_draws_do_not_depend_on_neighbours(vocabulary):
    keys = np.array([s.row_key(1, i, "") for i in range(len(HARD))], np.uint64)
    texts = [f" {t}" if t else "" for t in HARD]
    together = s._sample(texts, keys, vocabulary, 2)
    for i, text in enumerate(texts):
        alone = s._sample([text], keys[i : i + 1], vocabulary, 2)[0]
        assert [x[0].tolist() for x in alone] == [x[0].tolist() for x in together[i]]


def test_lattice_edges_match_the_vocabulary(vocabulary):
    one = Lattice([" the"], vocabulary)
    spelled = {(int(b), int(e), vocabulary.bytes_[p].decode()) for b, e, p in zip(one.begin, one.end, one.piece) if p >= 0}
    assert all(" the"[b:e] == w for b, e, w in spelled) and (0, 4, " the") in spelled


def test_query_round_trip_and_odd_rows(spark, sf):
    import hashlib

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = s.op6_sentencepiece(spark, sf).collect()
    assert Counter(r.doc_id for r in got) == dict.fromkeys(docs, s.K)
    assert all(r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest() for r in got)
    rows = [(1, None, "x"), (2, "", "y"), (None, "some text", "z"), (3, "some text", "w"), (3, "some text", "w")]
    table = spark.createDataFrame(rows, "doc_id long, text string, sample string")
    found = s.sample_encode(table).select("doc_id", "sample", "ids", s.decode(F.col("ids")).alias("t")).collect()
    assert sorted((str(r.doc_id), r.sample, r.t) for r in found) == sorted([("1", 0, ""), ("2", 0, ""), *[(i, n, "some text") for i in ("None", "3", "3") for n in (0, 1)]])
    assert s.sample_encode(table.where(F.lit(False))).count() == 0


def test_digests_are_those_of_the_ids(spark, sf):
    import hashlib
    import zlib

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {(r.doc_id, r.sample): (len(r.ids), zlib.crc32(np.array(r.ids, "<i4").tobytes()), hashlib.sha256(r.t.encode()).hexdigest()) for r in s.sample_encode(docs).select("*", s.decode(F.col("ids")).alias("t")).collect()}
    assert {(r.doc_id, r.sample): (r.n_pieces, r.ids_crc32, r.decoded_sha256) for r in s.op6_sentencepiece(spark, sf).collect()} == ids
