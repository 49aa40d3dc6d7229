import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from dockflow.llm import sentencepiece_scan as SP

from .common import edge_docs, empty_docs


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=SP.MODEL_PATH)


@pytest.fixture(scope="module")
def lattice():
    return SP.Lattice(SP.load())


def texts():
    rng = random.Random(5)
    out = ["", "  ", " a", "a" + " " * 40 + "x", "日本語のテキスト。", "a" * 400, "👩‍👩‍👧 hi\n\n\t\tx", "=" * 70, "The quick brown fox. Über Straße."]
    return out + ["".join(rng.choices("abcdehilnorst  \néü0123(){}=_", k=rng.randrange(1, 150))) for _ in range(300)]


def test_encoding_equals_the_library(lib, lattice):
    for t in texts():
        assert np.frombuffer(lattice.encode(SP.marked(t))[0], np.int32).tolist() == lib.encode(t)


@pytest.mark.parametrize("chunk", [32, 47, 100])
def test_chunk_matrices_give_the_same_path(lib, lattice, chunk):
    ctx = lattice.p.longest
    for t in texts()[:120] + ["x" * 500, "word " * 100]:
        s = SP.marked(t)
        cuts = [*range(0, len(s) - chunk // 2, chunk), len(s)]
        if len(cuts) < 3:
            continue
        rec = []
        for lo, hi in itertools.pairwise(cuts):
            a, b = max(0, lo - ctx), min(len(s), hi + ctx)
            rec.append((s[a:b], lo - a, hi - a, lo == 0, hi == len(s)))
        ms = [lattice.matrix(*r) for r in rec]
        left = ms[0]
        for m in ms[1:]:
            left = SP.max_plus(left, m)
        right = ms[-1]
        for m in ms[-2::-1]:
            right = SP.max_plus(m, right)
        assert (left == right).all()  # associative
        ends = pa.table({"entry": [0], "leave": [int(np.argmax(left[0]))]})
        parts = pa.table({"row": [1] * len(ms), "k": list(range(len(ms))), "m": [SP._pack(m) for m in ms]})
        d = SP._descend(ends, parts)
        got = b"".join(lattice.backtrace(*r, e, x) for r, e, x in zip(rec, d["entry"].to_pylist(), d["leave"].to_pylist(), strict=True))
        assert np.frombuffer(got, np.int32).tolist() == lib.encode(t)
        assert int(left[0].max()) == lattice.encode(s)[1]


def test_spark_encode_with_two_levels_and_decode(spark, lib, monkeypatch):
    monkeypatch.setattr(SP, "FAN", 3)
    docs = edge_docs(spark)
    rows = SP.decode(SP.encode(docs, chunk=4096)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = lib.encode(r["text"] or "")
        assert r["_ids"] == want
        assert r["_decoded"] == lib.decode(want)
        assert r["_decoded"] == (r["text"] or "")
    assert SP.encode(empty_docs(spark)).count() == 0


def test_unigram_mode_is_viterbi():
    pieces = {"▁a": -2.0, "▁ab": -3.5, "b": -1.0, "c": -1.0, "bc": -1.5, "a": -4.0, "▁": -3.0}
    names = list(pieces)
    p = SP.Pieces(names, [round(v * 1024) for v in pieces.values()], {t: i for i, t in enumerate(names)}, [-1.0] * 7, list(range(7)),
                  list(range(7)), [True] * 7, {}, 99, False, 3, frozenset(t[k:k + 2] for t in names for k in range(len(t) - 1)))
    lat = SP.Lattice(p)

    def best(s):
        if not s:
            return 0.0, []
        return max((v + best(s[len(t):])[0], [names.index(t), *best(s[len(t):])[1]]) for t, v in pieces.items() if s.startswith(t)
                   and best(s[len(t):])[0] > -1e9) if any(s.startswith(t) for t in pieces) else (-1e18, [])
    for s in ("▁abc", "▁bc", "▁aabcbc"):
        got, score = lat.encode(s)
        assert score == round(best(s)[0] * 1024)
        assert sum(p.weight[i] for i in np.frombuffer(got, np.int32)) == score


def test_words_walked_together_equal_the_lattice_alone():
    lat = SP.Lattice(SP.load())
    table = SP.WordTable(lat)
    rng = random.Random(4)
    words = ["".join(rng.choice("theanoingr.,é日👍\t▁") for _ in range(rng.randrange(1, 60))) for _ in range(400)] + ["", "▁", "▁" * 70, "a"]
    assert table.paths(words) == [lat.word(w) for w in words]
    texts = ["the  river\n\n road ", "", " ", "\n", "x" * 500, "é\x00 日本", "the  river\n\n road "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    for _ in range(2):  # new and known words
        ids, edge, score = table.encode(data, off)
        got = [(ids[a:b].tobytes(), s) for a, b, s in zip(edge[:-1], edge[1:], score.tolist(), strict=True)]
        assert got == [lat.encode(SP.marked(t)) for t in texts]
