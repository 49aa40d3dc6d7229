import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dockflow.llm import ctw

from .common import edge_docs, edge_rows, empty_docs, prose

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_model(texts, depth):
    """Counts per (context, decision) in sequence, weighted recursively from the definition."""
    zeros, ones, kids = Counter(), Counter(), defaultdict(set)
    for t in texts:
        s = bytes([0xFE]) * depth + t + b"\xff"
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                ctx = s[i - d:i]
                if d:
                    kids[ctx[1:]].add(ctx)
                node = 1
                for b in range(7, -1, -1):
                    bit = s[i] >> b & 1
                    (ones if bit else zeros)[ctx, node] += 1
                    node = node * 2 + bit
    memo = {}

    def kt(k):
        p, a, b = 0.0, 0, 0
        for _ in range(zeros[k]):
            p, a = p + math.log((a + 0.5) / (a + b + 1)), a + 1
        for _ in range(ones[k]):
            p, b = p + math.log((b + 0.5) / (a + b + 1)), b + 1
        return p

    def pw(ctx, node):
        if (ctx, node) not in memo:
            own = kt((ctx, node))
            if len(ctx) < depth:
                below = sum(pw(c, node) for c in kids[ctx])
                top = max(own, below)
                own = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(below - top))
            memo[ctx, node] = own
        return memo[ctx, node]

    def prob(s, i, d, node, bit):
        ctx = s[i - d:i]
        a, b = zeros[ctx, node], ones[ctx, node]
        est = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == depth:
            return est
        w = math.exp(kt((ctx, node)) + math.log(0.5) - pw(ctx, node))
        return w * est + (1 - w) * prob(s, i, d + 1, node, bit)

    def score(t):
        s, out = bytes([0xFE]) * depth + t + b"\xff", 0.0
        for i in range(depth, len(s)):
            node = 1
            for b in range(7, -1, -1):
                bit = s[i] >> b & 1
                out += math.log10(prob(s, i, 0, node, bit))
                node = node * 2 + bit
        return out
    return score


@pytest.mark.parametrize("depth", [2, 3])
def test_score_equals_the_definition(spark, depth, monkeypatch):
    monkeypatch.setattr(ctw, "GROUP_BYTES", 300)
    rows = [(i, prose(i, 4 + i % 5)) for i in range(12)] + [(20, None), (None, "Loose row"), (3, prose(3, 7))]
    got = ctw.score(spark.createDataFrame(rows, "doc_id long, text string"), depth=depth).collect()
    assert len(got) == len(rows)
    low = lambda t: (t or "").translate(LOW).encode()
    model = brute_model([low(t) for i, t in rows if not ctw.held_out(i)], depth)
    for r in got:
        assert any(abs(r["score"] - model(low(t))) < 1e-6 for i, t in rows if i == r["doc_id"])


def test_base_score_and_split(spark):
    got = ctw.score(edge_docs(spark)).collect()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    toks = [(i, word.findall((t or "").translate(LOW)) + ["<end>"]) for i, t in edge_rows()]
    c = Counter(w for i, ws in toks if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws), 4)) for i, ws in toks)
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in got)


def test_training_text_is_cheaper_than_noise(spark):
    rows = [(i, prose(i, 40)) for i in range(60)] + [(1000, "zq9 #x! " * 30)]
    got = {r["doc_id"]: r for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    held = [r["code_length"] for i, r in got.items() if r["held_out"] and i < 1000]
    assert held and max(held) < 3 < got[1000]["code_length"] or got[1000]["held_out"] is False


def test_empty_table(spark):
    assert ctw.score(empty_docs(spark)).count() == 0


def test_scoring_looks_up_every_distinct_feature_once_a_slice(monkeypatch):
    """A slice's keys are its distinct ones, and places and documents give every occurrence back in order."""
    monkeypatch.setattr(ctw, "SLICE", 40)
    texts = [b"a b a b a b", b"", b"Tower tower tower tower tower tower", b"a b"]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    keys, sliced = ctw.sliced_keys(b"".join(texts), off, 3)
    assert (np.diff(keys.astype(object)) > 0).all() and len(sliced) > 1
    for i, j, w, wat, wd, g, gat in sliced:
        data, so = np.frombuffer(b"".join(texts[i:j]), np.uint8), off[i:j + 1] - off[i]
        ws, docs, gs, _ = ctw.slice_features(data, so, 3)
        assert (w[wat] == ws).all() and (wd == docs).all() and (g[gat] == gs).all()
        assert len(w) < len(ws) and len(set(g.tolist())) == len(g) and np.isin(np.concatenate([w, g]), keys).all()
