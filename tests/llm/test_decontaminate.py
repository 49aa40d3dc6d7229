import random

import numpy as np
import pyarrow as pa

from dockflow.llm import decontaminate as DC
from dockflow.llm import kernels as K

from .common import edge_docs, empty_docs, prose

VOCAB = sorted({w for i in range(40) for w in prose(i, 80).lower().split()} | {f"v{i}" for i in range(400)})


def edit(words, n, rng):
    w = list(words)
    for _ in range(n):
        p = rng.randrange(len(w))
        op = rng.randrange(3)
        if op == 0:
            w[p] = rng.choice(VOCAB)
        elif op == 1 and len(w) > 2:
            del w[p]
        else:
            w.insert(p, rng.choice(VOCAB))
    return w


def distance(pat, text):
    """Brute force: smallest edit distance of the pattern to any span."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pat, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def found(index, docs):
    out = {}
    for i, _, data, off in K.slices(pa.RecordBatch.from_arrays([pa.array(docs)], ["text"])):
        for d, it, dist, first, n in index.matches(data, off):
            out[i + d, index.items[it][0]] = (dist, first, n)
    return out


def test_recall_and_exactness():
    rng = random.Random(2)
    items = [(i, " ".join(rng.choices(VOCAB, k=rng.randrange(13, 60)))) for i in range(120)]
    index = DC.ItemIndex(items, DC.MAX_RATE)
    docs, truth = [], set()
    for k, (_, t) in enumerate(items):
        w = edit(t.split(), int(0.1 * len(t.split())), rng)
        docs.append(" ".join(rng.choices(VOCAB, k=40) + [x.upper() for x in w] + rng.choices(VOCAB, k=40)))
        truth.add((k, k))
    docs += [" ".join(rng.choices(VOCAB, k=150)) for _ in range(100)]
    got = found(index, docs)
    for (d, it), (dist, first, n) in got.items():
        pat, text = items[it][1].split(), docs[d].lower().split()
        assert dist == distance(pat, text) <= DC.MAX_RATE * len(pat)
        assert distance(pat, text[first:first + n]) == dist
    assert len(truth & set(got)) >= 0.9 * len(truth) and set(got) <= truth
    exact = found(index, [f"x {t} y" for _, t in items])
    assert {k for k, v in exact.items() if v[0] == 0} >= {(i, i) for i, _ in items}


def test_equal_words_keep_walks_together():
    words = np.arange(100, 130, dtype=K.U) * K.U(7919)
    seed, steps = DC.plan(12, 1, 4)[0]
    both = np.concatenate([words, words])
    key, at = DC.walk_keys(both, np.array([0, 30, 5]), 12, seed, steps)
    assert at.tolist() == [0, 30, 5] and key[0] == key[1] != key[2]


def test_short_items_and_short_documents():
    index = DC.ItemIndex([(1, "alpha"), (2, "one two three"), (3, " "), (4, None), (5, " ".join(VOCAB[:14]))], DC.MAX_RATE)
    got = found(index, ["alpha", "x one two three y", "", None, "two three", " ".join(VOCAB[:13]), "ALPHA beta"])
    assert {k: v[0] for k, v in got.items()} == {(0, 1): 0, (1, 2): 0, (5, 5): 1, (6, 1): 0}


def test_repeated_phrases_at_the_ends_of_documents():
    twelve = [f"t{i}" for i in range(12)]
    texts = ["a a a", " ".join(twelve * 2), "x y x y x y x y", " ".join(["p q r"] * 7), " ".join((twelve[:8] + ["s"]) * 3)]
    items = list(enumerate(texts))
    index = DC.ItemIndex(items, DC.MAX_RATE)
    for before in range(5):
        for behind in range(5):
            docs = [" ".join([f"b{k}" for k in range(before)] + [t] + [f"e{k}" for k in range(behind)]) for t in texts]
            got = found(index, docs)
            for i, t in items:
                assert got[i, i] == (0, before, len(t.split())), (i, before, behind)


def test_every_edit_position_of_every_length():
    rng = random.Random(3)
    lengths = [n for n in range(7, 42) for _ in range(3)]
    items = [(i, " ".join(rng.choices(VOCAB, k=n))) for i, n in enumerate(lengths)]
    for rate in (DC.MAX_RATE, 0.05, 0.0):
        index = DC.ItemIndex(items, rate)
        docs, truth = [], set()
        for i, t in items:
            limit = int(rate * len(t.split()))
            for first in range(len(t.split())):
                w = t.split()
                at = [first, *rng.sample([x for x in range(len(w)) if x != first], max(0, limit - 1))][:limit]
                for p in sorted(at, reverse=True):
                    op = (i + first + p) % 3
                    w[p:p + (op < 2)] = [["new"], [], ["more"]][op]
                truth.add((len(docs), i))
                docs.append(" ".join(["x"] * (first % 3) + w + ["y"] * (i % 2)))
        assert truth <= set(found(index, docs)), rate


def test_recall_by_length_and_position():
    """Only the walks find spans here, so recall is measured; the exact check decides what is reported."""
    rng = random.Random(11)
    lengths = [n for n in [*range(7, 21), 26, 33, 59] for _ in range(8)]
    items = [(i, " ".join(rng.choices(VOCAB, k=n))) for i, n in enumerate(lengths)]
    index = DC.ItemIndex(items, DC.MAX_RATE)
    docs, truth = [], []
    for i, t in items:
        n, limit = len(t.split()), int(DC.MAX_RATE * len(t.split()))
        for first in range(n):
            w = t.split()
            for p in sorted([first, *rng.sample([x for x in range(n) if x != first], limit - 1)], reverse=True):
                op = rng.randrange(3)
                w[p:p + (op < 2)] = [[rng.choice(VOCAB)], [], [rng.choice(VOCAB)]][op]
            truth.append((len(docs), i, n, first))
            docs.append(" ".join(rng.choices(VOCAB, k=9) + w + rng.choices(VOCAB, k=9)))
    got = set(found(index, docs))
    for place in (lambda n, f: n, lambda n, f: (n, f)):
        caught = {}
        for d, i, n, f in truth:
            caught.setdefault(place(n, f), []).append((d, i) in got)
        assert min(sum(v) / len(v) for v in caught.values()) >= (0.97 if place(1, 2) == 1 else 0.75)
    for n in range(7, 80):
        size = DC.window_size(n, DC.MAX_RATE)
        assert n - size + 1 >= int(DC.MAX_RATE * n) + 2


def test_walks_skip_the_first_word_in_some_repetitions():
    firsts = [sampled[0] for _, sampled in DC.plan(12, DC.REPETITIONS, DC.SAMPLES)]
    assert firsts.count(0) == 6 and set(firsts) <= {0, 1, 2}
    words = np.arange(1, 13, dtype=K.U) * K.U(7919)
    for size in DC.SIZES:
        for seed, sampled in DC.plan(size, DC.REPETITIONS, DC.SAMPLES):
            assert sampled == sorted(set(sampled)) and sampled[-1] < max(1, 2 * size)
            assert len(DC.walk_keys(words, np.arange(13 - size), size, seed, sampled)[0]) == 13 - size


def test_spark_results_and_filter(spark, monkeypatch):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(7, prose(1)), (7, prose(1)), (8, prose(99, 20)), (9, None), (None, prose(2))], "item_id long, text string")
    want = sorted([(i, 7) for i in (1, 2, 2, 3, 12, None)] * 2 + [(11, None)], key=repr)
    for block in (4096, 2):
        monkeypatch.setattr(DC, "ITEM_BLOCK", block)
        got = DC.leaks(docs, items).collect()
        assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == want and {r["distance"] for r in got} == {0}
        kept = DC.drop_leaks(docs, items)
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.select("doc_id").where("doc_id IS NOT NULL").collect()) == [
            (False, i) for i in (-14, 4, 5, 6, 7, 8, 9, 10, 13)]
        assert kept.where("doc_id IS NULL").count() == 1
    assert DC.leaks(empty_docs(spark), items).count() == 0
    assert DC.leaks(docs, items.limit(0)).count() == 0 and DC.drop_leaks(docs, items.limit(0)).count() == docs.count()
