import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dockflow.llm import frames
from dockflow.llm import kernels as K
from dockflow.llm import ngram_join as NJ

from .common import edge_docs, edge_rows, empty_docs, prose


def brute(rows):
    """(doc_id, n, component) of rows (id, text) with distinct or repeated ids."""
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    by = defaultdict(set)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                by[x].add(k)
    both = Counter((a, b) for v in by.values() for a in v for b in v if a < b)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, b), c in both.items():
        if 100 * c >= 80 * (len(sets[a][1]) + len(sets[b][1]) - c):
            up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(s), None if i is None else least[root(k)]) for k, (i, s) in enumerate(sets)), key=repr)


def near(text, rate, rng):
    w = text.split()
    for k in range(len(w)):
        if rng.random() < rate:
            w[k] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def corpus():
    rng = random.Random(3)
    passage = prose(500, 60)
    rows = []
    for base in range(40):
        t = " ".join(prose(base * 100 + k, 20) for k in range(rng.choice([1, 1, 2, 4, 8])))
        t = " ".join(t.split()[: rng.choice([4, 5, 6, 8, 9, 10, 12, 20, 28, 29, 30, 34, 40, 160])])
        rows += [t] + [near(t, rng.choice([0.0, 0.01, 0.03, 0.05]), rng) for _ in range(rng.randrange(0, 6))]
        rows += [t + " tail", "head " + t, t + " a b c"]
    rows += [prose(9000 + k, 30) + " " + passage + " " + prose(9500 + k, 30) for k in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_equal_brute_force(spark):
    rows = corpus()
    got = NJ.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_signatures_never_miss_a_link():
    """Random pairs at and around the threshold, many sizes: a shared signature whenever they link."""
    rng = np.random.default_rng(4)
    linked = 0
    for size in [4, 5, 8, 10, 15, 20, 24, 25, 27, 30, 31, 36, 37, 45, 54, 60, 81, 100, 150, 300, 700, 2000]:
        for _ in range(30):
            extra = int(rng.integers(0, size // 4 + 1))
            drop = int(rng.integers(0, max(1, size // 5 + 1)))
            pool = rng.integers(0, 1 << 63, size + extra, dtype=np.int64).astype(K.U)
            a, b = np.unique(pool[:size]), np.unique(pool[drop:])
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common):
                continue
            linked += 1
            h, n = np.concatenate([a, b]), np.array([len(a), len(b)])
            sig, doc = NJ.signatures(h, np.repeat([0, 1], n), n)
            if len(a) != len(b) or common != len(a):
                assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist()), (size, extra, drop)
            sk = NJ.sketches(h, np.repeat([0, 1], n), 2).astype(int)
            assert 9 * np.abs(sk[0] - sk[1]).sum() <= n.sum()
    assert linked > 200


def test_edges(spark):
    docs = edge_docs(spark)
    got = NJ.jaccard_components(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(edge_rows())
    kept = NJ.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [-14, 1, 4, 5, 6, 7, 8, 9, 10, 11, 13]
    assert kept.where("doc_id IS NULL").count() == 2
    assert NJ.jaccard_components(empty_docs(spark)).count() == 0


def test_component_labels(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    got = {r["node"]: r["comp"] for r in frames.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    assert got == {x: root(x) for x in up}


@pytest.mark.parametrize("text", ["", "a", "a b c d", "a b c d e", "a b c d e f A B C D E f"])
def test_shingle_counts(text):
    data = np.frombuffer(text.encode(), np.uint8)
    _, _, n = NJ.slice_sets(data, np.array([0, len(data)]))
    w = text.lower().split()
    assert n[0] == (len({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}) if w else 0)


def test_one_row_of_each_component_is_kept(spark):
    """Repeated ids: texts that aren't linked all stay, repeats of a row count once, the choice is the same every time."""
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(5, a, "x"), (5, b, "x"), (9, a + " tail", "x"), (3, b, "x"), (5, c, "x"), (5, c, "y"), (5, c, "x"), (6, "", "x"), (6, None, "x"), (6, " ", "x"),
            (7, " ".join(c.split()[:-1]), "x"), (None, a, "x"), (None, a, "x"), (8, a.replace(" ", "  "), "x"), (5, a.upper(), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, grp string")
    runs = [sorted((tuple(r) for r in NJ.one_per_component(d).where("doc_id IS NOT NULL").collect()), key=repr) for d in (df, df.repartition(7))]
    assert runs[0] == runs[1]
    kept = [(i, t) for i, t, _ in runs[0]]
    assert len(kept) == len(set(kept)) == 5
    assert {(3, b), (5, c), (6, " ")} < set(kept) and len([1 for i, t in kept if i == 5 and (t or "").lower() == a.lower()]) == 1
    assert len([1 for i, t in kept if i == 6]) == 2  # null and empty text are the same text
    assert NJ.one_per_component(df).where("doc_id IS NULL").count() == 2


def test_a_large_cluster_of_different_near_copies(spark, monkeypatch):
    """Near copies that differ pairwise, in one cluster that takes several cells, beside a common table that is too small."""
    monkeypatch.setattr(NJ, "CELL", 200)
    monkeypatch.setattr(NJ, "COMMON_BITS", 1 << 10)
    rng = random.Random(8)
    base = prose(77, 120).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 1, 2, 5, 9])):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    got = NJ.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_a_cell_gives_fewer_links_than_components():
    """All of 90 near copies link pairwise and 10 others with nobody: 89 links, not 4,005 pairs, also with groups that repeat pairs."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 200, dtype=np.int64)
    sets = [np.unique(np.append(base[4:] if k < 90 else rng.integers(0, 1 << 62, 196, dtype=np.int64), rng.integers(0, 1 << 62, 4, dtype=np.int64))) for k in range(100)]
    sk = NJ.sketches(np.concatenate(sets).view(K.U), np.repeat(np.arange(100), [len(x) for x in sets]), 100)
    node = rng.permutation(100)
    members = pa.table({"node": node, "comp": node, "hashes": [sets[k].tobytes() for k in node], "sketch": [sk[k].tobytes() for k in node]})
    rows = pa.table({"grp": np.repeat([7, 8, 9], [100, 60, 40]), "member": np.concatenate([np.arange(100), np.arange(20, 80), np.arange(40)])})
    got = NJ._cell_links(rows, members).to_pylist()
    up = list(range(100))
    for r in got:
        u, v = up[r["a"]], up[r["b"]]
        assert u != v
        up = [v if x == u else x for x in up]
    assert len(got) == 89 and len(set(up[:90])) == 1
    cell = pa.table({"grp": rows.column("grp"), "node": rows.column("member"), "comp": rows.column("member"),
                     "n": np.array([len(x) for x in sets])[rows.column("member").to_numpy()], "sketch": [sk[k].tobytes() for k in rows.column("member").to_pylist()]})
    assert NJ._near_nodes(cell).column("node").to_pylist() == list(range(90))


def test_blocks_of_a_large_group_meet_in_small_cells(spark, monkeypatch):
    """Without star rounds the last one gets every near copy, and its groups are split into blocks by rows and bytes."""
    monkeypatch.setattr(NJ, "STARS", 0)
    monkeypatch.setattr(NJ, "CELL", 40)
    monkeypatch.setattr(NJ, "CELL_BYTES", 20_000)
    rng = random.Random(9)
    base = prose(78, 120).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 3, 4, 5, 9])):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    got = NJ.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_long_texts_that_share_many_signatures_meet_once(spark, monkeypatch):
    """Twelve texts hold different two thirds of the paragraphs of one: none links, and subsets of them share hundreds of signatures.
    Groups go by center, so no node meets another more than once for each."""
    rng = random.Random(10)
    paragraphs = [prose(700 + k, 40) for k in range(90)]
    rows = [(i, " ".join(p for p in paragraphs if rng.random() < 0.67)) for i in range(12)]
    rows += [(20 + i, t + " tail") for i, t in rows[:3]]
    met = []
    write = NJ.materialize

    def counted(df, name="t", *more):
        out = write(df, name, *more)
        met.extend([out.count()] if name == "cells" else [])
        return out
    monkeypatch.setattr(NJ, "materialize", counted)
    got = NJ.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert max(met) <= 15 * 15


def test_groups_of_a_center_are_merged_unless_pairs_multiply(spark):
    rng = random.Random(11)
    near = [(k, n, 1) for k in range(400) for n in {1, *rng.sample(range(2, 27), 12)}]
    large = [(1000 + k, n, 30) for k in range(3) for n in {30, *rng.sample(range(31, 131), 80)}]
    hub = [(2000 + k, n, 200) for k in range(300) for n in (200, 201 + k)]
    rows = near + large + hub
    got = [tuple(r) for r in NJ._by_center(spark.createDataFrame(rows, "grp long, node long, center long")).collect()]

    def pairs(rows):
        by = defaultdict(set)
        for g, n, _ in rows:
            by[g].add(n)
        return {(a, b) for v in by.values() for a in v for b in v if a < b}
    assert pairs(rows) <= pairs(got) and len(got) == len(set(got))
    assert len([g for g, _, c in got if c == 1]) == 26 and len({g for g, _, c in got if c == 30}) == 1
    assert sorted(r for r in got if r[2] == 200) == sorted(hub)
    assert all((g, c, c) in set(got) for g, _, c in got)
