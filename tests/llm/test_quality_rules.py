import re
from collections import Counter

import numpy as np
import pytest

from dockflow.llm import quality_rules as QR

from .common import edge_docs, edge_rows, empty_docs, prose

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    ws = W.findall(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if W.search(x):
            dup += x in seen
            seen.add(x)
    c = Counter(tuple(ws[k:k + 8]) for k in range(len(ws) - 7))
    cov = {j for k in range(len(ws) - 7) if c[tuple(ws[k:k + 8])] > 1 for j in range(k, k + 8)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cov)


def test_statistics_equal_brute_force(spark):
    rows = edge_rows() + [(100, "a b\na b\n\n a b\nx"), (101, "w1 w2 w3 w4 w5 w6 w7 w8 " * 3), (102, "#a *b\n|c <d>\n#a *b"), (103, "q " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = QR.judged(docs, QR.DecisionList()).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(r["text"])
        assert tuple(r[QR.PREFIX + c] for c in QR.COUNTS[:5]) == want
        assert r["_q_base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["_q_kept"] == (not r["_q_base_failed"])


def test_list_is_learned_from_labels_and_applied(spark):
    good = [(i, prose(i, 40)) for i in range(120)]
    bad = [(1000 + i, prose(i, 40).replace(" ", " ### ")) for i in range(60)] + [(2000 + i, prose(i, 40).upper()) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in (good + bad)[::2]] + [(None, 1), (1, None)], "doc_id long, quality int")
    rules = QR.fit(docs, labels)
    assert rules.rules and all(r.precision >= QR.MIN_PRECISION for r in rules.rules)
    assert {r["doc_id"] for r in QR.keep_good(docs, rules).select("doc_id").collect()} == {i for i, _ in good}
    assert QR.fit(docs.limit(0), labels).rules == () and QR.fit(docs, labels.limit(0)).rules == ()


def test_learner_prunes_and_orders():
    rng = np.random.default_rng(0)
    x = {"u": rng.random(3000), "v": rng.random(3000)}
    bad = (x["u"] > 0.8) | ((x["v"] < 0.1) & (x["u"] > 0.3))
    found = QR.learn(x, bad, rng.random(3000) < 0.67)
    hit = np.zeros(3000, bool)
    for r in found.rules:
        hit |= r.holds(x)
    assert (hit == bad).mean() > 0.97 and len(found.rules) <= 6


def test_edges(spark):
    docs = edge_docs(spark)
    rules = QR.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert QR.keep_good(docs, rules).columns == docs.columns
    assert QR.judged(docs, rules).count() == docs.count()
    assert QR.judged(empty_docs(spark), rules).count() == 0
    with pytest.raises(ValueError):
        QR.judged(docs.withColumnRenamed("a", "_q_a"), rules)
