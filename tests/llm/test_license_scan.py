import random
import re

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from dockflow.llm import license_scan as LS
from dockflow.llm import queries as Q

from ..conftest import SF_CHECK
from .common import LONG, edge_docs, edge_rows, empty_docs

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute(text, templates):
    """(n_words, matches as (label, family, phrase, start, past, overlap)) by looking at every place and block."""
    ws, out = words(text), set()
    for t in templates:
        tw = words(t.text)
        if not tw:
            continue
        if t.phrase:
            out |= {(t.label, t.family, True, i, i + len(tw), len(set(tw))) for i in range(len(ws) - len(tw) + 1) if ws[i:i + len(tw)] == tw}
            continue
        step = 8
        while step < len(tw):
            step *= 2
        for start in range(0, max(1, len(ws)), step):
            if start and start + step >= len(ws):
                break
            both = len(set(tw) & set(ws[start:start + 2 * step]))
            if 100 * both >= t.percent * len(set(tw)):
                out.add((t.label, t.family, False, start, min(start + 2 * step, len(ws)), both))
    return len(ws), out


def rows(scanned):
    return {r["doc_id"]: (r["n_words"], {(m["label"], m["family"], m["phrase"], m["start"], m["past"], m["overlap"]) for m in r["matches"]}) for r in scanned.collect()}


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF_CHECK}/documents.parquet").to_pydict()
    got = {r["doc_id"]: r for r in Q.QUERIES["op11_license_scan"](spark, SF_CHECK).collect()}
    assert len(got) == len(t["doc_id"])
    labelled = 0
    for i, text in zip(t["doc_id"], t["text"], strict=True):
        n, m = brute(text, LS.PHRASES + LS.NOTICES)
        places = sorted((x[3], x[0]) for x in m if x[2])
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not places
        assert (r["score"] > 0) == bool(m) and 0 <= r["score"] <= 1
        labelled += bool(m)
    assert labelled >= 10


def notices():
    rng = random.Random(3)
    filler = "river road hill morning the of and to in is license software".split()
    out = []
    for i, t in enumerate(LS.NOTICES):
        w = t.text.split()
        for k, cut in enumerate((0, 1, len(w) // 6, len(w) // 4, len(w) // 2)):
            gone = set(rng.sample(range(len(w)), cut))
            body = [x for j, x in enumerate(w) if j not in gone]
            lead = [rng.choice(filler) for _ in range(rng.randrange(60))]
            out.append((1000 * i + k, " ".join([*lead, *body, *[rng.choice(filler) for _ in range(rng.randrange(90))]])))
    return out


def test_notices_with_dropped_words(spark):
    docs = notices()
    got = rows(LS.scan(spark.createDataFrame(docs, "doc_id long, text string")))
    for i, text in docs:
        assert got[i] == brute(text, LS.PHRASES + LS.NOTICES)
    for i, t in enumerate(LS.NOTICES):
        assert any(m[0] == t.label for m in got[1000 * i][1])


def test_one_label_of_a_family(spark):
    lgpl = next(t.text for t in LS.NOTICES if t.label == "lgpl")
    docs = [(1, lgpl), (2, "Licensed under CC BY-NC 4.0"), (3, "gnu GENERAL-public License; Apache license. apache license"), (4, "general public license gnu")]
    got = {r["doc_id"]: r for r in LS.summary(LS.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    assert [got[i]["labels"] for i in (1, 2, 3, 4)] == ["lgpl", "cc-by,cc-by-nc", "apache,gpl", ""]
    assert [got[i]["base_labels"] for i in (1, 2, 3, 4)] == ["", "cc-by", "apache,gpl", ""]
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"], got[3]["score"]) == (3, 0, 6, 1.0)


def test_awkward_rows(spark):
    got = LS.summary(LS.scan(edge_docs(spark))).collect()
    want = sorted((str(i), *brute(t, LS.PHRASES + LS.NOTICES)) for i, t in edge_rows())
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in got) == [(i, n) for i, n, _ in want]
    assert all((r["labels"], r["score"], r["first_word"]) == ("", 0.0, None) for r in got)
    assert LS.summary(LS.scan(empty_docs(spark))).collect() == []
    text = f"{LONG} mit license {LONG} cc by {LONG}"
    assert rows(LS.scan(spark.createDataFrame([(1, text)], "doc_id int, text string")))[1] == brute(text, LS.PHRASES + LS.NOTICES)


@pytest.mark.parametrize("limit", [40, 10 ** 6])
def test_long_template_lists_take_several_passes(spark, monkeypatch, limit):
    monkeypatch.setattr(LS, "PASS_TOKENS", limit)
    monkeypatch.setattr(LS.passes, "__defaults__", (limit,))
    docs = notices()[::3]
    got = rows(LS.scan(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == {i: brute(t, LS.PHRASES + LS.NOTICES) for i, t in docs}
    assert (len(LS.passes(LS.PHRASES + LS.NOTICES)) > 3) == (limit == 40)


def test_empty_and_wordless_templates(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert rows(LS.scan(df, [])) == {1: (3, set())}
    assert rows(LS.scan(df, [LS.Template("x", "x", " - "), LS.Template("y", "y", "?", 100, True)])) == {1: (3, set())}


small = st.lists(st.sampled_from("a b c d e f g h".split()), max_size=40).map(" ".join)
templates = st.lists(st.builds(LS.Template, st.sampled_from(["p", "q"]), st.sampled_from(["f", "g"]), small.filter(bool),
                               st.sampled_from([50, 80, 100]), st.booleans()), min_size=1, max_size=5)


@settings(max_examples=200, deadline=None)
@given(st.lists(small, min_size=1, max_size=6), templates, st.data())
def test_filters_lose_nothing(texts, ts, data):
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    counts = {int(h): data.draw(st.integers(0, 3)) for t in ts for h in LS.K.as_i64(LS._text_words(t.text))}
    n, m = LS.find(np.frombuffer(b"".join(raw), np.uint8), off, index := LS.TemplateIndex(ts, counts))
    for i, text in enumerate(texts):
        want = brute(text, ts)
        assert n[i] == want[0]
        assert {(ts[t].label, ts[t].family, ts[t].phrase, s, p, o) for d, t, s, p, o in m.tolist() if d == i} == want[1]
    assert LS.best(m, index)[[ts[t].phrase for t in m[:, 1]]].all()
