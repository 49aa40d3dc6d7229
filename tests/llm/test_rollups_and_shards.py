import base64
import heapq
import os
import random
import shutil
import zlib
from collections import Counter

import pytest
import tiktoken

from dockflow.llm import shards as SH
from dockflow.llm import token_rollups as TR

from .common import edge_docs, edge_rows, empty_docs


def totals(store):
    return {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in store.totals().collect()}


CHANGES = "doc_id long, op string, source string, lang string, version string, n_tokens long, seq long"


def test_a_commit_reads_a_snapshot_and_few_ledger_batches(spark, tmp_path):
    store = TR.RollupStore(spark, str(tmp_path / "s"), 3)
    for batch in range(1, 9):
        rows = [(batch, "insert", "s", "en", "v1", 10, 0), (batch - 1, "revise", "s", "en", "v2", 1, 0), (batch - 2, "delete", *[None] * 4, 0)]
        store.commit(batch, spark.createDataFrame(rows, CHANGES))
        base, behind = store._history(None)
        assert base == ([batch // 3 * 3] if batch > 2 else []) and len(behind) == batch % 3
        state = {r["doc_id"]: (r["version"], r["n_tokens"]) for r in store.ledger().collect()}
        assert state == {batch: ("v1", 10), batch - 1: ("v2", 1)}
        assert totals(store) == {("s", "en", "v1"): (1, 10), ("s", "en", "v2"): (1, 1)}
        files = [f for f in store.ledger().inputFiles() if "/ledger/" in f]
        assert {int(f.split("batch_id=")[1].split("/")[0]) for f in files} == set(behind)
    # a snapshot that was cut short is ignored and written anew by a repeated commit
    os.remove(tmp_path / "s" / "snapshot" / "batch_id=6" / "_SUCCESS")
    assert store._history(None) == ([3], [4, 5, 6, 7, 8])
    assert {r["doc_id"] for r in store.ledger().collect()} == {7, 8}
    store.commit(8, spark.createDataFrame([], CHANGES))
    assert store._history(None) == ([8], []) and {r["doc_id"] for r in store.ledger().collect()} == {7, 8}


@pytest.mark.parametrize("every", [TR.COMPACT_EVERY, 2, 1])
def test_rollups_follow_a_reference_ledger(spark, tmp_path, every):
    rng = random.Random(1)
    store, ledger, blanks = TR.RollupStore(spark, str(tmp_path / "s"), every), {}, []
    for batch in range(1, 5):
        rows = []
        for i in rng.sample(range(30), 15):
            for seq in range(rng.randrange(1, 3)):
                op = rng.choice(["insert", "revise", "delete"])
                g = (None, None, None, None) if op == "delete" else (rng.choice(["s", None]), rng.choice(["en", "de"]), rng.choice(["v1", "v2"]), rng.randrange(100))
                rows.append((i, op, *g, seq))
                if op == "delete":
                    ledger.pop(i, None)
                else:
                    ledger[i] = g
        rows += [(None, "insert", "s", "en", "v1", 7, 0), (None, "delete", None, None, None, None, 1), rows[0]]
        last = max((r for r in rows if r[0] == rows[0][0]), key=lambda r: r[-1])
        if last[1] == "delete":
            ledger.pop(rows[0][0], None)
        else:
            ledger[rows[0][0]] = last[2:6]
        blanks.append(("s", "en", "v1", 7))
        changes = spark.createDataFrame(rows, CHANGES)
        store.commit(batch, changes)
        want = Counter(), Counter()
        for g in [*ledger.values(), *blanks]:
            want[0][g[:3]] += 1
            want[1][g[:3]] += g[3]
        assert totals(store) == {g: (want[0][g], want[1][g]) for g in want[0]}
        before = totals(store)
        store.commit(batch, changes)
        assert totals(store) == before
    with pytest.raises(ValueError):
        store.commit(0, changes)
    # a crash between the two writes: the ledger folder is there, the deltas are not
    shutil.rmtree(tmp_path / "s" / "deltas" / "batch_id=4")
    shutil.rmtree(tmp_path / "s" / "ledger" / "batch_id=4" / "_temporary", ignore_errors=True)
    store.commit(4, changes)
    assert totals(store) == before


def test_token_counts(spark):
    enc = tiktoken.Encoding("o", pat_str=TR.PATTERN, special_tokens={},
                            mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(TR.TOKENIZER_PATH, "rb"))})
    got = TR.count_tokens(edge_docs(spark).drop("version"), "v").collect()
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=repr) == sorted(((i, len(enc.encode_ordinary(t or ""))) for i, t in edge_rows()), key=repr)
    assert TR.count_tokens(empty_docs(spark), "v").count() == 0


def test_empty_store(spark, tmp_path):
    store = TR.RollupStore(spark, str(tmp_path / "none"))
    assert totals(store) == {}
    store.commit(1, TR.inserts(TR.count_tokens(empty_docs(spark), "v")))
    assert totals(store) == {} and store.committed() == [1]


def test_schedule_is_that_of_the_heap():
    rng = random.Random(2)
    for _ in range(100):
        classes = Counter(rng.choice([1, 2, 5, 7, 100, 3]) for _ in range(rng.randrange(0, 700)))
        k = rng.randrange(1, 17)
        load, count = Counter(), Counter()
        for size, first, past, shard in SH.deal(list(classes.items()), k):
            load[shard] += size * (past - first)
            count[size] += past - first
        h = [(0, i) for i in range(k)]
        for size in sorted(classes.elements(), reverse=True):
            heapq.heapreplace(h, (h[0][0] + size, h[0][1]))
        assert sorted(v for v, _ in h) == sorted(load.get(i, 0) for i in range(k)) and count == classes


@pytest.mark.parametrize("bucket_rows", [50_000, 3])
def test_shards_of_awkward_rows(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(SH, "BUCKET_ROWS", bucket_rows)
    got = SH.assign(edge_docs(spark).drop("n_chars"), 4).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in edge_rows()), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    place = {}
    for r in got:
        assert place.setdefault(r["text_crc32"], r["shard"]) == r["shard"]
    assert SH.assign(empty_docs(spark)).count() == 0


def test_sizes_are_near_equal(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(1, 400) + str(i % 150)) for i in range(600)]
    load = Counter()
    for r in SH.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        load[r["shard"]] += r["size"]
    assert len(load) == 16 and max(load.values()) - min(load.values()) <= 1700
