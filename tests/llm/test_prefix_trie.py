import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dockflow.llm import prefix_trie as PT
from dockflow.llm import queries as Q

from ..conftest import SF_SMALL

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows, family=20):
    """The contract's rows of (conv_id, turn, role, text), by walking every prefix."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    own = {c: [m for _, m in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if family else 0
        built[c] = own.get(c - (c % family), [])[:h] + mine[h:] if family else mine
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        yield node
        for k in kids[node]:
            yield from below(k)
    words = lambda n: len(n[-1][1].split()) if n else 0  # noqa: E731  texts here use plain blanks
    return sorted((min(v), len(n), min(members[n[:-1]]) if n else None, len(v), len(kids[n]), sum(not kids[x] for x in below(n)),
                   sum((len(members[x]) - 1) * words(x) for x in below(n)),
                   hashlib.sha256(",".join(map(str, sorted(c for c in v if len(built[c]) == len(n)))).encode()).hexdigest())
                  for n, v in members.items())


def found(df):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=key)


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert got == sorted(want, key=key)


def test_query_equals_sql(spark):
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from '{SF_SMALL}/conversations.parquet'")
    got = found(Q.QUERIES["op12_prefix_trie"](spark, SF_SMALL))
    same(got, c.sql(f"select {', '.join(COLS)} from ({Q.SQL['op12_prefix_trie']})").fetchall())
    assert len(got) > 50


def test_sql_equals_brute_force(spark):
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from '{SF_SMALL}/conversations.parquet'")
    rows = c.sql("select conv_id, turn, role, text from conversations").fetchall()
    same(sorted(c.sql(f"select {', '.join(COLS)} from ({Q.SQL['op12_prefix_trie']})").fetchall(), key=lambda r: tuple((x is not None, x) for x in r)), brute(rows))


talk = st.lists(st.sampled_from([("user", "a b"), ("user", "c"), ("assistant", "d e f")]), max_size=11)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(talk, min_size=1, max_size=30), st.sampled_from([None, 20]))
def test_blocks_that_diverge_anywhere(spark, talks, family):
    rows = [(c, i, r, t) for c, ms in enumerate(talks) for i, (r, t) in enumerate(ms)]
    df = spark.createDataFrame(rows, SCHEMA)
    same(found(PT.conversation_trie(df, family)), brute(rows, family))


def test_nulls_ties_repeats_long_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "y"), (None, 0, "user", "nobody"), (2, 5, "user", "word " * 50_000),
            (3, 0, "user", ""), (23, 0, "user", ""), (41, 0, "a", "bc"), (42, 0, "ab", "c"), (60, 0, "user", "x")]
    df = spark.createDataFrame([(*r, 1, "n", 2, "t") for r in rows], SCHEMA + ", pos long, node string, k int, turns string")
    same(found(PT.conversation_trie(df)), brute(rows))
    same(found(PT.conversation_trie(df, None)), brute(rows, None))
    assert PT.conversation_trie(df.where("conv_id = -5")).collect() == []


@pytest.mark.parametrize("chunk, ids", [(2, 1), (8, 3)])
def test_long_conversations_and_many_copies(spark, monkeypatch, chunk, ids):
    monkeypatch.setattr(PT, "CHUNK", chunk)
    monkeypatch.setattr(PT, "IDS", ids)
    long = [(c, i, "user", f"t{i if i < 40 else i * c}") for c in (5, 6, 9) for i in range(60)]
    copies = [(100 + c, i, "user", f"same {i}") for c in range(40) for i in range(5)]
    df = spark.createDataFrame(long + copies, SCHEMA)
    same(found(PT.conversation_trie(df, None)), brute(long + copies, None))
    same(found(PT.conversation_trie(df)), brute(long + copies))
