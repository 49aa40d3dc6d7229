import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockflow.llm import chat as CH
from dockflow.llm import queries as Q

from ..conftest import SF_SMALL

PIECES = ["<|im_start|>", "<|im_end|>", "\n", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "\\", "<", "[", "|", "a", " é", "👍", "<\\s>", "[\\\\INST]", "\x00"]


def fold_brute(events):
    turns = {}
    for conv, turn, seq, op, role, text in sorted(set(events), key=lambda e: (e[2], e[3] is not None, e[3] or "", e[4] is not None, e[4] or "", e[5] is not None, e[5] or "")):
        r, t = turns.get((conv, turn), ("", ""))
        text = text or ""
        t = {"delta": t + text, "edit": text, "regenerate": ""}.get(op, t)
        turns[conv, turn] = (r if role is None else role, t)
    return turns


def test_fold_of_deltas_edits_and_regenerations(spark):
    ev = [(1, 0, 0, "delta", "user", "He"), (1, 0, 1, "delta", "user", "llo"), (1, 1, 5, "delta", "assistant", "bad"), (1, 1, 6, "regenerate", "assistant", None),
          (1, 1, 7, "delta", "assistant", "go"), (1, 1, 7, "delta", "assistant", "go"), (1, 1, 8, "delta", None, "od"), (1, 2, 9, "edit", "user", "edited"),
          (1, 2, 10, "delta", "user", "!"), (2, 0, 1, "delta", None, None), (None, 0, 1, "delta", "user", "null id"), (3, None, 1, "edit", "user", "x"),
          (3, 0, 1, "noise", "user", "dropped"), (3, 0, 2, "edit", "user", "a"), (3, 0, 2, "edit", "user", "b")]
    got = CH.fold(spark.createDataFrame(ev, "conv_id long, turn long, seq long, op string, role string, text string").withColumn("log", F.lit(1))).collect()
    assert {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in got} == fold_brute(ev)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a\nb", "x\\ny", "<s>\\\\"]), st.lists(st.sampled_from(PIECES), max_size=8).map("".join)),
                min_size=1, max_size=60))
def test_render_and_read_back_are_inverse(spark, turns):
    df = spark.createDataFrame([(7, i, r, t) for i, (r, t) in enumerate(turns)] + [(None, 0, "assistant", "z")], "conv_id long, turn long, role string, text string")
    out = CH.render(df).cache()
    back = CH.read_back(out).orderBy("n").collect()
    mine = [r for r in back if r["conv_id"] == 7]
    assert [(r["role"], r["text"]) for r in mine] == turns
    assert [r["masked"] for r in mine] == [t if r == "assistant" else None for r, t in turns]
    assert [(r["role"], r["masked"]) for r in back if r["conv_id"] is None] == [("assistant", "z")]
    text = next(r["formatted"] for r in out.collect() if r["conv_id"] == 7)
    assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(turns)
    assert "[INST]" not in text and "</s>" not in text


def test_query_equals_sql_and_runs_no_python(spark):
    df = Q.QUERIES["op6_chat_format"](spark, SF_SMALL)
    assert "Python" not in df._jdf.queryExecution().toString() and "Pandas" not in df._jdf.queryExecution().toString()
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from '{SF_SMALL}/conversations.parquet'")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(tuple(r[x] for x in cols) for r in df.collect()) == sorted(c.sql(f"select {', '.join(cols)} from ({Q.SQL['op6_chat_format']})").fetchall())


def test_messages_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "b", "x"), (1, 1, "assistant", "a", "x"), (1, 1, "assistant", "a", "x"), (1, None, None, "first", "x"),
            (None, 3, "user", "q", "x"), (2, 0, "assistant", "long " * 50_000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string")
    got = CH.read_back(CH.render(CH.fold(CH.message_events(df)))).orderBy("conv_id", "n").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in got] == [
        (None, "user", "q"), (1, "", "first"), (1, "user", ""), (1, "assistant", "a"), (1, "assistant", "a"), (1, "assistant", "b"), (2, "assistant", "long " * 50_000)]
    assert CH.render(CH.fold(CH.message_events(df.limit(0)))).count() == 0
