"""Operator 6: chat formatting from an event log (DataFrame functions only).

The log holds, per conversation and turn, events in sequence: ``delta`` appends
streamed text, ``edit`` replaces the text so far, ``regenerate`` drops it (the
deltas behind it build the answer anew). ``fold`` groups the log by
conversation and turn (so one giant conversation is spread over its turns),
sorts by sequence and keeps what stands from the last edit or regeneration on.
``render`` joins the turns of a conversation in order into one string and the
spans of it that carry loss; ``read_back`` parses such strings again.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control strings (of
this template and of the bracketed one) inside texts get a backslash behind
their first character, or one more if they have some; reading takes one away.
In roles backslashes and line feeds are escaped as well.

Defined results: a null text is empty, a null role the empty role, an event of
unknown kind adds nothing; a null conversation id or turn is a value of its own
(turns: first); equal events (same turn, sequence, kind, role and text) count
once, different events of one sequence number go by kind, role, text; the role
is that of the turn's last event with one; extra columns are ignored; an empty
log gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LOSS_ROLES = ("assistant",)
# Fixed values of the templates.
START, END = "<|im_start|>", "<|im_end|>\n"
_TAILS = r"(\|im_start\|>|\|im_end\|>|/?INST\]|/?s>|</?SYS>>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])(\\*)" + _TAILS, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])\\(\\*)" + _TAILS, r"$1$2$3")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    mark = F.lit("\x00")  # stands for an escaped backslash while line feeds come back
    c = F.replace(F.replace(unescape(c), F.lit("\x00"), F.lit("\\0")), F.lit("\\\\"), mark)
    return F.replace(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\0"), F.lit("\x00")), mark, F.lit("\\"))


def message_events(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """An event log that a chat service would have written for finished messages.

    Assistant texts come as a draft that is regenerated and streamed in two
    deltas, others as a draft that is edited. Rows of one turn become separate
    turns in the order of role and text.
    """
    body, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    half = F.floor(F.length("text") / 2).cast("int")
    event = lambda k, op, t: F.struct(F.lit(k).cast("long").alias("seq"), F.lit(op).alias("op"), t.alias("text"))
    streamed = F.array(event(0, "delta", F.concat(F.lit("draft "), F.left("text", half))), event(1, "regenerate", F.lit("")),
                       event(2, "delta", F.left("text", half)), event(3, "delta", F.substr("text", half + 1)))
    edited = F.array(event(0, "delta", F.concat(F.lit("draft "), F.col("text"))), event(1, "edit", F.col("text")))
    rows = messages.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"), body.alias("text"))
    w = W.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = rows.withColumn("turn", F.struct("turn", F.row_number().over(w).alias("tie")))
    return (rows.withColumn("e", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(edited)))
            .select("conv_id", "turn", F.col("e.seq").alias("seq"), F.col("e.op").alias("op"), "role", F.col("e.text").alias("text")))


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the final message of every turn of an event log
    (conv_id, turn, seq, op, role, text); ``turn`` may be of any type that sorts."""
    log = F.array_sort(F.collect_set(F.struct("seq", "op", "role", "text")))
    g = events.groupBy("conv_id", "turn").agg(log.alias("log"))
    resets = lambda x: x["op"].isin("edit", "regenerate")
    last = F.coalesce(F.array_max(F.transform("log", lambda x, i: F.when(resets(x), i))), F.lit(-1))
    adds = lambda x: F.when(x["op"].isin("edit", "delta"), F.coalesce(x["text"], F.lit(""))).otherwise(F.lit(""))
    roles = F.filter("log", lambda x: x["role"].isNotNull())
    g = g.withColumn("_last", last)
    return g.select(
        "conv_id", "turn", F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(F.filter("log", lambda x, i: i >= F.col("_last")), adds), "").alias("text"))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, loss): one string per conversation and the spans (start, past) of it, in code
    points, that carry loss. Offsets come from a running sum over the turns, so cost stays linear in them."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = messages.select("conv_id", "turn", "role", F.length(head).alias("head"), escape(F.col("text")).alias("body"),
                           F.concat(head, escape(F.col("text")), F.lit(END)).alias("part"))
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("part").cast("long")).over(w), F.lit(0)) + F.col("head")
    rows = rows.withColumn("start", at).withColumn("past", F.col("start") + F.length("body"))
    span = F.when(F.col("role").isin(*loss_roles), F.struct("start", "past"))
    g = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "part", span.alias("span")))).alias("t"))
    return g.select("conv_id", F.array_join(F.transform("t", lambda x: x["part"]), "").alias("formatted"),
                    F.filter(F.transform("t", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, n, role, text, masked): the turns of rendered conversations; ``masked`` is the
    unescaped text that the loss spans cover, null without a span."""
    parts = rendered.select("conv_id", F.posexplode(F.split("formatted", r"<\|im_end\|>\n", -1)).alias("n", "part")).where("part <> ''")
    w = W.partitionBy("conv_id").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("at", F.coalesce(F.sum(F.length("part").cast("long") + len(END)).over(w), F.lit(0)))
    role = F.substr(F.substring_index("part", "\n", 1), F.lit(len(START) + 1))
    parts = parts.withColumn("raw_role", role).withColumn("start", F.col("at") + len(START) + F.length("raw_role") + 1)
    spans = rendered.select(F.col("conv_id").alias("c"), F.explode("loss").alias("s")).select("c", F.col("s.start").alias("a"), F.col("s.past").alias("z"))
    body = F.substr("part", F.lit(len(START) + 2) + F.length("raw_role"))
    return parts.join(spans, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("start") == F.col("a")), "left").select(
        "conv_id", "n", unescape_role(F.col("raw_role")).alias("role"), unescape(body).alias("text"),
        F.when(F.col("a").isNotNull(), unescape(F.substr("part", (F.col("a") - F.col("at") + 1).cast("int"), (F.col("z") - F.col("a")).cast("int")))).alias("masked"))
