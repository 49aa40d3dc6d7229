"""Operator 12: conversation prefix trie through fixed-length block hashing (DataFrame functions).

A node stands for a distinct sequence of first turns (role, text). The trie is
built from blocks of ``BLOCK`` turns instead of turn by turn:

1. Turns get their place in the conversation and a digest; a prefix is named by
   two running sums of 64-bit hashes over (place, digest), kept exactly as
   decimals, so names need no chain from turn to turn and equal prefixes get
   equal names whatever partition computes them.
2. Conversations are cut into blocks and grouped by (name of the prefix up to
   the block, name of the prefix behind it): copies and shared openings
   collapse here, with partial sums before the shuffle.
3. A block whose prefix is continued in one way only has the same members at
   all its turns: its turns become nodes as they are. Only where siblings
   diverge are the turns of the (already grouped) blocks grouped again.

Subtree sums need no walk over the tree. Each node is charged to its smallest
member; from the first depth where a conversation is the smallest member it
stays so to its end. So a subtree's sum is the running sum of that
conversation's own nodes from the depth down, plus the totals of all other
members: a second grouping of the same blocks with these totals as weights.

A conversation of any length is spread: places come from sorted ranges with
counted offsets, running sums from chunks of ``CHUNK`` turns. The digest of the
ids that end at a node is fed in order from packed pieces of 512 ids, so a node
with any number of them needs little memory (SHA-256 itself is sequential).

Defined results: a null role or text is empty; turns are ordered by turn (null
first), ties by the SHA-256 of (role, text); repeated rows are separate turns;
rows with a null conv_id belong to no conversation; id - id mod 20 of a negative
id is rounded towards zero; other columns are ignored; an empty table gives no
nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .frames import materialize

BLOCK = 4
CHUNK = 1024
IDS = 512
_WORD = r"[^\x20\x09-\x0D]+"
_SUM = "decimal(38,0)"


def _running(df: DataFrame, key: str, order: str, values: list[str], down: bool = False) -> DataFrame:
    """Columns ``values`` replaced by their sums along ``order`` (0, 1, ...; from the end with ``down``) within
    ``key``: sums inside chunks plus those of the chunks before, so no task holds more than a chunk's rows or
    a 1/CHUNK part of a key's rows."""
    way = (lambda c: F.desc(c)) if down else (lambda c: F.asc(c))
    df = df.withColumn("_chunk", F.floor(F.col(order) / CHUNK))
    inside = W.partitionBy(key, "_chunk").orderBy(way(order)).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(key).orderBy(way("_chunk")).rowsBetween(W.unboundedPreceding, -1)
    offsets = (df.groupBy(key, "_chunk").agg(*[F.sum(v).alias(f"_{v}") for v in values])
               .select(key, "_chunk", *[F.sum(f"_{v}").over(before).alias(f"_{v}") for v in values]))
    df = df.withColumns({v: F.sum(v).over(inside) for v in values})
    return (df.join(offsets, [key, "_chunk"])
            .withColumns({v: F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0)) for v in values})
            .drop("_chunk", *[f"_{v}" for v in values]))


def numbered(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, words): every turn's place from 0 in its conversation, digest and word count.

    Rows are range-partitioned by (conversation, turn, digest), so a giant conversation takes
    several partitions; a place is the rank in the partition plus the counts of earlier ones.
    """
    body, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = messages.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, body), 256).alias("digest"),
        F.regexp_count(body, F.lit(_WORD)).cast("long").alias("words"))
    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("digest")]
    placed = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .select("conv", "digest", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    first = placed.groupBy("conv", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    before = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = first.select("conv", "part", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(first, ["conv", "part"]).select("conv", (F.col("offset") + F.col("at") - F.col("start")).alias("pos"), "digest", "words")


def rebuild(turns: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """Turns of the rebuilt conversations: with h = crc32(decimal id) mod ``shared``, the first h turns of
    conversation id - id mod ``family``, then the own turns behind the first h."""
    h = lambda c: F.crc32(c.cast("string").cast("binary")) % shared
    own = turns.withColumn("h", h(F.col("conv")))
    heads = turns.where(F.col("pos") < shared - 1).withColumnRenamed("conv", "base")
    ids = own.select("conv", "h").distinct().withColumn("base", F.col("conv") - F.col("conv") % family)
    opening = ids.join(heads, "base").where("pos < h").select("conv", "pos", "digest", "words")
    held = heads.groupBy("base").agg(F.count("*").alias("held"))
    taken = ids.join(held, "base", "left").select("conv", F.least("h", F.coalesce("held", F.lit(0))).alias("taken"))
    rest = own.where("pos >= h").join(taken, "conv").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")
    return opening.unionByName(rest)


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, pos, p1, p2, words): the name of the prefix that ends with the turn."""
    named = turns.select("conv", "pos", "words", *[F.xxhash64(F.lit(s), "digest", "pos").cast(_SUM).alias(p) for s, p in ((1, "p1"), (2, "p2"))])
    return _running(named, "conv", "pos", ["p1", "p2"])


def _blocks(prefixes: DataFrame) -> DataFrame:
    """(conv, k, before, turns): block k of a conversation, the name of the prefix before it and its turns in order."""
    cut = prefixes.withColumns({"k": F.floor(F.col("pos") / BLOCK), "name": F.struct("p1", "p2")})
    rows = cut.groupBy("conv", "k").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "words"))).alias("turns"))
    ends = cut.where(F.col("pos") % BLOCK == BLOCK - 1).select("conv", (F.col("k") + 1).alias("k"), F.col("name").alias("before"))
    return rows.join(ends, ["conv", "k"], "left").withColumn("before", F.coalesce("before", _root()))


def _root() -> Column:
    return F.struct(F.lit(0).cast(_SUM).alias("p1"), F.lit(0).cast(_SUM).alias("p2"))


def _grouped(blocks: DataFrame, sums: list[Column], again: list[Column]) -> DataFrame:
    """One row per node below the root: (depth, name, before, words) and the aggregates.

    Blocks are grouped by their two names first; turns are grouped only where a prefix has several next blocks.
    ``again`` aggregates the results of ``sums`` once more.
    """
    by = ["k", "before", F.element_at("turns", -1)["name"].alias("after")]
    groups = blocks.groupBy(*by).agg(F.first("turns").alias("turns"), *sums)
    ways = groups.groupBy("k", "before").agg(F.count("*").alias("ways"))
    groups = materialize(groups.join(ways, ["k", "before"]), "blocks")
    cols = [c for c in groups.columns if c not in ("k", "before", "after", "turns", "ways")]
    inner = F.explode(F.transform("turns", lambda t, i: F.struct(
        (t["pos"] + 1).alias("depth"), t["name"].alias("name"), t["words"].alias("words"),
        F.when(i == 0, F.col("before")).otherwise(F.get("turns", i - 1)["name"]).alias("parent"))))
    turn = lambda rows: rows.select(inner.alias("t"), *cols).select("t.*", *cols)
    alone, split = turn(groups.where("ways = 1")), turn(groups.where("ways > 1"))
    return alone.unionByName(split.groupBy("depth", "name").agg(F.first("words").alias("words"), F.first("parent").alias("parent"), *again))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv): SHA-256 of each node's ids, ascending, comma-joined."""
    order = ["node", "conv"]
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def pack(batches):
        held, ids, count = None, [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([held]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])
        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (node != held or len(ids) >= IDS):
                    yield flush()
                    ids = []
                held = node
                ids.append(conv)
        if ids:
            yield flush()

    def digest(batches):
        held, h = None, None
        for batch in batches:
            out = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if node == held:
                    h.update(b",")
                else:
                    if h is not None:
                        out.append((held, h.hexdigest()))
                    held, h = node, hashlib.sha256()
                h.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out]), pa.array([x for _, x in out])], names=["node", "ends_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])
    packed = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(pack, "node string, first long, ids string")
    return packed.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(digest, "node string, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie over ``turns`` (conv, pos, digest, words) of ``conversations`` (conv, one row each):
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    prefixes = materialize(_prefixes(turns), "prefixes")
    blocks = materialize(_blocks(prefixes), "conv_blocks")
    ident = lambda d, name: F.concat_ws(":", d, name["p1"], name["p2"])
    root = _root()
    counted = [F.count("*").alias("n_convs"), F.min("conv").alias("rep")]
    nodes = _grouped(blocks, counted, [F.sum("n_convs").alias("n_convs"), F.min("rep").alias("rep")])
    top = conversations.agg(*counted).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), root.alias("name"), F.lit(0).cast("long").alias("words"),
        F.lit(None).cast(f"struct<p1:{_SUM},p2:{_SUM}>").alias("parent"), "n_convs", "rep")
    nodes = nodes.unionByName(top)
    nodes = materialize(nodes.select(
        ident(F.col("depth"), F.col("name")).alias("node"), "depth", "n_convs", "rep",
        F.when(F.col("depth") > 0, ident(F.col("depth") - 1, F.col("parent"))).alias("parent"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("value")), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    weights = nodes.groupBy(F.col("rep").alias("conv")).agg(
        F.sum("value").alias("total"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    # subtree sums: totals of all members, with the smallest member's own share counted from the node down
    summed = [F.sum("total").alias("total"), F.sum("leaf").alias("leaf")]
    below = _grouped(blocks.join(weights, "conv"), summed, summed).select(ident(F.col("depth"), F.col("name")).alias("node"), "total", "leaf")
    below = below.unionByName(weights.agg(*summed).where("leaf IS NOT NULL").select(ident(F.lit(0), root).alias("node"), "total", "leaf"))
    own = _running(nodes.select("rep", "depth", "node", F.col("value").alias("own")), "rep", "depth", ["own"], down=True)
    ends = prefixes.groupBy("conv").agg(F.max(F.struct("pos", "p1", "p2")).alias("e"))
    ends = conversations.join(ends, "conv", "left").select(
        F.when(F.col("e").isNull(), ident(F.lit(0), root)).otherwise(ident(F.col("e.pos") + 1, F.col("e"))).alias("node"), "conv")
    up = nodes.select(F.col("node").alias("parent"), F.col("rep").alias("parent_conv_id"))
    rep_total = weights.select(F.col("conv").alias("rep"), F.col("total").alias("rep_total"))
    return (nodes.join(below, "node").join(own.select("node", "own"), "node").join(rep_total, "rep")
            .join(_end_digests(ends), "node", "left").join(up, "parent", "left")
            .select(F.col("rep").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                    F.col("leaf").alias("n_leaves"), (F.col("total") - F.col("rep_total") + F.col("own")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def conversation_trie(messages: DataFrame, family: int | None = 20, shared: int = 4, conv_id: str = "conv_id", turn: str = "turn",
                      role: str = "role", text: str = "text") -> DataFrame:
    """Trie of the (with ``family``: rebuilt) conversations of a message table."""
    turns = materialize(numbered(messages, conv_id, turn, role, text), "places")
    conversations = turns.select("conv").distinct()
    return trie(rebuild(turns, family, shared) if family else turns.select("conv", "pos", "digest", "words"), conversations)
