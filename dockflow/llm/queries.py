"""Registered queries ``opN_<name>`` of the subpackage, and their DuckDB text where SQL can express one."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.catalog import prepare
from . import chat as CH
from . import ctw as CT
from . import decontaminate as DC
from . import html_text as HT
from . import license_scan as LS
from . import ngram_join as NJ
from . import prefix_trie as PT
from . import quality_rules as QR
from . import sentencepiece_scan as SP
from . import shards as SH
from . import token_rollups as TR
from . import warc as WA
from . import whitening as WH
from .frames import materialize, scratch_path, small_batches, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            small_batches(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn
    return deco


@query("op3_quality_rules")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = QR.fit(docs, table(spark, sf_dir, "labels"))
    q = QR.PREFIX
    return QR.judged(docs, rules).select(
        "doc_id", *[F.col(q + c).alias(c) for c in QR.COUNTS[:5]],
        F.col(q + "base_failed").alias("base_failed"), F.col(q + "kept").alias("kept"))


@query("op10_ngram_join")
def op10(spark, sf_dir):
    return NJ.jaccard_components(table(spark, sf_dir, "documents"))


@query("op4_decontaminate")
def op4(spark, sf_dir):
    return DC.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_sentencepiece")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = SP.encode(docs.withColumn("plain", SP.plain_digest("text")))
    back = SP.decode(ids.drop("text"))
    return back.select(
        "doc_id", F.size("_ids").cast("long").alias("n_tokens"), F.col("_score").alias("score"),
        F.sha2(F.concat_ws(",", "_ids"), 256).alias("ids_sha256"), (SP.plain_digest("_decoded") == F.col("plain")).alias("round_trip"))


@query("op8_shards")
def op8(spark, sf_dir):
    placed = SH.assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op7_token_rollups")
def op7(spark, sf_dir):
    """Three batches over the whole tables: all documents arrive; toxic ones go; labelled good ones
    are revised under a second tokenizer. The second batch is committed twice."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    store = TR.RollupStore(spark, scratch_path(spark, "rollups"))
    store.commit(1, TR.inserts(TR.count_tokens(docs, "byte_bpe_50k")))
    toxic = TR.deletes(labels.where("toxic = 1"))
    store.commit(2, toxic)
    good = labels.where("quality = 1 AND toxic = 0").select("doc_id")
    store.commit(3, TR.revisions(TR.count_tokens(docs, "byte_bpe_multi_50k", TR.TOKENIZER_PATH_MULTI, only=good)))
    store.commit(2, toxic)
    return store.totals()


@query("op5_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest FROM p),
     g AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)
""")
def op5(spark, sf_dir):
    back = WA.round_trip(table(spark, sf_dir, "pages")).where("kind = 'record'")
    body = F.col("record_type") == "response"
    return back.select(
        "page_id", F.when(body, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(body, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")


@query("op6_chat_format", """
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, regexp_replace(text, '([<\\[])(\\\\*)(\\|im_start\\|>|\\|im_end\\|>|/?INST\\]|/?s>|</?SYS>>)', '\\1\\\\\\2\\3', 'g') AS esc FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(esc)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op6(spark, sf_dir):
    probe = "</s>[INST] ok [/INST]"
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    talks = talks.unionByName(spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], talks.schema))
    out = materialize(CH.render(CH.fold(CH.message_events(talks))), "rendered")
    turns = CH.read_back(out).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "role", "text", "masked"))).alias("t"))
    line = lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))
    digests = turns.select(
        F.col("conv_id").alias("c"), F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("t", line), ""), 256).alias("turns_sha256"),
        F.array_join(F.transform("t", lambda x: F.coalesce(x["masked"], F.lit(""))), "").alias("masked"))
    return out.join(digests, out["conv_id"].eqNullSafe(digests["c"])).select(
        "conv_id", "n_turns", "turns_sha256", F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@query("op9_html_text")
def op9(spark, sf_dir):
    return HT.extract(table(spark, sf_dir, "pages"))


@query("op2_ctw_score")
def op2(spark, sf_dir):
    return CT.score(table(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13(spark, sf_dir):
    return WH.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_prefix_trie", r"""
WITH m AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
     k AS (SELECT c, turn, sha256(octet_length(encode(role)) || ':' || role || text) AS digest,
                  CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words FROM m),
     p AS (SELECT c, digest, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) - 1 AS pos FROM k),
     b AS (SELECT DISTINCT c, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes FROM p),
     i AS (SELECT c, c - c % 20 AS base,
                  xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(bytes, lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1]))),
                                  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4 AS h FROM b),
     t AS (SELECT i.c, 0 AS part, p.pos, digest, words FROM i JOIN p ON p.c = i.base AND p.pos < i.h
           UNION ALL SELECT i.c, 1, p.pos, digest, words FROM i JOIN p ON p.c = i.c AND p.pos >= i.h),
     l AS (SELECT c, list(digest ORDER BY part, pos) AS ds, list(words ORDER BY part, pos) AS ws FROM t GROUP BY c),
     s AS (SELECT i.c, coalesce(ds, []) AS ds, coalesce(ws, []) AS ws FROM i LEFT JOIN l USING (c)),
     d AS (SELECT c, unnest(range(0, len(ds) + 1)) AS depth, ds, ws FROM s),
     n AS (SELECT c, depth, sha256(array_to_string(ds[1:depth], ',')) AS node, depth = len(ds) AS ends,
                  CASE WHEN depth > 0 THEN sha256(array_to_string(ds[1:depth - 1], ',')) END AS parent,
                  CASE WHEN depth > 0 THEN ws[depth] ELSE 0 END AS words FROM d),
     g AS (SELECT node, min(depth) AS depth, min(parent) AS parent, min(c) AS rep, count(*) AS n_convs, min(words) AS words,
                  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM n GROUP BY node),
     ch AS (SELECT parent AS node, count(*) AS n_children FROM g WHERE parent IS NOT NULL GROUP BY parent),
     sub AS (SELECT n.node, count(*) FILTER (ch.node IS NULL) AS n_leaves, CAST(sum((g.n_convs - 1) * g.words) AS BIGINT) AS saved_tokens
             FROM g JOIN n ON n.c = g.rep AND n.depth <= g.depth LEFT JOIN ch ON ch.node = g.node GROUP BY n.node)
SELECT g.rep AS conv_id, CAST(g.depth AS BIGINT) AS depth, u.rep AS parent_conv_id, g.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, g.ends_sha256
FROM g JOIN sub USING (node) LEFT JOIN ch USING (node) LEFT JOIN g AS u ON u.node = g.parent
""")
def op12(spark, sf_dir):
    return PT.conversation_trie(table(spark, sf_dir, "conversations"))


def _license_sql() -> str:
    """Every place and every block of every text, without any filter."""
    quoted = lambda t: "[" + ", ".join(f"'{w}'" for w in re.findall("[0-9a-z]+", t.text.lower())) + "]"
    rows = ",\n".join(f"({i}, '{t.label}', '{t.family}', {quoted(t)}, {t.percent}, {str(t.phrase).lower()})" for i, t in enumerate(LS.PHRASES + LS.NOTICES))
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
     v(id, label, family, ws, percent, phrase) AS (VALUES {rows}),
     t AS (SELECT *, len(list_distinct(ws)) AS size, CAST(greatest({LS.SMALLEST}, 2 ** ceil(log2(len(ws)))) AS BIGINT) AS step FROM v),
     u AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(0, len(ws))) AS pos FROM w),
     places AS (SELECT u.doc_id, t.label, u.pos FROM u JOIN t ON t.phrase AND t.ws[1] = u.word JOIN w ON w.doc_id = u.doc_id
                WHERE w.ws[u.pos + 1:u.pos + len(t.ws)] = t.ws),
     tok AS (SELECT DISTINCT id, step, unnest(ws) AS word FROM t WHERE NOT phrase),
     b AS (SELECT doc_id, n, id, step, word, unnest([pos // step - 1, pos // step]) AS k FROM u JOIN tok USING (word)),
     c AS (SELECT doc_id, n, id, step, k, count(DISTINCT word) AS overlap FROM b WHERE k >= 0 AND k < greatest(1, (n + step - 1) // step - 1) GROUP BY ALL),
     m AS (SELECT doc_id, label, family, k * c.step AS start, least((k + 2) * c.step, n) AS past, overlap, overlap / size AS containment
           FROM c JOIN t USING (id) WHERE 100 * overlap >= percent * size),
     best AS (SELECT doc_id, label FROM m QUALIFY rank() OVER (PARTITION BY doc_id, family, start, past ORDER BY containment DESC, overlap DESC) = 1),
     labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels
                FROM (SELECT doc_id, label FROM best UNION SELECT doc_id, label FROM places) GROUP BY doc_id),
     base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
              FROM places GROUP BY doc_id),
     score AS (SELECT doc_id, max(containment) AS score FROM (SELECT doc_id, containment FROM m UNION ALL SELECT doc_id, 1.0 FROM places) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN score USING (doc_id)
"""


@query("op11_license_scan", _license_sql())
def op11(spark, sf_dir):
    return LS.summary(LS.scan(table(spark, sf_dir, "documents")))
