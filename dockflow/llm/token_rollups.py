"""Operator 7: token counts as delta-maintained rollups.

A store keeps three tables under one folder of shared storage, each with one
folder per batch:

* ``ledger/batch_id=K``: the state that batch K leaves behind for each document
  it changed (source, language, tokenizer version, tokens; or deleted);
* ``deltas/batch_id=K``: the signed sums of documents and tokens by source,
  language and tokenizer version that batch K adds to the totals;
* ``snapshot/batch_id=K``: the state of all documents after batch K, written
  once every ``COMPACT_EVERY`` batches. The state before a batch is read from
  the newest snapshot and the fewer than ``COMPACT_EVERY`` ledger folders behind
  it, cut down to the changed ids before anything is grouped; so a commit
  depends on the size of the corpus and of the batch, not on the number of
  batches before.

``commit`` turns changes into signed rows: minus the state before the batch,
plus the new state. An insert and a revision set a document's state, a delete
ends it; so a revision under another tokenizer version moves the counts
between the two versions. Totals are the sum of all deltas. A batch only reads
batches with smaller ids and writes its own folders, the deltas after the ledger. A
batch whose deltas are complete is committed, and committing it again does
nothing but finish its snapshot; one that was cut short is written anew. Batch
ids must grow: a new batch below a committed one is an error.

Defined results: a null or empty text has 0 tokens; a null source or language
is a group of its own; of several changes to one id in a batch the one with
the largest ``seq`` counts (ties: the largest row); deleting an unknown id does
nothing; inserts with a null id are counted and can't be revised or deleted;
extra columns are ignored.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from . import kernels as K
from .frames import bit_filter, materialize, ship, unpack

TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TOKENIZER_PATH_MULTI = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public split pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

ONLY_BITS = 1 << 23
COMPACT_EVERY = 8
GROUP = ["source", "lang", "version"]
STATE = "doc_id long, source string, lang string, version string, n_tokens long, deleted boolean"


def count_tokens(docs: DataFrame, version: str, path: str = TOKENIZER_PATH, pattern: str = PATTERN, doc_id: str = "doc_id",
                 text: str = "text", source: str = "source", lang: str = "lang", only: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens): byte-level BPE tokens of every whole text.

    The rank file is read on the driver (under 2 MB) and broadcast. With ``only``
    (a frame with ``doc_id``) just these documents are counted: a bit filter of
    fixed size spares the others the tokenizer, an exact join of the narrow
    result drops its false hits, so texts are not shuffled.
    """
    wanted = None if only is None else ship(docs.sparkSession, bit_filter(
        only.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("h")), ONLY_BITS))
    with open(path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in held.value.splitlines() if line)}
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        chosen = None if wanted is None else unpack(wanted)
        for batch in batches:
            if chosen is not None:
                ids = batch.column(0)
                hit = chosen.has(ids.fill_null(0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(hit))
            for i, j, _, _ in K.slices(batch, "text"):
                part = batch.slice(i, j - i)
                n = [len(enc.encode_ordinary(t)) if t else 0 for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([version] * len(n)), pa.array(n, pa.int64())],
                                                 names=["doc_id", "source", "lang", "version", "n_tokens"])
    out = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
           .mapInArrow(run, "doc_id long, source string, lang string, version string, n_tokens long"))
    return out if only is None else out.join(only.select("doc_id"), "doc_id", "left_semi")


def inserts(counted: DataFrame, seq: int = 0) -> DataFrame:
    return counted.select(*GROUP, "doc_id", "n_tokens", F.lit("insert").alias("op"), F.lit(seq).cast("long").alias("seq"))


def revisions(counted: DataFrame, seq: int = 0) -> DataFrame:
    return inserts(counted, seq).withColumn("op", F.lit("revise"))


def deletes(ids: DataFrame, doc_id: str = "doc_id", seq: int = 0) -> DataFrame:
    null = lambda t: F.lit(None).cast(t)
    return ids.select(null("string").alias("source"), null("string").alias("lang"), null("string").alias("version"),
                      F.col(doc_id).cast("long").alias("doc_id"), null("long").alias("n_tokens"),
                      F.lit("delete").alias("op"), F.lit(seq).cast("long").alias("seq"))


class RollupStore:
    """The three tables under ``root`` (a path that driver and executors share)."""

    def __init__(self, spark: SparkSession, root: str, compact_every: int = COMPACT_EVERY):
        self.spark, self.root, self.compact_every = spark, root.rstrip("/"), compact_every

    def _batches(self, table: str) -> list[int]:
        base = f"{self.root}/{table}"
        if not path_exists(self.spark, base):
            return []
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(base)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id=")
                      and path_exists(self.spark, f"{base}/{n}/_SUCCESS"))

    def _read(self, table: str, schema: str, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema + ", batch_id long")
        return (self.spark.read.schema(schema + ", batch_id long").option("basePath", f"{self.root}/{table}")
                .parquet(*[f"{self.root}/{table}/batch_id={b}" for b in batches]))

    def committed(self) -> list[int]:
        """Batch ids whose deltas are in the totals."""
        return self._batches("deltas")

    def _history(self, before: int | None) -> tuple[list[int], list[int]]:
        """(the newest snapshot, the ledger batches behind it) among committed batches below ``before``."""
        done = [b for b in self.committed() if before is None or b < before]
        base = [b for b in self._batches("snapshot") if b in set(done)][-1:]
        return base, [b for b in done if not base or b > base[0]]

    def ledger(self, before: int | None = None, ids: DataFrame | None = None) -> DataFrame:
        """The latest state of every document with an id (before a batch, of some ids, if given)."""
        base, behind = self._history(before)
        rows = self._read("ledger", STATE, behind)
        if base:
            rows = rows.unionByName(self._read("snapshot", STATE, base))
        rows = rows.where("doc_id IS NOT NULL")
        if ids is not None:
            rows = rows.join(ids, "doc_id", "left_semi")
        last = rows.groupBy("doc_id").agg(F.max_by(F.struct(*GROUP, "n_tokens", "deleted"), "batch_id").alias("s"))
        return last.select("doc_id", "s.*").where("NOT deleted").drop("deleted")

    def _compact(self, batch_id: int) -> None:
        """Write the snapshot after a committed batch once enough ledger batches lie behind the last one."""
        if len(self._history(batch_id + 1)[1]) >= self.compact_every:
            (self.ledger(batch_id + 1).withColumn("deleted", F.lit(False))
             .write.mode("overwrite").parquet(f"{self.root}/snapshot/batch_id={batch_id}"))

    def commit(self, batch_id: int, changes: DataFrame) -> None:
        """Apply one batch of changes (doc_id, op, source, lang, version, n_tokens, seq); safe to repeat."""
        done = self.committed()
        if batch_id in done:
            return self._compact(done[-1])
        later = [b for b in done if b > batch_id]
        if later:
            raise ValueError(f"batch {batch_id} comes after committed batches {later}")
        changes = materialize(changes.select("doc_id", "seq", "op", *GROUP, "n_tokens"), "changes")  # counted once, read twice
        fields = F.struct("seq", F.col("op"), *GROUP, "n_tokens")
        known = (changes.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(fields).alias("c")).select("doc_id", "c.*"))
        blank = changes.where("doc_id IS NULL AND op = 'insert'").select("doc_id", "seq", "op", *GROUP, "n_tokens")
        state = known.unionByName(blank).select(
            "doc_id", *GROUP, "n_tokens", (F.col("op") == "delete").alias("deleted"))
        state.write.mode("overwrite").parquet(f"{self.root}/ledger/batch_id={batch_id}")
        state = self._read("ledger", STATE, [batch_id])
        plus = state.where("NOT deleted").select(*GROUP, F.lit(1).alias("d"), F.col("n_tokens").alias("t"))
        minus = (self.ledger(batch_id, state.select("doc_id"))
                 .select(*GROUP, F.lit(-1).alias("d"), (-F.col("n_tokens")).alias("t")))
        delta = plus.unionByName(minus).groupBy(*GROUP).agg(F.sum("d").alias("d_docs"), F.sum("t").alias("d_tokens"))
        delta.write.mode("overwrite").parquet(f"{self.root}/deltas/batch_id={batch_id}")
        self._compact(batch_id)

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens): the sum of all deltas, groups without documents left out."""
        schema = "source string, lang string, version string, d_docs long, d_tokens long"
        return (self._read("deltas", schema, self.committed()).groupBy(*GROUP)
                .agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0"))


