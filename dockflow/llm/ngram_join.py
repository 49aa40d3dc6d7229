"""Operator 10: Jaccard self-join on 5-word shingles through PartEnum signatures.

A document's set holds its distinct 5-word shingles (64-bit hashes). Two sets
with similarity >= 0.8 and sizes s, t differ in at most (s + t) / 9 elements,
so in at most s / 4 for either of them. PartEnum turns this into equal
signatures:

* Sets are put in size bands (each 1.5 times the last); a set within 0.8 of
  its band's upper end also signs in the next band, so every pair that can
  link shares a band.
* In a band the feature domain is partitioned into groups, each group into
  three parts. At most s // 8 groups hold two or more differing elements; any
  other group agrees on at least two of its three parts. For each group the
  three subsets of two parts are enumerated; the contents of a subset (plus
  band, group and subset number) are one signature.
* Shingles that several different texts of one task share (passages that many
  documents hold) are *common*. They are left out of the partitioned domain,
  which changes nothing in the bounds: differing elements only get fewer. The
  set of common shingles is a bit table of fixed size, the same for all tasks;
  which shingles it flags only decides how well signatures separate.
* Empty subsets sign nothing, so a group only counts as *good* when all its
  subsets are non-empty. A set signs groups in order until it has more than
  s // 8 good ones: one of those agrees with any linked set. A set that never
  gets so many signs all groups and, among sets of that kind, the elements of
  its prefix (its first s - ceil(0.8 s) + 1 hashes).
* Small sets (up to 24, signing up to 30) use the domain's finest partition,
  one element each: all 3-element subsets of the first s - ceil(0.8 s) + 3.

No link can be missed. A candidate pair is first held against sketches of the
two sets (element counts in 128 bins, whose distance can't exceed the number
of differing elements), then verified on the full sets. Equal
sets are one *node* (a fingerprint of the set) before signing, so copies never
form pairs. Nodes under one signature are a *group*. Groups with the same
smallest node (their *center*) become one where that adds few pairs, so near
copies of a long text meet once for each center instead of once for each of the
many signatures they share. Groups are not expanded into all pairs: first
each node is checked against the smallest node it meets, then against the
node that a hash picks from each of its groups (``STARS`` times), and only
nodes that share a group and are still in different components after that are
compared with each other, by size and sketch first. This last round works in
cells of bounded size: a cell gets the sets of those nodes that sketches allow a
link for, joins components as it verifies, and gives only the links that
joined some, so its output never grows with the square of a group.

Signatures leave a task as packed blocks per hash bucket, the bucket count
follows the number of shingles, and a task sends a node once however many
copies it reads. The finished result has one row per document.

Defined results: null or empty text and texts without words have an empty set
(0 shingles) and link with nothing (component_id is their own id); with fewer
than five words the whole sequence is the one shingle; rows with a null id get
their set size and component_id null, and give links to nobody; repeated rows are
equal sets; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import is_broadcastable
from . import kernels as K
from .frames import BitFilter, bit_filter, components, materialize, partitions_for, ship, unpack

WIDTH = 5
SMALL, SMALL_PARTNER = 24, 30
GROUP = 7
#: Signatures that a task packs at once.
FLUSH = 1 << 18
#: Bytes of texts in a slice.
SLICE = 1 << 18
#: The groups of one center are merged up to so many nodes, or up to twice the nodes of the largest of them.
FEW = 32
#: Rounds in which the nodes of a group are checked against one of them.
STARS = 3
#: A shingle that so many different sets of one task share is common: it signs only where rare ones don't suffice.
COMMON = 3
COUNTED = 1 << 21
#: Bits of the table of common shingles. It holds the most shared ones, at most one per 16 bits: beyond that only
#: shingles that more sets share count as common, so the table never fills up however large the corpus is.
COMMON_BITS = 1 << 25
#: Bins of a set's sketch, one byte each.
BINS = 128
#: Rows of hits, and bytes of their sets, that one task compares in the last round.
CELL, CELL_BYTES = 1 << 13, 1 << 25
#: Pairs whose sketches are compared at once.
PAIRS = 1 << 14
#: Ids of documents whose sets are needed are broadcast up to this size, and joined by a shuffle beyond it.
IDS_BYTES = 64 << 20
_TAG = K.seeds(8, 901)


def band_tops(largest: int) -> list[int]:
    tops = [SMALL]
    while tops[-1] <= 2 * largest:
        tops.append(int(tops[-1] * 1.5))
    return tops


def slice_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle sets of a slice: (sorted hashes, document, set sizes)."""
    n = len(off) - 1
    start, end, doc = K.word_spans(data, off)
    h, d = K.shingles(K.span_hashes(data, start, end), doc, n, WIDTH)
    h, d = K.distinct_per_doc(h, d, n)
    return h, d, np.bincount(d, minlength=n).astype(np.int64)


def fingerprints(h: np.ndarray, d: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each set (order-free sums of mixed elements)."""
    a = np.zeros(len(sizes), K.U)
    b = np.zeros(len(sizes), K.U)
    np.add.at(a, d, K.mix(h + _TAG[0]))
    np.add.at(b, d, K.mix(h ^ _TAG[1]))
    return K.mix(a + K.mix(b + sizes.astype(K.U)))


def _small(h, first, sizes, out):
    for s in range(4, SMALL_PARTNER + 1):
        docs = np.flatnonzero(sizes == s)
        if not len(docs):
            continue
        p = s - (4 * s + 4) // 5 + 3
        m = K.mix(h[first[docs][:, None] + np.arange(p)])
        for x in itertools.combinations(range(p), 3):
            out.append((K.mix(m[:, x[0]] + m[:, x[1]] + m[:, x[2]] + _TAG[2]), docs))


def _large(h, common, first, sizes, out):
    if not len(sizes) or sizes.max() <= SMALL:
        return
    tops = np.array(band_tops(int(sizes.max())))
    docs = np.flatnonzero(sizes > SMALL)
    band = np.searchsorted(tops, sizes[docs])
    up = 5 * sizes[docs] > 4 * tops[band]
    docs, band = np.concatenate([docs, docs[up]]), np.concatenate([band, band[up] + 1])
    s = sizes[docs]
    groups = tops[band] // GROUP + 3
    base = np.concatenate([[0], np.cumsum(groups)])
    task = np.repeat(np.arange(len(docs)), s)
    at = np.arange(len(task)) - np.repeat(np.cumsum(s) - s, s) + first[docs][task]
    task, at = task[~common[at]], at[~common[at]]
    el = h[at]
    m = K.mix(el + K.mix(band.astype(K.U) + _TAG[3])[task])
    g = ((m >> K.U(32)) * groups.astype(K.U)[task] >> K.U(32)).astype(np.int64) + base[task]
    cell = g * 3 + ((m & K.U(0xFFFFFFFF)) % K.U(3)).astype(np.int64)
    n = np.bincount(cell, minlength=base[-1] * 3).reshape(-1, 3)
    content = np.zeros(base[-1] * 3, K.U)
    np.add.at(content, cell, K.mix(el ^ _TAG[4]))
    content = content.reshape(-1, 3)
    good = (n > 0).sum(1) >= 2
    owner = np.repeat(np.arange(len(docs)), groups)
    before = np.cumsum(good) - good
    before = before - before[base[:-1]][owner]
    signs = before <= (s // 8)[owner]
    number = K.mix((np.arange(base[-1]) - base[:-1][owner]).astype(K.U) + K.mix(band.astype(K.U) + _TAG[5])[owner])
    for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        use = np.flatnonzero(signs & (n[:, i] + n[:, j] > 0))
        out.append((K.mix(K.mix(content[use, i] + content[use, j] + K.U(k)) + number[use]), docs[owner[use]]))
    total = np.add.reduceat(good.astype(np.int64), base[:-1])
    for t in np.flatnonzero(total <= s // 8):
        p = h[first[docs[t]]:first[docs[t]] + s[t] - (4 * s[t] + 4) // 5 + 1]
        out.append((K.mix(p + K.mix(np.array([band[t]], K.U) + _TAG[6])), np.full(len(p), docs[t])))


def signatures(h: np.ndarray, d: np.ndarray, sizes: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of the sets of a slice: (signature, document). ``common`` flags elements."""
    common = np.zeros(len(h), bool) if common is None else common
    o = np.lexsort((h, common, d))  # the global order of elements: rare ones first, then by hash
    h, common = h[o], common[o]
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    out: list[tuple[np.ndarray, np.ndarray]] = []
    _small(h, first, sizes, out)
    _large(h, common, first, sizes, out)
    if not out:
        return np.zeros(0, K.U), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _keep(h, d, sizes, which):
    """The sets of the documents flagged in ``which``, renumbered."""
    m = which[d]
    return h[m], (np.cumsum(which) - 1)[d[m]], sizes[which]


def sketches(h: np.ndarray, d: np.ndarray, n_docs: int) -> np.ndarray:
    """Counts of each set's elements in ``BINS`` bins of the hash space, saturated at 255:
    the distance of two sketches never exceeds the number of differing elements."""
    c = np.bincount(d * BINS + (h % K.U(BINS)).astype(np.int64), minlength=n_docs * BINS)
    return np.minimum(c, 255).astype(np.uint8).reshape(n_docs, BINS)


def _sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, node, sketch, common) of rows (doc_id, text, key): set size, fingerprint and bin counts of
    every row (node null for an empty set), and rows with ``common`` alone: shingles that ``COMMON`` or more
    different sets of one task share, with how many."""
    names = ["doc_id", "key", "n", "node", "sketch", "common"]

    def shared(parts):
        h, n = np.unique(np.concatenate(parts), return_counts=True)
        h, n = h[n >= COMMON], n[n >= COMMON]
        report = h.tobytes() + n.astype(np.int64).tobytes()
        return pa.RecordBatch.from_arrays([*[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.binary()), pa.array([report], pa.binary())], names=names)

    def run(batches):
        seen: set[int] = set()
        parts, held = [], 0
        for batch in batches:
            for i, j, data, off in K.slices(batch, limit=SLICE):
                h, d, n = slice_sets(data, off)
                f = fingerprints(h, d, n)
                sk = pa.array([x.tobytes() for x in sketches(h, d, j - i)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(n), pa.array(K.as_i64(f), mask=n == 0), sk,
                                                  pa.nulls(j - i, pa.binary())], names=names)
                parts.append(_keep(h, d, n, _unseen(f, n, seen))[0])
                held += len(parts[-1])
                if held >= COUNTED:
                    yield shared(parts)
                    parts, held = [], 0
        if held:
            yield shared(parts)
        K.trim()
    return docs.mapInArrow(run, "doc_id long, key long, n long, node long, sketch binary, common binary")


def _unseen(f: np.ndarray, n: np.ndarray, seen: set[int]) -> np.ndarray:
    """Flags of the non-empty sets whose fingerprint this task meets for the first time."""
    new = np.zeros(len(n), bool)
    for k in np.flatnonzero(n > 0):
        if int(f[k]) not in seen:
            seen.add(int(f[k]))
            new[k] = True
    return new


def _common(info: DataFrame) -> DataFrame:
    """(h): the shingles that tasks reported as common, the most shared ones if they are too many for the table."""
    def fn(batch):
        both = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(0)]
        h, n = (np.concatenate([x[k * len(x) // 2:(k + 1) * len(x) // 2] for x in both]) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])
    shared = (info.where("common IS NOT NULL").select("common").mapInArrow(K.arrow_map(fn), "h long, n long")
              .groupBy("h").agg(F.floor(F.log2(F.sum("n"))).cast("int").alias("e")))
    shared = materialize(shared, "common")
    sizes = {r["e"]: r["count"] for r in shared.groupBy("e").count().collect()}  # at most 63 rows
    least, held = 64, 0
    while least > 0 and held + sizes.get(least - 1, 0) <= COMMON_BITS // 16:
        least -= 1
        held += sizes.get(least, 0)
    return shared.where(F.col("e") >= least).select("h")


def _packed(docs: DataFrame, buckets: int, common: BitFilter) -> DataFrame:
    """(bucket, block): signatures and their nodes, packed per bucket and flush."""
    held_common = ship(docs.sparkSession, common)

    def flush(parts):
        sig, node = (np.concatenate(x) for x in zip(*parts, strict=True))
        b = (sig % K.U(buckets)).astype(np.int64)
        o = np.argsort(b, kind="stable")
        sig, node, b = sig[o], node[o], b[o]
        at = np.flatnonzero(np.diff(b, prepend=-1))
        blocks = [sig[i:j].tobytes() + node[i:j].tobytes() for i, j in itertools.pairwise([*at, len(b)])]
        return pa.RecordBatch.from_arrays([pa.array(b[at].astype(np.int32)), pa.array(blocks, pa.binary())], names=["bucket", "block"])

    def run(batches):
        seen: set[int] = set()
        often = unpack(held_common)
        parts, held = [], 0
        for batch in batches:
            for _, _, data, off in K.slices(batch, limit=SLICE):
                h, d, n = slice_sets(data, off)
                f = fingerprints(h, d, n)
                new = _unseen(f, n, seen)
                h, d, n = _keep(h, d, n, new)
                sig, doc = signatures(h, d, n, often.has(h))
                if len(sig):
                    parts.append((sig, f[new][doc]))
                    held += len(sig)
                if held >= FLUSH:
                    yield flush(parts)
                    parts, held = [], 0
        if parts:
            yield flush(parts)
        K.trim()
    return docs.select("text").mapInArrow(run, "bucket int, block binary")


def _bucket_groups(t: pa.Table) -> pa.Table:
    """Of one bucket: every set of two or more nodes that share a signature, once: (grp, node, center)."""
    sig, node = [], []
    for x in t.column("block"):
        v = np.frombuffer(x.as_buffer(), K.U)
        sig.append(v[:len(v) // 2])
        node.append(v[len(v) // 2:])
    sig, node = np.concatenate(sig), np.concatenate(node)
    o = np.argsort(sig, kind="stable")
    sig, node = sig[o], node[o]
    twin = np.zeros(len(sig), bool)
    twin[1:] = sig[1:] == sig[:-1]
    twin[:-1] |= twin[1:]
    sig, node = sig[twin], node[twin]
    o = np.lexsort((node, sig))
    sig, node = sig[o], node[o]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[fresh], node[fresh]
    at = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    n = np.diff(np.append(at, len(sig)))
    at, n = at[n > 1], n[n > 1]
    rows = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    node = node[rows]
    if len(n):
        first = np.cumsum(n) - n
        ident = K.mix(np.add.reduceat(K.mix(node + _TAG[7]), first) + n.astype(K.U))
        _, once = np.unique(ident, return_index=True)
        pick = np.repeat(np.isin(np.arange(len(n)), once), n)
        grp, center = np.repeat(ident, n)[pick], np.repeat(node[first], n)[pick]
        node = node[pick]
    else:
        grp = center = node
    return pa.table({"grp": K.as_i64(grp), "node": K.as_i64(node), "center": K.as_i64(center)})


def _by_center(hits: DataFrame) -> DataFrame:
    """``hits`` (grp, node, center) with the groups of a center merged, where that makes at most ``FEW`` nodes or twice
    those of the largest group: every two nodes of a group still share one, with at most four times its pairs."""
    largest = hits.groupBy("center", "grp").agg(F.count("*").alias("m")).groupBy("center").agg(F.max("m").alias("m"))
    stars = materialize(hits.select("center", "node").distinct(), "stars")
    apart = materialize(stars.groupBy("center").agg(F.count("*").alias("u")).join(largest, "center")
                        .where(F.col("u") > F.greatest(F.lit(FEW), 2 * F.col("m"))).select("center"), "apart")
    return (stars.join(apart, "center", "left_anti").select(F.col("center").alias("grp"), "node", "center")
            .unionByName(hits.join(apart, "center", "left_semi").select("grp", "node", "center")))


def _sets(docs: DataFrame, reps: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, hashes): the sets of ``needed`` nodes, packed, once each.

    One document stands for a node (``reps``: node, doc_id); only the texts of
    these documents go through the workers again.
    """
    ids = materialize(reps.join(needed, "node", "left_semi").select("doc_id", F.col("node").alias("wanted")), "needed")
    n = ids.count()

    def run(batches):
        for batch in batches:
            for i, j, data, off in K.slices(batch, limit=SLICE):
                h, d, n = slice_sets(data, off)
                f = K.as_i64(fingerprints(h, d, n))
                b = np.concatenate([[0], np.cumsum(n)])
                hit = np.flatnonzero((n > 0) & (f == batch.column(1).slice(i, j - i).to_numpy()))  # an id may stand on several texts
                out = [h[b[k]:b[k + 1]].tobytes() for k in hit]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(f[hit]), pa.array(out, pa.binary())], names=["node", "hashes"])
    texts = docs.join(F.broadcast(ids) if is_broadcastable(ids, n, IDS_BYTES) else ids, "doc_id").select("text", "wanted")
    return texts.mapInArrow(run, "node long, hashes binary").dropDuplicates(["node"])


def _possible(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """The pairs whose sizes and sketches do not rule the similarity out (a necessary condition, so no link is lost)."""
    side = lambda x: info.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))

    def fn(batch):
        na, nb = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 4))
        sa, sb = (K.text_views(batch.column(k))[0].reshape(-1, BINS).astype(np.int16) for k in (3, 5))
        ok = (9 * np.abs(sa - sb).sum(1, dtype=np.int64) <= na + nb) & (5 * np.minimum(na, nb) >= 4 * np.maximum(na, nb))
        keep = pa.array(ok)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "sa", "nb", "sb")
            .mapInArrow(K.arrow_map(fn), "a long, b long"))


def _verified(pairs: DataFrame, info: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame | None:
    """The pairs (a, b) whose whole sets reach the similarity; None when sketches rule all of them out."""
    pairs = materialize(_possible(pairs, info), "pairs")
    if pairs.isEmpty():
        return None
    sets = materialize(_sets(docs, reps, pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()), "sets")
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b"))

    def fn(batch):
        ha, hb = batch.column(2), batch.column(3)
        ok = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            ok[k] = _linked(np.frombuffer(ha[k].as_buffer(), K.U), np.frombuffer(hb[k].as_buffer(), K.U))
        keep = pa.array(ok)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return materialize(both.select("a", "b", "ha", "hb").mapInArrow(K.arrow_map(fn), "a long, b long"), "links")


def _labelled(hits: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Hits of the groups that still span several components, with each node's component."""
    if labels is None:
        return hits.withColumn("comp", F.col("node"))
    with_comp = materialize(hits.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "hits")
    mixed = with_comp.groupBy("grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("grp")
    return with_comp.join(mixed, "grp", "left_semi")


def _dealt(rows: DataFrame, weight: Column, most: int) -> DataFrame:
    """``rows`` (grp, node, cluster, ...) with (c, p, q), the cell they are compared in: cells of about ``most`` weight.

    The groups of a cluster (those whose center lies in one component) share cells. A group above ``most`` is split
    into blocks of nodes, and every two blocks of it meet in a cell, so a cell never holds more than two blocks. Only
    groups and clusters above ``most`` are broadcast: there are at most total weight / ``most`` of each.
    """
    heavy = rows.groupBy("grp").agg(F.sum(weight).alias("w")).where(F.col("w") > most).select("grp", F.ceil(2 * F.col("w") / most).cast("long").alias("k"))
    wide = rows.groupBy("cluster").agg(F.sum(weight).alias("w")).where(F.col("w") > most).select("cluster", F.ceil(F.col("w") / most).cast("long").alias("parts"))
    cell = """CASE WHEN k IS NULL THEN array(named_struct('c', cluster, 'p', pmod(xxhash64(grp), coalesce(parts, 1L)), 'q', -1L))
        ELSE transform(sequence(0L, k - 1), x -> named_struct('c', grp, 'p', least(pmod(xxhash64(node), k), x), 'q', greatest(pmod(xxhash64(node), k), x))) END"""
    return (rows.join(F.broadcast(wide), "cluster", "left").join(F.broadcast(heavy), "grp", "left")
            .withColumn("cell", F.explode(F.expr(cell))).select(*rows.columns, "cell.c", "cell.p", "cell.q"))


def _group_pairs(grp: np.ndarray, at: np.ndarray, n: np.ndarray):
    """Of rows (group, position of the node, sizes by position): the pairs of a group's nodes whose sizes allow a
    link, as two arrays of positions, ``PAIRS`` at once."""
    o = np.lexsort((n[at], grp))
    grp, at, size = grp[o], at[o], n[at[o]]
    past = np.zeros(len(o), np.int64)  # partners of row i lie behind it and before past[i]
    for lo, hi in itertools.pairwise([*np.flatnonzero(np.diff(grp, prepend=~grp[:1])), len(o)]):
        past[lo:hi] = lo + np.searchsorted(4 * size[lo:hi], 5 * size[lo:hi], side="right")
    before = np.concatenate([[0], np.cumsum(past - np.arange(len(o)) - 1)])
    for k in range(0, int(before[-1]), PAIRS):
        flat = np.arange(k, min(k + PAIRS, int(before[-1])))
        i = np.searchsorted(before, flat, side="right") - 1
        yield at[i], at[i + 1 + flat - before[i]]


def _distances(sk: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.abs(sk[a] - sk[b]).sum(1, dtype=np.int64)


def _near_nodes(t: pa.Table) -> pa.Table:
    """Of a cell: the nodes with a partner in a group, in another component, that sizes and sketches allow a link with."""
    node, first, at = np.unique(t.column("node").to_numpy(), return_index=True, return_inverse=True)
    n = t.column("n").to_numpy()[first]
    comp = t.column("comp").to_numpy()[first]
    sk = K.text_views(t.column("sketch").take(pa.array(first)))[0].reshape(-1, BINS).astype(np.int16)
    near = np.zeros(len(node), bool)
    for a, b in _group_pairs(t.column("grp").to_numpy(), at, n):
        m = (comp[a] != comp[b]) & ~(near[a] & near[b])
        a, b = a[m], b[m]
        m = 9 * _distances(sk, a, b) <= n[a] + n[b]
        near[a[m]] = near[b[m]] = True
    return pa.table({"node": node[near]})


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Do two sorted sets reach the similarity?"""
    if len(x) > len(y):
        x, y = y, x
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * common >= 80 * (len(x) + len(y) - common)


def _cell_links(rows: pa.Table, members: pa.Table) -> pa.Table:
    """Of a cell (rows: grp, member; members: its nodes with their sets): links (a, b) that join whatever components are
    linked inside a group. Near ones are verified first, and components that are joined by then are not
    compared, so there are fewer links than components."""
    names = members.column("node").to_numpy()
    o = np.argsort(names)
    names, hashes = names[o], [members.column("hashes")[int(k)] for k in o]
    sets = [np.frombuffer(x.as_buffer(), K.U) for x in hashes]
    n = np.array([len(x) for x in sets], np.int64)
    comp = np.unique(members.column("comp").to_numpy()[o], return_inverse=True)[1]
    sk = K.text_views(members.column("sketch").take(pa.array(o)))[0].reshape(-1, BINS).astype(np.int16)
    label = np.arange(len(names))  # of each component, as joined so far
    links: list[tuple[int, int]] = []
    apart: set[int] = set()  # pairs found not to link, to be met in other groups
    for a, b in _group_pairs(rows.column("grp").to_numpy(), np.searchsorted(names, rows.column("member").to_numpy()), n):
        m = label[comp[a]] != label[comp[b]]
        a, b = a[m], b[m]
        d = _distances(sk, a, b)
        m = np.flatnonzero(9 * d <= n[a] + n[b])
        for i, j in zip(*(x[m[np.argsort(d[m])]].tolist() for x in (np.minimum(a, b), np.maximum(a, b))), strict=True):
            u, v = label[comp[i]], label[comp[j]]
            if u == v or i * len(names) + j in apart:
                continue
            if _linked(sets[i], sets[j]):
                links.append((names[i], names[j]))
                label[label == u] = v
            elif len(apart) < PAIRS * 16:
                apart.add(i * len(names) + j)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def node_links(docs: DataFrame, info: DataFrame) -> DataFrame | None:
    """(node, comp) of every node linked with another one; None when there is no link."""
    spark = docs.sparkSession
    total = info.agg(F.sum("n")).first()[0] or 0
    buckets = partitions_for(spark, int(total * 0.7 * 16))
    common = bit_filter(_common(info), COMMON_BITS)
    hits = materialize(_packed(docs, buckets, common).groupBy("bucket").applyInArrow(_bucket_groups, "grp long, node long, center long")
                       .dropDuplicates(["grp", "node"]), "hits")
    hits = materialize(_by_center(hits), "hits")
    rows = info.where("node IS NOT NULL AND doc_id IS NOT NULL")
    facts = rows.select("node", "n", "sketch").dropDuplicates(["node"])
    reps = materialize(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "reps")
    links, labels = None, None

    def add(more: DataFrame | None) -> None:
        nonlocal links, labels
        if more is not None:
            links = more if links is None else links.unionByName(more)
            labels = components(links)
    add(_verified(hits.where("center <> node").groupBy(F.col("node").alias("b")).agg(F.min("center").alias("a")).select("a", "b"), facts, docs, reps))
    for r in range(STARS):
        mixed = _labelled(hits, labels)
        heads = mixed.groupBy("grp").agg(F.min(F.struct(F.xxhash64("node", F.lit(r)).alias("h"), "node", "comp")).alias("c"))
        add(_verified(mixed.join(heads, "grp").where("comp <> c.comp")
                      .select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct(), facts, docs, reps))
    mixed = _labelled(hits, labels)
    heads = mixed.where("center = node").select("grp", F.col("comp").alias("cluster"))
    rows = materialize(mixed.select("grp", "node", "comp").join(heads, "grp").join(facts.select("node", "n"), "node"), "cells")
    near = materialize(_dealt(rows, F.lit(1), CELL).join(facts.select("node", "sketch"), "node")
                       .groupBy("c", "p", "q").applyInArrow(_near_nodes, "node long").distinct(), "near")
    if near.isEmpty():
        return labels
    cells = _dealt(materialize(rows.join(near, "node", "left_semi"), "cells"), 8 * F.col("n") + BINS, CELL_BYTES)
    sets = _sets(docs, reps, near).join(facts.select("node", "sketch"), "node")
    members = cells.select("c", "p", "q", "node", "comp").distinct().join(sets, "node")
    groups = cells.select("c", "p", "q", "grp", "node").toDF("c_", "p_", "q_", "grp", "member")  # names apart from those of members
    add(materialize(groups.groupBy("c_", "p_", "q_").cogroup(members.groupBy("c", "p", "q")).applyInArrow(_cell_links, "a long, b long"), "links"))
    return labels


def _classes(own: DataFrame) -> DataFrame:
    """(doc_id, key, n, grp), one row per row of ``own`` (doc_id, text, key): set size and component (null: no words)."""
    info = materialize(_sizes(own), "sets_info")
    labels = node_links(own.where("doc_id IS NOT NULL"), info.where("doc_id IS NOT NULL OR common IS NOT NULL"))
    info = info.where("common IS NULL")
    grouped = info.join(labels, "node", "left") if labels is not None else info.withColumn("comp", F.lit(None).cast("long"))
    return grouped.withColumn("grp", F.coalesce("comp", "node"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    grouped = _classes(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(0).cast("long").alias("key")))
    least = grouped.where("grp IS NOT NULL").groupBy("grp").agg(F.min("doc_id").alias("least"))
    return grouped.join(least, "grp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, of several texts of this id the one with
    the smallest hash. So texts that aren't linked all stay, also under one id. Rows that repeat id and text (null: empty)
    count once (of rows that differ in other columns the one with the smallest hash stays); rows without words link with
    nothing and stay, as do all rows with a null id."""
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    grouped = _classes(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), key.alias("key")))
    grouped = grouped.where("doc_id IS NOT NULL")
    heads = grouped.where("grp IS NOT NULL").groupBy("grp").agg(F.min(F.struct("doc_id", "key")).alias("h")).select("h.*")
    lone = grouped.where("grp IS NULL").select("doc_id", "key")
    heads = heads.unionByName(lone).distinct().select(F.col("doc_id").alias("_head"), F.col("key").alias("_key"))
    times = grouped.groupBy(F.col("doc_id").alias("_head"), F.col("key").alias("_key")).agg(F.count("*").alias("_times"))
    kept = docs.join(heads.join(times, ["_head", "_key"]), (docs[doc_id] == F.col("_head")) & (key == F.col("_key")))
    many = (kept.where("_times > 1").groupBy("_head", "_key")
            .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row")).select("_row.*"))
    return kept.where("_times = 1").select(*docs.columns).unionByName(many).unionByName(docs.where(F.col(doc_id).isNull()))
