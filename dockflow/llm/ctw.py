"""Operator 2: language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes (A-Z folded) and an end symbol, behind ``depth``
start symbols. Every byte is decomposed into eight binary decisions; for each
context of 0 to ``depth`` bytes each decision has counts of zeros and ones from
the training texts and their Krichevsky-Trofimov (KT) probability. A node's
weighted probability is half its own KT probability plus half the product of
its children's (contexts one byte longer); the deepest nodes have KT alone. So
the probability of a decision mixes the KT estimates of all depths, each
weighted by how well contexts of that depth predicted the training texts. The
counts stay as trained while texts are scored. A text's score is the log10
probability of its bytes and end; ``code_length`` is bits per symbol.

Beside it stands the unigram base score: words and one end token per text,
``log10((c + 0.5) / (N + 0.5 * (V + 1)))`` summed over the tokens.

Both scores are sums over a text's features (n-grams of depth + 1 bytes;
words) of a value from a table that grows with the corpus. Nothing of that
size is broadcast or collected:

1. A scan packs texts into groups, written compressed, with each group's
   distinct features and their training counts per hash bucket.
2. Buckets add up the counts of a feature over all groups.
3. n-grams are regrouped by their two newest context bytes; each such subtree
   is weighted bottom-up, its root passed on to the byte above, and these 256
   rows to the driver. The weights of depths 0 and 1 (a table of fixed size)
   go back to the subtrees, which give every n-gram its probability.
4. Buckets hand each group the values of its features in the order sent; the
   group's texts are scored from them.

A frequent word or n-gram is one entry per group, however many texts hold it.

Defined results: null texts are empty (one token, the end); a null id counts
as training; repeated rows are scored and counted each; without training
texts N = V = 0 and every decision has probability 1/2; extra columns are
ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .frames import materialize, partitions_for, ship, unpack

DEPTH = 5
#: Bytes of text in a group (a single longer text is a group of its own).
GROUP_BYTES = 16 << 20
#: Bytes of text handled at once inside a group (temporary arrays take about 60 bytes per byte).
SLICE = 1 << 19
#: Bytes of packed features in one Arrow batch, about.
OUT_BYTES = 4 << 20
START, END = 0xFE, 0xFF
GRAM = K.U(1 << 63)
END_TOKEN = K.mix(np.array([K.U(0xE0D)]))[0] >> K.U(1)


def held_out(doc_id: int | None) -> bool:
    """The contract's split: crc32 of the id as text, modulo 5, is 1."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def slice_features(data: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, their documents, n-gram keys, their documents) of a slice, with end token and end symbol."""
    n = len(off) - 1
    start, end, doc = K.word_spans(data, off)
    words = np.concatenate([K.span_hashes(data, start, end) >> K.U(1), np.full(n, END_TOKEN, K.U)])
    wdoc = np.concatenate([doc, np.arange(n)])
    owner = np.repeat(np.arange(n), np.diff(off))
    buf = np.full(len(data) + n * (depth + 1), START, np.uint8)
    at = np.arange(len(data)) + owner * (depth + 1) + depth
    buf[at] = K._LOWER[data]
    ends = off[1:] + np.arange(n) * (depth + 1) + depth
    buf[ends] = END
    code = np.zeros(max(0, len(buf) - depth), K.U)
    for k in range(depth + 1):
        code = (code << K.U(8)) | buf[k:k + len(code)]
    return words, wdoc, np.concatenate([code[at - depth], code[ends - depth]]) | GRAM, np.concatenate([owner, np.arange(n)])


def _group_slices(text: bytes, off: np.ndarray):
    """Slices of a packed group of texts."""
    data = np.frombuffer(text, np.uint8)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE, side="right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (K.mix(keys) % K.U(buckets)).astype(np.int64)


def group_keys(text: bytes, off: np.ndarray, train: np.ndarray, depth: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of a group in (bucket, key) order: (keys, training counts, buckets)."""
    keys, counts = np.zeros(0, K.U), np.zeros(0, np.uint32)
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def fold() -> None:
        nonlocal keys, counts, parts
        all_k = np.concatenate([keys, *[k for k, _ in parts]])
        all_c = np.concatenate([counts, *[c for _, c in parts]])
        o = np.argsort(all_k, kind="stable")
        all_k, all_c = all_k[o], all_c[o]
        at = np.flatnonzero(np.concatenate([[True], all_k[1:] != all_k[:-1]])) if len(all_k) else np.zeros(0, np.int64)
        keys, counts, parts = all_k[at], np.add.reduceat(all_c, at).astype(np.uint32) if len(at) else all_c, []
    for i, _, data, o in _group_slices(text, off):
        w, wd, g, gd = slice_features(data, o, depth)
        for k, d in ((w, wd), (g, gd)):
            u, c = np.unique(k, return_counts=True)
            if not train[i + d].all():
                t, tc = np.unique(k[train[i + d]], return_counts=True)
                c = np.zeros(len(u), np.uint32)
                c[np.searchsorted(u, t)] = tc
            parts.append((u, c.astype(np.uint32)))
        if len(parts) >= 16:
            fold()
    fold()
    b = _bucket(keys, buckets)
    o = np.argsort(b, kind="stable")
    return keys[o], counts[o], b[o]


def sliced_keys(text: bytes, off: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple]]:
    """A group's features once more, for scoring: all distinct keys, sorted, and of every slice its first and past
    document, the distinct keys and each occurrence's place among them of words (and their documents) and of n-grams."""
    sliced = []
    for i, j, data, o in _group_slices(text, off):
        w, wd, g, _ = slice_features(data, o, depth)
        (wu, wat), (gu, gat) = np.unique(w, return_inverse=True), np.unique(g, return_inverse=True)
        sliced.append((i, j, wu, wat.astype(np.int32), wd.astype(np.int32), gu, gat.astype(np.int32)))
    keys = np.concatenate([np.zeros(0, K.U), *[x[k] for x in sliced for k in (2, 5)]])
    keys.sort(kind="stable")  # sorted runs are merged
    return keys[np.flatnonzero(np.diff(keys, prepend=~keys[:1]))], sliced


def _scan(docs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Packed groups (bucket -1: ids, lengths, texts) and their features per bucket (keys, counts)."""
    schema = "grp long, bucket int, a binary, b binary, c binary"

    def rows(grp, bucket, a, b, c):
        return pa.RecordBatch.from_arrays([pa.array([grp] * len(bucket)), pa.array(bucket, pa.int32()), pa.array(a, pa.binary()),
                                           pa.array(b, pa.binary()), pa.array(c, pa.binary())], names=["grp", "bucket", "a", "b", "c"])

    def pack(ids, texts):
        grp = int.from_bytes(os.urandom(8), "little") >> 1  # a retried task writes a new group; only committed ones are read
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        text = b"".join(texts)
        known = np.array([i is not None for i in ids])
        ident = np.array([i or 0 for i in ids], np.int64)
        yield rows(grp, [-1], [np.concatenate([known.astype(np.int64), ident]).tobytes()], [off.tobytes()], [zlib.compress(text, 1)])
        keys, counts, b = group_keys(text, off, np.array([not held_out(i) for i in ids], bool), depth, buckets)
        at = np.flatnonzero(np.diff(b, prepend=-1))
        past = np.append(at[1:], len(b))
        out, size = [], 0
        for i, j in zip(at, past, strict=True):
            out.append((int(b[i]), K.packed(keys[i:j]), K.packed(counts[i:j].astype(np.uint32)), b""))
            size += len(out[-1][1]) + len(out[-1][2])
            if size >= OUT_BYTES:
                yield rows(grp, *zip(*out, strict=True))
                out, size = [], 0
        if out:
            yield rows(grp, *zip(*out, strict=True))
        del keys, counts, b, text
        K.trim()

    def run(batches):
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = t.as_buffer().to_pybytes() if t.is_valid else b""
                if held and held + len(t) > GROUP_BYTES:
                    yield from pack(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if ids:
            yield from pack(ids, texts)
    return docs.mapInArrow(run, schema)


def _add_counts(t: pa.Table) -> pa.Table:
    """Of one bucket: every feature with its total training count, and the bucket's tokens and token types."""
    keys = np.concatenate([K.unpacked(x.as_py(), K.U) for x in t.column("a")])
    n = np.concatenate([K.unpacked(x.as_py(), np.uint32) for x in t.column("b")])
    keys, inv = np.unique(keys, return_inverse=True)
    n = np.bincount(inv, n, len(keys)).astype(np.int64)
    w = keys < GRAM
    return pa.table({"bucket": pa.array([t.column("bucket")[0].as_py()], pa.int32()), "words": pa.array([keys[w].tobytes()], pa.binary()),
                     "n_words": pa.array([n[w].tobytes()], pa.binary()), "grams": pa.array([keys[~w].tobytes()], pa.binary()),
                     "n_grams": pa.array([n[~w].tobytes()], pa.binary()), "tokens": [int(n[w].sum())], "types": [int((n[w] > 0).sum())]})


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x >= 0.5 (Stirling's series after shifting x up)."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the KT probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _decisions(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary tree nodes (1..255) and bits of the eight decisions of each byte: two (n, 8) arrays."""
    lv = np.arange(8)
    s = sym.astype(np.int64)[:, None]
    return (1 << lv) | (s >> (8 - lv)), (s >> (7 - lv)) & 1


class Subtree:
    """The context nodes of depth ``top`` .. ``depth`` below one context of ``top`` bytes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int, top: int = 2):
        self.depth, self.top = depth, top
        sym = (codes & K.U(255)).astype(np.int64)
        ctx = [(codes >> K.U(8 * (d + 1))) & K.U(255) for d in range(depth)]  # newest byte first
        node, self.bit = _decisions(sym)
        n = np.broadcast_to(counts[:, None], node.shape).ravel()
        bit = self.bit.ravel()
        ident = np.zeros(len(codes), np.int64)  # context of the current depth
        self.at, self.zeros, self.ones, keys = {}, {}, {}, {}
        for d in range(top, depth + 1):
            if d > top:
                _, ident = np.unique(ident * 256 + ctx[d - 1].astype(np.int64), return_inverse=True)
            keys[d], inv = np.unique((ident[:, None] * 256 + node).ravel(), return_inverse=True)
            self.at[d] = inv
            self.ones[d] = np.bincount(inv, n * bit, len(keys[d]))
            self.zeros[d] = np.bincount(inv, n * (1 - bit), len(keys[d]))
        self.kt = {d: log_kt(self.zeros[d], self.ones[d]) for d in keys}
        self.pw = {depth: self.kt[depth]}
        for d in range(depth - 1, top - 1, -1):
            up = np.zeros(len(keys[d + 1]), np.int64)
            up[self.at[d + 1]] = self.at[d]
            below = np.bincount(up, self.pw[d + 1], len(keys[d]))
            self.pw[d] = np.logaddexp(self.kt[d], below) - np.log(2)
        self.nodes = (keys[top] % 256).astype(np.int64)

    def root(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(zeros, ones, log weighted probability) of the top context's 256 decision slots."""
        z, o, p = np.zeros(256), np.zeros(256), np.zeros(256)
        z[self.nodes], o[self.nodes], p[self.nodes] = self.zeros[self.top], self.ones[self.top], self.pw[self.top]
        return z, o, p

    def estimate(self, d: int) -> np.ndarray:
        z, o, at = self.zeros[d], self.ones[d], self.at[d]
        one = ((o + 0.5) / (z + o + 1))[at].reshape(-1, 8)
        return np.where(self.bit == 1, one, 1 - one)

    def decide(self) -> np.ndarray:
        """Probability of each decision of each n-gram, mixed over the depths of the subtree."""
        q = self.estimate(self.depth)
        for d in range(self.depth - 1, self.top - 1, -1):
            w = np.exp(self.kt[d] - self.pw[d] - np.log(2))[self.at[d]].reshape(-1, 8)
            q = w * self.estimate(d) + (1 - w) * q
        return q


def _upper(rows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """From the 256 contexts of depth 1 (byte, zeros, ones, log weighted): tables [byte, node, bit] of the part
    that depths 0 and 1 add to a decision's probability and [byte, node] of the weight left for deeper ones."""
    z, o, p = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
    for c, a, b, w in rows:
        z[c], o[c], p[c] = a, b, w
    kt1 = log_kt(z, o)
    z0, o0 = z.sum(0), o.sum(0)
    kt0 = log_kt(z0, o0)
    w0 = np.exp(kt0 - np.logaddexp(kt0, p.sum(0)))
    w1 = np.exp(kt1 - p - np.log(2))
    one0, one1 = (o0 + 0.5) / (z0 + o0 + 1), (o + 0.5) / (z + o + 1)
    add1 = w0 * one0 + (1 - w0) * w1 * one1
    add0 = w0 * (1 - one0) + (1 - w0) * w1 * (1 - one1)
    return np.stack([add0, add1], 2), (1 - w0) * (1 - w1)


def _probabilities(counts: DataFrame, depth: int) -> DataFrame:
    """(bucket, key, logp): log10 probability of the newest byte of every n-gram in its context."""
    spark = counts.sparkSession

    def spread(batches):
        for batch in batches:
            for k, n, b in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                key = np.frombuffer(k.as_buffer(), K.U)
                for i in range(0, len(key), 1 << 16):
                    part = key[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(((part >> K.U(8)) & K.U(0xFFFF)).astype(np.int32)), pa.array(K.as_i64(part)),
                         pa.array(np.frombuffer(n.as_buffer(), np.int64)[i:i + (1 << 16)]), pa.array([b] * len(part), pa.int32())],
                        names=["ctx", "key", "n", "bucket"])
    grams = counts.select("grams", "n_grams", "bucket").mapInArrow(spread, "ctx int, key long, n long, bucket int")

    def tree(t: pa.Table) -> Subtree:
        return Subtree(t.column("key").to_numpy().view(K.U), t.column("n").to_numpy(), depth)

    def roots(t: pa.Table) -> pa.Table:
        z, o, p = tree(t).root()
        return pa.table({"newest": pa.array([t.column("ctx")[0].as_py() & 255], pa.int32()), "v": pa.array([np.concatenate([z, o, p]).tobytes()], pa.binary())})

    def bytes_(t: pa.Table) -> pa.Table:
        v = sum(np.frombuffer(x.as_buffer(), float).reshape(3, 256) for x in t.column("v"))
        p = np.logaddexp(log_kt(v[0], v[1]), v[2]) - np.log(2)
        return pa.table({"newest": pa.array([t.column("newest")[0].as_py()], pa.int32()), "v": pa.array([np.concatenate([v[0], v[1], p]).tobytes()], pa.binary())})
    level1 = (grams.groupBy("ctx").applyInArrow(roots, "newest int, v binary")
              .groupBy("newest").applyInArrow(bytes_, "newest int, v binary").collect())  # at most 256 rows of 6 KB
    held = ship(spark, _upper([(r["newest"], *np.frombuffer(r["v"], float).reshape(3, 256)) for r in level1]))

    def final(t: pa.Table) -> pa.Table:
        add, rest = unpack(held)
        key = t.column("key").to_numpy().view(K.U)
        q = tree(t).decide()
        node, bit = _decisions(key & K.U(255))
        c = t.column("ctx")[0].as_py() & 255
        p = add[c][node, bit] + rest[c][node] * q
        return pa.table({"bucket": t.column("bucket"), "key": t.column("key"), "logp": np.log10(p).sum(1)})
    return grams.groupBy("ctx").applyInArrow(final, "bucket int, key long, logp double")


def _answers(requests: pa.Table, words: pa.Table, grams: pa.Table) -> pa.Table:
    """Of one bucket: for every group the values of the features it sent, in the order sent (counts of words, log
    probabilities of n-grams)."""
    wk = np.concatenate([np.frombuffer(x.as_buffer(), K.U) for x in words.column("words")] or [np.zeros(0, K.U)])
    wn = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in words.column("n_words")] or [np.zeros(0, np.int64)])
    gk = grams.column("key").to_numpy().view(K.U)
    o = np.argsort(gk)
    keys = np.concatenate([wk, gk[o]])  # words sort below n-grams
    values = np.concatenate([wn.astype(float), grams.column("logp").to_numpy()[o]])
    out = [values[np.searchsorted(keys, K.unpacked(x.as_py(), K.U))].tobytes() for x in requests.column("a")]
    return pa.table({"grp": requests.column("grp"), "bucket": requests.column("bucket"), "v": pa.array(out, pa.binary())})


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, code_length), one row per row of ``docs``."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = partitions_for(spark, size, 24 << 20)
    scan = materialize(_scan(own, depth, buckets), "ctw_scan")
    sent = scan.where("bucket >= 0").select("grp", "bucket", "a", "b")
    counts = materialize(sent.select("bucket", "a", "b").groupBy("bucket").applyInArrow(
        _add_counts, "bucket int, words binary, n_words binary, grams binary, n_grams binary, tokens long, types long"), "ctw_counts")
    total = counts.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    n_train, n_types = total["n"] or 0, total["v"] or 0
    logp = materialize(_probabilities(counts, depth), "ctw_logp")
    found = counts.select("bucket", "words", "n_words")
    # requests and both value tables meet per bucket; a cogroup has two sides, so the tables travel as one
    tables = found.select("bucket", "words", "n_words", F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("logp")).unionByName(
        logp.select("bucket", F.lit(None).cast("binary").alias("words"), F.lit(None).cast("binary").alias("n_words"), "key", "logp"))

    def answer(requests: pa.Table, values: pa.Table) -> pa.Table:
        import pyarrow.compute as pc
        if not requests.num_rows:
            return pa.table({"grp": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32()), "v": pa.array([], pa.binary())})
        is_gram = pc.is_valid(values.column("key"))
        return _answers(requests, values.filter(pc.invert(is_gram)), values.filter(is_gram))
    back = sent.select("grp", "bucket", "a").groupBy("bucket").cogroup(tables.groupBy("bucket")).applyInArrow(answer, "grp long, bucket int, v binary")
    norm = float(np.log10(n_train + 0.5 * (n_types + 1)))

    def finish(texts: pa.Table, values: pa.Table) -> pa.Table:
        known, ident = np.frombuffer(texts.column("a")[0].as_buffer(), np.int64).reshape(2, -1)
        off = np.frombuffer(texts.column("b")[0].as_buffer(), np.int64)
        text = zlib.decompress(texts.column("c")[0].as_py())
        order = np.argsort(values.column("bucket").to_numpy())
        got = np.concatenate([np.frombuffer(values.column("v")[int(k)].as_buffer(), float) for k in order])
        n = len(off) - 1
        tokens, hits, base, full = (np.zeros(n) for _ in range(4))
        keys, sliced = sliced_keys(text, off, depth)
        got = got[np.argsort(np.argsort(_bucket(keys, buckets), kind="stable"))]  # from the order sent to that of keys
        del text
        for i, j, w, wat, wd, g, gat in sliced:
            c = got[np.searchsorted(keys, w)][wat]
            m = j - i
            gd = np.concatenate([np.repeat(np.arange(m), np.diff(off[i:j + 1])), np.arange(m)])  # as in slice_features
            tokens[i:j] = np.bincount(wd, minlength=m)
            hits[i:j] = np.bincount(wd, c > 0, m)
            base[i:j] = np.bincount(wd, np.log10(c + 0.5), m)
            full[i:j] = np.bincount(gd, got[np.searchsorted(keys, g)][gat], m)
        del keys, got, sliced
        K.trim()
        ids = pa.array(ident, mask=known == 0)
        return pa.table({"doc_id": ids, "held_out": [held_out(x) for x in ids.to_pylist()], "n_tokens": tokens.astype(np.int64), "n_known": hits.astype(np.int64),
                         "train_tokens": np.full(n, n_train, np.int64), "base_score": base - tokens * norm, "score": full,
                         "code_length": -full * np.log2(10) / (np.diff(off) + 1)})
    return (scan.where("bucket < 0").select("grp", "a", "b", "c").groupBy("grp").cogroup(back.groupBy("grp")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, code_length double"))
