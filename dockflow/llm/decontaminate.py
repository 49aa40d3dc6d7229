"""Operator 4: benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are sequences of lower-cased words. An item is *leaked* into a document
when some span of the document is within ``max_rate`` word edits per item word
of the whole item (insertions, deletions and replacements).

The CGK embedding walks a window from its first word; at step j it emits the
word under the pointer and advances by one random bit that depends only on j
and that word. Equal words keep two walks together, and after an edit they
tend to meet again, so edit distance becomes Hamming distance between the
emitted sequences. A repetition draws a walk and a few sampled steps; windows
whose sampled words equal those of an item window share its bucket. Windows
stand at every word of every document and at every word of every item. Their
size is that of the item less its edits and one word, rounded down to one of
``SIZES``, so an item always has two windows more than it may have edits. A
walk is abandoned as soon as a sampled word occurs in no item at that step.

Every hit is verified exactly: semi-global edit distance of the whole item
against the span of the document that the hit points to. So what is reported is
exact; what is found is a matter of the repetitions. Tests measure the recall
for every item length from 7 words on and every position of the edits.

Tables of item keys are broadcast in blocks of at most ``ITEM_BLOCK`` items, so
their size has a bound; more items mean more passes. A document is judged
inside one task from its own words, so nothing is shuffled by text.

Defined results: null and empty texts and items without words never match;
items of one word need that word alone as the whole document's span (distance
0); repeated items and ties each give their own row; the reported span is the
closest one, the earliest among equals; a null id stays null in the result;
extra columns are ignored (or passed through by ``drop_leaks``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .frames import ship, unpack

MAX_RATE = 0.15
REPETITIONS = 9
SAMPLES = 4
SIZES = (1, 2, 4, 8, 12)
ITEM_BLOCK = 4096
_STEPS = 2  # a walk has this many steps per word of the window


def item_words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    start, end, _ = K.word_spans(data, np.array([0, len(data)]))
    return K.span_hashes(data, start, end)


def window_size(n: int, max_rate: float) -> int:
    """Words of the windows of an item of ``n`` words: the largest class that leaves the item
    two windows more than it may have edits (the whole item where it may have none)."""
    limit = int(max_rate * n)
    return max(s for s in SIZES if s <= max(1, n - limit - 1 if limit else n))


def plan(size: int, repetitions: int, samples: int) -> list[tuple[np.uint64, list[int]]]:
    """Walk seed and sampled steps of every repetition. Every third one leaves step 0 out, so
    that a window whose first word is edited keeps a chance; it starts at step 1 or 2 instead."""
    rng = np.random.default_rng(4000 + size)
    steps = max(1, _STEPS * size)
    out = []
    for r in range(repetitions):
        first = int(rng.integers(1, 3)) if r % 3 == 2 and size > 2 else 0
        more = rng.choice(np.arange(first + 1, steps), min(samples - 1, steps - 1 - first), replace=False) if steps > 1 else []
        out.append((K.seeds(64, 77)[r % 64], [first, *sorted(int(x) for x in more)]))
    return out


def walk_keys(words: np.ndarray, at: np.ndarray, size: int, seed, sampled: list[int], tables=None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of the windows that start at ``at``: (key, start).

    ``tables`` (one per sampled step: 65,536 flags of the words that items show there)
    abandons windows that cannot share a bucket with any item.
    """
    bits = K.mix(words + seed)
    at = at.astype(np.int64)
    ptr = at.copy()
    key = np.zeros(len(at), K.U)
    take = 0
    for j in range(sampled[-1] + 1):
        inside = ptr < at + size
        pos = np.where(inside, ptr, 0)
        if j == sampled[take]:
            word = np.where(inside, words[pos], K.U(0))
            if tables is not None:
                live = tables[take][(word & K.U(0xFFFF)).astype(np.int64)]
                at, ptr, key, word, pos, inside = at[live], ptr[live], key[live], word[live], pos[live], inside[live]
            key = key + word * K._Q[take]
            take += 1
        if j < sampled[-1]:
            ptr = ptr + (((bits[pos] >> K.U(j % 64)) & K.U(1)).astype(np.int64) & inside)
    return K.mix(key), at


class ItemIndex:
    """Keys of all windows of a block of items, per size class and repetition."""

    def __init__(self, items: list[tuple], max_rate: float, repetitions: int = REPETITIONS, samples: int = SAMPLES):
        self.items = [(i, w) for i, w in ((i, item_words(t)) for i, t in items) if len(w)]
        self.max_rate = max_rate
        self.lens = np.array([len(w) for _, w in self.items], np.int64)
        self.first = np.cumsum(self.lens) - self.lens
        self.bits = np.concatenate([np.zeros(0, K.U), *(w for _, w in self.items)]) & K.U(63)
        self.classes = []
        for size in SIZES:
            mine = [k for k, (_, w) in enumerate(self.items) if window_size(len(w), max_rate) == size]
            if not mine:
                continue
            words = np.concatenate([self.items[k][1] for k in mine])
            lens = np.array([len(self.items[k][1]) for k in mine])
            first = np.cumsum(lens) - lens
            at = np.concatenate([np.arange(f, f + n - size + 1) for f, n in zip(first, lens, strict=True)])
            owner = np.searchsorted(first, at, side="right") - 1
            runs = []
            for seed, sampled in plan(size, repetitions, samples):
                key, _ = walk_keys(words, at, size, seed, sampled)
                o = np.argsort(key, kind="stable")
                runs.append((seed, sampled, self._flags(words, at, size, seed, sampled), key[o], np.array(mine)[owner[o]], (at - first[owner])[o]))
            self.classes.append((size, runs))
    @staticmethod
    def _flags(words, at, size, seed, sampled):
        out = []
        for k, j in enumerate(sampled):
            flags = np.zeros(65536, bool)
            # the word under the pointer at step j: walk again, sampling that step alone
            ptr, bits = at.copy(), K.mix(words + seed)
            for t in range(j):
                ok = ptr < at + size
                pos = np.where(ok, ptr, 0)
                ptr = ptr + (((bits[pos] >> K.U(t % 64)) & K.U(1)).astype(np.int64) & ok)
            ok = ptr < at + size
            w = np.where(ok, words[np.where(ok, ptr, 0)], K.U(0))
            flags[(w & K.U(0xFFFF)).astype(np.int64)] = True
            out.append(flags)
        return out

    def matches(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item index, distance, first word, words of the span) of every leak in a slice."""
        start, end, doc = K.word_spans(data, off)
        words = K.span_hashes(data, start, end)
        n_docs = len(off) - 1
        bounds = K.doc_bounds(doc, n_docs)
        found = []
        for size, runs in self.classes:
            pad = size // 4  # a document may lack the last words of a window
            counts = np.diff(bounds)
            if pad:
                padded = np.insert(words, np.repeat(bounds[1:], pad), K.U(0))
                pdoc = np.insert(doc, np.repeat(bounds[1:], pad), np.repeat(np.arange(n_docs), pad))
            else:
                padded, pdoc = words, doc
            m = len(padded) - size + 1
            if m <= 0:
                continue
            at = np.flatnonzero((pdoc[:m] == pdoc[size - 1:]) & (counts[pdoc[:m]] > 0))
            for seed, sampled, flags, keys, item, offset in runs:
                key, where = walk_keys(padded, at, size, seed, sampled, flags)
                lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
                n = hi - lo
                k = np.repeat(np.arange(len(where)), n)
                t = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + lo[k]
                d = pdoc[where[k]]
                found.append((d, item[t], where[k] - pad * d - offset[t]))  # the place among the unpadded words
        if not found:
            return []
        hits = self._possible(words, bounds, *(np.concatenate(c) for c in zip(*found, strict=True)))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: set[tuple[int, int, int, int]] = set()
        for d, it, s in hits:
            pat = self.items[it][1]
            limit = int(self.max_rate * len(pat))
            lo, hi = max(int(bounds[d]), s - limit), min(int(bounds[d + 1]), s + len(pat) + limit)
            if lo >= hi or (d, it, lo, hi) in done:
                continue
            done.add((d, it, lo, hi))
            if best.get((d, it), (1,))[0] == 0:
                continue  # an earlier exact copy: nothing can be closer
            around = set(words[lo:hi].tolist())
            if sum(w in around for w in pat.tolist()) < len(pat) - limit:
                continue  # within the limit at least so many of the item's words must stand there
            got = closest_span(pat, words[lo:hi])
            if got[0] <= limit:
                row = (got[0], lo + got[1] - int(bounds[d]), got[2] - got[1])
                best[d, it] = min(best.get((d, it), row), row)
        return [(d, it, *v) for (d, it), v in sorted(best.items())]

    def _possible(self, words: np.ndarray, bounds: np.ndarray, doc: np.ndarray, item: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
        """The distinct hits, in order, without those whose span lacks more of the item's words than
        the item may have edits. Words are looked up as one of 64 bits, so only some of the lacking
        ones are seen and no span within the limit is dropped."""
        order = np.lexsort((at, item, doc))
        doc, item, at = doc[order], item[order], at[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1])
        doc, item, at = doc[new], item[new], at[new]
        size = self.lens[item]
        limit = (self.max_rate * size).astype(np.int64)
        lo, hi = np.maximum(bounds[doc], at - limit), np.minimum(bounds[doc + 1], at + size + limit)
        live = lo < hi
        doc, item, at, size, limit, lo, hi = (c[live] for c in (doc, item, at, size, limit, lo, hi))
        if not len(doc):
            return []
        bit = K.U(1) << (words & K.U(63))
        seen = np.zeros(len(doc), K.U)  # the bits of the span's words: two overlapping runs of a power of two
        width = 1
        while True:
            mine = (hi - lo >= width) & (hi - lo < 2 * width)
            seen[mine] = bit[lo[mine]] | bit[hi[mine] - width]
            if 2 * width > int((hi - lo).max()):
                break
            bit[:-width] |= bit[width:].copy()
            width *= 2
        lacking = np.zeros(len(doc), np.int64)
        for i in range(int(size.max())):
            k = np.flatnonzero(size > i)
            lacking[k] += (seen[k] >> self.bits[self.first[item[k]] + i]) & K.U(1) == 0
        live = lacking <= limit
        return list(zip(doc[live].tolist(), item[live].tolist(), at[live].tolist(), strict=True))


def closest_span(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edit distance, first, past) of the span of ``text`` closest to the whole pattern:
    semi-global alignment, the earliest end among equals, then the latest start."""
    m = len(pattern)
    dist = list(range(m + 1))
    begin = [0] * (m + 1)
    best = (m, 0, 0)
    pat = pattern.tolist()
    for j, c in enumerate(text.tolist(), 1):
        diag, dbeg = 0, j - 1
        dist[0], begin[0] = 0, j
        for i in range(1, m + 1):
            up, ub = dist[i], begin[i]
            cost, b = diag + (pat[i - 1] != c), dbeg
            if up + 1 < cost or (up + 1 == cost and ub > b):
                cost, b = up + 1, ub
            if dist[i - 1] + 1 < cost or (dist[i - 1] + 1 == cost and begin[i - 1] > b):
                cost, b = dist[i - 1] + 1, begin[i - 1]
            diag, dbeg = up, ub
            dist[i], begin[i] = cost, b
        if dist[m] < best[0]:
            best = (dist[m], begin[m], j)
    return best


def _blocks(items: DataFrame, item_id: str, text: str, max_rate: float):
    """Broadcast indexes over blocks of at most about ``ITEM_BLOCK`` items."""
    spark = items.sparkSession
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("t IS NOT NULL")
    n = -(-rows.count() // ITEM_BLOCK)
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("t"), F.lit(n)) == b)
        got = sorted(part.collect(), key=lambda r: (r.i is None, r.i or 0, r.t))
        yield ship(spark, ItemIndex([(r.i, r.t) for r in got], max_rate))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", max_rate: float = MAX_RATE) -> DataFrame:
    """(doc_id, item_id, distance, first_word, span_words): every document and item that leaks into it."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, distance int, first_word long, span_words int"
    out = docs.sparkSession.createDataFrame([], schema)
    for held in _blocks(items, item_id, item_text, max_rate):
        def run(batches, held=held):
            index = unpack(held)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = []
                for i, _, data, off in K.slices(batch):
                    rows += [(ids[i + d], index.items[it][0], *v) for d, it, *v in index.matches(data, off)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()))],
                    names=["doc_id", "item_id", "distance", "first_word", "span_words"])
        out = out.unionByName(own.mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, columns unchanged."""
    for held in _blocks(items, item_id, item_text, max_rate):
        def run(batches, held=held):
            index = unpack(held)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, _, data, off in K.slices(batch, text):
                    for d, *_ in index.matches(data, off):
                        keep[i + d] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
