"""Operator 1: SentencePiece encoding and decoding as a max-plus parallel scan.

An encoding is a path of pieces through the text. A path weighs the sum of its
piece scores; a step between two neighbouring pieces weighs minus infinity when
the model would never leave them side by side. For a BPE model that is the case
exactly when encoding their concatenation does not give back the two pieces:
the pairwise test is necessary and sufficient, so one path of finite weight is
left and it is the library's encoding. For a unigram model every step is
allowed and the heaviest path is the Viterbi segmentation.

A *state* at a cut is a piece that starts before the cut and ends at or after
it. A giant document is split into chunks; a chunk yields the max-plus matrix
of best weights from each state at its left cut to each state at its right
cut. Matrices combine associatively: blocks of ``FAN`` are multiplied per
task, level by level, until one matrix per document is left; its best entry
fixes the last state. Going down again, each block's known end states fix the
states at its inner cuts. Then each chunk is backtraced alone, between the two
states it was given. A document of one chunk is the one-matrix case and is
encoded where it is read.

Inside a chunk two neighbouring characters that occur side by side in no piece
force a cut, so the lattice falls into words; equal words share one lattice
result per task.

Defined results: null and empty texts give no ids (decoded: the empty string);
characters without a piece become byte pieces (or the unknown id when the model
has no bytes); ``U+2581`` in a text is a space after decoding, as in the library;
repeated rows and null ids are encoded like any other; all columns of the input
pass through, results are ``_ids`` and ``_score`` (such input columns are an error).
"""

from __future__ import annotations

import itertools
import re
import sys
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .frames import materialize, ship, unpack

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 16
FAN = 64
NEG = np.int64(-(1 << 60))
SPACE = "▁"
#: Words (and as many piece pairs) remembered per generation; two generations live in a Python worker.
CACHE_WORDS = 100_000
#: Words and ids that a task's word table holds at most (some 60 MB).
TABLE_WORDS, TABLE_IDS = 250_000, 4_000_000
#: Longest words, in characters, whose lattices are walked together.
TOGETHER = 48
#: Bytes of texts encoded at once: with their dummy prefixes below a power of two, to which the hash tables grow.
SLICE = 1_000_000
DECODE_ROWS = 256


@dataclass
class Pieces:
    """Tables of one model, small (a few megabytes) and shipped by broadcast."""

    text: list[str]
    weight: list[int]
    ids: dict[str, int]
    order: list[float]
    left: list[int]
    right: list[int]
    regular: list[bool]
    bytes_: dict[int, int]
    unknown: int
    bpe: bool
    longest: int
    joint: frozenset[str]

    @property
    def splits_at_space(self) -> bool:
        return not any(j[1] == SPACE and j[0] != SPACE for j in self.joint)


def _merge(symbols: list[str], rank: dict[str, float]) -> tuple[list[str], int]:
    """BPE from the definition: merge the best-ranked neighbours, leftmost first, until none is left.
    Also the length of the left part of the last merge."""
    symbols, cut = list(symbols), 0
    while True:
        best = min(((rank[a + b], i) for i, (a, b) in enumerate(itertools.pairwise(symbols)) if a + b in rank), default=None)
        if best is None:
            return symbols, cut
        i = best[1]
        cut = len(symbols[i])
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]


def load(path: str = MODEL_PATH) -> Pieces:
    """Read a model file on the driver. Only identity normalisation is supported."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = pb.ModelProto()
    proto.ParseFromString(sp.serialized_model_proto())
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only identity normalisation with a dummy prefix is supported")
    bpe = proto.trainer_spec.model_type == 2
    n = sp.get_piece_size()
    text = [sp.id_to_piece(i) for i in range(n)]
    usable = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
    ids = {text[i]: i for i in range(n) if usable[i]}
    score = [sp.get_score(i) for i in range(n)]
    weight = [round(s) if bpe else round(s * (1 << 20)) for s in score]
    order, left, right, regular = [-1.0] * n, list(range(n)), list(range(n)), [True] * n
    if bpe:
        rank = {t: -score[i] for t, i in ids.items() if len(t) > 1}
        for t, i in list(ids.items()):
            if len(t) == 1:
                continue
            got, cut = _merge(list(t), rank)
            if got != [t]:
                del ids[t]  # never the outcome of merging
                continue
            order[i] = rank[t]
            left[i], right[i] = (next((sp.piece_to_id(x) for x in [part]), i) for part in (t[:cut], t[cut:]))
        for t, i in ids.items():
            if len(t) > 1:
                a, b = left[i], right[i]
                regular[i] = order[a] < order[i] and order[b] < order[i] and set(t) != {SPACE}
    return Pieces(text, weight, ids, order, left, right, regular,
                  {int(text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}, sp.unk_id(), bpe,
                  max(map(len, ids)), frozenset(t[k:k + 2] for t in ids for k in range(len(t) - 1)))


class Lattice:
    """Forward and backward passes over one model's lattice."""

    def __init__(self, p: Pieces):
        self.p = p
        self.rank = {t: p.order[i] for t, i in p.ids.items() if len(t) > 1}
        self.words: dict[str, tuple[bytes, int]] = {}
        self.older: dict[str, tuple[bytes, int]] = {}
        self.pairs: dict[int, bool] = {}
        self.single = -1  # stands for a character without a piece
        cut = f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+" if p.splits_at_space and "\n" not in "".join(p.joint) else r"(?s).+"
        self.split = re.compile(cut)
        self.prefix = {t[:k]: -2 for t in p.ids for k in range(1, len(t))} | p.ids  # -2: only a prefix of pieces

    def allowed(self, a: int, b: int) -> bool:
        """Whether pieces a and b may stand side by side (weight 0, else minus infinity)."""
        p = self.p
        if not p.bpe or a < 0 or b < 0:
            return True
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= 2 * CACHE_WORDS:
                self.pairs.clear()
            got = self.pairs[key] = self._separate(a, b)
        return got

    def _separate(self, a: int, b: int) -> bool:
        """Whether encoding the text of two pieces gives these two pieces back."""
        p = self.p
        if not (p.regular[a] and p.regular[b]):
            x, y = p.text[a], p.text[b]
            return _merge(list(x + y), self.rank)[0] == [x, y]
        order, text, ids = p.order, p.text, p.ids
        limit = float("inf")
        while True:  # undo the merges of both pieces, latest first, looking for an earlier merge across
            c = ids.get(text[a] + text[b])
            if c is not None and order[c] < limit:
                return False
            if order[a] > order[b]:
                limit, a = order[a], p.right[a]
            elif order[b] < 0:
                return True
            else:
                limit, b = order[b] + 0.5, p.left[b]

    def ending(self, s: str, end: int, lowest: int) -> list[tuple[int, int]]:
        """(start, piece) of every piece that ends at ``end`` and starts at ``lowest`` or later, longest first."""
        ids = self.p.ids
        out = []
        for start in range(max(lowest, end - self.p.longest), end):
            i = ids.get(s[start:end])
            if i is not None:
                out.append((start, i))
        if not out or out[-1][0] != end - 1:
            out.append((end - 1, self.single))
        return out

    def value(self, piece: int) -> int:
        return self.p.weight[piece] if piece >= 0 else 0

    def forward(self, s: str, a: int, b: int, before: int | None) -> tuple[list[int], list[int], list[int | None]]:
        """Best path weights from position a (after piece ``before``) to every position up to b."""
        neg = int(NEG)
        score, back, last = [neg] * (b - a + 1), [0] * (b - a + 1), [None] * (b - a + 1)
        score[0], last[0] = 0, before
        prefix, weight, bpe = self.prefix, self.p.weight, self.p.bpe
        for start in range(a, b):
            here = score[start - a]
            if here == neg:
                continue
            prev, end, piece = last[start - a], start + 1, prefix.get(s[start])
            if piece is None or piece == -2:  # a character that is no piece itself
                if here > score[end - a]:
                    score[end - a], back[end - a], last[end - a] = here, start, self.single
            while piece is not None:
                to = end - a
                # with BPE one path at most is finite, so a position that is reached is settled
                if piece >= 0 and (score[to] == neg or (not bpe and here + weight[piece] > score[to])) and (prev is None or self.allowed(prev, piece)):
                    score[to], back[to], last[to] = here + weight[piece], start, piece
                if end == b:
                    break
                end += 1
                piece = prefix.get(s[start:end])
        return score, back, last

    def path(self, a: int, b: int, back: list[int], last: list) -> list[tuple[int, int]]:
        out = []
        while b > a:
            out.append((back[b - a], last[b - a]))
            b = back[b - a]
        return out[::-1]

    def emit(self, s: str, start: int, piece: int) -> list[int]:
        if piece >= 0:
            return [piece]
        return [self.p.bytes_.get(x, self.p.unknown) for x in s[start].encode()] if self.p.bytes_ else [self.p.unknown]

    def word(self, w: str) -> tuple[bytes, int]:
        """(ids as int32 bytes, weight) of a stretch between two forced cuts."""
        got = self.words.get(w)
        if got is None:
            got = self.older.get(w)
            if len(self.words) >= CACHE_WORDS:
                self.words, self.older = {}, self.words
            if got is not None:
                self.words[w] = got
                return got
            joint = self.p.joint
            cuts = [i for i in range(1, len(w)) if w[i - 1:i + 1] not in joint]
            if cuts:
                parts = [self.word(w[i:j]) for i, j in itertools.pairwise([0, *cuts, len(w)])]
                got = b"".join(x for x, _ in parts), sum(y for _, y in parts)
            else:
                score, back, last = self.forward(w, 0, len(w), None)
                ids = [i for start, piece in self.path(0, len(w), back, last) for i in self.emit(w, start, piece)]
                got = array("i", ids).tobytes(), score[-1]
            self.words[w] = got
        return got

    def stretches(self, s: str) -> list[str]:
        """``s`` cut before every run of spaces and around line feeds (forced cuts); ``word`` makes the others."""
        return self.split.findall(s)

    def encode(self, s: str) -> tuple[bytes, int]:
        got = list(map(self.word, self.stretches(s)))
        return b"".join(x for x, _ in got), sum(y for _, y in got)

    # chunks -----------------------------------------------------------------

    def states(self, s: str, cut: int, final: bool) -> list[tuple[int, int, int]]:
        """(start, end, piece) of every piece with start < cut <= end (end = cut in a final state), in a fixed order."""
        out = []
        for end in range(cut, cut + 1 if final else min(len(s), cut + self.p.longest) + 1):
            out += [(start, end, piece) for start, piece in self.ending(s, end, 0) if start < cut]
        return sorted(out)

    def forced(self, s: str, lo: int, hi: int) -> list[int]:
        """Forced cuts in [lo, hi]: neighbours that occur side by side in no piece."""
        joint = self.p.joint
        return [i for i in range(max(lo, 1), min(hi, len(s) - 1) + 1) if s[i - 1:i + 1] not in joint]

    def spans(self, s: str, lo: int, hi: int, first: bool, final: bool):
        """Entries and exits of the chunk [lo, hi) of ``s`` (with context) and the forced cuts nearest to both cuts."""
        entries = [(lo, lo, None)] if first else self.states(s, lo, False)
        exits = self.states(s, hi, final)
        cuts = [lo] if first else self.forced(s, max(e for _, e, _ in entries), hi - 1)
        if not cuts:
            return entries, exits, None, None
        return entries, exits, cuts[0], max([cuts[0], *self.forced(s, cuts[0], min(x[0] for x in exits))])

    def matrix(self, s: str, lo: int, hi: int, first: bool, final: bool) -> np.ndarray:
        """Max-plus transfer matrix of the chunk: entries x exits."""
        entries, exits, f, g = self.spans(s, lo, hi, first, final)
        m = np.full((len(entries), len(exits)), NEG, np.int64)

        def exits_from(a: int, before: int | None) -> np.ndarray:
            score, _, last = self.forward(s, a, hi - 1, before)
            v = np.full(len(exits), NEG, np.int64)
            for j, (start, _, piece) in enumerate(exits):
                if start >= a and score[start - a] > NEG and (last[start - a] is None or self.allowed(last[start - a], piece)):
                    v[j] = score[start - a] + self.value(piece)
            return v
        if f is None:
            for i, (_, e, piece) in enumerate(entries):
                m[i] = exits_from(e, piece)
            return m
        tail = exits_from(g, None)
        middle = self.encode(s[f:g])[1] if g > f else 0
        for i, (_, e, piece) in enumerate(entries):
            head = 0 if first else self.forward(s, e, f, piece)[0][-1]
            if head > NEG:
                m[i] = np.where(tail > NEG, tail + head + middle, NEG)
        return m

    def backtrace(self, s: str, lo: int, hi: int, first: bool, final: bool, entry: int, leave: int) -> bytes:
        """Ids of the pieces that start in the chunk, on the best path between two given states."""
        entries, exits, f, g = self.spans(s, lo, hi, first, final)
        _, a, before = entries[entry]
        stop, _, piece = exits[leave]
        out = []

        def piecewise(a: int, b: int, before: int | None) -> list[int]:
            _, back, last = self.forward(s, a, b, before)
            return [i for start, x in self.path(a, b, back, last) for i in self.emit(s, start, x)]
        if f is None:
            out = [np.array(piecewise(a, stop, before), np.int32).tobytes()]
        else:
            out = [np.array(piecewise(a, f, before) if not first else [], np.int32).tobytes(),
                   self.encode(s[f:g])[0] if g > f else b"", np.array(piecewise(g, stop, None), np.int32).tobytes()]
        return b"".join(out) + np.array(self.emit(s, stop, piece), np.int32).tobytes()


def _char_sums(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash over the characters, and the factors that make a stretch's sum independent
    of its place."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(K.U)
    p, q = K._power_tables(len(c) + 1)
    total = np.zeros(len(c) + 1, K.U)
    np.cumsum(K.mix(c + K.U(1)) * p[:len(c)], out=total[1:])
    return total, q


class WordTable:
    """Encodings of words as flat arrays, so that a slice of texts is encoded by gathering.

    A word is known by the 64-bit hash of its bytes and checked against the bytes themselves; the lattice
    only sees words that are new to the table. The table starts anew beyond ``TABLE_WORDS`` words or
    ``TABLE_IDS`` ids.
    """

    def __init__(self, lat: Lattice):
        self.lat = lat
        self.usable = lat.p.splits_at_space and "\n" not in "".join(lat.p.joint)
        self.slots = self.weights = None
        self.clear()

    def clear(self) -> None:
        self.number: dict[int, int] = {}
        self.raw: list[bytes] = []
        self.past, self.weight, self.ids = array("q", [0]), array("q"), array("i")

    def _numbers(self, hashes: list[int], words: list[bytes]) -> list[int]:
        """Places of words in the table; unknown ones are encoded and added."""
        raw = self.raw
        out = [k if (k := self.number.get(h, -1)) >= 0 and raw[k] == w else -1 for h, w in zip(hashes, words, strict=True)]
        new = [i for i, k in enumerate(out) if k < 0]
        if new:
            texts = [words[i].decode().replace(" ", SPACE) for i in new]
            for i, (ids, weight) in zip(new, self.paths(texts), strict=True):
                out[i] = self.number[hashes[i]] = len(raw)
                raw.append(words[i])
                self.ids.frombytes(ids)
                self.past.append(len(self.ids))
                self.weight.append(weight)
        return out

    def paths(self, words: list[str]) -> list[tuple[bytes, int]]:
        """(ids, weight) of words. Words of one length take the lattice's steps together (BPE models, where a
        position that is reached is settled); what that leaves open goes through ``Lattice.word`` singly."""
        out: list[tuple[bytes, int] | None] = [None] * len(words)
        if self.lat.p.bpe:
            lens = np.array([len(w) for w in words], np.int64)
            first = np.cumsum(lens) - lens
            sums = _char_sums("".join(words))
            for n in np.unique(lens[lens <= TOGETHER]).tolist():
                some = np.flatnonzero(lens == n)
                for at in range(0, len(some), 1 << 14):
                    part = some[at:at + (1 << 14)]
                    for k, got in zip(part.tolist(), self._together(first[part], n, sums), strict=True):
                        out[k] = got
        return [self.lat.word(w) if got is None else got for w, got in zip(words, out, strict=True)]

    def _together(self, base: np.ndarray, n: int, sums: tuple[np.ndarray, np.ndarray]) -> list[tuple[bytes, int] | None]:
        """Paths of the words of ``n`` characters that start at ``base``; None where a character is no piece."""
        lat, count = self.lat, len(base)
        weight = np.array(lat.p.weight, np.int64) if self.weights is None else self.weights
        self.weights = weight
        total, unshift = sums
        last = np.full((n + 1, count), -3, np.int64)  # piece that ends here; -3: not reached, -2: the word's start
        back, score = np.zeros((n + 1, count), np.int64), np.zeros((n + 1, count), np.int64)
        last[0] = -2
        for s in range(n):
            act = np.flatnonzero(last[s] != -3)
            origin, unit = total[base[act] + s], unshift[base[act] + s]
            for e in range(s + 1, min(n, s + lat.p.longest) + 1):
                if not len(act):
                    break
                piece = self._find(K.mix((total[base[act] + e] - origin) * unit + K.U(e - s)))
                i = np.flatnonzero((piece >= 0) & (last[e][act] == -3))
                if len(i):
                    prev, new = last[s][act[i]], piece[i]
                    known = [True if s == 0 else lat.pairs.get(k) for k in (prev << 32 | new).tolist()]
                    ok = np.array([lat.allowed(a, b) if g is None else g for g, a, b in zip(known, prev.tolist(), new.tolist(), strict=True)], bool)
                    w, new = act[i[ok]], new[ok]
                    last[e][w], back[e][w], score[e][w] = new, s, score[s][w] + weight[new]
                more = piece != -1
                act, origin, unit = act[more], origin[more], unit[more]
        done = last[n] != -3
        ids, at = np.full((count, n), -1, np.int32), np.where(done, n, 0)
        for step in range(n - 1, -1, -1):
            w = np.flatnonzero(at > 0)
            if not len(w):
                break
            ids[w, step] = last[at[w], w]
            at[w] = back[at[w], w]
        flat, edge = ids[ids >= 0].tobytes(), np.concatenate([[0], np.cumsum((ids >= 0).sum(1))]) * 4
        return [(flat[a:b], v) if ok else None for a, b, v, ok in zip(edge[:-1].tolist(), edge[1:].tolist(), score[n].tolist(), done.tolist(), strict=True)]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids by hash; -2 for texts that only begin a piece, -1 for others (open addressing)."""
        if self.slots is None:
            names = list(self.lat.prefix)
            lens = np.array([len(t) for t in names], np.int64)
            total, unshift = _char_sums("".join(names))
            past = np.cumsum(lens)
            keys = K.mix((total[past] - total[past - lens]) * unshift[past - lens] + lens.astype(K.U))
            bits = int(4 * len(names)).bit_length()
            slot_key, slot_id = np.zeros((1 << bits) + 64, K.U), np.full((1 << bits) + 64, -1, np.int64)
            for k, v in zip(keys.tolist(), self.lat.prefix.values(), strict=True):
                at = k >> (64 - bits)
                while slot_id[at] != -1:
                    at += 1
                slot_key[at], slot_id[at] = k, v
            self.slots = slot_key, slot_id, bits
        slot_key, slot_id, bits = self.slots
        at = (h >> K.U(64 - bits)).astype(np.int64)
        out = np.where(slot_key[at] == h, slot_id[at], -1)
        open_ = np.flatnonzero((slot_key[at] != h) & (slot_id[at] != -1))
        while len(open_):
            at[open_] += 1
            spot = at[open_]
            hit = slot_key[spot] == h[open_]
            out[open_[hit]] = slot_id[spot[hit]]
            open_ = open_[~hit & (slot_id[spot] != -1)]
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a slice of texts: (ids, ids before each text and in all, path weights)."""
        if len(self.raw) > TABLE_WORDS or len(self.ids) > TABLE_IDS:
            self.clear()
        some = np.diff(off) > 0
        off = off + np.concatenate([[0], np.cumsum(some)])
        buf = np.insert(data, off[:-1][some] - np.arange(some.sum()), 32)  # the dummy prefix
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64), np.zeros(len(some), np.int64)
        space, line = buf == 32, buf == 10
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[1:] |= line[1:] != line[:-1]
        cut[off[:-1][some]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(buf))
        h, first, which = np.unique(K.span_hashes(buf, start, end, lower=False), return_index=True, return_inverse=True)
        text = buf.tobytes()
        words = [text[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        k = np.array(self._numbers(h.tolist(), words), np.int64)[which]
        past, ids = np.frombuffer(self.past, np.int64), np.frombuffer(self.ids, np.int32)
        n = (past[1:] - past[:-1])[k]
        before = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(before[-1]) + np.repeat(past[k] - before[:-1], n)
        edge = np.searchsorted(start, off)
        total = np.concatenate([[0], np.cumsum(np.frombuffer(self.weight, np.int64)[k])])
        return ids[at], before[edge], np.diff(total[edge])


def word_table(lat: Lattice) -> WordTable:
    """The word table that lives with a lattice."""
    if getattr(lat, "table", None) is None:
        lat.table = WordTable(lat)
    return lat.table


def lattice(held) -> Lattice:
    """The lattice of a broadcast model, kept with its word cache for the life of a Python worker
    (results don't depend on what the cache holds)."""
    kept = sys.__dict__.setdefault("_sentencepiece_lattices", {})
    if held.value not in kept:
        kept.clear()
        kept[held.value] = Lattice(unpack(held))
    return kept[held.value]


def marked(text: str) -> str:
    """The library's identity normalisation: dummy prefix, spaces as ``U+2581``."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    out = np.maximum((a[:, :, None] + b[None, :, :]).max(1), NEG)
    out[out < NEG // 2] = NEG
    return out


def _pack(m: np.ndarray) -> bytes:
    return np.array(m.shape, np.int64).tobytes() + np.ascontiguousarray(m, np.int64).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    v = np.frombuffer(b, np.int64)
    return v[2:].reshape(v[0], v[1])


def _fresh(df: DataFrame, names: list[str]) -> None:
    clash = [c for c in df.columns if c in names]
    if clash:
        raise ValueError(f"input already has result columns: {clash}")


def _list_array(blobs: list[bytes]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(blobs), np.int32)))


def _encode_short(docs: DataFrame, held, text: str) -> DataFrame:
    schema = T.StructType(docs.schema.fields + [T.StructField("_ids", T.ArrayType(T.IntegerType())), T.StructField("_score", T.LongType())])

    def run(batches):
        lat = lattice(held)
        table = word_table(lat)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text))
            for i, j, data, off in K.slices(batch, text, SLICE):
                part = batch.slice(i, j - i)
                if table.usable and SPACE.encode() not in data.tobytes():
                    ids, edge, score = table.encode(data, off)
                    lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids))
                else:  # texts that hold the space mark itself, models with pieces across spaces or lines
                    got = [lat.encode(marked(x or "")) for x in col.slice(i, j - i).to_pylist()]
                    lists, score = _list_array([x for x, _ in got]), np.array([y for _, y in got], np.int64)
                yield pa.RecordBatch.from_arrays(part.columns + [lists, pa.array(score)], names=part.schema.names + ["_ids", "_score"])
        table.clear()  # the worker goes on to other tasks, also of other stages
        K.trim()
    return docs.mapInArrow(run, schema)


def _chunks(docs: DataFrame, held, text: str, chunk: int) -> DataFrame:
    """(row, k, last, lo, hi, s): chunks of the marked text with context on both sides."""
    def run(batches):
        ctx = unpack(held).longest
        for batch in batches:
            for row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = marked(t)
                cuts = [*range(0, len(s) - chunk // 2, chunk), len(s)] if len(s) > chunk else [0, len(s)]
                for k, (lo, hi) in enumerate(itertools.pairwise(cuts)):
                    a, b = max(0, lo - ctx), min(len(s), hi + ctx)
                    yield pa.RecordBatch.from_pydict({"row": [row], "k": [k], "last": [hi == len(s)], "lo": pa.array([lo - a], pa.int32()),
                                                      "hi": pa.array([hi - a], pa.int32()), "s": [s[a:b]]})
    return docs.select("_row", F.col(text).alias("t")).mapInArrow(run, "row long, k long, last boolean, lo int, hi int, s string")


def _product(t: pa.Table) -> pa.Table:
    rows = sorted(zip(t.column("k").to_pylist(), t.column("m").to_pylist(), strict=True))
    m = _unpack(rows[0][1])
    for _, b in rows[1:]:
        m = max_plus(m, _unpack(b))
    return pa.table({"row": [t.column("row")[0].as_py()], "k": [rows[0][0] // FAN], "m": [_pack(m)]})


def _descend(ends: pa.Table, parts: pa.Table) -> pa.Table:
    """States at the inner cuts of a block whose end states are known: forward weights, then the best state back from the end."""
    rows = sorted(zip(parts.column("k").to_pylist(), parts.column("m").to_pylist(), strict=True))
    ms = [_unpack(b) for _, b in rows]
    entry, leave = ends.column("entry")[0].as_py(), ends.column("leave")[0].as_py()
    v = [np.where(np.arange(ms[0].shape[0]) == entry, 0, NEG)]
    for m in ms[:-1]:
        v.append(max_plus(v[-1][None, :], m)[0])
    states = [leave]
    for k in range(len(ms) - 1, 0, -1):
        states.append(int(np.argmax(np.where((v[k] > NEG) & (ms[k][:, states[-1]] > NEG), v[k] + ms[k][:, states[-1]], NEG))))
    states = [entry, *states[::-1]]
    return pa.table({"row": [parts.column("row")[0].as_py()] * len(ms), "k": [k for k, _ in rows],
                     "entry": pa.array(states[:-1], pa.int32()), "leave": pa.array(states[1:], pa.int32())})


def _encode_long(docs: DataFrame, held, text: str, chunk: int) -> DataFrame:
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "sp_long")
    chunks = materialize(_chunks(rows, held, text, chunk), "sp_chunks")

    def matrices(batches):
        lat = lattice(held)
        for batch in batches:
            out = [_pack(lat.matrix(r["s"], r["lo"], r["hi"], r["k"] == 0, r["last"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["row", "k", "m"])
    levels = [materialize(chunks.mapInArrow(matrices, "row long, k long, m binary"), "sp_level")]
    while levels[-1].where("k > 0").limit(1).count():
        levels.append(materialize(levels[-1].withColumn("b", F.expr(f"k div {FAN}")).groupBy("row", "b")
                                  .applyInArrow(_product, "row long, k long, m binary"), "sp_level"))

    def top(batches):
        for batch in batches:
            ms = [_unpack(b) for b in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([0] * len(ms), pa.int32()),
                 pa.array([int(np.argmax(m[0])) for m in ms], pa.int32()), pa.array([int(m[0].max()) for m in ms], pa.int64())],
                names=["row", "k", "entry", "leave", "score"])
    tops = levels[-1].mapInArrow(top, "row long, k long, entry int, leave int, score long")
    ends = tops.select("row", "k", "entry", "leave")
    for level in levels[-2::-1]:
        ends = ends.groupBy("row", "k").cogroup(level.withColumn("b", F.expr(f"k div {FAN}")).groupBy("row", "b")).applyInArrow(
            _descend, "row long, k long, entry int, leave int")

    def trace(batches):
        lat = lattice(held)
        for batch in batches:
            out = [lat.backtrace(r["s"], r["lo"], r["hi"], r["k"] == 0, r["last"], r["entry"], r["leave"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _list_array(out)], names=["row", "k", "ids"])
    ids = (chunks.join(ends, ["row", "k"]).select("row", "k", "last", "lo", "hi", "s", "entry", "leave")
           .mapInArrow(trace, "row long, k long, ids array<int>")
           .groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("_ids"))
           .join(tops.select("row", F.col("score").alias("_score")), "row"))
    return rows.join(ids, rows["_row"] == ids["row"]).select(*[rows[c] for c in docs.columns], "_ids", "_score")


def encode(docs: DataFrame, text: str = "text", model_path: str = MODEL_PATH, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with ``_ids`` (array of int) and ``_score`` (path weight; piece scores summed)."""
    _fresh(docs, ["_ids", "_score", "_row"])
    pieces = load(model_path)
    if chunk < 2 * pieces.longest:
        raise ValueError(f"chunk must be at least {2 * pieces.longest} characters")
    held = ship(docs.sparkSession, pieces)
    size = F.coalesce(F.length(text), F.lit(0))
    return _encode_short(docs.where(size < chunk), held, text).unionByName(_encode_long(docs.where(size >= chunk), held, text, chunk))


def plain_digest(text: str) -> Column:
    """Digest of a text as decoding can give it back (null as empty, ``U+2581`` as a space)."""
    return F.sha2(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE), F.lit(" ")), 256)


def _texts(ids: np.ndarray, edge: np.ndarray, flat: np.ndarray, past: np.ndarray) -> pa.Array:
    """The texts of id lists (list k: ``ids[edge[k]:edge[k + 1]]``), the dummy prefix taken off."""
    n = (past[1:] - past[:-1])[ids]
    before = np.concatenate([[0], np.cumsum(n)])
    data = flat[np.arange(before[-1]) + np.repeat(past[ids] - before[:-1], n)]
    off = before[edge]
    prefix = off[:-1][np.diff(off) > 0]
    prefix = prefix[data[prefix] == 32]
    data, off = np.delete(data, prefix), off - np.searchsorted(prefix, off)
    raw = data.tobytes()
    starts = off[:-1][off[:-1] < len(data)]
    try:
        raw.decode()
        whole = not ((data[starts] & 0xC0) == 0x80).any()  # no text starts inside a character
    except UnicodeDecodeError:
        whole = False
    if whole:
        return pa.StringArray.from_buffers(len(off) - 1, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(raw))
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(off.tolist())], pa.string())


def decode(df: DataFrame, ids: str = "_ids", out: str = "_decoded", model_path: str = MODEL_PATH) -> DataFrame:
    """``df`` with the text of an id array; broken byte runs become ``U+FFFD``, null ids the empty string."""
    _fresh(df, [out])
    p = load(model_path)
    table = [t.replace(SPACE, " ").encode() for t in p.text]
    for byte, i in p.bytes_.items():
        table[i] = bytes([byte])
    if p.unknown >= 0:
        table[p.unknown] = " ⁇ ".encode()
    held = ship(df.sparkSession, (np.frombuffer(b"".join(table), np.uint8), np.cumsum([0, *map(len, table)])))
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])

    def run(batches):
        flat, past = unpack(held)
        for batch in batches:
            for at in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(at, DECODE_ROWS)
                col = part.column(part.schema.get_field_index(ids))
                edge = np.concatenate([[0], np.cumsum(np.nan_to_num(pc.list_value_length(col).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64))])
                yield pa.RecordBatch.from_arrays(part.columns + [_texts(col.flatten().to_numpy(zero_copy_only=False), edge, flat, past)],
                                                 names=part.schema.names + [out])
    return df.mapInArrow(run, schema)
