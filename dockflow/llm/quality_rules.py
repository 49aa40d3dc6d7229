"""Operator 3: quality rules learned as a decision list.

Statistics of whole texts are computed once per row. From labelled rows,
sequential covering grows a conjunction of thresholds by information gain on
two thirds of the rows, prunes its tail on the other third, keeps it only when
it is precise there, removes the rows it covers and repeats. The result is an
ordered list of readable rules and one Spark ``CASE WHEN`` expression.

Defined results: a null or empty text has all statistics 0 and fails the base
rule; a null id keeps its row; repeated rows and ties are judged alike (rules
see only the statistics); without labelled rows the list is empty and only
the base rule rejects; other columns pass through, whatever their names
(statistics live in the columns ``_q_*``; such columns of the input are an
error).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K

#: Bound of the labelled rows that reach the driver for fitting (smallest hashes of the id).
MAX_FIT_ROWS = 20_000
#: A rule enters the list when at least this share of the pruning rows it covers is bad.
MIN_PRECISION = 0.95
MIN_COVER = 5
MAX_CONDITIONS = 4
MAX_RULES = 24

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_digits", "n_marks", "n_distinct"]
PREFIX = "_q_"

# The symbol class of the base statistics.
SYMBOLS = b"#*$%&|<>"


def _class(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYM, _UP = _class(SYMBOLS), _class(bytes(range(65, 91)))
_DIG, _MARK = _class(b"0123456789"), _class(b"!?;:")


def _repeats(key: np.ndarray) -> np.ndarray:
    """True where a value occurs twice or more."""
    _, inv, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[inv] > 1


def _later(key: np.ndarray) -> np.ndarray:
    """True where an equal value stands earlier."""
    out = np.ones(len(key), bool)
    out[np.unique(key, return_index=True)[1]] = False
    return out


def text_statistics(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for every document of a slice."""
    n = len(off) - 1

    def per_doc(flags: np.ndarray) -> np.ndarray:
        c = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=c[1:])
        return c[off[1:]] - c[off[:-1]]

    start, end, doc = K.word_spans(data, off)
    words = K.span_hashes(data, start, end, lower=False)
    salt = K.mix(doc.astype(K.U) + K.U(77))
    covered = np.zeros(len(words) + 1, np.int64)
    h, at = K.window_hashes(words, doc, 8)
    if len(h):
        at = at[_repeats(h ^ salt[at])]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + 8, -1)
    nl = np.flatnonzero(data == 10)
    lo = np.unique(np.concatenate([off[:-1], nl + 1]))
    lo = lo[lo < len(data)]
    ldoc = np.searchsorted(off, lo, side="right") - 1
    hi = np.minimum(off[ldoc + 1], np.append(nl, len(data))[np.searchsorted(nl, lo)])
    worded = np.searchsorted(start, hi) > np.searchsorted(start, lo)
    lo, hi, ldoc = lo[worded], hi[worded], ldoc[worded]
    lines = K.span_hashes(data, lo, hi, lower=False) ^ K.mix(ldoc.astype(K.U) + K.U(78))
    return {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": per_doc(((data & 0xC0) != 0x80) & ~K._WS[data]),
        "n_symbols": per_doc(_SYM[data]),
        "n_dup_lines": np.bincount(ldoc[_later(lines)], minlength=n),
        "n_repeat_words": np.bincount(doc[np.cumsum(covered)[:-1] > 0], minlength=n),
        "n_lines": np.bincount(ldoc, minlength=n),
        "n_upper": per_doc(_UP[data]), "n_digits": per_doc(_DIG[data]), "n_marks": per_doc(_MARK[data]),
        "n_distinct": np.bincount(doc[~_later(words ^ salt)], minlength=n),
    }


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``_q_<count>`` (long) of the whole text appended."""
    clash = [c for c in docs.columns if c.startswith(PREFIX)]
    if clash:
        raise ValueError(f"input already has statistics columns: {clash}")
    schema = T.StructType(docs.schema.fields + [T.StructField(PREFIX + c, T.LongType()) for c in COUNTS])

    def fn(batch):
        for i, j, data, off in K.slices(batch, text):
            stats = text_statistics(data, off)
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays(part.columns + [pa.array(stats[c].astype(np.int64)) for c in COUNTS],
                                             names=part.schema.names + [PREFIX + c for c in COUNTS])
    return docs.mapInArrow(K.arrow_map(fn), schema)


def base_failed() -> Column:
    q = lambda c: F.col(PREFIX + c)
    return (q("n_words") < 20) | (100 * q("n_repeat_words") > 30 * q("n_words"))


#: Ratios the rules may test: name -> (numerator, denominator).
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"), "chars_per_word": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"), "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"), "marks_per_word": ("n_marks", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
}


def ratio(name: str) -> Column:
    a, b = RATIOS[name]
    return (F.col(PREFIX + a) / F.greatest(F.col(PREFIX + b), F.lit(1))).cast("double")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self) -> Column:
        c = ratio(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(x) for c in self.conditions])

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions)) + f" -> reject ({self.precision:.3f} of {self.covered})"


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = ()

    def keeps(self) -> Column:
        """Ordered conditional expression over the ``_q_*`` columns: false at the first rule that holds."""
        if not self.rules:
            return F.lit(True)
        out = F.when(self.rules[0].column(), F.lit(False))
        for r in self.rules[1:]:
            out = out.when(r.column(), F.lit(False))
        return out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join(map(str, self.rules)) or "(no rule)"


def _best(x, pos, neg, live, cuts) -> tuple[Condition | None, np.ndarray]:
    """The threshold test with the largest FOIL gain among the rows still covered."""
    p0, n0 = int(pos[live].sum()), int(neg[live].sum())
    base = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    for name, grid in cuts.items():
        v = x[name][live]
        o = np.argsort(v, kind="stable")
        sp = np.concatenate([[0], np.cumsum(pos[live][o])])
        sn = np.concatenate([[0], np.cumsum(neg[live][o])])
        k = np.searchsorted(v[o], grid, side="right")
        for above in (False, True):
            p = p0 - sp[k] if above else sp[k]
            q = n0 - sn[k] if above else sn[k]
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(p > 0, p * (np.log2(p / (p + q)) - base), -np.inf)
            i = int(np.argmax(g))
            if g[i] > gain:
                best, gain = Condition(name, above, float(grid[i])), float(g[i])
    return (best, live & best.holds(x)) if best else (None, live)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, grow: np.ndarray, min_precision: float = MIN_PRECISION,
          min_cover: int = MIN_COVER) -> DecisionList:
    """Sequential covering over feature vectors; ``grow`` marks the growing rows, the others prune."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    cuts = {}
    for name, v in x.items():  # midpoints between growing rows, so a clean gap is cut in its middle
        v = v[grow]
        u = np.unique(v)
        u = u if len(u) <= 256 else np.unique(np.quantile(v, np.linspace(0, 1, 257), method="inverted_cdf"))
        cuts[name] = (u[:-1] + u[1:]) / 2 if len(u) > 1 else u
    while len(rules) < MAX_RULES and (left & grow & bad).sum() >= min_cover:
        live, conds = left & grow, []
        while len(conds) < MAX_CONDITIONS and (live & ~bad).any():
            c, live = _best(x, bad, ~bad, live, cuts)
            if c is None:
                break
            conds.append(c)
        if not conds:
            break

        def worth(k: int) -> tuple[float, float, int, int]:
            m = left & ~grow & Rule(tuple(conds[:k]), 0, 0).holds(x)  # noqa: B023
            p, q = int((m & bad).sum()), int((m & ~bad).sum())
            return ((p - q) / (p + q) if p + q else -1.0, p / (p + q) if p + q else 0.0, p + q, -k)
        k = max(range(1, len(conds) + 1), key=lambda k: (worth(k)[0], worth(k)[3]))
        _, precision, n, _ = worth(k)
        rule = Rule(tuple(conds[:k]), precision, n)
        if precision < min_precision or n < min_cover:
            break
        rules.append(rule)
        left &= ~rule.holds(x)
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
        max_rows: int = MAX_FIT_ROWS) -> DecisionList:
    """Learn the list from at most ``max_rows`` labelled ids (smallest hashes; a bounded,
    deterministic sample). Only their statistics reach the driver."""
    ids = (labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull())
           .groupBy(F.col(doc_id).alias("_id")).agg((F.avg(quality) < 0.5).alias("_bad"))
           .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    rows = (with_statistics(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
                            .join(F.broadcast(ids), "_id"))
            .where(~base_failed())
            .select("_bad", (F.pmod(F.xxhash64("_id", F.lit("grow")), F.lit(3)) > 0).alias("_grow"),
                    *[ratio(r).alias(r) for r in RATIOS], F.xxhash64("_id").alias("_hash"))
            .orderBy("_hash", *RATIOS).limit(2 * max_rows).drop("_hash").toPandas())  # repeated ids may give more rows than ids
    if not len(rows):
        return DecisionList()
    rows = rows.sort_values(list(rows.columns))  # row order must not decide ties
    return learn({r: rows[r].to_numpy(float) for r in RATIOS}, rows["_bad"].to_numpy(bool), rows["_grow"].to_numpy(bool))


def judged(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """``docs`` with the ``_q_*`` statistics, ``base_failed`` and ``kept`` as ``_q_base_failed`` / ``_q_kept``."""
    s = with_statistics(docs, text)
    return s.withColumn(PREFIX + "base_failed", base_failed()).withColumn(
        PREFIX + "kept", ~F.col(PREFIX + "base_failed") & rules.keeps())


def keep_good(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the list, with their own columns only."""
    out = judged(docs, rules, text)
    return out.where(F.col(PREFIX + "kept")).select(*docs.columns)
