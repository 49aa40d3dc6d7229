"""Column functions: rounding, flags, bins, weather codes, labels."""

import numpy as np
from pyspark.sql import functions as F

from dockflow.functions import (capacity_group, code_label, cyclic, decode_tf, is_frozen, is_stormy,
                                profile_class, round_half_even, truthy_flag, weather_severity)
from dockflow.schema import SEVERITY_LABELS


def test_round_half_even_matches_numpy(spark):
    xs = [66.665, 0.125, 2.675, 1.005, 12.345, -0.004, 33.335, 0.5, 1.5, -2.5, 99.995]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [float(np.round(x, 2)) for x in xs]
    # no negative zero
    assert all(not (g == 0 and np.signbit(g)) for g in got)


def test_capacity_bins_right_closed(spark):
    caps = [0, 1, 20, 21, 35, 36, 50, 51, 999, 1000, None]
    df = spark.createDataFrame([(c,) for c in caps], "c int")
    got = [r[0] for r in df.select(capacity_group("c")).collect()]
    assert got == [None, 0, 0, 1, 1, 2, 2, 3, 3, None, None]


def _severity_reference(code):
    if code is None:
        return 0
    s = 0
    if 4 <= code <= 19:
        s = 1
    if 20 <= code <= 29 or 40 <= code <= 59:
        s = 2
    if 60 <= code <= 69 or 80 <= code <= 84:
        s = 3
    if 30 <= code <= 39 or 70 <= code <= 79 or code >= 85:
        s = 4
    return s


def test_weather_codes(spark):
    codes = list(range(100)) + [None]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    rows = df.select("c", weather_severity("c").alias("s"), is_frozen("c").alias("fz"),
                     is_stormy("c").alias("st")).collect()
    frozen = {56, 57, 66, 67, 85, 86} | set(range(70, 80))
    stormy = {17, 18, 19, 29} | set(range(90, 100))
    for r in rows:
        assert r.s == _severity_reference(r.c), r
        assert r.fz == int(r.c in frozen), r
        assert r.st == int(r.c in stormy), r


def test_flags_strict_vs_permissive(spark):
    vals = ["True", "False", "t", "f", "T", "true", "1", "0", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select(decode_tf("v").alias("p1"), truthy_flag("v").alias("p2")).collect()
    assert [r.p1 for r in rows] == [None, None, True, False, True, None, None, None, None, None]
    assert [r.p2 for r in rows] == [1, 0, 1, 0, 1, 1, 1, 0, 0, 0]
    b = spark.createDataFrame([(True,), (False,), (None,)], "v boolean")
    assert [r[0] for r in b.select(truthy_flag("v")).collect()] == [1, 0, 0]


def test_cyclic_no_negative_zero(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    for r in df.select(cyclic("h", 24, "sin").alias("s"), cyclic("h", 24, "cos").alias("c")).collect():
        for v in (r.s, r.c):
            assert not (v == 0 and np.signbit(v))


def test_labels_and_profiles(spark):
    df = spark.createDataFrame([(0,), (4,), (7,), (None,)], "c int")
    got = [r[0] for r in df.select(code_label("c", SEVERITY_LABELS)).collect()]
    assert got == [SEVERITY_LABELS[0], SEVERITY_LABELS[4], "7", None]
    r = spark.createDataFrame([(1.3,), (0.7,), (1.0,), (None,)], "r double")
    assert [x[0] for x in r.select(profile_class("r")).collect()] == ["residential", "office", "mixed", "mixed"]
    assert [x[0] for x in r.select(profile_class("r", null_as_mixed=False)).collect()] == \
        ["residential", "office", "mixed", None]
