"""Small tables with every awkward row the operators must take."""

import random

LONG = " ".join(f"word{i % 997} other{i % 31}" for i in range(20_000))
EXTRA = ["n", "node", "grp", "bucket", "a", "b", "key", "k", "row", "size", "shard", "op", "seq", "version", "comp", "load", "ids", "t"]


def prose(seed: int, n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["river", "road", "Hill", "morning", "snow", "water", "brown", "slow", "south", "village", "old", "new",
                                "north", "bridge", "tower", "bell", "rain", "wind", "stone", "field"]) + (rng.choice("abcdefgh")) for _ in range(n))


def edge_rows() -> list[tuple]:
    a = prose(1)
    return [(1, a), (2, a), (2, a), (3, a.upper()), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "one two three four"), (9, LONG),
            (None, a), (None, None), (10, "é ü 日本 👍 x"), (11, prose(2)), (12, a + " tail"), (13, "\x00 odd \x1c sep\x85 end"), (-14, prose(3))]


def edge_docs(spark):
    cols = ", ".join(f"{c} string" for c in EXTRA)
    rows = [(i, t, "en", "src", *["x"] * len(EXTRA)) for i, t in edge_rows()]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {cols}")


def empty_docs(spark):
    return edge_docs(spark).where("doc_id = -999")
