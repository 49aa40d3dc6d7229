import gzip
import hashlib
import random

import duckdb

from dockflow.llm import queries as Q
from dockflow.llm import warc as WA

from ..conftest import SF_SMALL


def record(i, body, **change):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    h = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{i}>", "Content-Type": "application/http; msgtype=response",
         "WARC-Block-Digest": "sha256:" + hashlib.sha256(block).hexdigest(), "Content-Length": str(len(block))} | change
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in h.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def seen(b):
    rows = list(WA.salvage(b))
    spans = sorted({(r["start"], r["past"]) for r in rows})
    assert not b or (spans[0][0] == 0 and spans[-1][1] == len(b) and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False)))
    return [r.get("page_id") if r["kind"] == "record" else "gap" for r in rows]


def test_salvage_plain_and_members():
    rs = [record(i, b"body %d " % i * 40) for i in range(6)]
    whole = b"".join(rs)
    assert seen(whole) == [0, 1, 2, 3, 4, 5] and seen(b"") == []
    flipped = bytearray(whole)
    flipped[len(rs[0]) + len(rs[1]) - 30] ^= 4
    assert seen(bytes(flipped)) == [0, "gap", 2, 3, 4, 5]
    assert seen(b"noise\r\n" + whole) == ["gap", 0, 1, 2, 3, 4, 5]
    assert seen(whole[:-20]) == [0, 1, 2, 3, 4, "gap"]
    assert seen(rs[0] + record(9, b"x" * 200, **{"Content-Length": "7"}) + rs[1]) == [0, "gap", 1]
    assert seen(rs[0] + record(9, b"x", **{"Content-Length": "no"}) + record(8, b"y" * 300, **{"Content-Length": "99999"}) + rs[1]) == [0, "gap", 1]
    gz = [gzip.compress(r) for r in rs]
    assert seen(b"".join(gz)) == [0, 1, 2, 3, 4, 5]
    assert seen(gz[0] + gz[1][:-6] + b"".join(gz[2:])) == [0, "gap", 2, 3, 4, 5]
    assert seen(gz[0] + rs[1] + gz[2] + b"\x1f\x8b\x08junk" + rs[3]) == [0, 1, 2, "gap", 3]
    assert seen(gzip.compress(rs[0] + rs[1]) + rs[2]) == [0, 1, 2]


def test_headers_of_any_length():
    long = record(1, b"body", **{"WARC-Target-URI": "http://x/" + "u" * 300_000})
    assert seen(record(0, b"a") + long + record(2, b"b")) == [0, 1, 2]
    assert seen(record(0, b"a") + long[:-9] + record(2, b"b")) == [0, "gap", 2]
    assert seen(b"WARC/1.1\r\n" + b"x" * 100_000 + record(2, b"b")) == ["gap", 2]


def test_long_urls_and_archives_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(WA, "ARCHIVE_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(WA, "RECORDS_PER_FILE", 200)
    sizes = [(i * 7919) % 4000 for i in range(300)] + [60_000 + i for i in range(60)] + [2_000_000, 2_000_000]
    rows = [(i, "http://x/" + "u" * (100_000 if i % 97 == 0 else 5), "é" + chr(97 + i % 26) * n) for i, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = WA.round_trip(pages, str(tmp_path / "w")).collect()
    assert all(r["kind"] == "record" for r in got)
    assert sorted((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in got if r["record_type"] == "response") == sorted(
        r for r in rows if r[0] not in {x["page_id"] for x in got if x["record_type"] == "revisit"})
    assert sorted(r["page_id"] for r in got) == list(range(len(rows)))
    files = [f for f in (tmp_path / "w").glob("part-*") if f.stat().st_size > 1 << 20]
    assert len(files) == 2 and all(f.read_bytes().count(b"\r\nWARC-Record-ID") == 1 for f in files)


def test_random_damage_never_hides_sound_records():
    rng = random.Random(7)
    rs = [record(i, rng.randbytes(rng.randrange(0, 500))) for i in range(30)]
    starts = [sum(map(len, rs[:k])) for k in range(31)]
    for _ in range(40):
        b = bytearray(b"".join(rs))
        hit = sorted(rng.sample(range(len(b)), 3))
        for x in hit:
            b[x] ^= 1 << rng.randrange(8)
        harmed = {k for k in range(30) for x in hit if starts[k] <= x < starts[k + 1]}
        assert {k for k in range(30)} - harmed <= set(x for x in seen(bytes(b)) if x != "gap")


def test_round_trip_equals_sql(spark):
    got = Q.QUERIES["op5_warc"](spark, SF_SMALL).collect()
    c = duckdb.connect()
    c.sql(f"create view pages as select * from '{SF_SMALL}/pages.parquet'")
    want = c.sql(Q.SQL["op5_warc"]).fetchall()
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == sorted(want)


def test_edges(spark, tmp_path):
    big = "é<p>" * 50
    rows = [(3, "http://x/a\r\nb", big), (1, None, big), (1, "u", big), (None, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "x" * 99), (7, "u", "x" * 99),
            (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\nfake " * 20), (9, "u", "\x00\x1c\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, digest string, size int")
    path = str(tmp_path / "w")
    got = WA.round_trip(pages, path).collect()
    assert all(r["kind"] == "record" for r in got)
    back = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], bytes(r["payload"]).decode() if r["payload"] is not None else None)
                   for r in got), key=repr)
    n = len(big.encode())
    want = [(i, "response", None, len((t or "").encode()), t or "") for i, _, t in rows if t != big]
    want += [(3, "revisit", 1, n, None), (None, "revisit", 1, n, None)] + [(1, "response", None, n, big)] * 2
    assert back == sorted(want, key=repr)
    assert {r["url"] for r in got if r["page_id"] == 3} == {"http://x/a%0D%0Ab"}
    part = next(p for p in sorted((tmp_path / "w").glob("part-*")) if p.stat().st_size > 400)
    damaged = tmp_path / "d"
    damaged.mkdir()
    b = bytearray(part.read_bytes())
    b[b.index(b"HTTP/1.1 200") + 5] ^= 1
    (damaged / "x.warc").write_bytes(bytes(b) + record(77, b"late"))
    r = WA.read_archives(spark, str(damaged)).collect()
    assert any(x["kind"] == "gap" and x["start"] == 0 for x in r) and any(x["page_id"] == 77 for x in r)
    assert WA.round_trip(pages.where("page_id = 999"), str(tmp_path / "e")).count() == 0
