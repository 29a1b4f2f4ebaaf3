import gzip
import hashlib
import random

import pytest

from cairnflow.llm.common import hot_join
from cairnflow.llm.warc import archive_digest, chunked, dechunked, read_archive, records, write_archive

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    least = {}
    for p, _, h in rows:
        h = (h or "").encode()
        if p is not None and len(h) >= 100:
            least[h] = min(p, least.get(h, p))
    out = []
    for p, _, h in rows:
        h = (h or "").encode()
        again = p is not None and p > least.get(h, p)
        out.append((p, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", least[h] if again else None))
    return sorted(out, key=str)


def make_rows():
    rng = random.Random(12)
    bodies = ["<p>é" + "x" * n + "</p>" for n in (0, 80, 91, 92, 93, 300, 5000)] + ["WARC/1.1\r\n\r\n0\r\n\r\n" * 40, "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9, "", None, "same " * 30_000]
    rows = [(d, f"http://a.example/{d}", rng.choice(bodies)) for d in range(200)]
    rows += [(300 + d, "http://hot.example/", "hot" * 50) for d in range(150)]
    edge = [(None, None, "hot" * 50), (None, "u", None), (507, "http://x y\r\nz", "hot" * 50), (507, "http://x y\r\nz", "hot" * 50), (500, None, "漢字😀" * 40_000), (501, "http://ü.example", "漢字😀" * 40_000), (-3, "n", "q" * 120)]
    return rows + edge


def test_round_trip_against_brute_force(spark):
    rows = make_rows()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'c' as digest", "1 as refers_to", "2 as bytes", "'k' as kind", "3 as n")
    got = archive_digest(pages)
    assert got.dtypes == [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_archives_are_valid_and_payloads_come_back(spark, tmp_path):
    rows = make_rows()
    write_archive(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "a"), segment_bytes=700, chunk_bytes=64, archive_bytes=20_000)
    files = [f for f in (tmp_path / "a").iterdir() if f.name.startswith("part")]
    assert len(files) > 5 and max(f.stat().st_size for f in files) < 40_000
    seen = {}
    for f in files:
        for fields, block, status in records(gzip.decompress(f.read_bytes())):  # the standard library reads the members and skips the padding
            assert status == "ok" and len(block) <= 700 and int(fields["content-length"]) == len(block)
            seen[fields["warc-record-id"]] = fields
    kinds = [f["warc-type"] for f in seen.values()]
    assert kinds.count("continuation") > 500 and kinds.count("response") + kinds.count("revisit") == len(rows)
    assert all(f["warc-segment-origin-id"] in seen for f in seen.values() if f["warc-type"] == "continuation")
    back = read_archive(spark, str(tmp_path / "a")).collect()
    assert {r.status for r in back} == {"ok"} and len(back) == len(rows)
    text = {(p, (h or "")) for p, _, h in rows}
    assert {(r.page_id, bytes(r.payload).decode()) for r in back if r.kind == "response"} <= text
    urls = {r.page_id: r.url for r in back}
    assert urls[507] == "http://x%20y%0D%0Az" and urls[500] is None and urls[501] == "http://ü.example"


def one(kind, ident, block, **more):
    fields = {"WARC-Type": kind, "WARC-Record-ID": ident, **{k.replace("_", "-"): v for k, v in more.items()}, "Content-Length": len(block)}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def http(body, head="Transfer-Encoding: chunked"):
    return f"HTTP/1.1 200 OK\r\n{head}\r\n\r\n".encode() + body


def cut(ident, message, places, **change):
    parts = [message[a:b] for a, b in zip([0, *places], [*places, len(message)])]
    out = [one("response", ident, parts[0], WARC_Segment_Number=1, Page_ID=ident)]
    for n, p in enumerate(parts[1:], 2):
        last = {"WARC_Segment_Total_Length": change.get("total", len(message))} if n == len(parts) else {}
        out.append(one("continuation", f"{ident}-{n}", p, WARC_Segment_Origin_ID=ident, WARC_Segment_Number=n, **last))
    return out


def test_foreign_and_damaged_archives(spark, tmp_path):
    whole = http(chunked(b"hello segments" * 30, 100))
    good = cut("1", whole, [10, 200])
    files = {
        "a.warc": one("warcinfo", "i", b"x") + good[2] + one("response", "2", http(b"plain", "Content-Length: 5"), Page_ID=2),
        "b.warc.gz": b"".join(gzip.compress(x) for x in (good[1], good[0], good[1])),  # out of order, in another file, one segment twice
        "c.warc.gz": gzip.compress(b"".join([*cut("3", whole, [50, 90])[:2], *cut("4", whole, [50], total=7), cut("5", whole, [50, 90])[0], cut("5", whole, [50, 90])[2]])),
        "d.warc": b"".join([*cut("6", whole, [50]), cut("6", whole[:-9] + b"damaged!!", [50])[1]]),
        "e.warc": one("response", "7", http(b"5\r\nabc"), Page_ID=7) + b"noise\r\n\r\n" + one("response", "8", http(b"short", "Content-Length: 9"), Page_ID=8) + one("revisit", "9", b"", WARC_Payload_Digest="sha256:" + "0" * 64, Page_ID=9),
        "f.warc": one("response", "10", http(b"A;x=y\r\n0123456789\r\n0\r\nTrailer: t\r\n\r\n"), Page_ID=10) + one("response", "11", http(b"0\r\n\r\n"), Page_ID=11, WARC_Payload_Digest="sha256:" + "1" * 64),
        "g.warc": one("resource", "12", b"raw", Page_ID=12) + one("revisit", "13", b"", WARC_Payload_Digest="SHA256:" + hashlib.sha256(b"plain").hexdigest().upper(), Page_ID=13) + one("response", "14", whole, Page_ID=14)[:-30],
        "h.warc": b"",
        "i.warc.gz": gzip.compress(one("response", "15", http(b"0\r\n\r\n"), Page_ID=15))[:-12],
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    got = read_archive(spark, str(tmp_path)).collect()
    by = {r.page_id: r for r in got if r.page_id is not None}
    assert {k: r.status for k, r in by.items()} == {1: "ok", 2: "ok", 3: "missing segment", 4: "wrong length", 5: "missing segment", 6: "conflicting segments", 7: "bad chunk", 8: "short body", 9: "unresolved", 10: "ok", 11: "wrong digest", 12: "ok", 13: "ok"}
    assert bytes(by[1].payload) == b"hello segments" * 30 and bytes(by[10].payload) == b"0123456789" and bytes(by[12].payload) == b"raw"
    assert (by[13].refers_to, by[13].payload_bytes, by[13].payload) == (2, 5, None) and by[3].payload is None
    assert sorted(r.status for r in got if r.page_id is None) == ["malformed", "truncated", "truncated"]


def test_empty_table(spark):
    assert archive_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chunk_framing():
    rng = random.Random(1)
    for n in (0, 1, 63, 64, 65, 1000):
        data = rng.randbytes(n)
        assert dechunked(chunked(data, 64)) == data
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b"-1\r\n", b"zz\r\nab\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"0\r\n"):
        assert dechunked(bad) is None


@pytest.mark.parametrize("share", [2, 1024])
def test_hot_keys_meet_a_broadcast_and_no_row_is_lost(spark, share):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i % 90}", i) for i in range(300)], "k string, __hot long").repartition(4)
    right = spark.createDataFrame([("hot", 1), *((f"k{i}", i) for i in range(0, 90, 2))], "k string, v long")
    got = sorted(tuple(r) for r in hot_join(left, right, "k", share).collect())
    known = dict(tuple(r) for r in right.collect())
    assert got == sorted(((r.k, r["__hot"], known.get(r.k)) for r in left.collect()), key=lambda x: (x[0], x[1])) and len(got) == 800
