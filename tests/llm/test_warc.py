"""Web archives: round trip, odd input, foreign archives, assembly in any order."""

import gzip
import hashlib
from base64 import b32encode

import pytest
from stationkit.llm import warc
from stationkit.plans.stored import fresh_path

PAGES = "page_id bigint, url string, html string, type string, digest string, rows bigint"


def expected(rows, least=0):
    """Brute force over (page_id, html)."""
    heads = {}
    for i, html in rows:
        body = (html or "").encode()
        heads[body] = max([k for k in (heads.get(body), i) if k is not None], default=None)
    out = []
    for i, html in rows:
        body = (html or "").encode()
        again = len(body) >= least and i != heads[body]
        digest = b32encode(hashlib.sha1(body).digest()).decode()
        kind = "revisit" if again else "response"
        out.append((i, len(body), digest, kind, heads[body] if again else None))
    return sorted(out, key=repr)


def result(df):
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, df.collect()), key=repr)


ODD = [
    (1, "<p>a</p>"), (2, "<p>a</p>"), (9, "<p>a</p>"), (9, "<p>a</p>"), (3, None), (4, ""),
    (None, "<p>a</p>"), (None, "alone"), (None, "alone"), (5, "x\r\n\r\nWARC/1.1\r\nWARC-Type: request\r\n\r\n"),
    (6, "\r\n\r\n"), (7, "naïve – 文字 🙂"), (8, "long " * 600_000), (-4, "negative"), (10, "a\x00b"),
]


@pytest.mark.parametrize("least", [0, 5, 10_000])
def test_round_trip(spark, least):
    urls = ["http://h.example/p?q=1", None, "", "no url", "http://h/a b\r\nX-Evil: 1", "http://h/ü"]
    rows = [(i, urls[n % 6], html, "t", "d", 1) for n, (i, html) in enumerate(ODD)]
    got = result(warc.round_trip(spark.createDataFrame(rows, PAGES), least))
    assert got == expected(ODD, least)


def test_hot_payload_without_broadcast(spark, monkeypatch):
    from stationkit.plans import keyed

    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
    rows = [(i, "same" if i % 3 else f"own {i % 40}") for i in range(600)]
    table = spark.createDataFrame([(i, "http://h/", h, "", "", 0) for i, h in rows], PAGES)
    assert result(warc.round_trip(table)) == expected(rows)


def test_empty(spark):
    assert result(warc.round_trip(spark.createDataFrame([], PAGES))) == []


def record(kind, name, to=None, block=b"", mime="application/http; msgtype=response", version="1.0"):
    head = [f"WARC/{version}", f"warc-type: {kind}", f"WARC-Record-ID: <{name}>", f"Content-Type: {mime}"]
    if to:
        head.append(f"WARC-Concurrent-To: <{to}>")
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def archives(spark, *files):
    """A folder of archive files, written by Spark as binary text without a separator of its own."""
    from pathlib import Path

    folder = Path(fresh_path(spark, "foreign").removeprefix("file:"))
    folder.mkdir()
    for i, data in enumerate(files):
        (folder / f"{i}.warc").write_bytes(data)
    return str(folder)


def test_foreign_archives_in_any_direction(spark):
    """Response names request, metadata names request; members per record; two files; orphans."""
    one = [
        record("warcinfo", "w", mime="application/warc-fields", block=b"software: x\r\n"),
        record("request", "q1", mime="application/http; msgtype=request", block=b"GET / HTTP/1.1\r\n\r\n"),
        record("response", "r1", "q1", HTTP + b"one"),
        record("response", "r2", block=HTTP + b"two" * 2_000_000),
        record("request", "q3", "nobody", b"GET /3 HTTP/1.1\r\n\r\n", "application/http; msgtype=request"),
    ]
    two = [
        record("metadata", "m1", "q1", b"fetch: 1\r\n", "application/warc-fields"),
        record("metadata", "m2", "r2", b"fetch: 2\r\n", "application/warc-fields", "1.1"),
        record("metadata", "m2b", "r2", b"fetch: 3\r\n", "application/warc-fields", "1.1"),
    ]
    folder = archives(spark, b"".join(map(gzip.compress, one)), b"".join(two), b"")
    records = warc.read_records(spark, folder)
    got = {r.capture: r for r in warc.captures(records).collect()}
    assert set(got) == {"<r1>", "<r2>"}
    assert got["<r1>"].request.record_id == "<q1>" and got["<r1>"].metadata.block == "fetch: 1\r\n"
    assert bytes(got["<r1>"].response.payload) == b"one"
    assert got["<r2>"].request is None and got["<r2>"].response.payload_bytes == 6_000_000
    assert got["<r2>"].metadata_records == 2 and got["<r2>"].metadata.record_id == "<m2>"
    assert [r.record_id for r in warc.orphans(records).collect()] == ["<q3>"]


def test_cut_and_damaged_files(spark):
    whole = record("response", "r1", block=HTTP + b"body")
    assert [r["complete"] for r in warc.parse_records(whole + whole[:-8])] == [True, False]
    assert [r["complete"] for r in warc.parse_records(whole + whole[:30])] == [True, False]
    with pytest.raises(ValueError, match="record 1 of f"):
        list(warc.parse_records(whole + b"junk\r\n\r\n", "f"))
    folder = archives(spark, whole + whole[:-8])
    assert warc.captures(warc.read_records(spark, folder)).count() == 1
