"""WARC: round trips of records and members, digests, duplicates, edge cases."""

import gzip
import hashlib
import io

import pytest
from conftest import SF001

from tastegraph.llm import warc
from tastegraph.llm.common import Scratch


def expected(rows):
    """rows: (page, html) -> sorted digest rows."""
    data = [(p, (h or "").encode()) for p, h in rows]
    best = {}
    for p, b in data:
        if len(b) >= 1000 and p is not None:
            best[b] = max(p, best.get(b, p))
    several = {b for _, b in data if sum(x == b for _, x in data) > 1}
    out = []
    for p, b in data:
        keeper = best.get(b) if b in several else None
        revisit = keeper is not None and keeper != p
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(map(str, out))


def test_table(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    got = sorted(str(tuple(r)) for r in warc.digest(pages).collect())
    assert got == expected([(r.page_id, r.html) for r in pages.collect()])


def test_edge_cases_and_copies(spark):
    big, other = "é" * 600, "y" * 5000
    rows = [(1, "u", None), (2, None, ""), (3, "u\r\nInjected: x", "x" * 999), (4, "u", "x" * 999), (5, "ü b", big), (6, "u", big),
            (7, "u", big), (7, "u", big), (None, "u", big), (None, "u", other), (8, "u", "z" * 3_000_000), (9, "u", "HTTP/1.1\r\n\r\nWARC/1.1\r\n\r\n" * 80)]
    pages = spark.createDataFrame([(*r, 1, "clash") for r in rows], "page_id long, url string, html string, page int, digest string")
    got = sorted(str(tuple(r)) for r in warc.digest(pages).collect())
    assert got == expected([(p, h) for p, _, h in rows])
    assert warc.digest(pages.limit(0)).count() == 0


def test_payloads_and_members(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    scratch = Scratch(spark, "warc")
    files = scratch.keep(warc.write_archives(warc.record_plan(pages, scratch), scratch.path("a"), archive_bytes=20_000), "m").collect()
    assert len(files) > 3  # archives of bounded size
    html = {r.page_id: r.html or "" for r in pages.collect()}
    n = 0
    for f in files:
        f_s, p = warc.open_fs(f.path)
        with f_s.open_input_stream(p, compression=None) as stream:
            raw = stream.read()
        records = list(warc.read_records(io.BytesIO(raw), with_payload=True))
        assert len(records) == f.n_records and len(raw) == f.n_bytes
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: ")  # any gzip reader sees the records in order
        for r in records:
            if r["payload"] is not None:
                assert r["payload"].decode() == html[int(r["x-page-id"])]
        n += len(records)
    assert n == len(html)


def test_very_long_url(spark):
    rows = [(1, "http://x/" + "é" * 700_000, "<p>a</p>" * 200), (2, "u", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(str(tuple(r)) for r in warc.digest(pages).collect()) == expected([(p, h) for p, _, h in rows])


def test_damage_is_found():
    record = warc.record_bytes(1, "http://x/", b"payload " * 50, hashlib.sha1(b"payload " * 50).hexdigest(), None)
    whole = warc._member(record)
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(whole + whole))] == [400, 400]
    for broken in (record.replace(b"payload pay", b"payload bay", 1), record[:-5] + b"\r\n\r\n", record + b"more"):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(warc._member(broken))))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(whole[:-12])))
