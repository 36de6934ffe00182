import gzip
import itertools
import json
import time
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tracewell.llm import dom, warc
from tracewell.llm.queries import QUERIES


def archive(n, size=40):
    return [gzip.compress(warc.serialise(warc.response(i, f"http://x/{i}", f"<p>{i} " + "é" * size, "2020-01-01T00:00:00Z")) + b"\r\n\r\n") for i in range(n)]


def test_a_damaged_member_costs_no_other(spark, tmp_path):
    members = archive(10)
    hurt = bytearray(members[3])
    hurt[len(hurt) // 2] ^= 0xFF
    places = [0, *itertools.accumulate(map(len, members))]
    (tmp_path / "a.warc.gz").write_bytes(b"".join([*members[:3], bytes(hurt), *members[4:]]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(members)[:-30])
    (tmp_path / "c.warc").write_bytes(b"")
    rows = warc.read(spark, str(tmp_path)).collect()
    a = sorted((r["offset"], r["error"], r["record"]) for r in rows if r["path"].endswith("a.warc.gz"))
    assert [o for o, _, _ in a] == places[:10]
    assert [i for i, (_, error, record) in enumerate(a) if error or not record] == [3]
    assert [next(warc.parse(bytes(r))).get("WARC-Target-URI") for _, _, r in a if r] == [f"http://x/{i}" for i in range(10) if i != 3]
    b = sorted((r["offset"], r["error"]) for r in rows if r["path"].endswith("b.warc.gz"))
    assert [e is None for _, e in b] == [True] * 9 + [False] and len(rows) == 20
    assert warc.derivatives(warc.read(spark, str(tmp_path))).filter("refers_to is not null").count() == 2 * 19


def test_time_grows_with_an_archives_size():
    def seconds(raw):
        began = time.perf_counter()
        n = sum(1 for _, member, _ in warc.unpacked(raw) for _ in warc.parse(member))
        return time.perf_counter() - began, n

    one = b"".join(archive(400, 20)) * 100  # 40 000 records
    small, n = seconds(one)
    large, m = seconds(one * 8)
    assert (n, m) == (40_000, 320_000) and large < 16 * small + 1


def test_two_hundred_megabytes_in_seconds():
    body = zlib.compressobj(0, wbits=31)
    member = warc.serialise(warc.response(1, "http://x/", "<p>" + "word " * 20_000, "2020-01-01T00:00:00Z"))
    member = body.compress(member) + body.flush()
    raw = member * (200_000_000 // len(member))
    began = time.perf_counter()
    assert sum(1 for _ in warc.unpacked(raw)) == len(raw) // len(member)
    assert time.perf_counter() - began < 30


@pytest.mark.parametrize("size", [10, 17_000_000])
def test_each_record_written_is_a_member(spark, tmp_path, size):
    pages = spark.range(3).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), F.concat(F.lit("<p>x "), F.repeat(F.lit("y"), size)).alias("html"))
    derived = warc.derivatives(warc.responses(pages))
    warc.write(derived.coalesce(1), f"{tmp_path}/w")
    (file,) = (tmp_path / "w").glob("part-*.warc.gz")
    found = [r for _, member, error in warc.unpacked(file.read_bytes()) if member for r in warc.parse(member) if not error]
    assert len(found) == sum(1 for _, m, _ in warc.unpacked(file.read_bytes()) if m) == 6
    assert sorted(warc.serialise(r).decode() for r in found) == sorted(r["record"] for r in derived.select("record").collect())
    assert len({r.get("WARC-Record-ID") for r in found}) == 6
    assert gzip.decompress(file.read_bytes()).count(b"WARC/1.1\r\n") == 6
    back = warc.read(spark, f"{tmp_path}/w")
    assert back.filter("error is null").count() == 6


def test_empty_and_clashing(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>a", "x", "y"), (1, "u", "<p>a", "x", "y"), (None, None, None, None, None)], "page_id long, url string, html string, record_id string, source_record_id string")
    made = warc.responses(pages)
    assert len({next(warc.parse(bytes(r["record"]))).get("WARC-Record-ID") for r in made.collect()}) == 3
    named = warc.derivatives(made.withColumn("record_id", F.lit("x")).withColumn("source_record_id", F.lit("y")), keep=["record_id", "source_record_id", "page_id"])
    assert len(set(named.columns)) == len(named.columns) and named.columns[:3] == ["source_source_record_id", "source_record_id", "page_id"]
    assert [r[0] for r in named.select("source_source_record_id").distinct().collect()] == ["x"] and named.count() == 6
    assert warc.digest(pages.limit(0)).count() == 0
    warc.write(warc.digest(pages.limit(0)), f"{tmp_path}/none")
    assert warc.read(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "bare").mkdir()
    assert warc.read(spark, str(tmp_path / "bare")).count() == 0


def test_rows_of_the_query_against_a_plain_version(spark, sf_dir):
    """Every derived record of the table, made again from the pages by hand."""
    pages = {i: (u, h) for i, u, h in zip(*(pq.read_table(f"{sf_dir}/pages.parquet").column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)}
    got = {}
    for r in QUERIES["op3_warc_derivatives"](spark, sf_dir).collect():
        got.setdefault(r["page_id"], {})[r["record_type"]] = r
    assert set(got) == set(pages)
    for i, (url, page) in pages.items():
        m, c = got[i]["metadata"], got[i]["conversion"]
        payload = (page or "").encode()
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        text = "\n".join(t for t in dom.read(page or "").text if t is not None)
        head, _, body = c["record"].partition("\r\n\r\n")
        assert body == text and c["n_chars"] == len(text) and c["content_length"] == len(text.encode())
        assert f"WARC-Refers-To: {c['refers_to']}" in head and f"WARC-Target-URI: {url or ''}" in head and head.startswith("WARC/1.1\r\nWARC-Type: conversion")
        said = json.loads(m["record"].partition("\r\n\r\n")[2])
        assert m["refers_to"] == c["refers_to"] and dict(map(tuple, said["source"]["warc-headers"]))["WARC-Record-ID"] == m["refers_to"]
        assert said["conversion"]["record-id"] == c["record_id"] and said["conversion"]["block-digest"] == c["block_digest"] == warc.digest_of(text.encode())
        assert m["source_payload_digest"] == c["source_payload_digest"] == warc.digest_of(payload) and m["source_block_digest"] == warc.digest_of(block)
        assert m["digests_hold"] and m["http_status"] == 200
    ids = [r["record_id"] for x in got.values() for r in x.values()]
    assert len(set(ids)) == len(ids)
