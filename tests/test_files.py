import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracewell.operators import manifest as M
from tracewell.operators import membership, sketch
from tracewell.plans import snapshot
from tracewell.sources import files, seek

# a dataset of our own: a sorted master of all records and two shards of some
RECORDS = sorted(["lantern", "Quay-7", "quay-7", "quay-77", "0:anchor", "tide table", "ölzeug", "rope\tend", "lantern2", "buoy"], key=str.encode)
SHARDS = {"harbour_7.txt": RECORDS[:4], "harbour_12.txt": RECORDS[3:7]}


def text(records):
    return "".join(f"{r}\n" for r in records).encode()


def place(record):
    return len(text(RECORDS[: RECORDS.index(record)]))


MASTER = text(RECORDS)
MANIFEST = "".join(f"{name}\n{rs[0]}\n{rs[-1]}\n" for name, rs in SHARDS.items()).encode()


def put(root, **datasets):
    for name, content in datasets.items():
        (root / name).mkdir(parents=True, exist_ok=True)
        for file, raw in content.items():
            (root / name / file).write_bytes(raw)
    return str(root)


@pytest.fixture
def corpus(tmp_path):
    return put(tmp_path, harbour={**{name: text(rs) for name, rs in SHARDS.items()}, "harbour_sorted.txt": MASTER, "lookup.txt": MANIFEST})


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_records_are_numbered_by_line_and_byte(spark, tmp_path):
    root = put(tmp_path, crlf={"a.txt": b"aa\r\nb\rb\n\ncc\xff\n\xc3\xa9\nlast\r"})
    got = files.read_lines(spark, f"{root}/crlf/a.txt")
    assert rows(got, "line_no", "offset") == [(1, 0), (2, 4), (3, 8), (4, 9), (5, 13), (6, 16)]
    assert [r[0] for r in got.orderBy("line_no").select(F.hex("line")).collect()] == ["6161", "620D62", "", "6363FF", "C3A9", "6C617374"]


def test_files_cut_into_blocks_are_numbered_alike(spark, tmp_path):
    lines = [b"x" * (i % 37) for i in range(5000)]
    root = put(tmp_path, d={"a.txt": b"\n".join(lines) + b"\n", "b.txt": b"one\ntwo"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = {(r["file"], r["line_no"]): (r["offset"], r["line"]) for r in files.read_lines(spark, [f"{root}/d/a.txt", f"{root}/d/b.txt"]).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    at = 0
    for i, line in enumerate(lines):
        assert got["a.txt", i + 1] == (at, line.decode())
        at += len(line) + 1
    assert got["b.txt", 2] == (4, "two") and len(got) == 5002


def test_only_whole_records_match_and_probes_stay_hidden(spark, corpus):
    lines = files.read_lines(spark, f"{corpus}/harbour/harbour_sorted.txt")
    asked = {"quay-7": True, "quay": False, "tide table": True, "tide": False, "zinc": False, "": False, "LANTERN": False, "--": False, "ölzeug": True, None: False}
    probes = spark.createDataFrame([(p,) for p in asked], "probe string")
    assert {r["probe"]: r["hit"] for r in membership.membership(probes, lines).collect()} == asked
    places = membership.locations(probes, lines, ["file", "offset"])
    assert rows(places, "probe", "offset") == sorted((p, place(p)) for p, hit in asked.items() if hit)
    assert "line" not in places.columns
    assert rows(membership.proper_prefixes(probes, lines), "probe") == [("quay",), ("tide",)]


def test_master_supersedes_its_shards(spark, corpus):
    for scan in (True, False):
        index = files.build_index(spark, corpus, scan=scan)
        assert rows(index, "kind", "file", "lo", "hi", "size_bytes", "place") == [("sorted", "harbour_sorted.txt", RECORDS[0], RECORDS[-1], len(MASTER), 1)]
    probes = spark.createDataFrame([("mast",), ("\U0001f600",), ("",)], "probe string")
    assert rows(membership.candidates(probes, index), "probe") == [("mast",)]


def test_status_and_audit_of_a_sound_corpus(spark, corpus):
    shard_bytes = sum(len(text(rs)) for rs in SHARDS.values())
    warning = M.LOW_COVERAGE % ("harbour", shard_bytes, "harbour_sorted.txt", len(MASTER))
    s = files.status(spark, corpus).first()
    assert (s["ok"], s["dataset_count"], s["shard_count"], s["missing_files"], s["unsorted_datasets"], s["sorted_datasets"], s["coverage_warnings"], s["audit"]) == (True, 1, 1, [], [], ["harbour"], [warning], None)
    audited = files.audit(spark, corpus)
    a = audited.first()
    assert (a["ok"], a["shards"], a["sampled_files"], a["sorted"], a["shard_bytes"], a["master_bytes"], a["errors"], a["warnings"]) == (True, 2, 2, True, shard_bytes, len(MASTER), [], [warning])
    said, code = files.audit_outcome(audited, 0)
    assert code == 0 and json.loads(said) == {"ok": True, "checkedAt": "1970-01-01T00:00:00.000Z", "datasetCount": 1, "errors": [], "warnings": [warning], "results": [{"dataset": "harbour", "shards": 2, "sampledFiles": 2, "sorted": True, "shardBytes": shard_bytes, "sortedMaster": {"file": "harbour_sorted.txt", "sizeBytes": len(MASTER)}}]}
    audits = snapshot.Audits(lambda: json.loads(said))
    audits.once()
    assert json.loads(files.status(spark, corpus, audits).first()["audit"])["report"]["results"][0]["dataset"] == "harbour"


def test_rebuild_gives_the_manifest_back(spark, corpus):
    at = Path(corpus) / "harbour" / "lookup.txt"
    at.write_bytes(b"stale\na\nb\n")
    rebuilt = files.rebuild(spark, corpus)
    assert rows(rebuilt, "dataset", "shards") == [("harbour", 2)]
    assert at.read_bytes() == MANIFEST and {p.name for p in at.parent.iterdir()} >= {*SHARDS, "lookup.txt"}
    report = files.rebuild_report(rebuilt, 1000).first()
    assert (report["ok"], report["rebuiltAt"], report["datasetCount"], [tuple(r) for r in report["results"]]) == (True, "1970-01-01T00:00:01.000Z", 1, [("harbour", 2)])


def test_unsorted_files_lose_no_match(spark, tmp_path):
    """A master and a shard whose first and last record aren't the least and the greatest."""
    root = put(tmp_path, mixed={"mixed_sorted.txt": b"m\nz\na\nn\n", "m_1.txt": b"m\n", "lookup.txt": b"m_1.txt\nm\nm\n"}, loose={"l_1.txt": b"k\na\nz\nk\n", "lookup.txt": b"l_1.txt\nk\nk\ngone.txt\nb\nc\n"})
    index = files.build_index(spark, root)
    assert rows(index, "dataset", "file", "lo", "hi") == [("loose", "gone.txt", "b", "c"), ("loose", "l_1.txt", "a", "z"), ("mixed", "mixed_sorted.txt", "a", "z")]
    probes = spark.createDataFrame([("a",), ("z",), ("k",)], "probe string")
    assert rows(membership.candidates(probes, index).filter("file <> 'gone.txt'"), "probe", "dataset") == [(p, d) for p in "akz" for d in ("loose", "mixed")]
    a = {r["dataset"]: r for r in files.audit(spark, root).collect()}
    assert "mixed/mixed_sorted.txt is not in byte order" in a["mixed"]["warnings"]
    assert files.audit_outcome(files.audit(spark, root), 0)[1] == 1


def test_facts_of_files_cut_into_blocks(spark, tmp_path):
    lines = [f"{i * 7919 % 10007:05d}" for i in range(4000)]
    root = put(tmp_path, d={"a.txt": text(sorted(lines)), "b.txt": text(lines) + b"\n\n", "c.txt": b"\n\n", "none.txt": b""})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = {r["file"]: r for r in files.file_facts(spark, [f"{root}/d/{x}.txt" for x in ("a", "b", "c", "none")]).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(got) == {"a.txt", "b.txt", "c.txt"}
    a, b, c = (got[f"{x}.txt"] for x in "abc")
    assert (a["first_line"], a["last_full_line"], a["in_order"], a["records"], a["size_bytes"]) == (min(lines), max(lines), True, 4000, 24_000)
    assert (b["first_line"], b["last_line"], b["last_full_line"], b["lo"], b["hi"], b["in_order"], b["records"]) == (lines[0], "", lines[-1], "", max(lines), False, 4002)
    assert (c["first_line"], c["last_full_line"], c["in_order"]) == ("", None, True)


def test_seeking_reads_few_bytes(spark, tmp_path):
    lines = sorted({f"{i * 7919 % 100_003:06d}" + "x" * (i % 50) for i in range(20_000)})
    raw = "".join(f"{x}{chr(13) if i % 3 == 0 else ''}\n" for i, x in enumerate(lines)).encode()
    root = put(tmp_path, d={"s_sorted.txt": raw, "one.txt": b"only", "blank.txt": b"\n\n", "none.txt": b"", "dup.txt": b"a\nb\nb\nb\nc\n"})
    with seek.TextFile(spark, f"{root}/d/s_sorted.txt", block=256) as f:
        whole, reads = f.bytes_at, []
        f.bytes_at = lambda a, z: reads.append((a, z)) or whole(a, z)
        at = 0
        for i, x in enumerate(lines[:40] + lines[-3:]):
            found = f.find(x)
            assert found.record.decode() == x and raw[found.offset : found.next].rstrip(b"\r\n").decode() == x
        assert len(reads) < 43 * 20 * 4 and all(z - a <= 256 for a, z in reads)
        assert f.find("zzz") is None and f.find("0") is None and f.find("") is None
        for at in (0, 1, 5, len(raw) // 2, len(raw) - 1, len(raw) + 10):
            begin = raw.rfind(b"\n", 0, min(at, len(raw) - 1)) + 1
            assert f.line_holding(at).offset == begin
        assert f.line_from(3).raw == raw[3 : raw.index(b"\n")] and f.line_from(len(raw)) is None
        assert [x.decode() for x in f.ends()] == [lines[0], lines[-1]]
    got = {p.rsplit("/", 1)[1]: (a, z, n) for p, a, z, n in seek.boundaries(spark, [f"{root}/d/{x}.txt" for x in ("one", "blank", "none", "dup")])}
    assert got == {"one.txt": (b"only", b"only", 4), "blank.txt": (None, None, 2), "none.txt": (None, None, 0), "dup.txt": (b"a", b"c", 10)}
    assert seek.point_lookup(spark, "b", [f"{root}/d/{x}.txt" for x in ("one", "dup", "none")]) == [(f"{root}/d/dup.txt", 2)]


def test_filters_beside_files(spark, corpus, tmp_path):
    paths = [f"{corpus}/harbour/{name}" for name in SHARDS]
    files.write_filters(spark, paths, f"{tmp_path}/bloom", n=100)
    probes = spark.createDataFrame([(r,) for r in [*RECORDS, "nowhere", ""]], "probe string")
    passed = sketch.files_that_may_hold(spark.read.parquet(f"{tmp_path}/bloom"), probes, ["dataset", "file"])
    assert set(rows(passed, "probe", "file")) >= {(r, name) for name, rs in SHARDS.items() for r in rs}
    assert files.text_files(spark, f"{corpus}/harbour") == sorted(f"file:{corpus}/harbour/{name}" for name in [*SHARDS, "harbour_sorted.txt", "lookup.txt"])


def test_rebuild_orders_files_by_number(spark, tmp_path):
    root = put(tmp_path, s={"s_10.txt": b"m\nz\n", "s_2.txt": b"c\nd\n", "s_1.txt": b"a\nb\n", "s.zip": b"-", "lookup.txt": b""}, other={"o_1.txt": b"a\n"})
    assert rows(files.rebuild(spark, root), "dataset", "shards") == [("s", 3)]
    assert (tmp_path / "s" / "lookup.txt").read_bytes() == b"s_1.txt\na\nb\ns_2.txt\nc\nd\ns_10.txt\nm\nz\n"
    assert rows(files.rebuild(spark, root, only=["other"]), "dataset") == []


def test_faults_are_reported_as_rows(spark, tmp_path):
    root = put(
        tmp_path,
        missing={"lookup.txt": b"gone.txt\na\nb\n"},
        empty={"lookup.txt": b""},
        bad={"lookup.txt": b"a\nb\nc\nd\n"},
        wrong={"w.txt": b"b\na\n", "lookup.txt": b"w.txt\nx\ny\n"},
        crlf={"c.txt": b"a\r\nb\r\n", "lookup.txt": b"c.txt\r\na\r\nb\r\n"},
    )
    a = {r["dataset"]: r for r in files.audit(spark, root).collect()}
    assert a["missing"]["errors"] == ["missing/gone.txt boundaries do not match lookup.txt", "no such file: missing/gone.txt"]
    assert a["empty"]["ok"] and a["empty"]["shards"] == 0
    assert a["bad"]["errors"] == ["bad/lookup.txt has 4 lines, expected a multiple of 3"]
    assert a["wrong"]["errors"] == ["wrong/w.txt boundaries do not match lookup.txt"]
    assert a["crlf"]["ok"]
    s = files.status(spark, root).first()
    assert not s["ok"] and s["missing_files"] == ["missing/gone.txt"] and s["dataset_count"] == 5


def test_index_and_audit_differ_on_order(spark):
    m = spark.createDataFrame([("a", 0, "f", "a", "z"), ("a", 1, "g", "a", "b"), ("b", 0, "f", "b", "c"), ("b", 1, "g", "a", "d"), ("c", 0, "f", "a", "b"), ("c", 1, "g", "b", "c")], "dataset string, entry int, file string, lo string, hi string")
    assert rows(M.unsorted_index(m), "dataset") == [("a",), ("b",)]
    assert rows(M.unsorted_audit(m), "dataset", "entry_no") == [("b", 2)]


def test_largest_master_and_ties(spark):
    got = M.largest_masters(spark.createDataFrame([("d", "a_sorted.txt", 5), ("d", "b_sorted.txt", 9), ("d", "c_sorted.zip", 99), ("e", "a_sorted.txt", 7), ("e", "b_sorted.txt", 7)], "dataset string, file string, size_bytes long"))
    assert rows(got, "dataset", "file") == [("d", "b_sorted.txt"), ("e", "b_sorted.txt")]


def test_line_numbers_are_never_taken_from_records(spark, tmp_path):
    root = put(tmp_path, n={"n.txt": b"a\nx:99\n12345\n"})
    lines = files.read_lines(spark, f"{root}/n/n.txt")
    probes = spark.createDataFrame([("12345",), ("x:99",)], "probe string")
    assert rows(membership.locations(probes, lines, ["file", "line_no"]), "probe", "file", "line_no") == [("12345", "n.txt", 3), ("x:99", "n.txt", 2)]


def test_offsets_of_repeated_records_and_order_of_bytes(spark):
    words = ["Z", "a", "a", "a", "é", "￮", "\U0001f600"]
    m = membership.master_offsets(spark.createDataFrame([("d", w) for w in words], "dataset string, line string"), ["dataset"])
    assert {r["line"]: r["offset"] for r in m.collect()} == {"Z": 0, "a": 2, "é": 8, "￮": 11, "\U0001f600": 15}
    at = spark.createDataFrame([("d", x) for x in range(20)], "dataset string, position long")
    got = {r["position"]: r["line_offset"] for r in membership.line_at(m, at, ["dataset"], bin_bytes=4).collect()}
    assert [got[x] for x in range(20)] == [0, 0, 2, 2, 4, 4, 6, 6, 8, 8, 8, 11, 11, 11, 11, 15, 15, 15, 15, 15]


def test_lower_bounds(spark):
    corpus = spark.createDataFrame([(x,) for x in ("abc", "abd", "b", "zz")], "line string")
    probes = spark.createDataFrame([(x,) for x in ("", "abc", "abcd", "abe", "c", "zzz")], "probe string")
    got = {r["probe"]: r["bound"] for r in membership.lower_bound(probes, corpus).collect()}
    assert got == {"": "abc", "abc": "abc", "abcd": "abd", "abe": "b", "c": "zz", "zzz": None}
