import json
import threading

import pytest
from pyspark.sql import functions as F

from tracewell.functions import strings as S
from tracewell.operators import kanon, sketch
from tracewell.plans import layout, snapshot
from tracewell.sources import range_store
from tracewell.streaming import lookups


def column(spark, values, made, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(made(F.col("v"))).collect()]


def test_one_carriage_return_goes(spark):
    assert column(spark, ["a\r", "a\r\r", "a\r\n", "", None], S.strip_cr) == ["a", "a\r", "a\r\n", "", None]


def test_lines_of_a_text(spark):
    assert column(spark, ["a\nb\n\n", "a\r\nb", "", "\n"], S.split_lines) == [["a", "b", ""], ["a", "b"], [], [""]]


def test_leading_numbers(spark):
    assert column(spark, ["12abc", " 7", "-3", "x", "", None, "9" * 30], S.leading_int) == [12, 7, -3, 0, 0, 0, 0]


def test_natural_order(spark):
    names = ["s_10", "s_2", "s_1", "s_b", "s"]
    assert [n for _, n in sorted(zip(column(spark, names, S.natural_key), names, strict=True))] == ["s", "s_1", "s_2", "s_10", "s_b"]


def test_hash_halves(spark):
    assert column(spark, ["password", "é"], lambda v: S.hash_prefix(S.sha1_upper(v))) == ["5BAA6", "BF15B"]


def test_requests(spark):
    said = ['{"password":"x"}', '{"password":5}', '{"other":1}', "5", "null", '"q"', "not json", '{"password":""}', "", None]
    assert column(spark, said, S.requested_text) == ["x", '{"password":5}', '{"other":1}', "5", "null", '"q"', "not json", "", "", None]


def test_samples(spark):
    def expected(n, limit=3):
        return sorted({0, max(0, n - 1)} | {i * n // (limit + 1) for i in range(1, min(n - 1, limit))})

    sizes = [0, 1, 2, 3, 4, 5, 10, 80]
    assert column(spark, sizes, S.sample_indices, "long") == [expected(n) for n in sizes]


def test_range_table_and_responses(spark):
    table = kanon.range_table(spark.createDataFrame([("a",), ("a",), ("b",)], "line string"))
    got = kanon.counts(spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "probe string"), table)
    assert {r["probe"]: r["count"] for r in got.collect()} == {"a": 2, "b": 1, "c": 0, None: 0}
    parsed = kanon.parse_response(spark.createDataFrame([("AAAAA", "S1:3\r\nS2:x\r\n S3 : 9 \r\nS1:7\r\nbroken")], "prefix string, body string"))
    assert {r["suffix"]: r["count"] for r in parsed.collect()} == {"S1": 3, "S2": 0, "S3": 9}


def test_verdicts(spark):
    got = kanon.verdicts(spark.createDataFrame([("a", 2, False), ("b", 0, True), ("c", 0, False), ("", 0, False), (None, 0, False)], "probe string, count long, hit boolean"))
    assert {r["probe"]: (r["ok"], r["count"], r["reason"]) for r in got.collect()} == {"a": (False, 2, None), "b": (False, 0, None), "c": (True, None, None), "": (False, None, kanon.NO_PROBE), None: (False, None, kanon.NO_PROBE)}


def test_remote_ranges_fail_open_but_say_so(spark):
    def fetch(prefix):
        if prefix == "86F7E":  # a
            return 200, "437FAA5A7FCE15D1DDCB9EAEAEA377667B8:41\r\n"
        if prefix == "E9D71":  # b
            return 503, "busy"
        raise OSError("no way")

    got = range_store.remote_counts(spark.createDataFrame([("a",), ("b",), ("c",)], "probe string"), fetch)
    assert {r["probe"]: (r["count"], r["remote_status"]) for r in got.collect()} == {"a": (41, 200), "b": (0, 503), "c": (0, -1)}


def test_stored_ranges(spark, tmp_path):
    range_store.write_range_table(kanon.range_table(spark.range(2000).select(F.col("id").cast("string").alias("line"))), f"{tmp_path}/r", files=4)
    df = range_store.read_range(spark, f"{tmp_path}/r", "B6589")  # 0 is B6589FC6…
    assert df.filter("suffix = 'FC6AB0DC82CF12099D1C2D40AB994E8410C'").count() == 1
    assert "EqualTo(prefix,B6589)" in df._jdf.queryExecution().toString()


def test_layout_pushes_lookups_down(spark, tmp_path):
    layout.write_corpus(spark.range(5000).select(F.format_string("w%05d", "id").alias("line"), F.lit("x").alias("more")), f"{tmp_path}/c", files=4, bloom=True)
    df = layout.lookup(spark, f"{tmp_path}/c", "w00042").select("line")
    plan = df._jdf.queryExecution().toString()
    assert df.count() == 1 and "EqualTo(line,w00042)" in plan and "ReadSchema: struct<line:string>" in plan


def test_bloom_filter_has_no_false_negatives(spark):
    corpus = spark.range(1000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("line"))
    bloom = sketch.build(corpus, n=1000, fpp=0.01)
    seen = corpus.filter(sketch.may_contain(spark, bloom, F.col("line"))).count()
    other = spark.range(1000).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("line")).filter(sketch.may_contain(spark, bloom, F.col("line"))).count()
    assert seen == 1000 and other < 40
    assert len(sketch.to_bytes(spark, bloom)) > 1000
    assert sketch.build(corpus, n=15_000_000).bitSize() >= sketch.bits_for(15_000_000, 0.01)


def test_stream_of_probes(spark, tmp_path):
    spark.createDataFrame([("1", '{"password":"a"}'), ("2", "b"), ("3", "zz")], "id string, value string").write.json(f"{tmp_path}/in")
    corpus = spark.createDataFrame([("a", "f1"), ("a", "f2"), ("b", "f1")], "line string, file string")
    messages = spark.readStream.schema("id string, value string").json(f"{tmp_path}/in")
    out = lookups.run_available(lookups.stream_hits(lookups.requests(messages), corpus, ["file"]), f"{tmp_path}/q")
    assert sorted(map(tuple, out.select("id", "file").collect())) == [("1", "f1"), ("1", "f2"), ("2", "f1")]
    assert "probe" not in out.columns


def test_events(spark):
    e = lookups.event("update", id=F.lit("7"), done=F.lit(True))
    said = json.loads(spark.range(1).select(lookups.to_message(e, F.lit(0))).first()[0])
    assert said == {"type": "update", "timestamp": "1970-01-01T00:00:00.000Z", "id": "7", "done": True}
    with pytest.raises(ValueError):
        lookups.event("update", secret=F.lit("x"))
    events = spark.createDataFrame([("1",), ("2",)], "id string")
    assert [r["id"] for r in lookups.open_only(events, events.filter("id = '1'")).collect()] == ["2"]


def test_snapshot_loads_once_and_again_when_old():
    now, loads = [0.0], []
    s = snapshot.Snapshot(lambda: loads.append(1) or len(loads), ttl_ms=300_000, clock=lambda: now[0])
    threads = [threading.Thread(target=s.get) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert loads == [1] and s.get() == 1
    now[0] = 301
    assert s.get() == 2 and s.get(refresh=True) == 3


def test_audits_keep_the_latest_outcome():
    reports = iter([{"ok": True}])
    a = snapshot.Audits(lambda: next(reports))
    assert a.once()["ok"] and not a.once()["ok"] and a.latest["report"]


def test_settings():
    s = snapshot.Settings.read({"TRACEWELL_RANGE_SERVICE": "http://x", "TRACEWELL_PORT": "abc", "TRACEWELL_SAMPLE_LIMIT": "5"})
    assert (s.port, s.sample_limit, s.audit_interval_ms) == (8080, 5, 900_000)
    with pytest.raises(ValueError, match="RANGE_SERVICE"):
        snapshot.Settings.read({})
