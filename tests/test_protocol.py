import json

import pytest
from pyspark.sql import functions as F

from tracewell import session
from tracewell.streaming import lookups


def test_all_that_clients_are_told(spark):
    probes = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("5", "e")], "id string, probe string")
    candidates = spark.createDataFrame(
        [("1", "sorted", "x", "m.txt", "x/m.txt"), ("2", "lookup", "y", "s.txt", "y/s.txt"), ("2", "sorted", "x", "m.txt", "x/m.txt"), ("3", "lookup", "y", "s.txt", "y/s.txt"), ("5", "lookup", "y", "s.txt", "y/s.txt")], "id string, kind string, dataset string, file string, full_path string"
    )
    sorted_hits = spark.createDataFrame([("1", "x/m.txt", 7), ("2", "x/m.txt", 9)], "id string, full_path string, offset long")
    lookup_hits = spark.createDataFrame([("2", "y/s.txt", 3), ("2", "x/m.txt", 4)], "id string, full_path string, line long")
    failures = spark.createDataFrame([("5", "disk gone")], "id string, error string")
    told = lookups.scan_events(probes, candidates, sorted_hits, lookup_hits, failures).select("id", "step", lookups.to_message(F.col("event"), F.lit(0)).alias("m"))
    got = {}
    for r in told.orderBy("id", "step").collect():
        said = json.loads(r["m"])
        assert said.pop("type") == "update" and said.pop("timestamp") and said.pop("id") == r["id"]
        got.setdefault(r["id"], []).append(said)
    both = [{"dataset": "x", "file": "m.txt", "kind": "sorted"}, {"dataset": "y", "file": "s.txt", "kind": "lookup"}]
    assert got["1"] == [{"ok": False, "file": "x/m.txt", "offset": 7, "source": "sorted"}, {"done": True}]
    assert got["2"] == [{"ok": False, "file": "x/m.txt", "offset": 9, "source": "sorted"}, {"debug": "searching 2 shards", "candidates": both}, {"ok": False, "file": "y/s.txt", "line": 3}, {"done": True, "exitCode": 0}]
    assert got["3"] == [{"debug": "searching 1 shards", "candidates": both[1:]}, {"done": True, "exitCode": 1}]
    assert got["4"] == [{"debug": lookups.NO_CANDIDATE}, {"done": True}]
    assert got["5"][1:] == [{"error": "disk gone"}, {"done": True, "exitCode": 2}]


def test_only_the_first_message_counts_until_the_client_is_gone(spark):
    said = [("a", 1, "one", None), ("a", 2, "two", None), ("b", 3, "x", None), ("a", 4, None, True), ("a", 5, "three", None), ("a", 6, "four", None), ("b", 7, "y", False)]
    got = lookups.first_messages(spark.createDataFrame(said, "id string, at long, value string, closed boolean"))
    assert sorted(map(tuple, got.select("id", "connection", "value").collect())) == [("a", 0, "one"), ("a", 1, "three"), ("b", 0, "x")]


def test_each_id_ends(spark):
    hits = spark.createDataFrame([("1", "f")], "id string, file string")
    got = lookups.with_end(hits, spark.createDataFrame([("1",), ("2",), ("2",)], "id string"))
    assert sorted((r["id"], r["done"], r["file"]) for r in got.collect()) == [("1", False, "f"), ("1", True, None), ("2", True, None)]


def test_streams_meet_a_corpus_without_repetitions(spark, tmp_path):
    corpus = lookups.prepared(spark.createDataFrame([("a", "f"), ("a", "f"), ("b", "g")], "line string, file string"), ["file"])
    assert corpus.count() == 2
    spark.createDataFrame([("1", "a"), ("2", "q")], "id string, probe string").write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema("id string, probe string").json(f"{tmp_path}/in")
    out = lookups.run_available(lookups.stream_hits(stream, corpus, ["file"]), f"{tmp_path}/q")
    assert [tuple(r) for r in out.select("id", "file").collect()] == [("1", "f")]


def test_no_folder_of_our_own_on_a_cluster():
    class Fake:
        class conf:  # noqa: N801
            @staticmethod
            def get(*_):
                return None

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Fake)


def test_a_remote_service_is_asked_again_a_few_times(spark, tmp_path):
    from tracewell.sources import range_store

    folder = str(tmp_path)

    def fetch(prefix):
        import os

        with open(os.path.join(folder, prefix), "a") as f:
            f.write("x")
        asked = os.path.getsize(os.path.join(folder, prefix))
        if prefix == "86F7E":  # a: answers the second time
            return (200, "437FAA5A7FCE15D1DDCB9EAEAEA377667B8:41\r\n") if asked > 1 else (503, "busy")
        return (404, "") if prefix == "E9D71" else (500, "")

    got = range_store.remote_counts(spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "probe string"), fetch)
    assert sorted((r["probe"], r["count"], r["remote_status"]) for r in got.collect()) == [("a", 41, 200), ("a", 41, 200), ("b", 0, 404), ("c", 0, 500)]
    assert {p.name: p.stat().st_size for p in tmp_path.iterdir()} == {"86F7E": 2, "E9D71": 1, "84A51": 3}


def test_results_that_are_no_more_needed_go(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    first = session.kept_so_far(spark)
    one = session.durable(spark.range(10))
    two = session.durable(one.filter("id > 5"))
    files = [Path(urlparse(f).path) for f in session._files(spark)[first:]]
    assert len(files) == 2 and all(f.exists() for f in files)
    session.drop_kept(spark, first, session.kept_so_far(spark) - 1)
    assert [f.exists() for f in files] == [False, True] and two.count() == 4
