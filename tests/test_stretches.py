import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.operators import membership, sketch, stretches
from tracewell.plans import catalogue


@pytest.fixture(params=[1, 7])
def tasks(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_sums(spark, tasks):
    r = random.Random(3)
    rows = [(r.choice(["a", "a", "a", "b", None, "\u00fc"]), i, r.randint(-3, 9)) for i in range(3000)]
    got = stretches.running_before(spark.createDataFrame(rows, "k string, i int, w int"), ["k"], ["i"], F.col("w"), "before").collect()
    total, expected = {}, {}
    for k, i, w in rows:
        expected[i] = total.get(k, 0)
        total[k] = expected[i] + w
    assert {x["i"]: x["before"] for x in got} == expected
    whole = stretches.running_before(spark.createDataFrame(rows, "k string, i int, w int"), [], ["i"], F.lit(2), "before").collect()
    assert {x["i"]: x["before"] for x in whole} == {i: 2 * i for i in range(3000)}
    assert stretches.running_before(spark.createDataFrame([], "k string, i int"), ["k"], ["i"], F.lit(1), "before").count() == 0


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_nearest_rows(spark, tasks, after, strict):
    r = random.Random(4)
    right = {(r.choice("abc"), r.randint(0, 400)) for _ in range(150)}
    left = {(r.choice("abcd"), r.randint(0, 400)) for _ in range(600)}
    one = spark.createDataFrame(sorted(left), "k string, at int").withColumn("more", F.col("at") * 2)
    two = spark.createDataFrame([(k, at, f"{k}{at}") for k, at in sorted(right)], "k string, at int, said string")
    got = stretches.nearest(one, two, ["k"], "at", ["said"], after=after, strict=strict).collect()
    assert len(got) == len(left)
    for x in got:
        places = sorted(at for k, at in right if k == x["k"])
        cut = (bisect.bisect_right if after == strict else bisect.bisect_left)(places, x["at"])
        cut = cut if after else cut - 1
        assert x["said"] == (f"{x['k']}{places[cut]}" if 0 <= cut < len(places) else None) and x["more"] == 2 * x["at"]
    assert stretches.nearest(one, two.limit(0), ["k"], "at", ["said"]).filter("said is not null").count() == 0
    assert stretches.nearest(one.limit(0), two, ["k"], "at", ["said"]).count() == 0


def test_no_window_over_a_dataset(spark, sf_dir):
    for name in ("first_offset", "lower_bound", "line_at_offset", "line_starting_at", "exact_locations", "event_envelope", "no_prefix_match"):
        plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan, name


@pytest.mark.parametrize("tasks", [7], indirect=True)
def test_one_common_beginning_is_dealt_to_all_tasks(spark, tasks):
    corpus = spark.range(20_000).select(F.format_string("same beginning %06d", "id").alias("line"), F.lit("d").alias("d"))
    dealt = stretches._dealt(corpus, [F.col("d"), F.col("line")], [])
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == tasks and max(sizes) < 2 * 20_000 / tasks
    got = membership.master_offsets(corpus, ["d"]).agg(F.max("offset"), F.countDistinct("offset")).first()
    assert tuple(got) == (22 * 19_999, 20_000)


def _masters(spark):
    """Records of two masters, by text, and their bytes."""
    r = random.Random(5)
    rows = [(d, "x" * r.randint(0, 9) + str(r.randint(0, 300))) for d in ("a", "b") for _ in range(1500)]
    raw = {d: "".join(f"{w}\n" for k, w in sorted(rows) if k == d).encode() for d in ("a", "b")}
    at = spark.createDataFrame([(d, p) for d in raw for p in range(0, len(raw[d]), 3)], "d string, position long")
    return membership.master_offsets(spark.createDataFrame(rows, "d string, line string"), ["d"]), raw, at


def test_sums_and_neighbours_in_a_union(spark, tasks):
    other = spark.range(0, 3000, 1, 5)
    summed = stretches.running_before(spark.range(3000).withColumn("k", F.col("id") % 2), ["k"], ["id"], F.lit(1), "before")
    got = other.select("id", (F.col("id") - 5000).alias("before")).unionByName(summed.select("id", "before")).filter("before >= 0").collect()
    assert {x["id"]: x["before"] for x in got} == {i: i // 2 for i in range(3000)}
    right = spark.range(0, 3000, 100).select("id", F.col("id").alias("found"))
    near = stretches.nearest(spark.range(3000), right, [], "id", ["found"])
    got = other.select("id", (F.col("id") - 5000).alias("found")).unionByName(near).filter("found is null or found >= 0").collect()
    assert {x["id"]: x["found"] for x in got} == {i: i // 100 * 100 for i in range(3000)}


def test_lines_at_places_of_masters_in_many_stretches(spark, tasks):
    masters, raw, at = _masters(spark)
    got = {(x["d"], x["position"]): x["line_offset"] for x in membership.line_at(masters, at, ["d"]).collect()}
    assert got == {(d, p): raw[d].rfind(b"\n", 0, p) + 1 for d in raw for p in range(0, len(raw[d]), 3)}


def test_what_starts_at_places_of_masters_in_many_stretches(spark, tasks):
    masters, raw, at = _masters(spark)
    got = {(x["d"], x["position"]): x["rest"] for x in membership.line_starting(masters, at, ["d"]).collect()}
    assert got == {(d, p): raw[d][p : raw[d].index(b"\n", p)].decode() for d in raw for p in range(0, len(raw[d]), 3)}


def test_lines_that_start_at_a_place(spark):
    masters = membership.master_offsets(spark.createDataFrame([("d", w) for w in ("aa", "aa", "b", "", "\u00e9e")], "d string, line string"), ["d"])
    raw = "\naa\naa\nb\n\u00e9e\n".encode()
    at = spark.range(20).selectExpr("'d' AS d", "id AS position")
    got = {r["position"]: bytes(r["rest"]) for r in membership.line_starting(masters, at, ["d"]).withColumn("rest", F.col("rest").cast("binary")).collect()}
    assert got == {p: raw[p : raw.index(b"\n", p)] for p in range(len(raw))}


def test_bins_grow_with_the_manifest(spark):
    entries = [(f"f{i}", f"{i:05d}", f"{i + 3:05d}") for i in range(2000)]
    probes = [f"{i:05d}" for i in range(0, 2010, 7)] + ["", "~"]
    m = spark.createDataFrame([*entries, ("none", None, None), ("turned", "2", "1")], "file string, lo string, hi string")
    got = {(r["probe"], r["file"]) for r in membership.candidates(spark.createDataFrame([(p,) for p in [*probes, None]], "probe string"), m).collect()}
    assert got == {(p, f) for p in probes for f, lo, hi in entries if lo <= p <= hi}
    assert membership.candidates(spark.createDataFrame([("a",)], "probe string"), m.limit(0)).count() == 0


def test_hits_in_reported_files_are_left_out(spark):
    found = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a")], "probe string, file string")
    assert sorted(map(tuple, membership.unseen(found, spark.createDataFrame([("p", "a")], "probe string, file string"), ["probe", "file"]).collect())) == [("p", "b"), ("q", "a")]


def test_filters_are_read_as_the_jvm_reads_them(spark):
    corpus = spark.range(3000).select(F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("file"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("line"))
    filters = sketch.per_file(corpus, ["file"], n=1500, fpp=0.02)
    asked = spark.range(6000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("probe")).select("probe", F.xxhash64("probe").alias("h")).collect()
    hashes = np.array([r["h"] for r in asked], np.int64)
    bloom = sketch.build(corpus.filter("file = 'even'"), n=1500, fpp=0.02)
    expected = [bloom.mightContainLong(int(h)) for h in hashes]
    assert sketch.holds(sketch.to_bytes(spark, bloom), hashes).tolist() == expected
    even = sketch.holds(bytes(filters.filter("file = 'even'").first()["bloom"]), hashes)
    assert even[np.arange(0, 3000, 2)].all() and even[3000:].mean() < 0.08
    assert sketch.build(corpus.limit(0), n=100).mightContainLong(7) is False
    assert sketch.prefiltered_hits(corpus.limit(0).withColumnRenamed("line", "probe"), corpus).count() == 0


def test_empty_records_can_be_found(spark):
    corpus = spark.createDataFrame([("",), ("a",)], "line string")
    assert sorted(r[0] for r in sketch.prefiltered_hits(spark.createDataFrame([("",), ("a",), ("b",)], "probe string"), corpus).collect()) == ["", "a"]
