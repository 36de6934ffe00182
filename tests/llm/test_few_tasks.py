import pytest
from test_text_filters import brute_components, near_copies

from tracewell.llm import graph, near_duplicates
from tracewell.session import compact, tasks_of


@pytest.fixture
def many_partitions(spark):
    """A session that gives each shuffle 61 tasks, however few rows it has."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 61
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def stages_run(spark, work):
    """What work gives, and how many tasks each of its stages ran."""
    context = spark.sparkContext
    context.setJobGroup("counted", "")
    got = work()
    track = context.statusTracker()
    stages = {s for j in track.getJobIdsForGroup("counted") if track.getJobInfo(j) for s in track.getJobInfo(j).stageIds}
    context.setLocalProperty("spark.jobGroup.id", None)
    return got, [i.numCompletedTasks for s in stages if (i := track.getStageInfo(s))]


def test_small_results_are_read_by_few_tasks(spark, many_partitions):
    kept = compact(spark.range(0, 5000, 1, 61))
    assert tasks_of(kept) <= 12 and kept.distinct().count() == 5000
    assert tasks_of(compact(spark.range(0, 40, 1, 3))) == 3
    empty = spark.createDataFrame([], "u long, v long")
    assert compact(empty).count() == 0 and graph.components(empty).count() == 0


def test_near_duplicates_of_few_rows_run_few_tasks(spark, many_partitions):
    said = near_copies(11, 4, 30, 70, 8) + near_copies(12, 4, 6, 40, 3) + ["a b c", "", None]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    rows, ran = stages_run(spark, lambda: near_duplicates.classes(docs, settings=near_duplicates.Settings(small=2, block_sets=16)).collect())
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_components(list(range(len(said))), said, 3, 85)
    assert sum(n >= many_partitions for n in ran) < 15
