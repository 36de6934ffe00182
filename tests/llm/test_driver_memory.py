import re
from pathlib import Path

import pytest

from tracewell.llm import common, graph


def native_mb(spark):
    """MB of the driver's JVM that aren't mapped files."""
    rollup = Path(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup")
    if not rollup.exists():
        pytest.skip("memory can't be read here")
    return int(re.search(r"\nPss_Anon:\s+(\d+)", rollup.read_text())[1]) / 1024


def leave_behind(spark, blocks=2000, size=100_000):
    """Memory that is free again, below a block that isn't, which is what the C library keeps; that block."""
    platform = spark._jvm.org.apache.spark.unsafe.Platform
    made = [platform.allocateMemory(size) for _ in range(blocks)]
    for at in made:
        platform.setMemory(at, 1, size)
    for at in made[:-1]:
        platform.freeMemory(at)
    return made[-1]


def test_memory_that_threads_leave_behind_goes_back(spark):
    spark._jvm.System.gc()
    last = leave_behind(spark)
    held = native_mb(spark)
    common.release(spark)
    assert native_mb(spark) < held - 100
    spark._jvm.org.apache.spark.unsafe.Platform.freeMemory(last)


def test_each_round_of_components_gives_memory_back(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "release", lambda s: rounds.append(common.release(s)))
    found = graph.components(spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)} and len(rounds) > 2
