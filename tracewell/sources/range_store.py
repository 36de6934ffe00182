"""Stores of k-anonymity ranges: a sorted table of our own, or a remote service behind a fetching function."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import strings as S
from tracewell.operators import kanon
from tracewell.session import durable


def write_range_table(table: DataFrame, path: str, files: int = 200) -> None:
    """Sorted by hash in ranges, so a prefix touches few row groups; a folder a prefix would be a million folders."""
    h = F.concat("prefix", "suffix")
    table.repartitionByRange(files, h).sortWithinPartitions("prefix", "suffix").write.mode("overwrite").parquet(path)


def read_range(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("prefix") == prefix)


def remote_counts(probes: DataFrame, fetch: Callable[[str], tuple[int, str]], probe: str = "probe", *, attempts: int = 3, at_once: int = 8) -> DataFrame:
    """Each probe row with `count` and `remote_status`, asking a remote service for each distinct prefix.

    fetch takes a prefix and gives an HTTP status and a body; nothing here opens a connection by itself.  A status
    other than 2xx counts as 0, and so does a failed connection, whose status is -1; the status tells them from absence.
    A failed connection and a status of 429 or from 500 on are asked again, up to `attempts` times in all.  A task has
    at_once requests under way.  Answers are kept, so that a prefix isn't asked for twice but by a task that is repeated.
    """

    def one(p: str) -> tuple[str, int, str]:
        code, body = -1, ""
        for _ in range(attempts):
            try:
                code, body = fetch(p)
            except OSError:
                code, body = -1, ""
            if 0 <= code < 500 and code != 429:
                break
        return p, code, body if 200 <= code < 300 else ""

    def ask(batches: Iterable):
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa

        for b in batches:
            with ThreadPoolExecutor(at_once) as pool:
                rows = list(pool.map(one, b.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string()))], names=["prefix", "remote_status", "body"])

    asked = probes.withColumn("prefix", S.hash_prefix(S.sha1_upper(probe)))
    got = asked.filter("prefix is not null").select("prefix").distinct().mapInArrow(ask, "prefix string, remote_status int, body string")
    got = durable(got)
    return kanon.counts(probes, kanon.parse_response(got), probe).withColumn("prefix", S.hash_prefix(S.sha1_upper(probe))).join(got.select("prefix", "remote_status"), "prefix", "left").drop("prefix")
