"""k-anonymity range tables and verdicts.

A range table is (prefix, suffix, count): the first five and the other thirty-five digits of an upper-case SHA-1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions import strings as S

#: Fixed value: the reason that callers know for a request without a probe.
NO_PROBE = "No password provided."


def range_table(corpus: DataFrame, record: str = "line") -> DataFrame:
    """How often each record occurs, by its hash; records themselves aren't in it."""
    counted = corpus.groupBy(F.col(record).alias("r")).agg(F.count("*").alias("count")).withColumn("h", S.sha1_upper("r"))
    return counted.select(S.hash_prefix("h").alias("prefix"), S.hash_suffix("h").alias("suffix"), "count")


def parse_response(responses: DataFrame) -> DataFrame:
    """Rows of a range table from (prefix, body) with lines of SUFFIX:COUNT; the first line of a suffix counts."""
    lines = responses.select("prefix", F.posexplode(F.split("body", "\r?\n", -1)).alias("pos", "text"))
    parts = lines.select("prefix", "pos", F.split(F.trim("text"), ":", -1).alias("p")).filter(F.size("p") > 1)
    rows = parts.select("prefix", "pos", F.trim(F.get("p", F.lit(0))).alias("suffix"), S.leading_int(F.get("p", F.lit(1))).alias("n"))
    return rows.groupBy("prefix", "suffix").agg(F.min_by("n", "pos").alias("count"))


def counts(probes: DataFrame, table: DataFrame, probe: str = "probe") -> DataFrame:
    """Each probe row with `count`, 0 where its hash isn't in the table."""
    asked = probes.withColumn("__h", S.sha1_upper(probe)).withColumn("prefix", S.hash_prefix("__h")).withColumn("suffix", S.hash_suffix("__h"))
    return asked.join(table.select("prefix", "suffix", "count"), ["prefix", "suffix"], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint"))).drop("__h", "prefix", "suffix")


def verdicts(evidence: DataFrame, probe: str = "probe") -> DataFrame:
    """ok, count and reason from rows with `count` (remote) and `hit` (local).

    No probe, no verdict but a reason.  Found in either place: not ok, with the remote count.  Else ok.
    """
    none = F.col(probe).isNull() | (F.col(probe) == "")
    found = (F.col("count") > 0) | F.col("hit")
    return evidence.withColumn("ok", F.when(none, False).otherwise(~found)).withColumn("reason", F.when(none, NO_PROBE)).withColumn("count", F.when(~none & found, F.col("count"))).drop("hit")
