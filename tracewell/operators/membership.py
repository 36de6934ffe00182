"""Exact membership of probes in a corpus, where they occur, and what lies next to them.

A corpus is a table with a string column of records; probes are a table with a string column.  Matches are of whole
records and by bytes.  Results carry the probe or its id as given and never another column of the corpus' text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators.stretches import nearest, running_before


def hits(probes: DataFrame, corpus: DataFrame, probe: str = "probe", record: str = "line") -> DataFrame:
    """Distinct probes that are records.

    The corpus is streamed past the probes: those are the side that is broadcast if it is small, and both are shuffled
    by value if it isn't.
    """
    asked = probes.select(F.col(probe).alias("__asked")).distinct()
    found = corpus.select(F.col(record).alias(probe))
    return found.join(asked, F.col(probe) == F.col("__asked"), "left_semi").distinct()


def membership(probes: DataFrame, corpus: DataFrame, probe: str = "probe", record: str = "line") -> DataFrame:
    """Each probe row with `hit`; a null probe is no hit."""
    found = hits(probes, corpus, probe, record).withColumnRenamed(probe, "__found")
    return probes.join(found, F.col(probe) == F.col("__found"), "left").withColumn("hit", F.col("__found").isNotNull()).drop("__found")


def not_found(probes: DataFrame, corpus: DataFrame, probe: str = "probe", record: str = "line") -> DataFrame:
    found = hits(probes, corpus, probe, record).withColumnRenamed(probe, "__found")
    return probes.join(found, F.col(probe) == F.col("__found"), "left_anti")


def proper_prefixes(probes: DataFrame, corpus: DataFrame, probe: str = "probe", record: str = "line") -> DataFrame:
    """Distinct probes, but the empty one, that some longer record begins with and that are no record.

    They must not count as matches.  Records that begin with a probe come right after it in byte order, so it is
    enough to look at the nearest record above each.
    """
    asked = probes.select(F.col(probe).alias("value")).filter("value <> ''").distinct()
    words = corpus.select(F.col(record).alias("value"), F.col(record).alias("above")).distinct()
    begun = nearest(asked, words, [], "value", ["above"], after=True, strict=True).filter(F.startswith("above", "value"))
    return not_found(begun.select(F.col("value").alias(probe)), corpus, probe, record)


def _place(bounds: list[bytes], value: Column) -> Column:
    """How many of the sorted bounds aren't above a value that isn't null, by bytes."""

    @F.pandas_udf("int")
    def place(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array([*bounds, None], object)[:-1], values.map(bytes).to_numpy(object), side="right").astype("int32"))

    return place(value.cast("binary"))


#: The most bounds that candidates are met by; they are sent to every task.
_MOST_BINS = 1 << 16


def candidates(probes: DataFrame, manifest: DataFrame, probe: str = "probe", lo: str = "lo", hi: str = "hi", bin_entries: int = 16) -> DataFrame:
    """Each probe with every manifest entry whose range [lo, hi] may hold it.

    A range join by bins: starts of ranges, one for some bin_entries entries, cut the order of strings; an entry lies
    in the bins that it spans and a probe in one, so rows meet by equality and neither side need be small.  Bins grow
    with the manifest, up to 2^16; a bin then has more entries.
    """
    entries = manifest.filter(F.col(lo) <= F.col(hi))
    n = entries.count()
    most = min(_MOST_BINS, max(1, n // bin_entries))
    part = F.pmod(F.xxhash64(lo), F.lit(1 << 20)) < int(min(1.0, 1.2 * most / max(n, 1)) * (1 << 20))
    starts = entries.select(F.col(lo).cast("binary").alias("b")).filter(F.lit(True) if n <= most else part).distinct().limit(_MOST_BINS).collect()
    bounds = sorted(bytes(r["b"]) for r in starts)
    spread = entries.withColumn("__bin", F.explode(F.sequence(_place(bounds, F.col(lo)), _place(bounds, F.col(hi)))))
    asked = probes.filter(F.col(probe).isNotNull()).withColumn("__bin", _place(bounds, F.col(probe)))
    return asked.join(spread, "__bin").filter(F.col(probe).between(F.col(lo), F.col(hi))).drop("__bin")


def unseen(found: DataFrame, reported: DataFrame, keys: list[str]) -> DataFrame:
    """Hits in files that weren't reported before: for callers that search masters and then shards."""
    return found.join(reported.select(*keys).distinct(), keys, "left_anti")


def locations(probes: DataFrame, corpus: DataFrame, keep: list[str], probe: str = "probe", record: str = "line") -> DataFrame:
    """A row for each record equal to a probe, with the columns `keep` of the corpus and not its text."""
    asked = probes.select(probe).distinct()
    return corpus.select(*keep, F.col(record).alias("__record")).join(asked, F.col("__record") == F.col(probe)).select(probe, *keep)


def master_offsets(records: DataFrame, keys: list[str], record: str = "line") -> DataFrame:
    """Distinct records of each sorted master, with the byte offset of the first and the offset after the last.

    Copies are counted before anything is ordered.
    """
    counted = records.groupBy(*keys, record).agg(F.count("*").alias("copies"))
    size = (F.octet_length(record).cast("long") + 1) * F.col("copies")
    return running_before(counted, keys, [record], size, "offset").withColumn("next_offset", F.col("offset") + size)


def line_at(masters: DataFrame, positions: DataFrame, keys: list[str], position: str = "position", record: str = "line", bin_bytes: int | None = None) -> DataFrame:
    """Each position with the record whose bytes, line end included, hold it: start offset and copy number.

    Masters are as master_offsets makes them; positions beyond the end give no row.  bin_bytes is of no effect.
    """
    places = masters.withColumn("__at", F.col("offset"))
    payload = [c for c in (record, "copies", "offset", "next_offset") if c in masters.columns]
    met = nearest(positions.withColumn("__at", F.col(position).cast("long")), places, keys, "__at", payload).drop("__at")
    met = met.filter((F.col("offset") <= F.col(position)) & (F.col(position) < F.col("next_offset")))
    return met.withColumn("__each", F.expr("(next_offset - offset) div copies")).withColumn("line_offset", F.expr(f"offset + ((`{position}` - offset) div __each) * __each")).drop("__each")


def line_starting(masters: DataFrame, positions: DataFrame, keys: list[str], position: str = "position", record: str = "line") -> DataFrame:
    """Each position with what is read from it up to the next line end, as a reader that jumps there sees it.

    That is the end of the record that holds the position, or all of it; "" at a line end.  Beyond the end there is
    no row.  `skipped` bytes of the record come before the position.
    """
    held = line_at(masters, positions, keys, position, record)
    skipped = F.col(position) - F.col("line_offset")
    raw = F.col(record).cast("binary")
    return held.withColumn("skipped", skipped).withColumn("rest", F.substring(raw, (skipped + 1).cast("int"), F.octet_length(raw)).cast("string"))


def lower_bound(probes: DataFrame, corpus: DataFrame, probe: str = "probe", record: str = "line") -> DataFrame:
    """Each distinct probe with the least record that isn't below it, null where all are."""
    asked = probes.select(F.col(probe).alias("value")).filter("value is not null").distinct()
    words = corpus.select(F.col(record).alias("value"), F.col(record).alias("bound")).distinct()
    return nearest(asked, words, [], "value", ["bound"], after=True).withColumnRenamed("value", probe)
