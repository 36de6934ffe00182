"""Range manifests: building, parsing, ordering and auditing what each file of a dataset spans.

A listing is (dataset, file, size_bytes); a manifest is (dataset, entry, file, lo, hi), entries from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions import strings as S
from tracewell.operators.stretches import running_before


# Texts of reports that callers know.
BAD_MANIFEST = "%s/lookup.txt has %d lines, expected a multiple of 3"
LOW_COVERAGE = "%s: lookup shards cover %d bytes but sorted master %s is %d bytes"
UNSORTED_MANIFEST = "%s/lookup.txt is not sorted at entry %d"
BAD_BOUNDARIES = " boundaries do not match lookup.txt"


def merged_ends(parts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, first_line, last_line, last_full_line, records, size_bytes) of files from their parts' ends.

    parts: first, last, last_full (null if all of its records are empty), records and size_bytes, in order of `order`.
    """
    full = F.col("last_full").isNotNull()
    return parts.groupBy(*keys).agg(
        F.min_by("first", order).alias("first_line"), F.max_by("last", order).alias("last_line"), F.max_by(F.when(full, F.col("last_full")), F.when(full, F.col(order))).alias("last_full_line"),
        F.sum("records").cast("long").alias("records"), F.sum("size_bytes").cast("long").alias("size_bytes"),
    )


def boundaries(records: DataFrame, keys: list[str], order: Column, record: str = "line") -> DataFrame:
    """First record, last record that isn't empty, and bytes of each file; files of empty records only are left out."""
    full = F.col(record) != ""
    return (
        records.groupBy(*keys)
        .agg(F.min_by(record, order).alias("first_line"), F.max_by(F.when(full, F.col(record)), F.when(full, order)).alias("last_line"), F.sum(S.record_bytes(record)).cast("long").alias("size_bytes"))
        .filter("last_line is not null")
    )


def build(records: DataFrame, keys: list[str], order: Column, record: str = "line") -> DataFrame:
    """lo and hi of each file: its first and last record by position, empty ones too."""
    return records.groupBy(*keys).agg(F.min_by(record, order).alias("lo"), F.max_by(record, order).alias("hi"), F.count("*").alias("records"), F.sum(S.record_bytes(record)).cast("long").alias("size_bytes"))


def ranges(records: DataFrame, keys: list[str], record: str = "line") -> DataFrame:
    """lo and hi of each file by value; these prune rightly whether or not the file is sorted."""
    return records.groupBy(*keys).agg(F.min(record).alias("lo"), F.max(record).alias("hi"), F.sum(S.record_bytes(record)).cast("long").alias("size_bytes"))


def render(manifest: DataFrame) -> DataFrame:
    """(dataset, content): three lines for each entry, in order.  A dataset's manifest has a line or three a file."""
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("entry", "file", "lo", "hi"))), lambda e: F.concat(e["file"], F.lit("\n"), e["lo"], F.lit("\n"), e["hi"], F.lit("\n"))), "")
    return manifest.groupBy("dataset").agg(lines.alias("content"))


def parse(raw: DataFrame) -> DataFrame:
    """Entries of (dataset, content) rows.  A manifest whose lines don't come in threes gives one row with an error."""
    lines = raw.select("dataset", F.transform(S.split_lines("content"), S.strip_cr).alias("lines"))
    n = F.size("lines")
    good = lines.filter(n % 3 == 0).select("dataset", F.explode(F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest((n / 3).cast("int") - 1, F.lit(0))), lambda i: F.struct(i.alias("entry"), F.get("lines", i * 3).alias("file"), F.get("lines", i * 3 + 1).alias("lo"), F.get("lines", i * 3 + 2).alias("hi"))))).alias("e"))
    bad = lines.filter(n % 3 != 0).select("dataset", F.format_string(BAD_MANIFEST, "dataset", n).alias("error"))
    return good.select("dataset", F.col("e.entry").alias("entry"), F.col("e.file").alias("file"), F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi"), F.lit(None).cast("string").alias("error")).unionByName(bad, allowMissingColumns=True)


def largest_masters(listing: DataFrame) -> DataFrame:
    """The largest sorted master of each dataset; of equal ones, the last by name."""
    best = F.max_by(F.struct("file", "size_bytes"), F.struct("size_bytes", "file")).alias("m")
    return listing.filter(S.is_master_name("file")).groupBy("dataset").agg(best).select("dataset", "m.file", "m.size_bytes")


def effective(masters: DataFrame, lookups: DataFrame) -> DataFrame:
    """Entries to search: a dataset's master in place of its lookup shards, wherever there is one.

    Both have dataset, file, lo, hi and size_bytes.
    """
    cols = ["dataset", "file", "lo", "hi", "size_bytes"]
    rest = lookups.join(masters.select("dataset").distinct(), "dataset", "left_anti")
    both = masters.select(F.lit("sorted").alias("kind"), *cols).unionByName(rest.select(F.lit("lookup").alias("kind"), *cols))
    return both.withColumn("full_path", S.join_path("dataset", "file"))


def ordered(index: DataFrame) -> DataFrame:
    """The index with its place by start, end and path."""
    return running_before(index, [], ["lo", "hi", "full_path"], F.lit(1), "place").withColumn("place", F.col("place") + 1)


def unsorted_index(manifest: DataFrame) -> DataFrame:
    """Datasets with an entry whose (lo, hi) is below the entry before it."""
    before = F.lag(F.struct("lo", "hi")).over(Window.partitionBy("dataset").orderBy("entry"))
    return manifest.withColumn("b", before).filter(F.col("b") > F.struct("lo", "hi")).select("dataset").distinct()


def unsorted_audit(manifest: DataFrame) -> DataFrame:
    """(dataset, entry_no): the first entry, from 1, whose lo alone is below that of the entry before."""
    before = F.lag("lo").over(Window.partitionBy("dataset").orderBy("entry"))
    return manifest.withColumn("b", before).filter(F.col("b") > F.col("lo")).groupBy("dataset").agg((F.min("entry") + 1).cast("long").alias("entry_no"))


def coverage(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """A row for each dataset with a master: bytes of its manifest's shards against the master's, and both verdicts.

    The index warns if shards cover something but less than the master, the audit also if they cover nothing.
    """
    found = manifest.join(listing, ["dataset", "file"], "left").groupBy("dataset").agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("shard_bytes"))
    m = largest_masters(listing).withColumnRenamed("file", "master_file").withColumnRenamed("size_bytes", "master_bytes")
    both = m.join(found, "dataset", "left").withColumn("shard_bytes", F.coalesce("shard_bytes", F.lit(0).cast("long")))
    less = F.col("shard_bytes") < F.col("master_bytes")
    said = F.format_string(LOW_COVERAGE, "dataset", "shard_bytes", "master_file", "master_bytes")
    return both.select("dataset", "shard_bytes", "master_file", "master_bytes", (less & (F.col("shard_bytes") > 0)).alias("index_warns"), less.alias("audit_warns"), F.when(less, said).alias("warning"))


def missing_files(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Entries whose file isn't there, as data rather than as a failure."""
    return manifest.join(listing.select("dataset", "file").distinct(), ["dataset", "file"], "left_anti").select("dataset", "file", S.join_path("dataset", "file").alias("full_path"))


def audit_samples(manifest: DataFrame, limit: int = 3) -> DataFrame:
    """The entries of each dataset that an audit reads."""
    n = manifest.groupBy("dataset").agg(F.count("*").alias("n"))
    return n.select("dataset", F.explode(S.sample_indices("n", limit)).alias("entry"))


def boundary_mismatches(manifest: DataFrame, actual: DataFrame) -> DataFrame:
    """Entries whose lo or hi isn't the file's first_line or last_line, or whose file has none."""
    met = manifest.join(actual, ["dataset", "file"], "left")
    return met.filter(~(F.col("lo").eqNullSafe(F.col("first_line")) & F.col("hi").eqNullSafe(F.col("last_line"))))


def audit_report(manifest: DataFrame, listing: DataFrame, limit: int = 3) -> DataFrame:
    """A row for each dataset: shards, sampled_files, sorted, shard_bytes and its master, if any."""
    counted = manifest.groupBy("dataset").agg(F.count("*").alias("shards"))
    counted = counted.withColumn("sampled_files", F.size(S.sample_indices("shards", limit)).cast("long"))
    sized = manifest.join(listing, ["dataset", "file"], "left").groupBy("dataset").agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("shard_bytes"))
    broken = unsorted_audit(manifest).select("dataset", F.lit(True).alias("broken"))
    m = largest_masters(listing).withColumnRenamed("file", "master_file").withColumnRenamed("size_bytes", "master_bytes")
    out = counted.join(sized, "dataset").join(broken, "dataset", "left").join(m, "dataset", "left")
    return out.select("dataset", "shards", "sampled_files", F.col("broken").isNull().alias("sorted"), "shard_bytes", "master_file", "master_bytes")


def status(index: DataFrame, manifest: DataFrame, listing: DataFrame, datasets: DataFrame) -> DataFrame:
    """One row: what the index holds and what is wrong with it; lists have a name a dataset or a file."""
    parts = {
        "missing_files": missing_files(index, listing).select("full_path"),
        "unsorted_datasets": unsorted_index(manifest).select("dataset"),
        "sorted_datasets": index.filter("kind = 'sorted'").select("dataset"),
        "coverage_warnings": coverage(manifest, listing).filter("index_warns").select("warning"),
        "dataset_count": datasets.select("dataset"),
        "shard_count": index.select("full_path"),
    }
    rows = None
    for name, df in parts.items():
        part = df.toDF("value").select(F.lit(name).alias("part"), "value")
        rows = part if rows is None else rows.unionByName(part)
    of = lambda name: F.when(F.col("part") == name, F.col("value"))
    lists = [F.sort_array(F.collect_set(of(name))).alias(name) for name in list(parts)[:4]]
    out = rows.agg(F.countDistinct(of("dataset_count")).alias("dataset_count"), F.count(of("shard_count")).alias("shard_count"), *lists)
    return out.select((F.size("missing_files") == 0).alias("ok"), "*")


def with_findings(report: DataFrame, errors: DataFrame, warnings: DataFrame) -> DataFrame:
    """A report's rows with lists of their errors and warnings; both are (dataset, e)."""
    none = F.array().cast("array<string>")
    for name, found in (("errors", errors), ("warnings", warnings)):
        listed = found.groupBy("dataset").agg(F.sort_array(F.collect_list("e")).alias(name))
        report = report.join(listed, "dataset", "left").withColumn(name, F.coalesce(name, none))
    return report


def audit_json(audited: DataFrame, at_ms: int) -> DataFrame:
    """(ok, json): an audit's rows as one JSON document, as callers know it; a row a dataset goes into it."""
    master = F.when(F.col("master_file").isNotNull(), F.struct(F.col("master_file").alias("file"), F.col("master_bytes").alias("sizeBytes")))
    row = F.struct("dataset", "shards", F.col("sampled_files").alias("sampledFiles"), "sorted", F.col("shard_bytes").alias("shardBytes"), master.alias("sortedMaster"))
    every = lambda c: F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("dataset", c))), lambda x: x[c]))
    whole = audited.agg(every("errors").alias("errors"), every("warnings").alias("warnings"), F.sort_array(F.collect_list(row)).alias("results"), F.count("*").alias("datasetCount"))
    ok = F.size("errors") == 0
    said = F.struct(ok.alias("ok"), S.iso_time(F.lit(at_ms)).alias("checkedAt"), "datasetCount", "errors", "warnings", "results")
    return whole.select(ok.alias("ok"), F.to_json(said).alias("json"))


def rebuild_report(rebuilt: DataFrame, at_ms: int) -> DataFrame:
    """One row: ok, rebuiltAt, datasetCount and results, from (dataset, shards)."""
    whole = rebuilt.agg(F.sort_array(F.collect_list(F.struct("dataset", "shards"))).alias("results"), F.count("*").alias("datasetCount"))
    return whole.select(F.lit(True).alias("ok"), S.iso_time(F.lit(at_ms)).alias("rebuiltAt"), "datasetCount", "results")
