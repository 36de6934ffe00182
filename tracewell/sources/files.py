"""Corpora as they lie in a store: folders of datasets with text files, read byte for byte.

Everything goes through Spark's and Hadoop's own readers, so a root may be in any store that Spark can open.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.functions import strings as S
from tracewell.operators import manifest as M
from tracewell.operators import sketch
from tracewell.plans.snapshot import Audits
from tracewell.session import durable, ship
from tracewell.sources import seek

MANIFEST = "lookup.txt"


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, file, path, size_bytes) of the files in each dataset's folder; contents aren't read."""
    fs, path = _folder(spark, root)
    rows = []
    for d in fs.listStatus(path):
        if d.isDirectory():
            rows += [(d.getPath().getName(), f.getPath().getName(), f.getPath().toString(), f.getLen()) for f in fs.listStatus(d.getPath()) if f.isFile()]
    return spark.createDataFrame(rows, "dataset string, file string, path string, size_bytes long")


def datasets(spark: SparkSession, root: str) -> DataFrame:
    """Every sub-folder of the root, empty ones too, by name."""
    fs, path = _folder(spark, root)
    return spark.createDataFrame([(d.getPath().getName(),) for d in fs.listStatus(path) if d.isDirectory()], "dataset string").orderBy("dataset")


def read_lines(spark: SparkSession, paths: str | list[str], *, number: bool = True) -> DataFrame:
    """(dataset, file, line) and, if asked for, line_no from 1 and the byte offset of each record.

    Only \\n ends a record; one carriage return before it is taken off after offsets are known; a final line end adds
    no record; bytes that aren't UTF-8 stay.  Records are numbered inside the block of a file that one task reads, and
    blocks are joined by their sums, so a file of any size is numbered in parallel.
    """
    raw = spark.read.option("lineSep", "\n").text(paths)
    raw = raw.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at") if number else F.lit(0).alias("at"))
    named = raw.withColumn("dataset", F.element_at(F.split("path", "/"), -2)).withColumn("file", F.element_at(F.split("path", "/"), -1))
    named = named.withColumns({c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))) for c in ("dataset", "file")})
    if not number:
        return named.select("dataset", "file", S.strip_cr("value").alias("line"))
    size = S.record_bytes("value")
    sums = named.groupBy("path", "block").agg(F.sum(size).alias("bytes"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("path", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("b0"), F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("l0"))
    inside = Window.partitionBy("path", "block").orderBy("at")
    placed = named.withColumn("l1", F.row_number().over(inside)).withColumn("b1", F.coalesce(F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return placed.join(begins, ["path", "block"]).select("dataset", "file", (F.col("l0") + F.col("l1")).cast("long").alias("line_no"), (F.col("b0") + F.col("b1")).cast("long").alias("offset"), S.strip_cr("value").alias("line"))


def file_facts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row for each file: first_line, last_line, last_full_line (the last that isn't empty), lo and hi by value,
    records, size_bytes and whether its records are in byte order.

    One pass: each task makes a few facts of each batch of a file that it reads, and only those are shuffled; lines
    are neither numbered nor sorted.  Files without a record have no row.
    """
    ship(spark)
    raw = spark.read.option("lineSep", "\n").text(paths)
    raw = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), S.strip_cr("value").cast("binary").alias("line"), S.record_bytes("value").alias("size"))
    fields = "path string, at struct<block: bigint, batch: int>, first binary, last binary, last_full binary, lo binary, hi binary, records bigint, size_bytes bigint, in_order boolean"

    def facts(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for number, b in enumerate(batches):
            if not b.num_rows:
                continue
            path, block, line, size = b.columns
            changes = pc.or_(pc.not_equal(path.slice(1), path.slice(0, b.num_rows - 1)), pc.not_equal(block.slice(1), block.slice(0, b.num_rows - 1)))
            cuts = [0, *(np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1).tolist(), b.num_rows]
            rows = []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                x, n = line.slice(a, z - a), z - a
                full = x.filter(pc.greater(pc.binary_length(x), 0))
                ends = pc.min_max(x)
                rows.append({
                    "path": path[a].as_py(), "at": {"block": block[a].as_py(), "batch": number}, "first": x[0].as_py(), "last": x[n - 1].as_py(), "last_full": full[-1].as_py() if len(full) else None,
                    "lo": ends["min"].as_py(), "hi": ends["max"].as_py(), "records": n, "size_bytes": pc.sum(size.slice(a, n)).as_py(), "in_order": n < 2 or pc.all(pc.less_equal(x.slice(0, n - 1), x.slice(1))).as_py(),
                })
            kinds = [("path", pa.string()), ("at", pa.struct([("block", pa.int64()), ("batch", pa.int32())])), *((c, pa.binary()) for c in ("first", "last", "last_full", "lo", "hi")), ("records", pa.int64()), ("size_bytes", pa.int64()), ("in_order", pa.bool_())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    parts = raw.mapInArrow(facts, fields)
    parts = parts.withColumns({c: F.col(c).cast("string") for c in ("first", "last", "last_full", "lo", "hi")})
    # a part's first record against the last of the part before it: parts are a row a batch, dealt by file
    before = F.lag("last").over(Window.partitionBy("path").orderBy("at"))
    parts = parts.withColumn("in_order", F.col("in_order") & (F.coalesce(before, F.col("first")) <= F.col("first")))
    ends = M.merged_ends(parts, ["path"], "at")
    spans = parts.groupBy("path").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.every("in_order").alias("in_order"))
    named = ends.join(spans, "path").withColumn("dataset", F.element_at(F.split("path", "/"), -2)).withColumn("file", F.element_at(F.split("path", "/"), -1))
    return named.withColumns({c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))) for c in ("dataset", "file")}).drop("path")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Entries of every dataset's manifest, with an error in place of entries where one can't be read."""
    files = listing(spark, root).filter(F.col("file") == MANIFEST)
    paths = [r["path"] for r in files.select("path").collect()]  # one a dataset
    if not paths:
        return M.parse(spark.createDataFrame([], "dataset string, content string"))
    raw = spark.read.format("binaryFile").load(paths)
    return M.parse(raw.select(F.url_decode(F.element_at(F.split("path", "/"), -2)).alias("dataset"), F.col("content").cast("string").alias("content")))


def write_manifests(manifest: DataFrame, root: str) -> None:
    """A lookup.txt in each dataset's folder, put in place once it is whole.

    What was there stays beside it as .lookup.txt.old until the new one is in place, so a crash leaves one of them.
    """
    spark = manifest.sparkSession
    fs, _ = _folder(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for r in M.render(manifest).toLocalIterator():  # a few lines a file of the corpus, a dataset at a time
        made, old, final = (path(f"{root}/{r['dataset']}/{name}") for name in (f".{MANIFEST}.new", f".{MANIFEST}.old", MANIFEST))
        out = fs.create(made, True)
        out.write(bytearray(r["content"].encode()))
        out.close()
        if fs.exists(final):
            fs.delete(old, False)
            fs.rename(final, old)
        if not fs.rename(made, final):
            raise OSError(f"cannot put {final} in place")
        fs.delete(old, False)


def rebuild(spark: SparkSession, root: str, only: list[str] | None = None) -> DataFrame:
    """New manifests for the datasets that have one (or for those of `only` that do); returns (dataset, shards)."""
    files = listing(spark, root)
    known = files.filter(F.col("file") == MANIFEST).select("dataset")
    if only:
        known = known.filter(F.col("dataset").isin(only))
    shards = files.join(known, "dataset", "left_semi").filter(S.is_shard_name("file", "dataset"))
    paths = [r["path"] for r in shards.select("path").collect()]
    if not paths:
        return known.select("dataset", F.lit(0).cast("long").alias("shards"))
    ends = file_facts(spark, paths).select("dataset", "file", F.col("first_line").alias("lo"), F.col("last_line").alias("hi"))
    entry = (F.row_number().over(Window.partitionBy("dataset").orderBy(S.natural_key("file"), "file")) - 1).cast("int")
    manifest = durable(ends.withColumn("entry", entry))
    write_manifests(manifest, root)
    return known.join(manifest.groupBy("dataset").agg(F.count("*").alias("shards")), "dataset", "left").select("dataset", F.coalesce("shards", F.lit(0)).cast("long").alias("shards"))


def rebuild_report(rebuilt: DataFrame, at_ms: int) -> DataFrame:
    """One row: ok, rebuiltAt, datasetCount and results, as callers know it."""
    return M.rebuild_report(rebuilt, at_ms)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def build_index(spark: SparkSession, root: str, *, scan: bool = True) -> DataFrame:
    """The effective index of a root: kind, dataset, file, lo, hi, size_bytes, full_path and place.

    lo and hi are the least and greatest record of each file, from a pass over the masters, and over the shards of
    datasets without one; so a file that isn't sorted loses no match.  With scan=False they are what manifests say, and
    the ends of masters, which are read by seeking; that is right for sorted files only, and `audit` tells which are.
    """
    files = listing(spark, root)
    best = M.largest_masters(files).join(files.select("dataset", "file", "path"), ["dataset", "file"])
    paths = [r["path"] for r in best.select("path").collect()]  # one a dataset
    lookups = read_manifests(spark, root).filter("error is null").join(files.select("dataset", "file", "path", "size_bytes"), ["dataset", "file"], "left")
    if scan:
        spans = "dataset string, file string, lo string, hi string"
        known = lambda paths: file_facts(spark, paths).select("dataset", "file", "lo", "hi") if paths else _empty(spark, spans)
        masters = best.drop("path").join(known(paths), ["dataset", "file"])
        shards = lookups.join(masters.select("dataset"), "dataset", "left_anti").filter("path is not null")
        spans = known([r["path"] for r in shards.select("path").distinct().collect()])
        # a missing file stays in the index with what its manifest says
        lookups = lookups.withColumnsRenamed({"lo": "said_lo", "hi": "said_hi"}).join(spans, ["dataset", "file"], "left").withColumns({c: F.coalesce(c, f"said_{c}") for c in ("lo", "hi")})
    else:
        ends = [(path, bytearray(a), bytearray(z)) for path, a, z, _ in seek.boundaries(spark, paths) if a is not None]
        ends = spark.createDataFrame(ends, "path string, lo binary, hi binary").withColumns({c: F.col(c).cast("string") for c in ("lo", "hi")})
        masters = best.join(ends, "path").drop("path")
    return M.ordered(M.effective(masters, lookups))


def status(spark: SparkSession, root: str, audits: Audits | None = None) -> DataFrame:
    """One row: the index's status, and the outcome of the latest audit as JSON, null before the first."""
    files = listing(spark, root)
    out = M.status(build_index(spark, root), read_manifests(spark, root).filter("error is null"), files, datasets(spark, root))
    latest = None if audits is None or audits.latest is None else json.dumps(audits.latest, ensure_ascii=False)
    return out.withColumn("audit", F.lit(latest).cast("string"))


def audit(spark: SparkSession, root: str, limit: int = 3) -> DataFrame:
    """A row for each dataset with a manifest: the report's columns, and errors and warnings as lists.

    Sampled files are read whole and compared with their entries, and so is the order of the dataset's master; a
    manifest without entries is a row like any other.
    """
    files, manifest = listing(spark, root), read_manifests(spark, root)
    good = manifest.filter("error is null")
    sampled = good.join(M.audit_samples(good, limit), ["dataset", "entry"], "left_semi")
    best = M.largest_masters(files).select("dataset", "file")
    read = sampled.select("dataset", "file").unionByName(best).join(files, ["dataset", "file"])
    paths = [r["path"] for r in read.select("path").distinct().collect()]  # at most limit + 2 a dataset
    none = "dataset string, file string, first_line string, last_line string, in_order boolean"
    facts = durable(file_facts(spark, paths).select("dataset", "file", "first_line", "last_line", "in_order")) if paths else _empty(spark, none)
    said = lambda df, text: df.select("dataset", text.alias("e"))
    errors = said(manifest.filter("error is not null"), F.col("error"))
    errors = errors.unionByName(said(M.missing_files(good, files), F.concat(F.lit("no such file: "), F.col("full_path"))))
    errors = errors.unionByName(said(M.boundary_mismatches(sampled, facts), F.concat(S.join_path("dataset", "file"), F.lit(M.BAD_BOUNDARIES))))
    warnings = said(M.unsorted_audit(good), F.format_string(M.UNSORTED_MANIFEST, "dataset", "entry_no")).unionByName(said(M.coverage(good, files).filter("audit_warns"), F.col("warning")))
    warnings = warnings.unionByName(said(best.join(facts, ["dataset", "file"]).filter("not in_order"), F.concat(S.join_path("dataset", "file"), F.lit(" is not in byte order"))))
    out = files.filter(F.col("file") == MANIFEST).select("dataset").join(M.audit_report(good, files, limit), "dataset", "left")
    out = M.with_findings(out, errors, warnings).withColumns({"shards": F.coalesce("shards", F.lit(0).cast("long")), "sampled_files": F.coalesce("sampled_files", F.lit(0).cast("long")), "shard_bytes": F.coalesce("shard_bytes", F.lit(0).cast("long")), "sorted": F.coalesce("sorted", F.lit(True))})
    return out.withColumn("ok", F.size("errors") == 0)


def audit_outcome(audited: DataFrame, at_ms: int) -> tuple[str, int]:
    """The JSON of an audit and the exit code that callers know: 1 if there is any error."""
    row = M.audit_json(audited, at_ms).first()
    return row["json"], 0 if row["ok"] else 1


def write_filters(spark: SparkSession, paths: list[str], folder: str, n: int = 15_000_000, fpp: float = 0.01) -> None:
    """A Bloom filter for each file, in a table of (dataset, file, bloom, records) under folder."""
    lines = read_lines(spark, paths, number=False)
    sketch.per_file(lines, ["dataset", "file"], "line", n, fpp).write.mode("overwrite").parquet(folder)


def text_files(spark: SparkSession, root: str) -> list[str]:
    """The .txt files that lie in the root itself, not in datasets."""
    fs, path = _folder(spark, root)
    return sorted(f.getPath().toString() for f in fs.listStatus(path) if f.isFile() and f.getPath().getName().endswith(".txt"))
