"""Every query of the engine's own operators, with the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.functions import strings as S
from tracewell.operators import kanon, membership, sketch
from tracewell.operators import manifest as M
from tracewell.operators.stretches import running_before
from tracewell.plans import domain as D
from tracewell.session import durable, shared_folder
from tracewell.streaming import lookups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _views(sql: str) -> str:
    """The definitions that a query needs, in front of it."""
    found = {m[1]: m[0] for m in re.finditer(r"^(\w+) AS \((?:.|\n)*?\)(?=,\n\w+ AS \(|\n*\Z)", D.SQL.strip(), re.M)}
    need: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in found.items():
            if name not in need and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need.add(name)
                todo.append(body)
    return ("WITH " + ",\n".join(b for n, b in found.items() if n in need) + "\n" if need else "") + sql.strip()


def query(sql: str) -> Callable:
    """Register a function as the query of its name, with its SQL."""

    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = _views(sql)
        return f

    return keep


@query("SELECT probe, probe IN (SELECT line FROM words) AS hit FROM probes")
def exact_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.membership(D.probes(spark, sf_dir), D.words(spark, sf_dir))


@query("SELECT probe FROM probes WHERE probe NOT IN (SELECT line FROM words)")
def not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.not_found(D.probes(spark, sf_dir), D.words(spark, sf_dir))


@query("""
SELECT probe FROM probes WHERE probe NOT IN (SELECT line FROM words)
AND probe IN (SELECT substr(line, 1, n) FROM (SELECT DISTINCT line FROM words) w, (SELECT DISTINCT length(probe) AS n FROM probes) l WHERE length(line) > n)
""")
def no_prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.proper_prefixes(D.probes(spark, sf_dir), D.words(spark, sf_dir))


def _word_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short-named datasets have a sorted master of their words, the others shards by first character.

    The words are read once: a master spans what its dataset's shards span together.
    """
    ranges = D.range_manifest(spark, sf_dir)
    short = ranges.filter("octet_length(dataset) = 4").groupBy("dataset")
    masters = short.agg(F.concat(F.first("dataset"), F.lit("_sorted.txt")).alias("file"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("size_bytes").cast("long").alias("size_bytes"))
    return M.effective(masters, ranges)


@query("SELECT probe, kind, dataset, file FROM probes JOIN index_ ON probe BETWEEN lo AND hi")
def candidate_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = durable(_word_index(spark, sf_dir))  # a row a file; read for the bins' bounds and for the join
    return membership.candidates(D.probes(spark, sf_dir), index).select("probe", "kind", "dataset", "file")


@query("""
SELECT l.dataset, l.file, l.line_no, md5(l.line) AS probe_id FROM
(SELECT *, row_number() OVER (PARTITION BY dataset, file ORDER BY doc_id, pos) AS line_no FROM lines) l JOIN line_probes p ON l.line = p.probe
""")
def exact_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are numbered, a row each, and only hits look up where their document begins."""
    parts = D.line_ends(spark, sf_dir).select("dataset", "file", "doc_id", "records")
    begins = running_before(parts, ["dataset", "file"], ["doc_id"], F.col("records"), "before").select("dataset", "file", "doc_id", "before")
    found = membership.locations(D.line_probes(spark, sf_dir), D.lines(spark, sf_dir), ["dataset", "file", "doc_id", "pos"])
    found = found.join(begins, ["dataset", "file", "doc_id"]).withColumn("line_no", F.col("before") + F.col("pos") + 1)
    return found.select("dataset", "file", "line_no", F.md5(F.col("probe").cast("binary")).alias("probe_id"))


@query('SELECT dataset, md5(line) AS probe_id, "offset" FROM offsets JOIN line_probes ON line = probe')
def first_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    masters = membership.master_offsets(D.lines(spark, sf_dir), ["dataset"])
    found = membership.locations(D.line_probes(spark, sf_dir), masters, ["dataset", "offset"])
    return found.select("dataset", F.md5(F.col("probe").cast("binary")).alias("probe_id"), "offset")


@query("SELECT probe, line AS bound FROM probes ASOF LEFT JOIN (SELECT DISTINCT line FROM words) ON probe <= line")
def lower_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.lower_bound(D.probes(spark, sf_dir), D.words(spark, sf_dir))


def _positions(spark: SparkSession, sf_dir: str, step: int) -> DataFrame:
    """(dataset, position): each step-th byte of each dataset; blocks of them are dealt out before they are spelt."""
    total = D.line_ends(spark, sf_dir).groupBy("dataset").agg(F.sum("size_bytes").cast("long").alias("s"))
    zero, block = F.lit(0).cast("long"), F.lit(step * 4096).cast("long")
    blocks = total.select("dataset", "s", F.explode(F.sequence(zero, F.col("s") - 1, block)).alias("b"))
    return blocks.select("dataset", F.explode(F.sequence(F.col("b"), F.least(F.col("b") + block, F.col("s")) - 1, F.lit(step).cast("long"))).alias("position"))


@query("""
SELECT o.dataset, p.position, CAST(o."offset" + ((p.position - o."offset") // (strlen(o.line) + 1)) * (strlen(o.line) + 1) AS BIGINT) AS line_offset
FROM offsets o JOIN (SELECT dataset, CAST(unnest(range(0, CAST(s AS BIGINT), 1009)) AS BIGINT) AS position FROM whole) p
ON o.dataset = p.dataset AND o."offset" <= p.position AND p.position < o."offset" + (strlen(o.line) + 1) * o.n
""")
def line_at_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.lines(spark, sf_dir)
    found = membership.line_at(membership.master_offsets(rows, ["dataset"]), _positions(spark, sf_dir, 1009), ["dataset"])
    return found.select("dataset", "position", "line_offset")


@query("""
SELECT o.dataset, p.position, md5(encode(o.line)[CAST((p.position - o."offset") % (strlen(o.line) + 1) AS BIGINT) + 1:]) AS rest_id, CAST(strlen(o.line) - (p.position - o."offset") % (strlen(o.line) + 1) AS BIGINT) AS rest_bytes
FROM offsets o JOIN (SELECT dataset, CAST(unnest(range(0, CAST(s AS BIGINT), 2003)) AS BIGINT) AS position FROM whole) p
ON o.dataset = p.dataset AND o."offset" <= p.position AND p.position < o."offset" + (strlen(o.line) + 1) * o.n
""")
def line_starting_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader that jumps to each 2003rd byte of a sorted master reads up to the line's end."""
    found = membership.line_starting(membership.master_offsets(D.lines(spark, sf_dir), ["dataset"]), _positions(spark, sf_dir, 2003), ["dataset"])
    return found.select("dataset", "position", F.md5(F.col("rest").cast("binary")).alias("rest_id"), F.octet_length("rest").cast("long").alias("rest_bytes"))


@query("""
SELECT dataset, file, arg_min(line, (doc_id, pos)) AS first_line, arg_max(line, (doc_id, pos)) FILTER (line <> '') AS last_line, CAST(sum(strlen(line) + 1) AS BIGINT) AS size_bytes
FROM lines GROUP BY dataset, file HAVING bool_or(line <> '')
""")
def file_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = M.merged_ends(D.line_ends(spark, sf_dir), ["dataset", "file"], "doc_id").filter("last_full_line is not null")
    return ends.select("dataset", "file", "first_line", F.col("last_full_line").alias("last_line"), "size_bytes")


@query("SELECT dataset, file, lo, hi, records, size_bytes, entry FROM positional_manifest")
def manifest_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.positional_manifest(spark, sf_dir)


@query("""
SELECT dataset, CAST(i AS INTEGER) AS entry, x[3 * i + 1] AS file, x[3 * i + 2] AS lo, x[3 * i + 3] AS hi FROM (
  SELECT dataset, x, unnest(range(len(x) // 3)) AS i FROM (SELECT dataset, flatten(list([file, lo, hi] ORDER BY entry)) AS x FROM positional_manifest GROUP BY dataset))
""")
def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.parse(M.render(D.positional_manifest(spark, sf_dir))).select("dataset", "entry", "file", "lo", "hi")


@query("SELECT kind, dataset, file, lo, hi, size_bytes, full_path FROM index_")
def effective_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_index(spark, sf_dir).select("kind", "dataset", "file", "lo", "hi", "size_bytes", "full_path")


@query("SELECT full_path, row_number() OVER (ORDER BY lo, hi, full_path) AS place FROM index_")
def index_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.ordered(_word_index(spark, sf_dir)).select("full_path", "place")


@query("SELECT dataset FROM unsorted_lohi")
def unsorted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.unsorted_index(D.positional_manifest(spark, sf_dir))


@query("SELECT dataset, entry_no FROM unsorted_lo")
def unsorted_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.unsorted_audit(D.positional_manifest(spark, sf_dir))


@query("SELECT dataset, file, size_bytes FROM masters")
def largest_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.largest_masters(D.named_listing(spark, sf_dir))


_COVERAGE = """
SELECT m.dataset, b.shard_bytes, m.file AS master_file, m.size_bytes AS master_bytes, b.shard_bytes > 0 AND b.shard_bytes < m.size_bytes AS index_warns, b.shard_bytes < m.size_bytes AS audit_warns,
CASE WHEN b.shard_bytes < m.size_bytes THEN m.dataset || ': lookup shards cover ' || b.shard_bytes || ' bytes but sorted master ' || m.file || ' is ' || m.size_bytes || ' bytes' END AS warning
FROM masters m JOIN (SELECT dataset, CAST(sum(size_bytes) AS BIGINT) AS shard_bytes FROM positional_manifest GROUP BY dataset) b USING (dataset)
"""


@query(_COVERAGE)
def coverage_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.coverage(D.positional_manifest(spark, sf_dir).drop("size_bytes"), D.named_listing(spark, sf_dir))


@query("SELECT dataset, file, dataset || '/' || file AS full_path FROM positional_manifest WHERE size_bytes < 2000")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.missing_files(D.positional_manifest(spark, sf_dir), D.named_listing(spark, sf_dir).filter("size_bytes >= 2000"))


@query("""
SELECT dataset, unnest(list_distinct([0, greatest(0, n - 1)] || list_transform(list_filter([1, 2], lambda i: i < least(n - 1, 3)), lambda i: (i * n) // 4))) AS entry
FROM (SELECT dataset, count(*) AS n FROM lines GROUP BY dataset)
""")
def audit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.audit_samples(D.lines(spark, sf_dir))


@query("""
SELECT p.dataset, p.file, r.lo, r.hi, p.lo AS first_line, p.hi AS last_line FROM positional_manifest p
JOIN (SELECT dataset, file, min(line) AS lo, max(line) AS hi FROM lines GROUP BY dataset, file) r ON p.dataset = r.dataset AND p.file = r.file WHERE r.lo <> p.lo OR r.hi <> p.hi
""")
def audit_boundary_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = M.ranges(D.lines(spark, sf_dir), ["dataset", "file"])
    ends = M.merged_ends(D.line_ends(spark, sf_dir), ["dataset", "file"], "doc_id")
    return M.boundary_mismatches(ranges.select("dataset", "file", "lo", "hi"), ends.select("dataset", "file", "first_line", "last_line"))


@query("""
SELECT p.dataset, count(*) AS shards, CAST(len(list_distinct([0, greatest(0, count(*) - 1)] || list_transform(list_filter([1, 2], lambda i: i < least(count(*) - 1, 3)), lambda i: (i * count(*)) // 4))) AS BIGINT) AS sampled_files,
p.dataset NOT IN (SELECT dataset FROM unsorted_lo) AS sorted, CAST(sum(p.size_bytes) AS BIGINT) AS shard_bytes, any_value(m.file) AS master_file, any_value(m.size_bytes) AS master_bytes
FROM positional_manifest p LEFT JOIN masters m USING (dataset) GROUP BY p.dataset
""")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.audit_report(D.positional_manifest(spark, sf_dir).drop("size_bytes"), D.named_listing(spark, sf_dir))


@query("""
SELECT (SELECT count(*) FROM there_index WHERE (dataset, file) NOT IN (SELECT (dataset, file) FROM there)) = 0 AS ok, (SELECT count(DISTINCT source) FROM documents) AS dataset_count, (SELECT count(*) FROM there_index) AS shard_count,
(SELECT array_to_string(coalesce(list(dataset || '/' || file ORDER BY dataset || '/' || file), []), ',') FROM there_index WHERE (dataset, file) NOT IN (SELECT (dataset, file) FROM there)) AS missing_files,
(SELECT array_to_string(coalesce(list(dataset ORDER BY dataset), []), ',') FROM unsorted_lohi) AS unsorted_datasets,
(SELECT array_to_string(coalesce(list(dataset ORDER BY dataset), []), ',') FROM there_index WHERE kind = 'sorted') AS sorted_datasets,
(SELECT array_to_string(coalesce(list(w ORDER BY w), []), ',') FROM (
  SELECT m.dataset || ': lookup shards cover ' || b.s || ' bytes but sorted master ' || m.file || ' is ' || m.size_bytes || ' bytes' AS w
  FROM there_masters m JOIN (SELECT dataset, CAST(sum(size_bytes) AS BIGINT) AS s FROM positional_manifest WHERE size_bytes >= 2000 GROUP BY dataset) b ON m.dataset = b.dataset WHERE b.s < m.size_bytes)) AS coverage_warnings
""")
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of fewer than 2000 bytes are missing; short-named datasets have a sorted master."""
    manifest, there = D.positional_manifest(spark, sf_dir), D.named_listing(spark, sf_dir).filter("size_bytes >= 2000")
    masters = M.largest_masters(there).filter("octet_length(dataset) = 4").selectExpr("*", "cast(null as string) AS lo", "cast(null as string) AS hi")
    index = M.effective(masters, manifest)
    out = M.status(index, manifest.drop("size_bytes"), there, D.table(spark, sf_dir, "documents").select(F.col("source").alias("dataset")))
    return out.withColumns({c: F.array_join(c, ",") for c in ("missing_files", "unsorted_datasets", "sorted_datasets", "coverage_warnings")})


@query(f"""
SELECT (SELECT count(*) FROM findings WHERE error) = 0 AS ok, '1970-01-01T00:00:00.000Z' AS checked_at, (SELECT count(DISTINCT dataset) FROM positional_manifest) AS dataset_count,
(SELECT array_to_string(coalesce(list(e ORDER BY dataset, e), []), ',') FROM findings WHERE error) AS errors,
(SELECT array_to_string(coalesce(list(e ORDER BY dataset, e), []), ',') FROM (SELECT dataset, e FROM findings WHERE NOT error UNION ALL SELECT dataset, warning FROM ({_COVERAGE}) WHERE audit_warns)) AS warnings,
p.dataset, count(*) AS shards, p.dataset NOT IN (SELECT dataset FROM unsorted_lo) AS sorted, CAST(sum(p.size_bytes) AS BIGINT) AS shard_bytes, any_value(m.file) AS master_file, any_value(m.size_bytes) AS master_bytes
FROM positional_manifest p LEFT JOIN masters m USING (dataset) GROUP BY p.dataset
""")
def audit_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's document, read back; files of fewer than 2000 bytes count as missing."""
    manifest, files = D.positional_manifest(spark, sf_dir).drop("size_bytes"), D.named_listing(spark, sf_dir)
    errors = M.missing_files(manifest, files.filter("size_bytes >= 2000")).select("dataset", F.concat(F.lit("no such file: "), "full_path").alias("e"))
    warnings = M.unsorted_audit(manifest).select("dataset", F.format_string(M.UNSORTED_MANIFEST, "dataset", "entry_no").alias("e")).unionByName(M.coverage(manifest, files).filter("audit_warns").select("dataset", F.col("warning").alias("e")))
    said = M.audit_json(M.with_findings(M.audit_report(manifest, files), errors, warnings), 0)
    kind = "ok boolean, checkedAt string, datasetCount bigint, errors array<string>, warnings array<string>, results array<struct<dataset: string, shards: bigint, sorted: boolean, shardBytes: bigint, sortedMaster: struct<file: string, sizeBytes: bigint>>>"
    read = said.select(F.from_json("json", kind).alias("j")).select("j.*").select("*", F.explode("results").alias("r"))
    joined = [F.array_join(c, ",").alias(c) for c in ("errors", "warnings")]
    return read.select("ok", F.col("checkedAt").alias("checked_at"), F.col("datasetCount").alias("dataset_count"), *joined, "r.dataset", "r.shards", "r.sorted", F.col("r.shardBytes").alias("shard_bytes"), F.col("r.sortedMaster.file").alias("master_file"), F.col("r.sortedMaster.sizeBytes").alias("master_bytes"))


@query("""
SELECT true AS ok, '1970-01-01T00:00:00.000Z' AS rebuilt_at, (SELECT count(DISTINCT dataset) FROM positional_manifest) AS dataset_count, dataset, count(*) AS shards FROM positional_manifest GROUP BY dataset
""")
def rebuild_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = D.positional_manifest(spark, sf_dir).groupBy("dataset").agg(F.count("*").alias("shards"))
    report = M.rebuild_report(rebuilt, 0).select("*", F.explode("results").alias("r"))
    return report.select("ok", F.col("rebuiltAt").alias("rebuilt_at"), F.col("datasetCount").alias("dataset_count"), "r.dataset", "r.shards")


@query("""
SELECT id, 0 AS step, CAST(NULL AS BOOLEAN) AS ok, CAST(NULL AS VARCHAR) AS file, CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS BIGINT) AS line, CAST(NULL AS VARCHAR) AS source,
  'No candidate shard matched the password range.' AS debug, CAST(NULL AS VARCHAR) AS candidates, CAST(NULL AS BOOLEAN) AS done, CAST(NULL AS INTEGER) AS exit_code
FROM (SELECT md5(probe) AS id FROM probes) WHERE id NOT IN (SELECT id FROM told)
UNION ALL SELECT id, 1, false, full_path, "offset", NULL, 'sorted', NULL, NULL, NULL, NULL FROM sorted_hits
UNION ALL SELECT id, 2, NULL, NULL, NULL, NULL, NULL, 'searching ' || n || ' shards', candidates, NULL, NULL FROM told WHERE scans
UNION ALL SELECT id, 3, false, full_path, NULL, line, NULL, NULL, NULL, NULL, NULL FROM lookup_hits
UNION ALL SELECT md5(probe), 5, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true,
  CASE WHEN md5(probe) IN (SELECT id FROM told WHERE scans) THEN CASE WHEN md5(probe) IN (SELECT id FROM lookup_hits) THEN 0 ELSE 1 END END FROM probes
""")
def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that the client of each probe is told, as read back from the events' JSON."""
    index = durable(_word_index(spark, sf_dir))
    probes = D.probes(spark, sf_dir).withColumn("id", F.md5(F.col("probe").cast("binary")))
    met = durable(membership.candidates(probes, index).select("id", "probe", "kind", "dataset", "file", "full_path"))
    counted = durable(D.words(spark, sf_dir).groupBy("dataset", "file", "line").agg(F.count("*").alias("n")).join(D.probes(spark, sf_dir).withColumnRenamed("probe", "line").withColumn("asked", F.lit(True)), "line", "left"))
    whole = counted.groupBy("dataset", "line").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    offsets = running_before(whole, ["dataset"], ["line"], S.record_bytes("line") * F.col("n"), "offset").filter("asked")
    lines = running_before(counted, ["dataset", "file"], ["line"], F.col("n"), "before").filter("asked").withColumn("line_no", F.col("before") + 1)
    hit = lambda kind, places, on: met.filter(F.col("kind") == kind).join(places.withColumnRenamed("line", "probe"), [*on, "probe"])
    sorted_hits = hit("sorted", offsets.select("dataset", "line", "offset"), ["dataset"]).select("id", "full_path", "offset")
    lookup_hits = hit("lookup", lines.select("dataset", "file", "line", "line_no"), ["dataset", "file"]).select("id", "full_path", F.col("line_no").alias("line"))
    told = lookups.scan_events(probes, met, sorted_hits, lookup_hits)
    kind = "struct<type: string, " + ", ".join(f"{k}: {t}" for k, t in lookups.EVENT_FIELDS.items()) + ">"
    e = told.select("step", F.from_json(lookups.to_message(F.col("event")), kind).alias("e")).select("step", "e.*")
    listed = F.array_join(F.transform("candidates", lambda c: F.concat_ws("|", c["dataset"], c["file"], c["kind"])), ",").alias("candidates")
    return e.select("id", "step", "ok", "file", "offset", "line", "source", "debug", listed, "done", F.col("exitCode").alias("exit_code"))


@query("SELECT DISTINCT probe, dataset, file FROM probes JOIN words ON probe = line")
def bloom_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold a probe: those that their filters pass, confirmed by the records."""
    words = D.words(spark, sf_dir)
    filters = durable(sketch.per_file(words, ["dataset", "file"], n=20_000))
    passed = sketch.files_that_may_hold(filters, D.probes(spark, sf_dir), ["dataset", "file"])
    records = words.select("dataset", "file", F.col("line").alias("probe"))
    return records.join(passed, ["dataset", "file", "probe"], "left_semi").distinct().select("probe", "dataset", "file")


@query("""
SELECT dataset, file FROM file_names WHERE file <> 'lookup.txt' AND file NOT LIKE '%.zip' AND file NOT LIKE '%.7z' AND file <> dataset || '.txt' AND file <> dataset || '_sorted.txt'
""")
def shard_file_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.file_names(spark, sf_dir).filter(S.is_shard_name("file", "dataset"))


@query("""
SELECT dataset, file, row_number() OVER (PARTITION BY dataset ORDER BY list_aggregate(list_transform(regexp_extract_all(file, '\\d+|\\D+'), lambda p: CASE WHEN regexp_matches(p, '^\\d') THEN lpad(p, 20, '0') ELSE p END), 'string_agg', ''), file) AS place
FROM file_names
""")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("dataset").orderBy(S.natural_key("file"), "file")
    return D.file_names(spark, sf_dir).withColumn("place", F.row_number().over(order).cast("long"))


@query("SELECT DISTINCT source AS dataset FROM documents")
def list_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "documents").select(F.col("source").alias("dataset")).distinct()


@query("SELECT h[1:5] AS prefix, h[6:] AS suffix, n AS count FROM counted")
def kanon_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kanon.range_table(D.words(spark, sf_dir))


@query("SELECT probe, coalesce(n, 0) AS count FROM probes LEFT JOIN counted ON h = upper(sha1(probe))")
def kanon_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kanon.counts(D.probes(spark, sf_dir), kanon.range_table(D.words(spark, sf_dir)))


@query(f"""
SELECT probe, CASE WHEN coalesce(probe, '') = '' THEN false ELSE NOT (c > 0 OR hit) END AS ok, CASE WHEN coalesce(probe, '') <> '' AND (c > 0 OR hit) THEN c END AS count,
CASE WHEN coalesce(probe, '') = '' THEN '{kanon.NO_PROBE}' END AS reason
FROM (SELECT p.probe, coalesce(n, 0) AS c, p.probe IS NOT NULL AND p.probe IN (SELECT line FROM words WHERE dataset <> 'src2') AS hit
      FROM (SELECT probe FROM probes UNION ALL SELECT '' UNION ALL SELECT NULL) p LEFT JOIN (SELECT upper(sha1(line)) AS h, count(*) AS n FROM words WHERE dataset = 'src2' GROUP BY line) ON h = upper(sha1(p.probe)))
""")
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset stands for the remote service, the others for local files."""
    words = D.words(spark, sf_dir)
    probes = D.probes(spark, sf_dir).unionByName(spark.createDataFrame([("",), (None,)], "probe string"))
    counted = kanon.counts(probes, kanon.range_table(words.filter("dataset = 'src2'")))
    return kanon.verdicts(membership.membership(counted, words.filter("dataset <> 'src2'"))).select("probe", "ok", "count", "reason")


_PASSWORD = "CASE WHEN json_type(CASE WHEN json_valid({0}) THEN {0} END, '$.password') = 'VARCHAR' THEN CASE WHEN json_valid({0}) THEN {0} END ->> '$.password' ELSE {0} END"


@query(f"""
SELECT id, {_PASSWORD.format("message")} AS probe FROM (
  SELECT 'c' || conv_id || '.' || turn AS id, text AS message FROM conversations
  UNION ALL SELECT 'e' || event_id, props FROM events
  UNION ALL SELECT 'w' || event_id, CASE WHEN event_id % 3 = 0 THEN '{{"password":"' || event_type || '"}}' WHEN event_id % 3 = 1 THEN '{{"password":' || event_id || '}}' ELSE '"' || event_type || '"' END FROM events)
""")
def parse_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = D.table(spark, sf_dir, "events")
    k = F.col("event_id") % 3
    made = F.when(k == 0, F.concat(F.lit('{"password":"'), "event_type", F.lit('"}'))).when(k == 1, F.concat(F.lit('{"password":'), F.col("event_id").cast("string"), F.lit("}"))).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    raw = D.table(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("."), F.col("turn").cast("string")).alias("id"), F.col("text").alias("value"))
    raw = raw.unionByName(e.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), F.col("props").alias("value")))
    raw = raw.unionByName(e.select(F.concat(F.lit("w"), F.col("event_id").cast("string")).alias("id"), made.alias("value")))
    return lookups.requests(raw)


@query("""
SELECT 'update' AS type, md5(line) AS id, false AS ok, dataset || '/' || dataset || '_sorted.txt' AS file, "offset", 'sorted' AS source FROM offsets JOIN line_probes ON line = probe
""")
def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of hits in sorted masters, as read back from their JSON."""
    masters = membership.master_offsets(D.lines(spark, sf_dir), ["dataset"])
    found = membership.locations(D.line_probes(spark, sf_dir), masters, ["dataset", "offset"])
    made = lookups.event("update", id=F.md5(F.col("probe").cast("binary")), ok=F.lit(False), file=F.concat("dataset", F.lit("/"), "dataset", F.lit("_sorted.txt")), offset=F.col("offset"), source=F.lit("sorted"))
    kind = "struct<type: string, " + ", ".join(f"{k}: {t}" for k, t in lookups.EVENT_FIELDS.items()) + ">"
    return found.select(F.from_json(lookups.to_message(made), kind).alias("e")).select("e.type", "e.id", "e.ok", "e.file", "e.offset", "e.source")


@query("SELECT probe FROM probes WHERE probe IN (SELECT line FROM words)")
def bloom_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.prefiltered_hits(D.probes(spark, sf_dir), D.words(spark, sf_dir))


@query("SELECT md5(probe) AS id, dataset FROM probes JOIN (SELECT DISTINCT dataset, line FROM words) ON probe = line")
def stream_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    D.probes(spark, sf_dir).select(F.md5(F.col("probe").cast("binary")).alias("id"), "probe").write.parquet(f"{folder}/probes")
    stream = spark.readStream.schema("id string, probe string").parquet(f"{folder}/probes")
    return lookups.run_available(lookups.stream_hits(stream, lookups.prepared(D.words(spark, sf_dir), ["dataset"]), ["dataset"]), folder)
