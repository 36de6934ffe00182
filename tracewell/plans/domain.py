"""The driver's tables read as a corpus of records, with manifests and listings over it.

dataset = source of a document, file = a name made from its language, record = a line or a word of its text.  Each SQL
below defines a view that holds the same rows as the function of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import strings as S
from tracewell.operators import manifest as M


def order() -> Column:
    """Where a line lies in its file."""
    return F.struct("doc_id", "pos")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, file, doc_id, pos, line)"""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    return d.select(F.col("source").alias("dataset"), F.concat("lang", F.lit(".txt")).alias("file"), "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, file, doc_id, first, last, last_full, records, size_bytes): what each document adds to its file.

    A row a document, without the lines between.
    """
    d = table(spark, sf_dir, "documents").filter("text is not null").withColumn("ls", F.split("text", "\n", -1))
    full = F.filter("ls", lambda x: x != "")
    return d.select(F.col("source").alias("dataset"), F.concat("lang", F.lit(".txt")).alias("file"), "doc_id", F.get("ls", F.lit(0)).alias("first"), F.get("ls", F.size("ls") - 1).alias("last"), F.get(full, F.size(full) - 1).alias("last_full"), F.size("ls").cast("long").alias("records"), S.record_bytes("text").alias("size_bytes"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, file, line): every word as a record; files are cut by the word's first character."""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    w = d.select(F.col("source").alias("dataset"), F.explode(F.split("text", "[ \n]", -1)).alias("line")).filter("line <> ''")
    return w.select("dataset", F.concat("dataset", F.lit("_"), F.hex(F.substring("line", 1, 1)), F.lit(".txt")).alias("file"), "line")


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(probe): distinct words of the benchmark."""
    b = table(spark, sf_dir, "benchmark").filter("text is not null")
    return b.select(F.explode(F.split("text", "[ \n]", -1)).alias("probe")).filter("probe <> ''").distinct()


def line_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(probe): distinct lines of one dataset, looked up in all."""
    return lines(spark, sf_dir).filter("dataset = 'src1'").select(F.col("line").alias("probe")).distinct()


def range_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, file, lo, hi, size_bytes) of the words' files."""
    return M.ranges(words(spark, sf_dir), ["dataset", "file"])


def positional_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, file, lo, hi, records, size_bytes, entry) of the lines' files, entries by file name."""
    built = M.merged_ends(line_ends(spark, sf_dir), ["dataset", "file"], "doc_id").select("dataset", "file", F.col("first_line").alias("lo"), F.col("last_line").alias("hi"), "records", "size_bytes")
    from pyspark.sql import Window

    return built.withColumn("entry", (F.row_number().over(Window.partitionBy("dataset").orderBy("file")) - 1).cast("long"))


def named_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, file, size_bytes): the lines' files, with two more that pass for sorted masters.

    One master is as large as half of the dataset, the other a byte more for datasets with an even number of lines.
    """
    sizes = line_ends(spark, sf_dir).groupBy("dataset", "file").agg(F.sum("size_bytes").alias("size_bytes"), F.sum("records").alias("n"))
    whole = sizes.groupBy("dataset").agg(F.sum("size_bytes").alias("s"), F.sum("n").alias("n"))
    sizes = sizes.drop("n")
    half = F.floor(F.col("s") / 2).cast("long")
    one = whole.select("dataset", F.lit("all_sorted.txt").alias("file"), half.alias("size_bytes"))
    two = whole.select("dataset", F.lit("old_sorted.txt").alias("file"), (F.when(F.col("n") % 2 == 0, half + 1).otherwise(F.col("s") * 2)).cast("long").alias("size_bytes"))
    return sizes.unionByName(one).unionByName(two)


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, file): names of every sort that folders hold."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("dataset"), (F.col("doc_id") % 12).cast("string").alias("k")).distinct()
    made = F.array(*(F.concat(*(F.lit(x) if x not in ("d", "k") else F.col("dataset" if x == "d" else "k") for x in parts)) for parts in (("d", "_", "k", ".txt"), ("d", "_", "k", ".zip"), ("k", ".7z"), ("d", "_sorted.txt"), ("d", ".txt"), ("lookup.txt",), ("part", "k", "_sorted.txt"))))
    return d.select("dataset", F.explode(made).alias("file")).distinct()


SQL = r"""
lines AS (
  SELECT source AS dataset, lang || '.txt' AS file, doc_id, CAST(unnest(range(len(ls))) AS INTEGER) AS pos, unnest(ls) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
words AS (
  SELECT dataset, dataset || '_' || hex(substr(line, 1, 1)) || '.txt' AS file, line
  FROM (SELECT source AS dataset, unnest(regexp_split_to_array(text, '[ \n]')) AS line FROM documents WHERE text IS NOT NULL) WHERE line <> ''),
probes AS (SELECT DISTINCT probe FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS probe FROM benchmark WHERE text IS NOT NULL) WHERE probe <> ''),
line_probes AS (SELECT DISTINCT line AS probe FROM lines WHERE dataset = 'src1'),
range_manifest AS (SELECT dataset, file, min(line) AS lo, max(line) AS hi, CAST(sum(strlen(line) + 1) AS BIGINT) AS size_bytes FROM words GROUP BY dataset, file),
positional_manifest AS (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY file) - 1 AS entry FROM (
    SELECT dataset, file, arg_min(line, (doc_id, pos)) AS lo, arg_max(line, (doc_id, pos)) AS hi, count(*) AS records, CAST(sum(strlen(line) + 1) AS BIGINT) AS size_bytes
    FROM lines GROUP BY dataset, file)),
sizes AS (SELECT dataset, file, CAST(sum(strlen(line) + 1) AS BIGINT) AS size_bytes FROM lines GROUP BY dataset, file),
whole AS (SELECT dataset, CAST(sum(strlen(line) + 1) AS BIGINT) AS s, count(*) AS n FROM lines GROUP BY dataset),
named_listing AS (
  SELECT * FROM sizes UNION ALL SELECT dataset, 'all_sorted.txt', s // 2 FROM whole
  UNION ALL SELECT dataset, 'old_sorted.txt', CASE WHEN n % 2 = 0 THEN s // 2 + 1 ELSE s * 2 END FROM whole),
masters AS (
  SELECT dataset, file, size_bytes FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY size_bytes DESC, file DESC) AS k FROM named_listing WHERE file LIKE '%.txt' AND contains(file, '_sorted')) WHERE k = 1),
word_masters AS (
  SELECT dataset, dataset || '_sorted.txt' AS file, min(line) AS lo, max(line) AS hi, CAST(sum(strlen(line) + 1) AS BIGINT) AS size_bytes
  FROM words WHERE strlen(dataset) = 4 GROUP BY dataset),
index_ AS (
  SELECT *, dataset || '/' || file AS full_path FROM (
    SELECT 'sorted' AS kind, dataset, file, lo, hi, size_bytes FROM word_masters
    UNION ALL SELECT 'lookup', dataset, file, lo, hi, size_bytes FROM range_manifest WHERE dataset NOT IN (SELECT dataset FROM word_masters))),
unsorted_lo AS (
  SELECT dataset, min(entry) + 1 AS entry_no FROM (SELECT *, lag(lo) OVER (PARTITION BY dataset ORDER BY entry) AS b FROM positional_manifest) WHERE b > lo GROUP BY dataset),
unsorted_lohi AS (
  SELECT DISTINCT dataset FROM (SELECT *, lag(lo) OVER (PARTITION BY dataset ORDER BY entry) AS b, lag(hi) OVER (PARTITION BY dataset ORDER BY entry) AS c FROM positional_manifest)
  WHERE b > lo OR (b = lo AND c > hi)),
counted AS (SELECT upper(sha1(line)) AS h, count(*) AS n FROM words GROUP BY line),
file_names AS (
  SELECT DISTINCT dataset, unnest([dataset || '_' || k || '.txt', dataset || '_' || k || '.zip', k || '.7z', dataset || '_sorted.txt', dataset || '.txt', 'lookup.txt', 'part' || k || '_sorted.txt']) AS file
  FROM (SELECT DISTINCT source AS dataset, CAST(doc_id % 12 AS VARCHAR) AS k FROM documents)),
there AS (SELECT * FROM named_listing WHERE size_bytes >= 2000),
there_masters AS (
  SELECT dataset, file, size_bytes FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY size_bytes DESC, file DESC) AS k FROM there WHERE file LIKE '%.txt' AND contains(file, '_sorted')) WHERE k = 1),
there_index AS (
  SELECT 'sorted' AS kind, dataset, file FROM there_masters WHERE strlen(dataset) = 4
  UNION ALL SELECT 'lookup', dataset, file FROM positional_manifest WHERE dataset NOT IN (SELECT dataset FROM there_masters WHERE strlen(dataset) = 4)),
findings AS (
  SELECT dataset, 'no such file: ' || dataset || '/' || file AS e, true AS error FROM positional_manifest WHERE size_bytes < 2000
  UNION ALL SELECT dataset, dataset || '/lookup.txt is not sorted at entry ' || entry_no, false FROM unsorted_lo),
word_candidates AS (SELECT md5(probe) AS id, probe, kind, dataset, file, full_path FROM probes JOIN index_ ON probe BETWEEN lo AND hi),
word_counts AS (SELECT dataset, file, line, count(*) AS n FROM words GROUP BY dataset, file, line),
word_offsets AS (
  SELECT dataset, line, CAST(coalesce(sum((strlen(line) + 1) * n) OVER (PARTITION BY dataset ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM (SELECT dataset, line, sum(n) AS n FROM word_counts GROUP BY dataset, line)),
word_lines AS (
  SELECT dataset, file, line, CAST(coalesce(sum(n) OVER (PARTITION BY dataset, file ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS line_no
  FROM word_counts),
sorted_hits AS (SELECT c.id, c.full_path, o."offset" FROM word_candidates c JOIN word_offsets o ON c.kind = 'sorted' AND c.dataset = o.dataset AND c.probe = o.line),
lookup_hits AS (SELECT c.id, c.full_path, l.line_no AS line FROM word_candidates c JOIN word_lines l ON c.kind = 'lookup' AND c.dataset = l.dataset AND c.file = l.file AND c.probe = l.line),
told AS (
  SELECT id, array_to_string(list(dataset || '|' || file || '|' || kind ORDER BY dataset, file, kind), ',') AS candidates, count(*) AS n, bool_or(kind = 'lookup') AS scans
  FROM word_candidates GROUP BY id),
offsets AS (
  SELECT dataset, line, n, CAST(coalesce(sum((strlen(line) + 1) * n) OVER (PARTITION BY dataset ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM (SELECT dataset, line, count(*) AS n FROM lines GROUP BY dataset, line))
"""
