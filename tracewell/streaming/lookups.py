"""Lookups of a stream of probes, and the events that answer them.

Probes meet the corpus by a stream-static join, so no state is kept; results carry the query's id and never the probe's
text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions import strings as S
from tracewell.session import durable

#: Columns of an event beyond its type and time; those without a value are left out of its JSON.
EVENT_FIELDS = {
    "id": "string", "ok": "boolean", "count": "bigint", "file": "string", "offset": "bigint", "line": "bigint", "source": "string", "debug": "string",
    "candidates": "array<struct<dataset:string,file:string,kind:string>>", "error": "string", "done": "boolean", "exitCode": "int", "signal": "string",
}
# Texts of events that callers know.
NO_CANDIDATE = "No candidate shard matched the password range."
SCAN_START = "searching %d shards"


def requests(messages: DataFrame, message: str = "value", id_col: str = "id") -> DataFrame:
    """(id, probe) of messages, streaming or not."""
    return messages.select(F.col(id_col).alias("id"), S.requested_text(message).alias("probe"))


def first_messages(messages: DataFrame, at: str = "at", id_col: str = "id") -> DataFrame:
    """The first message of each connection; a re-used id is a new connection only after it was closed.

    messages, not streaming: id, at, value and, where the client went away, closed.  Later messages on an open
    connection are of no effect.
    """
    closed = F.sum(F.col("closed").cast("int")).over(Window.partitionBy(id_col).orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    named = messages.withColumn("closed", F.coalesce("closed", F.lit(False))).withColumn("connection", F.coalesce(closed, F.lit(0)).cast("long"))
    asked = named.filter(~F.col("closed"))
    return asked.groupBy(id_col, "connection").agg(F.min_by("value", at).alias("value"))


def prepared(corpus: DataFrame, keep: list[str], record: str = "line") -> DataFrame:
    """What streams are joined with: the corpus without repetitions, made once and not in every micro-batch."""
    return durable(corpus.select(*keep, F.col(record).alias("__record")).distinct())


def stream_hits(probes: DataFrame, corpus: DataFrame, keep: list[str], probe: str = "probe", record: str = "line") -> DataFrame:
    """A row for each match of each streamed probe: the stream's other columns and `keep` of the corpus.

    A micro-batch reads the prepared corpus past its probes, which are the smaller side.
    """
    static = corpus if "__record" in corpus.columns else prepared(corpus, keep, record)
    return probes.join(static.select(*keep, "__record"), F.col(probe) == F.col("__record")).drop("__record", probe)


def scan_events(probes: DataFrame, candidates: DataFrame, sorted_hits: DataFrame, lookup_hits: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """(id, step, event): what each probe's client is told, in order.

    probes: id, probe.  candidates: id, kind, dataset, file, full_path.  sorted_hits: id, full_path, offset.
    lookup_hits: id, full_path, line; those in a file that a sorted hit named are left out.  failures: id, error.

    A probe without candidates gets a remark and the end.  Else come hits in masters, then, if there are shards to
    scan, the list of all candidates, hits in shards, and the end with the scan's exit code: 0 if it found any, 1 if
    none.  A failure comes before the end, which has exit code 2 then.  Lists have a row a file.
    """
    none = F.array().cast(EVENT_FIELDS["candidates"])
    told = candidates.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("dataset", "file", "kind"))).alias("list"), F.max((F.col("kind") == "lookup").cast("int")).alias("scans"))
    asked = probes.select("id").distinct().join(told, "id", "left").withColumn("list", F.coalesce("list", none)).withColumn("scans", F.coalesce("scans", F.lit(0)))
    fresh_hits = lookup_hits.join(sorted_hits.select("id", "full_path").distinct(), ["id", "full_path"], "left_anti")
    counted = fresh_hits.groupBy("id").agg(F.count("*").alias("n"))
    said = lambda df, step, **fields: df.select("id", F.lit(step).alias("step"), event("update", id=F.col("id"), **fields).alias("event"))
    parts = [
        said(asked.filter(F.size("list") == 0), 0, debug=F.lit(NO_CANDIDATE)),
        said(sorted_hits, 1, ok=F.lit(False), file=F.col("full_path"), offset=F.col("offset"), source=F.lit("sorted")),
        said(asked.filter("scans = 1"), 2, debug=F.format_string(SCAN_START, F.size("list")), candidates=F.col("list")),
        said(fresh_hits, 3, ok=F.lit(False), file=F.col("full_path"), line=F.col("line")),
    ]
    ended = asked.join(counted, "id", "left").withColumn("code", F.when(F.col("scans") == 1, F.when(F.col("n").isNotNull(), 0).otherwise(1)))
    if failures is not None:
        parts.append(said(failures, 4, error=F.col("error")))
        ended = ended.join(failures.select("id", F.lit(True).alias("failed")).distinct(), "id", "left").withColumn("code", F.when(F.col("failed"), 2).otherwise(F.col("code")))
    parts.append(said(ended, 5, done=F.lit(True), exitCode=F.col("code")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_end(hits: DataFrame, probes: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows of a batch's hits and one more for each id, whose `done` is true and whose other columns are null."""
    return hits.withColumn("done", F.lit(False)).unionByName(probes.select(id_col).distinct().withColumn("done", F.lit(True)), allowMissingColumns=True)


def event(kind: str, **fields: Column) -> Column:
    """An event's struct: its type and the fields given, the others null."""
    unknown = set(fields) - set(EVENT_FIELDS)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return F.struct(F.lit(kind).alias("type"), *(fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in EVENT_FIELDS.items()))


def to_message(event_col: Column, epoch_ms: Column | None = None) -> Column:
    """The JSON of an event, with the time it is sent."""
    at = S.iso_time(epoch_ms) if epoch_ms is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.to_json(F.struct(event_col["type"].alias("type"), at.alias("timestamp"), *(event_col[k].alias(k) for k in EVENT_FIELDS)))


def open_only(events: DataFrame, closed: DataFrame, id_col: str = "id") -> DataFrame:
    """Events whose client is still there."""
    return events.join(closed.select(id_col), id_col, "left_anti")


def run_available(results: DataFrame, path: str) -> DataFrame:
    """Run a streaming query over what there is now into Parquet, and return what it wrote."""
    query = results.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return results.sparkSession.read.schema(results.schema).parquet(f"{path}/out")
