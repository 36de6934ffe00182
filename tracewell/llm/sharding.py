"""Sharding by Karmarkar-Karp differencing, with near-equal bytes and groups kept whole.

Documents of equal text are a group and stay together.  A group of more than a 1024th of all bytes is a unit of its
own, and there are fewer than 1024 of those; the others are hashed to `units` units.  So a unit holds whole groups and
the driver sees a bounded table of sums however many groups there are.  Each unit starts as a partial
partition with its bytes in one of n places; the two partial partitions of largest spread are combined, the heaviest
place of one with the lightest of the other, until one is left.

The text is read once.  Ids, sizes and units are checkpointed; sums are made before they are shuffled; slots come from
counts by partition and shard, so no shard is ever gathered in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import durable, prepare, quoted

#: Partitions that slots are counted by; a table of this many times the shards reaches the driver.
_MOST_PARTITIONS = 20_000
#: A group of more than this part of all bytes is a unit of its own.
_HEAVY = 1024


def karmarkar_karp(weights: list[int], n: int) -> list[int]:
    """The place, from 0 to n - 1, of each weight; places are in descending order of their sums.

    Ties go by the order of the weights, so the answer is a function of them alone.
    """
    if not weights:
        return []
    # a partial partition: spread, a serial number, sums in descending order less the least, and the tree behind each
    # place: a weight's index, or a pair of trees, so that combining n places takes n steps however many weights meet
    heap = []
    for i, w in enumerate(weights):
        heap.append((-w, i, [w] + [0] * (n - 1), [i] + [None] * (n - 1)))
    heapq.heapify(heap)
    serial = len(weights)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        sums = [p + q for p, q in zip(a, reversed(b), strict=True)]
        trees = [(p, q) if p is not None and q is not None else (q if p is None else p) for p, q in zip(x, reversed(y), strict=True)]
        order = sorted(range(n), key=lambda k: (-sums[k], k))
        least = sums[order[-1]]
        sums = [sums[k] - least for k in order]
        heapq.heappush(heap, (-sums[0], serial, sums, [trees[k] for k in order]))
        serial += 1
    out = [0] * len(weights)
    for place, tree in enumerate(heap[0][3]):
        stack = [] if tree is None else [tree]
        while stack:
            t = stack.pop()
            if isinstance(t, tuple):
                stack.extend(t)
            else:
                out[t] = place
    return out


def assign(docs: DataFrame, *, shards: int = 16, units: int = 1 << 15, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, size (UTF-8 bytes of the text and one), text_crc32, law ('bytes'), shard,
    slot (gapless from 0 in its shard) and grown_shard (null: more shards mean another partition).

    A null text counts as the empty one, in its group too.  Repeated rows are of one group, so they share a shard, and
    each has its slot.  A group of more than a shard's even share has a shard to itself, and the others are balanced.
    An empty table gives an empty one; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    sized = docs.select(F.col(quoted(id_col)).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group"))
    if docs.rdd.getNumPartitions() > _MOST_PARTITIONS:
        sized = sized.coalesce(_MOST_PARTITIONS)
    sized = durable(sized)
    total = sized.agg(F.sum("size")).first()[0] or 0
    heavy = sized.groupBy("group").agg(F.sum("size").alias("s")).filter(F.col("s") * _HEAVY > total).orderBy("group").select("group").collect()
    own = docs.sparkSession.createDataFrame([(r["group"], units + i) for i, r in enumerate(heavy)], "group long, own int")
    sized = sized.join(F.broadcast(own), "group", "left").select("doc_id", "size", "text_crc32", F.coalesce("own", F.pmod("group", F.lit(units)).cast("int")).alias("unit"))
    sums = sized.groupBy("unit").agg(F.sum("size").alias("size")).toPandas().sort_values(["size", "unit"], ascending=[False, True])
    place = np.zeros(units + len(heavy), np.int32)
    place[sums["unit"].to_numpy()] = karmarkar_karp([int(x) for x in sums["size"]], shards)
    context = docs.sparkSession.sparkContext
    placed = context.broadcast(place)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n = np.zeros(shards, np.int64)
        for batch in batches:
            n += np.bincount(placed.value[np.asarray(batch.column(0))], minlength=shards)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * shards, pa.int32()), pa.array(range(shards), pa.int32()), pa.array(n)], names=["part", "shard", "n"])

    counts = sized.select("unit").mapInArrow(count, "part int, shard int, n long").toPandas()
    table = np.zeros((sized.rdd.getNumPartitions() + 1, shards), np.int64)
    table[counts["part"].to_numpy() + 1, counts["shard"].to_numpy()] = counts["n"].to_numpy()
    before = context.broadcast(np.cumsum(table, axis=0))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        next_ = before.value[TaskContext.get().partitionId()].copy()
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = placed.value[np.asarray(batch.column(3))]
            order = np.argsort(shard, kind="stable")
            n = np.bincount(shard, minlength=shards)
            slot = np.empty(len(shard), np.int64)
            slot[order] = np.arange(len(shard)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(next_, n)
            next_ += n
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(["bytes"] * len(shard)), pa.array(shard, pa.int32()), pa.array(slot), pa.nulls(len(shard), pa.int32())], names=["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"])

    kind = docs.schema[id_col].dataType.simpleString()
    return sized.mapInArrow(number, f"doc_id {kind}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
