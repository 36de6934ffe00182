"""Bloom filters in the JVM: built by Spark's aggregate, tested by Spark's own expression.

Neither has a SQL name, so both are reached through the session's JVM; what runs on executors is generated code.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators.membership import hits
from tracewell.session import ship

_CAP = "spark.sql.optimizer.runtime.bloomFilter.maxNumBits"


def bits_for(n: int, fpp: float) -> int:
    return math.ceil(-n * math.log(fpp) / math.log(2) ** 2)


def build(corpus: DataFrame, record: str = "line", n: int = 15_000_000, fpp: float = 0.01):
    """A filter of the records that aren't empty, for n of them at a rate of false positives; of none, one that holds nothing.

    Spark silently cuts filters at a number of bits; the setting is raised for as long as the filter is built.
    """
    spark = corpus.sparkSession
    before, need = spark.conf.get(_CAP), bits_for(n, fpp) + 64
    if int(before) < need:
        spark.conf.set(_CAP, str(need))
    full = corpus.filter(F.col(record) != "").select(F.xxhash64(record).alias("h"))
    try:
        return full._jdf.stat().bloomFilter("h", n, fpp)
    except Py4JJavaError as e:
        if "NullPointerException" not in str(e.java_exception) or full.limit(1).count():
            raise
        return spark._jvm.org.apache.spark.util.sketch.BloomFilter.create(n, fpp)
    finally:
        spark.conf.set(_CAP, before)


def to_bytes(spark, bloom) -> bytes:
    out = spark._jvm.java.io.ByteArrayOutputStream()
    bloom.writeTo(out)
    return bytes(out.toByteArray())


def may_contain(spark, bloom, record: Column) -> Column:
    """A column that is false only for strings that weren't put into the filter."""
    jvm = spark._jvm
    out = jvm.java.io.ByteArrayOutputStream()
    bloom.writeTo(out)
    kind = jvm.org.apache.spark.sql.types.DataTypes.BinaryType
    literal = jvm.org.apache.spark.sql.catalyst.expressions.Literal(out.toByteArray(), kind)
    value = jvm.org.apache.spark.sql.classic.ExpressionUtils.expression(F.xxhash64(record)._jc)
    made = jvm.org.apache.spark.sql.catalyst.expressions.BloomFilterMightContain(literal, value)
    return Column(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(made))


def _column(spark, expression) -> Column:
    return Column(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))


def per_file(corpus: DataFrame, keys: list[str], record: str = "line", n: int = 15_000_000, fpp: float = 0.01) -> DataFrame:
    """(keys, bloom, records): a filter of each file's records that aren't empty, as bytes that to_bytes gives too.

    Built as an aggregate: parts of a file make filters of their own, which are united.
    """
    spark = corpus.sparkSession
    x = spark._jvm.org.apache.spark.sql.catalyst.expressions
    of = lambda c: spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.expression(c._jc)
    made = x.aggregate.BloomFilterAggregate(of(F.xxhash64(record)), of(F.lit(n).cast("bigint")), of(F.lit(bits_for(n, fpp)).cast("bigint")))
    need = bits_for(n, fpp) + 64
    if int(spark.conf.get(_CAP)) < need:  # read when the aggregate runs, so it stays raised
        spark.conf.set(_CAP, str(need))
    return corpus.filter(F.col(record) != "").groupBy(*keys).agg(_column(spark, made.toAggregateExpression()).alias("bloom"), F.count("*").alias("records"))


def files_that_may_hold(filters: DataFrame, probes: DataFrame, keys: list[str], probe: str = "probe", block: int = 100_000) -> DataFrame:
    """(probe, keys): files whose filter passes a probe; some have no such record.

    filters: as per_file makes them, kept in a table of their own.  Each is read once for a block of probes.
    """
    spark = filters.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))  # filters are large
    kinds = {f.name: f.dataType.simpleString() for f in filters.schema}
    asked = probes.select(F.col(probe).alias("p")).filter("p <> ''").distinct().select("p", F.xxhash64("p").alias("h"))
    n = max(1, -(-asked.count() // block))

    def passed(some: list) -> DataFrame:
        sent = spark.sparkContext.broadcast(([r["p"] for r in some], np.array([r["h"] for r in some], np.int64)))

        def test(batches):
            said, hashes = sent.value
            for b in batches:
                found = [[said[i] for i in np.flatnonzero(holds(raw, hashes))] for raw in b.column(len(keys)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.list_(pa.string()))], names=[*keys, "probes"])

        made = filters.select(*keys, "bloom").mapInArrow(test, "".join(f"`{k}` {kinds[k]}, " for k in keys) + "probes array<string>")
        return made.select(F.explode("probes").alias(probe), *keys)

    out = passed(asked.filter(F.pmod("h", F.lit(n)) == 0).collect())
    for k in range(1, n):
        out = out.unionByName(passed(asked.filter(F.pmod("h", F.lit(n)) == k).collect()))
    return out


def _murmur_longs(values: np.ndarray, seeds) -> np.ndarray:
    """Murmur3, 32 bits, of 64-bit numbers: what the JVM's filters hash numbers by."""
    u = np.uint32
    turn = lambda x, r: x << u(r) | x >> u(32 - r)
    v = values.view(np.uint64)
    h = np.broadcast_to(np.asarray(seeds, np.int32).view(u), v.shape).copy()
    for word in ((v & np.uint64(0xFFFFFFFF)).astype(u), (v >> np.uint64(32)).astype(u)):
        h ^= turn(word * u(0xCC9E2D51), 15) * u(0x1B873593)
        h = turn(h, 13) * u(5) + u(0xE6546B64)
    h ^= u(8)
    h = (h ^ h >> u(16)) * u(0x85EBCA6B)
    h = (h ^ h >> u(13)) * u(0xC2B2AE35)
    return (h ^ h >> u(16)).view(np.int32)


def holds(raw: bytes, items: np.ndarray) -> np.ndarray:
    """Whether a filter's bytes may hold each of some hashes.

    They are a version, the number of hashes, a seed if the version is 2, the number of words, and the words.
    """
    number = lambda at: int.from_bytes(raw[at : at + 4], "big", signed=True)
    version, hashes = number(0), number(4)
    if version not in (1, 2):
        raise ValueError(f"unknown version of filter: {version}")
    seed, begin = (0, 12) if version == 1 else (number(8), 16)
    words = np.frombuffer(raw, ">u8", number(begin - 4), begin)
    one = _murmur_longs(items, seed)
    two = _murmur_longs(items, one).astype(np.int64)
    one = one.astype(np.int64)
    out = np.ones(len(items), bool)
    for i in range(1, hashes + 1):
        x = (one + i * two).astype(np.int32).astype(np.int64) if version == 1 else one * 0x7FFFFFFF + i * two
        place = np.where(x < 0, ~x, x) % (64 * len(words))
        out &= (words[place >> 6].astype(np.uint64) >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    return out


def prefiltered_hits(probes: DataFrame, corpus: DataFrame, probe: str = "probe", record: str = "line", fpp: float = 0.01, most: int = 50_000_000) -> DataFrame:
    """Distinct probes that are records.

    A filter of the probes keeps most records out of the exact join that follows, so they are never shuffled.  It has
    the size that their number asks for; beyond `most` probes, some 60 MB, the join goes without.
    """
    asked = probes.select(probe).distinct()
    n = asked.count()
    if n <= most:
        bloom = build(asked, probe, max(n, 1000), fpp)
        corpus = corpus.filter(may_contain(probes.sparkSession, bloom, F.col(record)) | (F.col(record) == ""))
    return hits(asked, corpus, probe, record)
