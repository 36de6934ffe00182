"""What the training-data operators share: tables, durable intermediate results, Arrow batches."""

from __future__ import annotations

import base64
import contextlib
import ctypes
import gc
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import fields

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from tracewell.session import durable, ship

__all__ = ["annotate", "durable", "fresh", "held_out", "map_batches", "model_from_json", "model_to_json", "prepare", "quoted", "rekeyed", "release", "strings", "table", "tidy"]

#: Rows and bytes of one Arrow batch handed to Python; a single larger row still makes a batch of its own.
BATCH_ROWS = 1024
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that a worker's memory doesn't depend on how rows are laid out."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _trim(spark: SparkSession) -> None:
    """What jcmd's System.trim_native_heap does, by an interface that the JVM lets others call."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway

    def array(kind, *items):
        made = gateway.new_array(kind, len(items))
        for i, x in enumerate(items):
            made[i] = x
        return made

    named = jvm.java.lang.Class.forName
    takes = array(jvm.Class, *map(named, ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")))
    invoke = named("javax.management.MBeanServer").getMethod("invoke", takes)
    commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), array(jvm.Object, commands, "systemTrimNativeHeap", None, None))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of results that nothing refers to any more, and give the driver's unused memory back.

    What the C library keeps of memory that is free again lies outside the JVM's heap and grows from plan to plan.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    with contextlib.suppress(Py4JError):  # a JVM that has no such command keeps its memory
        _trim(spark)
    tidy()


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def model_to_json(model) -> str:
    """A fitted model, a dataclass of numbers, names and arrays, as text to be kept anywhere."""

    def plain(x):
        if isinstance(x, np.ndarray):
            return {"kind": x.dtype.str, "shape": x.shape, "data": base64.b64encode(np.ascontiguousarray(x).tobytes()).decode()}
        return x

    return json.dumps({f.name: plain(getattr(model, f.name)) for f in fields(model)})


def model_from_json(kind: type, text: str):
    """A model of this class from what model_to_json gave."""

    def back(x):
        if isinstance(x, dict) and set(x) == {"kind", "shape", "data"}:
            return np.frombuffer(base64.b64decode(x["data"]), x["kind"]).reshape(x["shape"]).copy()
        return x

    return kind(**{k: back(v) for k, v in json.loads(text).items()})


def held_out(doc_id: Column | str) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves remainder 2 by 4."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous array of text; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null("") if column.null_count else column


def tidy() -> None:
    """Give memory that this process no longer needs back to the system, as workers live on and share an executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow, a batch at a time, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)
        tidy()

    return df.mapInArrow(run, schema)


def rekeyed(df: DataFrame, key: str) -> DataFrame:
    """df with its long key computed anew.

    An aggregate by a key is already dealt by it, and a join would sit right on top of it, where Spark can't split a
    hot key of the other side.  A key that it doesn't recognise makes both sides plain exchanges, which it can split.
    """
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def annotate(df: DataFrame, inputs: list[str], function: Callable[..., list], fields: str, keep: list[str]) -> tuple[DataFrame, str]:
    """The columns `keep` of df, and a struct column of a fresh name, which is returned with the frame.

    function takes the arrays of the columns `inputs` and gives an array (or anything pa.array takes) for each of
    `fields`, which are DDL.  No shuffle; any other columns of df, whatever their names, stay as they are.
    """
    prepare(df.sparkSession)
    name, made = fresh("r"), StructType.fromDDL(fields)
    into = [(f.name, to_arrow_type(f.dataType)) for f in made]
    # plain names meanwhile: mapInArrow can't take those with dots
    source = df.select(*(F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keep)), *(F.col(quoted(c)).alias(f"x{i}") for i, c in enumerate(inputs) if c not in keep))
    at = [f"k{keep.index(c)}" if c in keep else f"x{i}" for i, c in enumerate(inputs)]
    plain = [f"k{i}" for i in range(len(keep))]
    schema = StructType([source.schema[c] for c in plain] + [StructField(name, made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = function(*(batch.column(c) for c in at))
            found = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, (_, t) in zip(found, into, strict=True)]
            struct = pa.StructArray.from_arrays(found, names=[n for n, _ in into])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in plain), struct], names=[*plain, name])
        tidy()

    return source.mapInArrow(run, schema).toDF(*keep, name), name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
