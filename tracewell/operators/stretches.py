"""Work along an order of rows without gathering a group, or all rows, in one task: running sums and nearest rows.

Rows are dealt by ranges of the order, so each task has a stretch of it, and are checkpointed then, so stretches stay
what they are.  What a task must know of the stretches before its own is one row of each, which goes by the driver.
A row carries its stretch's number: in a union, or after a coalesce, a task's own number is another.
No row is copied, and one shuffle is all.  Within a task rows are worked on a batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.session import durable, ship


def _dealt(rows: DataFrame, by: list[Column], within: list[Column]) -> DataFrame:
    """rows by ranges of their order, each with the number of its stretch in a last column, __part."""
    ship(rows.sparkSession)
    return durable(rows.repartitionByRange(*by).sortWithinPartitions(*by, *within).withColumn("__part", F.spark_partition_id()))


def _part(b: pa.RecordBatch) -> int:
    return b.column(b.num_columns - 1)[0].as_py()


def _begins(keys: list[pa.Array]) -> np.ndarray:
    """Whether each row's keys differ from those of the row before; nulls are equal."""
    n = len(keys[0]) if keys else 0
    out = np.zeros(n, bool)
    for k in keys:
        a, b = k.slice(1), k.slice(0, n - 1)
        same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | (pc.is_null(a).to_numpy(zero_copy_only=False) & pc.is_null(b).to_numpy(zero_copy_only=False))
        out[1:] |= ~same
    return out


def _loose(x: pa.StructArray) -> pa.StructArray:
    """x with a type by which any of its fields may be null, as those of rows without an answer are."""
    fields = [pa.field(f.name, f.type) for f in x.type]
    return pa.StructArray.from_arrays([x.field(i) for i in range(len(fields))], fields=fields, mask=x.is_null())


def _by_bytes(rows: DataFrame, names: list[str]) -> list[Column]:
    """Strings as bytes: their order is the same, and bytes that aren't UTF-8 pass through Python."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return [(F.col(c).cast("binary") if kinds[c] == "string" else F.col(c)) for c in names]


def running_before(rows: DataFrame, keys: list[str], order: list[str], weight: Column, name: str) -> DataFrame:
    """rows with the sum of weight over all rows of the same keys that come before, as a long.

    Rows that are equal by keys and order come one after another as they happen to lie.
    """
    n, columns = len(keys), list(rows.columns)
    plain = rows.select(*(F.col(c) for c in rows.columns), F.struct(*(k.alias(f"k{i}") for i, k in enumerate(_by_bytes(rows, keys))), weight.cast("long").alias("w")).alias("__along"))
    dealt = _dealt(plain, [F.col(c) for c in [*keys, *order]], [])

    def groups(b: pa.RecordBatch) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
        along = b.column(b.num_columns - 2)
        key = [along.field(i) for i in range(n)]
        begins = _begins(key) if n else np.zeros(b.num_rows, bool)
        begins[0] = True
        return key, np.flatnonzero(begins), np.asarray(along.field(n).fill_null(0)).astype(np.int64)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = part = None
        total, one = 0, True
        for b in batches:
            if not b.num_rows:
                continue
            key, at, w = groups(b)
            part = _part(b)
            sums = np.add.reduceat(w, at)
            for i, s in ((0, sums[0]), (-1, sums[-1])) if len(at) > 1 else ((0, sums[0]),):
                k = tuple(x[int(at[i])].as_py() for x in key)
                first = k if first is None else first
                if last != k:
                    one, total = last is None, 0
                last, total = k, total + int(s)
        if first is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "first": pa.array([repr(first)]), "last": pa.array([repr(last)]), "total": pa.array([total], pa.int64()), "one": pa.array([one])})

    # one row a task
    found = sorted(dealt.mapInArrow(ends, "part int, first string, last string, total long, one boolean").collect())
    carried, last, total = {}, None, 0
    for r in found:
        carried[r["part"]] = total if r["first"] == last else 0
        total = r["total"] + (carried[r["part"]] if r["one"] else 0)
        last = r["last"]
    sent = rows.sparkSession.sparkContext.broadcast(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = last = None
        for b in batches:
            if not b.num_rows:
                continue
            key, at, w = groups(b)
            if last is None:
                before = sent.value[_part(b)]
            elif last != tuple(x[0].as_py() for x in key):
                before = 0
            sums = np.cumsum(w) - w
            sums -= np.repeat(sums[at], np.diff(np.append(at, len(w))))
            sums[: at[1] if len(at) > 1 else len(w)] += before
            before, last = int(sums[-1] + w[-1]), tuple(x[b.num_rows - 1].as_py() for x in key)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(sums)], names=[*columns, name])

    return _named(dealt, columns, run, [(name, "long")])


def _named(dealt: DataFrame, columns: list[str], run: Callable, more: list[tuple[str, str]]) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema}
    return dealt.mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in [*((c, kinds[c]) for c in columns), *more]))


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, payload: list[str], *, after: bool = False, strict: bool = False) -> DataFrame:
    """Each row of left with `payload` of the row of right, of the same keys, that is nearest before it by `at`.

    after: nearest after it; strict: not at the same place.  Where there is none, the payload is null.  Rows of right
    that are equal by keys and place come in no order; so do those of left.  Columns of the payload must be new to left.
    """
    n, kinds = len(keys), {f.name: f.dataType.simpleString() for f in right.schema}
    told = F.struct(*(c.alias(f"v{i}") for i, c in enumerate(_by_bytes(right, payload))), F.lit(0).alias("z"))
    along = lambda df: [c.alias(f"k{i}") for i, c in enumerate(_by_bytes(df, [*keys, at]))]
    whole = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(left.columns)))
    one = left.select(*along(left), F.lit(1 if not strict else 0).alias("side"), F.lit(True).alias("asks"), whole.alias("row"))
    two = right.select(*along(right), F.lit(0 if not strict else 1).alias("side"), F.lit(False).alias("asks"), told.alias("told"))
    both = one.unionByName(two, allowMissingColumns=True)
    place = F.col(f"k{n}").desc() if after else F.col(f"k{n}").asc()
    dealt = _dealt(both, [*(F.col(f"k{i}") for i in range(n)), place], [F.col("side")])
    dealt = dealt.select(*(f"k{i}" for i in range(n)), "asks", "told", "row", "__part")

    def answers(b: pa.RecordBatch) -> np.ndarray:
        return ~b.column(n).to_numpy(zero_copy_only=False)

    def last_told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            found = np.flatnonzero(answers(b))
            if len(found):
                held = b.slice(int(found[-1]), 1)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([_part(held)], pa.int32()), *held.columns[:n], held.column(n + 1)], names=["part", *(f"k{i}" for i in range(n)), "told"])

    heads = dealt.select(*(f"k{i}" for i in range(n)), "told").schema
    lasts = dealt.mapInArrow(last_told, "part int" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in heads)).toArrow()  # one row a task
    table = lasts.sort_by("part").combine_chunks() if lasts.num_rows else lasts
    sent = left.sparkSession.sparkContext.broadcast(table.to_batches()[0] if table.num_rows else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, begun = None, False
        for b in batches:
            if not b.num_rows:
                continue
            if not begun and sent.value is not None:
                earlier = int(np.searchsorted(np.asarray(sent.value.column(0)), _part(b)))
                held = sent.value.slice(earlier - 1, 1) if earlier else None
                held = held and [*held.columns[1 : n + 1], _loose(held.column(n + 1))]
            begun = True
            key, told = list(b.columns[:n]), _loose(b.column(n + 1))
            if held is None:
                held = [*(pa.nulls(1, k.type) for k in key), pa.nulls(1, told.type)]
            whole = [pa.concat_arrays([h, x]) for h, x in zip(held, [*key, told], strict=True)]
            says = answers(b)
            near = np.maximum.accumulate(np.where(says, np.arange(1, b.num_rows + 1), 0))
            taken = [x.take(pa.array(near)) for x in whole]
            same = np.ones(b.num_rows, bool)
            for k, t in zip(key, taken[:-1], strict=True):
                same &= pc.fill_null(pc.equal(k, t), False).to_numpy(zero_copy_only=False)
            held = [x.slice(int(near[-1]), 1) for x in whole]
            asks = np.flatnonzero(~says)
            if len(asks):
                said = taken[-1].take(pa.array(np.where(same, np.arange(b.num_rows), -1)[asks], pa.int64(), mask=~same[asks]))
                yield pa.RecordBatch.from_arrays([b.column(n + 2).take(pa.array(asks)), said], names=["row", "told"])

    shape = dealt.select("row", "told").schema
    met = dealt.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape))
    return met.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(left.columns)), *(F.col(f"told.v{i}").cast(kinds[c]).alias(c) for i, c in enumerate(payload)))
