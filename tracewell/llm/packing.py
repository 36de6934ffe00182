"""Packing by power-of-two decomposition: each document is cut into pieces whose lengths are powers of two.

A document of n ids gives floor(n / most) pieces of `most` ids and one for each bit of the rest, longest first.  Every
piece is a sequence of its own, in the bucket of its length: no sequence crosses documents, none needs padding, and a
batch drawn from one bucket has equal lengths.  Pieces are made where the document is read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import textops as X
from tracewell.llm.common import prepare, quoted, strings, tidy
from tracewell.llm.tokens import tokenizer

#: Ids held at a time while pieces are written.
_CHUNK_IDS = 1 << 18


def decompose(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents of these sizes; most is a power of two."""
    bits = 1 << np.arange(most.bit_length() - 2, -1, -1)
    full, rest = sizes // most, sizes % most
    has = (rest[:, None] & bits) > 0
    n = full + has.sum(1)
    doc = np.repeat(np.arange(len(sizes)), n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    length = np.full(len(doc), most, np.int64)
    tail = place >= full[doc]
    length[tail] = np.broadcast_to(bits, has.shape)[has]
    total = np.concatenate([[0], np.cumsum(length)])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    return doc, total[:-1] - begin[doc], length


def pieces(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", most: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket and, if asked
    for, ids.  vocabulary: path of a tokenizer file, read by the driver.

    A null or empty text gives one piece, of end_id alone.  Repeated rows are packed each.  sequence_id is unique but
    not gapless: it joins the partition's number and the place in it.  offset is 0, as a piece fills its sequence;
    bucket is the binary logarithm of length.  Other columns are not looked at; an empty table gives none.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("most must be a power of two")
    prepare(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        t = tokenizer(sent.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, first = t.encode(strings(batch.column(1)))
            sizes = np.diff(first) + 1
            joined = np.full(len(ids) + len(sizes), end_id, np.uint32)
            begin = np.cumsum(sizes) - sizes
            X.gather(ids, first[:-1], sizes - 1, joined, begin)
            doc, start, length = decompose(sizes, most)
            at = begin[doc] + start
            raw = memoryview(joined.astype("<u4")).cast("B")
            crc = np.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)], np.int64)
            edge = np.append(at, len(joined))
            lo = 0
            while lo < len(doc):  # a batch of output at a time
                hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + _CHUNK_IDS, side="right")) - 1)
                cols = [batch.column(0).take(pa.array(doc[lo:hi])), start[lo:hi], length[lo:hi], crc[lo:hi], sizes[doc[lo:hi]], np.zeros(hi - lo, np.int64), np.log2(length[lo:hi]).astype(np.int32)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset", "bucket"]
                if with_ids:
                    cuts = np.append(at[lo:hi], edge[hi]) - edge[lo]
                    cols.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(joined[edge[lo] : edge[hi]].astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in cols], names=names)
                lo = hi
        tidy()

    kind = docs.schema[id_col].dataType.simpleString()
    made = docs.select(F.col(quoted(id_col)).alias("doc_id"), quoted(text_col)).mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, offset long, bucket int" + ", ids array<int>" * with_ids)
    return made.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"), "offset", "bucket", *["ids"] * with_ids)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences of equal length in a folder each."""
    packed.write.partitionBy("bucket").parquet(path)


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """What op5 returns."""
    return pieces(docs, vocabulary, with_ids=False)
