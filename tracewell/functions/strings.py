"""Column functions with the byte semantics of the lookup protocol.

Strings compare by their UTF-8 bytes, which is how Spark compares strings by default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_cr(line: ColumnLike) -> Column:
    """Without one carriage return at the very end.

    A pattern would turn the bytes into characters and lose those that aren't UTF-8, so the end is cut off.
    """
    c = _c(line)
    return F.when(c.endswith("\r"), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)


def record_bytes(line: ColumnLike) -> Column:
    """Bytes of a record and its line end."""
    return F.octet_length(_c(line)).cast("long") + F.lit(1).cast("long")


def split_lines(text: ColumnLike) -> Column:
    """Records of a whole text: split at \\n or \\r\\n; a final line end adds no record."""
    parts = F.split(_c(text), "\r?\n", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def sha1_upper(value: ColumnLike) -> Column:
    return F.upper(F.sha1(_c(value).cast("binary")))


def hash_prefix(digest: ColumnLike) -> Column:
    return F.substring(_c(digest), 1, 5)


def hash_suffix(digest: ColumnLike) -> Column:
    return F.substring(_c(digest), 6, 35)


def leading_int(text: ColumnLike) -> Column:
    """The whole number that a text begins with, after white space; 0 where there is none or it doesn't fit."""
    return F.coalesce(F.regexp_extract(_c(text), r"^\s*([+-]?\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def natural_key(name: ColumnLike) -> Column:
    """A key by which runs of digits sort as numbers: each is padded to 20 digits."""
    parts = F.regexp_extract_all(_c(name), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p)), "")


def join_path(*parts: ColumnLike) -> Column:
    return F.concat_ws("/", *(_c(p) for p in parts))


def is_master_name(name: ColumnLike) -> Column:
    """A sorted master: a text file whose name says so."""
    return _c(name).endswith(".txt") & _c(name).contains("_sorted")


def is_shard_name(name: ColumnLike, dataset: ColumnLike) -> Column:
    """A shard: neither the manifest, an archive, nor the dataset's own whole or sorted file."""
    n, d = _c(name), _c(dataset)
    return (n != "lookup.txt") & ~n.endswith(".zip") & ~n.endswith(".7z") & (n != F.concat(d, F.lit(".txt"))) & (n != F.concat(d, F.lit("_sorted.txt")))


def requested_text(message: ColumnLike) -> Column:
    """What a message asks for: the string field `password` of a JSON object, else the message as it is."""
    m = _c(message)
    found = F.try_parse_json(m)
    kind = F.schema_of_variant(F.try_variant_get(found, "$.password", "variant"))
    return F.when(kind == "STRING", F.try_variant_get(found, "$.password", "string")).otherwise(m)


def sample_indices(n: ColumnLike, limit: int = 3) -> Column:
    """First, last, and up to limit - 1 evenly spread entries of n; ascending, each once."""
    n = _c(n).cast("bigint")
    ends = F.array(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), n - 1))
    steps = F.array(*(F.lit(i).cast("bigint") for i in range(1, max(limit, 2))))
    inner = F.transform(F.filter(steps, lambda i: (i < F.least(n - 1, F.lit(limit).cast("bigint")))), lambda i: F.floor((i * n) / F.lit(limit + 1)).cast("bigint"))
    return F.array_sort(F.array_distinct(F.concat(ends, inner)))


def iso_time(epoch_ms: ColumnLike) -> Column:
    return F.date_format(F.timestamp_millis(_c(epoch_ms)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
