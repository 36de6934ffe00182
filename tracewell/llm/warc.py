"""WARC derivatives: for each response a metadata record and a plain-text conversion record that refer to it.

The metadata record holds, as JSON, the source's own WARC and HTTP headers in order, its digests as they were given
and as they are, and the identifier of the conversion.  The conversion record holds the page's text.  Both bear the
source's identifier in WARC-Refers-To, its target and its date.

Records are made where the response is read.  Files are made by Spark's own text writer in any store that Spark can
write; each record of them is a gzip member of its own, so a reader can seek to any and a damaged one costs no other.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import dom
from tracewell.llm.common import prepare, quoted

VERSION = "WARC/1.1"
_END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b\x08"
_CHUNK = 1 << 16
_LIST = "refers_to string, record_type string, record_id string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, source_block_digest string, source_payload_digest string, digests_hold boolean, http_status int, n_chars long, record string"


@dataclass
class Record:
    headers: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.headers if k.lower() == name.lower()), None)


def digest_of(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def serialise(record: Record) -> bytes:
    """A record without the empty lines that end it."""
    head = "".join(f"{k}: {_clean(v)}\r\n" for k, v in record.headers)
    return f"{VERSION}\r\n{head}\r\n".encode() + record.block


def _header_lines(raw: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").split("\n"):
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and out:  # a folded line goes on
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, _, v = line.partition(":")
            out.append((k.strip(), v.strip()))
    return out


def _headers_end(raw: bytes, start: int = 0) -> tuple[int, int]:
    """Where the headers end and the block begins."""
    m = re.compile(rb"\r?\n\r?\n").search(raw, start)
    return (m.start(), m.end()) if m else (len(raw), len(raw))


def parse(raw: bytes) -> Iterator[Record]:
    """The records of an uncompressed WARC; blocks are cut by Content-Length.  What isn't a record is passed over."""
    at = raw.find(b"WARC/")
    while 0 <= at < len(raw):
        end, begin = _headers_end(raw, at)
        headers = _header_lines(raw[at:end].split(b"\n", 1)[-1])
        size = next((int(v) for k, v in headers if k.lower() == "content-length" and v.isdigit()), 0)
        yield Record(headers, raw[begin : begin + size])
        at = raw.find(b"WARC/", begin + size)


def _member(raw: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at this place holds, where it ends, and what is wrong with it."""
    d, parts = zlib.decompressobj(31), []
    while at < len(raw) and not d.eof:
        chunk = raw[at : at + _CHUNK]
        try:
            parts.append(d.decompress(chunk))
        except zlib.error as e:
            return b"", at, str(e)
        at += len(chunk) - len(d.unused_data)
    return b"".join(parts), at, None if d.eof else "the member is cut short"


def unpacked(raw: bytes) -> Iterator[tuple[int, bytes, str | None]]:
    """(place, content, error) of a gzip file's members one by one, or of the file itself if it isn't one.

    A damaged member has an error and no content, and reading goes on at the next that can be read; one cut short by
    the file's end gives what there is of it.  What lies between members and is none is passed over.  Every byte is
    looked at once, but for those of a damaged member.
    """
    if raw[:2] != _GZIP[:2]:
        yield 0, raw, None
        return
    view, at, damaged = memoryview(raw), 0, False
    while (at := raw.find(_GZIP, at)) >= 0:
        content, end, error = _member(view, at)
        if error and not content:
            if not damaged:  # the beginnings that a damaged member seems to hold are no members
                yield at, b"", error
            damaged, at = True, at + 1
            continue
        yield at, content, error
        damaged, at = False, end


def response(page_id, url: str | None, html: str | None, date: str, row: int = 0) -> Record:
    """A response record for a fetched page.  The same page in the same row gives the same identifier."""
    payload = (html or "").encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url or ''}\n{digest_of(payload)}\n{row}")
    return Record(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", f"<urn:uuid:{name}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", url or ""),
            ("WARC-Payload-Digest", digest_of(payload)),
            ("WARC-Block-Digest", digest_of(block)),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ],
        block,
    )


@dataclass
class Http:
    status: int | None
    line: str
    headers: list[tuple[str, str]]
    payload: bytes
    body: bytes  # the payload without transfer and content coding

    @classmethod
    def of(cls, block: bytes) -> Http:
        if not block.startswith(b"HTTP/"):
            return cls(None, "", [], block, block)
        end, begin = _headers_end(block)
        line, _, rest = block[:end].partition(b"\n")
        line = line.decode("utf-8", "replace").strip()
        headers = _header_lines(rest)
        m = re.match(r"HTTP/\S+\s+(\d{3})", line)
        http = cls(int(m[1]) if m else None, line, headers, block[begin:], block[begin:])
        if "chunked" in http.get("transfer-encoding").lower():
            http.body = _dechunked(http.body)
        coding = http.get("content-encoding").lower()
        try:
            if "gzip" in coding:
                http.body = gzip.decompress(http.body)
            elif "deflate" in coding:
                try:
                    http.body = zlib.decompress(http.body)
                except zlib.error:
                    http.body = zlib.decompress(http.body, -15)
        except (OSError, EOFError, zlib.error):
            pass  # a body that was stored decoded, or is damaged, is taken as it is
        return http

    def get(self, name: str) -> str:
        return next((v for k, v in self.headers if k.lower() == name), "")


def _dechunked(raw: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = raw.find(b"\r\n", at)
        size = re.match(rb"\s*([0-9a-fA-F]+)", raw[at:end]) if end >= 0 else None
        if not size:
            return b"".join(out) or raw
        n = int(size[1], 16)
        if not n:
            return b"".join(out)
        out.append(raw[end + 2 : end + 2 + n])
        at = end + 4 + n


def plain_text(http: Http) -> str | None:
    """All text of an HTML page, a block to a line; of plain text, itself; None of anything else."""
    kind = http.get("content-type").lower()
    if kind and "html" not in kind and "text/plain" not in kind:
        return None
    m = re.search(r"charset=[\"']?([\w-]+)", kind) or re.search(r"<meta[^>]+charset=[\"']?([\w-]+)", http.body[:2048].decode("latin-1"), re.I)
    try:
        text = http.body.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        text = http.body.decode("utf-8", "replace")
    return text if "text/plain" in kind else "\n".join(x for x in dom.read(text).text if x is not None)


def derive(source: Record) -> list[tuple[Record, dict]]:
    """The metadata record and, where there is text, the conversion record of a response; none of other records."""
    if (source.get("WARC-Type") or "").lower() != "response":
        return []
    http = Http.of(source.block)
    of, uri, date = (source.get(k) or "" for k in ("WARC-Record-ID", "WARC-Target-URI", "WARC-Date"))
    name = lambda kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {of}')}>"
    given = {k: source.get(k) for k in ("WARC-Block-Digest", "WARC-Payload-Digest")}
    found = {"WARC-Block-Digest": digest_of(source.block), "WARC-Payload-Digest": digest_of(http.payload)}
    hold = all(v is None or v == found[k] for k, v in given.items())
    text = plain_text(http)
    more = {"refers_to": of, "source_block_digest": given["WARC-Block-Digest"], "source_payload_digest": given["WARC-Payload-Digest"], "digests_hold": hold, "http_status": http.status}

    def made(kind: str, content: str, block: bytes) -> Record:
        return Record([("WARC-Type", kind), ("WARC-Record-ID", name(kind)), ("WARC-Refers-To", of), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Block-Digest", digest_of(block)), ("Content-Type", content), ("Content-Length", str(len(block)))], block)

    out = []
    about = {
        "source": {"warc-headers": source.headers, "http-line": http.line, "http-headers": http.headers, "block-length": len(source.block), "payload-length": len(http.payload), "block-digest": found["WARC-Block-Digest"], "payload-digest": found["WARC-Payload-Digest"], "digests-hold": hold},
        "conversion": None if text is None else {"record-id": name("conversion"), "block-digest": digest_of(text.encode())},
    }
    block = json.dumps(about, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "replace")
    out.append((made("metadata", "application/json", block), more | {"n_chars": 0}))
    if text is not None:
        out.append((made("conversion", "text/plain; charset=utf-8", text.encode()), more | {"n_chars": len(text)}))
    return out


def responses(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record): a response record, in bytes, for each fetched page.

    A null address is an empty target, a null page an empty payload.  Repeated rows give records that differ in their
    identifiers alone, as those must be unique: a row's place among the rows read is a part of what they are made from.
    An empty table gives none; other columns are not looked at.
    """
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([serialise(response(i, u, h, date, k)) for i, u, h, k in rows], pa.binary())], names=["page_id", "record"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(quoted(id_col)).alias("page_id"), F.col(quoted(url_col)).alias("url"), F.col(quoted(html_col)).alias("html"), F.monotonically_increasing_id().alias("row")).mapInArrow(run, f"page_id {kind}, record binary")


def read(spark: SparkSession, path: str, *, batch_bytes: int = 8 << 20) -> DataFrame:
    """(path, record, offset, error): every record of WARC files, plain or gzipped a record at a time.

    offset is where the record's gzip member begins, 0 in a plain file.  A damaged member is a row without a record,
    and one cut short by the file's end a row with what there is; error says so.  A file is one task's work, of 2 GB at
    most, which is Spark's bound for a binary file.  A folder without files, and files without records, give no rows.
    """
    prepare(spark)
    names, kinds = ["path", "record", "offset", "error"], [pa.string(), pa.binary(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held, size = [], 0
                for at, member, error in unpacked(raw.as_py()):
                    for r in [None] if error and not member else parse(member):
                        held.append((name, r and serialise(r), at, error))
                        size += len(held[-1][1] or b"")
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, record binary, offset long, error string")


def derivatives(records: DataFrame, *, record_col: str = "record", keep: list[str] | None = None) -> DataFrame:
    """A row for each derived record, with the columns `keep` of its source; `record` is its text.

    Records that aren't responses, nulls and what isn't a record give none; so does an empty table.  A source's digests
    are handed on as given; digests_hold tells whether they are right.  A kept column that is named like one of the
    derived record's comes as source_ and its name, with more such before it while that is taken too.
    """
    prepare(records.sparkSession)
    asked, names = list(keep or ()), [x.split()[0] for x in _LIST.split(", ")]
    keep = []
    for c in asked:
        while c in names or c in keep or c != asked[len(keep)] and c in asked:
            c = f"source_{c}"
        keep.append(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, origin = [], []
            for i, raw in enumerate(b.column(len(keep)).to_pylist()):
                for source in parse(raw or b""):
                    for made, more in derive(source):
                        text = serialise(made).decode()
                        back = next(parse(text.encode()))  # what a reader of the output sees
                        rows.append(more | {"record_type": back.get("WARC-Type"), "record_id": back.get("WARC-Record-ID"), "target_uri": back.get("WARC-Target-URI"), "warc_date": back.get("WARC-Date"), "content_type": back.get("Content-Type"), "content_length": len(back.block), "block_digest": digest_of(back.block), "record": text})
                        origin.append(i)
            cols = [b.column(k).take(pa.array(origin, pa.int64())) for k in range(len(keep))]
            cols += [pa.array([r[n] for r in rows], {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}[x.split()[1]]) for n, x in zip(names, _LIST.split(", "), strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *names])

    kept = "".join(f"{quoted(c)} {records.schema[a].dataType.simpleString()}, " for c, a in zip(keep, asked, strict=True))
    return records.select(*(F.col(quoted(a)).alias(f"k{i}") for i, a in enumerate(asked)), F.col(quoted(record_col)).alias("x")).mapInArrow(run, kept + _LIST)


def _members(records: list[str]) -> list[bytes]:
    """Each record as a gzip member, less its last byte, which is 0: the highest of the size.

    After a record of 16 MB or more, whose size needs that byte, comes a member that holds nothing.
    """
    out = []
    for text in records:
        raw = text.encode() + _END
        made = gzip.compress(raw, 6, mtime=0)
        out.append((made if len(raw) < 1 << 24 else made + gzip.compress(b"", mtime=0))[:-1])
    return out


def write(derived: DataFrame, path: str) -> None:
    """WARC files, one for each partition, in a new folder; an empty table makes a folder without records.

    A record is a gzip member.  Spark's text writer puts a byte of its choice after each row, so rows are members
    without their last byte, and that byte is the separator.  Files are then given names that end in .warc.gz.
    """
    spark = derived.sparkSession
    prepare(spark)
    made = derived.select("record").mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array(_members(b.column(0).to_pylist()), pa.binary())], names=["m"]) for b in it), "m binary")
    made.select(F.col("m").cast("string")).write.option("lineSep", "\0").option("compression", "none").text(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if name.startswith("part-") and not fs.rename(f.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.gz")):
            raise OSError(f"cannot rename {f.getPath()}")


def digest(pages: DataFrame) -> DataFrame:
    """What op3 returns: every derived record of every page, with its text."""
    return derivatives(responses(pages), keep=["page_id"])
