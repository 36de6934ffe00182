"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with documents.

A window is `size` consecutive words of an item (the whole item if it has fewer), seen as a set of shingles of up to
`shingle` words.  Containment of the whole set is asked for, so by the prefix-filter principle it is enough to look up
one shingle of each window, the rarest over all documents.  A shingle met in a document names the windows that it may
belong to and its place in each; positional and length bounds drop those that would leave the document, and the rest
are confirmed word by word over the window's span.

Documents are never shuffled.  The benchmark comes in blocks of at most `block_windows` windows and `block_bytes` of
text, both checked; a window costs some 50 bytes in what every executor is sent, and its text.  Shingle frequencies of _TOGETHER blocks are taken
in one pass over the documents, and the join is one pass for each block, so the benchmark's size is no limit.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import textops as X
from tracewell.llm.common import annotate, durable, prepare, quoted, strings

_FILTER_BITS = 20
_STATE = "n_words long, lo array<int>, hi array<int>, items array<string>"
#: Blocks whose frequencies are counted in the same pass.
_TOGETHER = 4
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass
class Block:
    """Windows of some items, as places among the items' words, laid end to end."""

    raw: np.ndarray  # the items' bytes, and where their words begin and end
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray  # hash of each word
    first: np.ndarray  # first word of each distinct window
    length: np.ndarray
    of_first: np.ndarray  # CSR from windows to items
    of_item: np.ndarray
    ids: list[str]
    widths: list[int]  # words in a shingle; windows of fewer words are shingles themselves
    tokens: np.ndarray  # all shingles, sorted
    # chosen by rarity, CSR over the sorted distinct prefix tokens:
    prefix: np.ndarray | None = None
    prefix_first: np.ndarray | None = None
    prefix_window: np.ndarray | None = None
    prefix_place: np.ndarray | None = None
    table: np.ndarray | None = None

    def of_width(self, k: int) -> np.ndarray:
        """Whether a window's shingles have k words."""
        return self.length >= k if k == self.widths[-1] else self.length == k

    @property
    def shingle(self) -> np.ndarray:
        """Windows x places: their shingles' hashes, 0 beyond a window's end."""
        out = np.zeros((len(self.length), int(self.length.max(initial=1))), np.uint64)
        for k in self.widths:
            sh, mine = _shingles(self.words, k), self.of_width(k)
            for j in range(out.shape[1] - k + 1):
                on = np.flatnonzero(mine & (j <= self.length - k))
                out[on, j] = sh[self.first[on] + j]
        return out


def _filter_table(tokens: np.ndarray) -> np.ndarray:
    t = np.zeros(1 << _FILTER_BITS, bool)
    t[(tokens >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return t


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, where words begin and end, their hashes, and the first word of each text."""
    raw, offs = X.byte_view(texts)
    raw = X.lowered(raw)
    starts, ends, first = X.words(raw, offs, "alnum")
    return raw, starts, ends, X.span_hashes(raw, starts, ends), first


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of k words from each word on, whatever text they belong to."""
    return X.windows(h, np.array([0, len(h)]), k)[0]


def build_block(ids: list[str], texts: list[str], size: int, shingle: int) -> Block:
    raw, starts, ends, h, first = _split(pa.array(texts, pa.string()))
    n = np.minimum(np.diff(first), size)
    many = np.where(n > 0, np.diff(first) - n + 1, 0)
    item = np.repeat(np.arange(len(ids)), many)
    at = first[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
    length = n[item]
    # equal windows become one: two hashes of all their words tell them apart
    one, two = np.zeros(len(at), np.uint64), length.astype(np.uint64)
    for j in range(size):
        w = np.where(j < length, h[np.minimum(at + j, len(h) - 1)], np.uint64(0)) if len(h) else one
        one, two = X.mix(one) + w, X.mix(two ^ w)
    order = np.lexsort((item, one, two))
    new = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])[: len(order)]
    again = np.concatenate([[False], (~new[1:]) & (item[order][1:] == item[order][:-1])])[: len(order)]
    head = order[new]
    cuts = np.append(np.flatnonzero(new[~again]), (~again).sum())
    widths = sorted({min(shingle, int(k)) for k in np.unique(length)})
    b = Block(raw, starts.astype(np.int32), ends.astype(np.int32), h, at[head].astype(np.int32), length[head].astype(np.int32), cuts.astype(np.int32), item[order[~again]].astype(np.int32), ids, widths, np.zeros(0, np.uint64))
    found = [b.tokens]
    for k in widths:
        sh, mine = _shingles(h, k), b.of_width(k)
        used = np.zeros(len(sh), bool)
        for j in range(int((b.length[mine] - k).max(initial=-1)) + 1):
            used[b.first[mine & (j <= b.length - k)] + j] = True
        found.append(sh[used])
    b.tokens = np.unique(np.concatenate(found))
    return b


def choose_prefixes(b: Block, counts: np.ndarray) -> Block:
    """The rarest shingle of every window; ties by hash, then by place."""
    if not len(b.length):
        return b
    rank = np.empty(len(b.tokens), np.int64)
    rank[np.lexsort((b.tokens, counts))] = np.arange(len(b.tokens))
    best, place = np.full(len(b.length), len(rank)), np.zeros(len(b.length), np.int64)
    for k in b.widths:
        mine = np.flatnonzero(b.of_width(k))
        sh = _shingles(b.words, k)
        where = np.minimum(np.searchsorted(b.tokens, sh), len(rank) - 1)
        for j in range(int((b.length[mine] - k).max(initial=-1)) + 1):
            on = mine[j <= b.length[mine] - k]
            r = rank[where[b.first[on] + j]]
            less = r < best[on]
            best[on[less]], place[on[less]] = r[less], j
    token = b.tokens[np.argsort(rank)][best]
    order = np.argsort(token, kind="stable")
    b.prefix, firsts = np.unique(token[order], return_index=True)
    b.prefix_first = np.append(firsts, len(order)).astype(np.int32)
    b.prefix_window, b.prefix_place = order.astype(np.int32), place[order].astype(np.int16)
    b.table = _filter_table(b.prefix)
    return b


def _lookup(sh: np.ndarray, table: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into sh of known tokens, and which they are."""
    maybe = np.flatnonzero(table[(sh >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    at = np.minimum(np.searchsorted(tokens, sh[maybe]), len(tokens) - 1)
    ok = tokens[at] == sh[maybe]
    return maybe[ok], at[ok]


def find(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, first: np.ndarray, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence of a window in the rows of a batch."""
    if not len(b.length):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = X.row_of(first)
    out = []
    for k in b.widths:
        sh, word = X.windows(h, first, k)
        hit, token = _lookup(sh, b.table, b.prefix)
        n = (b.prefix_first[token + 1] - b.prefix_first[token]).astype(np.int64)
        at = np.repeat(b.prefix_first[token], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window, met = b.prefix_window[at], np.repeat(word[hit], n)
        start = met - b.prefix_place[at]
        r, size = row[met], b.length[window]
        ok = (start >= first[r]) & (start + size <= first[r + 1])  # positional and length bounds
        start, window, size = start[ok], window[ok], size[ok]
        for j in range(int(b.length.max())):  # exact containment over the window's span, by hashes first
            ok = (j >= size) | (h[np.minimum(start + j, len(h) - 1)] == b.words[np.minimum(b.first[window] + j, len(b.words) - 1)])
            start, window, size = start[ok], window[ok], size[ok]
        # and what they leave, word by word
        begin = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(begin, size)
        mine, theirs = np.repeat(start, size) + place, np.repeat(b.first[window], size) + place
        differ = np.concatenate([[0], np.cumsum(~X.same_spans(raw, starts[mine], ends[mine], b.raw, b.starts[theirs], b.ends[theirs]))])
        ok = differ[begin + size] == differ[begin]
        out.append((start[ok], window[ok]))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_windows: int, block_bytes: int):
    """Lists of (id, text) of at most block_windows words, so of no more windows, and block_bytes; or of one item."""
    items = benchmark.select(F.coalesce(F.col(quoted(item_col)).cast("string"), F.lit("null")).alias("i"), F.col(quoted(text_col)).alias("t")).filter("t is not null").distinct()
    size = F.greatest(F.regexp_count("t", F.lit(_WORD)) / block_windows, (F.octet_length("t") + F.octet_length("i") + 64) / block_bytes)  # of a block
    n = max(1, math.ceil(items.agg(F.sum(size)).first()[0] or 0))
    while n > 1:
        block = F.pmod(F.xxhash64("i", "t"), F.lit(n))
        most = items.groupBy(block.alias("b")).agg(F.sum(size).alias("s"), F.count("*").alias("c")).filter("s > 1 and c > 1").limit(1).count()
        if not most:
            break
        n *= 2
    for k in range(n):
        yield items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect() if n > 1 else items.collect()


def _frequencies(docs: DataFrame, text_col: str, tokens: np.ndarray, widths: list[int]) -> np.ndarray:
    """How often each of these shingles occurs in all documents; partial counts are made before the shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast((tokens, _filter_table(tokens)))

    def run(batches):
        tokens, table = sent.value
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            h, first = _split(strings(batch.column(0)))[3:]
            for k in widths:
                sh, _ = X.windows(h, first, k)
                total += np.bincount(_lookup(sh, table, tokens)[1], minlength=len(tokens))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["token", "n"])

    found = docs.select(quoted(text_col)).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(tokens), np.int64)
    out[found["token"].to_numpy()] = found["n"].to_numpy()
    sent.unpersist()
    return out


def _ready(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, size: int, shingle: int, block_windows: int, block_bytes: int):
    """Blocks with their prefixes chosen."""
    rows = _blocks(benchmark, item_col, item_text_col, block_windows, block_bytes)
    while some := [build_block([r["i"] for r in x], [r["t"] for r in x], size, shingle) for x in itertools.islice(rows, _TOGETHER)]:
        tokens = np.unique(np.concatenate([b.tokens for b in some]))
        counts = _frequencies(docs, text_col, tokens, sorted({k for b in some for k in b.widths})) if len(tokens) else tokens
        while some:
            b = some.pop(0)
            choose_prefixes(b, counts[np.searchsorted(tokens, b.tokens)])
            b.tokens = b.tokens[:0]  # no more needed
            yield b


def mark(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, size: int = 10, shingle: int = 3, block_windows: int = 1 << 20, block_bytes: int = 16 << 20) -> tuple[DataFrame, str]:
    """The columns `keep` of docs with a struct column: n_words, n_hit, n_items, items (sorted), lo and hi (hit spans).

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case.  A null or empty text has no
    words and is never hit; a null or wordless item has no window; repeated items count once; an empty benchmark hits
    nothing; repeated documents are each marked; other columns stay as they are.
    """
    prepare(docs.sparkSession)
    keep = list(docs.columns if keep is None else keep)
    df, state = docs, None
    for b in _ready(docs, benchmark, text_col, item_col, item_text_col, size, shingle, block_windows, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(b)

        def run(texts, before=None, sent=sent):
            b = sent.value
            raw, starts, ends, h, first = _split(strings(texts))
            start, window = find(raw, starts, ends, h, first, b)
            hit = X.cover(start, start + b.length[window], len(h)) if len(start) else np.zeros(len(h), bool)
            row = X.row_of(first)
            pair = np.unique(np.stack([row[start], window]), axis=1) if len(start) else np.zeros((2, 0), np.int64)
            items: dict[int, set[str]] = {}
            for r, w in pair.T.tolist():
                items.setdefault(r, set()).update(b.ids[i] for i in b.of_item[b.of_first[w] : b.of_first[w + 1]].tolist())
            if before is not None:
                for r, x in enumerate(before.to_pylist()):
                    if x["items"]:
                        items.setdefault(r, set()).update(x["items"])
                        for lo, hi in zip(x["lo"], x["hi"], strict=True):
                            hit[first[r] + lo : first[r] + hi] = True
            edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            cut = np.setdiff1d(first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(h))], edge)
            cut = cut[hit[cut]]
            lo, hi = np.sort(np.concatenate([edge[0::2], cut])).astype(np.int64), np.sort(np.concatenate([edge[1::2], cut])).astype(np.int64)
            n = np.searchsorted(lo, first)
            shift = np.repeat(first[:-1], np.diff(n))
            spans = [pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.array(x - shift, pa.int32())) for x in (lo, hi)]
            return [np.diff(first), *spans, pa.array([sorted(items.get(r, ())) for r in range(len(texts))], pa.list_(pa.string()))]

        more = list(dict.fromkeys([*keep, text_col]))
        if state is None:
            df, state = annotate(df, [text_col], run, _STATE, more)
        else:
            before = state
            df, state = annotate(durable(df), [text_col, before], run, _STATE, more)
    s = F.col(state)
    n_hit = F.aggregate(F.zip_with(s["lo"], s["hi"], lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    out = F.struct(s["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(s["items"]).cast("long").alias("n_items"), s["items"].alias("items"), s["lo"].alias("lo"), s["hi"].alias("hi"))
    return df.withColumn(state, out).select(*(quoted(c) for c in keep), state), state


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    df, r = mark(docs, benchmark, **options)
    return df.filter(F.col(r)["n_hit"] == 0).drop(r)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What op2 returns: a row for each document with the counts and a digest of the items met."""
    df, r = mark(docs, benchmark, keep=["doc_id"])
    x = F.col(r)
    return df.select("doc_id", x["n_words"].alias("n_words"), x["n_hit"].alias("n_hit"), x["n_items"].alias("n_items"), F.sha2(F.array_join(x["items"], ","), 256).alias("items_sha256"), (x["n_hit"] > 0).alias("contaminated"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, ns WHERE len(ws) >= n)),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ks, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
