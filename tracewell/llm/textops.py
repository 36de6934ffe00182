"""Vectorised work on the bytes of Arrow text columns: words, their hashes, spans.

All functions take the concatenated UTF-8 bytes of a batch and the offsets of its rows.  Word classes are byte
classes: every byte of a character beyond ASCII is a word byte, which is what the word patterns of the operators say.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

_KEY = np.uint64(0xA24BAED4963EE407)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 18  # chunks of eight bytes worked on at a time


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of rows from 0) of an Arrow string or binary array without nulls."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]]
    return raw, offs - offs[0]


@cache
def word_bytes(kind: str) -> np.ndarray:
    """Whether a byte belongs to a word.  'alnum': digits, letters and all beyond ASCII; 'space': all but white space."""
    t = np.ones(256, bool)
    if kind == "alnum":
        t[:128] = False
        t[ord("0") : ord("9") + 1] = t[ord("a") : ord("z") + 1] = t[ord("A") : ord("Z") + 1] = True
    else:
        t[[0x20, *range(0x09, 0x0E)]] = False
    return t


@cache
def _lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    return t


def lowered(raw: np.ndarray) -> np.ndarray:
    return _lower()[raw]


def words(raw: np.ndarray, offs: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the index of its first word (one entry more than rows)."""
    inside = word_bytes(kind)[raw]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    edge = np.empty(len(raw) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    both = np.unique(cut[inside[cut] & inside[cut - 1]])  # a word ends at a row's end, and one begins there
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    if len(both):
        starts, ends = np.sort(np.concatenate([starts, both])), np.sort(np.concatenate([ends, both]))
    return starts, ends, np.searchsorted(starts, offs)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _chunks(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Eight bytes of each span from 8 * place on, as little-endian numbers; beyond a span's end they are zero."""
    at = starts + 8 * places
    if len(raw) < 8:
        raw = np.concatenate([raw, np.zeros(8 - len(raw), np.uint8)])
    load = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    from_ = np.minimum(at, len(load) - 1)
    v = load[from_].astype(np.uint64) >> (8 * (at - from_)).astype(np.uint64)
    left = np.minimum(sizes - 8 * places, 8)
    return v & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * (8 - left)).astype(np.uint64))


def _chunked(sizes: np.ndarray):
    """(first span, one beyond the last, spans, places, where each span's begin) for blocks of chunks of the spans.

    A span longer than a block is met in several.
    """
    total = np.concatenate([[0], np.cumsum(-(-sizes // 8))])
    for lo in range(0, int(total[-1]), _BLOCK):
        hi = min(lo + _BLOCK, int(total[-1]))
        a, b = int(np.searchsorted(total, lo, side="right")) - 1, int(np.searchsorted(total, hi, side="left"))
        begin = np.maximum(total[a:b], lo)
        n = np.minimum(total[a + 1 : b + 1], hi) - begin
        span = np.repeat(np.arange(a, b), n)
        yield span, np.arange(lo, hi) - total[span], begin - lo, n


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); equal spans are equal.

    Every eight bytes are spread over all bits together with their place, and summed; so unlike a polynomial there is
    no arithmetic by which two texts could be made to agree, and long spans are no worse than short ones.
    """
    starts, sizes = starts.astype(np.int64), (ends - starts).astype(np.int64)
    out = sizes.astype(np.uint64) * _PLACE
    for span, place, begin, n in _chunked(sizes):
        v = mix(mix(_chunks(raw, starts[span], sizes[span], place) ^ _KEY) + place.astype(np.uint64) * _PLACE)
        full = n > 0
        some = np.add.reduceat(v, begin[full])
        out[span[begin[full]]] += some
    return mix(out)


def same_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each span of raw has the bytes of its span of other."""
    starts, sizes, other_starts = starts.astype(np.int64), (ends - starts).astype(np.int64), other_starts.astype(np.int64)
    same = sizes == other_ends - other_starts
    at = np.flatnonzero(same)
    starts, other_starts, sizes = starts[at], other_starts[at], sizes[at]
    for span, place, _, _ in _chunked(sizes):
        differ = _chunks(raw, starts[span], sizes[span], place) != _chunks(other, other_starts[span], sizes[span], place)
        same[at[span[differ]]] = False
    return same


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words that don't leave their row, and the index of each one's first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = h[:n].copy()
    for i in range(1, k):
        g = mix(g) + h[i : n + i]
    row_end = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(k, n + k) <= row_end)
    return mix(g[at]), at


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def cover(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n positions lies in a span [lo, hi)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, lo, 1)
    np.add.at(d, hi, -1)
    return np.cumsum(d[:-1]) > 0


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values (one for each word or byte) by row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def gather(src: np.ndarray, starts: np.ndarray, lengths: np.ndarray, out: np.ndarray, dest: np.ndarray) -> None:
    """Copy the spans of src at starts to out at dest, by index arrays."""
    total = int(lengths.sum())
    if not total:
        return
    within = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(dest, lengths) + within] = src[np.repeat(starts, lengths) + within]
