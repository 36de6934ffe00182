"""Byte-level BPE ids of Arrow text columns, with a tokenizer file that is a parameter and is never trained here.

A byte-level BPE splits a text into pieces by a fixed pattern and merges within each piece alone, so equal pieces have
equal ids.  Pieces of texts in Latin script are found with numpy on their UTF-8 bytes and only those not met before go
to the tokenizer's model, thousands in one string, without its pattern; texts with any other character go to the
tokenizer whole.  Both ways give the tokenizer's own ids: a piece is taken for one met before only if their bytes agree.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tracewell.llm import textops as X

_SLOT_BITS = 20
_MOST_PIECES = 500_000
_BYTES = 500_000
_AT_ONCE = 2000
_LATIN = 0x250
_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point below _LATIN; controls and odd spaces are left to the tokenizer."""
    out = np.full(_LATIN + 1, _UNSURE, np.int8)
    for c in range(_LATIN):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LN":
            out[c] = _LETTER if kind[0] == "L" else _NUMBER
        elif 0x20 < c < 0x7F or 0xA1 <= c and c != 0xAD:
            out[c] = _OTHER
    out[[0x09, 0x0A, 0x0D, 0x20]] = _SPACE
    return out


@lru_cache(1)
def _alphabet() -> np.ndarray:
    """The characters that stand for bytes in vocabularies of byte-level BPE; none is a line feed."""
    own = np.r_[0x21:0x7F, 0xA1:0xAD, 0xAE:0x100]
    out = np.zeros(256, np.uint32)
    out[own] = own
    rest = np.setdiff1d(np.arange(256), own)
    out[rest] = 256 + np.arange(len(rest))
    return out


def byte_classes(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class of the character that each byte belongs to, in UTF-8 texts that begin at first (one entry more than texts).

    Bytes of characters from _LATIN on, and those of no whole character, are _UNSURE.
    """
    of = _classes()
    ascii_only = np.full(256, _UNSURE, np.int8)
    ascii_only[:128] = of[:128]
    kind = ascii_only[raw]
    lead = np.flatnonzero((raw[:-1] >= 0xC2) & (raw[:-1] <= 0xC9))  # of two bytes, below 0x280
    if len(lead):
        begin = np.zeros(len(raw) + 1, bool)
        begin[first] = True
        lead = lead[(raw[lead + 1] & 0xC0 == 0x80) & ~begin[lead + 1]]
        cp = (raw[lead] & 0x1F).astype(np.int64) << 6 | raw[lead + 1] & 0x3F
        kind[lead] = kind[lead + 1] = of[np.minimum(cp, _LATIN)]
    return kind


def piece_starts(raw: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes, of these classes, of Latin-script texts that begin at first (one entry more than texts).

    Pieces: 's 't 'm 'd 're 've 'll; a run of letters, of numbers, or of other signs, each with one space before it;
    white space, less the last one where something follows.
    """
    n = len(raw)
    begin = np.zeros(n + 1, bool)
    begin[first] = True
    space, blank = kind == _SPACE, raw == 0x20
    before_space = np.concatenate([[False], space[:-1]]) & ~begin[:-1]
    before_blank = np.concatenate([[False], blank[:-1]]) & ~begin[:-1]
    changes = np.concatenate([[True], kind[1:] != kind[:-1]]) | begin[:-1]
    after_word = np.concatenate([~space[1:], [False]]) & ~begin[1:]
    start = np.where(space, ~before_space | after_word, ~before_blank & (changes | before_space)) | begin[:-1]
    quote = np.flatnonzero((raw == 0x27) & start)
    if len(quote):
        padded = np.concatenate([raw, np.zeros(2, raw.dtype)])
        end = first[np.searchsorted(first, quote, side="right")]
        a, b = padded[quote + 1].astype(np.int64), padded[quote + 2].astype(np.int64)
        one = (quote + 1 < end) & np.isin(a, [ord(c) for c in "stmd"])
        two = (quote + 2 < end) & np.isin(a * 128 + b, [ord(x) * 128 + ord(y) for x, y in ("re", "ve", "ll")]) & (a < 128) & (b < 128)
        size = np.where(one, 2, np.where(two, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        rest = quote + size
        start[rest[rest < n]] = True
    return np.flatnonzero(start)


class Tokenizer:
    """Ids of texts.  Keeps the ids of up to _MOST_PIECES pieces, then begins anew."""

    def __init__(self, source: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Made
        from tokenizers import pre_tokenizers

        self.made = Made.from_str(source)
        self.made.encode_special_tokens = True  # their strings in a text are ordinary text
        own, model, vocabulary = self.made.pre_tokenizer, self.made.model, self.made.get_vocab(with_added_tokens=False)
        plain = isinstance(own, pre_tokenizers.ByteLevel) and own.use_regex and not own.add_prefix_space and self.made.normalizer is None
        if not plain or model.continuing_subword_prefix or model.end_of_word_suffix or any(chr(c) not in vocabulary for c in _alphabet()):
            raise ValueError("not a plain byte-level BPE")
        self.merger = Made(model)  # the same model, on pieces that are in its alphabet already
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.id_bytes[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.at = np.full(1 << _SLOT_BITS, -1, np.int64)
        self.known, self.known_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes, ascending, and pieces' numbers
        self.pool = np.zeros(1 << 20, np.uint32)
        self.begin = np.zeros(1 << 16, np.int64)
        self.used = 0
        self.said = np.zeros(1 << 20, np.uint8)  # the pieces' bytes
        self.said_begin = np.zeros(1 << 16, np.int64)
        self.said_used = 0

    def _merged(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces end to end, how many each has), by the model."""
        parts = []
        for lo in range(0, len(starts), _AT_ONCE):
            begin, sizes = starts[lo : lo + _AT_ONCE], (ends - starts)[lo : lo + _AT_ONCE]
            dest = np.cumsum(sizes + 1) - sizes - 1
            said = np.zeros(int(sizes.sum()) + len(sizes), np.uint8)
            X.gather(raw, begin, sizes, said, dest)
            letters = _alphabet()[said]
            letters[dest + sizes] = 0x0A
            made = self.merger.encode_batch_fast([letters.tobytes().decode("utf-32-le")], add_special_tokens=False)
            parts.append(np.array(made[0].ids, np.uint32))
        ids = np.concatenate([np.zeros(0, np.uint32), *parts])
        stop = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum(ends - starts)) + 1  # no id reaches over a piece's end
        return ids, np.diff(stop, prepend=0)

    def _grow(self, flat: np.ndarray, sizes: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> int:
        """Adds pieces of so many ids each, returns the number of the first."""
        first = len(self.known)
        long = ends - starts
        while self.said_used + int(long.sum()) > len(self.said):
            self.said = np.concatenate([self.said, np.zeros_like(self.said)])
        while first + len(sizes) + 1 > len(self.said_begin):
            self.said_begin = np.concatenate([self.said_begin, np.zeros_like(self.said_begin)])
        self.said_begin[first + 1 : first + 1 + len(sizes)] = self.said_used + np.cumsum(long)
        X.gather(raw, starts, long, self.said, self.said_begin[first : first + len(sizes)])
        self.said_used += int(long.sum())
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while first + len(sizes) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.begin[first + 1 : first + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.used += len(flat)
        return first

    def _pieces(self, raw: np.ndarray, kind: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > _MOST_PIECES:
            self._forget()
        starts = piece_starts(raw, kind, first)
        ends = np.append(starts[1:], len(raw))
        h = X.span_hashes(raw, starts, ends)
        slot = (h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        which = np.where(self.key[slot] == h, self.at[slot], -1)
        miss = np.flatnonzero(which < 0)
        if len(miss):
            u, one, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            place = np.searchsorted(self.known, u)
            new = np.flatnonzero(self.known[np.minimum(place, len(self.known) - 1)] != u) if len(self.known) else np.arange(len(u))
            if len(new):
                at = miss[one[new]]
                first_new = self._grow(*self._merged(raw, starts[at], ends[at]), raw, starts[at], ends[at])
                self.known, self.known_at = np.insert(self.known, place[new], u[new]), np.insert(self.known_at, place[new], first_new + np.arange(len(new)))
            found = self.known_at[np.searchsorted(self.known, u)]
            which[miss] = found[inverse]
            into = (u >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
            self.key[into], self.at[into] = u, found
        size = self.begin[which + 1] - self.begin[which]
        other = np.flatnonzero(~X.same_spans(raw, starts, ends, self.said, self.said_begin[which], self.said_begin[which + 1]))
        own, size[other] = self._merged(raw, starts[other], ends[other])
        ids = np.empty(int(size.sum()), np.uint32)
        dest = np.cumsum(size) - size
        held = np.ones(len(size), bool)
        held[other] = False
        X.gather(self.pool, self.begin[which[held]], size[held], ids, dest[held])
        X.gather(own, np.cumsum(size[other]) - size[other], size[other], ids, dest[other])
        total = np.append(dest, len(ids))
        return ids, total[np.searchsorted(starts, first)]

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, where each text's begin); texts, without nulls, go through _BYTES bytes at a time."""
        said, offs = X.byte_view(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        parts, sizes, lo = [], np.zeros(len(texts), np.int64), 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + _BYTES, side="right")) - 1)
            raw, first = said[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            kind = byte_classes(raw, first)
            bad = kind == _UNSURE
            whole = {}
            if bad.any():
                unsure = X.per_row(bad, first) > 0
                at = np.flatnonzero(unsure)
                made = self.made.encode_batch_fast([raw[first[i] : first[i + 1]].tobytes().decode() for i in at], add_special_tokens=False)
                whole = {int(i): np.array(e.ids, np.uint32) for i, e in zip(at, made, strict=True)}
                plain = np.repeat(~unsure, np.diff(first))
                raw, kind, first = raw[plain], kind[plain], np.concatenate([[0], np.cumsum(np.where(unsure, 0, np.diff(first)))])
            ids, at = self._pieces(raw, kind, first) if len(raw) else (np.zeros(0, np.uint32), np.zeros(hi - lo + 1, np.int64))
            for i in range(hi - lo) if whole else ():
                parts.append(whole.get(i, ids[at[i] : at[i + 1]]))
                sizes[lo + i] = len(parts[-1])
            if not whole:
                parts.append(ids)
                sizes[lo:hi] = np.diff(at)
            lo = hi
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum(sizes)])


@lru_cache(2)
def tokenizer(source: str) -> Tokenizer:
    """One for each Python worker and file."""
    return Tokenizer(source)
