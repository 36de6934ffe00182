"""Pieces of texts are found on their bytes, and new ones reach the tokenizer many at once."""

import itertools
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tracewell.llm import tokens
from tracewell.llm.common import strings

VOCABULARY = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


class Counted:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, made):
        self.made, self.n = made, 0

    def encode_batch_fast(self, texts, **options):
        self.n += len(texts)
        return self.made.encode_batch_fast(texts, **options)


def said(t, texts):
    ids, first = t.encode(texts)
    return [ids[a:b].tolist() for a, b in itertools.pairwise(first)]


def test_new_pieces_are_not_a_string_each():
    r = random.Random(3)
    texts = [" ".join("".join(r.choices("abcdeéŕö", k=r.randint(3, 12))) for _ in range(200)) for _ in range(100)]
    t = tokens.Tokenizer(VOCABULARY)
    expect = [e.ids for e in t.made.encode_batch(texts, add_special_tokens=False)]
    counted = []
    for name in ("made", "merger"):
        if hasattr(t, name):
            counted.append(Counted(getattr(t, name)))
            setattr(t, name, counted[-1])
    assert said(t, texts) == expect
    assert sum(c.n for c in counted) < 50  # of nearly 20 000 pieces


def test_every_character_and_where_blocks_end(monkeypatch):
    r = random.Random(4)
    t = tokens.Tokenizer(VOCABULARY)
    each = [chr(c) for c in range(0x2A0)]
    texts = [*each, *(f"a{c}b {c}{c} '{c} 's{c}" for c in each), *("".join(r.choices([*each, "'ll", "'s", " ", "\n", "word"], k=20)) for _ in range(2000)), "é", "", "\n\n", "ɏ", "ɐ"]
    expect = [e.ids for e in t.made.encode_batch(texts, add_special_tokens=False)]
    for size, n in ((500_000, 2000), (700, 3), (1, 1)):
        monkeypatch.setattr(tokens, "_BYTES", size)
        monkeypatch.setattr(tokens, "_AT_ONCE", n)
        t._forget()
        assert said(t, texts) == expect


def test_arrow_columns_with_nulls_and_parts_of_them():
    t = tokens.Tokenizer(VOCABULARY)
    texts = ["über alles", None, "", "日本 und mehr", "the end é"]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts * 3, kind)
        for part in (column, column[2:9], column[5:5], column[1:3]):
            expect = [t.made.encode(x or "", add_special_tokens=False).ids for x in part.to_pylist()]
            assert said(t, strings(part)) == expect


def test_bytes_of_no_character_are_unsure():
    raw = np.frombuffer(b"a\xc3\xa9\xc3b\xa9\xc3\xa9", np.uint8)
    kind = tokens.byte_classes(raw, np.array([0, 7, len(raw)]))
    assert (kind == tokens._UNSURE).tolist() == [False, False, False, True, False, True, True, True]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokens.Tokenizer(VOCABULARY.replace('"add_prefix_space":false', '"add_prefix_space":true').replace('"add_prefix_space": false', '"add_prefix_space": true'))
