"""Different words on which polynomial hashes modulo 2^64 agree, whatever their base."""

import pickle
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from tracewell.llm import decontamination, near_duplicates, packing, repetition
from tracewell.llm import textops as X
from tracewell.llm.tokens import Tokenizer

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


def thue_morse(n):
    """Two words of n letters, each the other with its letters swapped."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_queries_tell_them_apart(spark, n):
    a, b = thue_morse(n)
    few = " ".join(f"w{i}" for i in range(9))
    docs = spark.createDataFrame([(1, f"{few} {a}"), (2, f"{few} {b}"), (3, f"{a}\n{b}\n{few}"), (4, " ".join([a] * 20)), (5, " ".join([b] * 20))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, f"{few} {a}")], "item_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in decontamination.digest(docs, bench).collect()} == {1: 10, 2: 0, 3: 0, 4: 0, 5: 0}
    assert {r["doc_id"]: r["n_dup_lines"] for r in repetition.digest(docs).collect()} == dict.fromkeys(range(1, 6), 0)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates.classes(docs).collect()}[5] == 5
    made = Tokenizer(Path(VOCABULARY).read_text(encoding="utf-8")).made
    got = {}
    for r in packing.pieces(docs, VOCABULARY).collect():
        got.setdefault(r["doc_id"], {})[r["start"]] = r["ids"]
    for i, text in docs.collect():
        assert [x for s in sorted(got[i]) for x in got[i][s]] == [*made.encode(text, add_special_tokens=False).ids, 1]


def test_hashes_differ_by_place_length_and_end():
    words = [b"", b"\0", b"\0\0", b"a", b"a\0", b"ab", b"ba", b"abcdefgh", b"abcdefgh\0", b"abcdefghabcdefgi", b"abcdefgiabcdefgh", *(w.encode() for w in thue_morse(1 << 14))]
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    assert len(set(X.span_hashes(raw, starts, ends).tolist())) == len(words)
    other = np.frombuffer(b"x" + b"".join(words), np.uint8)
    assert X.same_spans(raw, starts, ends, other, starts + 1, ends + 1).all()
    for i in range(len(words)):
        same = X.same_spans(raw, np.full(len(words), starts[i]), np.full(len(words), ends[i]), raw, starts, ends)
        assert np.flatnonzero(same).tolist() == [i]


def test_long_spans_are_hashed_in_blocks(monkeypatch):
    r = np.random.default_rng(1)
    raw = r.integers(97, 100, 5000).astype(np.uint8)
    cut = np.sort(r.integers(0, 5000, 60))
    starts, ends = cut[:-1], cut[1:]
    whole = X.span_hashes(raw, starts, ends)
    other = raw.copy()
    other[cut[30]] += 1
    for block in (1, 3, 64):
        monkeypatch.setattr(X, "_BLOCK", block)
        assert (X.span_hashes(raw, starts, ends) == whole).all()
        same = X.same_spans(raw, starts, ends, other, starts, ends)
        assert same.sum() == 58 and X.same_spans(raw, starts, ends, raw, starts, ends).all()


def test_confirmation_does_not_rest_on_hashes(monkeypatch):
    """With a hash of two bits, pieces still get their own ids and windows are still met rightly."""
    full = X.span_hashes
    monkeypatch.setattr(X, "span_hashes", lambda *x: full(*x) & np.uint64(3))
    t = Tokenizer(Path(VOCABULARY).read_text(encoding="utf-8"))
    texts = ["the quick brown fox", "jumps over the lazy dog", "and the quick red fox, too"]
    for _ in range(2):
        ids, first = t.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [e.ids for e in t.made.encode_batch(texts, add_special_tokens=False)]
    b = decontamination.build_block(["i"], ["one two three four"], 4, 2)
    decontamination.choose_prefixes(b, np.arange(len(b.tokens)))
    said = ["zero one two three four five", "six seven eight nine ten eleven twelve", "one two three for", "four three two one"]
    start, _ = decontamination.find(*decontamination._split(pa.array(said)), b)
    assert start.tolist() == [1]


def test_a_block_of_a_megabyte_is_small():
    r = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 50_000, 120)) for _ in range(1500)]
    size = sum(map(len, texts))
    assert size > 1e6
    tracemalloc.start()
    b = decontamination.build_block([str(i) for i in range(len(texts))], texts, 10, 3)
    decontamination.choose_prefixes(b, np.zeros(len(b.tokens), np.int64))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    b.tokens = b.tokens[:0]
    assert most < 100 * size and len(pickle.dumps(b)) < 12 * size
