"""Rows of queries that SQL can't express, made again by plain Python."""

import heapq
import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tracewell.llm import language_id, quality_classifier, sharding
from tracewell.llm.queries import QUERIES


def read(sf_dir, name, *columns):
    return list(zip(*(pq.read_table(f"{sf_dir}/{name}.parquet").column(c).to_pylist() for c in columns), strict=True))


def gram_counts(text, s):
    """Hashes of 1- to 3-grams, sign by sign."""
    low = "".join(" " if c.isspace() else c for c in text.lower())
    signs = [ord(c) for i, c in enumerate(low) if not (c == " " and low[i - 1 : i] == " ")]
    out = Counter()
    for i in range(len(signs)):
        h = 0
        for n in range(min(s.longest, len(signs) - i)):
            h = (h + signs[i + n]) * 0x9E3779B1 & 0xFFFFFFFF
            h ^= h >> 15
            out[(h * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - s.bucket_bits)] += 1
    return out


def test_languages_of_the_whole_table(spark, sf_dir):
    s = language_id.Settings()
    rows = read(sf_dir, "documents", "doc_id", "text", "lang")
    model = language_id.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    learned = [(i, t, x) for i, t, x in rows if x is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    seen = Counter(b for _, t, _ in learned for b in gram_counts(t or "", s))
    assert np.allclose(model.idf, [math.log((1 + len(learned)) / (1 + seen[b])) + 1 for b in range(1 << s.bucket_bits)])
    got = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, sf_dir).collect()}
    assert set(got) == {i for i, _, _ in rows}
    for i, text, _ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
            continue
        x = {b: (1 + math.log(n)) * model.idf[b] for b, n in gram_counts(text, s).items()}
        size = math.sqrt(sum(v * v for v in x.values()))
        logits = [(sum(v / size * model.weights[b, k] for b, v in x.items()) + model.bias[k]) / model.temperature for k in range(len(model.languages))]
        p = [1 / sum(math.exp(other - one) for other in logits) for one in logits]
        assert got[i]["lang_pred"] == model.languages[int(np.argmax(p))] and math.isclose(got[i]["score"], max(p), rel_tol=1e-9)


@pytest.mark.parametrize("text,letters", [("½ ² ① 12", False), ("Ⅷ 🎉 १२", False), ("ª", True), ("日", True), ("1 é", True), ("́", False), ("", False)])
def test_only_letters_are_letters(text, letters):
    assert language_id.grams(pa.array([text, "x", None]), language_id.Settings()).lettered.tolist() == [letters, True, False]


def test_numbers_of_the_whole_table(sf_dir):
    texts = [t or "" for (t,) in read(sf_dir, "documents", "text")] + ["", "!", "a|b!", "Ü é\nx y\n\nx y\n"]
    signs = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    for text, got in zip(texts, quality_classifier.style(pa.array(texts)), strict=True):
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
        n, raw, lines = max(len(words), 1), text.encode(), text.split("\n")
        chars = max(sum(map(len, words)), 1)
        upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
        worded = [x for x in lines if x.strip(" \t\n\v\f\r")]
        lengths = [len(w.encode()) for w in words]
        plain = {0: math.log1p(len(words)), 1: math.log1p(n / len(lines)), 2: math.log1p(len(lines)), 3: sum(map(len, words)) / n, 4: upper / max(upper + lower, 1), 5: sum("0" <= c <= "9" for c in text) / chars, 6: sum(c in signs for c in text) / n, 7: sum(x <= 3 for x in lengths) / n, 8: sum(x >= 12 for x in lengths) / n, 9: sum(w[-1] in signs for w in words) / n, 10: (len(worded) - len(set(worded))) / len(lines), 14: sum(b >= 0xC0 for b in raw) / chars}
        assert np.allclose([got[k] for k in plain], list(plain.values()))
        assert np.allclose(got[15:], [math.sqrt(text.count(c) / n) for c in signs])


def test_scores_of_the_whole_table(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    m = quality_classifier.fit(docs, labels)
    rows = read(sf_dir, "documents", "doc_id", "text")
    x = quality_classifier.style(pa.array([t for _, t in rows]))
    # what is learned from all texts
    assert np.allclose(m.mean, x.mean(0)) and np.allclose(m.scale, x.std(0) + 1e-6)
    for k, edges in enumerate(m.edges):
        above = np.sort(x[x[:, k] > 0, k])
        assert edges[0] == 1e-12 and all(abs((above <= e).mean() - q) < 0.02 or (above == e).mean() > 0.01 for e, q in zip(edges[1:], quality_classifier._PLACES, strict=True) if len(above))
    got = {r["doc_id"]: r for r in QUERIES["op7_quality_classifier"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for (i, _), v in zip(rows, x, strict=True):
        value = m.bias + sum(np.clip((v - m.mean) / m.scale, -4, 4) * m.weights[: len(v)])
        for k, edges in enumerate(m.edges):
            value += m.weights[len(v) + 10 * k + sum(e <= v[k] for e in edges)]
        score = 1 / (1 + math.exp(-max(-40, min(40, value))))
        assert math.isclose(got[i]["score"], score, rel_tol=1e-6) and got[i]["predicted"] == (got[i]["score"] >= 0.7) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)


def differencing(weights, n):
    """Karmarkar and Karp on lists of groups, place by place."""
    heap = [(-w, i, [(w, [i])] + [(0, [])] * (n - 1)) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    serial = len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, reversed(b), strict=True)), key=lambda v: -v[0])
        least = both[-1][0]
        both = [(x - least, p) for x, p in both]
        heapq.heappush(heap, (-both[0][0], serial, both))
        serial += 1
    return [sorted(sum(weights[i] for i in p) for _, p in heap[0][2])] if heap else []


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_shards_of_the_whole_table(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = {i: t or "" for i, t in read(sf_dir, "documents", "doc_id", "text")}
    got = {r["doc_id"]: r for r in QUERIES["op9_sharding"](spark, sf_dir).collect()}
    assert set(got) == set(rows)
    shard, slots, group = Counter(), defaultdict(list), {}
    for i, text in rows.items():
        raw, r = text.encode(), got[i]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None) and 0 <= r["shard"] < 16
        assert group.setdefault(text, r["shard"]) == r["shard"]
        shard[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    weights = Counter()
    for text in rows.values():
        weights[text] += len(text.encode()) + 1
    best = differencing(sorted(weights.values(), reverse=True), 16)[0]
    assert max(shard.values()) - min(shard.values()) <= max(best[-1] - best[0], 2 + sum(shard.values()) // 2000)


def test_a_giant_group_is_alone(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id < 2000 THEN repeat('copy ', 40) ELSE concat(id, repeat('z', cast(id % 211 AS int))) END AS text")
    got = sharding.assign(docs).toPandas()
    giant = got[got["doc_id"] < 2000]["shard"].unique()
    assert len(giant) == 1 and set(got[got["shard"] == giant[0]]["doc_id"]) == set(range(2000))
    rest = got[got["shard"] != giant[0]].groupby("shard")["size"].sum()
    assert len(rest) == 15 and rest.max() - rest.min() <= 16
