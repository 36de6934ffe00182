import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewell.llm import decontamination, near_duplicates, repetition
from tracewell.llm import textops as X
from tracewell.llm.graph import components


def random_texts(seed, n, vocabulary=12, most=60):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Ä", "é", "日"]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(r.randint(0, most)):
            text += r.choice(words) + r.choice([" ", " ", "  ", "\n", "\t", ", "])
        out.append(text)
    return out


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# words


def test_words_and_hashes_agree_with_patterns():
    texts = random_texts(1, 200) + ["", "a", "ab" * 9, "x" * 70_000 + " y"]
    raw, offs = X.byte_view(pa.array(texts))
    for kind, pattern in (("space", r"[^\x20\x09-\x0D]+"), ("alnum", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        starts, ends, first = X.words(raw, offs, kind)
        got = [bytes(raw[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
        assert got == [w for t in texts for w in re.findall(pattern, t)]
        assert np.diff(first).tolist() == [len(re.findall(pattern, t)) for t in texts]
        h = X.span_hashes(raw, starts, ends)
        assert len(set(h.tolist())) == len(set(got)) == len(set(zip(got, h.tolist(), strict=True)))


def test_words_end_with_their_row():
    raw, offs = X.byte_view(pa.array(["ab", "cd", "", "ef gh"]))
    starts, ends, first = X.words(raw, offs, "space")
    assert [bytes(raw[a:b]) for a, b in zip(starts, ends, strict=True)] == [b"ab", b"cd", b"ef", b"gh"] and first.tolist() == [0, 1, 2, 2, 4]


# decontamination


def brute_decontamination(text, items, size):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit, met = set(), set()
    for item, said in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (said or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(size, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                met.add(item)
    return len(words), len(hit), sorted(met, key=str)


@pytest.mark.parametrize("size,block_bytes", [(10, 1 << 20), (3, 1 << 20), (4, 900), (1, 1 << 20)])
def test_decontamination_is_exact(spark, size, block_bytes):
    texts = [*random_texts(2, 60, 6, 40), None, "", "w1"]
    items = [(i, t) for i, t in enumerate([*random_texts(3, 12, 6, 14), None, "", "W1 w2", "w3", "w3"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    df, r = decontamination.mark(docs, bench, size=size, block_bytes=block_bytes)
    for row in df.select("doc_id", f"{r}.*").collect():
        n, hit, met = brute_decontamination(texts[row["doc_id"]], items, size)
        assert (row["n_words"], row["n_hit"], row["items"]) == (n, hit, sorted(map(str, met)))


def test_prefix_is_the_rarest_shingle():
    b = decontamination.build_block(["a"], ["common words here then something rare at the very end now"], 10, 3)
    counts = np.arange(len(b.tokens), 0, -1)
    decontamination.choose_prefixes(b, counts)
    for w in range(len(b.length)):
        mine = b.shingle[w][b.shingle[w] != 0]
        assert counts[np.searchsorted(b.tokens, mine)].min() in counts[np.searchsorted(b.tokens, b.prefix)]


def test_decontamination_of_messy_rows(messy, none, spark):
    bench = spark.createDataFrame([(1, "brown fox jumps over the lazy dog and runs far"), (1, "brown fox jumps over the lazy dog and runs far"), (2, None)], "item_id long, text string")
    left = decontamination.decontaminate(messy, bench)
    assert left.columns == messy.columns and sorted(r["doc_id"] for r in left.select("doc_id").collect()) == [1, 2, 3, 4, 5, 6, 9, 10]
    assert decontamination.decontaminate(messy, bench.limit(0)).count() == messy.count()
    assert decontamination.digest(none, bench).count() == 0


# repetition


def brute_longest(words):
    n, best = len(words), [0] * len(words)
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                best[i] = max(best[i], k)
    return best


def test_longest_repeats_are_exact():
    texts = [*random_texts(4, 60, 2, 50), "a " * 40, "", "a b", "a b a b a b c"]
    raw, offs = X.byte_view(pa.array(texts))
    starts, ends, first = X.words(raw, offs, "space")
    got = repetition.longest_repeats(X.span_hashes(raw, starts, ends), first)
    assert got.tolist() == [x for t in texts for x in brute_longest(space_words(t))]


def test_repetition_counts_and_maximal_spans():
    texts = random_texts(5, 80, 3, 60) + ["same line here\nsame line here\n\nother | #\nsame line here", ""]
    out = [np.asarray(x) if i < 7 else x.to_pylist() for i, x in enumerate(repetition.measure(pa.array(texts), 5))]
    for k, t in enumerate(texts):
        w = space_words(t)
        best = brute_longest(w)
        covered = {p for i, m in enumerate(best) if m >= 5 for p in range(i, i + m)}
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        assert covered == {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
        lines = [x for x in t.split("\n") if space_words(x)]
        assert [int(out[i][k]) for i in range(7)] == [len(w), sum(map(len, w)), sum(c in repetition.SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered), sum(len(w[p]) for p in covered), max(best, default=0)]
        spans = list(zip(out[7][k], out[8][k], strict=True))
        assert {p for a, b in spans for p in range(a, b)} == covered
        assert all(not (a <= c and d <= b) for a, b in spans for c, d in spans if (a, b) != (c, d))


def test_verdicts_of_messy_rows(messy, none):
    df, r = repetition.mark(messy, keep=["doc_id"])
    got = {x["doc_id"]: (x["base_failed"], x["kept"]) for x in df.select("doc_id", f"{r}.*").collect()}
    assert got[1] == got[2] == got[5] == (True, False) and got[7] == got[6] == (False, True)
    left = repetition.passing(messy)
    assert left.columns == messy.columns and left.count() == 4
    assert repetition.passing(none).count() == 0


def test_one_long_repeat_is_rejected_though_little_of_the_text(spark):
    r = random.Random(1)
    fresh = lambda n: " ".join(str(r.random()) for _ in range(n))
    passage = fresh(120)
    docs = spark.createDataFrame([(1, f"{fresh(2000)} {passage} {fresh(300)} {passage}"), (2, fresh(2500))], "doc_id long, text string")
    assert {x["doc_id"]: x["kept"] for x in repetition.digest(docs).collect()} == {1: False, 2: True}


# near duplicates


def brute_components(ids, texts, k=3, percent=85):
    sets = []
    for t in texts:
        w = space_words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(k, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = dict(zip(ids, ids, strict=True))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(ids[i]), find(ids[j])
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets, strict=True)}


def near_copies(seed, groups, copies, words, edits):
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"g{g}w{r.randint(0, 10**6)}" for _ in range(words)]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(len(w))] = str(r.randint(0, 10**6))
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("settings", [near_duplicates.Settings(), near_duplicates.Settings(small=2, block_sets=16)])
def test_near_duplicates_are_exact(spark, settings):
    texts = near_copies(1, 6, 25, 90, 9) + near_copies(2, 3, 3, 4, 1) + ["", None, "a", "a", "A", "a b", "a b c", "  a  b c "]
    ids = [7 * i % 1009 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.classes(docs, settings=settings).collect()}
    assert got == brute_components(ids, texts)


def test_estimates_are_close():
    s = near_duplicates.Settings()
    r = np.random.default_rng(3)
    x = r.integers(0, 2**63, 4000).astype(np.uint64)
    sets = [np.sort(x[:2000]), np.sort(x[200:2200])]
    low = near_duplicates.minhash(np.concatenate(sets), np.array([0, 2000, 4000]), s.minima)
    sig = near_duplicates.pack(low)
    assert near_duplicates.match_counts(sig[0], sig[0]) == 128
    assert abs(near_duplicates.estimate(near_duplicates.match_counts(sig[0], sig[1]), s) - 1800 / 2200) < 0.12
    assert 0.6 < s.least_estimate < 0.7


def test_one_of_each_messy(messy, none):
    left = near_duplicates.one_of_each(messy)
    assert left.columns == messy.columns and sorted(r["doc_id"] for r in left.select("doc_id").collect()) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert near_duplicates.classes(none).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (5, 5)] + [(100, 101 + i) for i in range(30)] + [(200 + i, 201 + i) for i in range(40)], "u long, v long")
    got = dict(components(edges).collect())
    assert all(got[i] == 1 for i in (1, 2, 3, 7, 8, 9)) and got[21] == 20 and all(got[101 + i] == 100 for i in range(30)) and all(got[i] == 200 for i in range(200, 241))
    assert components(edges.filter(F.lit(False))).count() == 0
