"""Near duplicates where a third of all rows are copies of one text, and all rows share a passage."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_text_filters import brute_components, near_copies

from tracewell.llm import near_duplicates

SHARED = [f"b{i}" for i in range(30)]


def texts(rows, copies):
    r = random.Random(5)
    out = []
    base = [f"h{i}" for i in range(60)]
    for _ in range(copies):
        w = list(base)
        for _ in range(r.randint(0, 2)):
            w[r.randrange(60)] = f"e{r.randint(0, 10**9)}"
        out.append(w)
    while len(out) < rows:
        body = [f"u{r.randint(0, 10**9)}" for _ in range(60)]
        for k in range(r.choice([1, 1, 1, 1, 3, 8])):
            out.append(body if not k else [w if r.random() > 0.02 else f"x{r.randint(0, 10**9)}" for w in body])
    return [" ".join(SHARED + w) for w in out[:rows]]


def components_by_shared_shingles(said):
    """Exact: overlaps are counted over postings; what all texts share is added, as it is the same for each."""
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in said)]
    common = set.intersection(*sets)
    numbers, postings = {}, defaultdict(list)
    own = [np.array([numbers.setdefault(g, len(numbers)) for g in s - common]) for s in sets]
    for i, s in enumerate(own):
        for g in s.tolist():
            postings[g].append(i)
    postings = {g: np.array(x) for g, x in postings.items() if len(x) > 1}
    root = list(range(len(said)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    n = np.array([len(s) for s in sets])
    for i, s in enumerate(own):
        met = [postings[g] for g in s.tolist() if g in postings]
        if not met:
            continue
        both = np.bincount(np.concatenate(met), minlength=len(said)) + len(common)
        j = np.flatnonzero((both > len(common)) & (100 * both >= 85 * (n[i] + n - both)))
        for x in j[j < i].tolist():
            a, b = find(i), find(x)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(said))]


def test_twenty_thousand_rows(spark, monkeypatch):
    said = texts(20_000, 7_000)
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").repartition(8)
    seen = []
    whole = near_duplicates._still_apart

    def counted(hot, labels, reps, s):
        found = whole(hot, labels, reps, s)
        seen.append((hot.count(), found.count()))
        return found

    monkeypatch.setattr(near_duplicates, "_still_apart", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.classes(docs).collect()}
    expected = components_by_shared_shingles(said)
    assert [got[i] for i in range(len(said))] == expected
    ((hot, copies),) = seen
    # rows in hot buckets are many; sets are copied for few of them, and not once for each pair
    assert hot > 20_000 and copies < 2000
    assert max(Counter(expected).values()) > 6000


@pytest.mark.parametrize("settings", [near_duplicates.Settings(small=2, block_sets=16, chunk=8, reach=2, chosen=1, hubs=1), near_duplicates.Settings(small=0, block_sets=4, reach=0, hubs=0), near_duplicates.Settings(shingle=5, percent=80, bands=28, small=2, block_sets=8)])
def test_hot_path_alone_is_exact(spark, settings):
    """However little the first pairs link, what is left is found in blocks."""
    said = near_copies(11, 4, 30, 70, 8) + near_copies(12, 4, 6, 40, 3) + ["a b c", "a b c d", "", None]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.classes(docs, settings=settings).collect()}
    assert got == brute_components(list(range(len(said))), said, settings.shingle, settings.percent)


def test_pairs_of_neighbours_are_few():
    s = near_duplicates.Settings(reach=3)
    sig = np.zeros((6, 8), np.uint64)
    run, n = np.array([0, 0, 0, 0, 1, 1]), np.array([100, 100, 10, 100, 100, 100])
    assert near_duplicates.nearest_alike(run, n, sig, s).tolist() == [-1, 0, -1, 1, -1, 4]


def test_the_hub_is_what_most_are_like():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 8).astype(np.uint64)
    rows = np.repeat(base[None], 40, 0)
    for i in range(40):
        if i != 17:
            for k in r.integers(0, 128, 9):  # each differs from the base in a few places, and from others in twice as many
                rows[i, k // 16] ^= np.uint64(1 + i % 15) << np.uint64(4 * (k % 16))
    other = r.integers(0, 2**63, (3, 8)).astype(np.uint64)
    got = near_duplicates.hub_of(np.full(43, 100), np.concatenate([rows, other]), near_duplicates.Settings())
    assert got[17] == -1 and (np.delete(got[:40], 17) == 17).all() and (got[40:] == -1).all()


def test_a_hubs_edges_do_not_meet_in_one_task(spark):
    from tracewell.llm import graph

    edges = spark.range(1, 30_000).selectExpr("id as u", "case when id % 7 = 0 then id - 1 else 0 end as v")
    got = graph.components(edges)
    assert got.count() == 30_000 and got.filter("component <> 0").count() == 0
    both = graph._stars(edges, True, 4, 1000)
    plan = both._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
