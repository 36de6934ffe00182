import corpus_pipeline
from test_text_filters import brute_components, near_copies

from tracewell.llm import near_duplicates


def union_kept(ids, texts):
    """The least id of each component of links of 3 words at 0.85 or 5 words at 0.8."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, percent in ((3, 85), (5, 80)):
        for i, (_, c) in brute_components(ids, texts, k, percent).items():
            a, b = find(i), find(c)
            root[max(a, b)] = min(a, b)
    return {i for i in ids if find(i) == i}


def test_stage_removes_five_word_copies_too(spark, sf_dir):
    long = " ".join(f"w{i}" for i in range(1000))
    texts = [long, long + "".join(f" x{i}" for i in range(200))] + near_copies(4, 5, 8, 90, 3) + near_copies(5, 5, 4, 60, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = union_kept(list(range(len(texts))), texts)
    kept = [r["doc_id"] for r in corpus_pipeline.near_duplicate_removal(spark, docs, sf_dir).collect()]
    assert 0 in kept and 1 not in kept
    assert len(kept) == len(expected) and set(kept) == expected


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    a, b = near_copies(6, 2, 2, 80, 1)[::2]
    c, d, e = f"{a} more", f"{b} more", f"{b} less"
    alone = " ".join(f"z{i}" for i in range(50))
    rows = [(1, a), (5, c), (5, alone), (7, d), (7, e), (7, d), (9, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in near_duplicates.one_of_each(docs).collect()]
    assert len(kept) == 3 and {(1, a), (5, alone)} < set(kept)
    assert [i for i, t in kept if t in (b, d, e)] == [7]
