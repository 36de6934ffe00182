import re

import corpus_pipeline
from test_text_filters import brute_components, brute_decontamination, brute_longest, space_words

from tracewell.llm import language_id, near_duplicates, quality_classifier, sharding
from tracewell.llm.common import table


def test_stages_against_brute_force(spark, sf_dir):
    """Each stage's documents are those that a plain version keeps of the same input; the last packs them all."""
    docs = table(spark, sf_dir, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    now = {r["doc_id"]: r["text"] for r in docs.collect() if len(r["text"]) < 4000}
    docs = docs.filter("length(text) < 4000")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        rows = out.collect()
        kept = {r["doc_id"]: r["text"] for r in rows}
        assert len(kept) == len(rows)
        if name == "quality_rules":
            expected = set()
            for i, t in now.items():
                w = space_words(t)
                best = brute_longest(w)
                hit = {p for a, m in enumerate(best) if m >= 5 for p in range(a, a + m)}
                if len(w) >= 10 and 100 * len(hit) <= 20 * len(w) and 100 * sum(len(w[p]) for p in hit) <= 30 * sum(map(len, w)) and max(best) <= 100:
                    expected.add(i)
        elif name == "language_id":
            df, r = language_id.mark(docs, keep=["doc_id"])
            expected = {x["doc_id"] for x in df.select("doc_id", f"{r}.*").collect() if x["lang_pred"] != "und" and x["score"] >= 0.3}
            assert len(expected) > 0.97 * len(now)
        elif name == "near_duplicates":
            found = brute_components(list(now), list(now.values()))
            expected = {i for i, (_, c) in found.items() if i == c}
            assert len(expected) < len(now)
        else:
            expected = {i for i, t in now.items() if not brute_decontamination(t, items, 10)[1]}
            assert len(expected) < len(now)
        assert set(kept) == expected, name
        docs, now = spark.createDataFrame(rows, docs.schema), kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).groupBy("doc_id", "doc_tokens").sum("length").collect()
    assert {r["doc_id"] for r in pieces} == set(now) and all(r["sum(length)"] == r["doc_tokens"] for r in pieces)
    assert re.match("packing", corpus_pipeline.STAGES[-1][0])


def test_messy_documents_go_through(spark, messy, sf_dir):
    docs = messy
    for _, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, sf_dir)
            out.count()
        docs = stage(spark, docs, sf_dir)
    assert docs.count() > 0


def test_run_gives_packed_rows(spark, sf_dir):
    df = corpus_pipeline.run(spark, sf_dir)
    assert df.count() > 100 and {"doc_id", "ids", "sequence_id"} <= set(df.columns)


def test_rows_without_an_id(spark, sf_dir):
    text = "these are words enough for a text that no rule of quality would ever want to reject"
    rows = [(None, text), (None, text), (1, text), (1, text), (None, None)] + [(i, f"{text} {i} in a number of further words {i * i}") for i in range(2, 40)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = near_duplicates.classes(docs).collect()
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)] * 3
    assert near_duplicates.one_of_each(docs).filter("doc_id is null").count() == 3
    assert {r["component_id"] for r in got if r["doc_id"] == 1} == {1}
    labels = spark.createDataFrame([(i, 1) for i in range(1, 40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    assert quality_classifier.digest(docs, labels).count() == language_id.digest(docs).count() == sharding.assign(docs).count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.filter("doc_id is null").count() > 0
