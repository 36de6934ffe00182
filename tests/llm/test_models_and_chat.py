import random

import numpy as np
import pytest

from tracewell.llm import chat, html_extraction, language_id, quality_classifier
from tracewell.llm.common import model_from_json, model_to_json


def test_models_can_be_kept(spark, sf_dir):
    docs, labels, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "pages"))
    one = language_id.fit(docs)
    two = model_from_json(language_id.Model, model_to_json(one))
    assert two.languages == one.languages and (two.weights == one.weights).all() and two.temperature == one.temperature
    df, r = language_id.mark(docs.drop("lang"), keep=["doc_id"], model=two)
    assert {x["doc_id"]: x[r]["lang_pred"] for x in df.collect()} == {x["doc_id"]: x["lang_pred"] for x in language_id.digest(docs).collect()}
    one = quality_classifier.fit(docs, labels)
    two = model_from_json(quality_classifier.Model, model_to_json(one))
    df, r = quality_classifier.mark(docs, labels.limit(0), keep=["doc_id"], model=two)
    said = {x["doc_id"]: x["score"] for x in quality_classifier.digest(docs, labels).collect()}
    assert all(np.isclose(x[r]["score"], said[x["doc_id"]]) for x in df.collect())
    one = html_extraction.made_up_model(30)
    two = model_from_json(html_extraction.Model, model_to_json(one))
    df, r = html_extraction.extract(pages, keep=["page_id"], model=two)
    other, q = html_extraction.extract(pages, keep=["page_id"], training_pages=30)
    assert {x["page_id"]: x[r]["text"] for x in df.collect()} == {x["page_id"]: x[q]["text"] for x in other.collect()}


def test_a_conversation_that_does_not_fit_says_so(monkeypatch):
    import pyarrow as pa

    turns = pa.RecordBatch.from_arrays([pa.array([1, 1]), pa.array(["user", "assistant"]), pa.array(["x" * 60, "y" * 60])], names=["conv_id", "role", "text"])
    assert list(chat._made([turns]))[0].num_rows == 1
    for most in (100, 150):  # beyond it before, and after roles and marks are added
        monkeypatch.setattr(chat, "_MOST", most)
        with pytest.raises(ValueError, match="2 GB"):
            list(chat._made([turns]))


def test_long_conversations_and_clashing_columns(spark):
    r = random.Random(1)
    long = "".join(r.choice(["<", "|", "\\", "a", "é", "\n"]) for _ in range(300_000))
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t} {long[: 1000 * t]}", "x", [t], t) for t in range(60)] + [(2, 0, "assistant", long, "y", [0], None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, loss_starts array<int>, n_turns int")
    got = {x["conv_id"]: x for x in chat.formatted(turns).collect()}
    assert chat.parse(got[1]["formatted"]) == [(a, b) for _, _, a, b, *_ in rows[:60]]
    assert chat.parse(got[2]["formatted"]) == [("assistant", long)] and len(got[1]["loss_starts"]) == 30
    assert {x["conv_id"]: x["n_turns"] for x in chat.digest(turns).collect()} == {1: 60, 2: 1, -1: 2}
