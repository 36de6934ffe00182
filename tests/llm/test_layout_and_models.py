import gzip
import hashlib
import itertools
import json
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from tracewell.llm import chat, dom, html_extraction, labelled_pages, language_id, packing, quality_classifier, sharding, warc
from tracewell.llm.tokens import Tokenizer

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


# packing


def test_tokens_are_the_tokenizers_own():
    t = Tokenizer(Path(VOCABULARY).read_text(encoding="utf-8"))
    r = random.Random(5)
    signs = ["'", "'s", "'re", "'ll", "'t", " ", "  ", "\n", "\t", "\r\n", "a", "b", "S", "é", "ß", "²", "1", "22", "½", ".", "!!", "<|endoftext|>", "日", "\xad", "’", "\x85", "\xa0", "́", "''", "\U0001f600"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 14))) for _ in range(5000)] + ["", "x" * 5000]
    for _ in range(2):  # the second time from memory
        ids, first = t.encode(texts)
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(first)] == [e.ids for e in t.made.encode_batch(texts, add_special_tokens=False)]
    assert 50256 not in ids


def test_pieces_rebuild_documents(spark, messy):
    got = packing.pieces(messy, VOCABULARY, most=64).collect()
    made = Tokenizer(Path(VOCABULARY).read_text(encoding="utf-8")).made
    assert len({r["sequence_id"] for r in got}) == len(got)
    for r in got:
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 64 and r["offset"] == 0 and 2 ** r["bucket"] == r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    for doc, text in messy.select("doc_id", "text").distinct().collect():
        mine = sorted((r for r in got if r["doc_id"] == doc), key=lambda r: (r["start"], r["sequence_id"]))
        ids = [*made.encode(text or "", add_special_tokens=False).ids, 1]
        n = sum(r["length"] for r in mine) // len(ids)
        assert n == (2 if doc == 7 else 1)
        at = {r["start"]: r["ids"] for r in mine}
        assert [i for s in sorted(at) for i in at[s]] == ids and all(r["doc_tokens"] == len(ids) for r in mine)


def test_decomposition():
    doc, start, length = packing.decompose(np.array([1, 4097, 2048, 7]), 2048)
    assert list(zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)) == [(0, 0, 1), (1, 0, 2048), (1, 2048, 2048), (1, 4096, 1), (2, 0, 2048), (3, 0, 4), (3, 4, 2), (3, 6, 1)]
    with pytest.raises(ValueError):
        packing.pieces(None, VOCABULARY, most=100)


def test_buckets_on_disk(spark, messy, none, tmp_path):
    packing.write_buckets(packing.pieces(messy, VOCABULARY), f"{tmp_path}/b")
    assert {p.name for p in (tmp_path / "b").glob("bucket=*")} >= {"bucket=0", "bucket=11"}
    assert packing.pieces(none, VOCABULARY).count() == 0


# sharding


def test_differencing_beats_greedy_and_keeps_all():
    r = random.Random(2)
    for n in (2, 3, 16):
        weights = sorted((r.randint(1, 10**6) for _ in range(300)), reverse=True)
        sums = [0] * n
        for w, p in zip(weights, sharding.karmarkar_karp(weights, n), strict=True):
            sums[p] += w
        greedy = [0] * n
        for w in weights:
            greedy[greedy.index(min(greedy))] += w
        assert sum(sums) == sum(weights) and max(sums) - min(sums) <= max(greedy) - min(greedy)
    assert sharding.karmarkar_karp([8, 7, 6, 5, 4], 2) == [1, 0, 1, 0, 0]  # 7 + 5 + 4 against 8 + 6, as worked by hand
    assert sharding.karmarkar_karp([], 4) == [] and sharding.karmarkar_karp([5], 4) == [0]


def test_shards_keep_groups_and_number_rows(spark, messy, none):
    docs = messy.select("doc_id", "text").unionByName(spark.range(100, 2100).selectExpr("id AS doc_id", "repeat('x', cast(id % 97 AS int)) AS text")).repartition(7)
    got = sharding.assign(docs).toPandas()
    assert len(got) == 2011 and set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert (got.groupby(["text_crc32", "size"])["shard"].nunique() == 1).all()
    assert set(got.loc[got["doc_id"].isin([1, 2]), "size"]) == {1}
    assert sharding.assign(none).count() == 0


def test_balance_without_large_groups(spark):
    got = sharding.assign(spark.range(3000).selectExpr("id AS doc_id", "concat(id, repeat('y', cast(id % 311 AS int))) AS text")).groupBy("shard").sum("size").toPandas()["sum(size)"]
    assert len(got) == 16 and got.max() - got.min() <= 4


# chat


@pytest.mark.parametrize("text", ["", "<|", "a<|b", "<\\|", "<\\\\|x", "<<|>|", "\\<|im_end|>\\", "é<|日", "<\\", "<"])
def test_escapes_are_reversible(text):
    raw, offs = chat.X.byte_view(pa.array(["<", text, "|x", text]))
    made, at = chat.escape_bytes(raw, offs)
    parts = [bytes(made[a:b]).decode() for a, b in itertools.pairwise(at)]
    assert "<|" not in parts[1] and [chat.unescape(p) for p in parts] == ["<", text, "|x", text]


def test_conversations_read_back(spark):
    r = random.Random(9)
    rows = []
    for c in [None, *range(60)]:
        for t in range(r.randint(1, 40)):
            rows.append((c, t, r.choice(["user", "assistant", "system", None, "a\nb\\", "<|x"]), r.choice([None, "", "hi", "<|im_end|>\n", "<\\|", "日本 é", "x" * 3000])))
    rows += rows[:5]
    r.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x["conv_id"]: x for x in chat.formatted(turns).collect()}
    said = {x["conv_id"]: x for x in chat.digest(turns).collect()}
    assert len(got) == 61 and -1 in said
    for c, x in got.items():
        mine = sorted((t, role or "", text or "") for k, t, role, text in rows if k == c)
        assert chat.parse(x["formatted"]) == [(a, b) for _, a, b in mine]
        loss = [chat.unescape(x["formatted"][a:b]) for a, b in zip(x["loss_starts"], x["loss_ends"], strict=True)]
        assert loss == [b for _, a, b in mine if a == "assistant"]
        d = said[c]
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in mine).encode()).hexdigest()
        assert (d["n_turns"], d["loss_chars"], d["formatted_chars"]) == (len(mine), len("".join(loss)), len(x["formatted"]))
    assert chat.formatted(turns.limit(0)).count() == 0


# web archives


def test_records_round_trip_through_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/?x=1\r\nX: y", "<html><head><title>t</title></head><body><p>Hello &amp; wörld</p><script>no</script>\r\n\r\n<p>two"), (2, None, None), (2, None, None), (3, "http://c/", "")], "page_id long, url string, html string")
    derived = warc.derivatives(warc.responses(pages), keep=["page_id"])
    rows = derived.collect()
    assert len(rows) == 8 and all(r["digests_hold"] and r["http_status"] == 200 for r in rows)
    warc.write(derived, f"{tmp_path}/w")
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("part-*.gz")))
    records = list(warc.parse(raw))
    assert len(records) == 8 and {r.get("WARC-Type") for r in records} == {"metadata", "conversion"}
    sources = {s.get("WARC-Record-ID"): s for (raw_,) in warc.responses(pages).select("record").collect() for s in warc.parse(raw_)}
    for r in records:
        source = sources[r.get("WARC-Refers-To")]
        assert r.get("WARC-Target-URI") == source.get("WARC-Target-URI") and r.get("WARC-Date") == source.get("WARC-Date")
        assert warc.digest_of(r.block) == r.get("WARC-Block-Digest") and int(r.get("Content-Length")) == len(r.block)
        if r.get("WARC-Type") == "metadata":
            said = json.loads(r.block)
            assert [tuple(h) for h in said["source"]["warc-headers"]] == source.headers and said["source"]["payload-digest"] == source.get("WARC-Payload-Digest")
            linked = next(x for x in records if x.get("WARC-Record-ID") == said["conversion"]["record-id"])
            assert linked.get("WARC-Block-Digest") == said["conversion"]["block-digest"]
    text = next(r.block.decode() for r in records if r.get("WARC-Type") == "conversion" and r.block)
    assert text == "Hello & wörld\ntwo"


def test_archives_are_read_member_by_member(spark, tmp_path):
    made = [warc.response(i, f"http://x/{i}", f"<p>{i}\r\n\r\nWARC/1.1 no", "2020-01-01T00:00:00Z") for i in range(3)]
    info = warc.Record([("WARC-Type", "warcinfo"), ("Content-Length", "2")], b"hi")
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(warc.serialise(r) + b"\r\n\r\n") for r in [info, *made]) + b"junk")
    (tmp_path / "b.warc").write_bytes(b"".join(warc.serialise(r) + b"\r\n\r\n" for r in made))
    records = warc.read(spark, str(tmp_path))
    assert records.count() == 7
    assert warc.derivatives(records).count() == 12


def test_http_bodies_are_decoded():
    body = gzip.compress("<p>é</p>".encode("latin-1"))
    chunked = b"%x\r\n" % len(body) + body + b"\r\n0\r\n\r\n"
    block = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=ISO-8859-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked
    http = warc.Http.of(block)
    assert http.status == 404 and warc.plain_text(http) == "é"
    assert warc.plain_text(warc.Http.of(b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x00")) is None
    damaged = warc.Record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>"), ("WARC-Block-Digest", "sha1:WRONG")], block)
    assert [m["digests_hold"] for _, m in warc.derive(damaged)] == [False, False]
    assert warc.derive(warc.Record([("WARC-Type", "request")], b"")) == [] and list(warc.parse(b"")) == []


# pages


@pytest.fixture(scope="module")
def page_model():
    return html_extraction.fit(labelled_pages.pages(300))


def test_sum_product_is_exact(page_model):
    r = np.random.default_rng(1)
    trees = [dom.read(p) for p in ("<div><p>a</p><p>b</p></div><ul><li>c</li></ul>", "<p>x", "")]
    f = html_extraction.Forest.of(trees, page_model.known)
    unary, pair = r.normal(size=len(page_model.known)), r.normal(size=page_model.pair.shape)
    marginal, joint, z = html_extraction.sum_product(f, unary, pair)
    score = np.bincount(f.feature_node, weights=unary[f.feature], minlength=len(f.parent))
    total, one, two = 0.0, np.zeros(len(f.parent)), np.zeros((len(f.parent), 2, 2))
    for y in itertools.product((0, 1), repeat=len(f.parent)):
        w = np.exp(sum(score[i] * y[i] + (pair[f.kind[i], y[p], y[i]] if p >= 0 else 0) for i, p in enumerate(f.parent)))
        total += w
        one += w * np.array(y)
        for i, p in enumerate(f.parent):
            two[i, y[p], y[i]] += w * (p >= 0)
    assert np.isclose(np.log(total), z) and np.allclose(one / total, marginal[:, 1])
    inner = f.parent >= 0
    assert np.allclose((two / total)[inner], joint[inner])


def test_unseen_labelled_pages(page_model):
    trees = [dom.read(p) for p in labelled_pages.pages(150, seed=99)]
    f = html_extraction.Forest.of(trees, page_model.known)
    marginal, _, _ = html_extraction.sum_product(f, page_model.unary, page_model.pair)
    y = np.concatenate([html_extraction.labels_of(t) for t in trees])
    leaf = np.array([x is not None for t in trees for x in t.text])
    assert ((marginal[leaf, 1] >= 0.5) == y[leaf]).mean() > 0.99


ARTICLE = "<h1>The title</h1><p>First  paragraph\n of the &lt;story&gt;, with <b>bold</b> words. It goes on.</p><p>Second one, also with a few words in it.</p><ul><li>One point.</li><li>Another.</li></ul>"
TEXT = "The title\nFirst paragraph of the <story>, with bold words. It goes on.\nSecond one, also with a few words in it.\nOne point.\nAnother."


@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="main"><article class="post">{}</article></div>', '<section class="entry-content">{}</section>'])
@pytest.mark.parametrize(
    "around",
    [
        ('<nav><a href="/">Home</a><a href="/b">News</a></nav>', "<footer>&copy; Some site. All rights reserved.</footer>"),
        ('<header><div class="logo">Site</div><ul class="menu"><li><a href="/">Home</a></li><li><a href="/x">More</a></li></ul></header>', '<aside class="sidebar"><h3>Related</h3><ul><li><a href="/1">Another long story to read</a></li></ul></aside>'),
        ('<div class="cookie-notice"><p>We use cookies. Please agree to that.</p><button>OK</button></div>', '<section class="comments"><h3>Comments</h3><div class="comment"><p>I liked this story a lot. Thank you for it.</p></div></section>'),
        ('<form action="/s"><label>Search</label><input name="q"><button>Go</button></form>', '<div id="comments"><ol><li class="comment"><p>Reader says this is wrong.</p></li></ol></div><div id="footer"><p>Imprint and more.</p></div>'),
        ('<div class="ad">Buy now! It is cheap. Really very cheap indeed.</div><style>p{color:red}</style>', '<script>var a="<p>not text</p>";</script><div class="newsletter"><p>Sign up for our letter today.</p></div>'),
    ],
)
def test_boilerplate_goes_and_the_article_stays(page_model, holder, around):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{around[0]}{holder.format(ARTICLE)}{around[1]}</body></html>"
    assert html_extraction.main_texts([dom.read(page)], page_model) == [TEXT]


def test_odd_pages(spark, page_model):
    odd = ["<", "<a", "<p class='x", "a < b", "<!-- never closed", "</p></div>", "<p>" * 3000 + "x", "<div>" * 3000 + "x", '<p title="a>b">t</p>', "&#0;&bogus;&amp", "<script>x"]
    assert dom.read('<p title="a>b">t</p>').text[-1] == "t"
    pages = spark.createDataFrame([(i, None, p) for i, p in enumerate([None, "", *odd])], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_extraction.digest(pages).collect()}
    assert len(got) == 13 and got[0]["text"] == got[1]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_extraction.digest(pages.limit(0)).count() == 0


# models


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98 and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()


def test_language_weights_are_sparse_and_calibrated():
    s = language_id.Settings()
    rows = [(*language_id.counts(t, s), y) for y, t in enumerate(["the and of", "der die das", "el la los"]) for _ in range(20)]
    weights, bias = language_id.fit_weights(rows, np.ones(1 << s.bucket_bits), 3, s)
    assert 0 < (weights != 0).mean() < 0.01 and bias.shape == (3,)
    r = np.random.default_rng(0)
    truth = r.normal(size=(4000, 3)) * 2
    y = np.array([r.choice(3, p=p) for p in language_id._softmax(truth)])
    assert abs(language_id.calibrate(truth * 5, y) - 5) < 0.6


def test_languages_of_messy_rows(messy, none):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.digest(messy).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 9)) and got[7][0] in ("en", "de")
    assert language_id.identified(messy).columns == messy.columns
    assert language_id.digest(none).count() == 0
    nothing = language_id.digest(messy.withColumn("lang", messy["`a.b`"]))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.digest(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got["held_out"]]
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.97 and (held["predicted"] == held["quality"]).mean() > 0.97
    prior = quality_classifier.fit(docs, labels).prior
    assert abs(prior - labels.toPandas()["quality"].mean()) < 0.05


def test_non_negative_risk_finds_the_prior():
    r = np.random.default_rng(4)
    draw = lambda n, good: np.abs(np.where(good[:, None], r.normal(1, 1, (n, 6)), r.normal(4, 1, (n, 6))))
    unlabelled_good = r.random(3000) < 0.7
    s = quality_classifier.Settings()
    m = quality_classifier.fit_rows(draw(1500, np.ones(1500, bool)), draw(3000, unlabelled_good), s)
    assert abs(m.prior - 0.7) < 0.06
    test_good = r.random(1000) < 0.5
    x = draw(1000, test_good)
    p = quality_classifier._sigmoid(quality_classifier._expand(x, m.edges, m.mean, m.scale) @ m.weights + m.bias)
    assert ((p >= 0.5) == test_good).mean() > 0.95


def test_quality_of_messy_rows(spark, messy, none):
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (6, 1, None), (None, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.digest(messy, labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert {r["score"] for r in quality_classifier.digest(messy, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.digest(none, labels).count() == 0
