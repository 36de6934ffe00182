import time

import pyarrow.parquet as pq
import pytest

from tracewell.llm import dom, html_extraction, labelled_pages
from tracewell.llm.queries import QUERIES


@pytest.fixture(scope="module")
def page_model():
    return html_extraction.made_up_model(200)


def article(page):
    """All text under article elements, a block to a line."""
    tree = dom.read(page or "")
    inside = [False] * len(tree.parent)
    for i in range(1, len(inside)):
        inside[i] = inside[tree.parent[i]] or tree.tag[i] == "article"
    return "\n".join(t for t, ok in zip(tree.text, inside, strict=True) if ok and t is not None)


def test_every_page_gives_its_article(spark):
    sf_dir = "/root/testdata/sf0.1"
    expected = {(i, u): article(h) for i, u, h in zip(*(pq.read_table(f"{sf_dir}/pages.parquet").column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)}
    got = {(r["page_id"], r["url"]): r["text"] for r in QUERIES["op1_html_extraction"](spark, sf_dir).collect()}
    assert got == expected and sum(not t for t in got.values()) < 5


AROUND = "<html><head><title>t</title></head><body><nav><ul>" + "".join(f'<li><a href="/{i}">Part {i}</a></li>' for i in range(9)) + "</ul></nav>{}<aside class='sidebar'><h3>Other things</h3><p>Have a look at this too.</p></aside><footer>&copy; Somebody.</footer></body></html>"


@pytest.mark.parametrize("n", [10, 100, 2000])
@pytest.mark.parametrize("one", ["<p>Wh the.</p>", "<p>Yes</p>", "<div>No, not that.</div>", "<ul><li>A name</li></ul>"])
@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div class="post-body">{}</div>'])
def test_many_short_paragraphs_are_content(page_model, n, one, holder):
    body = "<h1>What they said that day</h1><p>This is how it began, as far as I can tell, on a cold morning in March.</p>" + one * n
    tree = dom.read(AROUND.format(holder.format(body)))
    lines = html_extraction.main_texts([tree], page_model)[0].split("\n")
    assert len(lines) == n + 2 and lines[0] == "What they said that day"


def test_an_advert_among_many_paragraphs_goes(page_model):
    body = "<p>Short one.</p>" * 300 + '<div class="ad">Buy now. Really cheap.</div>' + "<p>Short one.</p>" * 300
    assert html_extraction.main_texts([dom.read(AROUND.format(f"<article><h1>Title</h1>{body}</article>"))], page_model)[0] == "Title" + "\nShort one." * 600


def test_large_comment_sections_go(page_model):
    comments = "".join(f'<div class="comment"><b>user{i}</b><p>I do not think that this is so.</p></div>' for i in range(400))
    page = AROUND.format(f'<article><h1>Title of it</h1><p>The first paragraph of the story, which is not so long.</p><p>And a second one.</p></article><section class="comments">{comments}</section>')
    assert html_extraction.main_texts([dom.read(page)], page_model)[0] == "Title of it\nThe first paragraph of the story, which is not so long.\nAnd a second one."


def test_weakened_messages_only_beyond_a_number_of_siblings(page_model):
    few, many = (html_extraction.Forest.of([dom.read("<div>" + "<p>x</p>" * n + "</div>")], page_model.known) for n in (6, 24))
    assert (few.weight == 1).all() and sorted(set(many.weight)) == [0.25, 1]


@pytest.mark.parametrize(
    "page,text",
    [
        ('<p>a</p><script src="a.js"/>var x = 1;</script><p>b', ["a", "b"]),
        ("<p>a</p><style/>p{}</style><p>b", ["a", "b"]),
        ("<select><option>x<p>a</p><select><option>y</select><p>b", ["a", "b"]),
        ("<select><option>x<option>y</select><p>b", ["b"]),
        ("<video src=x><p>a</p><video src=y></video><p>b", ["a", "b"]),
        ("<p>a<svg/>b</p>", ["ab"]),
        ("<p>a<svg><svg></svg>b", ["ab"]),
        ("<object/><p>b", ["b"]),
        ("<p>a</p><script>x</script", ["a"]),
    ],
)
def test_elements_that_hold_no_text(page, text):
    assert [x for x in dom.read(page).text if x] == text


@pytest.mark.parametrize(
    "page",
    ["<div>" * 60_000 + "</p>" * 160_000, "<li><ul>" + "<div>" * 50_000 + "<li></li>" * 80_000, "<svg>" * 200_000, "<b><div>" + "<i>" * 50_000 + "</b>" * 200_000, "<i>" * 50_000 + "<div></div>" * 80_000, "</script" * 120_000, "<select><option>x" * 60_000, "<!--" * 250_000, '<p a="' * 160_000, "<p><font>x" * 100_000],
)
def test_a_megabyte_of_nested_tags_takes_seconds(page, page_model):
    began = time.perf_counter()
    tree = dom.read(page)
    html_extraction.main_texts([tree], page_model)
    assert time.perf_counter() - began < 30


def test_text_deeper_than_the_tree_is_kept():
    tree = dom.read("<div>" * 2000 + "<p>x</p>" + "</div>" * 2000 + "<p>y</p>")
    assert [t for t in tree.text if t] == ["x", "y"] and tree.tag[tree.parent[tree.text.index("y")]] == "p" and tree.parent[tree.parent[tree.text.index("y")]] == 0


def test_rows_alike_and_clashing_columns(spark):
    page = AROUND.format("<article><p>Some words that are long enough for a paragraph.</p></article>")
    pages = spark.createDataFrame([(1, "u", page, "a", 5), (1, "u", page, "a", 5), (2, None, None, "b", None)], "page_id long, url string, html string, text string, n_chars int")
    df, r = html_extraction.extract(pages)
    assert df.columns[:-1] == pages.columns and [x[r]["text"] for x in df.orderBy("page_id").collect()] == ["Some words that are long enough for a paragraph."] * 2 + [""]


def test_held_out_made_up_pages_with_many_items(page_model):
    trees = [dom.read(p) for p in labelled_pages.pages(300, seed=4242)]
    wrong = sum(html_extraction.main_texts([t], page_model)[0] != "\n".join(x for x, y in zip(t.text, html_extraction.labels_of(t), strict=True) if y and x is not None) for t in trees)
    assert wrong <= 24
