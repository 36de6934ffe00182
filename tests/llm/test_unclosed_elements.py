import pytest

from tracewell.llm import dom


@pytest.mark.parametrize("tag,read_on", [("svg", True), ("math", True), ("select", True), ("video", True), ("script", False), ("style", False)])
def test_text_after_an_unclosed_element(tag, read_on):
    text = [x for x in dom.read(f"<p>before</p><{tag}><p>after</p>").text if x]
    assert text == (["before", "after"] if read_on else ["before"])
    assert [x for x in dom.read(f"<p>a <{tag}>no</{tag}> b</p>").text if x] == ["a b"]
