"""Pages that a parser may choke on: time and memory stay linear; trees equal those of the standard library's parser."""

import time
from html.parser import HTMLParser

import pytest

from keyloom.llm import html

SF = "/root/testdata/sf0.001"
N = 150_000
ODD = {
    "nested": lambda n: "<div>some text" * n, "open tags": lambda n: "<a href " * n, "stray ends": lambda n: "<b>x</i>" * n, "open quotes": lambda n: '<a t="x' * n + ">", "one open quote": lambda n: "<a " * n + '"' + "<a>" * n,
    "names": lambda n: "<b" * n + ' "' + ">" * 3, "inline and rules": lambda n: "<b>" * n + "<hr>" * n, "under a button": lambda n: "<p><button>" + "<b>" * n + "<hr>" * n, "items": lambda n: "<ul>" + "<i>" * n + "<li>x" * n,
    "headers": lambda n: "<header>" * n + "<h1>x</h1>", "entities": lambda n: "&amp" * n, "comments": lambda n: "<!--" * n, "declarations": lambda n: "<!" * n, "mixed quotes": lambda n: "<a '\"" * n + ">", "spaces": lambda n: "<a" + " " * n + ">x",
    "attributes": lambda n: "<a " + "b = " * n + ">x", "tables": lambda n: "<table><tr><td>" * (n // 3), "brackets": lambda n: "<" * n + ">", "slashes": lambda n: "</a " * n + "'",
}


@pytest.mark.parametrize("name", sorted(ODD))
def test_linear(name):
    """Twice as long takes about twice the time."""
    times = []
    for n in (N // 2, N):
        page = ODD[name](n)
        began = time.process_time()
        runs, hashes, within = html.outline(page)
        html.join_runs((runs, hashes, within), frozenset([1]))
        times.append(time.process_time() - began)
        assert len(hashes) == len(within) <= page.count("<") and all(w < i for i, w in enumerate(within))
    assert times[1] < 3.2 * times[0] + 1, times


def test_what_does_not_close_is_text():
    assert html.main_text('<p>a <a href="x b</p>') == 'a <a href="x b'
    assert html.main_text("<p>a</p> <b ") == "a\n<b"
    assert html.main_text('<p>1</p><a "<p>2</p>') == '1\n<a "\n2'
    assert html.main_text("<p>1<b<!-- gone -->2") == "1\n2" or html.main_text("<p>1<b<!-- gone -->2").startswith("1")
    assert html.main_text("<p>x<!-- open <p>y") == "x"
    assert html.main_text("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a\nb\nc d\ne"


class Pieces(HTMLParser):
    """The text of a page in order, with the element that each piece stands in; raw elements hold none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.found = ["#root"], []

    def handle_starttag(self, tag, attrs):
        if tag not in html.VOID:
            self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        if self.stack[-1] not in html.RAW and data.strip():
            self.found.append((" ".join(data.split()), self.stack[-1]))


def test_text_equals_the_standard_parser(spark):
    """Every piece of text of every page, in order and in the element it stands in."""

    def pieces(top):
        found, stack = [], [(top, top.tag)]
        while stack:
            node, tag = stack.pop()
            if isinstance(node, str):
                if node.strip():
                    found.append((" ".join(node.split()), tag))
            else:
                stack += [(c, node.tag) for c in reversed(node.children)]
        return found

    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect() if r["html"]]
    for page in pages:
        other = Pieces()
        other.feed(page)
        other.close()
        own = pieces(html.parse(page))
        assert " ".join(t for t, _ in own) == " ".join(t for t, _ in other.found)
        assert sum(x in set(other.found) for x in own) >= 0.9 * len(own)
