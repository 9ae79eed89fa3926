"""Composite density by its definition, hard pages in linear time, text that must stay."""

import math
import random
import time
from html.parser import HTMLParser

import pytest

from tidemark.llm import html_text


class _Tree(HTMLParser):
    """Well-formed pages as [tag, children or texts]."""

    def __init__(self, page):
        super().__init__()
        self.top = ["html", []]
        self.open = [self.top]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        node = [tag, []]
        self.open[-1][1].append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][1].append(data)


def _counts(node, link=False):
    """characters, tags, link characters, link tags below a node."""
    c = t = lc = lt = 0
    link = link or node[0] == "a"
    for child in node[1]:
        if isinstance(child, str):
            n = len("".join(child.split()))
            c, lc = c + n, lc + n * link
        else:
            x = _counts(child, link)
            c, t, lc, lt = c + x[0], t + x[1] + 1, lc + x[2], lt + x[3] + (child[0] == "a")
    return c, t, lc, lt


def _plain(page):
    """The texts of the node that the definition chooses, by comparing all nodes."""
    top = _Tree(page).top
    nodes = []

    def walk(node, path):
        nodes.append((node, path))
        for child in node[1]:
            if not isinstance(child, str):
                walk(child, [*path, child])
    walk(top, [top])
    body = next(n for n, _ in nodes if n[0] == "body")
    cb, _, lcb, _ = _counts(body)

    def density(node):
        c, t, lc, lt = _counts(node)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + lcb / max(cb, 1) * c + math.e)
        return c / max(t, 1) * math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / math.log(max(base, math.e ** .1))

    total = {id(n): sum(density(x) for x in n[1] if not isinstance(x, str)) for n, _ in nodes}
    alive = [(n, p) for n, p in nodes if _counts(n)[0]]
    best, path = max(alive, key=lambda x: total[id(x[0])])
    least = min(density(n) for n in path[next(k for k, n in enumerate(path) if n is body):]) if body in path else density(best)
    best = max((n for n, _ in alive if density(n) >= least), key=lambda n: total[id(n)])

    def words(node):
        return [w for x in node[1] for w in (x.split() if isinstance(x, str) else words(x))]
    return words(best)


@pytest.mark.parametrize("seed", range(40))
def test_the_chosen_node_is_that_of_the_definition(seed):
    rng = random.Random(seed)

    def text(n):
        return " ".join("".join(rng.choices("abcdefg", k=rng.randint(1, 8))) for _ in range(n))

    def block(depth):
        if depth == 0 or rng.random() < 0.3:
            if rng.random() < 0.3:
                return "".join(f"<a>{text(2)}</a>" for _ in range(rng.randint(1, 6)))
            return f"<p>{text(rng.randint(1, 40))}</p>"
        return "<div>" + "".join(block(depth - 1) for _ in range(rng.randint(1, 4))) + "</div>"

    page = "<html><body>" + "".join(block(3) for _ in range(3)) + "</body></html>"
    want = _plain(page.replace("<html>", "").replace("</html>", ""))
    assert "".join(html_text.main_text(page).split()) == "".join(want)  # links in a row have no space between


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "<p>hello</p>" * 100_000, "<div>" * 50_000 + "x", "<ul><li>" * 30_000 + "x",
    "<table><tr><td>" * 20_000 + "x", "<a x='>" * 50_000, "<span></i>" * 50_000])
def test_hard_pages_take_linear_time(page):
    begin = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - begin < 30


def test_text_inside_the_article_stays():
    page = ("<body><article><p>a <math><mi>x</mi></math> b <noscript>c</noscript> <object>d</object> "
            "<label>e</label></p></article><form><label>mail</label><input></form>")
    assert html_text.main_text(page) == "a x b c d e"


def test_articles_side_by_side():
    one, two = "<article><p>First story is here.</p></article>", "<article><p>Second story is here.</p></article>"
    assert html_text.main_text(f"<body><nav>n</nav>{one}{two}<footer>f</footer>") == \
        "First story is here.\nSecond story is here."
    small = "<article><p>More</p></article>"
    assert html_text.main_text(f"<body>{one.replace('here', 'here and goes on for long')}{small}") == \
        "First story is here and goes on for long."


def test_odd_tables(spark):
    page = "<body><article><p>One two.</p></article>"
    rows = [(1, page, "t", 5)] * 3 + [(None, None, None, None), (2, "", "", 0), (1, "<p>x" * 20000, "u", 1)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int")
    got = html_text.extract_text(df).collect()
    assert sorted((r.page_id or 0, r.text[:8], r.n_chars) for r in got) == sorted(
        [(1, "One two.", 8)] * 3 + [(0, "", 0), (2, "", 0), (1, "x\nx\nx\nx\n", 39999)])
    assert html_text.extract_text(df.limit(0)).count() == 0
