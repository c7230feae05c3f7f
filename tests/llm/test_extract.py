"""HTML extraction against densities computed from their definition, node by node."""

import math
import random
import re
import time
from html.parser import HTMLParser

import duckdb
import pytest

from lakewright.llm import extract

PAGES = "/root/testdata/sf0.01/pages.parquet"


class Slow(HTMLParser):
    """Nodes of a well-formed page: [tag, class, children and text], the root first."""

    def __init__(self, page):
        super().__init__()
        self.root = ["#root", "", []]
        self.stack = [self.root]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs).get("class") or "", []]
        self.stack[-1][2].append(node)
        if tag != "br":
            self.stack.append(node)

    def handle_endtag(self, tag):
        assert self.stack.pop()[0] == tag

    def handle_data(self, data):
        self.stack[-1][2].append(data)


BLOCKS = {"#root", "html", "body", "div", "section", "p", "ul", "li", "nav", "footer", "h1", "article", "aside"}
APART = {"nav", "footer", "aside"}


def below(node):
    for child in node[2]:
        if not isinstance(child, str):
            yield child
            yield from below(child)


def marked(node):
    return node[0] in APART or node[1] == "ad"


def measure(node, apart=False, link=False):
    """(characters, link characters, tags, link tags) of a node, read anew; apart, link: what stands above it is."""
    apart, link = apart or marked(node), link or node[0] == "a"
    c = lc = t = lt = 0
    for child in node[2]:
        if isinstance(child, str):
            size = len("".join(child.split()))
            c, lc = c + size, lc + size * (apart or link)
        else:
            mc, mlc, mt, mlt = measure(child, apart, link)
            c, lc, t, lt = c + mc, lc + mlc, t + mt + 1, lt + mlt + bool(apart or marked(child) or child[0] == "a")
    return c, lc, t, lt


def slow_text(page):
    root = Slow(page).root
    parents = {id(root): None}
    for node in (root, *below(root)):
        for child in node[2]:
            if not isinstance(child, str):
                parents[id(child)] = node
    order = [root, *below(root)]
    at = {id(x): k for k, x in enumerate(order)}

    def above(node):
        own, p = [], parents[id(node)]
        while p is not None:
            own.append(p)
            p = parents[id(p)]
        return any(map(marked, own)), any(x[0] == "a" for x in own)

    page_c, page_lc, _, _ = measure(root)
    density = {}
    for node in order:
        c, lc, t, lt = measure(node, *above(node))
        if not c:
            density[id(node)] = 0.0
            continue
        t, lt, one = max(1, t), max(1, lt), max(1, lc)
        base = math.log(c / max(1, c - lc) * lc + page_lc / max(1, page_c) * c + math.e)
        density[id(node)] = c / t * math.log(c / one * t / lt) / max(1.0, math.log(base))

    def children(node):
        for child in node[2]:
            if not isinstance(child, str):
                if child[0] in BLOCKS:
                    yield child
                else:
                    yield from children(child)

    total = {id(n): sum(density[id(c)] for c in children(n)) if n[0] in BLOCKS else 0.0 for n in order}

    def best_in(node):
        return max((node, *below(node)), key=lambda x: (round(total[id(x)], 6), -at[id(x)]))

    body = next(n for n in order if n[0] == "body")
    best = best_in(body)
    path, node = [], best
    while node is not body:
        path.append(node)
        node = parents[id(node)]
    threshold = min(density[id(n)] for n in (*path, body))
    chosen = {id(best_in(n)) for n in (body, *below(body)) if density[id(n)] > 0 and density[id(n)] >= threshold - 1e-9}
    chosen |= {id(n) for n in order[: at[id(best)]] if n[0] == "h1" and density[id(n)] > 0}
    out = [[]]

    def emit(node, inside):
        inside = (inside or id(node) in chosen) and not (marked(node) and density[id(node)] == 0)
        if node[0] in BLOCKS:
            out.append([])
        for child in node[2]:
            if isinstance(child, str):
                out[-1] += [child] if inside else []
            else:
                emit(child, inside)
        if node[0] in BLOCKS:
            out.append([])
        if node[0] == "br":
            out[-1].append(" ")

    emit(root, False)
    return "\n".join(t for t in (" ".join("".join(b).split()) for b in out) if t)


def sentence(rng, n):
    return " ".join("".join(rng.choice("aeioust") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def made_page(rng):
    def part(depth):
        kind = rng.random()
        if depth > 3 or kind < 0.45:
            inner = rng.choice(["{}", "{} <b>{}</b>", "<a href=x>{}</a>", "{}<br>{}", "{} <a href=y>{}</a> {}", "<i><b>{}</b></i>"])
            while "{}" in inner:
                inner = inner.replace("{}", sentence(rng, rng.choice([1, 3, 12, 60])), 1)
            return f"<p>{inner}</p>"
        if kind < 0.55:
            return "<ul>" + "".join(f"<li><a href=z>{sentence(rng, 2)}</a></li>" for _ in range(rng.randrange(1, 9))) + "</ul>"
        if kind < 0.65:
            tag = rng.choice(['nav', 'aside', 'footer', 'div class="ad"'])
            return f"<{tag}>{sentence(rng, rng.choice([2, 30]))}</{tag.split()[0]}>"
        tag = rng.choice(["div", "section", "article"])
        return f"<{tag}>" + "".join(part(depth + 1) for _ in range(rng.randrange(1, 7))) + f"</{tag}>"

    title = f"<h1>{sentence(rng, 5)}</h1>" if rng.random() < 0.5 else ""
    return f"<html><body>{title}" + "".join(part(0) for _ in range(rng.randrange(1, 8))) + "</body></html>"


@pytest.mark.parametrize("seed", range(150))
def test_text_is_what_the_definition_gives(seed):
    page = made_page(random.Random(seed))
    tree = extract.Tree(page)
    if extract._main_text(tree):
        assert extract.main_text(page) == slow_text(page)
    else:
        assert slow_text(page) == ""


def pages():
    return [h for (h,) in duckdb.sql(f"SELECT html FROM '{PAGES}' ORDER BY page_id").fetchall()]


def test_without_densities_most_pages_change(monkeypatch):
    own = pages()
    want = [extract.main_text(h) for h in own]
    monkeypatch.setattr(extract, "densities", lambda tree: ([1.0] * len(tree.tag), [1.0] * len(tree.tag)))
    assert sum(extract.main_text(h) != w for h, w in zip(own, want, strict=True)) > 0.9 * len(own)


def test_article_elements_are_not_needed():
    bare = lambda h: re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", h)
    own = pages()
    assert sum(extract.main_text(h) != extract.main_text(bare(h)) for h in own) == 0


def test_real_pages_keep_their_articles_and_nothing_else():
    for h in pages():
        article = re.search(r"<article[^>]*>(.*)</article>", h, re.S)[1]
        assert extract.main_text(h) == extract.main_text(f"<body><div>{article}</div></body>")


def test_names_round_everything_mean_nothing():
    text = "".join(f"<p>Paragraph {i} of a text that is long enough.</p>" for i in range(4))
    assert len(extract.main_text(f'<body><div id="comments">{text}</div></body>').split("\n")) == 4


def test_two_articles_of_like_density_both_stay():
    one = "<article>" + "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(5)) + "</article>"
    two = one.replace("word", "text")
    got = extract.main_text(f"<body><nav>{'<a href=1>Link</a> ' * 20}</nav>{one}{two}<footer>end</footer></body>")
    assert len(got.split("\n")) == 10


@pytest.mark.parametrize("shape", ["<div>", "<p><table><tr><td>", "<ul><li>", "<span>", "<b></i>", "<article></b>"])
def test_nesting_costs_linear_time(shape):
    def seconds(n):
        began = time.perf_counter()
        extract.main_text(shape * n + "text")
        return time.perf_counter() - began

    seconds(100)
    assert seconds(40_000) < 60 * max(seconds(2_000), 0.005)  # 20 times the tags; 400 times if quadratic


def test_equal_density_sums_give_the_first():
    part = "<div><p>{0} words of a part here</p><p>{0} other words as many</p></div>"
    tree = extract.Tree(f"<body>{part.format('aaa')}{part.format('bbb')}</body>")
    _, total = extract.densities(tree)
    first, second = [i for i, t in enumerate(tree.tag) if t == "div"]
    assert total[first] == total[second]
    text = extract.main_text(f"<body>{part.format('aaa')}{part.format('bbb')}</body>")
    assert text.startswith("aaa")
