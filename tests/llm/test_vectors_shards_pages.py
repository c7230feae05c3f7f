"""Top-k search, sharding and HTML extraction against brute force."""

import random
import zlib
from collections import Counter, defaultdict
from math import floor, inf, nan

import numpy as np
import pytest

from lakewright.llm import extract, shard, topk

VECTORS = "vec_id long, embedding array<float>, label int, score string, rank string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", "r") for i, v in rows], VECTORS)


def slow_search(rows, k=20):
    import struct

    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    good = [(i, [floor(64 * single(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and abs(x) < inf for x in v)]
    for q, v in good:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(v) == len(w))[:k]
            for rank, (s, i) in enumerate(scored, 1):
                yield q, rank, i, -s


@pytest.mark.parametrize("blocks", [(1 << 20, 1 << 20), (200, 1500)])
@pytest.mark.parametrize("lists", [(topk.DEPTH, topk.DEPTH_SHARE), (0, 1 << 30)])
def test_search_is_brute_force(spark, blocks, lists):
    """With lists of one entry phase 1 ends few queries, and phases 2 and 3 have to find the rest."""
    random.seed(6)
    rows = [(i, [random.gauss(0, 1) for _ in range(9)]) for i in range(150)]
    rows += [(200 + i, [1.0] * 9) for i in range(60)]  # ties by the dozen
    rows += [(300, None), (301, [None] * 9), (320, [nan] * 9), (340, [inf] * 9), (None, [1.0] * 9), (360, [0.5, -2.0]), (361, [1.5, 1.0]), (380, []), (381, [])]
    got = [tuple(r) for r in topk.search(vectors_of(spark, rows), query_bytes=blocks[0], candidate_bytes=blocks[1], depth=lists[0], share=lists[1]).collect()]
    assert sorted(got) == sorted(slow_search(rows))


def test_a_block_whose_bound_falls_short_holds_nothing_better():
    rng = np.random.default_rng(9)
    local = [rng.integers(-50, 50, (40, 600)).astype(np.float32) for _ in range(topk.LISTS)]
    whole = sum(m.astype(float) for m in local)
    places, total, bound = topk.gather(local, 30)
    for i in range(40):
        rest = np.setdiff1d(np.arange(600), places[i])
        assert whole[i, rest].max() <= bound[i]
        there = np.isfinite(total[i])
        assert np.array_equal(total[i][there], whole[i, places[i][there]]) and len(set(places[i][there])) == there.sum() == len(set(places[i]))


def test_few_scores_are_left_to_resolve():
    rng = np.random.default_rng(10)
    local = [np.rint(rng.normal(0, 40, (50, 4_000))).astype(np.float32) for _ in range(topk.LISTS)]
    whole = sum(m.astype(float) for m in local)
    cutoff = np.sort(whole, axis=1)[:, -20]
    r, at, total, resolved = topk.resolve(local, cutoff)
    want = {(i, j) for i, j in zip(*np.nonzero(whole >= cutoff[:, None]))}
    assert set(zip(r.tolist(), at.tolist())) == want and np.array_equal(total, whole[r, at])
    assert resolved < 0.05 * topk.LISTS * whole.size
    # Lists as deep as in a search end most queries in phase 1.
    assert np.mean(topk.gather(local, max(20 * topk.DEPTH, 4_000 // topk.DEPTH_SHARE))[2] < cutoff) > 0.5


def test_repeated_ids_fill_no_block(spark):
    rows = [(7, [float(i % 5)] * 4) for i in range(400)] + [(20, [1.0] * 4)]
    got = topk.search(vectors_of(spark, rows), candidate_bytes=64 * 40).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(7, 4 * 4 * 64 * 64)] * 20


def test_search_of_few_none_and_huge(spark):
    assert topk.search(vectors_of(spark, [])).count() == 0
    assert topk.search(vectors_of(spark, [(0, [1.0])])).count() == 0
    rows = [(0, [2.0**60, 1.0]), (1, [2.0**-6, 2.0]), (2, [-3.0e30, 1.0]), (3, [3.0e30, 1.0])]
    got = [tuple(r) for r in topk.search(vectors_of(spark, rows)).collect()]
    assert sorted(got) == [(0, 1, 1, (1 << 63) - 1), (0, 2, 3, (1 << 63) - 1), (0, 3, 2, -(1 << 63))]  # held to a long's range


def test_search_of_repeated_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [1.0]), (1, [1.0])]
    assert sorted(tuple(r) for r in topk.search(vectors_of(spark, rows)).collect()) == [(0, 1, 1, 4096), (0, 2, 1, 4096)]


def check_shards(rows, texts, ids, shards=8):
    assert Counter(r.doc_id for r in rows) == Counter(ids)
    slots = defaultdict(list)
    size = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == size
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_shards_are_even_and_keep_copies_together(docs_of):
    texts = [None, "", *(f"text {i}" for i in range(200)), *(f"copy {i % 40}" for i in range(160)), *["large"] * 180]
    rows = shard.assign(docs_of(texts)).collect()
    check_shards(rows, texts, list(range(len(texts))))
    held = defaultdict(set)
    for r in rows:
        held[(texts[r.doc_id] or "")].add(r.shard)
    n = len(texts) // 8
    assert len(held["large"]) <= -(-180 // n) + 2  # a group beyond a shard's quota is split, but not scattered
    assert sum(len(v) > 1 for k, v in held.items() if k.startswith("copy")) <= 3
    again = {(r.doc_id, r.shard, r.slot) for r in shard.assign(docs_of(texts)).repartition(7).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


@pytest.mark.parametrize("texts", [[], ["one"], ["same"] * 11, [None] * 9, ["x" * 100_000, "y"] * 3])
def test_shards_of_odd_tables(docs_of, texts):
    ids = [None if i == 4 else i // 2 for i in range(len(texts))]
    check_shards(shard.assign(docs_of(texts, ids)).collect(), texts, ids)


def test_copies_leave_a_full_shard_at_equal_votes(spark):
    rows = [(g, 0, 1, cell, 1, cell) for g in range(12) for cell in (0, 5)]
    schema = "g long, text_crc32 long, size long, cell int, n long, shard int"
    found = shard.propagate(spark.createDataFrame(rows, schema), [12, 0, 0, 0, 0, 24, 0, 0]).collect()
    assert sorted((r.g, r.shard) for r in found) == [(g, 5) for g in range(12) for _ in range(2)]


def test_sharding_runs_no_python(docs_of):
    plan = shard.assign(docs_of(["a", "b", "a"]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>Head &amp; line</h1><p>First   paragraph, <b>bold</b> and&nbsp;<i>more</i>.<p>Second one &eacute;&#x41; of words.<br>Next.
<ul><li>item one<li>item two</ul><aside>Side note</aside><form><input><button>Send</button></form></p></article>
<section id="comments"><p>A reader says something long about all of this, at length.</p></section>
<div class="cookie-consent">We use cookies.</div><footer>&copy; someone</footer></body></html>"""


def test_article_without_what_stands_round_it():
    want = "Head & line\nFirst paragraph, bold and more.\nSecond one éA of words. Next.\nitem one\nitem two"
    assert extract.main_text(PAGE) == want
    assert extract.main_text(PAGE.replace("article>", "div>")) == want


def test_density_finds_the_text_among_links():
    links = "<div>" + "".join(f"<a href={i}>link {i} here</a> " for i in range(30)) + "</div>"
    text = "".join(f"<p>Paragraph {i} with enough words to be the text of the page.</p>" for i in range(5))
    got = extract.main_text(f"<body>{links}<div><div>{text}</div></div>{links}</body>")
    assert got.split("\n") == [f"Paragraph {i} with enough words to be the text of the page." for i in range(5)]


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></p>", "<script>x", "<!-- never closed", "<a href='x>y", "<div>" * 5_000 + "deep text", "&#0;&bogus;&#xFFFFFFFF;", "<table><tr><td>a<td>b</table>"])
def test_broken_pages_give_something(page):
    assert isinstance(extract.main_text(page), str)


def test_pages(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "v", "", "x"), (None, "w", "<p>Only some text here</p>", "x")]
    got = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (2, 3)} == {""}
    assert [r.text for r in got if r.page_id is None] == ["Only some text here"]
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_all_of_a_long_page_is_read():
    text = "".join(f"<p>Sentence number {i} of a very long article.</p>" for i in range(20_000))
    assert len(extract.main_text(f"<article>{text}</article>").split("\n")) == 20_000
