"""KD-tree search and HTML extraction."""

import random

import numpy as np
import pytest

from tidewatch.llm import html_text, kd_search


def brute(rows, k, n=50):
    usable = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if q % n == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(0, 0.2, 8)]) for i in range(400)]
    rows += [(400 + i, [0.25] * 8) for i in range(120)]  # one very common vector: ties
    rows += [(1000, None), (1001, [None] + [0.1] * 7), (1050, [float("nan")] * 8), (1100, [float("inf")] * 8), (1150, [0.5] * 3), (1151, [0.5] * 3), (1200, []), (None, [0.1] * 8)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted(map(tuple, kd_search.every_nth(frame).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == brute(rows, 5)
    small = kd_search.quantised(frame).persist()
    for shard_rows, block_rows in ((40, 3), (100, 1000)):
        again = kd_search.top_k(small, small.where("id % 50 = 0"), 5, shard_rows, block_rows)
        assert sorted(map(tuple, again.select("query_id", "rank", "id", "score").collect())) == got
    assert kd_search.every_nth(frame.limit(0)).count() == 0


def test_shards_with_repeated_ids_ties_and_clashing_columns(spark):
    """One vector and one id fill a third of the rows; shards stay small and results whole."""
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.normal(0, 0.3, 4)]) for i in range(600)]
    rows += [(700, [0.5, 0.5, 0.5, 0.5])] * 400 + [(None, [0.1] * 4)] * 50
    frame = spark.createDataFrame([(i, v, "a", 2, 3) for i, v in rows], "vec_id long, embedding array<double>, id string, q int, space int")
    small = kd_search.quantised(frame).persist()
    queries = small.where("id % 50 = 0 and id < 700").unionByName(small.where("id = 700").limit(1))
    got = sorted(map(tuple, kd_search.top_k(small, queries, 5, 64, 7).select("query_id", "rank", "id", "score").collect()))
    assert got == sorted(set(brute(rows, 5)))
    trees = kd_search.spaces(small, small.count(), 64)
    sizes = [len(r.ids) // 8 for r in kd_search.shards(small, trees, 64).select("ids").collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 110 and len(sizes) > 10


def test_best_first_opens_few_leaves():
    """In few dimensions most leaves are never opened, and a kth score from elsewhere closes a whole shard."""
    draw = np.random.default_rng(6)
    points, ids = draw.integers(-1000, 1000, (8192, 2)), np.arange(8192)
    tree = kd_search.build(points, 64)
    queries = draw.integers(-1000, 1000, (40, 2))
    best, found, opened = kd_search.search(tree, ids[tree.order], points[tree.order], np.full(40, -1), queries, np.full(40, kd_search.NONE), 5)
    scores = queries @ points.T
    for q in range(40):
        want = sorted(zip(-scores[q], ids))[:5]
        assert list(zip(-best[q], found[q])) == want
    assert opened.mean() < 8 and opened.max() < 40
    _, _, none = kd_search.search(tree, ids[tree.order], points[tree.order], np.full(40, -1), queries, scores.max(axis=1) + 10**7, 5)
    assert none.sum() == 0


def test_boxes_are_tight_and_leaves_small():
    points = np.random.default_rng(2).integers(-50, 50, (1000, 5))
    tree = kd_search.build(points, 64)
    leaves = np.flatnonzero(tree.child < 0)
    rows = [tree.order[tree.start[i]:tree.end[i]] for i in leaves]
    assert sorted(np.concatenate(rows)) == list(range(1000)) and max(map(len, rows)) <= 64
    for i, child in enumerate(tree.child):
        own = points[tree.order[tree.start[i]:tree.end[i]]]
        assert (own.min(axis=0) == tree.low[i]).all() and (own.max(axis=0) == tree.high[i]).all()
        if child >= 0:
            assert (tree.start[i], tree.end[child], tree.end[i]) == (tree.start[child], tree.start[child + 1], tree.end[child + 1])
    same = kd_search.build(np.zeros((300, 5), int), 64)
    assert max(same.end[same.child < 0] - same.start[same.child < 0]) <= 64


def test_large_components_stay_exact():
    draw = np.random.default_rng(3)
    points, ids = draw.integers(-(1 << 28), 1 << 28, (50, 4)), np.arange(50)
    tree = kd_search.build(points, 8)
    best, found, _ = kd_search.search(tree, ids[tree.order], points[tree.order], ids[:3], points[:3], np.full(3, kd_search.NONE), 4)
    for q in range(3):
        want = sorted((-int(sum(int(a) * int(b) for a, b in zip(points[q], points[i]))), i) for i in range(50) if i != q)[:4]
        assert list(zip(-best[q], found[q])) == want


@pytest.fixture(scope="module")
def model():
    return html_text.fitted()


def wanted(html):
    """The marked text of a template page."""
    page = html_text._Marked()
    page.feed(html)
    page.close()
    nodes, parents, _ = html_text.describe(page.root)
    keep = [" keep" in n.names or i == 0 for i, n in enumerate(nodes)]
    for i in range(1, len(nodes)):
        keep[i] = keep[i] and keep[parents[i]]
    return "\n\n".join(html_text.blocks(nodes[0], {id(n) for n, k in zip(nodes, keep) if k}))


def test_held_out_templates(model):
    pages = list(html_text.templates(200, seed=991))
    got = html_text.main_texts(pages, model)
    assert sum(g == wanted(p) for g, p in zip(got, pages)) >= 194


PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><div class="cookie-notice"><p>We use cookies. <button>OK</button></p></div>
<div class="ad">Buy &amp; save now.</div><article><h1>The  title &amp; more</h1><p><b>Lead words here.<br><p>First &lt;para&gt; with <a href="x">a link</a> and
 &eacute;&#233;&#x1F600; text that goes on for a while.</p><!-- no --><div class="share"><a href="#">Tweet</a> <a href="#">Post</a></div><p>Second paragraph has a few more words in it, too.</p></article>
<aside class="sidebar"><h3>Popular</h3><ul><li><a href="/x">One thing</a></li></ul></aside><section id="comments"><h3>Comments</h3><div class="comment"><p>I disagree with all of it.</p></div></section>
<form><label>Search</label><input name="q"></form><footer>&copy; 2024 Site &middot; Terms</footer></body></html>"""
TEXT = "The title & more\n\nLead words here.\n\nFirst <para> with a link and éé😀 text that goes on for a while.\n\nSecond paragraph has a few more words in it, too."


def test_one_page(model):
    assert html_text.main_text(PAGE, model) == TEXT
    assert html_text.main_text(PAGE[:PAGE.index("</footer>")], model) == TEXT
    assert html_text.main_text(PAGE[:PAGE.index("<aside") + 9], model) == TEXT


@pytest.mark.parametrize("name", ["article", "main", "div class='post-content'", "div id=content", "section class=story"])
def test_container_names(model, name):
    page = PAGE.replace("<article>", f"<{name}>").replace("</article>", f"</{name.split()[0]}>")
    assert html_text.main_text(page, model) == TEXT


@pytest.mark.parametrize("left_out", ["</head>", "</head><body>"])
def test_head_without_its_end_tag(model, left_out):
    assert html_text.main_text(PAGE.replace("</head><body>", "</head><body>".replace(left_out, "")), model) == TEXT
    bare = html_text.parse("<html><head><title>t</title><meta charset=x>words<p>more</p>")
    assert html_text.blocks(bare) == ["words", "more"]


def test_siblings_are_counted_by_tag_at_every_size():
    nodes, _, x = html_text.describe(html_text.parse("<body>" + "<p>a</p>" * 61 + "<aside>b</aside></body>"))
    same = dict(zip([n.tag for n in nodes], x[:, html_text.FEATURES.index("same tag siblings")]))
    assert (same["p"], same["aside"]) == (61, 1)


def test_decoding_never_keeps_below_what_is_dropped():
    draw = np.random.default_rng(5)
    for _ in range(50):
        n = 30
        parents = np.array([-1, *(draw.integers(0, i) for i in range(1, n))])
        logit = draw.normal(0, 3, n)
        keep = html_text.decode(parents, logit)
        assert keep[0] and all(keep[parents[i]] or not keep[i] for i in range(1, n))


def test_decoding_is_the_best_choice():
    draw = np.random.default_rng(6)
    for _ in range(20):
        n = 9
        parents = np.array([-1, *(draw.integers(0, i) for i in range(1, n))])
        logit = draw.normal(0, 2, n)
        value = lambda k: sum(x if y else -x for x, y in zip(logit, k))
        allowed = [k for k in (np.array([True, *((m >> i) & 1 == 1 for i in range(n - 1))]) for m in range(1 << (n - 1))) if all(k[parents[i]] or not k[i] for i in range(1, n))]
        assert value(html_text.decode(parents, logit)) == pytest.approx(max(map(value, allowed)))


def test_awkward_pages(spark, model):
    draw = random.Random(1)
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = "<article>" + "".join(f"<p>{' '.join(['word'] * draw.randint(5, 40))} {i}.</p>" for i in range(4000)) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text only"), (4, "u", "<"), (5, "u", "</p></div><p"), (6, "u", deep), (7, "u", long), (8, "u", PAGE), (8, "u", PAGE), (None, "u", "<html></html>")]
    frame = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.report(frame).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "" and texts[2] == "" and texts[8] == TEXT and texts[7].count("\n\n") == 3999
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.report(frame.limit(0)).count() == 0


@pytest.mark.parametrize("tag", sorted(html_text.DROPPED))
def test_a_silent_element_left_open_keeps_the_article(tag):
    article = "<article class='post'><h1>Title</h1><p>First words of it.</p><p>More of it.</p></article>"
    texts = lambda page: html_text.blocks(html_text.parse(page))
    whole = ["Title", "First words of it.", "More of it."]
    assert texts(f"<html><body><{tag}>x{article}</body></html>") == whole
    assert texts(f"<html><body><div><{tag}>x</div>{article}</body></html>") == whole
    assert texts(f"<html><body>{article.replace('<h1>', f'<{tag}>x<h1>')}</body></html>") == whole
    assert texts(f"<html><head><title>t</title><{tag}>x<body>{article}</body></html>") == whole
    assert texts(f"<html><body>{article.replace('<h1>', f'<{tag}><p>x</p></{tag}><h1>')}</body></html>") == whole  # ended: all of it goes
    assert texts(f"<p>one <{tag}>x</{tag}>two <{tag}><i>y</i><p>z</p></{tag}>three</p>") == ["one two three"]
