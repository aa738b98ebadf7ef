from __future__ import annotations

import html as entities
import re

import pytest

from rideflow.llm import html_text

COSTS = {"p": 0.02, "b": 0.02, "br": 0.02, "h1": 0.02, "a": 3.0, "li": 3.0, "ul": 3.0, "div": 3.0}
BODY = "<article><h1>Head</h1><p>One two  three\n four.</p><p>Five &amp; six&nbsp;seven.</p></article>"
TEXT = "Head\nOne two three four.\nFive & six seven."

PAGES = [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("<script>var a = 'x y z';</script>", ""), ("plain words", "plain words"), (BODY, TEXT),
    (f"<html><head><title>T t t</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>home</a></ul></nav>{BODY}<footer>&copy; us</footer>", TEXT),
    (f"<header>Site name here</header><div class='ad'>Buy now and here</div>{BODY}<aside>more of this</aside>", TEXT),
    (f"{BODY}<section id='comments'><h2>Comments</h2><p>I like it very much indeed.</p></section>", TEXT),
    (f"{BODY}<article class='comment'><p>A long comment of a reader on all of it.</p></article>", TEXT),
    (f"<div class='cookie-notice'>We use cookies on this page, you know.</div>{BODY}<form><label>Mail</label><input></form>", TEXT),
    (f"<div id='sidebar'><p>Ten most read texts of the week</p></div>{BODY}<div role='contentinfo'>imprint and more</div>", TEXT),
    (BODY.replace("</p><p>Five", "</p><div class='advert'>Now with a discount of half</div><script>x('</p>')</script><p>Five"), TEXT),
    (BODY.replace("article", "main"), TEXT),
    ("<article><p><b>Bold.<br><p>Next one.</p><p>The.</p></article>", "Bold.\nNext one.\nThe."),
    ("<article><h1>cut &am</h1><p>a &lt;b&gt; &#233; &#x41; &quot;</p></article>", 'cut &am\na <b> é A "'),
    ("<div><p>Words without an article stand here as well.</p><p>And more.</p></div>", "Words without an article stand here as well.\nAnd more."),
    (f"<div class='ad'>never closed {BODY}", TEXT),
    (f"<!-- <p>not this</p> -->{BODY}<!-- ad -->", TEXT),
    ("<article><p>in <a href='x'>a link</a> of the text, that goes on</p><table><tr><td>cell one</td><td>cell two</td></tr></table></article>",
     "in a link of the text, that goes on\ncell one\ncell two"),
    ("<article><p>unclosed <b>bold <i>both", "unclosed bold both"), ("</p></div></article>", ""), ("<article></article>", ""),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_text_of(page, text):
    assert html_text.main_text(page, COSTS) == text


def test_best_run_is_the_best(spark):
    import itertools
    import random

    rng = random.Random(3)
    for _ in range(300):
        items = [html_text.Item(*rng.choice([("text", "a b", True), ("text", "a", True), ("tag", "x", True), ("part", "ad", True), ("edge", "article", True)]))
                 for _ in range(rng.randint(1, 9))]
        costs = {"x": rng.choice([0.5, 1.5, 3.0])}
        start, end = html_text.best_run(items, costs)
        total = lambda a, b: sum(html_text._score(i, costs) for i in items[a:b])
        free = [(a, b) for a, b in itertools.combinations(range(len(items) + 1), 2) if not any(i.kind == "edge" for i in items[a:b])]
        assert total(start, end) == pytest.approx(max([0.0, *(total(a, b) for a, b in free)]))


def article_of(page):
    """The text of the test tables' pages, whose article is marked."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(x for x in (" ".join(entities.unescape(b).split()) for b in blocks) if x)


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    rows = html_text.page_report(pages).collect()
    assert len(rows) == len(raw)
    for r in rows:
        assert r.text == article_of(raw[r.page_id]) and r.n_chars == len(r.text)


@pytest.mark.parametrize("mark", ["article", "div"])
def test_the_scan_leaves_the_menu_out(spark, sf_dir, monkeypatch, mark):
    """With and without the mark, what furnishes the page is outside of the best run, and only that keeps it out."""
    raw = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    costs = html_text.tag_costs(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    pages = [p.replace("<article>", f"<{mark}>").replace("</article>", f"</{mark}>") for p in raw]
    right = sum(html_text.main_text(p, costs) == article_of(r) for p, r in zip(pages, raw))
    assert right == len(raw) if mark == "article" else right > 0.9 * len(raw)
    monkeypatch.setattr(html_text, "best_run", lambda items, costs: (0, len(items)))
    assert not any(html_text.main_text(p, costs) == article_of(r) for p, r in zip(pages, raw))


def test_learned_costs(spark, sf_dir):
    costs = html_text.tag_costs(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    assert costs["p"] == html_text.LEAST_COST < costs.get("a", html_text.MOST_COST)


def test_nulls_repeats_clashes_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, "kept"), (None, BODY, "kept"), (None, BODY, "kept")], "page_id long, html string, Text string")
    rows = html_text.extracted(df).collect()
    assert sorted((r["Text"], r["text_"]) for r in rows) == [("kept", ""), ("kept", TEXT), ("kept", TEXT)]
    assert html_text.extracted(df.limit(0)).count() == 0


KEPT = [
    "<article><h1>Head</h1><section id='related-work'><p>Others did it as well, and before.</p></section><p>One two three.</p></article>",
    "<article><h1>Head</h1><section id='discussion'><p>It may be so or it may not.</p></section></article>",
    "<article><h2 id='how-to-login'>How to login</h2><p>One two three.</p><h2 id='search-methods'>Search</h2><p>Four.</p></article>",
    "<article class='post category-social tag-search'><h1>Head</h1><p>One two three.</p></article>",
    "<main class='has-sidebar'><h1>Head</h1><p>One two three.</p></main>",
    "<article><p>One two three.</p><pre><span class='token comment'># why</span> x = 1</pre></article>",
    "<div class='layout has-sidebar'><p>Words without an article stand here as well.</p></div>",
]


@pytest.mark.parametrize("page", KEPT)
def test_a_word_in_a_name_cuts_nothing(page):
    assert html_text.main_text(page, COSTS).split() == re.sub("<[^>]*>", " ", page).split()


def test_names_are_weighed(spark):
    """A doubtful part at the article's edge is left out where its name costs more than its words."""
    page = "<p>One two three four five.</p><section class='{}'><p>see these three too</p></section>"
    whole, cut = "One two three four five.\nsee these three too", "One two three four five."
    assert html_text.main_text(page.format("related-box"), COSTS) == cut
    assert html_text.main_text(page.format("related-box"), COSTS | {".related": 0.02}) == whole
    assert html_text.main_text(page.format("plain-box"), COSTS) == whole
    assert html_text.main_text(f"<article>{page.format('related-box')}</article>", COSTS) == whole
    # Within the article even a learned name weighs no more than a tag.
    assert html_text.main_text(f"<article>{page.format('related-box')}</article>", COSTS | {".related": 20.0}) == whole
    pages = [(i, f"<div class='share-bar'>x</div><article><section id='related-{i}'><p>a b</p></section></article>") for i in range(20)]
    costs = html_text.tag_costs(spark.createDataFrame(pages, "page_id long, html string"))
    assert costs[".related"] == html_text.LEAST_COST and costs[".share"] > html_text.NAME_COST


PARTS = [
    ("<main><h1>Title</h1><p>lead</p><article><p>body of it</p></article></main>", "Title\nlead\nbody of it"),
    ("<article><h1>Head</h1><p>before</p><article><p>embedded post</p></article><p>after</p></article>", "Head\nbefore\nembedded post\nafter"),
    ("<div><p>not this</p></div><section><article><p>part one</p></article>\n<article><p>part two</p></article> <article>three</article></section>", "part one\npart two\nthree"),
    ("<main><article><p>part one</p></article><article><p>part two</p></article></main><p>imprint</p>", "part one\npart two"),
    ("<article><p>one two</p><main><p>three</p></main><p>four", "one two\nthree\nfour"),
    # Parts with an article of their own stay out; what is never closed does not.
    ("<article><p>one two</p><aside><article><p>see this other text as well</p></article></aside><p>three</p></article>", "one two\nthree"),
    (f"{BODY}<section id='comments'><article><p>A long comment of one reader on it.</p></article><article><p>And a second one of some words.</p></article></section>", TEXT),
    ("<body><article><p>one two</p></article><div class='ad'>never closed <article><p>three four five</p></article></body>", "three four five"),
    (f"<section><article><p>short</p></article></section><section>{BODY}</section>", f"short\n{TEXT}"),
    (f"<section><article><p>short</p></article></section><p>between</p><section>{BODY}</section>", TEXT),
    ("<nav>a b</nav><div><h1>Title</h1><p>lead of it</p><article><p>body</p></article></div><p>imprint</p>", "Title\nlead of it\nbody"),
    (f"<body><form id='aspnetForm'><nav>home</nav>{BODY}<input><label>Mail</label></form></body>", TEXT),
    ("<article><h1>Title</h1><p>lead</p><table>" + "<tr><td></td><td></td></tr>" * 20 + "</table><p>a</p></article>", "Title\nlead\na"),
    ("<h1>Title</h1><p>lead of the text</p><table>" + "<tr><td></td><td></td></tr>" * 20 + "</table><p>last one</p>", "Title\nlead of the text\nlast one"),
    ("<article><div class='masthead'><h1>Head</h1></div><blockquote class='comment'>quoted</blockquote><p>text</p></article>", "Head\nquoted\ntext"),
    ("<article><p>Press <button>OK</button> or <label>this one</label> now.</p><form><label>Mail</label><button>Send</button></form></article>",
     "Press OK or this one now."),
]


@pytest.mark.parametrize("page, text", PARTS)
def test_nested_and_sibling_articles_are_one_text(page, text):
    assert html_text.main_text(page, COSTS) == text
