"""Main text of pages with short paragraphs, lists, tables, menus inside the article, teasers and readers' comments."""

import random

import pytest

from weftgraph.llm import html_text

TREE = html_text.fit()
LONG = "word " * 39 + "end."
PAGES = {
    "short paragraphs": ("<h1>T</h1><p>Short one.</p><p>Another short.</p>", ["T", "Short one.", "Another short."]),
    "recipe": ("<html><body><h1>Pancakes</h1><p>Easy to make.</p><h2>Ingredients</h2><ul><li>2 eggs</li><li>Milk</li><li>100 g flour</li></ul><h2>Steps</h2><ol><li>Mix all.</li><li>Fry.</li></ol></body></html>", ["Pancakes", "Easy to make.", "Ingredients", "2 eggs", "Milk", "100 g flour", "Steps", "Mix all.", "Fry."]),
    "table": ("<body><h1>Results</h1><table><tr><th>Name<th>Score<tr><td>Ann</td><td>12</td></tr><tr><td>Bob</td><td>7</td></tr></table></body>", ["Results", "Name", "Score", "Ann", "12", "Bob", "7"]),
    "side parts": ('<body><nav><a>Home</a></nav><div class="menu"><a href=x>Home</a> <a>About</a></div><h1>Title</h1><p>One line.</p><div class="footer"><p>Contact us</p></div><p>Copyright 2024 Acme</p></body>', ["Title", "One line."]),
    "menu in main": (f"<main><ul><li><a>Home</a></li><li><a>About us</a></li><li><a>Contact</a></li></ul><h1>Story</h1><p>{LONG}</p><p>See <a>this link</a>.</p></main>", ["Story", LONG, "See this link."]),
    "teaser beside main": (f"<article><a>Other story</a></article><main><h1>Story</h1><p>{LONG}</p></main>", ["Story", LONG]),
    "teaser in main": (f"<main><article><h1>Story</h1><p>{LONG}</p></article><article><a>Other story</a></article></main>", ["Story", LONG]),
    "comments by heading": (f"<article><h1>Story</h1><p>{LONG}</p><h2>3 Comments</h2><p>I like this a lot, thanks for writing it.</p><h3>Ann</h3><p>Me too</p></article>", ["Story", LONG]),
    "comments end": (f"<article><h1>Story</h1><section><h2>Comments</h2><p>Me too</p></section><p>{LONG}</p><h2>Comments</h2><p>no</p><h2>Sources</h2><p>A book.</p></article>", ["Story", LONG, "Sources", "A book."]),
    "names of subjects": (f'<article><h1>Story</h1><div class="comment-policy"><p>{LONG}</p></div><div class="navigation-systems"><p>Ships.</p></div><div class="comment-list"><p>{LONG}</p></div><div class="related-links"><a>x y</a></div></article>', ["Story", LONG, "Ships."]),
    "rights in the article": (f"<article><p>{LONG}</p><p>All rights reserved.</p></article><p>All rights reserved.</p>", [LONG, "All rights reserved."]),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_pages(name):
    page, wanted = PAGES[name]
    assert html_text.main_text(page, TREE).split("\n") == wanted


def test_all_features_are_used():
    def used(tree):
        return {html_text.FEATURES[tree["feature"]]} | used(tree["low"]) | used(tree["high"]) if isinstance(tree, dict) else set()

    assert {"words", "links", "words_before", "words_after", "links_after", "apart", "hint", "article", "page_article", "prose"} <= used(TREE)


def test_random_articles_with_short_blocks():
    """Articles of short and long blocks of all kinds, in main or article, between side parts that are marked in any of several ways."""
    rng = random.Random(12)
    say = lambda n: " ".join(rng.choice(("alpha", "beta", "gamma", "delta", "Ünder", "x")) for _ in range(n))
    link = lambda: f"<a href='/x'>{say(rng.randint(1, 3))}</a>"
    side = [
        lambda: f"<nav><ul>{''.join(f'<li>{link()}</li>' for _ in range(4))}</ul></nav>",
        lambda: f"<div class='sidebar widget'><p>{say(rng.randint(1, 40))}</p>{link()}</div>",
        lambda: f"<footer><p>{say(rng.randint(2, 30))}</p></footer>",
        lambda: f"<div id='comments'><p>{say(rng.randint(2, 30))}</p></div>",
        lambda: f"<form><label>{say(2)}</label><button>Go</button></form>",
        lambda: f"<div role='navigation'>{link()} {link()}</div>",
        lambda: f"<div class='cookie-notice'>{say(12)}</div>",
        lambda: f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(5))}</ul>",
    ]
    for _ in range(150):
        kept, body = [], ""
        for _ in range(rng.randint(2, 12)):
            kind, text = rng.choice(("p", "p", "p", "h2", "li", "td", "pre", "dd", "blockquote", "menu")), say(rng.choice((1, 2, 5, 12, 40, 120)))
            if kind == "menu":
                body += f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(4))}</ul>"
                continue
            kept.append(text)
            around = {"li": ("<ul><li>", "</li></ul>"), "td": ("<table><tr><td>", "</td></tr></table>"), "dd": ("<dl><dd>", "</dd></dl>")}.get(kind, (f"<{kind}>", f"</{kind}>"))
            body += around[0] + text + around[1]
        if sum(len(k.split()) for k in kept) < 30:
            body += f"<p>{LONG}</p>"
            kept.append(LONG)
        tag = rng.choice(("main", "article"))
        page = "<html><body>" + "".join(rng.choice(side)() for _ in range(rng.randint(0, 3))) + f"<{tag}>{body}</{tag}>" + "".join(rng.choice(side)() for _ in range(rng.randint(0, 3))) + "</body></html>"
        assert html_text.main_text(page, TREE) == "\n".join(kept), page


def test_null_pages_beside_columns_with_clashing_names(spark):
    rows = spark.createDataFrame([(1, "u", None, "a", 5), (None, None, "<p>One.</p><p>Two.</p>", "b", 6), (1, "u", "", "c", 7)], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_text.extract(rows).collect()), key=str)
    assert got == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "One.\nTwo.", 9)]
    assert html_text.extract(rows.limit(0)).collect() == []
