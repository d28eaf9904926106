"""Main text of pages: the parser, the trees, the decoding, and the whole operator."""

from __future__ import annotations

import html
import itertools
import re

import numpy as np
import pytest
from texts import prose

from meterlake.llm import boosting, extraction, layouts, queries
from meterlake.llm.dom import Forest


def runs(page: str) -> list[str]:
    forest = Forest()
    forest.add(page)
    return [t for t in forest.text if t]


def shape(page: str):
    """The block tree as nested lists, runs as their text."""
    forest = Forest()
    forest.add(page)
    children: dict[int, list] = {k: [] for k in range(len(forest.tag))}
    for k in range(len(forest.tag) - 1, 0, -1):
        children[forest.parent[k]].insert(0, forest.text[k] or [forest.tag[k], *children[k]])
    return children[0]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", []),
        ("just text", ["just text"]),
        ("<p>a<p>b<div>c</div>d", [["p", "a"], ["p", "b"], ["div", "c"], "d"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", [["ul", ["li", "a"], ["li", "b", ["ul", ["li", "c"]], "d"]], "e"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", [["table", ["tr", ["td", "a"], ["td", "b"]], ["tr", ["td", "c"]]], "d"]),
        ("<dl><dt>a<dd>b<dt>c</dl>", [["dl", ["dt", "a"], ["dd", "b"], ["dt", "c"]]]),
        ("<p><b>bold <i>both</b> one</i><br>two</p>", [["p", "bold both one two"]]),
        ("</p></div>a<div>b</p>c</div>", ["a", ["div", "b c"]]),
        ("<h1>a<h2>b</h3>c", [["h1", "a"], ["h2", "b"], "c"]),
        ("a<!-- <p>x</p> -->b<!-- open <p>c", ["ab"]),
        ("<script>var t='</p><p>';</script>a<style>p{}</style><TITLE>t</TITLE>b<script>c", ["ab"]),
        ("<p>a &amp;&lt;b&gt; &eacute;&#233;&#xe9; &nbsp; x  \n y", [["p", "a &<b> ééé x y"]]),
        ("1 < 2 <3 <p class='a>b' id=\"c>d\">e<p title=it's>f", ["1 < 2 <3", ["p", "e"], ["p", "f"]]),
        ("<div>a<button>b</button>c<select><option>d</select><svg><p>e</svg>f<noscript>g</noscript></div>", [["div", "a c f"]]),
        ("<div>a<button>b<p>c</div>", [["div", "ab", ["p", "c"]]]),
        ("<td>a</div>b</td>", [["td", "ab"]]),
        ("<div><table><tr><td>a</div>b</table>c</div>d", [["div", ["table", ["tr", ["td", "ab"]]], "c"], "d"]),
        ("<p class=\"x", [["p"]]),
    ],
)
def test_trees(page, expected):
    def tidy(node):
        return [tidy(n) for n in node if n != []] if isinstance(node, list) else node

    found = tidy(shape(page))
    squeezed = lambda x: re.sub(r"\s", "", repr(x))
    assert squeezed(found) == squeezed(expected)


def test_attribute_words():
    forest = Forest()
    forest.add('<div class="site-Nav mainMenu" ID=top2 data-x="no" style="color:red; Display : none">x</div><p hidden>y<p class=\'a  b\'>z')
    assert [t for t in forest.tokens if t] == [("site", "nav", "main", "menu", "top", "2", "hidden"), ("hidden",), ("a", "b")]


def test_subtrees_are_ranges():
    forest = Forest()
    for page in itertools.islice(layouts.pages(5, 3), 5):
        forest.add(page)
    for k, end in enumerate(forest.end):
        below = [j for j in range(len(forest.tag)) if j == k or (j > k and any(a == k for a in ancestors(forest, j)))]
        assert below == list(range(k, end))


def ancestors(forest, k):
    while k >= 0:
        yield k
        k = forest.parent[k]


def test_odd_markup_ends():
    deep = "<div>" * 30_000 + "x" + "</div>" * 10
    assert runs(deep) == ["x"]
    assert runs("<button>" * 20_000 + "x") == ["x"]
    assert runs("<a <a <a '" * 5_000) in ([], ["'"])
    assert runs("</div>" * 20_000 + "<li>" * 20_000 + "y") == ["y"]


def test_trees_learn_two_questions_together():
    r = np.random.default_rng(1)
    rows = r.normal(size=(4000, 5))
    target = ((rows[:, 1] > 0.3) ^ (rows[:, 3] > -0.2)).astype(float)
    model = boosting.fit(rows[:3000], target[:3000], trees=25, depth=3, rate=0.3)
    odds = model.log_odds(model.binned(rows[3000:]))
    assert ((odds > 0) == (target[3000:] > 0)).mean() > 0.95


def choices(forest, k):
    """Every consistent choice below a node: (runs that stay, nodes out, nodes in, nodes split)."""
    below = range(k, forest.end[k])
    all_runs = frozenset(j for j in below if forest.text[j])
    if not all_runs:
        return [(frozenset(), (), (), ())]
    full = tuple(j for j in below if any(forest.text[i] for i in range(j, forest.end[j])))
    found = [(frozenset(), full, (), ()), (all_runs, (), full, ())]
    if not forest.text[k]:
        children = [j for j in below if forest.parent[j] == k]
        for parts in itertools.product(*[choices(forest, c) for c in children]):
            found.append((frozenset().union(*[p[0] for p in parts]), *[sum((p[i] for p in parts), ()) for i in (1, 2)], (k, *sum((p[3] for p in parts), ()))))
    return found


@pytest.mark.parametrize("seed", range(12))
def test_decoding_is_the_best_consistent_choice(seed):
    r = np.random.default_rng(seed)
    forest = Forest()
    forest.add("<div>a<p>b</p><div><p>c<p>d</div></div><ul><li>e<li>f</ul><div></div>g")
    some, whole = r.normal(size=(2, len(forest.tag))) * 2
    p_some, p_all = 1 / (1 + np.exp(-some)), 1 / (1 + np.exp(-whole))
    split = np.log(np.maximum(p_some - p_all, 1e-4))

    def score(choice):
        _, out, kept, parted = choice
        return sum(np.log(1 - p_some[j]) for j in out) + sum(np.log(p_all[j]) for j in kept) + sum(split[j] for j in parted)

    best = max(choices(forest, 0), key=score)
    assert set(np.flatnonzero(extraction.decode(forest, some, whole)).tolist()) == best[0]


def truth(page: str) -> str:
    """The blocks of the article of a given page."""
    article = page[page.index("<article>") + 9 :].split("</article>")[0]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
    return "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_given_pages(spark, sf_dir, scale):
    folder = sf_dir.replace("0.001", scale)
    given = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = queries.op11_html_extraction(spark, folder)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert {r.page_id: r.text for r in rows} == {i: truth(r.html) for i, r in given.items()}
    assert all(r.url == given[r.page_id].url and r.n_chars == len(r.text) for r in rows)


def test_layouts_it_was_not_fitted_to():
    model = extraction.trained()
    good = lost = wrong = 0
    for page in layouts.pages(150, 99):
        forest = Forest()
        forest.add(page)
        main = np.array([t.startswith(layouts.MARK) for t in forest.text])
        forest.text = [t.removeprefix(layouts.MARK) for t in forest.text]
        keep, size = extraction.decode(forest, *model.log_odds(forest)), np.array([len(t) for t in forest.text])
        good, lost, wrong = good + size[keep & main].sum(), lost + size[~keep & main].sum(), wrong + size[keep & ~main].sum()
    assert good / (good + lost) > 0.95 and good / (good + wrong) > 0.95


MAIN = "The harbour was closed on Monday, when the storm came in and two ships had to wait outside for the pilot."
OTHER = "Something about our partners, our newsletter and the choices you have."
HAND_MADE = {
    "notice, header, sidebar, comments": (
        f'<div class="cookie-notice"><p>{OTHER}</p><button>OK</button></div><header><h1>Site</h1><nav><a href=/>Home</a></nav></header><main><article>'
        f'<h1>Title</h1><p>{MAIN}</p><p>{MAIN}</p></article><aside class="sidebar"><h3>About</h3><p>{OTHER}</p></aside></main>'
        f'<section id="comments"><h2>Comments</h2><div class="comment"><p>{MAIN}</p></div></section><footer><p>© 2020 {OTHER}</p></footer>',
        ["Title", MAIN, MAIN],
    ),
    "advert, form and comments inside": (
        f'<article><h1>T</h1><p>{MAIN}</p><div class="ad">{OTHER}</div><p>{MAIN}</p><section class="comments"><p>{MAIN}</p></section>'
        f"<form><label>Mail</label><input><p>{OTHER}</p></form></article>",
        ["T", MAIN, MAIN],
    ),
    "names without elements": (
        f'<div id="menu"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div id="content"><h2>Head</h2><div>{MAIN}</div><div>{MAIN}</div></div>'
        f'<div id="sidebar">{OTHER}</div><div id="footer">{OTHER}</div>',
        ["Head", MAIN, MAIN],
    ),
    "no markup around": (f"<p>{MAIN}<p>{MAIN}", [MAIN, MAIN]),
    "text": (MAIN, [MAIN]),
    "only a menu": ("<nav><ul><li><a href=1>a b</a></li></ul></nav><footer>© x</footer>", []),
}


@pytest.mark.parametrize("name", sorted(HAND_MADE))
def test_hand_made_pages(name):
    page, expected = HAND_MADE[name]
    assert extraction.main_blocks([page], extraction.trained())[0] == expected


def test_odd_rows(spark):
    long = "<article>" + "".join(f"<p>{prose(k, 300)}</p>" for k in range(1100)) + "</article>"
    assert len(long) > 2 * extraction._CHUNK
    rows = [(1, None, "u", "x"), (2, "", None, "x"), (None, f"<p>{MAIN}", "u", "y"), (3, f"<p>{MAIN}", "u", "y"), (3, f"<p>{MAIN}", "u", "y"), (4, long, "u", "z")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, id string").coalesce(1)
    found = extraction.extract_text(pages, carry=True).collect()
    blocks = [prose(k, 300) for k in range(1100)]
    assert sorted((r.id is not None, r.id or 0, r.text, r.n_blocks, r.row.id) for r in found) == sorted(
        [(True, 1, "", 0, "x"), (True, 2, "", 0, "x"), (False, 0, MAIN, 1, "y"), (True, 3, MAIN, 1, "y"), (True, 3, MAIN, 1, "y"), (True, 4, "\n\n".join(blocks), 1100, "z")]
    )
    assert extraction.extract_text(pages.limit(0)).count() == 0
    broken = spark.createDataFrame([(1, b"<p>caf\xe9 " + MAIN.encode())], "page_id long, html binary")
    assert [r.text for r in extraction.extract_text(broken).collect()] == ["caf\ufffd " + MAIN]
