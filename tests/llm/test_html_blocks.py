import html
import re

import duckdb
import numpy as np
import pytest

from tessera.llm.html_blocks import FEATURES, LABELLED, blocks, extract, features, labelled_tree, main_text, predict, train_tree

TREE = labelled_tree()
PROSE = "Ona thre inger of the lyat edat onst, anstonble eredou eaor to edre of thheenti of atreon. "

PAGES = [
    # no article element: densities decide
    (f"""<html><head><title>T</title><script>if (a<b) x("</p><p>no")</script></head><body class="has-sidebar">
     <div id="menu"><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></div><h1>A head line</h1>
     <div><p>{PROSE * 3}<p>{PROSE}<br>two  lines&nbsp;&amp; more<p>Les.<p>{PROSE * 2}</div>
     <div class="comments"><h3>Comments</h3><p>{PROSE}</p></div><div><a href=x>one</a> <a href=y>two</a></div></body></html>""",
     f"A head line {(PROSE * 3).strip()} {PROSE.strip()} two lines & more Les. {(PROSE * 2).strip()}"),
    # all kinds of surroundings
    (f"""<!DOCTYPE html><body><header><a href="/">Site</a><p>{PROSE}</p></header><nav><a href=1>x</a></nav><div class="cookie-notice">We use
     cookies. {PROSE}</div><main><article><header><h1>Ti<b>tle</b> &eacute;</h1></header><p>One.<p>{PROSE}</p><aside>{PROSE}</aside>
     <div class="ad">{PROSE}</div><form><p>{PROSE}</p><button>Go</button></form><ul><li>a<li>b <a href=z>c</a></ul><!-- <p>no</p> --><p
     title="a > b">End &lt;b&gt;</article><section id=comments><article class="comment"><p>{PROSE}</p></article></section></main>
     <aside class=sidebar><p>{PROSE}</p></aside><footer>&copy; {PROSE}</footer><p hidden>{PROSE}""",
     f"Title é One. {PROSE.strip()} a b c End <b>"),
    ("", ""), ("<p>", ""), ("<!-- open", ""), ("<script>x", ""), ("just text without any tags but with quite a few words in it", "just text without any tags but with quite a few words in it"),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_pages(page, want):
    assert main_text(page, TREE) == want


@pytest.mark.parametrize("page", [
    f"<html><head><title>x</title><meta charset=utf-8><body><article><p>{PROSE}</article>",
    f"<head><title>x</title><article><p>{PROSE}</article>",
    f"<div><datalist><option value=a>a<option value=b>b</datalist></div><article><p>{PROSE}</p></article>",
    f"<select><option>a<option>b</select><article><p>{PROSE}</p></article>",
    f"<article><p><svg viewBox='0 0 1 1'/>{PROSE}</p></article>",
    f"<article><p><svg><path d=x><p>{PROSE}</p></article>",
    f"<div><svg><path d=x></div><article><p>{PROSE}</p></article>",
    f"<div><object data=x></div><div><canvas></div><div><iframe src=x></div><article><p>{PROSE}</p></article>",
    f"<article><p>{PROSE}<svg><title/><text>no</text></svg><template><p>no</p></template><noscript><p>no</p></noscript></p></article>"])
def test_end_tags_left_out(page):
    assert main_text(page, TREE) == PROSE.strip()


LONG = "x > <y>" * 1000


@pytest.mark.parametrize("page,want", [
    (f"<nav data-props='{LONG}'><p>{PROSE}</p></nav><article><p>{PROSE}</p></article>", PROSE),
    (f'<div hidden data-props="{LONG}"><p>{PROSE}</p></div><article><p>{PROSE}</p></article>', PROSE),
    (f"<article><div style='{LONG}'><p>One.</p></div><p>Two.</p><p>Three.</p></article>", "One. Two. Three."),
    (f"<article><div data-props='{LONG} hidden class=sidebar' data-hidden=1 aria-hidden=false><p>One.</p></div></article>", "One."),
    (f"<article><script data-x='{LONG}'>no</script><iframe srcdoc='{LONG}'>no</iframe><p>Two.</p></article>", "Two."),
])
def test_attributes_of_any_length(page, want):
    assert main_text(page, TREE) == want.strip()


@pytest.mark.parametrize("page,want", [
    (f'<div class="layout has-sidebar"><article><p>{PROSE}</p></article></div>', PROSE),
    (f'<div id=page class="no-sidebar"><p>{PROSE}</p></div>', PROSE),
    (f'<div class="content sidebar-layout with-sidebar"><p>{PROSE}</p></div>', PROSE),
    (f'<div class="widget"><main><p>{PROSE}</p></main></div>', PROSE),
    (f'<form><article><p>{PROSE}</p></article></form>', PROSE),
    (f'<article><p>One.</p><section id=discussion><p>{PROSE}</p></section></article>', "One. " + PROSE),
    # still no main text
    (f'<article><p>One.</p><div class="related"><article><p>{PROSE}</p></article></div></article>', "One."),
    (f'<article><p>One.</p></article><div class="comment-list"><article><p>{PROSE}</p></article></div>', "One."),
    (f'<article><p>One.</p></article><div class="left-sidebar widget-area"><p>{PROSE}</p></div>', "One."),
    (f'<div hidden><article><p>{PROSE}</p></article></div>', ""),
])
def test_marks_of_wrappers(page, want):
    assert main_text(page, TREE) == want.strip()


def test_many_tags_that_fail_are_read_in_linear_time():
    for part in ('<a "', "<a x='", '<a x="<a" ', "<a x=", "</", "<!", "<!--", "<svg>"):
        assert main_text(part * 50_000, TREE) is not None


def test_tree_learns_its_table():
    found = blocks("<nav><a href=x>Menu</a></nav><article><p>short</p></article>")
    assert [b[0] for b in found] == ["Menu", "short"]
    assert predict(TREE, features(found)).round().tolist() == [0, 1]


def prose(n):
    return " ".join((PROSE * 40).split()[:n])


#: Pages whose marks mislead or say nothing, and their main text.
MISLEADING = [
    # a theme's wrapper names the article something else
    (f"<div class=widget><p>{prose(90)}</p><p>{prose(110)}</p><p>{prose(130)}</p><p>{prose(80)}</p></div><ul><li><a href=1>a</a><li><a href=2>b</a></ul>",
     f"{prose(110)} {prose(130)}"),
    # an element that is never closed holds the whole page
    (f"<nav><a href=1>x</a><article><p>{prose(240)}</p><p>{prose(260)}</p><p>{prose(300)}</p></article>", prose(260)),
    # bare links in an article are a menu
    (f"<article><p>{prose(60)}</p><ul><li><a href=1>a b</a><li><a href=2>c</a><li><a href=3>d e</a></ul></article>", f"{prose(60)} a b"),
    # no mark at all
    (f"<div><a href=1>x</a></div><div><a href=2>y</a></div><div>A title here</div><div>{prose(70)}</div><div>{prose(40)}</div><div><a href=3>z</a></div>",
     f"A title here {prose(70)} {prose(40)}"),
]


@pytest.mark.parametrize("page,want", MISLEADING)
def test_words_links_and_neighbours_overrule_marks(page, want):
    assert main_text(page, TREE) == want
    by_marks = " ".join(b[0] for b in blocks(page) if b[3] > 0)
    assert by_marks != want


def test_no_hint_decides_alone():
    table = np.array([[float(v) for v in line.split()] for line in LABELLED.strip().split("\n")])
    hint = FEATURES.index("hint")
    assert all(set(table[table[:, hint] == h, -1]) == {0, 1} for h in (1, 0, -1, -2))
    # a tree of hints only, and one of words, links and neighbours only, read pages otherwise
    hints, others = table.copy(), table.copy()
    hints[:, :hint] = 0
    others[:, hint] = 0
    for weaker in (hints, others):
        tree = train_tree(weaker[:, :-1], weaker[:, -1])
        x = [features(blocks(page)) for page, _ in MISLEADING + PAGES[:2]]
        for f in x:
            f[:, np.ptp(weaker[:, :-1], axis=0) == 0] = 0
        full = [predict(TREE, features(blocks(page))) > 0.5 for page, _ in MISLEADING + PAGES[:2]]
        assert sum(int((a != (predict(tree, b) > 0.5)).sum()) for a, b in zip(full, x)) >= 4


@pytest.mark.parametrize("n", [1, 5, 20, 60])
def test_short_marked_blocks_among_long_ones_go(n):
    ends = (f"<p>{prose(300)}</p>",) * 2
    for mark in ("div class=ad", "aside", "div class=newsletter-signup", "footer"):
        page = f"<{mark}>{prose(n)}</{mark.split()[0]}>".join(ends)
        assert main_text(f"<article>{page}</article>", TREE) == f"{prose(300)} {prose(300)}"
        assert main_text(page, TREE) == f"{prose(300)} {prose(300)}"


def test_hidden_and_comments_of_any_length_go():
    long = f"<p>{prose(300)}</p>" * 4
    for mark in ("section class=comments", "div hidden", "div id=replies"):
        assert main_text(f"<article><p>{prose(80)}</p></article><{mark}>{long}</{mark.split()[0]}>", TREE) == prose(80)
    assert main_text(f"<article><p>{prose(80)}</p></article><div class=sidebar>{f'<p>{prose(90)}</p>' * 4}</div>", TREE) == prose(80)


def test_unclosed_markup_is_read_in_linear_time():
    assert main_text("<p class='" + "<a <b \"" * 50_000, TREE) is not None
    assert len(main_text("<article>" + f"<p>{PROSE}" * 5000, TREE)) > 400_000


def test_table_and_edges(spark):
    path = "/root/testdata/sf0.001/pages.parquet"
    got = {r.page_id: r for r in extract(spark.read.parquet(path)).collect()}
    rows = duckdb.sql(f"select page_id, html from '{path}'").fetchall()
    assert len(got) == len(rows)
    for i, page in rows:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        article = re.sub(r"</?(p|h1)>|<br>", " ", article)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", article)).split())
        assert (got[i].text, got[i].n_chars) == (want, len(want))
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 2)], "page_id long, url string, html string, text int")
    assert [tuple(r) for r in extract(df).collect()] == [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0)]
    assert extract(df.limit(0)).count() == 0
