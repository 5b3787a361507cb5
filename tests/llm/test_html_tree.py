from __future__ import annotations

import html
import random
import re
import time

import pytest

from requestmill.llm import html_tree
from requestmill.llm.html_tree import main_text

from .conftest import SF

LONG = "A sentence of the story, with commas, and words enough to count as text. " * 3


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def lines(*parts):
    return "\n".join(p.strip() for p in parts)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in html_tree.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        body = re.sub(r"<[^>]*$", "", body.replace("<br>", " "))
        blocks = re.split(r"<[^>]+>", re.sub(r"</?b>", "", body))
        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want
        assert got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


def test_best_container_without_article_tags():
    menu = "".join(f'<li><a href="/{k}">Menu entry {k}, a long one</a></li>' for k in range(30))
    text = page(
        f"<div class=top><ul>{menu}</ul></div><div><div class=story><h2>Title</h2><p>{LONG}</p>"
        f"<p>Short.</p><ul><li>one</li><li>two</li></ul><p>{LONG}</p></div>"
        '<div class="related-links"><p>' + LONG + "</p></div></div>"
    )
    assert main_text(text) == lines("Title", LONG, "Short.", "one", "two", LONG)


@pytest.mark.parametrize(
    "extra",
    [
        "<nav><p>{}</p></nav>",
        "<header><p>{}</p></header>",
        "<footer>{}</footer>",
        "<aside><p>{}</p></aside>",
        "<form><p>{}</p><input></form>",
        "<script>var a = '<p>{}</p>';</script>",
        "<style>p {{ }} {}</style>",
        '<div class="ad">{}</div>',
        '<div id="cookie-notice"><p>{}</p></div>',
        '<section class="comments"><p>{}</p></section>',
        '<div role="navigation"><p>{}</p></div>',
        "<div hidden><p>{}</p></div>",
        "<!-- <p>{}</p> -->",
    ],
)
@pytest.mark.parametrize("inside", [False, True])
def test_furniture_is_left_out(extra, inside):
    if extra.startswith("<header") and inside:
        return  # an article's own header belongs to it
    extra = extra.format("Other words, many of them, not of the article. " * 9)
    story = f"<h1>Head</h1><p>{LONG}</p>{{}}<p>{LONG}</p>"
    body = f"<article>{story.format(extra)}</article>" if inside else (
        extra + f"<article>{story.format('')}</article>" + extra
    )
    assert main_text(page(body)) == lines("Head", LONG, LONG)


@pytest.mark.parametrize(
    "name",
    ["content has-sidebar", "layout sidebar-right", "with-header", "post-content widget-area", "withSidebar"],
)
@pytest.mark.parametrize("tag", ["article", "div", "section"])
def test_named_wrappers_keep_the_text(name, tag):
    body = f'<div class="{name}"><{tag}><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></{tag}></div>'
    assert main_text(page("<nav><p>menu</p></nav>" + body)) == lines("Head", LONG, LONG)
    assert main_text(page(body.replace("<h1>", "<h2>").replace("</h1>", "</h2>"))) == lines("Head", LONG, LONG)


@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div>{}</div>", "{}"])
def test_a_form_around_the_page(inner):
    text = inner.format(f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>")
    fields = "<label>Your name</label><input><select><option>One<option>Two</select><button>Go</button>"
    assert main_text(page(f"<form>{fields}{text}</form>")) == lines("Head", LONG, LONG)
    assert main_text(page(text + f"<form><p>Tell us</p>{fields}</form>")) == lines("Head", LONG, LONG)


def test_names_inside_an_article():
    body = (
        '<article><div class="entry-header"><h2>Head</h2></div>'
        f'<section class="social-policy"><p>{LONG}</p></section>'
        f'<div class="notice-of-meeting"><p>The meeting is on Monday.</p></div><p>{LONG}</p>'
        '<div class="sharing"><p>Tell your friends</p></div><div id="site-notice">Sale</div></article>'
    )
    assert main_text(page(body)) == lines("Head", LONG, "The meeting is on Monday.", LONG)


def test_hidden_content_stays_hidden():
    select = "<select><option>One<option>Two<p>Three</select>"
    body = f"<article><p>{LONG}{select} and on</p><p hidden>no<p>{LONG}</article>"
    assert main_text(page(body)) == lines(f"{LONG.strip()} and on", LONG)
    body = f"<article><p>{LONG}</p><ul><li hidden>no<li>yes</ul><div><svg><p>no</div><p>{LONG}</p></article>"
    assert main_text(page(body)) == lines(LONG, "yes", LONG)
    assert main_text(f"<html><head><title>T<body><p>{LONG}</p>") == ""  # a title that never ends
    assert main_text(f"<html><head><title>T</title><body><p>{LONG}</p>") == LONG.strip()
    assert main_text(page(f"<article><svg/><p>{LONG}</p></article>")) == LONG.strip()


def test_title_in_a_container_before_the_text():
    body = f'<div class="top"><h1>Head</h1></div><div class="story"><p>{LONG}</p><p>{LONG}</p></div>'
    assert main_text(page(body)) == lines("Head", LONG, LONG)
    assert main_text(page(f"<div>{body}</div>")) == lines("Head", LONG, LONG)
    body = f"<div><h1>Head</h1></div><article><p>{LONG}</p></article>"
    assert main_text(page(body)) == lines("Head", LONG)
    body = f"<header><h1>Site</h1></header><article><h1>Head</h1><p>{LONG}</p></article>"
    assert main_text(page(body)) == lines("Head", LONG)


def test_comments_go_however_many():
    many = "".join(f'<article class="comment"><p>{LONG * 3}</p></article>' for _ in range(20))
    for tag in ("article", "div"):
        body = f'<{tag}><h1>Head</h1><p>{LONG}</p></{tag}><div class="comments">{many}</div>'
        assert main_text(page(body)) == lines("Head", LONG)
    plain = many.replace("article", "div")
    body = f'<div><p>{LONG}</p><p>{LONG}</p></div><div id="comments">{plain}</div>'
    assert LONG.strip() in main_text(page(body))


@pytest.mark.parametrize("opened", ["<div>", "<p><b>", "<ul><li>", "<span>", "<table><tr><td>", "<select>", "<p hidden>"])
def test_deep_nesting_is_linear(opened):
    began = time.process_time()
    main_text(page(opened * 20_000 + f"<p>{LONG}</p>"))
    main_text(page(opened * 20_000 + f"<p>{LONG}</p>" + "</div></li></td></p>" * 20_000))
    assert time.process_time() - began < 30


# A second scorer: plain recursion over nested lists, straight from the rules.


def slow_points(tree, found, links=False):
    """tree: (tag, name, children); found: id -> [points, chars, link chars]."""
    tag, _, children = tree
    own = found.setdefault(id(tree), [0.0, 0, 0])
    paragraphs = []
    text = ""
    for c in children:
        if isinstance(c, str):
            text += c
        else:
            below = slow_points(c, found)
            own[1] += found[id(c)][1]
            own[2] += found[id(c)][2]
            for worth, level in below:
                paragraphs.append((worth, level + 1))
    own[1] += len(" ".join(text.split()))
    if tag == "a":
        own[2] = own[1]
    if tag in ("p", "li") or (tag == "div" and text.strip()):
        worth = (own[1] >= 25) + text.count(",") + min(own[1] / 100, 3)
        worth *= 1 - own[2] / own[1] if own[1] else 0
        paragraphs.append((worth, 0 if tag != "div" else 1))
    shares = [None, 1.0, 0.5, 0.5 / 1.5, 0.5 / 1.5 / 1.5]
    for worth, level in paragraphs:
        if 1 <= level <= 4:
            own[0] += worth * shares[level]
    return paragraphs


def random_tree(rng, depth=0):
    children = []
    for _ in range(rng.randint(1, 4)):
        words = ", ".join(["word"] * rng.randint(1, 30))
        if depth < 4 and rng.random() < 0.5:
            children.append(random_tree(rng, depth + 1))
        elif rng.random() < 0.2:
            children.append(("p", "", [("a", "", [words])]))
        else:
            children.append(("p", "", [words]))
    return ("div", "", children)


def as_html(tree):
    tag, _, children = tree
    return f"<{tag}>" + "".join(c if isinstance(c, str) else as_html(c) for c in children) + f"</{tag}>"


@pytest.mark.parametrize("seed", range(20))
def test_scores_by_brute_force(seed):
    tree = random_tree(random.Random(seed))
    found = {}
    slow_points(tree, found)
    scores = []

    def walk(node):
        p, chars, link_chars = found[id(node)]
        if node[0] == "div":
            scores.append(p * (1 - link_chars / max(1, chars)))
        for c in node[2]:
            if not isinstance(c, str):
                walk(c)

    walk(tree)
    builder = html_tree.Builder()
    builder.feed(as_html(tree))
    html_tree._cut(builder.root)
    nodes = html_tree._walk(builder.root)
    html_tree._measure(nodes)
    html_tree._pass_points(nodes)
    got = [html_tree._score(n) for n in html_tree._in_order(builder.root) if n.tag == "div"]
    assert got == pytest.approx(scores)


def test_sections_of_one_article_stay_together():
    body = f"<article><h1>H</h1><section><p>{LONG}</p></section><section><p>x</p></section></article>"
    assert main_text(page(body)) == lines("H", LONG, "x")


def test_white_space_references_and_open_tags():
    body = f"<article><p>a &amp; b&nbsp;&lt;c&gt; &#233;<b>x</b>y\n\t z<p>second<br>line<div>{LONG}</div></article>"
    assert main_text(page(body)) == lines("a & b <c> éxy z", "second line", LONG)


def test_links_count_less():
    links = "".join(f'<p><a href="#">{LONG}</a></p>' for _ in range(9))
    assert main_text(page(f"<div>{links}</div><div><p>{LONG}</p></div>")) == lines(LONG)


def test_odd_pages(spark):
    odd = [None, "", "   ", "plain words, no tags", "<p>", "<div><p>cut off in the mid", "<a <b <<", "&#0;"]
    odd += ["<div>" * 3_000 + "deep" + "</div>" * 3_000, f"<p>{LONG * 2_000}</p>", "<p>x</p>", "<p>x</p>"]
    pages = spark.createDataFrame(
        [(k, None, h) for k, h in enumerate(odd)], "page_id long, url string, html string"
    ).selectExpr("*", "'t' AS text", "1 AS n_chars")
    rows = {r["page_id"]: r for r in html_tree.extract(pages).collect()}
    assert len(rows) == len(odd)
    assert [rows[k]["text"] for k in (0, 1, 2)] == ["", "", ""]
    assert rows[3]["text"] == "plain words, no tags" and rows[5]["text"] == "cut off in the mid"
    assert rows[8]["text"] == "deep" and rows[9]["n_chars"] == len((LONG * 2_000).strip())
    assert html_tree.extract(pages.where("false")).count() == 0
