"""What a class, an id or another attribute says of an element, and pages that are deeply nested."""

from __future__ import annotations

import time

import pytest

from tallyward.llm import html

LONG = "word " * 60


def text(body):
    return html.extract(f"<html><body>{body}</body></html>", None)


@pytest.mark.parametrize("opening", [
    '<div class="content has-sidebar">', '<article class="post no-ad">', '<div class="sidebar-left">', '<section id=banner>', '<div role="form">'])
def test_a_page_is_not_lost_by_the_name_of_its_main_element(opening):
    tag = opening[1:].split()[0]
    assert text(f"<nav>menu</nav>{opening}<p>{LONG}</p><div class=comments>said</div></{tag}>") == LONG.strip()


@pytest.mark.parametrize("attribute", [
    'class="form-factor"', 'id="notice-to-readers"', 'data-id="share"', 'data-hidden="false"', 'title="a hidden gem"',
    'style="overflow: hidden ; color: red"', "data-x='class=ad'", 'class="lead"', 'class="header-image-caption"', 'class="comment-free"'])
def test_blocks_that_only_look_marked_stay(attribute):
    assert text(f"<article><p>{LONG}</p><div {attribute}>This stays.</div></article>") == f"{LONG.strip()}\n\nThis stays."


@pytest.mark.parametrize("attribute", [
    'class="ad"', 'class="x ad-slot-3"', 'class="adsbygoogle"', 'class="gpt-slot"', 'class="cookie-notice"', 'id="comment-list"', "class=site-header",
    "CLASS=Sidebar", 'class="share-buttons"', "hidden", 'aria-hidden="true"', 'role="navigation"', 'data-a="1" class="related-posts"', "class = 'promo'"])
def test_marked_blocks_go(attribute):
    assert text(f"<article><p>{LONG}</p><div {attribute}>This goes.</div></article>") == LONG.strip()


def test_comments_go_even_when_they_are_most_of_the_page():
    assert text(f"<article><p>Short but the article itself.</p></article><div class=comments><p>{LONG * 9}</p></div>") == "Short but the article itself."


def test_a_formula_within_a_sentence_stays():
    assert text(f"<article><p>{LONG}</p><p>So <math><mi>x</mi> = <mn>2</mn></math> holds.</p></article>").endswith("So x = 2 holds.")


@pytest.mark.parametrize("page", ["<div class=a>" * 100_000, "<b>" * 100_000, "<div>" * 50_000 + "</b>" * 50_000, "<ul><li>" * 50_000, "<section><p>x" * 30_000])
def test_deep_pages_take_no_more_than_their_length(page):
    began = time.process_time()
    html.extract(page + "text", None)
    assert time.process_time() - began < 5  # seconds where each element costs the same; hours where it costs what is above it


def test_paths_of_deep_pages_are_told_apart_and_bounded():
    deep = "<div class=level>" * 2_000
    one, other = html.vote(deep + "<section>text"), html.vote(deep + "<td>text")
    assert one[0] != other[0] and len(one[0]) < 2_000 and one == html.vote(deep + "<section>text")


def test_many_containers_of_one_path_under_a_deep_one():
    page = "<div>" * 3_000 + "<section>part</section>" * 3_000
    path = html.parse(page).paths[-1]
    assert html.extract(page, path).count("part") == 3_000


def test_extra_columns_with_the_names_used_inside(spark):
    rows = [(1, "http://a.example/1", f"<article><p>{LONG}</p></article>", "h", "p", "t")]
    got = html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, _host string, _path string, text string")).first()
    assert (got["_host"], got["_path"], got["text"]) == ("h", "p", LONG.strip())
