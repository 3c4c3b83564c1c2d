"""Class names and ids that hold words of what is left out."""

from __future__ import annotations

import pytest

from sparkmart.llm import pages

LONG = "A paragraph of the article that is long enough to be taken for content by its ratio of text to tags"
ARTICLE = f"<h1>Title</h1><p>{LONG}, one.</p><p>{LONG}, two.</p>"
WANT = f"Title\n{LONG}, one.\n{LONG}, two."


@pytest.mark.parametrize("name", ["content has-sidebar", "no-comments", "ad-free", "with-header", "widget", "page_header"])
def test_containers_of_the_article_stay(name):
    for tag in ("div", "section", "my-app"):
        assert pages.main_text(f"<body><nav>menu</nav><{tag} class='{name}'>{ARTICLE}<div class='ad'>Buy this now</div></{tag}><footer>f</footer></body>") == WANT


def test_headings_and_what_is_still_left_out():
    page = f"<body><article><div class='article-header'><h1>Title</h1></div><p>{LONG}, one.</p><p>{LONG}, two.</p><div class='related-posts'>{LONG}</div></article><div id='comments'><p>{LONG}</p></div></body>"
    assert pages.main_text(page) == WANT


SHORT = "<article><h1>Title</h1><p>One paragraph of the article, no more than that.</p></article>"
SHORT_TEXT = "Title\nOne paragraph of the article, no more than that."
OTHERS = "".join(f"<p>{LONG}, said reader {i}.</p>" for i in range(6))


@pytest.mark.parametrize(
    "outside",
    [
        f'<div id="comments">{OTHERS}</div>', f'<section class="comments">{OTHERS}</section>', f'<ol class="commentlist"><li>{OTHERS}</li></ol>',
        f'<div class="cookie-notice">{OTHERS}</div>', f'<div class="gdpr-consent">{OTHERS}</div>', f'<div class="site-notice">{OTHERS}</div>',
        f'<div class="ads">{OTHERS}</div>', f'<div id="sponsored">{OTHERS}</div>', f'<div class="sidebar">{OTHERS}</div>', f'<div class="nav">{OTHERS}</div>',
        f'<div class="related">{OTHERS}</div>', f"<aside>{OTHERS}</aside>", f"<footer>{OTHERS}</footer>", f"<form>{OTHERS}</form>", f"<nav>{OTHERS}</nav>", f"<header>{OTHERS}</header>",
        f'<div role="complementary">{OTHERS}</div>', f"<script>{OTHERS}</script>", f"<style>{OTHERS}</style>",
    ],
)
def test_what_is_no_content_goes_whatever_its_length(outside):
    assert pages.main_text(f"<body>{SHORT}{outside}</body>") == SHORT_TEXT
    assert pages.main_text(f"<body>{outside}{SHORT}</body>") == SHORT_TEXT
    if "<header" not in outside:
        assert pages.main_text(f"<body>{SHORT.replace('</article>', outside + '</article>')}</body>") == SHORT_TEXT


def test_comments_alone_are_no_article():
    assert pages.main_text(f'<body><div id="comments"><h1>Comments</h1>{OTHERS}</div></body>') == ""
