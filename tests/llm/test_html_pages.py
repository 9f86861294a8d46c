"""Page text over generated pages whose article is known: what is left out, and what gets in."""

import random

import pytest

from reviewmill.llm.html_text import main_text

LONG = "A sentence of this part of the page with quite a few words in it, as articles have. "
OTHERS = [
    "comment-list", "user-comments", "left-sidebar", "site-footer", "cookie-bar", "ad-slot", "ad-container",
    "related-posts", "commentList", "js-newsletter-signup", "social-share-buttons", "widget-area", "wp-comments",
    "promo_box", "breadcrumbs", "comments", "main-nav", "footer__links",
]


@pytest.mark.parametrize("name", OTHERS)
@pytest.mark.parametrize("place", ["inside", "before", "after", "inside-main"])
@pytest.mark.parametrize("key", ["class", "id"])
def test_parts_named_as_other_things_go(name, place, key):
    other = f"<div {key}='{name}'><p>{LONG.replace('article', 'other')}</p><p>Great, I agree.</p></div>"
    body = f"<h1>Head</h1><p>{LONG * 2}</p><p>{LONG * 3}</p>"
    page = {
        "inside": f"<article>{body}{other}<p>End.</p></article>",
        "before": f"{other}<article>{body}<p>End.</p></article>",
        "after": f"<article>{body}<p>End.</p></article>{other}",
        "inside-main": f"<main><div class='content'>{body}<p>End.</p></div>{other}</main>",
    }[place]
    wanted = ["Head", (LONG * 2).strip(), (LONG * 3).strip(), "End."]
    assert main_text(f"<html><body>{page}</body></html>").split("\n") == wanted


@pytest.mark.parametrize("name", ["no-sidebar", "content-sidebar-wrap", "has-comments", "side-effects", "ad-hoc",
                                  "layout-sidebar", "share-of-market", "with-ads"])
def test_parts_with_such_words_that_hold_the_article_stay(name):
    page = f"<div id='{name}' class='{name}'><h2>Head</h2><p>{LONG * 3}</p><p>{LONG}</p></div><footer>x</footer>"
    assert main_text(page).split("\n") == ["Head", (LONG * 3).strip(), LONG.strip()]


def test_long_comments_do_not_displace_a_short_article():
    comments = "".join(f"<li><p>{LONG}</p></li>" for _ in range(30))
    for page in (f"<article><p>{LONG * 4}</p><p>{LONG * 4}</p><div class=comments><ul>{comments}</ul></div></article>",
                 f"<div id=content><p>{LONG * 4}</p><p>{LONG * 4}</p></div><div id=comments><ul>{comments}</ul></div>"):
        assert main_text(page).split("\n") == [(LONG * 4).strip()] * 2


def generated(seed):
    """A page and its article's lines."""
    draws = random.Random(seed)

    def words(low, high):
        return " ".join("".join(draws.choices("abcdefghij", k=draws.randrange(2, 9)))
                        for _ in range(draws.randrange(low, high))) + f" {draws.random():.12f}."

    lines, body = [], []
    for _ in range(draws.randrange(3, 14)):
        kind, text = draws.choice(["p", "p", "p", "p", "h2", "li", "blockquote"]), None
        text = words(1, 5) if kind == "h2" else words(8, 60)
        lines.append(text)
        body.append(f"<ul><li>{text}</li></ul>" if kind == "li" else f"<{kind}>{text}</{kind}>")

    def other():
        name, tag = draws.choice(OTHERS), draws.choice(["div", "section", "ul"])
        inner = "".join(f"<p>{words(2, 25)}</p>" if draws.random() < 0.5 else f"<a href=x>{words(1, 3)}</a> "
                        for _ in range(draws.randrange(1, 5)))
        return f"<{tag} {draws.choice(['class', 'id'])}='{name}'>{inner}</{tag}>"

    for _ in range(draws.randrange(3)):
        body.insert(draws.randrange(len(body) + 1), other())
    start, end = draws.choice([("<article>", "</article>"), ("<main><div>", "</div></main>"),
                               ("<div class='post-body'>", "</div>"), ("<div id=content><article>", "</article></div>")])
    menu = "".join(f"<li><a href=x>{words(1, 3)}</a></li>" for _ in range(draws.randrange(3, 9)))
    page = (f"<html><head><title>t</title></head><body><header>{words(1, 4)}</header><nav><ul>{menu}</ul></nav>"
            + "".join(other() for _ in range(draws.randrange(3))) + start + "".join(body) + end
            + "".join(other() for _ in range(draws.randrange(3))) + f"<footer><p>{words(3, 20)}</p></footer></body></html>")
    return page, lines


def test_precision_and_recall_of_lines():
    found = right = wanted = 0
    for seed in range(600):
        page, lines = generated(seed)
        made = main_text(page).split("\n")
        found, wanted = found + len(made), wanted + len(lines)
        right += len(set(made) & set(lines))
    assert right / found > 0.99 and right / wanted > 0.99, (right / found, right / wanted)
