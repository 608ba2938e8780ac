"""Labelled pages for the extraction model, written by rule from a few layouts.

data-y="1" marks main text, data-y="0" everything else; descendants inherit the mark.
"""

from __future__ import annotations

import random

# Words of the pages' sentences.
WORDS = "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system program question work government number night point home water room mother area money story fact month lot right study book eye job word business issue side kind head house service friend father power hour game line end member law car city community name".split()
MENU = "Home About News Contact Products Blog Shop Help Login Archive".split()


def labelled_pages(n: int = 200, seed: int = 7) -> list[str]:
    """n pages; the same ones for the same seed."""
    pick = random.Random(seed)
    return [_page(pick) for _ in range(n)]


def _sentence(r: random.Random, low: int = 5, high: int = 18) -> str:
    return (" ".join(r.choice(WORDS) for _ in range(r.randint(low, high))) + r.choice([".", ".", "!", "?", " &amp; more."])).capitalize()


def _paragraph(r: random.Random) -> str:
    text = " ".join(_sentence(r) for _ in range(r.choice([1, 1, 2, 3, 5])))
    if r.random() < 0.25:
        text += f' <a href="/x">{r.choice(WORDS)} {r.choice(WORDS)}</a>.'
    return r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p><b>{}<br>", "<p>{}"]).format(text)


def _links(r: random.Random, tag: str = "ul") -> str:
    items = [r.choice(MENU + WORDS) for _ in range(r.randint(3, 8))]
    if tag == "ul":
        return "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in items) + "</ul>"
    return " | ".join(f'<a href="/{w}">{w}</a>' for w in items)


def _short(r: random.Random) -> str:
    return " ".join(_sentence(r, 2, 9) for _ in range(r.choice([1, 1, 2])))


def _page(r: random.Random) -> str:
    main = _paragraph(r) + "".join(r.choice([_paragraph(r)] * 7 + [f"<h2>{_sentence(r, 2, 5)}</h2>", f"<blockquote><p>{_sentence(r)}</p></blockquote>", "<ul>" + "".join(f"<li>{_sentence(r)}</li>" for _ in range(3)) + "</ul>", f"<pre>{_sentence(r)}</pre>", f"<table><tr><td>{_sentence(r, 2, 4)}</td><td>{_sentence(r, 2, 4)}</td></tr></table>"]) for _ in range(r.choice([0, 0, 1, 2, 4, 8])))
    title = f"<h1>{_sentence(r, 3, 8)}</h1>"
    main_tag = r.choice(["<article{}>{}</article>"] * 5 + ["<main{}>{}</main>", "<div class=\"content\"{}>{}</div>", "<div id=\"main\"{}><div class=\"post-body\">{}</div></div>", "<div{}>{}</div>", "<section class=\"entry\"{}>{}</section>"])
    article = main_tag.format(' data-y="1"', title + main)

    nav = r.choice(["<nav>{}</nav>", "<nav>{}</nav>", '<div class="menu">{}</div>', '<div id="nav">{}</div>', '<ul class="navbar"><li>{}</li></ul>']).format(_links(r, r.choice(["ul", "ul", "plain"])))
    header = r.choice(["<header>{}</header>", '<div class="header">{}</div>', '<div id="masthead">{}</div>']).format(r.choice([f"<h1>{_sentence(r, 1, 3)}</h1>", f'<p class="logo">{_sentence(r, 1, 4)}</p>', _links(r, "plain")]))
    footer = r.choice(["<footer>{}</footer>", "<footer>{}</footer>", '<div class="footer">{}</div>', '<div id="footer"><p>{}</p></div>']).format(f"&copy; {r.choice(WORDS)}.example.com &middot; " + _short(r) + r.choice(["", _links(r, "plain")]))
    advert = r.choice(['<div class="ad">{}</div>', '<div class="ad">{}</div>', '<div class="advert">{}</div>', '<aside class="promo"><p>{}</p></aside>', '<div class="sponsored"><p>{}</p></div>', '<div id="banner-ad">{}</div>']).format(_short(r))
    side = r.choice(["<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div class="related"><h3>Related</h3>{}</div>', '<div id="widget">{}</div>']).format(r.choice([_links(r), f"<p>{_short(r)}</p>", f"<h3>{_sentence(r, 1, 3)}</h3><p>{_short(r)}</p>"]))
    notice = r.choice(['<div class="notice">{}</div>', '<div class="cookie-banner"><p>{}</p></div>', '<div id="consent"><p>{}</p><button>OK</button></div>', '<div class="newsletter">{}</div>', '<p class="notice">{}</p>', '<div class="alert">{}</div>']).format(_short(r))
    form = r.choice(['<form action="/s"><label>{}</label><input name="q"><button>Go</button></form>', '<form class="search"><p>{}</p><input></form>']).format(_sentence(r, 1, 6))
    comments = r.choice(['<section class="comments"><h3>Comments</h3>{}</section>', '<div id="comments">{}</div>', '<div class="comment-list"><ol>{}</ol></div>']).format("".join(r.choice(["<div class=\"comment\"><p>{}</p></div>", "<p class=\"reply\">{}</p>", "<li class=\"comment\">{}</li>"]).format(_short(r)) for _ in range(r.randint(1, 3))))

    top = [x for x, p in ((header, 0.4), (nav, 0.8), (notice, 0.3), (advert, 0.6), (form, 0.2), (side, 0.2)) if r.random() < p]
    end = [x for x, p in ((side, 0.3), (comments, 0.35), (form, 0.2), (notice, 0.2), (advert, 0.2), (footer, 0.85)) if r.random() < p]
    if r.random() < 0.3:  # something foreign inside the article
        inner = r.choice([advert, notice, comments, form, side]).replace("<", "<", 1)
        tag_end = inner.index(">")
        inner = inner[:tag_end] + ' data-y="0"' + inner[tag_end:]
        article = main_tag.format(' data-y="1"', title + _paragraph(r) + "</b></p>" + inner + main)
    bare = r.random() < 0.08  # a page that is nothing but its text
    if bare:
        top, end, article = [], [], r.choice(["", title]) + main
    body = "".join(top) + article + "".join(end)
    if r.random() < 0.3:
        body = r.choice(['<div class="wrapper">{}</div>', '<div id="page">{}</div>', "<div>{}</div>"]).format(body)
    return f'<!DOCTYPE html><html lang="en"><head><title>{_sentence(r, 2, 6)}</title><style>p{{}}</style></head><body data-y="{int(bare)}">{body}</body></html>'
