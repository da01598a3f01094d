"""Labelled pages for training the main-text extractor.

Pages are composed from layouts seen on the web: semantic elements, class-named divisions,
tables, blogs with comments, shops, bare paragraphs. Leaf blocks inside an element with the
attribute ``data-main`` are main text. Words are invented, so that only markup and the shape of
a text can be learnt, never its vocabulary; fixed phrases of notices are given in several languages.
"""

from __future__ import annotations

import random
import re

_NOTICES = (
    "We use cookies to improve your experience. Accept all", "Cookies help us. Learn more", "Subscribe to our newsletter",
    "Sign in to continue", "Wir verwenden Cookies. Zustimmen", "Nous utilisons des cookies. Accepter", "Utilizamos cookies. Aceptar",
    "Advertisement", "Sponsored", "Anzeige", "Publicité", "Share this", "Read more", "Follow us", "Skip to content", "Loading",
)
_RIGHTS = ("&copy; {0}", "&copy; 2024 {0} &middot; {1}", "Copyright 2023 {0}. All rights reserved.", "{0} | {1} | {2}", "&copy; {0} &middot; {1}.")


class _Words:
    def __init__(self, rng: random.Random):
        self.rng = rng
        letters = rng.choice(("aeiourtnsl", "aeiouérçdmp", "aäoueichsßt", "aeioñrslcd", "aeiouwhtdgnr"))
        self.parts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(40)]

    def word(self) -> str:
        return "".join(self.rng.choice(self.parts) for _ in range(self.rng.randint(1, 3)))

    def some(self, low: int, high: int) -> str:
        out = [self.word() + ("," if self.rng.random() < 0.05 else "") for _ in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.1:  # junk signs, as pages of poor quality have
            out = [w + self.rng.choice(("%%%", "***", "$$$", "&amp;&amp;&amp;", " |")) for w in out]
        return " ".join(out)

    def sentence(self, low: int = 1, high: int = 25) -> str:
        s = self.some(low, high)
        return s[:1].upper() + s[1:] + "."

    def paragraph(self) -> str:
        text = " ".join(self.sentence() for _ in range(self.rng.choice((1, 1, 2, 3, 5, 8))))
        if self.rng.random() < 0.2:
            text += f' <a href="/{self.word()}">{self.some(1, 4)}</a> {self.sentence()}'
        if self.rng.random() < 0.1:
            text = f"<b>{text}</b>"
        return text


def _article(w: _Words, heading: str) -> str:
    rng, out = w.rng, []
    if rng.random() < 0.85:
        out.append(f"<{heading}>{w.some(1, 10)}</{heading}>")
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.62:
            out.append(f"<p>{w.paragraph()}</p>")
        elif kind < 0.72:  # never closed
            out.append(f"<p><b>{w.paragraph()}<br>")
        elif kind < 0.78:
            out.append(f"<p>{w.sentence(1, 3)}</p>")
        elif kind < 0.83:
            out.append(f"<h2>{w.some(1, 6)}</h2>")
        elif kind < 0.88:
            out.append("<ul>" + "".join(f"<li>{w.sentence(2, 14)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.92:
            out.append(f"<blockquote>{w.paragraph()}</blockquote>")
        elif kind < 0.95:
            out.append("<table>" + "".join(f"<tr><td>{w.some(1, 3)}</td><td>{w.some(1, 3)}</td></tr>" for _ in range(rng.randint(1, 3))) + "</table>")
        elif kind < 0.97:
            out.append(f"<pre>{w.some(3, 12)}</pre>")
        else:
            out.append(f"<figure><img src=x><figcaption>{w.some(2, 9)}</figcaption></figure>")
    return "".join(out)


def _links(w: _Words, low: int = 2, high: int = 8) -> str:
    return "<ul>" + "".join(f'<li><a href="/{w.word()}">{w.some(1, 2)}</a></li>' for _ in range(w.rng.randint(low, high))) + "</ul>"


def _aside(w: _Words) -> str:
    """Boilerplate of one kind, in semantic or class-named markup."""
    rng = w.rng
    name = lambda *names: rng.choice(names)
    kinds = (
        lambda: f'<div class="{name("ad", "ads", "advert", "banner-ad", "promo", "sponsor")}">{w.sentence(1, 14)}</div>',
        lambda: f'<aside class="{name("sidebar", "side", "widget", "related")}"><h3>{w.some(1, 4)}</h3>{_links(w)}<p>{w.sentence(3, 16)}</p></aside>',
        lambda: f'<div id="{name("sidebar", "secondary", "right-col")}"><h3>{w.some(1, 3)}</h3><p>{w.sentence(3, 20)}</p>{_links(w)}</div>',
        lambda: f'<div class="{name("cookie-banner", "notice", "cookies", "consent", "alert", "gdpr-notice", "popup")}">{name("<p>{0}</p>", "{0}").format(rng.choice((rng.choice(_NOTICES), w.sentence(3, 16))))}</div>',
        lambda: f'<form action="/s"><label>{w.some(1, 3)}</label><input name=q><button>{w.some(1, 2)}</button><p>{w.sentence(2, 9)}</p></form>',
        lambda: f'<div class="{name("share", "social", "share-buttons")}"><a href=x>{w.word()}</a> <a href=y>{w.word()}</a></div>',
        lambda: f'<div class="{name("breadcrumb", "crumbs", "breadcrumbs")}"><a href=/>{w.word()}</a> &gt; <a href=/x>{w.word()}</a></div>',
        lambda: f'<section class="{name("related", "recommended", "more-stories")}"><h3>{w.some(1, 4)}</h3>' + "".join(f'<div><a href=z>{w.some(3, 9)}</a><p>{w.sentence(4, 14)}</p></div>' for _ in range(rng.randint(1, 3))) + "</section>",
        lambda: f'<div class="{name("newsletter", "subscribe", "signup")}"><h4>{w.some(1, 4)}</h4><p>{w.sentence(3, 14)}</p></div>',
        lambda: f"<aside><p>{w.sentence(3, 20)}</p></aside>",
        lambda: f'<p class="{name("ad", "sponsored", "notice", "disclaimer")}">{w.sentence(3, 16)}</p>',
    )
    return rng.choice(kinds)()


def _comments(w: _Words) -> str:
    rng = w.rng
    tag, name = rng.choice((("section", "comments"), ("div", "comment-list"), ("div", "responses"), ("ol", "commentlist"), ("div", "reader-comments")))
    attr = rng.choice(("id", "class"))
    item = rng.choice(("div", "article", "li"))
    body = "".join(
        f'<{item} class="comment"><span class="author">{w.word()}</span> {rng.choice(("<p>{0}</p>", "{0}")).format(w.paragraph())}</{item}>'
        for _ in range(rng.randint(1, 4)))
    return f'<{tag} {attr}="{name}"><h3>{w.some(1, 3)}</h3>{body}</{tag}>'


def page(seed: int) -> str:
    rng = random.Random(seed)
    w = _Words(rng)
    alone = rng.random() < 0.1  # nothing around the text
    maybe = lambda part, chance=0.5: part() if rng.random() < chance else ""
    out = [f"<!DOCTYPE html><html><head><title>{w.some(1, 9)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"]
    nav = rng.choice((
        lambda: f"<nav>{_links(w, 3, 9)}</nav>",
        lambda: f"<header><h1>{w.some(1, 3)}</h1><p>{w.some(2, 8)}</p><nav>{_links(w)}</nav></header>",
        lambda: f'<div class="{rng.choice(("menu", "nav", "navbar", "top-nav", "navigation"))}">{_links(w)}</div>',
        lambda: f'<div id="header"><a href="/">{w.some(1, 3)}</a><p>{w.some(2, 8)}</p></div><div id="menu">{_links(w)}</div>',
        lambda: f'<table><tr><td class="nav">{_links(w)}</td></tr></table>',
    ))
    out.append(maybe(nav, 0.0 if alone else 0.9))
    for _ in range(0 if alone else rng.randint(0, 2)):
        out.append(_aside(w))
    shell, end = rng.choice((
        ("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"),
        ('<div class="content">', "</div>"), ('<div id="main-content">', "</div>"), ('<div class="post"><div class="entry-content">', "</div></div>"),
        ('<div class="article-body">', "</div>"), ('<section class="story">', "</section>"), ("<div>", "</div>"), ('<td class="text">', "</td>"),
        ("<article>", "</article>"), ("<article>", "</article>"),
    ))
    first, rest = shell.split(">", 1)
    inner = _article(w, rng.choice(("h1", "h1", "h2")))
    if rng.random() < 0.25:  # boilerplate inside the article
        inner += f'<div data-other="1">{rng.choice((_aside, _aside, _comments))(w)}</div>'
        if rng.random() < 0.5:
            inner += f"<p>{w.paragraph()}</p>"
    if rng.random() < 0.1:  # no element of its own around the text
        out.append(re.sub(r"<(p|h1|h2|ul|blockquote|table|pre|figure)>", r'<\1 data-main="1">', _article(w, "h1")))
    else:
        out.append(f'{first} data-main="1">{rest}{inner}{end}')
    out.append(maybe(lambda: _comments(w), 0.35))
    for _ in range(0 if alone else rng.randint(0, 2)):
        out.append(_aside(w))
    rights = rng.choice(_RIGHTS).format(w.word() + ".example", w.sentence(1, 12), w.some(1, 3))
    foot = rng.choice((
        f"<footer>{rights}</footer>", f"<footer><p>{rights}</p>{_links(w, 1, 4)}</footer>", f'<div class="footer">{rights}</div>',
        f'<div id="footer"><p>{rights}</p><p>{w.some(2, 9)}</p></div>', f"<footer><div>{w.sentence(2, 14)}</div><p>{rights}</p></footer>",
    ))
    out.append(foot if rng.random() < (0.0 if alone else 0.9) else "")
    text = "".join(out) + ("</body></html>" if rng.random() < 0.9 else "")
    return text.replace("</head>", "") if seed % 10 == 3 else text
