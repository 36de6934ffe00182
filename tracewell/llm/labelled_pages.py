"""Labelled pages to learn from: made up, with what sites put around an article, in many kinds of mark-up.

A labelled page is HTML whose elements may bear data-content="1" or "0"; a text's label is that of the nearest such
element, 0 if none.  The reader of pages doesn't use that attribute as evidence.
"""

from __future__ import annotations

import random

_SYLLABLES = "an ar be da de el en er es fi ga ha in is ka la le lo ma me mi na ne no on or pa re ri ro sa se si ta te ti to un ur va ve wi".split()


class _Writer:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentences(self, lo: int, hi: int) -> str:
        out = []
        for _ in range(self.r.randint(lo, hi)):
            s = self.words(1, 18).capitalize()
            if self.r.random() < 0.2:
                s = s.replace(" ", ", ", 1)
            if self.r.random() < 0.1:
                s = s.replace(" ", f" <{'b' if self.r.random() < 0.5 else 'em'}>{self.word()}</b> ", 1)
            if self.r.random() < 0.1:
                s = s.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
            out.append(s + self.r.choice("...!?"))
        return " ".join(out)

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def attribute(self, *names: str) -> str:
        """A class or id of one of these names, or with other words beside it; sometimes none."""
        name = self.r.choice(names)
        if self.r.random() < 0.3:
            name = self.r.choice([f"{name} {self.word()}", f"{self.word()}-{name}", f"{name}-{self.word()}", f"{name}{self.r.randint(1, 9)}"])
        return f' {self.pick("class", "class", "id")}="{name}"'

    # what surrounds an article
    def links(self, lo: int = 3, hi: int = 9) -> str:
        one = lambda: f'<a href="/{self.word()}">{self.words(1, 4)}</a>'
        kind = self.r.randint(0, 2)
        n = self.r.randint(lo, hi) * (self.r.randint(4, 12) if self.r.random() < 0.03 else 1)
        if kind == 0:
            return "<ul>" + "".join(f"<li>{one()}</li>" for _ in range(n)) + "</ul>"
        return (" | " if kind == 1 else "\n").join(one() for _ in range(n))

    def menu(self) -> str:
        return self.pick(f"<nav{self.maybe('nav', 'menu', 'main-nav')}>{self.links()}</nav>", f"<div{self.attribute('nav', 'menu', 'navbar', 'navigation', 'breadcrumb', 'breadcrumbs', 'topnav', 'pagination')}>{self.links()}</div>", f"<ul{self.attribute('menu', 'nav', 'navigation', 'breadcrumb')}><li><a href='/'>{self.words(1, 2)}</a></li><li><a href='/x'>{self.words(1, 2)}</a></li><li>{self.words(1, 3)}</li></ul>")

    def maybe(self, *names: str) -> str:
        return self.attribute(*names) if self.r.random() < 0.5 else ""

    def header(self) -> str:
        inner = f"<{self.pick('h1', 'h2', 'div', 'p')}>{self.words(1, 4)}</a>" if self.r.random() < 0.5 else f"<div{self.attribute('logo', 'brand', 'site-title')}><a href='/'>{self.words(1, 3)}</a></div><p>{self.words(2, 8)}</p>"
        inner += self.menu() if self.r.random() < 0.4 else ""
        return self.pick(f"<header{self.maybe('header', 'site-header', 'masthead')}>{inner}</header>", f"<div{self.attribute('header', 'masthead', 'site-header', 'topbar', 'page-header', 'top')}>{inner}</div>")

    def footer(self) -> str:
        inner = self.pick(f"&copy; {self.words(1, 3)} &middot; {self.sentences(1, 2)}", f"<p>&copy; 20{self.r.randint(10, 25)} {self.words(1, 4)}. {self.sentences(1, 1)}</p>", self.links(), f"<p>{self.sentences(1, 4)}</p>{self.links()}")
        return self.pick(f"<footer{self.maybe('footer', 'site-footer')}>{inner}</footer>", f"<div{self.attribute('footer', 'site-footer', 'copyright', 'bottom', 'legal')}>{inner}</div>")

    def sidebar(self) -> str:
        inner = "".join(self.pick(f"<h3>{self.words(1, 3)}</h3>{self.links()}", f"<p>{self.sentences(1, 4)}</p>", self.links(), f"<div{self.attribute('widget', 'box')}>{self.sentences(1, 3)}</div>") for _ in range(self.r.randint(1, 3)))
        return self.pick(f"<aside{self.maybe('sidebar', 'aside')}>{inner}</aside>", f"<div{self.attribute('sidebar', 'side', 'aside', 'widget', 'related', 'recommended', 'popular', 'trending', 'more-stories')}>{inner}</div>", f"<section{self.attribute('related', 'recommended', 'more', 'sidebar')}>{inner}</section>")

    def advert(self) -> str:
        inner = self.pick(self.sentences(1, 3), f"<p>{self.sentences(1, 4)}</p>", f"<a href='/x'>{self.words(2, 8)}</a>", f"<div>{self.sentences(1, 6)}</div>")
        return self.pick(f"<div{self.attribute('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'sponsor', 'promo', 'banner', 'adsense', 'ad-slot')}>{inner}</div>", f"<aside{self.attribute('ad', 'advert', 'promo', 'sponsored')}>{inner}</aside>", f"<section{self.attribute('ad', 'ads', 'promo')}>{inner}</section>")

    def notice(self) -> str:
        inner = self.pick(f"<p>{self.sentences(1, 4)}</p><button>{self.words(1, 2)}</button>", self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>")
        return self.pick(f"<div{self.attribute('cookie', 'cookie-notice', 'cookie-banner', 'consent', 'notice', 'alert', 'gdpr', 'popup', 'modal', 'newsletter', 'subscribe', 'paywall', 'warning', 'overlay', 'message')}>{inner}</div>", f'<div role="{self.pick("alert", "dialog", "banner")}">{inner}</div>', f"<dialog>{inner}</dialog>", f"<aside{self.attribute('notice', 'newsletter')}>{inner}</aside>", f"<section{self.attribute('notice', 'newsletter', 'cookie')}>{inner}</section>", f"<p{self.attribute('notice', 'alert', 'disclaimer')}>{self.sentences(1, 3)}</p>")

    def form(self) -> str:
        return f"<form{self.maybe('search', 'login', 'signup', 'subscribe', 'comment-form')}><label>{self.words(1, 3)}</label><input name='q'><p>{self.sentences(1, 2)}</p><button>{self.words(1, 2)}</button></form>"

    def comments(self) -> str:
        one = self.pick("li", "div", "article")
        each = lambda: f"<{one}{self.attribute('comment', 'reply', 'comment-body')}><{self.pick('b', 'cite', 'h4')}>{self.words(1, 2)}</b></cite></h4><p>{self.sentences(1, 6)}</p>{'<p>' + self.sentences(1, 4) + '</p>' if self.r.random() < 0.3 else ''}</{one}>"
        inner = f"<h3>{self.words(1, 3)}</h3>" * self.r.randint(0, 1) + "".join(each() for _ in range(self.r.randint(20, 90) if self.r.random() < 0.08 else self.r.randint(1, 6)))
        if one == "li":
            inner = f"<ol>{inner}</ol>"
        return self.pick(f"<section{self.attribute('comments', 'responses', 'discussion', 'replies', 'comment-list')}>{inner}</section>", f"<div{self.attribute('comments', 'comment-section', 'responses', 'discussion', 'disqus', 'replies')}>{inner}</div>")

    def share(self) -> str:
        return f"<{(t := self.pick('div', 'ul', 'p'))}{self.attribute('share', 'social', 'sharing', 'follow', 'tags', 'share-buttons')}>{self.links(2, 5)}</{t}>"

    # an article
    def many(self) -> list[str]:
        """Scores of short paragraphs or lines, as dialogues, verse, lists of names and tables have."""
        tag = self.pick("p", "p", "p", "li", "div", "td")
        said = self.words(1, 3).capitalize() + self.pick(".", "", "!")
        one = self.pick(lambda: said, lambda: self.words(1, 4).capitalize() + self.pick(".", "", ","), lambda: self.sentences(1, 1))
        each = [f"<{tag}>{one()}</{tag}>" for _ in range(self.r.randint(40, 220))]
        if tag == "li":
            return ["<ul>" + "".join(each) + "</ul>"]
        if tag == "td":
            return ["<table>" + "".join(f"<tr>{x}</tr>" for x in each) + "</table>"]
        return each

    def content(self) -> str:
        out = []
        if self.r.random() < 0.85:
            title = f"<h1>{self.words(2, 12)}</h1>"
            out.append(f"<header>{title}</header>" if self.r.random() < 0.12 else title)
        if self.r.random() < 0.1:
            out += self.many()
        for _ in range(self.r.choice([1, 2, 3, 5, 8, 12, 20])):
            k = self.r.random()
            if k < 0.72:
                out.append(f"<p{self.maybe('lead', 'text', 'paragraph') if self.r.random() < 0.1 else ''}>{self.sentences(1, self.r.choice([1, 1, 3, 6, 12]))}" + self.pick("</p>", "</p>", "<br>", ""))
            elif k < 0.80:
                out.append(f"<{(t := self.pick('h2', 'h3', 'h4'))}>{self.words(1, 8)}</{t}>")
            elif k < 0.87:
                t = self.pick("ul", "ol")
                out.append(f"<{t}>" + "".join(f"<li>{self.sentences(1, 2) if self.r.random() < 0.7 else self.words(1, 5)}</li>" for _ in range(self.r.randint(2, 6))) + f"</{t}>")
            elif k < 0.91:
                out.append(f"<blockquote>{self.pick('<p>' + self.sentences(1, 3) + '</p>', self.sentences(1, 3))}</blockquote>")
            elif k < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(self.r.randint(2, 4))) + "</table>")
            elif k < 0.97:
                out.append(f"<pre>{self.words(2, 20)}</pre>")
            else:
                out.append(f"<figure><img src='x.png'><figcaption>{self.words(2, 10)}</figcaption></figure>")
        return "\n".join(out)

    def page(self) -> str:
        around = [self.menu, self.header, self.footer, self.sidebar, self.advert, self.notice, self.form, self.comments, self.share]
        some = lambda ks, p: "".join(k() for k in ks if self.r.random() < p)
        body = self.content()
        if self.r.random() < 0.35:  # things inside the article that aren't its text
            inner = self.r.choice([self.advert, self.comments, self.share, self.form, self.notice, self.sidebar, self.footer])()
            cut = body.find("\n<", len(body) // 2) if self.r.random() < 0.5 else -1
            inner = f'<div data-content="0">{inner}</div>' if self.r.random() < 0.01 else inner.replace(">", ' data-content="0">', 1)
            body = body + inner if cut < 0 else body[:cut] + inner + body[cut:]
        label = ' data-content="1"'
        holder = self.pick("article", "article", "article", "main", "div", "div", "section", "td", "bare")
        attribute = self.attribute("article", "content", "main", "post", "entry", "story", "article-body", "post-content", "entry-content", "body", "text", "main-content")
        if holder == "bare":
            body = f"<div{label}>{body}</div>"
        elif holder == "td":
            body = f"<table><tr><td>{self.links()}</td><td{label}>{body}</td></tr></table>"
        else:
            body = f"<{holder}{attribute if holder in ('div', 'section') and self.r.random() < 0.8 or self.r.random() < 0.3 else ''}{label}>{body}</{holder}>"
        beside = [self.advert, self.sidebar, self.comments, self.share, self.form, self.menu]
        if self.r.random() < 0.4:
            body = f"<{(t := self.pick('div', 'main', 'section'))}{self.maybe('wrapper', 'container', 'page', 'main', 'row', 'content')}>{some(beside, 0.15)}{body}{some(beside, 0.25)}</{t}>"
        first = [self.header, self.menu, self.notice, self.advert, self.form]
        last = [self.comments, self.sidebar, self.advert, self.share, self.notice, self.form, self.footer]
        assert around
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title></head><body>{some(first, 0.4)}{body}{some(last, 0.35)}</body></html>"


def pages(n: int, seed: int = 20240) -> list[str]:
    """n labelled pages, the same for the same seed."""
    w = _Writer(seed)
    return [w.page() for _ in range(n)]
