"""Labelled pages to train the extraction on.

Pages are composed at random from a seed: a layout, an article with its blocks, and
around and between them what is no part of it (menus, headers, sidebars, notices,
adverts, forms, comments, footers), in many namings, some with tags left out.  Texts are
invented words on both sides, so the labels follow from the structure and the shape of
the texts, not from a vocabulary.
"""

from __future__ import annotations

import random
from collections.abc import Callable

_SYLLABLES = ["la mente cion rar ado que osa ir ta en", "ung heit lich ver be ch sch ein er tz", "tion eau ment re ou ai le qu es an",
              "the ing er an st ed wh ble and or", "ска по на ть ов ий не ра", "の に は 学 日 本 語 文", "ka mo ri ta su no he"]
_NAV = ["Home", "About us", "Contact", "News", "Archive", "Impressum", "Inicio", "Accueil", "Help", "Shop", "Next", "Previous"]


def text(r: random.Random, words: int | None = None) -> str:
    """Invented sentences; short ones and odd ones (bars, numbers, one word) are among them."""
    parts = r.choice(_SYLLABLES).split()
    n = words or r.choice([1, 1, 2, 4, 8, 15, 30, 60, 120])
    glue = r.choice([" "] * 9 + [" | "])
    out = [("".join(r.choices(parts, k=r.randint(1, 4))) if r.random() > 0.03 else str(r.randint(1, 9_999))) + r.choice(["", "", "", "", ",", "."])
           for _ in range(n)]
    s = glue.join(out)
    return (s[:1].upper() + s[1:]).rstrip(",.") + r.choice([".", ".", ".", "", "?", ":"]) + r.choice(["", "", "", "", " &amp; 1"])


class Page:
    """Builds one page; `mark` stands before each text of the article."""

    def __init__(self, r: random.Random, mark: str):
        self.r, self.mark = r, mark
        self.headline = text(r, r.randint(2, 12)).rstrip(".")
        self.open = r.random() < 0.25  # leaves out end tags

    def tag(self, name: str, body: str, **attributes: str) -> str:
        a = "".join(f' {k.rstrip("_")}="{v}"' for k, v in attributes.items() if v)
        end = "" if self.open and name in ("p", "li") and self.r.random() < 0.5 else f"</{name}>"
        return f"<{name}{a}>{body}{end}"

    def named(self, *names: str) -> dict[str, str]:
        """A class or id made of one of the names, or none."""
        n = self.r.choice(names) + self.r.choice(["", "", "-box", "Wrapper", "-1", " wide"])
        return {self.r.choice(["class_", "class_", "id"]): n}

    def links(self, n: int, wrap: str = "li") -> str:
        return "".join(self.tag(wrap, f'<a href="/{i}">{self.r.choice([self.r.choice(_NAV), text(self.r, self.r.randint(1, 4))])}</a>')
                       for i in range(n))

    # What is no part of the article.

    def menu(self) -> str:
        r = self.r
        items = self.tag("ul", self.links(r.randint(2, 9)))
        return r.choice([lambda: self.tag("nav", items), lambda: self.tag("div", items, **self.named("nav", "menu", "navbar", "navigation", "breadcrumbs", "topnav")),
                         lambda: self.tag("nav", self.links(r.randint(2, 6), "span"), **self.named("menu", "pagination")), lambda: items])()

    def top(self) -> str:
        name = self.tag(self.r.choice(["p", "div", "h2", "span"]), text(self.r, self.r.randint(1, 4)), class_=self.r.choice(["logo", "brand", "tagline", ""]))
        return self.r.choice([lambda: self.tag("header", name + self.r.choice(["", self.menu()])),
                              lambda: self.tag("div", name + self.menu(), **self.named("header", "masthead", "banner", "topbar", "siteHeader"))])()

    def advert(self) -> str:
        body = self.r.choice([text(self.r), self.tag("p", text(self.r)), f'<a href="/buy">{text(self.r, 6)}</a>', self.tag("span", "Advertisement") + text(self.r)])
        return self.tag(self.r.choice(["div", "div", "aside", "section", "p"]), body, **self.named("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad"))

    def notice(self) -> str:
        body = self.tag("p", text(self.r)) + self.r.choice(["", "<button>OK</button>", self.tag("p", "We use cookies. " + text(self.r))])
        return self.tag(self.r.choice(["div", "div", "section", "aside"]), body,
                        **self.named("cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "paywall", "disclaimer"))

    def form(self) -> str:
        label = self.tag(self.r.choice(["label", "p", "div", "legend"]), text(self.r, self.r.randint(1, 9)))
        return self.tag("form", label + '<input name="q"><textarea>type here</textarea>' + self.r.choice(["<button>Send</button>", "<select><option>One<option>Two</select>", ""]),
                        **self.r.choice([{}, self.named("search", "subscribe", "login", "signup", "contact")]))

    def sidebar(self) -> str:
        body = "".join(self.r.choice([lambda: self.tag("h3", text(self.r, 3)) + self.tag("ul", self.links(4)), lambda: self.tag("p", text(self.r)),
                                      lambda: self.tag("div", text(self.r), **self.named("widget", "related", "popular", "trending"))])()
                       for _ in range(self.r.randint(1, 4)))
        return self.r.choice([lambda: self.tag("aside", body), lambda: self.tag("div", body, **self.named("sidebar", "widgets", "aside", "related", "rightcol", "secondary"))])()

    def share(self) -> str:
        return self.tag(self.r.choice(["div", "ul", "p"]), self.links(3, "span"), **self.named("share", "social", "tags", "related", "more", "author", "meta", "byline"))

    def comments(self) -> str:
        r = self.r
        item = lambda: self.tag(r.choice(["div", "li", "article"]), r.choice(["", self.tag("span", text(r, 2), class_="author")]) +  # noqa: E731
                                r.choice([self.tag("p", text(r)), text(r), self.tag("blockquote", text(r)) + self.tag("p", text(r))]),
                                **self.named("comment", "reply", "comment-body", "comments", "response", "review"))
        head = r.choice(["", self.tag("h3", r.choice(["Comments", "3 comments", "Leave a reply", text(r, 2)]))])
        body = head + "".join(item() for _ in range(r.randint(1, 5))) + r.choice(["", self.form()])
        return self.tag(r.choice(["section", "div", "ol", "aside"]), body, **self.named("comments", "comment-list", "commentlist", "responses", "discussion", "replies", "disqus", "reader-comments"))

    def foot(self) -> str:
        body = r"&copy; " + text(self.r, 5) + self.r.choice(["", " &middot; " + text(self.r)])
        body = self.r.choice([body, self.tag("p", body), self.tag("p", text(self.r)) + self.tag("ul", self.links(4)) + self.tag("p", body)])
        return self.r.choice([lambda: self.tag("footer", body), lambda: self.tag("div", body, **self.named("footer", "foot", "copyright", "bottom", "colophon"))])()

    # The article.

    def own(self, words: int | None = None) -> str:
        return self.mark + text(self.r, words)

    def paragraph(self) -> str:
        r, t = self.r, self.own()
        return r.choice([lambda: self.tag("p", t), lambda: self.tag("p", t), lambda: self.tag("p", t), lambda: f"<p><b>{t}<br>", lambda: f"<p>{t}",
                         lambda: self.tag("p", f"<b>{t}</b>"), lambda: self.tag("p", f'{t} <a href="/x">{text(r, 2)}</a> {text(r, 5)}'),
                         lambda: self.tag("div", t)])()

    def piece(self) -> str:
        r = self.r
        kind = r.random()
        if kind < 0.7:
            return self.paragraph()
        return r.choice([lambda: self.tag("h2", self.own(4)), lambda: self.tag("h3", self.own(3)),
                         lambda: self.tag(r.choice(["ul", "ol"]), "".join(self.tag("li", self.own(r.randint(1, 20))) for _ in range(r.randint(1, 6)))),
                         lambda: self.tag("blockquote", r.choice([self.own(), self.tag("p", self.own())])), lambda: self.tag("pre", self.own(9)),
                         lambda: self.tag("figure", '<img src="a.png">' + self.tag("figcaption", self.own(6))),
                         lambda: self.tag("table", "".join(self.tag("tr", self.tag("td", self.own(2)) + self.tag("td", self.own(1))) for _ in range(3))),
                         lambda: self.tag("section", self.tag("h2", self.own(3)) + self.paragraph() + self.paragraph()),
                         lambda: self.tag("dl", self.tag("dt", self.own(1)) + self.tag("dd", self.own(8)))])()

    def article(self) -> str:
        r = self.r
        head = self.tag("h1", self.mark + self.headline)
        head = r.choice([head, head, head, self.tag("header", head), "", self.tag("div", head, **self.named("title", "headline", "entry"))])
        body = [self.piece() for _ in range(r.choice([0, 1, 3, 6, 10, 20]))]
        for extra in (self.advert, self.share, self.form, self.notice, self.sidebar, self.menu):
            if r.random() < 0.2:
                body.insert(r.randint(0, len(body)), extra())
        if not body and not head:
            body = [self.paragraph()]
        if r.random() < 0.2:
            body.append(self.comments())
        inner = head + "".join(body)
        kind = r.random()
        if kind < 0.55:
            return self.tag("article", inner, **r.choice([{}, self.named("post", "entry", "story")]))
        if kind < 0.7:
            return self.tag("main", inner)
        if kind < 0.95:
            return self.tag(r.choice(["div", "div", "section", "td"]), inner, **self.named("content", "post", "article", "entry", "story", "main", "text", "body", "article-body", "postContent"))
        return inner

    def html(self) -> str:
        r = self.r
        some: Callable[..., list] = lambda *made: [m() for m in made if r.random() < 0.45]
        before = some(self.top, self.notice, self.menu, self.advert, self.form, self.sidebar, self.menu)
        after = some(self.comments, self.sidebar, self.share, self.advert, self.form, self.comments, self.notice, self.menu, self.foot)
        if r.random() < 0.5:
            r.shuffle(before)
        # Some pages are an article and little else.
        before, after = before if r.random() < 0.75 else [], after if r.random() < 0.75 else []
        main = self.article()
        if r.random() < 0.3:
            main = self.tag(r.choice(["div", "main", "section"]), main, **r.choice([{}, self.named("wrapper", "container", "page", "site")]))
        body = "".join([*before, "<!-- start -->", main, *after])
        script = '<script>var t="</p><p>";track(1);</script>'
        return (f"<!DOCTYPE html><html><head><title>{self.headline}</title><style>p{{margin:0}}</style>{script}</head><body>"
                f"{body}" + r.choice(["</body></html>", "", script]))


def labelled_pages(n: int, seed: int = 11, mark: str = "\ue000") -> list[str]:
    """`n` pages, whose article texts begin with `mark`."""
    return [Page(random.Random(f"{seed}-{i}"), mark).html() for i in range(n)]
