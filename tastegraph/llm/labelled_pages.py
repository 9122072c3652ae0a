"""Labelled pages: drawn from a seed in many layouts, each with the texts of its article's blocks."""

from __future__ import annotations

import random
from html import escape

#: Names that site builders give to the parts of a page, by part.
ARTICLE_NAMES = ["post", "entry content", "article body", "content", "story", "post content", "blog post", "main content",
                 "page content", "text", "article", "entry", "body content", "articleBody", "story body", "prose", "news article"]
PART_NAMES = {
    "menu": ["menu", "nav", "navbar", "navigation", "main menu", "topnav", "breadcrumb", "breadcrumbs", "tabs", "toc", "pagination",
             "pager", "skip links"],
    "header": ["header", "masthead", "site header", "top", "topbar", "branding", "logo", "page header", "hero header"],
    "footer": ["footer", "site footer", "bottom", "copyright", "colophon", "legal", "page footer", "footer info"],
    "sidebar": ["sidebar", "side", "widget", "widget area", "aside", "rail", "related", "related posts", "recommended", "popular",
                "trending", "tags", "archive", "author box", "teaser", "more stories", "read more", "complementary", "secondary"],
    "notice": ["notice", "cookie", "cookie banner", "consent", "gdpr", "alert", "warning", "message", "popup", "modal", "overlay",
               "dialog", "announcement", "disclaimer", "paywall", "notification", "toast", "info bar", "privacy notice"],
    "advert": ["ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion", "adsbox", "ad slot",
               "commercial", "partner", "offer", "deal", "marketing", "adv"],
    "form": ["form", "search", "newsletter", "subscribe", "signup", "login", "contact form", "search box", "poll", "feedback"],
    "comments": ["comments", "comment list", "comment", "disqus", "discussion", "responses", "replies", "respond", "reviews",
                 "user comments", "reader comments", "reply", "thread", "feedback comments"],
    "share": ["share", "social", "sharing", "follow us", "share buttons", "social links"],
}
TAGS = {"menu": ["nav", "div", "ul", "div"], "header": ["header", "div", "header"], "footer": ["footer", "div", "footer"],
        "sidebar": ["aside", "div", "section", "aside"], "notice": ["div", "section", "aside", "p", "div"],
        "advert": ["div", "aside", "section", "div", "p", "ins"], "form": ["form", "form", "div"],
        "comments": ["section", "div", "ol", "ul", "aside"], "share": ["div", "ul"]}
SYLLABLES = "an er on the in re th ed ou ti la de le en es que ci os ar mi ein sch ung ver be ä ü é è ñ ó ción ment eau".split()


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.content = rng, []

    def words(self, n: int) -> str:
        r = self.rng
        out = []
        for i in range(n):
            w = "".join(r.choice(SYLLABLES) for _ in range(r.choice((1, 1, 2, 2, 3))))
            out.append(w + r.choice(("", "", "", "", "", ",", ".") if i < n - 1 else ("",)))
        text = " ".join(out)
        return text[:1].upper() + text[1:]

    def sentence(self, low: int, high: int) -> str:
        return self.words(self.rng.randint(low, high)) + self.rng.choice((".", ".", ".", ".", "", "!", "?"))

    def attrs(self, names: list[str], bare: float) -> str:
        r = self.rng
        if r.random() < bare:
            return ""
        name = r.choice(names).split()
        value = r.choice(("-", "_", " ", "")).join(name) if r.random() < 0.7 else "-".join([r.choice(("site", "main", "page", "js", "c")), *name])
        return f' {r.choice(("class", "class", "class", "id"))}="{value}"'

    def inline(self, text: str, keep: bool) -> str:
        """Markup inside a line; the text of a block of the article is noted."""
        if keep:
            self.content.append(" ".join(text.split()))
        r, parts = self.rng, escape(text, quote=False).split(" ")
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            i = r.randrange(len(parts))
            parts[i] = r.choice(("<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<span>{}</span>", "<code>{}</code>")).format(parts[i])
        return " ".join(parts)

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{i}">{self.words(self.rng.randint(1, 5))}</a></li>' for i in range(n))

    def paragraphs(self, keep: bool, n: int, low: int, high: int, tag: str = "p") -> str:
        out = []
        for _ in range(n):
            end = "" if tag == "p" and self.rng.random() < 0.15 else f"</{tag}>"
            out.append(f"<{tag}>{self.inline(self.sentence(low, high), keep)}{end}")
        return "".join(out)

    def part(self, kind: str, inside: bool = False) -> str:
        """A part of the page that is not the article."""
        r = self.rng
        tag = r.choice(TAGS[kind])
        told = tag not in ("div", "section", "p", "ul", "ol", "ins")
        attrs = self.attrs(PART_NAMES[kind], 0.6 if told and not inside else 0.1 if kind in ("menu", "footer") else 0.0)
        if kind in ("menu", "share"):
            items = self.links(r.randint(2, 8))
            body = items if tag == "ul" else f"<ul>{items}</ul>" if r.random() < 0.7 else " | ".join(
                f'<a href="/{i}">{self.words(2)}</a>' for i in range(r.randint(2, 6)))
        elif kind == "header":
            body = f'<a href="/">{self.words(2)}</a>' + r.choice(("", f"<p>{self.sentence(2, 9)}</p>", self.part("menu"), f"<h2>{self.words(3)}</h2>"))
        elif kind == "footer":
            body = r.choice((f"&copy; {self.words(1)} &middot; {self.sentence(4, 25)}", f"<p>&copy; 2020 {self.words(3)}</p><ul>{self.links(4)}</ul>",
                             self.paragraphs(False, r.randint(1, 3), 3, 40), f"<p>{self.sentence(3, 14)}</p>"))
        elif kind == "sidebar":
            body = r.choice((f"<h3>{self.words(2)}</h3><ul>{self.links(r.randint(2, 7))}</ul>", f"<h4>{self.words(3)}</h4>" + self.paragraphs(False, r.randint(1, 4), 4, 60),
                             self.paragraphs(False, r.randint(1, 3), 5, 50)))
        elif kind == "notice":
            body = r.choice((self.sentence(5, 40), self.paragraphs(False, r.randint(1, 2), 5, 40)) if tag == "p" else (
                self.paragraphs(False, r.randint(1, 2), 5, 40) + f"<button>{self.words(2)}</button>", self.sentence(5, 40), f"<h4>{self.words(3)}</h4><p>{self.sentence(5, 40)}</p>"))
        elif kind == "advert":
            body = r.choice((self.sentence(3, 25), self.sentence(10, 60)) if tag == "p" else (
                self.sentence(3, 25), self.sentence(15, 60), f'<a href="/ad">{self.sentence(3, 12)}</a>', self.paragraphs(False, r.randint(1, 2), 4, 40)))
        elif kind == "form":
            body = f'<label>{self.words(2)}</label><input name="q"><button>{self.words(1)}</button>' + r.choice(("", f"<p>{self.sentence(5, 30)}</p>", f"<h3>{self.words(3)}</h3>"))
        else:
            inner = r.choice(("li", "div", "article", "div")) if tag not in ("ol", "ul") else "li"
            own = self.attrs(["comment", "comment body", "reply", "review", "response"], 0.25)
            body = r.choice(("", f"<h3>{self.words(2)}</h3>", f"<h2>{self.words(1)}</h2>")) if inner != "li" else ""
            for _ in range(r.randint(1, 7)):
                body += f"<{inner}{own}>" + r.choice(("", f"<b>{self.words(2)}</b>", f'<div class="author">{self.words(2)}</div>', f"<cite>{self.words(1)}</cite>")) + r.choice(
                    (self.paragraphs(False, r.randint(1, 3), 4, 70), self.sentence(4, 60))) + f"</{inner}>"
            if r.random() < 0.3:
                body += self.part("form")
        return f"<{tag}{attrs}>{body}</{tag}>"

    def article(self) -> str:
        r = self.rng
        tag, attrs = r.choice((("article", ""), ("article", ""), ("article", self.attrs(ARTICLE_NAMES, 0)), ("div", self.attrs(ARTICLE_NAMES, 0)), ("div", self.attrs(ARTICLE_NAMES, 0)),
                               ("main", ""), ("section", self.attrs(ARTICLE_NAMES, 0)), ("div", ""), ("td", "")))
        head = f"<{r.choice(('h1', 'h1', 'h2'))}>{{}}</h1>"
        body = ""
        if r.random() < 0.85:
            level = "h1" if r.random() < 0.85 else "h2"
            head = f"<{level}>{self.inline(self.words(r.randint(1, 12)), True)}</{level}>"
            body += f"<header>{head}</header>" if tag == "article" and r.random() < 0.2 else head
        short = r.random() < 0.25
        for _ in range(r.choice((0, 1, 1, 2, 3, 4, 6, 9))):
            kind = r.random()
            if kind < 0.66:
                body += self.paragraphs(True, r.randint(1, 4), 1 if short else 4, 15 if short else 110)
            elif kind < 0.72:
                level = r.choice(("h2", "h3"))
                body += f"<{level}>{self.inline(self.words(r.randint(1, 8)), True)}</{level}>"
            elif kind < 0.79:
                lst = r.choice(("ul", "ol"))
                body += f"<{lst}>" + "".join(f"<li>{self.inline(self.sentence(2, 30), True)}</li>" for _ in range(r.randint(1, 6))) + f"</{lst}>"
            elif kind < 0.84:
                body += f"<blockquote>{self.paragraphs(True, 1, 5, 50)}</blockquote>"
            elif kind < 0.87:
                body += f"<pre>{self.inline(self.words(r.randint(2, 30)), True)}</pre>"
            elif kind < 0.90:
                body += "<table>" + "".join("<tr>" + "".join(f"<td>{self.inline(self.words(r.randint(1, 5)), True)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>"
            elif kind < 0.93:
                body += f'<figure><img src="x"><figcaption>{self.inline(self.sentence(3, 15), True)}</figcaption></figure>'
            else:
                body += f"<div>{self.paragraphs(True, r.randint(1, 2), 5, 60)}</div>"
            if r.random() < 0.14:
                body += self.part(r.choice(("advert", "share", "sidebar", "form", "notice")), True)
        if r.random() < 0.12:
            body += self.part(r.choice(("comments", "share", "sidebar")), True)
        html = f"<{tag}{attrs}>{body}</{tag}>"
        return f"<table><tr>{html}</tr></table>" if tag == "td" else html

    def page(self) -> str:
        r = self.rng
        before = [self.part(k) for k in ("notice", "header", "menu", "advert", "form", "menu", "sidebar") if r.random() < 0.35]
        middle = self.article()
        after = [self.part(k) for k in ("share", "sidebar", "comments", "advert", "form", "notice", "sidebar") if r.random() < 0.33]
        if r.random() < 0.8:
            after.append(self.part("footer"))
        if r.random() < 0.4:
            side = self.part("sidebar") if r.random() < 0.6 else ""
            middle = f'<div{self.attrs(["wrapper", "container", "page", "row", "layout", "wrap"], 0.3)}>{side}{middle}{"".join(after[:2])}</div>'
            after = after[2:]
        if r.random() < 0.2:
            middle = f"<main>{middle}</main>" if "<main" not in middle else middle
        return "<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>" + "".join(before) + middle + "".join(after) + "</body></html>"


def labelled_pages(n: int, seed: int = 5) -> list[tuple[str, list[str]]]:
    """(html, texts of the article's blocks) of n pages."""
    out = []
    for i in range(n):
        page = _Page(random.Random(seed * 1_000_003 + i))
        out.append((page.page(), page.content))
    return out
