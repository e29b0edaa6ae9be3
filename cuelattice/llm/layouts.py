"""Labelled page layouts for training the page-text model.

A page is drawn from a small grammar with a seed of its own: parts before, a main part
with asides, adverts and reader comments inside it or not, parts after. A slot `{M}` is
a block of main text, `{B}` one of boilerplate; `{m}`/`{b}` are short ones (headings,
links, labels). Containers are named by tags, by class or id words, or not at all."""

from __future__ import annotations

import random
import re

MENUS = ["nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs", "main menu", "site nav", "tabs", "toc links", "pagination"]
HEADERS = ["header", "site header", "masthead", "topbar", "logo", "branding", "top"]
ADS = ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad slot", "banner ad", "sponsor"]
NOTICES = ["cookie notice", "notice", "alert", "consent", "gdpr banner", "message", "disclaimer", "paywall", "announcement"]
SIDES = ["sidebar", "aside", "widget", "rail", "secondary", "side column", "related", "popular", "recommended", "trending", "tags", "author box"]
FORMS = ["search", "newsletter", "subscribe", "login", "signup", "contact form", "poll"]
COMMENTS = ["comments", "comment list", "disqus thread", "respond", "discussion", "replies", "reader comments", "comment section", "feedback"]
SHARES = ["share", "social", "share buttons", "follow", "toolbar", "actions"]
FEET = ["footer", "site footer", "legal", "colophon", "copyright", "bottom", "imprint", "credits"]
MAINS = ["content", "main", "main content", "post", "post body", "entry content", "article body", "story", "text", "body", "page content", "prose"]
PAGES = 900
FALLBACK = ["Some words of plain text stand here, and more of them follow in a second part.", "A short line", "One more sentence, with a comma, ends here.", "Home"]


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.bare = self.r.random() < 0.25  # containers without a name

    def some(self, make, least: int, most: int) -> str:
        return "".join(make() for _ in range(self.r.randint(least, most)))

    def box(self, inner: str, words: list[str], tags: tuple[str, ...] = ("div",)) -> str:
        tag = "div" if self.bare and self.r.random() < 0.8 else self.r.choice(tags)
        name = self.r.choice(words).split()
        name = self.r.choice(["-", "_", " "]).join(name)
        named = "" if self.bare or (tag != "div" and self.r.random() < 0.5) else f" {self.r.choice(['class', 'class', 'id'])}='{name}'"
        return f"<{tag}{named}>{inner}</{tag}>"

    def links(self) -> str:
        link = lambda: "<a href='#'>{b}</a>"
        return self.r.choice([
            lambda: "<ul>" + self.some(lambda: f"<li>{link()}</li>", 2, 6) + "</ul>", lambda: self.some(lambda: link() + " | ", 2, 5),
            lambda: self.some(lambda: f"<div>{link()}</div>", 2, 4), lambda: f"<p>{link()}</p>",
        ])()

    def said(self) -> str:
        """Sentences that are no main text."""
        return self.r.choice(["<p>{B}</p>", "{B}", "<p>{b}</p><p>{B}</p>", "<h3>{b}</h3><p>{B}</p>", "<div>{B}</div>", "<span>{B}</span>"])

    def comments(self) -> str:
        one = lambda: self.r.choice(["<div class='comment'><p>{B}</p></div>", "<li class='comment'><p>{b}</p><p>{B}</p></li>", "<div class='reply'>{B}</div>", "<article class='comment'><p>{B}</p></article>", "<p>{B}</p>", "<div class='comment-body'>{B}</div>"])
        was, self.bare = self.bare, False
        out = self.box(self.r.choice(["<h3>{b}</h3>", "<h2>{b}</h2>", ""]) + self.some(one, 1, 4), COMMENTS, ("div", "section", "ol"))
        self.bare = was
        return out

    def inset(self) -> str:
        """What stands in the middle of an article and is no part of its text."""
        was, self.bare = self.bare, False
        out = self.r.choice([
            lambda: self.box(self.said(), ADS), lambda: self.box(self.said() + self.links(), SIDES, ("aside", "div")), lambda: self.box(self.links(), SHARES),
            lambda: self.box(self.said() + "<form><p>{b}</p><label>{b}</label></form>", FORMS), lambda: self.box(self.said(), NOTICES),
        ])()
        self.bare = was
        return out

    def block(self) -> str:
        p = "<p>{M}</p>"
        return self.r.choices(
            [p, "<p>{m}</p>", "<h2>{m}</h2>", "<ul><li>{m}</li><li>{M}</li></ul>", "<ol><li>{M}</li><li>{m}</li></ol>", "<blockquote><p>{M}</p></blockquote>", "<blockquote>{M}</blockquote>", "<pre>{M}</pre>", "<figure><figcaption>{m}</figcaption></figure>",
             "<table><tr><th>{m}</th><th>{m}</th></tr><tr><td>{m}</td><td>{M}</td></tr></table>", "<dl><dt>{m}</dt><dd>{M}</dd></dl>", "<div>{M}</div>", "<p><b>{M}<br><p>{M}</p>", "<h3>{m}</h3>" + p, "<p>{M} <a href='#'>x</a></p>"],
            [30, 5, 4, 3, 3, 2, 1, 2, 2, 3, 2, 4, 4, 3, 3])[0]

    def main(self) -> str:
        inner = self.r.choice(["<h1>{m}</h1>", "<h1>{m}</h1>", "<header><h1>{m}</h1></header>", "<h2>{m}</h2>", ""])
        n = self.r.randint(1, 9)
        for k in range(n):
            inner += self.block() if not self.bare or self.r.random() < 0.4 else self.r.choice(["<p>{M}</p>", "<div>{M}</div>", "<div>{M}</div>"])
            if k < n - 1 and self.r.random() < 0.12:
                inner += self.inset()
        if self.r.random() < 0.3:
            inner = self.box(inner, MAINS, ("div", "section"))
        if self.r.random() < 0.25:
            inner += self.r.choice([self.comments, self.inset])()
        if self.bare and self.r.random() < 0.35:
            return inner  # nothing around it
        return self.box(inner, MAINS, ("article", "article", "article", "main", "div", "section"))

    def page(self) -> str:
        before = [
            lambda: self.box(self.links(), MENUS, ("nav", "nav", "div", "ul")), lambda: self.box("<h1>{b}</h1>" + self.r.choice(["", "<p>{b}</p>"]) + self.links(), HEADERS, ("header", "div")), lambda: self.box(self.said(), ADS), lambda: self.box(self.said() + "<button>{b}</button>", NOTICES),
            lambda: self.box("<label>{b}</label>", FORMS, ("form", "div")), lambda: self.box("<h3>{b}</h3>" + self.links(), SIDES, ("aside", "div")), lambda: self.box("{b}", ADS), lambda: self.box("{B}", ADS),
        ]
        after = [
            self.comments, lambda: self.box("<h4>{b}</h4>" + self.links(), SIDES, ("aside", "div")), lambda: self.box(self.links(), SHARES), lambda: self.box(self.said(), ADS), lambda: self.box("<p>{b}</p><label>{b}</label>", FORMS, ("form", "div")),
            lambda: self.box("<h3>{b}</h3>" + self.said(), SIDES, ("aside", "div")),
        ]
        foot = self.box(self.r.choice(["&copy; {b}", "&copy; {B}", "<p>&copy; {b}</p>" + self.links(), "<p>{b}</p><p>&copy; {b}</p>", "{b}"]), FEET, ("footer", "div"))
        head = "".join(self.r.choice(before)() for _ in range(self.r.randint(0, 4)))
        tail = "".join(self.r.choice(after)() for _ in range(self.r.randint(0, 3))) + (foot if self.r.random() < 0.9 else "")
        body = head + self.main() + tail
        if self.r.random() < 0.15:
            body = f"<table><tr><td>{self.links()}</td><td>{self.main()}</td></tr></table>" + foot
        return f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head><body>{self.box(body, ['wrapper', 'page', 'container', 'site']) if self.r.random() < 0.4 else body}</body></html>"


def labelled_pages(texts: list[str], pages: int = PAGES, seed: int = 0):
    """(html, {first word of a block: 0 or 1}) of so many pages. Each slot gets a key
    word of its own, then a text; a copyright sign stands after the key word."""
    texts = [" ".join(t.replace("<", " ").replace("&", " ").split()) for t in texts]
    long_ = [t for t in texts if len(t) > 80] or FALLBACK
    short = [t for t in texts if 0 < len(t) <= 80] or FALLBACK
    n = 0
    for k in range(pages):
        made = _Page(seed * 1_000_003 + k)
        labels: dict[str, int] = {}

        def fill(m, r=made.r, bare=made.bare, labels=labels):
            nonlocal n
            n += 1
            key = f"k{n}"
            labels[key] = int(m[2] in "Mm")
            few = m[2] in "mb" or r.random() < (0.15 if m[2] == "M" else 0.85 if bare else 0.4)  # without names only looks can tell
            return f"{key} {'&copy; ' if m[1] else ''}{r.choice(short if few else long_)}"

        yield re.sub(r"(&copy; )?\{([MmBb])\}", fill, made.page()), labels
