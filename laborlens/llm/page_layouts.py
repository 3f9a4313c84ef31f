"""Generated web pages whose main text is known: every word of it carries a mark."""

from __future__ import annotations

import random
from collections.abc import Iterator

MARK = "\u2063"

#: Syllables, and names that page makers give to parts of a page.
SYLLABLES = "an er the in re on st en ti ha ou ea es lo ver ch ie le que ment tion do la os é ü ñ ß ar ci mo ka ri".split()
NAMES = {
    "nav": ["nav", "menu", "main-menu", "navbar", "site-navigation", "breadcrumbs", "topnav links"],
    "header": ["header", "site-header", "masthead", "topbar", "page-header logo"],
    "ad": ["ad", "ads", "advert", "ad-slot", "sponsored", "promo banner", "advertisement"],
    "notice": ["cookie-banner", "consent", "notice", "newsletter", "alert", "gdpr-popup", "subscribe-box"],
    "side": ["sidebar", "widget", "related", "related-posts", "share", "social", "popular", "recommended"],
    "comment": ["comments", "comment-list", "disqus", "replies", "discussion"],
    "footer": ["footer", "site-footer", "copyright", "bottom legal", "colophon"],
    "form": ["search-form", "login", "contact-form", "signup"],
    "main": ["content", "post", "entry-content", "article-body", "main", "story", "post-content text"],
    "neutral": ["row", "col-8", "wrap", "container", "inner", "x1", "box", "block"],
}
LABELS = ["Home", "About", "Login", "News", "Contact", "Sport", "Next", "Previous", "Read more", "Share", "Privacy", "Terms", "Help", "OK", "Accept"]


class Layout:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def sentence(self, mark: bool, low: int = 3, high: int = 22) -> str:
        noisy = self.r.random() < 0.05
        words = [self.word() + ("," if self.r.random() < 0.08 else "") + (self.r.choice(["###", "&amp;&amp;", "%%", "!!"]) if noisy else "")
                 for _ in range(self.r.randint(low, high))]
        text = " ".join(words)
        text = text.upper() if self.r.random() < 0.03 else text.capitalize()
        text += self.r.choice(["."] * 8 + ["!", "?", ""])
        return " ".join(MARK + w for w in text.split()) if mark else text

    def text(self, mark: bool, low: int, high: int) -> str:
        sentences = [self.sentence(mark) for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.15:
            i = self.r.randrange(len(sentences))
            sentences[i] = f'<a href="/x">{sentences[i]}</a>'
        return " ".join(sentences)

    def named(self, tag: str, kind: str, inner: str) -> str:
        """An element with a name of its kind, a neutral one or none."""
        chance = self.r.random()
        name = self.r.choice(NAMES[kind]) if chance < 0.7 else self.r.choice(NAMES["neutral"]) if chance < 0.8 else ""
        attribute = f' {self.r.choice(["class", "class", "id"])}="{name}"' if name else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def part(self, kind: str, tag: str, inner: str) -> str:
        """An element that is told by its tag or by its name, one at least."""
        if self.r.random() < 0.55:
            return self.named(tag, kind, inner)
        return f'<{self.r.choice(["div", "div", "section"])} {self.r.choice(["class", "id"])}="{self.r.choice(NAMES[kind])}">{inner}</div>'

    def links(self, low: int = 2, high: int = 9) -> str:
        items = [f'<a href="/{i}">{self.r.choice(LABELS) if self.r.random() < 0.5 else self.word()}</a>' for i in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            close = self.r.choice(["</li>", ""])
            return "<ul>" + "".join(f"<li>{a}{close}" for a in items) + "</ul>"
        return self.r.choice([" | ", " ", "<br>"]).join(items)

    def menu(self) -> str:
        return self.part("nav", "nav", self.links(3, 12))

    def header(self) -> str:
        return self.part("header", "header", f"<a href='/'>{self.word()}</a>" + (f"<p>{self.sentence(False, 2, 8)}</p>" if self.r.random() < 0.5 else "")
                         + (self.menu() if self.r.random() < 0.5 else ""))

    def paragraph(self, inner: str) -> str:
        return f"<p>{inner}</p>" if self.r.random() < 0.7 else f"<{self.r.choice(['div', 'span', 'p'])}>{inner}" if self.r.random() < 0.3 else inner

    def advert(self) -> str:
        inner = self.paragraph(self.text(False, 1, 3))
        return f'<div class="{self.r.choice(NAMES["ad"])}">{inner}</div>' if self.r.random() < 0.85 else f'<aside id="{self.r.choice(NAMES["ad"])}">{inner}</aside>'

    def notice(self) -> str:
        inner = self.paragraph(self.text(False, 1, 4)) + (f"<button>{self.r.choice(LABELS)}</button>" if self.r.random() < 0.5 else "")
        extra = ' role="alert"' if self.r.random() < 0.2 else ""
        return f'<div class="{self.r.choice(NAMES["notice"])}"{extra}>{inner}</div>'

    def side(self) -> str:
        inner = f"<h3>{self.sentence(False, 1, 4)}</h3>" + self.links(2, 8)
        inner += "".join(self.paragraph(self.text(False, 1, 3)) for _ in range(self.r.randint(0, 2)))
        return self.part("side", "aside", inner)

    def comments(self) -> str:
        one = lambda: f'<{self.r.choice(["div", "li"])} class="{self.r.choice(["comment", "comment-body", "reply", "user-comment"])}"><b>{self.word()}</b> <p>{self.text(False, 1, 6)}</p></div>'
        inner = (f"<h2>{self.r.choice(['Comments', 'Replies', self.word()])}</h2>" if self.r.random() < 0.6 else "") + "".join(one() for _ in range(self.r.randint(1, 6)))
        return f'<{self.r.choice(["section", "div", "ul"])} {self.r.choice(["class", "id"])}="{self.r.choice(NAMES["comment"])}">{inner}</div>'

    def form(self) -> str:
        inner = f"<label>{self.sentence(False, 1, 4)}</label><input name='q'>" + (f"<p>{self.sentence(False)}</p>" if self.r.random() < 0.5 else "") + "<button>OK</button>"
        return self.named("form", "form", inner)

    def footer(self) -> str:
        inner = self.r.choice(["&copy; ", "", "Copyright 2024 "]) + self.text(False, 1, 3) + (self.links(2, 6) if self.r.random() < 0.5 else "")
        return self.part("footer", "footer", self.paragraph(inner))

    def body_text(self) -> str:
        """Blocks of the article."""
        tiny = self.r.random() < 0.25
        low, high = (1, 1) if tiny else self.r.choice([(1, 1), (1, 3), (2, 6), (2, 12)])
        parts = []
        style = self.r.random()
        for _ in range(self.r.choice([1, 1, 2]) if tiny else self.r.choice([1, 1, 2, 3, 5, 8, 14])):
            inner = self.sentence(True, 1, 7) if tiny or self.r.random() < 0.1 else self.text(True, low, high)
            if style < 0.15:
                parts.append(inner + "<br><br>")
            elif style < 0.3:
                parts.append(f"<p>{inner}")
            elif style < 0.4:
                parts.append(f"<div>{inner}</div>")
            else:
                parts.append(f"<p><b>{inner}<br>" if self.r.random() < 0.12 else f"<p>{inner}</p>")
            more = self.r.random()
            if more < 0.07:
                parts.append("<ul>" + "".join(f"<li>{self.sentence(True, 1, 12)}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>")
            elif more < 0.12:
                parts.append(f"<h2>{self.sentence(True, 1, 6)}</h2>")
            elif more < 0.15:
                parts.append(f"<blockquote>{self.text(True, 1, 3)}</blockquote>")
            elif more < 0.18:
                parts.append("<table>" + "".join(f"<tr><td>{self.sentence(True, 1, 4)}</td><td>{self.sentence(True, 1, 4)}</td></tr>" for _ in range(3)) + "</table>")
            elif more < 0.2:
                parts.append(f"<figure><img src='a.png'><figcaption>{self.sentence(True, 2, 10)}</figcaption></figure>")
            elif more < 0.21:
                parts.append(f"<pre>{self.sentence(True)}</pre>")
        for make in (self.advert, self.side, self.notice, self.form):
            if self.r.random() < 0.08:
                parts.insert(self.r.randint(0, len(parts)), make())
        return "".join(parts)

    def article(self) -> str:
        title = f"<h1>{self.sentence(True, 1, 10)}</h1>" if self.r.random() < 0.8 else ""
        if title and self.r.random() < 0.1:
            title = f"<header>{title}</header>"
        inner = title + self.body_text() + (self.comments() if self.r.random() < 0.08 else "")
        kind = self.r.random()
        if kind < 0.4:
            return f"<article>{inner}</article>" if self.r.random() < 0.7 else self.named("article", "main", inner)
        if kind < 0.55:
            return self.named("main", "main", inner)
        if kind < 0.85:
            return f'<div {self.r.choice(["class", "id"])}="{self.r.choice(NAMES["main"])}">{inner}</div>'
        return self.named(self.r.choice(["div", "section"]), "neutral", inner)

    def page(self) -> str:
        if self.r.random() < 0.03:
            return self.text(True, 1, 5)
        some = lambda make, chance: make() if self.r.random() < chance else ""
        top = [some(self.header, 0.4), some(self.menu, 0.6), some(self.notice, 0.25), some(self.advert, 0.35), some(self.form, 0.15)]
        self.r.shuffle(top)
        middle = [some(self.side, 0.2), self.article(), some(self.side, 0.3), some(self.comments, 0.25), some(self.advert, 0.15)]
        if self.r.random() < 0.3:
            middle = [self.named("div", "neutral", "".join(middle))]
        bottom = [some(self.form, 0.1), some(self.notice, 0.15), some(self.footer, 0.7), some(self.menu, 0.1)]
        head = f"<head><meta charset='utf-8'><title>{self.sentence(False)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        return f"<!DOCTYPE html><html>{head}<body>" + "".join(top + middle + bottom) + self.r.choice(["</body></html>", ""])


def layouts(pages: int, seed: int = 1) -> Iterator[str]:
    for i in range(pages):
        yield Layout(seed * 1_000_003 + i).page()
