"""Labelled pages to learn from: common layouts, drawn by a fixed seed.

Regions carry data-label (1 for the article, 0 for the rest); blocks take the
label of the nearest region around them. Words are invented.
"""

from __future__ import annotations

import random

_PARTS = "an ber co de el fi gra ho in ja ker lo mi nu or pa qui re si ta ur ve wo zen".split()


class _Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def word(self) -> str:
        return "".join(self.random.choices(_PARTS, k=self.random.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.random.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(4, 18).capitalize() + self.random.choice("...!?") for _ in range(self.random.randint(low, high)))

    def marks(self, *names: str) -> str:
        """Class or id of one of the names, or none."""
        name = self.random.choice([*names, None])
        if name is None:
            return ""
        return f' {self.random.choice(["class", "id"])}="{name}"'

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>' for _ in range(self.random.randint(low, high)))

    def paragraph(self) -> str:
        text = self.sentences(1, 7)
        kind = self.random.random()
        if kind < 0.1:
            return f"<p><b>{text}<br>"
        if kind < 0.2:
            return f'<p>{text} <a href="#">{self.words(1, 4)}</a> {self.sentences(1, 2)}</p>'
        if kind < 0.25:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.3:
            return "<ul>" + "".join(f"<li>{self.words(2, 14)}</li>" for _ in range(self.random.randint(2, 5))) + "</ul>"
        if kind < 0.34:
            return f"<pre>{text}</pre>"
        if kind < 0.38:
            rows = "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 6)}</td></tr>" for _ in range(self.random.randint(2, 5)))
            return f"<table>{rows}</table>"
        if kind < 0.46:
            return f"<h2>{self.words(2, 6)}</h2><p>{text}</p>"
        if kind < 0.52:
            return f"<p>{self.words(1, 4).capitalize()}.</p>"
        return f"<p>{text}</p>"

    def junk(self, kind: str) -> str:
        r = self.random
        if kind == "menu":
            tag = r.choice(["nav", "nav", "div"])
            mark = self.marks("nav", "menu", "navbar", "breadcrumb") if tag == "nav" else f' class="{r.choice(["menu", "nav", "breadcrumbs"])}"'
            return f'<{tag} data-label="0"{mark}><ul>{self.links(3, 10)}</ul></{tag}>'
        if kind == "header":
            inner = r.choice([f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(2, 6)}</p>", f"<div>{self.words(1, 5)}</div>"])
            tag, mark = r.choice([("header", ""), ("header", self.marks("header", "masthead")), ("div", ' class="header"'), ("div", ' id="masthead"')])
            return f'<{tag} data-label="0"{mark}>{inner}{r.choice(["", f"<p>{self.sentences(1, 1)}</p>"])}</{tag}>'
        if kind == "footer":
            tag, mark = r.choice([("footer", ""), ("footer", ""), ("div", ' class="footer"'), ("div", ' id="footer"')])
            return f'<{tag} data-label="0"{mark}>{r.choice(["&copy; ", ""])}{self.words(1, 4)} &middot; {self.sentences(1, 4)}{r.choice(["", f"<ul>{self.links(1, 5)}</ul>"])}</{tag}>'
        if kind == "sidebar":
            tag, mark = r.choice([("aside", ""), ("aside", self.marks("sidebar", "widget")), ("div", ' class="sidebar"'), ("div", ' class="related"')])
            inner = r.choice([f"<h3>{self.words(1, 3)}</h3><ul>{self.links(2, 8)}</ul>", f"<h2>{self.words(1, 4)}</h2><p>{self.sentences(1, 4)}</p>"])
            return f'<{tag} data-label="0"{mark}>{inner}</{tag}>'
        if kind == "notice":
            mark = r.choice(["notice", "cookie-notice", "cookie", "consent", "alert", "newsletter", "popup"])
            inner = r.choice([self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>", f"<p>{self.sentences(1, 2)}</p><button>{self.word()}</button>"])
            tag = r.choice(["div", "div", "section", "p"]) if "<p>" not in inner else "div"
            return f'<{tag} data-label="0" {r.choice(["class", "id"])}="{mark}">{inner}</{tag}>'
        if kind == "advert":
            mark = r.choice(["ad", "ads", "advert", "ad-banner", "sponsored", "promo", "advertisement"])
            inner = r.choice([self.sentences(1, 4), f"<p>{self.sentences(1, 4)}</p>", f'<a href="#">{self.words(2, 8)}</a>'])
            tag = r.choice(["div", "div", "section", "aside"])
            return f'<{tag} data-label="0" class="{mark}">{inner}</{tag}>'
        if kind == "form":
            field = f'<label>{self.words(1, 3)}<input name="q"></label>'
            return f'<form data-label="0"{self.marks("search", "login", "signup")}>{r.choice(["", f"<p>{self.sentences(1, 2)}</p>"])}{field}<button>{self.word()}</button></form>'
        if kind == "comments":
            tag = r.choice(["section", "div", "ol"])
            mark = r.choice(["comments", "comment-list", "responses", "discussion"])
            item = "li" if tag == "ol" else r.choice(["div", "article"])
            inner = "".join(
                f'<{item}{r.choice(["", " class=" + chr(34) + "comment" + chr(34)])}><b>{self.word()}</b>{r.choice([f"<p>{self.sentences(1, 4)}</p>", self.sentences(1, 4)])}</{item}>'
                for _ in range(r.randint(1, 6))
            )
            return f'<{tag} data-label="0" {r.choice(["class", "id"])}="{mark}">{r.choice(["", f"<h3>{self.words(1, 2)}</h3>"]) if tag != "ol" else ""}{inner}</{tag}>'
        return f'<div data-label="0" class="share"><ul>{self.links(2, 5)}</ul></div>'

    def article(self) -> str:
        r = self.random
        tag, mark = r.choice(
            [("article", ""), ("article", ""), ("article", self.marks("post", "entry")), ("main", ""), ("div", ' id="content"'),
             ("div", ' class="post-body"'), ("div", ' class="article"'), ("section", ' class="story"'), ("div", ""), ("section", "")]
        )
        body = [f"<h1>{self.words(2, 9)}</h1>"] if r.random() < 0.8 else []
        body += [self.paragraph() for _ in range(r.choice([1, 2, 3, 5, 8, 14, 25]))]
        for kind, chance in (("advert", 0.25), ("notice", 0.1), ("sidebar", 0.12), ("form", 0.08), ("share", 0.1)):
            if r.random() < chance:
                body.insert(r.randint(min(1, len(body)), len(body)), self.junk(kind))
        if r.random() < 0.2:
            body.append(self.junk("comments"))
        return f'<{tag} data-label="1"{mark}>{"".join(body)}</{tag}>'

    def page(self) -> str:
        r = self.random
        before = [k for k, c in (("notice", 0.3), ("header", 0.5), ("menu", 0.7), ("form", 0.2), ("advert", 0.4)) if r.random() < c]
        after = [k for k, c in (("share", 0.2), ("comments", 0.35), ("sidebar", 0.45), ("advert", 0.25), ("form", 0.2), ("footer", 0.8), ("notice", 0.1)) if r.random() < c]
        r.shuffle(before)
        inner = "".join(self.junk(k) for k in before) + self.article() + "".join(self.junk(k) for k in after)
        if r.random() < 0.35:
            inner = f'<div data-label="0"{self.marks("wrapper", "container", "page")}>{inner}</div>'
        return f'<html><body data-label="0">{inner}</body></html>'


def labelled_pages(count: int, seed: int = 5) -> list[str]:
    """Pages of as many different layouts as chance gives."""
    return [_Writer(seed * 100_003 + i).page() for i in range(count)]
