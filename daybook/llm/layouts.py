"""Labelled pages that the costs of page blocks are fitted on: layouts as sites use them, filled with random words.

A page is made of parts, each known to be content or not. Names in them are those that templates of blogs, shops, news sites,
wikis, forums and manuals use; a name that sites give to either kind of part stands in both lists here.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

LETTERS = "aabcdeeefghiiklmnooprstuvw"
#: Containers of an article: tag and attributes. Names that tell how a page is set up say nothing about the container.
CONTAINERS = [
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("main", 'id="main"'), ("div", 'id="content"'), ("div", 'class="entry-content"'),
    ("div", 'class="post-body"'), ("div", 'class="article-body"'), ("div", 'class="main-content"'), ("div", 'class="story"'), ("div", 'class="text"'),
    ("div", 'role="main"'), ("div", 'class="col-md-8"'), ("div", ""), ("div", 'class="page"'), ("section", 'class="entry"'), ("div", 'class="article legal"'),
    ("div", 'class="post social"'), ("div", 'class="search article"'), ("div", 'class="maincontent"'), ("td", 'class="content"'), ("div", 'class="left"'),
    ("article", 'class="related-post"'), ("div", 'class="content form"'), ("div", 'class="article share"'), ("div", 'class="post alert"'),
    ("div", 'class="entry notice"'), ("article", 'class="comment"'), ("article", 'class="discussion"')]
#: Sections of an article whose names sound like boilerplate.
SECTIONS = ["discussion", "related", "search", "legal", "form", "share", "social", "notice", "alert", "copyright", "disclaimer", "subscription",
            "recommended", "comment", "promotion", "overlay", "widget", "rail", "skip", "banner", "navigation", "login", "reply"]
#: Parts beside the article: names, and how they are filled.
BESIDE = [
    (["nav", "navbar", "navigation", "menu", "menubar", "main-menu", "topbar", "toolbar", "skip", "masthead", "site-nav"], "links"),
    (["breadcrumb", "breadcrumbs", "pagination", "pager"], "links"),
    (["sidebar", "sidebox", "rail", "widget", "aside", "left sidebar", "sidebar-right", "complementary"], "teasers"),
    (["related", "recommended", "related-posts", "promo", "promotion", "sponsored"], "teasers"),
    (["footer", "foot", "footnav", "site-footer", "contentinfo", "copyright", "legal", "disclaimer"], "small"),
    (["ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adbox", "adslot", "ad-slot", "sponsor", "banner"], "lines"),
    (["cookie", "cookies", "cookie-notice", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay"], "lines"),
    (["newsletter", "subscribe", "subscription", "signup", "signin", "login", "search", "form"], "lines"),
    (["share", "sharing", "social", "share-buttons"], "links"),
    (["comment", "comments", "comments-area", "commentlist", "comment-body", "discussion", "discuss", "disqus", "replies", "reply", "respond"], "prose"),
    (["header", "head", "heading", "site-header"], "title")]
SMALL_PRINT = ["© {n} {w}. All rights reserved.", "Copyright {n} {w} {w}", "Privacy policy | Terms of use", "(c) {n} {w}", "© {w}.example · {w} {w} {w}."]


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.content: set[str] = set()

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.rng.choices(LETTERS, k=self.rng.randint(2, 9))) for _ in range(self.rng.randint(low, high)))

    def prose(self, low: int, high: int) -> str:
        return self.words(low, high).capitalize() + self.rng.choice("...?!:")

    def own(self, text: str) -> str:
        """A text that is content."""
        self.content.add(" ".join(text.split()))
        return text

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(n))

    def filling(self, kind: str) -> str:
        rng = self.rng
        if kind == "links":
            return f"<ul>{self.links(rng.randint(2, 9))}</ul>" if rng.random() < 0.7 else " | ".join(f"<a>{self.words(1, 2)}</a>" for _ in range(4))
        if kind == "teasers":
            teaser = lambda: f"<li><a href=x>{self.words(3, 9)}</a></li>" if rng.random() < 0.6 else f"<li>{self.prose(4, 30)}</li>"
            return f"<h3>{self.words(1, 3)}</h3><ul>{''.join(teaser() for _ in range(rng.randint(1, 6)))}</ul>"
        if kind == "small":
            return f"<p>{rng.choice(SMALL_PRINT).format(n=rng.randint(1999, 2030), w=self.words(1, 1))}</p>" * rng.randint(0, 1) + (
                f"<p>{self.prose(2, 25)}</p>" if rng.random() < 0.6 else f"<ul>{self.links(4)}</ul>")
        if kind == "title":
            return f"<h1>{self.words(1, 3)}</h1>" + (f"<ul>{self.links(4)}</ul>" if rng.random() < 0.5 else f"<p>{self.words(2, 6)}</p>")
        n, low, high = (rng.randint(1, 2), 4, 40) if kind == "lines" else (rng.randint(1, 5), 5, 70)
        line = lambda: self.words(low, high // 2) if kind == "lines" and rng.random() < 0.5 else self.prose(low, high)
        return "".join(f"<p>{line()}</p>" if rng.random() < 0.6 else f"<div>{line()}</div>" if rng.random() < 0.6 else f"{line()}<hr>" for _ in range(n))

    def beside(self, inside: bool = False) -> str:
        """A part that is no content; within an article it is one of those that sites put there."""
        rng = self.rng
        names, kind = rng.choice([b for b in BESIDE if not inside or b[1] not in ("title", "small")])
        if rng.random() < 0.35:
            tags = {"links": "nav", "teasers": "aside", "small": "footer", "title": "header", "lines": rng.choice(["form", "dialog", "aside"])}
            tag, attributes = tags.get(kind, "aside"), ""
        else:
            name = rng.choice(names)
            if inside and name in SECTIONS:
                name = names[0] if names[0] not in SECTIONS else f"{name}-{rng.choice(['box', 'list', 'area'])}"
            kind_of = "role" if name in ("complementary", "contentinfo", "navigation", "banner") and rng.random() < 0.5 else rng.choice(["class", "id"])
            tag, attributes = rng.choice(["div", "div", "section", "ul" if kind == "links" else "div"]), f' {kind_of}="{name}"'
        return f"<{tag}{attributes}>{self.filling(kind)}</{tag}>"

    def piece(self) -> str:
        rng = self.rng
        kind = rng.random()
        if kind < 0.12:  # text straight in the container, or in one without a name
            text = self.own(self.prose(8, 90))
            return rng.choice([f"<div>{text}</div>", f"{text}<hr>", f"<div><span>{text}</span></div>"])
        if kind < 0.55:
            return f"<p>{self.own(self.prose(8, 90))}</p>"
        if kind < 0.65:
            return f"<p>{self.own(self.prose(1, 8))}</p>"
        if kind < 0.75:
            return f"<ul>{''.join(f'<li>{self.own(self.words(1, 20))}</li>' for _ in range(rng.randint(2, 5)))}</ul>"
        if kind < 0.81:
            return f"<blockquote>{self.own(self.prose(6, 40))}</blockquote>"
        if kind < 0.85:
            return f"<table><tr>{''.join(f'<td>{self.own(self.words(1, 4))}</td>' for _ in range(4))}</tr></table>"
        if kind < 0.89:
            return f"<pre>{self.own(self.words(3, 30))}</pre>"
        if kind < 0.93:
            text = f"{self.words(6, 20)} {self.words(1, 3)} {self.words(3, 9)}."
            self.own(text)
            head, tail = text.split(" ", 6)[:6], text.split(" ", 6)[6]
            return f"<p>{' '.join(head)} <a href=y>{tail.split(' ')[0]}</a> {' '.join(tail.split(' ')[1:])}</p>"
        if kind < 0.96:
            return f"<figure><img><figcaption>{self.own(self.words(3, 15))}</figcaption></figure>"
        name = rng.choice(SECTIONS)
        return (f'<section {rng.choice(["id", "class"])}="{name}"><h2>{self.own(self.words(1, 4))}</h2>'
                + "".join(f"<p>{self.own(self.prose(15, 90))}</p>" for _ in range(rng.randint(1, 3))) + "</section>")

    def page(self) -> str:
        rng = self.rng
        tag, attributes = rng.choice(CONTAINERS)
        parts = [f"<h1>{self.own(self.words(2, 14))}</h1>" if rng.random() < 0.85 else ""]
        if rng.random() < 0.2:
            parts = [f"<header>{parts[0]}<p>{self.own(self.words(2, 6))}</p></header>"] if tag in ("article", "main") else parts
        for _ in range(rng.randint(1, 9)):
            if rng.random() < 0.25:
                parts.append(f"<h{rng.randint(2, 4)}>{self.own(self.words(1, 7))}</h3>")
            parts.append(self.piece())
            if rng.random() < 0.1:
                parts.append(self.beside(inside=True))
        body = f"<{tag} {attributes}>{''.join(parts)}</{tag}>"
        body = f"<table><tr>{body}</tr></table>" if tag == "td" else body
        before, after = ("".join(self.beside() for _ in range(rng.randint(0, 4))) for _ in range(2))
        wrapped = f"{before}{body}{after}"
        return f"<html><body>{f'<div class=wrapper>{wrapped}</div>' if rng.random() < 0.5 else wrapped}</body></html>"


def labelled_pages(n: int, seed: int) -> Iterator[tuple[str, set[str]]]:
    """Pages and the texts of their content blocks."""
    rng = random.Random(seed)
    for _ in range(n):
        writer = _Writer(rng)
        yield writer.page(), writer.content
