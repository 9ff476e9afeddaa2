"""Training pages with known labels: invented layouts filled with invented words."""

from __future__ import annotations

import random

from .dom import Block, blocks

WORDS = (
    "able acorn amber arch autumn basin birch bold brook calm cedar chalk cliff cloud coast copper coral dawn delta dune early ember fern field "
    "flint foam forest frost glade grain granite grove harbor hazel heath hill iris island ivory jade juniper lake larch leaf lichen lily maple "
    "marsh meadow mist moss north oak ocean olive opal orchard pearl pebble pine plain quartz rain reed ridge river rowan sage sand shale shore "
    "sky slate snow spring spruce stone storm summer tide timber valley violet water willow wind winter yarrow"
).split()
MARK = "⁣"  # stands at the start of each text that is main text; invisible and never in the words

#: Where main text may stand: an opening, and the closing tags.
HOLDERS = [
    ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article class='post'>", "</article></main>"),
    ("<div id='content'>", "</div>"), ("<div class='entry-content'>", "</div>"), ("<section class='article-body'>", "</section>"),
    ("<div class='post'><div class='text'>", "</div></div>"), ("<div>", "</div>"), ("<div class='c12'><div>", "</div></div>"),
    ("<table><tr><td>", "</td></tr></table>"), ("<article itemprop='articleBody'><section>", "</section></article>"), ("", ""),
]


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.r.choice(WORDS) for _ in range(self.r.randint(lo, hi))).capitalize()

    def prose(self, lo: int = 1, hi: int = 6) -> str:
        return " ".join(self.words(4, 18) + self.r.choice(". . . . ! ?".split()) for _ in range(self.r.randint(lo, hi)))

    def some(self, make, lo: int, hi: int) -> str:
        return "".join(make() for _ in range(self.r.randint(lo, hi)))

    def link(self, lo: int = 1, hi: int = 4) -> str:
        return f"<a href='/{self.r.choice(WORDS)}'>{self.words(lo, hi)}</a>"

    def links(self) -> str:
        return "<ul>" + self.some(lambda: f"<li>{self.link()}</li>", 2, 8) + "</ul>"

    def paragraph(self) -> str:
        kind = self.r.random()
        if kind < 0.7:
            return f"<p>{MARK}{self.prose()}</p>"
        if kind < 0.78:
            return f"<h2>{MARK}{self.words(1, 8)}</h2>"
        if kind < 0.84:
            return "<ul>" + self.some(lambda: f"<li>{MARK}{self.words(2, 14)}{self.r.choice(['', '.'])}</li>", 2, 5) + "</ul>"
        if kind < 0.88:
            return f"<blockquote>{MARK}{self.prose(1, 2)}</blockquote>"
        if kind < 0.91:
            return f"<pre>{MARK}{self.words(3, 20)}</pre>"
        if kind < 0.94:
            return f"<p>{MARK}{self.words(3, 8)} {self.link()} {self.words(3, 12)}.</p>"
        if kind < 0.97:
            return f"<p>{MARK}{self.words(1, 3)}</p>"
        return f"<p><b>{MARK}{self.prose()}<br>"

    def around(self) -> str:
        """One thing that is not main text."""
        p, c = self.prose, self.r.choice
        return c([
            lambda: f"<nav>{self.links()}</nav>",
            lambda: f"<div class='{c(['menu', 'main-nav', 'navbar', 'topbar', 'breadcrumbs'])}'>{self.links()}</div>",
            lambda: f"<header><p>{self.words(1, 4)}</p><p>{p(1, 1)}</p></header>",
            lambda: f"<div class='{c(['header', 'masthead', 'site-header'])}'>{self.words(1, 5)}</div>",
            lambda: f"<aside>{c([self.links(), f'<p>{p()}</p>'])}</aside>",
            lambda: f"<div {c(['class', 'id'])}='{c(['sidebar', 'widget', 'right-rail', 'side'])}'><h3>{self.words(1, 3)}</h3><p>{p(1, 4)}</p></div>",
            lambda: f"<div class='{c(['ad', 'ads', 'advert', 'ad-slot', 'banner', 'promo', 'sponsored'])}'>{c(['', '<p>'])}{p(1, 3)}</div>",
            lambda: f"<section id='{c(['ad', 'advertisement', 'sponsor'])}'><p>{p(1, 2)}</p>{self.link()}</section>",
            lambda: f"<div class='{c(['cookie', 'cookie-notice', 'consent', 'notice', 'alert', 'popup', 'modal'])}'><p>{p(1, 3)}</p></div>",
            lambda: f"<div role='{c(['alert', 'dialog', 'banner', 'navigation', 'complementary', 'search'])}'>{p(1, 2)}</div>",
            lambda: f"<div><p>We use cookies. {p(1, 1)}</p></div>",
            lambda: f"<form><label>{self.words(1, 3)}</label><p>{p(1, 2)}</p><button>{self.words(1, 2)}</button></form>",
            lambda: f"<div class='{c(['newsletter', 'subscribe', 'login', 'search', 'contact'])}'><p>{p(1, 2)}</p></div>",
            lambda: f"<div class='{c(['share', 'social', 'related', 'recommended', 'tags'])}'>{self.links()}</div>",
            lambda: f"<div class='{c(['related', 'popular', 'trending'])}'><h3>{self.words(1, 3)}</h3><p>{p(1, 1)}</p></div>",
            lambda: f"<{c(['div', 'section'])} {c(['id', 'class'])}='{c(['comments', 'comment-list', 'discussion', 'replies'])}'>"
            + self.some(lambda: f"<{'div'} class='comment'><p>{self.words(1, 2)} says:</p><p>{p()}</p></div>", 1, 4) + "</div>",
            lambda: "<ol class='commentlist'>" + self.some(lambda: f"<li><p>{p()}</p></li>", 1, 4) + "</ol>",
            lambda: f"<div>{self.link()} | {self.link()} | {self.link()}</div>",
        ])()

    def footer(self) -> str:
        c = self.r.choice
        inside = c(["&copy; ", "Copyright ", ""]) + self.words(1, 4) + c([" &middot; ", ". "]) + self.prose(1, 2)
        return c([f"<footer>{inside}</footer>", f"<div class='footer'>{inside}</div>", f"<div id='footer'><p>{inside}</p>{self.links()}</div>",
                  f"<footer><p>{inside}</p></footer>"])

    def build(self) -> str:
        r = self.r
        start, stop = r.choice(HOLDERS)
        inner = [f"<h1>{MARK}{self.words(2, 9)}{r.choice(['', '', '.'])}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.randint(1, 8)):
            inner.append(self.paragraph())
            if r.random() < 0.12:
                inner.append(self.around())
        parts = [self.around() for _ in range(r.randint(1, 4))] + [start, *inner, stop] + [self.around() for _ in range(r.randint(0, 3))]
        return "<html><body>" + "".join(parts) + (self.footer() if r.random() < 0.85 else "") + ("</body></html>" if r.random() < 0.8 else "")


def labelled_pages(n: int) -> list[tuple[list[Block], list[int]]]:
    """``n`` pages as blocks and labels, 1 for main text; the same ones each time."""
    out = []
    for seed in range(n):
        found = blocks(_Page(seed).build())
        labels = [int(MARK in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(MARK, "").strip()
        kept = [(b, y) for b, y in zip(found, labels) if b.text]
        out.append(([b for b, _ in kept], [y for _, y in kept]))
    return out
