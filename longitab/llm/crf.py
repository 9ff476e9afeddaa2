"""Main text of web pages by a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import Block, blocks
from .layouts import labelled_pages

#: Pages of the table that are labelled by their own markup for training, and the longest such page.
TRAIN_PAGES, TRAIN_CHARS = 100, 50_000
#: Pages laid out for training, rounds of training, and its step and penalty.
LAID_OUT, ROUNDS, STEP, PENALTY = 240, 20, 0.5, 1e-4
#: Words of class, id and role by what they announce.
HINTS = {
    "menu": "nav navigation navbar navigate menu menubar topbar breadcrumb breadcrumbs crumbs toc pagination pager skip tabs toolbar",
    "head": "header masthead branding logo tagline hero",
    "foot": "footer foot colophon copyright legal contentinfo",
    "side": "sidebar side aside widget widgets complementary rail",
    "ad": "ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit banner promo promotion sponsored sponsor sponsors affiliate",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay dialog disclaimer warning toast paywall message hidden",
    "form": "form search login signin signup subscribe subscription newsletter contact input register poll survey",
    "talk": "comment comments commentlist respond reply replies disqus discussion feedback reviews forum thread",
    "more": "share sharing social related recommended recommend recommendations trending popular tags tagcloud teaser teasers byline meta",
    "main": "article content main post entry story body text articlebody prose",
}
HINT = {f".{w}": f"hint={group}" for group, words in HINTS.items() for w in words.split()}
#: What short texts around an article say; a leading space stands for the start of a word.
PHRASES = {
    "copyright": ("©", "(c)", " copyright", "all rights reserved", " impressum", "privacy policy", "terms of use", "terms of service"),
    "cookie": (" cookie", " consent "),
    "advert": (" advert", " sponsored", " promoted", " buy now", "% off"),
    "form": (" sign in", " sign up", " log in", " login", " subscribe", " newsletter", " your email", " your e-mail", " submit ", " search "),
    "talk": (" reply ", " replies", " comment", " says:", " posted by"),
    "more": (" read more", " share ", " related ", " follow us", " tweet"),
}


def features(block: Block) -> list[str]:
    """Ancestor-tag and text features of one block."""
    words = block.text.count(" ") + 1
    out = ["bias", f"tag={block.tag}", f"words={min(6, words.bit_length())}", f"linked={round(block.linked * 3)}"]
    out += {HINT[n] if n in HINT else f"in={n}" for n in block.around if n in HINT or n[0] != "."}
    if block.text[-1:] in ".!?…。\"'”»":
        out.append("ends")
    if words <= 60:
        said = f" {block.text.lower()} "
        out += [f"says={k}" for k, phrases in PHRASES.items() if any(map(said.__contains__, phrases))]
    return out


Sequence_ = tuple[list[list[str]], list[bool]]  # features, and whether the section is that of the block before


def sequence(of: Sequence[Block]) -> Sequence_:
    return [features(b) for b in of], [False, *[a.section == b.section for a, b in zip(of, of[1:])]]


class Crf:
    """Two labels, 0 and 1 (main text); edge weights differ within a section and across two."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}  # in favour of label 1
        self.edges = np.zeros((2, 2, 2))  # same section, label before, label

    def emissions(self, rows: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in row) for row in rows]

    def decode(self, rows: list[list[str]], same: list[bool]) -> list[int]:
        """The most likely labels (Viterbi)."""
        edges = self.edges.tolist()
        zero = one = 0.0
        back = []
        for k, score in enumerate(self.emissions(rows)):
            if k:
                e = edges[same[k]]
                a, b, c, d = zero + e[0][0], one + e[1][0], zero + e[0][1], one + e[1][1]
                back.append((b > a, d > c))
                zero, one = max(a, b), max(c, d)
            one += score
        if not rows:
            return []
        label = int(one > zero)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]

    def _gradient(self, rows, same, labels) -> float:
        """Add one page's gradient to ``self.change`` and ``self.turn``; returns its log-likelihood."""
        n = len(rows)
        unary = np.zeros((n, 2))
        unary[:, 1] = self.emissions(rows)
        step = self.edges[np.array(same, np.int64)]
        ahead, after = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = unary[0]
        for k in range(1, n):
            ahead[k] = unary[k] + np.logaddexp(ahead[k - 1][0] + step[k][0], ahead[k - 1][1] + step[k][1])
        for k in range(n - 2, -1, -1):
            to = step[k + 1] + unary[k + 1] + after[k + 1]
            after[k] = np.logaddexp(to[:, 0], to[:, 1])
        total = np.logaddexp(*ahead[-1])
        share = np.exp(ahead[:, 1] + after[:, 1] - total)
        for row, y, p in zip(rows, labels, share):
            for f in row:
                self.change[f] = self.change.get(f, 0.0) + y - p
        likely = sum(u[y] for u, y in zip(unary, labels))
        for k in range(1, n):
            pair = np.exp(ahead[k - 1][:, None] + step[k] + unary[k] + after[k] - total)
            self.turn[int(same[k])] -= pair
            self.turn[int(same[k]), labels[k - 1], labels[k]] += 1
            likely += step[k][labels[k - 1], labels[k]]
        return likely - total

    def fit(self, pages: Iterable[tuple[Sequence_, list[int]]], rounds: int = ROUNDS) -> Crf:
        """Maximise the penalised log-likelihood by adaptive gradient steps, in a fixed order."""
        pages = [p for p in pages if p[1]]
        squares: dict[str, float] = {}
        turned = np.full_like(self.edges, 1e-6)
        for _ in range(rounds):
            for start in range(0, len(pages), 20):
                self.change, self.turn = {}, np.zeros_like(self.edges)
                for (rows, same), labels in pages[start:start + 20]:
                    self._gradient(rows, same, labels)
                for f, g in self.change.items():
                    g -= PENALTY * len(pages) * self.weights.get(f, 0.0)
                    squares[f] = squares.get(f, 1e-6) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + STEP * g / squares[f] ** 0.5
                turned += self.turn ** 2
                self.edges += STEP * self.turn / turned ** 0.5
        del self.change, self.turn
        self.weights = {f: float(w) for f, w in self.weights.items()}
        return self


def marked_up(page: str) -> tuple[list[Block], list[int]] | None:
    """A page labelled by its own markup: main text is what stands in ``article``
    or ``main`` and in nothing that announces otherwise; null without either."""
    found = blocks(page)
    away = {"nav", "aside", "footer", "form", "button", "select", "dialog"}
    labels = []
    for b in found:
        hints = {HINT[n] for n in b.around if n in HINT} - {"hint=main"}
        labels.append(int(bool(b.around & {"article", "main"}) and not b.around & away and not hints))
    return (found, labels) if any(labels) else None


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> Crf:
    """Fit on laid-out pages whose labels are known, and on at most
    ``train_pages`` pages of the table that mark their main text themselves."""
    short = pages.where(F.length(html_col) <= TRAIN_CHARS).select(F.xxhash64(id_col, html_col).alias("at"), F.col(html_col).alias("html"))
    least = [r.at for r in short.select("at").distinct().orderBy("at").limit(train_pages).collect()]
    sample = short.where(F.col("at").isin(least)).distinct().orderBy("at", "html").limit(train_pages).collect()
    known = [*labelled_pages(LAID_OUT), *[r.html for r in sample]]
    marked = [p if isinstance(p, tuple) else marked_up(p) for p in known]
    return Crf().fit([(sequence(m[0]), m[1]) for m in marked if m])


def main_text(page: str | None, model: Crf) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, y in zip(found, model.decode(*sequence(found))) if y)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Crf | None = None) -> DataFrame:
    """The main text of every page: ``(<id>, <url>, text, n_chars)``, one row per input row.

    Blocks labelled as main text, in page order, joined by one line break.  A
    null or empty page, or one without main text, gives an empty text.  Pages
    are read whole, one at a time.  Repeated rows are extracted alike; other
    columns are ignored; an empty table gives no rows.
    """
    model = model or train(pages, id_col, html_col)
    held = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), held.value) for p in column], pa.string())

    return pages.select(pages[id_col].alias(id_col), pages[url_col].alias(url_col), text(pages[html_col]).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
