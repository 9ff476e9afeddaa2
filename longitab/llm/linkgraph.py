"""Allow and block rules for urls, spread over the link graph between hosts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longitab.session import stage, unstage

Rule = tuple[str, str, str]  # host, path, verdict
#: The rules of the url contract.
RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The address of an anchor, quoted or bare, where it names a host.
HREF = r"(?i)<a\b[^>]*?\shref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"
DAMPING = 0.85
#: Propagation ends when a round adds less than this to either kind's scores, of which each sums to 1 at most.
TOLERANCE = 1e-9
#: Rounds after which the tolerance is met on any graph; the SQL twin makes so many.
ROUNDS = 1 + int(math.log(TOLERANCE) / math.log(DAMPING))
#: A host is blocked from this share of the mean distrust on, which is 1 by the number of hosts.
LEAST = 0.001


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; without ``://`` empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (its text, like ``net/es/``) and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is tried last and wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst, links)`` between different hosts; a page counts each host it links to once.

    Relative links, links to the own host and links without a host are no edges.
    """
    links = F.regexp_extract_all(pages[html_col], F.lit(HREF), F.lit(1))
    hosts = F.array_distinct(F.transform(links, lambda x: host(F.regexp_replace(x, "^[^/]*//", "x://"))))
    return (
        pages.select(host(pages[url_col]).alias("src"), F.explode(hosts).alias("dst"))
        .where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))
    )


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = TOLERANCE
) -> DataFrame:
    """Personalised PageRank from two sets of seeds at once: ``(node, trust, distrust)``.

    ``edges`` is ``(src, dst, links)``, ``seeds`` ``(node, kind, weight)`` with
    kind ``trust`` or ``distrust``.  Trust runs along the links, distrust
    against them; a node divides its score by its links in that direction.
    Each kind's seeds share 1.  After k rounds a node holds what paths of at
    most k links bring it.  Rounds end after ``rounds``, where given, and when
    one adds less than ``tolerance`` to each kind's scores; what is left out is
    then below ``tolerance * damping / (1 - damping)`` for all nodes of a kind
    together.  A round passes on ``damping`` of what the last one added, so
    their number does not grow with the graph.  One row of sums a round comes
    to the driver.  Nodes that nothing reaches get no row; null nodes are ignored.
    """
    ways = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("node"), F.col("dst").alias("to"), "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("node"), F.col("src").alias("to"), "links"))
    total = ways.groupBy("kind", "node").agg(F.sum("links").alias("all"))
    flow = stage(ways.join(total, ["kind", "node"]).select("kind", "node", "to", (F.col("links") / F.col("all")).alias("share")))
    start = stage(seeds.where("node is not null and weight > 0").groupBy("kind", "node").agg(F.sum("weight").alias("weight")))
    sums = start.groupBy("kind").agg(F.sum("weight").alias("all"))
    jump = start.join(sums, "kind").select("kind", "node", (F.col("weight") / F.col("all") * (1 - damping)).alias("score"))
    # ``added`` is what the last round brought: the only part that still moves
    score = stage(jump.withColumn("added", F.col("score")))
    of = lambda kind, what: F.sum(F.when(F.col("kind") == kind, F.col(what)).otherwise(0.0))
    done = 0
    going = not flow.isEmpty()
    while going and done != rounds:
        passed = F.col("added") * F.col("share") * damping
        moved = score.where("added > 0").join(flow, ["kind", "node"]).select("kind", F.col("to").alias("node"), passed.alias("score"), passed.alias("added"))
        after = stage(score.withColumn("added", F.lit(0.0)).unionByName(moved).groupBy("kind", "node").agg(
            F.sum("score").alias("score"), F.sum("added").alias("added")))
        unstage(score)
        score, done = after, done + 1
        trust, distrust = score.agg(of("trust", "added"), of("distrust", "added")).first()
        going = max(trust or 0.0, distrust or 0.0) >= tolerance
    unstage(flow, start)
    return score.groupBy("node").agg(of("trust", "score").alias("trust"), of("distrust", "score").alias("distrust"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = tuple(RULES),
    majority: float = 0.5,
    least: float = LEAST,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One verdict per page: ``(<id>, host, path, rule, verdict, trust, distrust)``.

    The longest rule that fits decides.  Where none fits, the host does: it is
    blocked if its distrust is above its trust and at least ``least`` times the
    mean over all hosts with pages or links, else allowed.  Propagation goes on
    until what it leaves out is a thousandth of that threshold.  Hosts of
    which at least ``majority`` of the pages are allowed (blocked) by a rule
    are trusted (blocked) seeds, weighing as many as those pages.

    A null url or one without ``://`` has empty host and path, no rule, and is
    allowed; a null html has no links.  Repeated rows are judged alike and each
    counts.  Other columns are ignored; no pages give no rows.
    """
    at_host, at_path = host(pages[url_col]), path(pages[url_col])
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    rows = pages.select(pages[id_col].alias(id_col), at_host.alias("host"), at_path.alias("path")).select(
        id_col, "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    counts = rows.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("ruled") == "allow").alias("trust"),
        F.count_if(F.col("ruled") == "block").alias("distrust"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("weight")) for k in ("trust", "distrust")]))
    seeds = counts.select(F.col("host").alias("node"), "pages", kinds.alias("s")).select("node", "s.*", "pages").where(
        F.col("weight") >= majority * F.col("pages"))
    edges = stage(host_edges(pages, url_col, html_col))
    hosts = counts.select("host").union(edges.select("src")).union(edges.select("dst")).distinct().count()
    threshold = least / max(hosts, 1)
    scores = propagate(edges, seeds.drop("pages"), tolerance=min(TOLERANCE, threshold / 1000 * (1 - DAMPING) / DAMPING) or TOLERANCE)
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= threshold)
    return rows.join(scores, F.col("host") == F.col("node"), "left").select(
        id_col, "host", "path", "rule", F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        zero("trust"), zero("distrust"))
