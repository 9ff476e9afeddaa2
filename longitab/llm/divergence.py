"""How a source's words differ from its language's, by iceberg prefix refinement.

Which terms stand in enough documents is found without counting all terms: the
documents of each byte prefix are counted, prefixes below the threshold are
dropped with all that start with them, and the others are extended, level by
level, until only complete terms are left.  All arithmetic is in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longitab.session import stage, unstage

from .common import BATCH_ROWS, batches_of, released

#: Bytes of the first level's prefixes; each level doubles them.
FIRST = 4
#: Bits of the table that tells blocks which prefixes or terms are still in: 4 MB, whatever their number.  A prefix
#: that is in by chance is counted once more and then dropped by its own count.
MARKS = 1 << 25
#: Bytes of text of a block, a longer text alone.
BLOCK = 4 << 20
#: Rows, and bytes of names, whose counts a worker sums before they leave it, and rows that leave it at a time.
MERGED, MERGED_BYTES, SENT = 500_000, 1 << 25, 1 << 15
#: Counts below it may be multiplied by UNIT in 64 bits.
SMALL = 9_000_000_000
#: Rows of a language or group table that a join may send to every executor; above, it is shuffled.
FEW = 50_000
#: Fixed value: the unit of the smoothed shares.
UNIT = 1_000_000_000
#: Fixed value: A-Z become small; other bytes that are neither ASCII letters nor beyond ASCII become spaces.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _distinct(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, all below ``size``, ascending, and each key's place among them; without a sort where they lie close."""
    if size > 16 * len(keys):
        return np.unique(keys, return_inverse=True)
    there = np.zeros(size, bool)
    there[keys] = True
    found = np.flatnonzero(there)
    place = np.zeros(size, np.int32)
    place[found] = np.arange(len(found))
    return found, place[keys]


def tallied(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, all below ``size``, ascending, and how often each stands; without a sort where they lie close."""
    if size > 4 * len(keys):
        return np.unique(keys, return_counts=True)
    often = np.bincount(keys, minlength=size)
    found = np.flatnonzero(often)
    return found, often[found]


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of each one's positive numbers; without a sort where they lie close."""
    if not len(keys):
        return keys, n
    width = int(n.max()) + 1
    if int(keys.max()) < 4 * len(keys) and width * len(keys) < 1 << 53:  # sums are exact in doubles
        sums = np.bincount(keys, n)
        found = np.flatnonzero(sums)
        return found, sums[found].astype(np.int64)
    if int(keys.max()) >= (1 << 62) // width:
        found, at = np.unique(keys, return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, at, n)
        return found, sums
    both = keys * width + n  # sorted as one number
    both.sort()
    key = both // width
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(both - key * width, first)


def prefixes(terms: pa.Array, length: int) -> tuple[np.ndarray, pa.Array]:
    """The number of each term's prefix of ``length`` bytes, and the prefixes; the terms ascend, so equal prefixes stand together."""
    cut = pc.binary_slice(terms, 0, length)
    if not len(cut):
        return np.zeros(0, np.int64), cut
    first = np.append(True, pc.not_equal(cut.slice(1), cut.slice(0, len(cut) - 1)).to_numpy(zero_copy_only=False))
    return np.cumsum(first) - 1, cut.filter(pa.array(first))


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """``(document, term, count)`` of each distinct term of each text, and the terms, both ascending."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    start, end = int(offsets[0]), int(offsets[-1])
    plain = pa.py_buffer(data[start:end].to_pybytes().translate(BYTES)) if data is not None else None
    # as bytes: a text is cut between its characters only, so terms stay UTF-8
    words = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - start), plain))
    code, terms = _distinct(words.flatten())
    terms = terms.cast(pa.binary())
    order = pc.array_sort_indices(terms).to_numpy()
    order = order[pc.binary_length(terms).to_numpy()[order] > 0]
    size = max(1, len(order))
    kind = np.int32 if len(texts) * size < 1 << 31 else np.int64  # half as wide, sorted twice as fast
    place = np.full(len(terms), -1, kind)
    place[order] = np.arange(len(order), dtype=kind)
    term = place[code]
    doc = np.repeat(np.arange(len(texts), dtype=kind), pc.list_value_length(words).to_numpy())
    key, n = np.unique((doc * kind(size) + term)[term >= 0], return_counts=True)
    doc = key // kind(size)
    return doc, key - doc * kind(size), n, terms.take(pa.array(order))


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of runs of rows that hold about ``BLOCK`` bytes of text, a longer text alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // BLOCK)) + 1):
        if len(rows):
            yield int(rows[0]), len(rows)


def merged(counted: Iterator[tuple[list[tuple], np.ndarray, pa.Array, np.ndarray]]) -> Iterator[tuple[list[pa.Array], pa.Array, pa.Array]]:
    """Counts of several blocks with those of one (group, name) summed, so that fewer rows leave the worker.

    A block gives its groups as tuples, and of each row the group's number, the
    name and the count; rows come out as the groups' columns, names and sums.
    """
    known, held, rows, size = {}, [], 0, 0

    def sums():
        table = pa.Table.from_batches(held).group_by(["group", "name"], use_threads=False).aggregate([("n", "sum")])
        held.clear()
        columns = [pa.array(x) for x in zip(*known)]
        for part in table.to_batches(max_chunksize=SENT):
            yield [x.take(part.column("group")) for x in columns], part.column("name"), part.column("n_sum")

    for groups, at, names, n in counted:
        if not len(n):
            continue
        code = np.array([known.setdefault(g, len(known)) for g in groups], np.int32)
        held.append(pa.RecordBatch.from_arrays([pa.array(code[at]), names, pa.array(n)], ["group", "name", "n"]))
        rows, size = rows + len(n), size + names.nbytes
        if rows >= MERGED or size >= MERGED_BYTES:
            yield from sums()
            known, held, rows, size = {}, [], 0, 0
    if held:
        yield from sums()


def _joined(names: pa.Array) -> bytes:
    offsets, data = np.frombuffer(names.buffers()[1] or b"", np.int32), names.buffers()[2]
    return data[int(offsets[names.offset]):int(offsets[names.offset + len(names)])].to_pybytes() if len(names) else b""


def _bags(docs: DataFrame) -> DataFrame:
    """One row per block of documents: its ``bag`` of terms, packed.

    ``group_of`` has each document's (lang, source); ``doc``, ``term`` and
    ``n`` have how often a term stands in a document, by document and term.
    All are 32-bit integers, little-endian; the terms are stored one after
    another, ascending.
    """
    schema = ("langs array<string>, sources array<string>, term_bytes binary, "
              "term_sizes binary, group_of binary, doc binary, term binary, n binary")

    def run(batches):
        for batch in batches:
            for start, size in blocks(batch.column(2)):
                lang, source, text = (batch.column(k).slice(start, size) for k in range(3))
                (a, langs), (b, sources) = _distinct(lang), _distinct(source)
                groups, group_of = np.unique(a.astype(np.int64) * len(sources) + b, return_inverse=True)
                doc, term, n, terms = bags(text)
                rows = [langs.take(pa.array(groups // len(sources))), sources.take(pa.array(groups % len(sources)))]
                numbers = (pc.binary_length(terms).to_numpy(), group_of, doc, term, n)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([x.to_pylist()], pa.list_(pa.string())) for x in rows], pa.array([_joined(terms)], pa.binary()),
                     *[pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in numbers]],
                    ["langs", "sources", "term_bytes", "term_sizes", "group_of", "doc", "term", "n"])

    return docs.mapInArrow(released(run), schema)


def marks(rows: DataFrame, lang: str, name: str) -> bytes:
    """A table of ``MARKS`` bits, of which those at the hashes of the rows' (lang, name) are set."""
    spot = F.col("spot")
    words = rows.select(F.pmod(F.xxhash64(lang, name), F.lit(MARKS)).alias("spot")).groupBy(
        F.floor(spot / 32768).alias("at")).agg(F.bitmap_construct_agg((spot % 32768)).alias("bits"))
    table = bytearray(MARKS // 8)
    for r in words.collect():  # at most MARKS / 32768 rows of 4 KB, in one job, not one a partition
        table[r["at"] * 4096:(r["at"] + 1) * 4096] = r["bits"]
    return bytes(table)


def marked(table: np.ndarray, seeds: np.ndarray, names: pa.Array, lang: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Which of the (lang, name), given by number, are marked; some are by chance.  ``seeds`` are the languages' hashes."""
    of, data = xxhash.xxh64_intdigest, names.to_numpy(zero_copy_only=False)
    seed = seeds.tolist()
    spot = np.fromiter((of(data[b], seed[a]) for a, b in zip(lang.tolist(), name.tolist())), np.uint64, len(lang)).view(np.int64) % MARKS
    return (table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


def seeds_of(langs: pa.Array) -> np.ndarray:
    """Spark's hash of each language, which starts the hash of what follows it; 42 is Spark's own start."""
    return np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in langs.to_pylist()], dtype=np.uint64)


class Bag:
    """One row of ``_bags``."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        def numbers(name):
            return np.frombuffer(batch.column(name)[k].as_buffer(), "<i4")
        self.langs, self.sources = batch.column("langs")[k].values, batch.column("sources")[k].values
        sizes = numbers("term_sizes")
        offsets = pa.array(np.append(0, np.cumsum(sizes, dtype=np.int64)).astype(np.int32))
        data = batch.column("term_bytes")[k].as_buffer()
        self.terms = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets.buffers()[1], data])
        self.sizes, self.doc, self.term, self.n = sizes, numbers("doc"), numbers("term"), numbers("n")
        self.group_of = numbers("group_of").astype(np.int64)


def _nodes(stored: DataFrame, length: int, kept) -> DataFrame:
    """``(lang, node, complete, docs)``, some blocks' share: in how many of its documents each open prefix of
    ``length`` bytes stands, and each term that ends on this level, if the prefix of half the length is marked."""
    def counted(batches):
        table = kept and np.frombuffer(kept.value, np.uint8)
        for batch in batches:
            for k in range(batch.num_rows):
                bag = Bag(batch, k)
                here = np.flatnonzero(bag.sizes > (length // 2 if length > FIRST else 0))
                prefix, names = prefixes(bag.terms.take(pa.array(here)), length)
                node = np.full(len(bag.sizes), -1)
                node[here] = prefix * 2 + (bag.sizes[here] > length)  # ascending as the terms are, for what ends here comes first
                lang, langs = _distinct(bag.langs)
                row = node[bag.term]
                on = row >= 0
                nodes = 2 * max(1, len(names))
                # one of each document, where equal ones stand together, then how many of each language
                doc, row = bag.doc[on], row[on]
                if not len(doc):
                    continue
                first = np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]))
                lang_of = lang[bag.group_of].astype(np.int64)
                key, docs = tallied(lang_of[doc[first]] * nodes + row[first], len(langs) * nodes)
                lang_, name = key // nodes, key % nodes // 2
                if table is not None:
                    half, halves = prefixes(names, length // 2)
                    pairs, back = numbered(lang_ * len(halves) + half[name], len(langs) * len(halves))
                    on = marked(table, seeds_of(langs), halves, pairs // len(halves), pairs % len(halves))[back]
                    key, docs, lang_, name = key[on], docs[on], lang_[on], name[on]
                groups = [(x, complete) for x in langs.to_pylist() for complete in (True, False)]
                yield groups, lang_ * 2 + key % 2, names.take(pa.array(name)), docs

    def run(batches):
        for (lang, complete), node, docs in merged(counted(batches)):
            yield pa.RecordBatch.from_arrays([lang, node, complete, docs], ["lang", "node", "complete", "docs"])

    # dealt first, then summed: a worker's rows are sums already
    return stored.mapInArrow(released(run), "lang string, node binary, complete boolean, docs long").repartition("lang", "node")


def _kept(stored: DataFrame, least: int) -> DataFrame:
    """``(lang, term, docs)`` of the terms in at least ``least`` documents of the language."""
    context = stored.sparkSession.sparkContext
    levels, held, table, length = [], [], None, FIRST
    while True:
        level = stage(_nodes(stored, length, table).groupBy("lang", "node", "complete").agg(F.sum("docs").alias("docs"))
                      .where(F.col("docs") >= least))
        held.append(level)
        levels.append(level.where("complete").select("lang", F.col("node").alias("term"), "docs"))
        still = level.where("not complete")
        if still.isEmpty():
            break
        table = context.broadcast(marks(still, "lang", "node"))
        length *= 2
    kept = levels[0]
    for more in levels[1:]:
        kept = kept.union(more)
    out = stage(kept)
    unstage(*held)
    return out


def _cells(stored: DataFrame, kept) -> DataFrame:
    """``(lang, source, term, n)``, some blocks' share of how often each group has each marked term."""
    def counted(batches):
        table = np.frombuffer(kept.value, np.uint8)
        for batch in batches:
            for k in range(batch.num_rows):
                bag = Bag(batch, k)
                if not len(bag.n):
                    continue
                terms = len(bag.terms)
                lang, langs = _distinct(bag.langs)
                group = bag.group_of[bag.doc]
                pairs, back = numbered(lang[group] * np.int64(terms) + bag.term, len(langs) * terms)
                on = marked(table, seeds_of(langs), bag.terms, pairs // terms, pairs % terms)[back]
                key, n = summed(group[on] * terms + bag.term[on], bag.n[on])
                yield list(zip(bag.langs.to_pylist(), bag.sources.to_pylist())), key // terms, bag.terms.take(pa.array(key % terms)), n

    def run(batches):
        for (lang, source), term, n in merged(counted(batches)):
            yield pa.RecordBatch.from_arrays([lang, source, term, n], ["lang", "source", "term", "n"])

    # dealt as the kept terms are
    return stored.mapInArrow(released(run), "lang string, source string, term binary, n long").repartition("lang", "term")


def _share(count: Column, denominator: Column) -> Column:
    """The smoothed share in units: 1 + floor(UNIT * (count + 2) / denominator), exactly."""
    whole = F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    wide = F.call_function("div", whole, denominator.cast("decimal(20,0)")).cast("long")
    return F.lit(1) + F.when(count < SMALL, F.call_function("div", F.lit(UNIT) * (count + 2), denominator)).otherwise(wide)


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least: int = 10, best: int = 10, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """How far sources differ from each other, and the terms that set each apart from its language.

    A term is a run of ASCII letters, of which capitals become small, and
    characters beyond ASCII.  A language keeps the terms that stand in at least
    ``least`` of its documents.  A group is a source of a language; ``count``
    is how often a kept term stands in its documents, N the sum of these, V the
    number of kept terms, p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)), and
    the gap of two shares p, q is floor((p - q)^2 / (p + q)).

    Returns ``(lang, source, part, item, value, rank)``.  Part ``pair``: each
    other source of the language and the gaps summed over all kept terms, also
    those that neither has.  Part ``term``: the ``best`` kept terms whose share
    in the group is above that in the whole language, by gap.  Ranks go by
    value, then by the item's bytes.

    A null text, language or source is an empty one.  Repeated rows are
    documents of their own.  Other columns are ignored; an empty table gives no
    rows.  Every pair of a language's sources is a row of the result, so it
    grows with the square of their number.
    """
    def plain(name):
        return F.coalesce(docs[name].cast("string"), F.lit(""))
    texts = docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).alias("text"))
    spark = docs.sparkSession
    with batches_of(spark, BATCH_ROWS):
        # a task gets few groups, so its counts have few rows; AQE cuts a large group among several
        stored = stage(_bags(texts.hint("rebalance", "lang", "source")))
    with batches_of(spark, 1):  # a row is a block
        kept = _kept(stored, least)
        table = spark.sparkContext.broadcast(marks(kept, "lang", "term"))
        cells = _cells(stored, table).groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(kept, ["lang", "term"], "left_semi")
        # the rows lie by language and term here
        cells = stage(cells.withColumn("whole", F.sum("n").over(Window.partitionBy("lang", "term"))))
    unstage(stored)
    sizes = _few(stage(kept.groupBy("lang").agg(F.count("*").alias("v"))))
    groups = texts.select("lang", "source").distinct().join(
        cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(sizes, "lang", "left")
    v = F.coalesce("v", F.lit(0).cast("long"))
    groups = stage(groups.select("lang", "source", v.alias("v"), F.nullif(F.coalesce("total", F.lit(0)) + 2 * v, F.lit(0)).alias("den"))
                   .withColumn("none", _share(F.lit(0).cast("long"), F.col("den"))))
    groups = _few(groups)
    shares = stage(cells.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("den"))).select(
        "lang", "source", "term", "whole", "p", "none"))
    out = _pairs(groups, shares).unionByName(_terms(cells, shares, sizes, best))
    return out


def _few(table: DataFrame) -> DataFrame:
    """A staged table of languages or groups, for a join in place where it is small: else one task joins a whole language."""
    return F.broadcast(table) if table.count() <= FEW else table


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The gaps summed over all kept terms, from those that a group has.

    Were no term in both groups, each term of one would face the other's share
    for nothing, and the terms that neither has would face each other: for that
    a histogram of each group's shares is enough.  Terms in both are set right.
    """
    other = _few(groups.select("lang", F.col("source").alias("item"), F.col("none").alias("none_b")))
    both = groups.join(other, "lang").where("source <> item")
    marks = shares.groupBy("lang", "source", "p", "none").agg(F.count("*").alias("terms"))
    alone = marks.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(
        F.sum(F.col("terms") * (_gap(F.col("p"), F.col("none_b")) - _gap(F.col("none"), F.col("none_b")))).alias("alone"))
    p, none, q, none_b = (F.col(x) for x in ("a.p", "a.none", "b.p", "b.none"))
    right = _gap(p, q) - _gap(p, none_b) - _gap(none, q) + _gap(none, none_b)
    # each pair once, from the smaller name; both sides are one shuffle
    shared = shares.alias("a").join(shares.alias("b"), F.expr("a.lang = b.lang and a.term = b.term and a.source < b.source")).groupBy(
        "a.lang", "a.source", F.col("b.source").alias("item")).agg(F.sum(right).alias("shared"))
    turned = [F.col("lang"), F.col("item").alias("source"), F.col("source").alias("item")]
    parts = alone.select("lang", "source", "item", F.col("alone").alias("part")).unionByName(
        alone.select(*turned, F.col("alone").alias("part"))).unionByName(
        shared.select("lang", "source", "item", F.col("shared").alias("part"))).unionByName(
        shared.select(*turned, F.col("shared").alias("part"))).unionByName(
        both.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * _gap(F.col("none"), F.col("none_b"))).otherwise(0).alias("part")))
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("part").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(cells: DataFrame, shares: DataFrame, sizes: DataFrame, best: int) -> DataFrame:
    dens = _few(stage(cells.groupBy("lang").agg(F.sum("n").alias("total")).join(sizes, "lang").select(
        "lang", (F.col("total") + 2 * F.col("v")).alias("den"))))
    found = shares.join(dens, "lang").withColumn("q", _share(F.col("whole"), F.col("den"))).where("p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", rank).where(F.col("rank") <= best).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
