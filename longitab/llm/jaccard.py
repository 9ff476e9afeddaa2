"""Exact Jaccard join on word shingles that uses relations between sets to skip work.

Prefix filtering finds candidates: under one global order of shingles, sets
that are similar enough share one among the first few of each.  Two relations
save most of the rest:

* In an index list, entries of one size and near positions form a block.  A
  block is skipped as a whole where its first position can't reach the overlap
  that is needed, or where all of it is known to be linked with the prober.
* The entry of least position of a list is its hub.  Each entry is compared
  with the hub first.  What two sets share with the same hub bounds what they
  share with each other from both sides, which answers most of their pairs
  without looking at the sets; pairs already connected need no answer.
"""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longitab.session import stage, unstage

from .common import components, pieces, released, window_hashes, with_ids, word_hashes

#: Counters of the frequency sketch, whatever the input's size.
CELLS = 1 << 22
CHUNK = 1 << 16
#: Partial sketches that one task adds up.
FAN_IN = 64
#: Positions of a list that form a block.
BLOCK = 8


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; fewer words make one shingle, none make none."""
    return np.unique(window_hashes(word_hashes((text or "").encode().lower().split()), words))


def _fingerprint(u: np.ndarray) -> tuple[int, int]:
    """128 bits of a set that do not depend on its order."""
    mixed = (u ^ (u >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return tuple(int(x) for x in np.array([mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed * mixed | np.uint64(1))]).view(np.int64))


def sets_and_sketch(docs: DataFrame, words: int) -> DataFrame:
    """Per document ``(id, size, f1, f2)``, and per task its counts of shingles
    by hash cell as rows ``(part, chunk, counts)`` without a size."""
    schema = "id long, size long, f1 long, f2 long, part int, chunk int, counts binary"

    def run(batches):
        counts = np.zeros(CELLS, np.uint32)
        for batch in (p for b in batches for p in pieces(b, 1)):
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u = shingles(text, words)
                if len(u):
                    np.add.at(counts, (u & np.uint64(CELLS - 1)).astype(np.int64), 1)
                    rows.append((i, len(u), *_fingerprint(u)))
                else:
                    rows.append((i, 0, None, None))
            cols = list(zip(*rows)) if rows else [()] * 4
            none = [None] * len(rows)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in cols], pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.binary())],
                ["id", "size", "f1", "f2", "part", "chunk", "counts"])
        chunks = [zlib.compress(c.tobytes(), 1) for c in np.split(counts, CELLS // CHUNK)]
        none, part = [None] * len(chunks), TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(none, pa.int64())] * 4, pa.array([part] * len(chunks), pa.int32()), pa.array(range(len(chunks)), pa.int32()),
             pa.array(chunks, pa.binary())], ["id", "size", "f1", "f2", "part", "chunk", "counts"])

    return docs.mapInArrow(released(run), schema)


def merged_sketch(parts: DataFrame) -> np.ndarray:
    """The sum of all partial sketches, added ``FAN_IN`` at a time; its size is fixed."""
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c.as_py()), np.uint32).astype(np.uint64) for c in table["counts"])
        total = np.minimum(total, np.uint64(2**32 - 1)).astype(np.uint32)
        return pa.table({"part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int32()), "chunk": table["chunk"].slice(0, 1).combine_chunks(),
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    left = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        parts = parts.groupBy("chunk", (F.col("part") / FAN_IN).cast("int").alias("up")).applyInArrow(add, "part int, chunk int, counts binary")
        left = -(-left // FAN_IN)
    sketch = np.zeros(CELLS, np.uint32)
    for row in parts.select("chunk", "counts").toLocalIterator():
        sketch[row.chunk * CHUNK:(row.chunk + 1) * CHUNK] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return sketch


def _need(num: int, den: int, a: Column, b: Column) -> Column:
    """The least overlap at which sets of these sizes link."""
    return F.ceil((a + b) * num / (num + den))


def postings(docs: DataFrame, words: int, num: int, den: int, sketch) -> DataFrame:
    """The probing prefix of each set, rarest shingles first: ``(token, id, size, pos, ahead)``.

    ``ahead`` marks the shorter indexing prefix, which suffices towards sets
    that are at least as large.
    """
    def run(batches):
        frequency = sketch.value
        for batch in (p for b in batches for p in pieces(b, 1)):
            out = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u = shingles(text, words)
                n = len(u)
                if n == 0 or i is None:
                    continue
                probe = n - -(-num * n // den) + 1
                index = n - -(-2 * num * n // (num + den)) + 1
                count = frequency[(u & np.uint64(CELLS - 1)).astype(np.int64)]
                if probe < n:
                    near = np.flatnonzero(count <= np.partition(count, probe - 1)[probe - 1])
                    u, count = u[near], count[near]
                u = u[np.lexsort((u, count))[:probe]]
                out.append((u.view(np.int64), i, n, index))
            sizes = [len(x[0]) for x in out]
            tokens = np.concatenate([x[0] for x in out]) if out else np.empty(0, np.int64)
            pos = np.concatenate([np.arange(k) for k in sizes]) if out else np.empty(0, np.int64)
            of = lambda k, kind: np.repeat(np.array([x[k] for x in out], kind), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.int64()), pa.array(of(1, np.int64)), pa.array(of(2, np.int32)), pa.array(pos.astype(np.int32)), pa.array(pos < of(3, np.int64))],
                ["token", "id", "size", "pos", "ahead"])

    return docs.mapInArrow(released(run), "token long, id long, size int, pos int, ahead boolean")


def overlaps(docs: DataFrame, pairs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``(a, b)`` to ``(a, b, size_a, size_b, overlap)``, counted on the sets themselves.

    Pairs that can't link by their sets' counts in 256 hash ranges, of which
    the smaller ones bound the overlap, are left out before any set is moved.
    """
    wanted = stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())

    def sets(batches):
        for batch in (p for b in batches for p in pieces(b, 1)):
            found = [shingles(t, words) for t in batch.column(1).to_pylist()]
            ranges = [np.bincount((u >> np.uint64(56)).astype(np.int64), minlength=256).astype(np.uint32).tobytes() for u in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(u) for u in found], pa.int64()), pa.array(ranges, pa.binary()),
                 pa.array([u.tobytes() for u in found], pa.binary())], ["id", "size", "ranges", "set"])

    held = stage(with_ids(docs, "id", wanted).mapInArrow(released(sets), "id long, size long, ranges binary, set binary"))

    def bound(batches):
        for batch in (p for b in batches for p in pieces(b, 4, 5)):
            x, y = (batch.column(k).to_numpy() for k in (2, 3))
            p, q = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, 256) for k in (4, 5))
            most = np.minimum(p, q).sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(most * (num + den) >= (x + y) * num))

    def count(batches):
        for batch in (p for b in batches for p in pieces(b, 2, 3)):
            x, y = ([np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column(k)] for k in (2, 3))
            shared = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *[pa.array(c, pa.int64()) for c in ([len(p) for p in x], [len(q) for q in y], shared)]],
                ["a", "b", "size_a", "size_b", "overlap"])

    def beside(some: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
        """Each pair with these columns of both its sets."""
        of = lambda end: rows.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
        return some.join(of("b"), "b").join(of("a"), "a")

    open_ = stage(beside(pairs.select("a", "b"), held, "size", "ranges").select("a", "b", "size_a", "size_b", "ranges_a", "ranges_b").mapInArrow(
        released(bound), "a long, b long"))
    still = stage(open_.select(F.col("a").alias("id")).union(open_.select("b")).distinct())
    out = stage(beside(open_, with_ids(held, "id", still), "set").select("a", "b", "set_a", "set_b").mapInArrow(
        released(count), "a long, b long, size_a long, size_b long, overlap long"))
    unstage(wanted, held, open_, still)
    return out


def candidate_pairs(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of sets of different components that share a list and may still link.

    ``entries``: ``(token, id, size, pos, ahead, component, shared, hub_size)``
    of the lists that hold several components; ``shared`` is the overlap with
    the list's hub, null where it was not counted.  Returns ``(a, b, linked)``:
    true where the hub's answers prove the link, false where the sets must be
    looked at; pairs that can't link are left out.
    """
    e = entries.withColumn("block", F.floor(F.col("pos") / BLOCK))
    key = ["token", "size", "block"]
    ahead = e.where("ahead")
    blocks = ahead.groupBy(*key).agg(F.min("pos").alias("first"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    left = lambda names: [F.col(n).alias(f"x_{n}") for n in names]
    probe = e.select("token", *[F.col(n).alias(f"y_{n}") for n in ("id", "size", "pos", "component", "shared")])
    need = _need(num, den, F.col("size"), F.col("y_size"))
    # whole blocks: too small, too far down the list, or connected with the prober already
    open_blocks = probe.join(blocks, "token").where(
        (F.col("size") <= F.col("y_size")) & (F.col("size") * den >= F.col("y_size") * num)
        & (F.col("size") - F.col("first") >= need) & (F.col("y_size") - F.col("y_pos") >= need)
        & ~((F.col("c0") == F.col("y_component")) & (F.col("c1") == F.col("y_component")))).drop("first", "c0", "c1")
    members = ahead.select(*key, "hub_size", *left(["id", "pos", "component", "shared"]))
    pairs = open_blocks.join(members, key).where(
        (F.col("x_component") != F.col("y_component")) & (F.col("size") - F.col("x_pos") >= need))
    least = F.col("x_shared") + F.col("y_shared") - F.col("hub_size")
    most = F.least("x_shared", "y_shared") + F.least(F.col("size") - F.col("x_shared"), F.col("y_size") - F.col("y_shared"))
    return (
        pairs.where(most.isNull() | (most >= need))
        .select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"),
                F.coalesce(least >= need, F.lit(False)).alias("linked"))
        .groupBy("a", "b").agg(F.max("linked").alias("linked"))
    )


def jaccard_groups(
    docs: DataFrame,
    words: int = 5,
    threshold: str | float = "0.8",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Connected groups of documents: ``(<id>, n_shingles, component_id)``, one row per input row.

    A document's set holds the distinct runs of ``words`` words, A-Z
    lower-cased, split at ASCII white space; a text of fewer words is one run.
    Two documents link where intersection / union >= ``threshold`` (exact, a
    fraction).  ``component_id`` is the least id reachable by links.

    Documents without words (null, empty, white space) have an empty set and
    link with nothing.  Rows of one id are one document of several texts.  A
    null id links with nothing and has a null component.  Other columns are
    ignored; an empty table gives no rows.  Equal sets are joined by their
    fingerprint (128 bits) first, so copies cost nothing later.
    """
    limit = Fraction(str(threshold))
    num, den = limit.numerator, limit.denominator
    spark = docs.sparkSession
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))

    seen = stage(sets_and_sketch(docs, words))
    sizes = seen.where("size is not null").select("id", "size", "f1", "f2")
    sketch = spark.sparkContext.broadcast(merged_sketch(seen.where("chunk is not null").select("part", "chunk", "counts")))
    full = sizes.where("size > 0 and id is not null")
    first = full.groupBy("size", "f1", "f2").agg(F.min("id").alias("rep"), F.max("id").alias("last")).where("rep < last").drop("last")
    copies = stage(full.join(first, ["size", "f1", "f2"]).select("id", "rep"))
    # An id of several texts stays, as only one of them may be a copy.
    single = full.groupBy("id").agg(F.countDistinct("f1", "f2").alias("texts")).where("texts > 1").select("id")
    away = stage(copies.where("id <> rep").select("id").distinct().join(single, "id", "left_anti"))
    distinct = with_ids(docs, "id", away, "left_anti")

    entries = postings(distinct, words, num, den, sketch)
    lists = entries.groupBy("token").agg(F.count("*").alias("n"), F.min(F.struct("pos", "size", "id")).alias("hub")).where("n > 1")
    shared = stage(entries.join(lists.select("token", "hub"), "token").select("token", "id", "size", "pos", "ahead", "hub"))
    need = _need(num, den, F.col("size"), F.col("hub.size"))
    near = (
        (F.col("id") != F.col("hub.id")) & (F.least("size", "hub.size") * den >= F.greatest("size", "hub.size") * num)
        & (F.col("size") - F.col("pos") >= need) & (F.col("hub.size") - F.col("hub.pos") >= need)
    )
    to_hub = overlaps(distinct, shared.where(near).select(F.col("id").alias("a"), F.col("hub.id").alias("b")).distinct(), words, num, den)
    links_if = lambda df: df.where(F.col("overlap") * (den + num) >= (F.col("size_a") + F.col("size_b")) * num).select("a", "b")
    links = copies.select(F.col("id").alias("a"), F.col("rep").alias("b")).union(links_if(to_hub))
    known = components(links)

    with_component = shared.join(known, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node")
    mixed = with_component.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
    asked = to_hub.select(F.col("a").alias("id"), F.col("b").alias("hub_id"), "overlap")
    open_ = with_component.join(mixed, "token", "left_semi").withColumn("hub_id", F.col("hub.id")).join(asked, ["id", "hub_id"], "left")
    answered = open_.withColumn("shared", F.when(F.col("id") == F.col("hub_id"), F.col("size")).otherwise(F.col("overlap")))
    left = stage(candidate_pairs(answered.withColumn("hub_size", F.col("hub.size")), num, den))
    more = left.where("linked").select("a", "b").union(links_if(overlaps(distinct, left.where("not linked"), words, num, den)))
    groups = known if more.isEmpty() else components(links.union(more))
    unstage(shared, left, away)
    return sizes.join(groups, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def one_per_group(docs: DataFrame, words: int = 5, threshold: str | float = "0.8", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, of each group only the one of least id; see ``jaccard_groups``."""
    groups = jaccard_groups(docs, words, threshold, id_col, text_col)
    gone = stage(groups.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct())
    return with_ids(docs, id_col, gone, "left_anti")
