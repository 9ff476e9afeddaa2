"""Hard negatives of anchors by bounds along a spanning tree of the anchors.

Scores are inner products.  If a parent anchor's score with a candidate x is
known to lie in [lo, hi], then by Cauchy and Schwarz that of a child at
distance d lies in [lo - d |x|, hi + d |x|].  The anchors of a block form a
minimum spanning tree; along it, an anchor's exact score is taken only of the
candidates whose bounds overlap the window of scores asked for.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longitab.session import stage, unstage

from .common import every_pair

#: Candidates of a shard and anchors of a block: bounds of a block over a shard are two matrices of these sizes.
SHARD, BLOCK = 4096, 256
#: Whole numbers of doubles below are exact.
EXACT = float(1 << 53)


def tree(x: np.ndarray) -> list[tuple[int, int, float]]:
    """A minimum spanning tree over the rows: ``(row, parent, distance)``, parents first, the root its own parent."""
    def to(i):
        d = x.astype(np.float64) - x[i].astype(np.float64)
        return np.sqrt((d * d).sum(axis=1))
    out, near, parent = [(0, 0, 0.0)], to(0), np.zeros(len(x), np.int64)
    todo = np.ones(len(x), bool)
    todo[0] = False
    for _ in range(len(x) - 1):
        k = int(np.argmin(np.where(todo, near, np.inf)))
        out.append((k, int(parent[k]), float(near[k])))
        todo[k] = False
        d = to(k)
        closer = todo & (d < near)
        near[closer], parent[closer] = d[closer], k
    return out


class Shard:
    """Candidates in memory and their exact scores."""

    def __init__(self, packed: tuple):
        self.ids, self.labels, self.x = packed
        real = self.x.astype(np.float64)
        self.norms = np.sqrt((real * real).sum(axis=1))
        self.real = real

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        size = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if size * (self.norms.max() if len(self.norms) else 0.0) < EXACT:
            return (self.real[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ anchor  # whole numbers modulo 2**64, so exact where the result fits


class Bounds:
    """What is known of the scores of one block's anchors with one shard's candidates.

    ``widened`` and ``rescored`` go along the tree, parents first.
    """

    def __init__(self, shard: Shard, anchors: np.ndarray):
        self.shard, self.anchors, self.n = shard, anchors, len(shard.ids)
        self.lo = np.empty((len(anchors), self.n))
        self.hi = np.empty((len(anchors), self.n))
        self.compared = 0

    def widened(self, row: int, parent: int, distance: float) -> None:
        """Bounds of an anchor from its parent's; the root's from nothing."""
        if row == parent:
            self.lo[row], self.hi[row] = -np.inf, np.inf
            return
        # a little wider, for what doubles round off
        more = self.shard.norms * (distance * (1 + 1e-9)) + 1
        lo, hi = self.lo[parent], self.hi[parent]
        self.lo[row] = lo - more - 1e-9 * np.where(np.isfinite(lo), np.abs(lo), 0)
        self.hi[row] = hi + more + 1e-9 * np.where(np.isfinite(hi), np.abs(hi), 0)

    def rescored(self, row: int, rows: np.ndarray) -> np.ndarray:
        scores = self.shard.scores(self.anchors[row], rows)
        self.lo[row, rows] = self.hi[row, rows] = scores
        self.compared += len(rows)
        return scores


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, highest first."""
    if len(scores) > 4 * k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _same(labels: np.ndarray, of_anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides' labels as numbers."""
    _, codes = np.unique(np.concatenate([labels, of_anchors]), return_inverse=True)
    return codes[:len(labels)], codes[len(labels):]


def positives(shard: Shard, block: tuple, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per anchor the shard's ``k`` best other rows of its label: ``(anchor, ids, scores)``."""
    ids, labels, x, edges = block
    mine, theirs = _same(shard.labels, labels)
    bounds = Bounds(shard, x)
    for row, parent, distance in edges:
        bounds.widened(row, parent, distance)
        some = np.flatnonzero((mine == theirs[row]) & (shard.ids != ids[row]))
        if len(some) > k:  # k candidates reach the k-th largest lower bound
            some = some[bounds.hi[row, some] >= np.partition(bounds.lo[row, some], len(some) - k)[len(some) - k]]
        scores = bounds.rescored(row, some)
        best = first(scores, shard.ids[some], k)
        yield row, shard.ids[some[best]], scores[best]


def negatives(shard: Shard, block: tuple, asked: dict, k: int, low: int, high: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per anchor and window the shard's ``k`` best rows of other labels in it: ``(anchor, place, ids, scores)``.

    ``asked`` has for each anchor its windows, ``(place, positive score)``.
    """
    ids, labels, x, edges = block
    mine, theirs = _same(shard.labels, labels)
    bounds = Bounds(shard, x)
    for row, parent, distance in edges:
        bounds.widened(row, parent, distance)
        # least and largest whole score s with low * score <= 100 * s <= high * score
        windows = [(at, -(-low * score // 100), high * score // 100) for at, score in asked.get(row, ())]
        over = np.zeros(bounds.n, bool)
        for _, least, most in windows:
            if least <= most:
                over |= (bounds.hi[row] >= least) & (bounds.lo[row] <= most)
        some = np.flatnonzero(over & (mine != theirs[row]) & (shard.ids != ids[row]))
        scores = bounds.rescored(row, some)
        for at, least, most in windows:
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            if len(inside):
                best = inside[first(scores[inside], shard.ids[some[inside]], k)]
                yield row, at, shard.ids[some[best]], scores[best]


class Best:
    """Of what is added, the ``k`` highest scores of each key, ties by smaller id."""

    def __init__(self, k: int):
        self.k, self.parts, self.new, self.old = k, [], 0, 0

    def add(self, keys: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((keys, ids, scores))
        self.new += len(ids)
        if self.new > 10_000 + self.old:
            self.kept()

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.empty(0, np.int64),) * 3
        keys, ids, scores = (np.concatenate(c) for c in zip(*self.parts))
        by = np.lexsort((ids, -scores, keys))
        by = by[np.arange(len(by)) - np.searchsorted(keys[by], keys[by]) < self.k]
        self.parts, self.new, self.old = [(keys[by], ids[by], scores[by])], 0, len(by)
        return self.parts[0]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Shard, pa.Scalar, pa.Scalar | None]]:
    """``(block and dim, shard, anchors, windows)`` of each pair; a shard is unpacked once for the blocks that follow each other."""
    at, shard = None, None
    for batch in batches:
        ids = zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "dim")))
        windows = batch.column("windows") if "windows" in batch.schema.names else [None] * batch.num_rows
        for (n, block, dim), rows, anchors, asked in zip(ids, batch.column("rows"), batch.column("anchors"), windows):
            if at != (n, dim):
                at, shard = (n, dim), Shard(pickle.loads(rows.as_py()))
            yield (block, dim), shard, anchors, asked


def whole(vector: Column, scale: int) -> Column:
    """Each component times ``scale``, rounded down, as a long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, label, v, dim)`` of the rows that take part."""
    v = F.col("v")
    # a null component makes the aggregate null, which no comparison passes
    size = F.aggregate(v, F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") * scale, F.lit(2)))
    named = rows.select(rows[id_col].cast("long").alias("id"), rows[label_col].cast("string").alias("label"), rows[vector_col].alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    good = named.where("id is not null and label is not null and v is not null").where(finite)
    # a score fits 63 bits if two norms' product does
    fits = F.when(size < float(1 << 62), whole(v, scale)).otherwise(
        F.raise_error(F.lit("vectors are too long: scaled norms must stay below 2^31")).cast("array<bigint>"))
    return good.select("id", "label", fits.alias("v"), F.size("v").alias("dim"))


def _packed(rows: DataFrame, per: int, name: str, with_tree: bool) -> DataFrame:
    """Deal rows evenly into blocks of about ``per`` and pack each block by dimension: ``(<name>, dim, data)``."""
    from pyspark import TaskContext
    n = max(1, -(-rows.count() // per))

    def run(batches):
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        t = pa.Table.from_batches(kept).combine_chunks()
        for dim in np.unique(t["dim"].to_numpy()):
            some = t.filter(pa.compute.equal(t["dim"], int(dim))).combine_chunks()
            v = some["v"].combine_chunks()
            x = (v.flatten() if isinstance(v, pa.ListArray) else v.chunk(0).flatten()).to_numpy(zero_copy_only=False).reshape(some.num_rows, dim)
            data = (some["id"].to_numpy(), np.array(some["label"].to_pylist(), dtype=object), x)
            if with_tree:
                data += (tree(x),)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([dim], pa.int32()), pa.array([pickle.dumps(data, 5)], pa.binary())],
                [name, "dim", "data"])

    return rows.repartition(n).mapInArrow(run, f"{name} int, dim int, data binary")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    n_positives: int = 5,
    n_negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per anchor and positive the best rows of other labels that score nearly as high as the positive.

    Components are multiplied by ``scale`` and rounded down; a row's score is
    its inner product with the anchor, a whole number.  An anchor's positives
    are its ``n_positives`` best other rows of its label.  Of the rows of other
    labels that satisfy ``low * positive_score <= 100 * negative_score <= high
    * positive_score``, each positive gets the ``n_negatives`` best.  Higher
    scores come first, ties by smaller id.  Positives without such rows have no
    row in the result::

        anchor_id, positive_id, rank, negative_id, positive_score, negative_score

    Rows with a null id, label or vector, or a null or non-finite component
    take no part.  Vectors of different lengths do not meet; one without
    components scores 0.  A row is not found by an anchor of its own id.
    Repeated anchor rows count once, anchors alike in id only are mined each;
    other repeated rows are found each.  Labels are compared as text.  Empty
    tables give no rows.  Vectors whose scaled norm is 2^31 or more raise, as
    their scores would not fit a long.
    """
    if not 0 <= low <= high:
        raise ValueError("the window's ends must ascend from 0")
    parts = (id_col, label_col, vector_col, scale)
    shards = stage(_packed(usable(rows, *parts), SHARD, "shard", False))
    asked = stage(usable(anchors, *parts).dropDuplicates(["id", "label", "v"]))
    blocks = stage(_packed(asked, BLOCK, "block", True).withColumnRenamed("data", "anchors"))
    unstage(asked)
    candidates, n_blocks = shards.withColumnRenamed("data", "rows"), blocks.count()

    def find_positives(batches):
        packed, best = {}, {}
        for at, shard, anchors_, _ in _pairs(batches):
            if at not in packed:
                packed[at], best[at] = pickle.loads(anchors_.as_py()), Best(n_positives)
            for row, ids, scores in positives(shard, packed[at], n_positives):
                best[at].add(np.full(len(ids), row), ids, scores)
        for (block, dim), some in best.items():
            rows_, ids, scores = some.kept()
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(block, pa.int32()), len(ids)), pa.repeat(pa.scalar(dim, pa.int32()), len(ids)), pa.array(rows_.astype(np.int32)),
                 pa.array(packed[block, dim][0][rows_]), pa.array(ids), pa.array(scores)],
                ["block", "dim", "anchor", "anchor_id", "id", "score"])

    best = stage(_ranked(
        every_pair(candidates, blocks, n_blocks, "dim").mapInArrow(
            find_positives, "block int, dim int, anchor int, anchor_id long, id long, score long"),
        ["block", "dim", "anchor"], n_positives))
    # of one block at most its anchors times n_positives
    windows = best.groupBy("block", "dim").agg(F.collect_list(F.struct("anchor", "rank", "score")).alias("windows"))
    wanted = stage(blocks.join(windows.hint("merge"), ["block", "dim"]).repartition(max(1, n_blocks), "block"))

    def find_negatives(batches):
        packed, given, best = {}, {}, {}
        for at, shard, anchors_, windows_ in _pairs(batches):
            if at not in packed:
                packed[at], given[at], best[at] = pickle.loads(anchors_.as_py()), {}, Best(n_negatives)
                for w in windows_.as_py():
                    given[at].setdefault(w["anchor"], []).append((w["rank"], w["score"]))
            for row, place, ids, scores in negatives(shard, packed[at], given[at], n_negatives, low, high):
                best[at].add(np.full(len(ids), row * (n_positives + 1) + place), ids, scores)
        for (block, dim), some in best.items():
            keys, ids, scores = some.kept()
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(block, pa.int32()), len(ids)), pa.repeat(pa.scalar(dim, pa.int32()), len(ids)),
                 *[pa.array(c.astype(np.int32)) for c in np.divmod(keys, n_positives + 1)], pa.array(ids), pa.array(scores)],
                ["block", "dim", "anchor", "place", "id", "score"])

    hard = _ranked(
        every_pair(candidates, wanted, n_blocks, "dim").mapInArrow(
            find_negatives, "block int, dim int, anchor int, place int, id long, score long"),
        ["block", "dim", "anchor", "place"], n_negatives)
    of = best.select("block", "dim", "anchor", F.col("rank").alias("place"), "anchor_id", F.col("id").alias("positive_id"),
                     F.col("score").alias("positive_score"))
    return hard.join(of.hint("merge"), ["block", "dim", "anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
