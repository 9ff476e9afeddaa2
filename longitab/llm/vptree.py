"""Largest inner products by vantage-point trees, one per shard.

Inner products become distances: with M the largest norm of a shard, a vector x
gets one more component sqrt(M^2 - |x|^2) and a query q gets 0, so that
|q - x|^2 = |q|^2 + M^2 - 2 q.x, which orders candidates as q.x does.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longitab.session import stage, unstage

from .common import every_pair

#: Vectors of a shard, of a leaf, and queries of a block.
SHARD, LEAF, QUERIES = 8192, 512, 1024


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products in double precision, added component by component from the first."""
    out = np.zeros((len(q), len(x)))
    for j in range(q.shape[1]):
        out += q[:, j, None] * x[None, :, j]
    return out


def product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The same of each row with its own."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def build(ids: np.ndarray, x: np.ndarray) -> dict:
    """A tree over the rows of ``x``: nodes split at the median distance to a vantage point."""
    norms = (x.astype(np.float64) ** 2).sum(axis=1)
    top = norms.max()
    lifted = np.concatenate([x.astype(np.float64), np.sqrt(np.maximum(top - norms, 0))[:, None]], axis=1)
    order, nodes = np.arange(len(x)), []

    def split(lo: int, hi: int) -> int:
        at = len(nodes)
        nodes.append(None)
        some = order[lo:hi]
        if hi - lo > LEAF:
            vantage = some[0]
            d = np.sqrt(((lifted[some] - lifted[vantage]) ** 2).sum(axis=1))
            by = np.argsort(d, kind="stable")
            mid = int(np.searchsorted(d[by], np.median(d), "right"))
            if mid < hi - lo:
                order[lo:hi] = some[by]
                # the largest distance inside and the least outside
                rim = (d[by[mid - 1]], d[by[mid]])
                nodes[at] = (vantage, rim, split(lo, lo + mid), split(lo + mid, hi))
                return at
        nodes[at] = (lo, hi)
        return at

    split(0, len(x))
    return {"ids": ids, "x": x, "top": top, "order": order, "nodes": nodes}


class Search:
    """The best ``k`` of one tree, or of several in turn, for a block of queries."""

    def __init__(self, tree: dict, qids: np.ndarray, q: np.ndarray, k: int, factor: float):
        self.qids, self.q, self.k, self.factor = qids, q.astype(np.float64), k, factor
        self.turn(tree)
        self.best = np.full((len(q), k), -np.inf)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)

    def turn(self, tree: dict) -> Search:
        """From now on search this tree, for what is better than the best so far."""
        size = (self.q ** 2).sum(axis=1)
        self.tree, self.base = tree, size + tree["top"]
        # twice what two orders of adding up a product can differ by
        self.slack = 4 * self.q.shape[1] * np.finfo(np.float64).eps * np.sqrt(size * tree["top"]) + 1e-300
        return self

    def offer(self, act: np.ndarray, rows: np.ndarray) -> None:
        ids, x = self.tree["ids"][rows], self.tree["x"][rows].astype(np.float64)
        q, least = self.q[act], self.best[act, -1]
        # a matrix product is fast but rounds in its own order: it only tells which pairs to add up
        near = ~(q @ x.T < (least - self.slack[act])[:, None])
        r, c = np.nonzero(near)
        score = products(q, x)[r, c] if len(r) > near.size // 8 else product(q[r], x[c])
        open_ = (score >= least[r]) & (ids[c] != self.qids[act][r])
        r, c, score = r[open_], c[open_], score[open_]
        if not len(r):
            return
        touched = np.unique(r)
        row = np.concatenate([r, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.best[act[touched]].ravel()])
        cand = np.concatenate([ids[c], self.found[act[touched]].ravel()])
        by = np.lexsort((cand, -score, row))
        row, score, cand = row[by], score[by], cand[by]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        at = (act[row[keep]], rank[keep])
        self.best[at], self.found[at] = score[keep], cand[keep]

    def radius(self, act: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far."""
        with np.errstate(invalid="ignore"):
            return np.sqrt(np.maximum(self.base[act] - 2 * self.best[act, -1], 0))

    def visit(self, node: int, act: np.ndarray) -> None:
        entry = self.tree["nodes"][node]
        if len(entry) == 2:
            self.offer(act, self.tree["order"][entry[0]:entry[1]])
            return
        vantage, (inner, outer), inside, outside = entry
        d = np.sqrt(np.maximum(self.base[act] - 2 * (self.q[act] @ self.tree["x"][vantage].astype(np.float64)), 0))
        near = d <= (inner + outer) / 2
        for first, second, some, gap in ((inside, outside, near, outer - d), (outside, inside, ~near, d - inner)):
            if some.any():
                self.visit(first, act[some])
                # by the triangle inequality the other side is at least gap away
                on = act[some][gap[some] * self.factor <= self.radius(act[some]) + 1e-9]
                if len(on):
                    self.visit(second, on)

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.visit(0, np.arange(len(self.q)))
        r, c = np.nonzero(self.best > -np.inf)
        return self.qids[r], self.found[r, c], self.best[r, c]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v, dim)`` of the vectors that take part: no null, no component null or not finite, not zero."""
    v = F.col("v")
    # a null component makes the aggregate null, which no comparison passes
    size = F.aggregate(v, F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    return vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v")).withColumn("size", size).where(
        "id is not null and v is not null and size(v) > 0 and size > 0 and not isnan(size) and size < double('infinity')").select(
        "id", "v", F.size("v").alias("dim"))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _packed(rows: DataFrame, per: int, make) -> DataFrame:
    """Deal rows evenly into blocks of about ``per`` and pack each block by dimension: ``(block, dim, data)``."""
    n = max(1, -(-rows.count() // per))

    def run(batches):
        kept = [b for b in batches if b.num_rows]
        if kept:
            t = pa.Table.from_batches(kept)
            for dim in np.unique(t["dim"].to_numpy()):
                some = t.filter(pa.compute.equal(t["dim"], int(dim))).combine_chunks()
                data = make(some["id"].to_numpy(), _matrix(some["v"].combine_chunks() if isinstance(some["v"], pa.ChunkedArray) else some["v"], int(dim)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([dim], pa.int32()), pa.array([pickle.dumps(data, 5)], pa.binary())],
                    ["block", "dim", "data"])

    return rows.repartition(n).mapInArrow(run, "block int, dim int, data binary")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    factor: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Each query's ``k`` vectors of largest inner product: ``(query_id, rank, vec_id, score)``.

    Every vector is indexed: dealt evenly to shards of about ``SHARD`` rows, of
    which each builds a tree.  Blocks of queries meet every shard; a subtree is
    skipped where ``factor`` times its distance by the triangle inequality
    exceeds the k-th best that the task has found.  1 gives the exact result,
    more skips more.  Ties go to the smaller id.  A row is not found by a query of
    its own id.

    Vectors that are null, zero, or hold a null or non-finite component take no
    part, neither do rows with a null id.  Vectors of different lengths do not
    meet.  Repeated query rows count once; repeated candidate rows are found
    each.  Fewer than k candidates are all returned; none give no rows.
    """
    index = stage(_packed(usable(vectors, id_col, vector_col), SHARD, build))
    asked = stage(usable(queries, id_col, vector_col).dropDuplicates(["id", "v"]))
    blocks = stage(_packed(asked, QUERIES, lambda ids, q: (ids, q)))
    unstage(asked)
    shards = index.select(F.col("block").alias("shard"), "dim", F.col("data").alias("tree"))
    pairs = every_pair(shards, blocks, blocks.count(), "dim").select("shard", "dim", "tree", "block", "data")

    def search(batches):
        at, tree, searches, found = None, None, {}, {}
        for batch in batches:
            for shard, dim, packed, block, data in zip(*(c if c.type == pa.binary() else c.to_pylist() for c in batch.columns)):
                if at != (shard, dim):
                    at, tree = (shard, dim), pickle.loads(packed.as_py())
                if (block, dim) in searches:
                    searches[block, dim].turn(tree)
                else:
                    searches[block, dim] = Search(tree, *pickle.loads(data.as_py()), k, factor)
                found[block, dim] = searches[block, dim].run()
        for columns in found.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
