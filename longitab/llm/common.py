"""What the operators share: words, hashes, graph components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longitab.session import stage, unstage

# Odd 64-bit constants that mix word hashes into window hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word."""
    of = xxhash.xxh3_64_intdigest
    return np.fromiter(map(of, words), dtype=np.uint64, count=len(words))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash per run of ``size`` items; a shorter input is one run, an empty one has none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    last = n - size + 1
    out = np.full(last, np.uint64(size))
    for k in range(size):
        out = (out ^ hashes[k:k + last]) * MIX[0]
        out ^= out >> np.uint64(29)
    out = out * MIX[1]
    return out ^ (out >> np.uint64(32))


def release() -> None:
    """Give a Python worker's unused memory back to the system: workers outlive
    their tasks, and what they keep adds to the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only the GNU library has it
        pass


def released(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, after whose last batch its worker gives memory back."""
    def then_release(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return then_release


#: Rows that Spark hands a Python worker at a time where they are whole texts.  Its default of 10,000
#: suits numbers; both the JVM and the worker hold a batch outside the heap.
BATCH_ROWS = 2000


#: Bytes of rows that Spark hands it at a time where the rows are whole texts; its default of 64 MB is no limit to them.
BATCH_BYTES = 1 << 20

_ROWS_KEY, _BYTES_KEY = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """From now on the session's Python workers get at most ``BATCH_ROWS`` rows and about ``size`` bytes at a time."""
    spark.conf.set(_ROWS_KEY, str(BATCH_ROWS))
    spark.conf.set(_BYTES_KEY, str(size))


@contextmanager
def batch_bytes(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Within it, a job's Python workers get about so many bytes at a time, a larger row alone; then the session is as before."""
    before = spark.conf.get(_BYTES_KEY)
    spark.conf.set(_BYTES_KEY, str(size))
    try:
        yield
    finally:
        spark.conf.set(_BYTES_KEY, before)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, a job's Python workers get at most so many rows at a time; then the session is as before."""
    before = spark.conf.get(_ROWS_KEY)
    spark.conf.set(_ROWS_KEY, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_ROWS_KEY, before)


#: Bytes of texts or sets that a worker unpacks at a time.
PIECE = 1 << 20


def pieces(batch: pa.RecordBatch, *columns: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows that hold about ``PIECE`` bytes in these columns, a longer row alone or with what follows."""
    size = sum(pc.fill_null(pc.binary_length(batch.column(k)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for k in columns)
    for rows in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(np.cumsum(size) // PIECE)) + 1):
        if len(rows):
            yield batch.slice(int(rows[0]), len(rows))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: one row ``(node, component)`` per node that has an
    edge, ``component`` being the smallest node of its component.

    Each round takes the least label among the neighbours and then jumps to the
    label's own label, so that chains shrink by halves.  Labels are written
    after each round; only the number of changed labels comes to the driver.
    Null ends and self loops link nothing.  No edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    both = stage(pairs.union(pairs.select("y", "x")).distinct())
    labels = stage(both.groupBy(F.col("x").alias("node")).agg(F.least("node", F.min("y")).alias("component")))
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy(F.col("x").alias("at")).agg(F.min("component").alias("near"))
        hooked = labels.join(near, F.col("node") == F.col("at"), "left").select(
            "node", "component", F.least("component", F.coalesce("near", "component")).alias("hooked"))
        target = labels.select(F.col("node").alias("root"), F.col("component").alias("up"))
        after = stage(hooked.join(target, F.col("hooked") == F.col("root"), "left").select(
            "node", F.least("hooked", F.coalesce("up", "hooked")).alias("component"), F.col("component").alias("before")))
        done = after.where("component <> before").isEmpty()
        unstage(labels)
        labels = after
        if done:
            unstage(both)
            return labels.select("node", "component")


#: Ids that a join may send to every executor: 16 MB. Above, it is shuffled.
BROADCAST_IDS = 1_000_000


def with_ids(rows: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``column`` is (``left_anti``: is not) among the one column of
    distinct ``ids``, without shuffling the rows where the ids are few."""
    ids = ids.toDF("_id")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, rows[column] == F.col("_id"), how)


#: Parts that the shards of an all-pairs search are read in, where its blocks alone are enough tasks.  What the
#: parts find meets by block, so its amount grows with them.
PARTS = 16


def every_pair(shards: DataFrame, blocks: DataFrame, n_blocks: int, on: str) -> DataFrame:
    """Each of the staged ``shards`` with each of about ``n_blocks`` staged ``blocks`` alike in ``on``.

    A task reads a part of the shards one by one and holds a few blocks, whose
    rows follow each other for a shard.  Nothing is shuffled or broadcast: rows
    of packed bytes look small by the size of their files, and one side, copied
    for the other, would be collected on the driver.
    """
    cores = shards.sparkSession.sparkContext.defaultParallelism
    return shards.coalesce(max(PARTS, -(-3 * cores // max(1, n_blocks)))).join(blocks.hint("shuffle_replicate_nl"), on)
