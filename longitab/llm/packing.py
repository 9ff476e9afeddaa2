"""Packing documents into sequences of one length by minimum bin slack.

What is left of a document after its whole windows is a remainder shorter than
a window.  Each partition collects remainders up to a bounded number of tokens
and fills windows from the histogram of their lengths: the longest remainder
first, then the multiset of others whose sum comes closest to the room left,
found by a subset-sum over a bitset and traced back to counts.  The same
choice is repeated as often as its counts allow.  Room that no multiset fills
takes the front of one more remainder, whose rest goes on as a remainder.

Nothing is shuffled: a partition's sequences hold its own documents, numbered
from the partition's number on, so that a lost task makes the same ones again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bytebpe import Encoder
from .records import blocks

#: Tokens of remainders that a partition collects before it fills windows.
COLLECTED = 4 << 20
#: Of these so many stay for the next time, so that there is always choice.
KEPT = 1 << 19
#: Sequences of a partition have numbers from its own times this.
NUMBERS = 1 << 40
#: Sequences given on at a time.
ROWS = 1024


def closest(counts: dict[int, int], lengths: list[int], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to ``room`` of lengths, each at most so often as ``counts`` says, and how often each is in it.

    Bit s of the bitset says that sum s can be made.  Each step offers a power
    of two of one length, so that all its counts can be made up of steps;
    going back over the steps tells which were taken.  ``lengths`` descend.
    """
    whole = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room or not counts.get(length):
            continue
        left, some = min(counts[length], room // length), 1
        while left and not reach >> room:
            take = min(some, left)
            steps.append((length, take, reach))
            reach |= reach << take * length & whole
            left, some = left - take, some * 2
        if reach >> room:
            break
    best = at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= take * length
    return best, chosen


def windows(counts: dict[int, int], size: int, keep: int = 0) -> Iterator[tuple[int, dict[int, int], tuple[int, int] | None]]:
    """How to fill windows of ``size`` from so many remainders of each length below it.

    Yields ``(times, counts of whole remainders, (length, front) of the one that
    is cut)`` while more than ``keep`` tokens and at least a window's are left;
    each choice fills its window.  ``counts`` is used up, what is left of it is
    what is left.
    """
    total = sum(k * n for k, n in counts.items())
    lengths = sorted((k for k, n in counts.items() if n), reverse=True)
    while total >= size and total > keep:
        top = lengths[0]
        counts[top] -= 1
        best, need = closest(counts, lengths, size - top)
        counts[top] += 1
        need[top] = need.get(top, 0) + 1
        cut = None
        slack = size - top - best
        if slack:  # what is left apart from those chosen is longer than the slack, else it would be in
            cut = (next(k for k in lengths if counts[k] > need.get(k, 0)), slack)
        used = dict(need)
        if cut:
            used[cut[0]] = used.get(cut[0], 0) + 1
        times = min(counts[k] // n for k, n in used.items())
        yield times, need, cut
        for k, n in used.items():
            counts[k] -= times * n
        if cut:
            rest = cut[0] - slack
            counts[rest] = counts.get(rest, 0) + times
            if rest not in lengths:
                lengths.append(rest)
                lengths.sort(reverse=True)
        total -= times * size
        lengths = [k for k in lengths if counts[k]]


class Pool:
    """Remainders that wait for a window: ``(number of the document, start, ids)``, by length."""

    def __init__(self, size: int):
        self.size, self.tokens = size, 0
        self.by_length: dict[int, deque] = {}

    def add(self, doc: int, start: int, ids: np.ndarray) -> None:
        self.by_length.setdefault(len(ids), deque()).append((doc, start, ids))
        self.tokens += len(ids)

    def fill(self, keep: int) -> Iterator[list]:
        """The pieces of one full window after another."""
        counts = {k: len(q) for k, q in self.by_length.items()}
        for times, need, cut in windows(counts, self.size, keep):
            for _ in range(times):
                pieces = [self.by_length[k].popleft() for k, n in need.items() for _ in range(n)]
                self.tokens -= self.size
                if cut:
                    doc, start, ids = self.by_length[cut[0]].popleft()
                    pieces.append((doc, start, ids[:cut[1]]))
                    self.by_length.setdefault(cut[0] - cut[1], deque()).append((doc, start + cut[1], ids[cut[1]:]))
                yield pieces

    def last(self) -> Iterator[list]:
        """What is left, less than a window, in sequences whose lengths are powers of two."""
        left = [piece for k in sorted(self.by_length, reverse=True) for piece in self.by_length[k]][::-1]
        while self.tokens:
            room = 1 << self.tokens.bit_length() - 1
            self.tokens -= room
            pieces = []
            while room:
                doc, start, ids = left.pop()
                pieces.append((doc, start, ids[:room]))
                if len(ids) > room:
                    left.append((doc, start + room, ids[room:]))
                room -= len(pieces[-1][2])
            yield pieces
        self.by_length.clear()


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def pack(docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as sequences of ``size`` tokens without padding.

    A document's tokens are the ids of its whole text and ``end_id``; each
    stands in exactly one piece.  Returns one row per sequence::

        sequence_id  long, unique
        n_tokens     long, ``size``, or at the end of a partition a power of two below
        ids          binary, the ids as little-endian unsigned 32-bit integers
        pieces       array of (<id>, start, length, offset, doc_tokens): whose ids stand
                     where, in the order of ``offset``; ``start`` counts the document's ids before

    Less than ``size`` tokens are left at the end of a partition.  They become
    sequences whose lengths are powers of two, at most one of each, so no
    sequence has padding.

    A null text is empty and gives the end id alone.  Rows of one id, or
    without an id, are documents of their own.  Other columns are ignored; an
    empty table gives no rows.
    """
    if size < 1:
        raise ValueError("a sequence has at least one token")
    # named by place: the id's own name may be one of the others
    kind = docs.schema[id_col].dataType
    schema = (f"sequence_id long, n_tokens long, ids binary, pieces array<struct<doc:{kind.simpleString()},"
              "start:long,length:long,offset:long,doc_tokens:long>>")
    id_type = to_arrow_type(kind)

    def run(batches):
        of, pool, docs_at, number = encoder(vocabulary), Pool(size), {}, TaskContext.get().partitionId() * NUMBERS
        waiting: list[list] = []
        seen = 0

        def emit():
            nonlocal number
            flat = [p for pieces in waiting for p in pieces]
            lengths = np.fromiter((len(p[2]) for p in flat), np.int64, len(flat))
            per = np.fromiter(map(len, waiting), np.int64, len(waiting))
            ends = np.append(0, np.cumsum(per))
            upto = np.append(0, np.cumsum(lengths))
            first = upto[ends[:-1]]
            struct = pa.StructArray.from_arrays(
                [pa.array([docs_at[p[0]][0] for p in flat], id_type), pa.array([p[1] for p in flat], pa.int64()), pa.array(lengths),
                 pa.array(upto[:-1] - np.repeat(first, per)), pa.array([docs_at[p[0]][1] for p in flat], pa.int64())],
                ["doc", "start", "length", "offset", "doc_tokens"])
            ids = [np.concatenate([p[2] for p in pieces]).astype("<u4").tobytes() for pieces in waiting]
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(waiting))), pa.array(upto[ends[1:]] - first),
                 pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)],
                ["sequence_id", "n_tokens", "ids", "pieces"])
            number += len(waiting)
            waiting.clear()
            return out

        def given(windows):
            for pieces in windows:
                waiting.append(pieces)
                if len(waiting) == ROWS:
                    yield emit()
            if waiting:
                yield emit()

        def whole(texts, names):
            nonlocal seen
            flat, sizes = of.encode(texts)
            at = 0
            for name, n in zip(names, sizes.tolist()):
                ids = np.append(flat[at:at + n], np.uint32(end_id))
                docs_at[seen] = (name, n + 1)
                for start in range(0, n + 2 - size, size):
                    yield [(seen, start, ids[start:start + size])]
                if rest := (n + 1) % size:
                    pool.add(seen, n + 1 - rest, ids[n + 1 - rest:].copy())
                seen, at = seen + 1, at + n

        for batch in batches:
            for start, n in blocks(batch.column(1)):
                yield from given(whole(batch.column(1).slice(start, n).to_pylist(), batch.column(0).slice(start, n).to_pylist()))
                if pool.tokens > COLLECTED:
                    yield from given(pool.fill(KEPT))
                held = {p[0] for q in pool.by_length.values() for p in q}
                for k in [k for k in docs_at if k not in held]:
                    del docs_at[k]
        yield from given(pool.fill(0))
        yield from given(pool.last())

    rows = docs.select(docs[id_col].alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    named = f"array<struct<`{id_col}`:{kind.simpleString()},start:long,length:long,offset:long,doc_tokens:long>>"
    return rows.mapInArrow(run, schema).withColumn("pieces", F.col("pieces").cast(named))


def pieces_of(sequences: DataFrame) -> DataFrame:
    """One row per piece of ``pack``: ``(<the piece's fields>, sequence_id, ids)``, ``ids`` being the piece's own."""
    one = sequences.select("sequence_id", F.col("ids").alias("all"), F.explode("pieces").alias("piece"))
    own = F.expr("substring(all, cast(piece.offset * 4 + 1 as int), cast(piece.length * 4 as int))")
    return one.select("piece.*", "sequence_id", own.alias("ids"))
