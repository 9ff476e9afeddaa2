"""Token ids in length-delimited binary records with masked checksums.

One file holds records one after another::

    8 bytes   length of the payload, little-endian
    4 bytes   masked checksum of these 8 bytes
    payload   8 bytes document id (signed, little-endian), 1 byte width (plus
              128 where there is no id), then the token ids, width bytes each
              (2 if all are below 65536, else 4), unsigned, little-endian
    4 bytes   masked checksum of the payload
    1 byte    10

A checksum is CRC-32; it is stored rotated right by 15 bits plus a constant, so
that the checksum of data that hold checksums stays sound.  The offset index is
a parquet table beside the files: shard, position, document, byte offset, byte
length and number of ids, which is what a shuffled reader seeks by.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from longitab.session import fresh_path

from .common import BATCH_ROWS, batch_bytes, batches_of, release, released

#: Fixed value: added to a rotated checksum.
MASK_DELTA = 0xA282EAD8
HEADER = struct.Struct("<QI")
END = b"\n"
#: The vocabulary's special strings, which are matched before anything else.
SPECIAL = "<|"
#: Words kept by a task; a full table is emptied and filled anew.
CACHED_WORDS = 150_000
#: Bytes of text that are encoded at a time.
BLOCK = 1 << 20
#: Words given to the tokenizer at a time.
LINE = 2000
#: Fixed value: ASCII marks, a run of which after a word is a word of its own.
MARKS = string.punctuation
#: Added to the width of a record without a document id.
NO_ID = 0x80
#: Letters up to it are composed already and have small forms of one letter.
LATIN_LAST = "\u024f"
#: Fixed value: the one of them whose small form is of two signs.
DOTTED = "\u0130"
#: The signs that stand for the bytes 128 to 255 in a byte-level vocabulary, and letters as such signs.
SIGNS = {b: chr(b if 0xA1 <= b <= 0xAC or b >= 0xAE else 0x100 + 33 + (b - 0x7F if b < 0xA1 else 34)) for b in range(0x80, 0x100)}
AS_BYTES = {c: "".join(SIGNS[b] for b in chr(c).encode()) for c in range(0x80, ord(LATIN_LAST) + 1)}


def masked(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record; ``doc_id`` may be null."""
    width = 4 if len(ids) and ids.max() > 0xFFFF else 2
    payload = struct.pack("<qB", doc_id or 0, width | (NO_ID if doc_id is None else 0)) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)), END))


def frames(data: bytes | memoryview) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """``(offset, bytes, document id, ids)`` of each record; a wrong checksum raises."""
    at = 0
    while at < len(data):
        length, check = HEADER.unpack_from(data, at)
        if masked(data[at:at + 8]) != check:
            raise ValueError(f"length checksum differs at byte {at}")
        start = at + HEADER.size
        payload = data[start:start + length]
        if masked(payload) != struct.unpack_from("<I", data, start + length)[0]:
            raise ValueError(f"payload checksum differs at byte {at}")
        doc_id, width = struct.unpack_from("<qB", payload)
        size = HEADER.size + length + 4 + len(END)
        yield at, size, None if width & NO_ID else doc_id, np.frombuffer(payload, f"<u{width & ~NO_ID}", offset=9).astype("<u4")
        at += size


def _gather(flat: np.ndarray, at: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that begin and end at ``at[entries]`` and the place after, one after another,
    and where each one begins and the last one ends."""
    sizes = at[entries + 1] - at[entries]
    places = np.append(0, np.cumsum(sizes))
    return flat[np.repeat(at[entries] - places[:-1], sizes) + np.arange(places[-1])], places


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """Loaded once a worker: its model remembers words, and what it remembers is not freed with it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Token ids of whole texts.

    The vocabulary drops white space and never joins across it, so a text's ids
    are those of its words one after another.  Each distinct word of a batch is
    looked up once, its stem apart from closing marks; what is new is encoded.
    A text that may hold a special string goes through the tokenizer whole.
    The ids of known words are one flat array.
    """

    def __init__(self, path: str):
        self.whole = _tokenizer(path)
        self.model = self.whole.model
        self.plain = self._as_written()
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.flat, self.at = np.empty(0, np.uint32), np.zeros(2, np.int64)

    def _add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Words whose ids stand one after another, and where each one's end."""
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.at = np.append(self.at, self.at[-1] + ends)
        self.flat = np.concatenate([self.flat, ids])

    def _as_written(self) -> bool:
        """Whether the model alone gives the ids of simple words: else all go through the tokenizer."""
        letters = [c for c in map(chr, range(ord(LATIN_LAST) + 1)) if c.isalpha() and c.lower() == c and c != DOTTED]
        words = ["".join(letters), "".join(letters[::-1]), *letters, string.ascii_lowercase, string.ascii_lowercase[::-1]]
        ids = self.whole.encode(" ".join(words), add_special_tokens=False).ids
        return ids == [t.id for w in words for t in self.model.tokenize(w.translate(AS_BYTES))]

    def _learn_simple(self, words: list[str]) -> None:
        """There is nothing to normalise or split."""
        tokenize = self.model.tokenize
        ids = [[t.id for t in tokenize(w if w.isascii() else w.translate(AS_BYTES))] for w in words]
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        self._add(words, np.fromiter(chain.from_iterable(ids), np.uint32), ends)

    def _learn(self, words: list[str]) -> None:
        if words:
            got = self.whole.encode(words, is_pretokenized=True, add_special_tokens=False)
            ends = np.searchsorted(np.asarray(got.word_ids, dtype=np.int64), np.arange(1, len(words) + 1))
            self._add(words, np.asarray(got.ids, np.uint32), ends)

    def learn(self, words: list[str], simple: np.ndarray) -> None:
        """New words, each once; ``simple``: of small letters up to ``LATIN_LAST`` alone."""
        if self.plain:
            self._learn_simple(list(compress(words, simple)))
            words = list(compress(words, ~simple))
        for k in range(0, len(words), LINE):
            self._learn(words[k:k + LINE])

    def _entries(self, words: list[str], simple: np.ndarray) -> np.ndarray:
        """Where each of these different words stands among the known; what is new is learnt."""
        found = list(map(self.known.get, words))
        if new := [k for k, e in enumerate(found) if e is None]:
            self.learn([words[k] for k in new], simple[new])
            for k in new:
                found[k] = self.known[words[k]]
        return np.array(found, np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words one after another, and where each one's begin and the last one's end."""
        stems = pc.ascii_rtrim(words, characters=MARKS)
        small = pc.utf8_lower(stems)
        odd = pc.or_(pc.match_substring_regex(small, f"[^\\x{{0}}-{LATIN_LAST}]"), pc.match_substring(stems, DOTTED))
        simple = pc.and_not(pc.utf8_is_alpha(small), odd)
        keys = pc.if_else(simple, small, words).dictionary_encode()
        simple, indices = simple.to_numpy(zero_copy_only=False), keys.indices.to_numpy()
        of_key = np.zeros(len(keys.dictionary), bool)
        of_key[indices] = simple
        pairs = np.zeros((len(words), 2), np.int64)  # a word and the marks after it, none at first
        pairs[:, 0] = self._entries(_strings(keys.dictionary), of_key)[indices]
        closing = (pc.binary_length(words).to_numpy() - pc.binary_length(stems).to_numpy()) * simple
        marked = np.flatnonzero(closing)
        tails = pa.array([w[-n:] for w, n in zip(_strings(words.take(pa.array(marked))), closing[marked].tolist())], pa.string()).dictionary_encode()
        pairs[marked, 1] = self._entries(_strings(tails.dictionary), np.zeros(len(tails.dictionary), bool))[tails.indices.to_numpy()]
        ids, at = _gather(self.flat, self.at, pairs.ravel())
        return ids, at[::2]

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.known) > CACHED_WORDS:
            self._clear()
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        out, at = _gather(*self._words(coded.dictionary), coded.indices.to_numpy())
        cuts = at[np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))]
        return [out[i:j] for i, j in zip(cuts, cuts[1:])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; the texts hold no null."""
        out = self._encode(texts)
        for k in np.flatnonzero(pc.match_substring(texts, SPECIAL).to_numpy(zero_copy_only=False)):
            out[k] = np.asarray(self.whole.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, np.uint32)
        return out


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of runs of rows that hold about ``BLOCK`` bytes of text, a longer text alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // BLOCK)) + 1):
        if len(rows):
            yield int(rows[0]), len(rows)


def write_records(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, id_col: str = "doc_id",
                  text_col: str = "text") -> None:
    """Encode every text whole, append ``end_id``, and write records in ascending id order below ``path``.

    Documents are dealt to shards by ranges of the id and sorted within; files
    are named in shard order.  Rows of one id follow each other by text.  A
    null id comes first.  A null text is an empty one and gives only the end
    id.  Other columns are ignored; an empty table writes no record.

    Spark's own writer places and commits the files in any file system, so a
    lost executor or a repeated task leaves no half-written shard; its line
    separator is the record's last byte.
    """
    def encode(batches):
        of = Encoder(vocabulary)
        try:
            for batch in batches:
                for start, n in blocks(batch.column(1)):
                    ids, texts = (batch.column(k).slice(start, n) for k in (0, 1))
                    data = [frame(i, np.append(x, np.uint32(end_id)))[:-1] for i, x in zip(ids.to_pylist(), of.encode(texts))]
                    yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["value"])
        finally:  # the worker lives on and keeps its tokenizer, but not its words
            del of
            release()

    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    with batches_of(docs.sparkSession, BATCH_ROWS), batch_bytes(docs.sparkSession):
        (dealt.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
         .write.option("lineSep", END.decode()).text(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, position, doc_id, offset, bytes, n_tokens, ids_crc32)`` of every record, checksums verified.

    ``ids_crc32`` is the unsigned CRC-32 of the ids as written.
    """
    schema = "shard string, position long, doc_id long, offset long, bytes long, n_tokens long, ids_crc32 long"

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(name, k, i, at, size, len(x), zlib.crc32(x.tobytes()))
                        for k, (at, size, i, x) in enumerate(frames(memoryview(content.as_buffer())))]
                cols = list(zip(*rows)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                    ["shard", "position", "doc_id", "offset", "bytes", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content").mapInArrow(released(parse), schema)


def tokenized(docs: DataFrame, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``records`` and beside them their ``index`` to a new place in the shared folder, and read them back.

    Returns ``(doc_id, start, n_tokens, ids_crc32, shard, offset, bytes)``;
    ``start`` counts the ids of all documents before, in file order.  Shards
    are summed first, so no task sees more than one shard's index.
    """
    spark = docs.sparkSession
    path = fresh_path(spark)
    write_records(docs, f"{path}/records", vocabulary, end_id, id_col, text_col)
    found = read_records(spark, f"{path}/records")
    with batches_of(spark, 1):  # a row is a whole file
        found.write.parquet(f"{path}/index")
    index = spark.read.schema(found.schema).parquet(f"{path}/index")
    sums = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    starts = sums.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("position")) - F.col("n_tokens")
    return index.withColumn("within", within).join(starts, "shard").select(
        F.col("doc_id"), (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "shard", "offset", "bytes")


def read_document(data: bytes, offset: int) -> tuple[int | None, np.ndarray]:
    """The record at one of the index's offsets."""
    length = HEADER.unpack_from(data, offset)[0]
    _, _, doc_id, ids = next(frames(data[offset:offset + HEADER.size + length + 5]))
    return doc_id, ids
