"""Substring dedup by sliding runs of consecutive sentences."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longitab.session import stage

#: Where a sentence ends: white space after a closing mark, a wide closing mark, or a line break.
_END = re.compile(r"(?<=[.!?])[^\S\n]+|(?<=[\u3002\uff01\uff1f])|\n\s*")
#: Fixed value: odd base of the run hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Letters of scripts written without spaces: Han, kana, bopomofo and Yi, one a word; Thai, Lao, Tibetan,
#: Burmese, Khmer, Tai, Balinese and Javanese, ``LETTERS`` a word.
_SIGNS = re.compile(
    "[\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\u9fff\ua000-\ua48c\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U000323af]")
_UNSPACED = re.compile(
    "[\u0e01-\u0e30\u0e32\u0e33\u0e40-\u0e46\u0e81-\u0eb0\u0eb2\u0eb3\u0ebd-\u0ec6\u0edc-\u0edf\u0f40-\u0f6c\u1000-\u102a\u103f"
    "\u1050-\u1055\u1780-\u17b3\u1950-\u1974\u1980-\u19ab\u1a20-\u1a54\u1b05-\u1b33\ua984-\ua9b2\uaa60-\uaa7a]")
_OTHER = re.compile(r"[^\W_]")
LETTERS = 4
#: A run has at least so many sentences and words, or is one sentence of that many words.
SENTENCES, WORDS, LONG = 2, 20, 40


def sentences(text: str) -> list[tuple[int, int]]:
    """``(start, next start)`` of each sentence; what separates two belongs to the first."""
    cuts = sorted({0, *(m.end() for m in _END.finditer(text)), len(text)})
    return list(zip(cuts, cuts[1:]))


def _n_words(sentence: str, words: list[str]) -> int:
    """What stands between spaces, but in scripts without spaces by their letters."""
    rest, signs = _SIGNS.subn(" ", sentence)
    rest, letters = _UNSPACED.subn(" ", rest)
    if not signs and not letters:
        return len(words)
    # vowel signs and tone marks that the letters leave behind are no words
    return signs + -(-letters // LETTERS) + sum(bool(_OTHER.search(w)) for w in rest.split())


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def runs(text: str, least: int = SENTENCES, words_: int = WORDS, long: int = LONG) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, first sentence, end sentence)`` of every run of consecutive sentences.

    From each sentence the shortest run forward, and to each the shortest run
    back, that has ``least`` sentences and ``words_`` words, or ``long``
    words.  So any stretch that holds one run is covered by its runs to both
    ends.  Letter case and the kind of white space do not count.  In scripts
    that are written without spaces, words are counted by letters.
    """
    words = [text[i:j].lower().split() for i, j in sentences(text)]
    n = len(words)
    if text.isascii() or not (_SIGNS.search(text) or _UNSPACED.search(text)):
        sizes = [len(w) for w in words]
    else:
        sizes = [_n_words(text[i:j], w) for (i, j), w in zip(sentences(text), words)]
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    of = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((of(" ".join(w)) for w in words), np.uint64, n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(BASE, n), dtype=np.uint64)])
    at = np.arange(n)
    ahead = np.minimum(np.maximum(at + least, np.searchsorted(total, total[:-1] + words_)), np.searchsorted(total, total[:-1] + long))
    ends = np.arange(1, n + 1)
    back = np.maximum(
        np.minimum(ends - least, np.searchsorted(total, total[1:] - words_, "right") - 1),
        np.searchsorted(total, total[1:] - long, "right") - 1)
    pairs = np.concatenate([np.stack([at, ahead]), np.stack([back, ends])], axis=1)
    pairs = np.unique(pairs[:, (pairs[0] >= 0) & (pairs[1] <= n)], axis=1)
    first, end = pairs
    mixed = ((sums[end] - sums[first]) * _powers(INVERSE, n + 1)[first]) ^ ((end - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return mixed ^ (mixed >> np.uint64(32)), first, end


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that repeat an id with another text are documents of their own."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def spans(rows: DataFrame, *sizes: int) -> DataFrame:
    """``(id, version, text)`` to one row per run: ``(hash, at: (id, version, first), end)``."""
    kind = rows.schema["id"].dataType.simpleString()

    def find(batches):
        for batch in batches:
            found = [runs(t, *sizes) for t in batch.column(2).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            one = lambda k, t: np.concatenate([f[k] for f in found]).astype(t) if found else np.empty(0, t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one(0, np.uint64).view(np.int64)), batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(one(1, np.int32)), pa.array(one(2, np.int32))], ["hash", "id", "version", "first", "end"])

    made = rows.mapInArrow(find, f"hash long, id {kind}, version long, first int, end int")
    return made.select("hash", F.struct("id", "version", "first").alias("at"), "end")


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = SENTENCES, words: int = WORDS,
                long: int = LONG) -> DataFrame:
    """Each document without the sentences of runs that stand elsewhere before.

    Returns ``(<id>, <text>, n_sentences, n_removed)``, one row per input row.
    Of equal runs in the whole table the first by (id, text hash, position)
    stays; sentences that another one covers are cut out with the white space
    after them.  Runs that overlap within a document count like any others.
    A run has at least ``least`` sentences and ``words`` words, or ``long``
    words; smaller repeats stay.

    A null text is an empty one, with no sentences.  Rows equal in id and text
    are one document and are cut alike.  A null id comes before all others.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = _row_key(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    # staged, so that the texts are cut into runs once for both readers
    found = stage(spans(rows, least, words, long))
    repeated = found.groupBy("hash").agg(F.count("*").alias("n"), F.min("at").alias("kept")).where("n > 1").drop("n")
    later = found.join(stage(repeated), "hash").where(~F.col("at").eqNullSafe(F.col("kept")))
    cover = later.select("at.id", "at.version", F.struct(F.col("at.first").alias("first"), "end").alias("run")).distinct()
    cuts = cover.groupBy(F.col("id").alias("i"), F.col("version").alias("v")).agg(F.collect_list("run").alias("runs"))

    def cut(batches):
        for batch in batches:
            texts, counts, gone = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = sentences(text)
                drop = np.zeros(len(parts) + 1, np.int64)
                for r in found or ():
                    drop[r["first"]] += 1
                    drop[r["end"]] -= 1
                drop = np.cumsum(drop)[:-1] > 0
                texts.append("".join(text[i:j] for (i, j), d in zip(parts, drop) if not d) if drop.any() else text)
                counts.append(len(parts))
                gone.append(int(drop.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                ["id", "text", "n_sentences", "n_removed"])

    joined = rows.join(cuts, F.col("id").eqNullSafe(F.col("i")) & (F.col("version") == F.col("v")), "left").select("id", "text", "runs")
    return joined.mapInArrow(cut, f"id {kind}, text string, n_sentences long, n_removed long").toDF(
        id_col, text_col, "n_sentences", "n_removed")
