"""Language of documents from their text, what they declare, and where they come from.

The text's likelihood is that of its letter trigrams under a model per
language, fitted on a bounded sample of each language's labelled rows.  The declared language
and the address suffix add likelihoods, the host a prior; all three are
estimated by grouped counts over all rows, the host's drawn to its domain's and
that to the whole table's, the more the fewer rows it has.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longitab.session import stage, unstage

from .common import release, released, with_ids

#: Labelled rows of each language that the trigram model is fitted on at most.
TRAIN_ROWS = 2000
#: Rows of a language that are ranked together; Spark limits ranks per map task before the shuffle up to 1000.
RANKED = 500
#: Hash buckets of trigrams; with the languages they bound the model's size.
BUCKETS = 1 << 15
#: Bytes of text that are scored at a time, and trigrams of a longer text that are looked up at a time.
BLOCK, PIECE = 1 << 18, 1 << 18
#: Odd constants of the trigram hash, and the shift that leaves a bucket.
A, B, C, SHIFT = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(32 - 15)
#: Rows' worth of belief in the parent's prior, and in a value being as common in each language.
PRIOR_ROWS, EVIDENCE_ROWS = 20.0, 20.0
#: A document is accepted if so much of its text is known and the best language is so likely.
KNOWN, CONFIDENCE = 0.5, 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The trigram buckets of all texts one after another, and how many each text has.

    Letters are small and what is not a letter separates; each letter gives the
    trigram that it is the middle of.
    """
    small = [(t or "").lower() for t in texts]
    codes = np.frombuffer(f" {' '.join(small)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    plain = np.where(letter, codes, np.uint32(32))
    middle = np.flatnonzero(letter)
    mixed = plain[middle - 1] * A ^ plain[middle] * B ^ plain[middle + 1] * C
    ends = np.cumsum([len(t) + 1 for t in small])
    return ((mixed * A) >> SHIFT).astype(np.int64), np.diff(np.searchsorted(middle, ends, "right"), prepend=0)


def _blocks(texts: pa.Array):
    """Runs of rows that hold about ``BLOCK`` bytes of text, a longer text alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // BLOCK)) + 1):
        if len(some):
            yield texts.slice(some[0], len(some)).to_pylist()


class Model:
    """Trigram log-likelihoods per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        logs = np.log((counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * BUCKETS))
        self.table = np.concatenate([logs, [np.ones(BUCKETS)], [counts.sum(axis=0) > 0]]).T.astype(np.float32)

    def score(self, texts: pa.Array) -> pa.Array:
        """Per text the log-likelihood under each language, its trigrams, and how many of them are known."""
        out = []
        for block in _blocks(texts):
            at, sizes = trigrams(block)
            ends = np.append(0, np.cumsum(sizes))
            if len(block) == 1:  # it may be a long one
                pieces = [self.table[at[k:k + PIECE]].sum(axis=0, dtype=np.float64) for k in range(0, len(at), PIECE)]
                out.append(np.sum(pieces, axis=0) if pieces else np.zeros(self.table.shape[1]))
            else:
                values = self.table[at]
                out += [values[i:j].sum(axis=0, dtype=np.float64) for i, j in zip(ends, ends[1:])]
        made = pa.array(out, pa.list_(pa.float64()))
        release()
        return made


def fit(rows: DataFrame, text: Column, label: Column, key: Column, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on up to ``train_rows`` labelled rows with letters of each label, those of least key hash; texts are read whole.

    A label with fewer rows gives all of them, so each label of such a row has a model.
    """
    label = label.cast("string")
    labelled = rows.select(F.xxhash64(key, label).alias("at"), label.alias("label"), text.alias("text")).where(
        F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    parts = -(-train_rows // RANKED)
    rank = F.row_number().over(Window.partitionBy("label", F.pmod("at", F.lit(parts))).orderBy("at"))
    sample = stage(labelled.select("at", rank.alias("rank")).where(F.col("rank") <= train_rows // parts).select("at").distinct())

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            for name in set(labels):
                at = total.setdefault(name, np.zeros(BUCKETS, np.int64))
                for block in _blocks(batch.column(1).filter(pa.array(labels == name))):
                    at += np.bincount(trigrams(block)[0], minlength=BUCKETS)
        for name, at in total.items():
            g = np.flatnonzero(at)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(g), pa.array(at[g])], ["label", "bucket", "n"])

    counts = with_ids(labelled, "at", sample).select("label", "text").mapInArrow(released(count), "label string, bucket long, n long")
    sums = counts.groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toPandas()  # at most BUCKETS rows for each language
    languages = sorted(set(table.label))
    out = np.zeros((len(languages), BUCKETS))
    out[[languages.index(x) for x in table.label], table.bucket.to_numpy(np.int64)] = table.n
    unstage(sample)
    return Model(languages, out)


def _counts(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``(value, counts per language)`` of the rows that have a value."""
    per = F.array(*[F.count_if(F.col("guess") == k).cast("double") for k in range(n)])
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"{key}_value")).agg(per.alias(f"{key}_counts"))


def _total(a: str) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _drawn(counts: str, parent: Column) -> Column:
    """Shares drawn to the parent's by ``PRIOR_ROWS`` rows."""
    return F.zip_with(counts, parent, lambda c, p: (c + p * PRIOR_ROWS) / (_total(counts) + PRIOR_ROWS))


def identify(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str | None = "lang",
    host_col: str | None = "source",
    suffix_col: str | None = None,
    label_col: str | None = None,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``(row, language, confidence, known, accepted)``, one per input row.

    ``row`` is the input row as a struct, so no column can clash.  The model is
    fitted on ``label_col`` (by default what rows declare), up to ``train_rows``
    rows of each label, however rare.  ``confidence`` is
    the posterior of the best language, ``known`` the share of the text's
    trigrams that occur in the training sample.  A document is accepted if
    ``known >= KNOWN`` and ``confidence >= CONFIDENCE``.

    A text without letters (null, empty) is not accepted; evidence alone then
    gives its language.  Null evidence says nothing.  Equal scores give the
    first language by name.  If no labelled row has letters, language
    is null, confidence 0, and nothing is accepted.  An empty table gives none.
    """
    null = F.lit(None).cast("string")
    col = lambda name: rows[name].cast("string") if name else null
    model = fit(rows, rows[text_col], col(label_col or declared_col), rows[id_col], train_rows)
    names, n = model.languages, len(model.languages)
    if not n:
        return rows.select(F.struct("*").alias("row"), null.alias("language"), F.lit(0.0).alias("confidence"),
                           F.lit(0.0).alias("known"), F.lit(False).alias("accepted"))

    held = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        return held.value.score(texts)

    # a filter on the scores would else be pushed below them with a scoring of its own, in a second worker a task
    score = score.asNondeterministic()
    host = col(host_col)
    domain = F.when(host.contains("."), F.substring_index(host, ".", -2))
    scored = rows.select(
        F.struct("*").alias("row"), score(rows[text_col]).alias("s"), col(declared_col).alias("declared"),
        col(suffix_col).alias("suffix"), host.alias("host"), domain.alias("domain"))
    text = F.slice("s", 1, n)
    guess = (F.array_position(text, F.array_max(text)) - 1).cast("int")
    # one narrow pass over all texts for the grouped counts
    seen = stage(scored.select("declared", "suffix", "host", "domain", F.when(F.get("s", F.lit(n)) > 0, guess).alias("guess")).where("guess is not null"))
    whole = seen.agg(*[F.count_if(F.col("guess") == k).alias(f"n{k}") for k in range(n)]).first()
    total = sum(whole)
    share = F.array(*[F.lit((x + 1.0) / (total + n)) for x in whole])
    size = F.array(*[F.lit(float(x)) for x in whole])

    def evidence(key: str) -> DataFrame:
        """log p(value | language): as common in each language as in all, but for what the counts say."""
        at = f"{key}_counts"
        of = F.zip_with(at, size, lambda c, m: F.ln((c + EVIDENCE_ROWS * (_total(at) + 1) / (total + 1)) / (m + EVIDENCE_ROWS)))
        return _counts(seen, key, n).select(f"{key}_value", of.alias(f"{key}_log"))

    domains = _counts(seen, "domain", n).select("domain_value", _drawn("domain_counts", share).alias("domain_share"))
    per_host = _counts(seen, "host", n).withColumn("d", F.when(F.col("host_value").contains("."), F.substring_index("host_value", ".", -2)))
    hosts = per_host.join(domains, F.col("d") == F.col("domain_value"), "left").select(
        "host_value", F.transform(_drawn("host_counts", F.coalesce("domain_share", share)), lambda x: F.ln(x)).alias("host_log"))
    out = scored
    for key, table in (("declared", evidence("declared")), ("suffix", evidence("suffix")), ("host", hosts)):
        table = stage(table)
        out = out.join(table, F.col(key) == F.col(f"{key}_value"), "left")
    nothing = F.array_repeat(F.lit(0.0), n)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = add(add(text, F.coalesce("declared_log", nothing)),
                add(F.coalesce("suffix_log", nothing), F.coalesce("host_log", F.transform(share, lambda x: F.ln(x)))))
    out = out.select("row", fused.alias("log"), F.get("s", F.lit(n)).alias("grams"), F.get("s", F.lit(n + 1)).alias("seen"))
    out = out.withColumn("top", F.array_max("log"))
    odds = F.aggregate("log", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    known = F.when(F.col("grams") > 0, F.col("seen") / F.col("grams")).otherwise(0.0)
    language = F.get(F.array(*[F.lit(x) for x in names]), (F.array_position("log", F.col("top")) - 1).cast("int"))
    return out.select(
        "row", language.alias("language"), (1 / odds).alias("confidence"), known.alias("known"),
        ((known >= KNOWN) & (1 / odds >= CONFIDENCE)).alias("accepted"))


def accepted(docs: DataFrame, **columns) -> DataFrame:
    """The rows that ``identify`` accepts, with their own columns."""
    return identify(docs, **columns).where("accepted").select("row.*")


def page_evidence(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(<id>, text, declared, suffix, host)`` of web pages, as ``identify`` takes them:
    visible text, the language of the ``html`` tag, and the url's host and its last label."""
    html, url = pages[html_col], pages[url_col]
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?(</\1\s*>|$)", " "), r"(?s)<!--.*?(-->|$)|<[^>]*>", " ")
    host = F.nullif(F.lower(F.regexp_extract(url, r"^(?s:.*?)://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    declared = F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([a-z]+)", 1)), F.lit(""))
    return pages.select(
        pages[id_col].alias(id_col), bare.alias("text"), declared.alias("declared"),
        F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"))
