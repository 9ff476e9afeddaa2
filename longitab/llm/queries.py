"""One query per operator over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, crf, divergence, jaccard, language, linkgraph, mixing, negatives, packing, records, spans, sql, templates, vptree

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = sql.SQL


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(*tables: str):
    """Register a function of these tables under its name."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        return fn
    return add


@query("documents")
def op3_mixing(documents: DataFrame) -> DataFrame:
    """Documents mixed to source weights 1, 2, 3 with at most 3 passes."""
    return mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken")


@query("documents")
def op6_token_records(documents: DataFrame) -> DataFrame:
    """Token ids written as records and read back."""
    return records.tokenized(documents, vocabulary("word_bpe_49k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("pages")
def op8_link_graph(pages: DataFrame) -> DataFrame:
    """Verdicts on page urls by rules and the hosts' link graph."""
    return linkgraph.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query("documents")
def op10_jaccard(documents: DataFrame) -> DataFrame:
    """Groups of documents linked at Jaccard 0.85 on 4-word shingles."""
    return jaccard.jaccard_groups(documents, words=4, threshold="0.85")


@query("documents")
def op9_sentence_spans(documents: DataFrame) -> DataFrame:
    """Documents without sentences that a repeated run covers, but for its first place."""
    return spans.dedup_spans(documents)


@query("conversations")
def op7_chat(conversations: DataFrame) -> DataFrame:
    """Conversations formatted, encoded and masked, read back from the output."""
    return chat.formatted_digests(chat.with_probe(conversations), vocabulary("byte_bpe_50k.json"))


@query("embeddings")
def op4_vantage_points(embeddings: DataFrame) -> DataFrame:
    """The 20 largest inner products of every twentieth vector."""
    return vptree.nearest(embeddings, embeddings.where("vec_id % 20 = 0"))


@query("documents")
def op5_language(documents: DataFrame) -> DataFrame:
    """Language of each document by fused evidence, and whether it is accepted."""
    return language.identify(documents).select("row.doc_id", "language", "confidence", "known", "accepted")


@query("documents", "benchmark")
def op2_templates(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold benchmark items, also with other names, numbers and units."""
    return templates.leaks(documents, benchmark)


@query("pages")
def op1_main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page by a conditional random field."""
    return crf.extract(pages)


@query("embeddings")
def op11_spanning_tree(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth vector, every seventh of them with the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.withColumn("label", label)
    return negatives.mine(rows, rows.where("vec_id % 100 = 0"))


@query("documents")
def op12_bin_slack(documents: DataFrame) -> DataFrame:
    """Documents packed into sequences of 1024 tokens, one row per piece."""
    pieces = packing.pieces_of(packing.pack(documents, vocabulary("byte_bpe_50k.json")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("documents")
def op13_iceberg_audit(documents: DataFrame) -> DataFrame:
    """How far each source's words are from its language's other sources, and the terms that set it apart."""
    return divergence.audit(documents)
