"""The dealt operators as registered queries, each over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fareloom.llm import bpe, decontaminate, hamming, jaccard_join, line_dedup, lm, mixing, oracle, quality, rabitq, spelling, toxicity, treap, warc
from fareloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: four-word shingles, similarity 0.85 or more."""
    found = jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, digests=True)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record in the archives says."""
    records = warc.archive_and_read(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a model fitted outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("text")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, by a model of trusted positives and unlabelled text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels"))).drop("text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document, its source's target and size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under smoothed word counts and under the mixture."""
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op8_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 vectors nearest to every 100th one in the Hamming distance of their sign codes."""
    vectors = table(spark, sf_dir, "embeddings")
    codes = vectors.select("vec_id", hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.top_k(codes, F.col("vec_id") % 100 == 0, k=10)


def op9_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of largest inner product with every 20th vector."""
    return rabitq.nearest(table(spark, sf_dir, "embeddings"), k=20)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document: lines before, lines removed, digest of the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, percent=90).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one run in 31 misspelt, under their more frequent forms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.vocabulary(spelling.misspelt(spelling.runs_of(docs))))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of ten words of benchmark items, and the items they are of."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op13_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for the terms of every benchmark item."""
    return treap.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def queries() -> dict[str, Query]:
    """Every dealt operator by its registered name, and the pipeline."""
    dealt = (
        op1_jaccard_join,
        op2_bpe,
        op3_warc,
        op4_toxicity,
        op5_quality,
        op6_mixing,
        op7_lm,
        op8_hamming_search,
        op9_rabitq,
        op10_line_dedup,
        op11_spelling,
        op12_decontaminate,
        op13_treap_search,
    )
    return {f.__name__: f for f in dealt} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL of those that SQL can express."""
    return oracle.SQL
