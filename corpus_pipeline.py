"""The corpus pipeline: five stages over ``documents``, each one operator of
``signalmart.llm``. A stage's result is written as Parquet and read again as
the next stage's input.

Defined results: rows with null or empty text pass the first stage (nothing
in them is toxic), one of them stays after the second, and it has no pieces.
Every stage but the last returns the columns it was given; the last adds
``token_ids``, ``n_tokens`` and ``decodes`` and replaces columns of those
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart.llm import benchmark_scan, exact_dedup, minhash, queries, sentence_pieces, toxicity
from signalmart.llm.common import remainder, send_package, stored, text_column


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half stay."""
    labels = queries.table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, labels, remainder(labels["doc_id"], 5) != 0)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one of the largest doc_id stays."""
    send_package(spark)
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8) stays."""
    send_package(spark)
    return minhash.drop_near_copies(docs, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return benchmark_scan.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def with_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its pieces, and whether they decode to its text."""
    send_package(spark)
    model = sentence_pieces.read_model(queries.PIECES)
    coded = docs.withColumn("token_ids", sentence_pieces.encoded(text_column(docs, "text"), model))
    return (coded.withColumn("decodes", F.col("token_ids.exact")).withColumn("token_ids", F.col("token_ids.ids"))
            .withColumn("n_tokens", F.size("token_ids").cast("long")))


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding", with_pieces),
]

# Scores by nearest neighbours and MinHash components are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` and return the last one's result."""
    docs = queries.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
