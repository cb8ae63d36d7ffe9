"""The corpus pipeline: five stages over documents, each one operator of ``routeline.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routeline.llm import language, mixing, neardup, pieces, secrets
from routeline.llm.common import stored

LEAST_LANGUAGE_SCORE = 0.5

# One of the stages can't be written in SQL (trained models and sampled pieces), so neither can run().
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: some letter, and one language on half the letters."""
    found = language.identify(docs, language.train(docs))
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(kept).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: five-word shingles, similarity 0.8 or more."""
    return neardup.keep_one(docs, size=5, percent=80).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret; the text's length follows."""
    found = secrets.scan(docs).withColumn("text", secrets.masked(F.col("text"), F.col("secret_spans")))
    return found.withColumn(
        "n_chars", F.when(F.size("secret_spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target sizes."""
    return mixing.mix(docs).select(*docs.columns)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document, and the text decoded from them.

    The copies that mixing made of a document are numbered, and the number is part of the seed, so each copy has
    a segmentation of its own. Equal rows are told apart by their text, so rows without an id spread.
    """
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(1))
    copies = docs.withColumn("copy", F.row_number().over(same))
    coded = copies.withColumn("p", pieces.roundtrip(spark, F.col("text"), F.struct("doc_id", "copy")))
    return coded.select(
        "doc_id", "lang", "source", "n_chars", "copy", F.col("p.piece_ids").alias("piece_ids"),
        F.size("p.piece_ids").alias("n_pieces"), F.sha2("p.decoded", 256).alias("decoded_sha256"),
        F.col("p.decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources", mix_sources),
    ("SentencePiece", sentence_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
