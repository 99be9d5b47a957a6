"""Training-data pipeline: toxic texts go, boilerplate lines go, copies go, benchmark leaks go, ids are made.

Each stage works on all rows its predecessor kept and returns the columns of ``documents``; the last returns ids.
Null and empty texts go through: they are not toxic unless a text without words is, hold no lines, have no copies and
overlap with nothing, and give no ids. Null ids stay, but for near copies, where they are linked with nothing. Rows that repeat an id are copies, so
one stays. An empty table gives an empty table. Other columns pass, also those named like a stage's own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bottom_k, line_spread, max_plus, plans, spaced_seeds, toxicity
from millrace.session import scratch
from millrace.sources.tables import table


CUT = "_pipeline_cut_lines"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"), plans.fold(4) != 2)
    return toxicity.clean(docs, model)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites show; ``n_chars``, if there is one, follows the text."""
    cut = line_spread.cleaned(docs, plans.MIN_SITES, count=CUT)
    if "n_chars" in docs.columns:
        chars = F.when(F.col(CUT) > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return bottom_k.kept(docs, 80, 5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return spaced_seeds.kept(docs, table(spark, sf_dir, "benchmark"), plans.OVERLAP_TOKENS, plans.OVERLAP_PERCENT)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, by chunk."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return max_plus.encoded(docs, model).select("doc_id", "chunks", "chunk", "score", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

# A trained classifier and a segmentation cannot be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
