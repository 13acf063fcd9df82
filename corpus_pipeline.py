"""A corpus from documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept and is written as Parquet
before the next one reads it, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.llm import decontaminate, line_dedup, near_dedup, packing, quality_rules
from ledgerlight.llm.storage import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules.judge(docs, labels, rejected=0.01, risk=0.05, keep_columns=docs.columns)
    return judged.where("_quality_kept").select(*docs.columns)


def drop_similar_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand elsewhere too; a document that loses its last word goes."""
    kept = line_dedup.dedup_lines(docs, percent=80, shingle=5, least_chars=1)
    worded = (F.col("_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    length = F.when(F.col("_removed") == 0, F.col("n_chars")).otherwise(F.char_length("text"))
    return kept.where(worded).withColumn("n_chars", length).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates; documents without an id stay."""
    gone = near_dedup.near_duplicates(docs, size=5, percent=80).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark, window=13, one_in=20)
    gone = found.where("contaminated").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a packed sequence."""
    packed = packing.pack(docs, "word_bpe_49k.json", end_id=2)
    return packing.pieces(packed)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_similar_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Fuzzy lines and tokens are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
