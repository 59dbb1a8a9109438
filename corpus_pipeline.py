"""The corpus pipeline: quality filter, line dedup, near dedup, source mix, packing.

Every stage takes all rows that the one before it kept, and its result is written as
Parquet in the cluster's shared folder before the next stage reads it. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import compression_quality, hyperminhash, line_dedup, mixing, packing
from lakeforge.llm.common import read_table, written
from lakeforge.llm.queries import QUALITY_THRESHOLD, held_out

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near duplicates of the pipeline share so many percent of their word shingles; op7's own 85 is its query's.
NEAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on their labels, doesn't reject.

    Where the labels make no classifier (none usable, or of one class only), all stay.
    """
    model = compression_quality.fit(docs, read_table(spark, sf_dir, "labels"), held_out())
    if model.constant is not None:
        return docs
    scored = compression_quality.classify(docs, model, threshold=QUALITY_THRESHOLD)
    return scored.where("predicted = 1").select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated chunks of lines; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs, phases=2, every_pair=True).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (NEAR_PERCENT): the one with the smallest id."""
    found = hyperminhash.near_duplicates(docs, percent=NEAR_PERCENT)
    stay = written(found.where("kept").select("row_key").distinct(), "kept-rows")
    key = hyperminhash.row_key("doc_id", "text")
    rows = docs.withColumn("row_key", key).join(stay, "row_key", "left_semi")
    return rows.dropDuplicates(["row_key"]).select(*docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mixing.mix_sources(docs).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.withColumn("copy", copies).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", remove_repeated_lines),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mix_sources", mix_to_targets),
    ("best_fit_packing", pack_sequences),
]

#: No SQL can express the learned stages; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
