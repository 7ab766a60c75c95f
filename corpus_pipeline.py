"""The corpus pipeline: stages over documents, each an operator of lodestone.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import cut_table, dropped, packed, table
from lodestone.llm.decontaminate import without_benchmark
from lodestone.llm.line_dedup import line_dedup
from lodestone.llm.mixing import by_position, mixed
from lodestone.llm.ngram_jaccard import without_near_duplicates
from lodestone.llm.quality import fitted, held_out, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it is fitted on the labels outside the held-out third."""
    model = fitted(docs, table(spark, sf_dir, "labels"), ~held_out())
    return quality(docs, model).where("predicted = 1").select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines, or of one long line; those of which nothing is left go. n_chars follows the text."""
    out = line_dedup(docs, long_lines=True).where("n_removed = 0 or length(trim(text)) > 0")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return without_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with size, source_size, target, taken (0: the mix leaves it out) and positions, range-sorted by first position."""
    mix = mixed(docs).drop("doc_id")
    names = ("size", "source_size", "target", "taken", "positions")
    out = packed(docs).join(mix, "_row")
    return by_position(out).select(*[F.col("_src").getField(c).alias(c) for c in docs.columns if c not in names], *names)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_stage),
    ("decontaminate", benchmark_stage),
    ("mix", mixing_stage),
]
#: The quality classifier and the near-duplicate classes can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents. What a stage keeps is written as Parquet before the next one reads it, and deleted
    once the next one's output stands.

    Nulls, empty texts, repeated rows and columns of any name are taken as the operators take them; a null text passes all
    stages but the classifier by its score; empty documents give no rows.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            out = cut_table(out)
            if before is not None:
                dropped(before)
            before = out
        docs = out
    return docs
