"""Registry operators: claims, upserts, folder comparison and audit scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def claim(urls: DataFrame, handoff: Column, archived: Column, limit: int, gated: bool) -> DataFrame:
    """The first `limit` urls to fetch, with position: handed-over ones, then (gated) archived before others or (not gated) after them, by id."""
    rank = F.when(handoff, 0).when(archived, 1 if gated else 2).otherwise(2 if gated else 1)
    first = urls.withColumn("_rank", rank).orderBy("_rank", "id").limit(limit)
    return first.withColumn("position", F.row_number().over(W.orderBy("_rank", "id")).cast("long")).drop("_rank")


def insert_or_ignore(existing: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of `new` that `existing` lacks, the first by order of each key."""
    fresh = new.join(existing.select(key), key, "left_anti")
    return fresh.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy(order))).where("_k = 1").drop("_k")


def merged_updates(rows: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of `updates` laid over them; null there keeps the old value."""
    cols = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_u_{c}") for c in cols])
    return rows.join(u, key, "left").select(*[F.coalesce(f"_u_{c}", c).alias(c) if c in cols else F.col(c) for c in rows.columns])


def tier_acceptance(urls: DataFrame, files: DataFrame) -> DataFrame:
    """Per tier: candidates, accepted (files to deliver), bytes, accepted_per_1k (two places, half to even), bytes_per_accepted (null without any). A url counts once for each of its files."""
    n = F.count("*")
    ok = F.count_if(F.col("decision") == "DELIVER")
    out = urls.join(files.select("url_id", "decision"), F.col("id") == F.col("url_id"), "left").groupBy("tier").agg(n.alias("candidates"), ok.alias("accepted"), F.sum(F.coalesce("content_length", F.lit(0))).cast("long").alias("bytes"))
    per = F.bround(F.col("bytes").cast("double") / F.nullif(F.col("accepted"), F.lit(0)), 0).cast("long")
    return out.withColumn("accepted_per_1k", F.bround(F.lit(1000.0) * F.col("accepted") / F.col("candidates"), 2)).withColumn("bytes_per_accepted", per)


def compare_folders(a: DataFrame, b: DataFrame, key: str = "sha") -> DataFrame:
    """(role, n): hashes in both, only in a, only in b, and all. One aggregation over both folders."""
    both = a.select(F.col(key).alias("k"), F.lit(1).alias("f")).union(b.select(F.col(key).alias("k"), F.lit(2).alias("f")))
    sides = both.groupBy("k").agg(F.bit_or("f").alias("f"))
    counts = sides.agg(F.count_if(F.col("f") == 3).alias("duplicate"), F.count_if(F.col("f") == 1).alias("unique_a"), F.count_if(F.col("f") == 2).alias("unique_b"), F.count("*").alias("all"))
    return counts.unpivot([], ["duplicate", "unique_a", "unique_b", "all"], "role", "n")


def audit_score() -> Column:
    """0..100 from image signals: text_density, pairs, lines, colors, long_edges, blobs, symmetry, white, hues."""
    c = F.col
    return F.greatest(F.lit(0), F.least(F.lit(100), (
        F.lit(50) + F.when(c("text_density") > 0.4, -35).when(c("text_density") > 0.2, -25).when(c("text_density") > 0.1, -15).when(c("text_density") > 0.05, -5).otherwise(0)
        + F.when(c("pairs") > 5, 25).when(c("pairs") > 2, 15).when(c("lines") > 10, 10).when(c("lines") > 5, 5).otherwise(0)
        + F.when(c("colors").between(4, 12), 10).when(c("colors") > 12, 5).when(c("colors") <= 2, -5).otherwise(0) + F.when(c("long_edges") > 0.3, 10).when(c("long_edges") > 0.15, 5).otherwise(0)
        + F.when(c("blobs").between(5, 100), 10).when(c("blobs") > 100, 5).otherwise(0) + F.when(c("symmetry") > 0.6, 5).otherwise(0) + F.when(c("white") > 0.5, 5).otherwise(0) + F.when(c("hues").between(3, 10), 5).otherwise(0))))
