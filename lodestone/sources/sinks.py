"""Sinks: manifests, sidecars, hash lists, audit rows, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a manifest (fixed values).
MANIFEST = (
    "delivered_filename", "sha256", "source_url", "source_domain", "download_url", "original_filename", "format", "converted_from_ppt", "slide_count", "quality_class", "collection_ts", "download_ts",
    "http_status", "robots_status", "retrieval_method", "public_access_status", "screen_pirate", "screen_robots", "screen_rights", "screen_pii", "screen_minors", "screen_prohibited",
    "page_index", "image_sha256", "phash", "source_file_sha256", "extraction_method", "final_status",
)


def manifest_rows(rows: DataFrame) -> DataFrame:
    """All columns of a manifest, in order, as text; those that rows lacks are empty."""
    return rows.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")).alias(c) for c in MANIFEST])


def write_manifest(rows: DataFrame, path: str) -> None:
    """One CSV with header for a batch (of bounded size), sorted by delivered_filename."""
    manifest_rows(rows).orderBy("delivered_filename").coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_sidecars(rows: DataFrame, path: str, by: str = "batch_id") -> None:
    """A JSON line for each row, in a folder for each batch."""
    rows.select(F.col(by), F.to_json(F.struct(*[c for c in rows.columns if c != by])).alias("value")).write.mode("overwrite").partitionBy(by).text(path)


def write_hashes(rows: DataFrame, path: str, column: str = "sha256") -> None:
    """Sorted distinct hashes as gzipped text, range-partitioned, so that parts in order are the sorted list."""
    rows.select(F.lower(column).alias("value")).where("length(value) = 64").distinct().orderBy("value").write.mode("overwrite").option("compression", "gzip").text(path)


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_report(rows: DataFrame, path: str, by: str = "classification", score: str = "score") -> None:
    """CSV in a folder for each class, each file sorted by falling score."""
    rows.repartition(by).sortWithinPartitions(by, F.desc(score)).write.mode("overwrite").partitionBy(by).option("header", "true").csv(path)
