"""Pages of decks on their way to delivery: which are kept, which are copies, which fall out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.dedup import first_near


def earliest_near(hashes: DataFrame, distance: int) -> DataFrame:
    """(phash, near_file): for each hash of (file_id, phash), the first file with a hash at most `distance` bits away.

    Equal hashes are one row before they meet, however many pages have them.
    """
    least = hashes.where("phash IS NOT NULL").groupBy("phash").agg(F.min("file_id").alias("file_id"))
    near = first_near(least.select(F.col("file_id").alias("place"), "file_id", F.col("phash").alias("h")), distance)
    return least.join(near.select(F.col("h").alias("phash"), "first"), "phash", "left").select("phash", F.coalesce("first", "file_id").alias("near_file"))


def extracted(files: DataFrame, pages: DataFrame, distance: int, inside: DataFrame | None = None) -> DataFrame:
    """(file_id, page_index, status, reason) of the pages that files contribute.

    files: id; pages: file_id, page_index, selected (worth delivering), sha256 and phash (null: rendering failed). Files are
    taken by id, their pages by index. A page whose bytes stood before anywhere is a duplicate (exact), one that looks like a
    page of an earlier file too (near), and one that lies within another image, if `inside` (file_id, page_index) says so
    (contained). The others are extracted. Copies count for later pages as well. A file without selected pages leaves one
    rejected row with index -1, by which it is known as done. Files without rows in pages are such files.
    """
    mine = pages.where("selected").join(files.select(F.col("id").alias("file_id")), "file_id", "left_semi").select("file_id", "page_index", "sha256", "phash")
    place = F.struct("file_id", "page_index")
    first = mine.where("sha256 IS NOT NULL").groupBy("sha256").agg(F.min(place).alias("first"))
    rows = mine.join(first, "sha256", "left").join(earliest_near(mine.where("sha256 IS NOT NULL"), distance), "phash", "left")
    rows = rows.join(inside.select("file_id", "page_index", F.lit(True).alias("within")).distinct(), ["file_id", "page_index"], "left") if inside is not None else rows.withColumn("within", F.lit(False))
    reason = F.when(F.col("sha256").isNull(), "not_rendered").when(F.col("first") != place, "exact").when(F.col("near_file") < F.col("file_id"), "near").when(F.col("within"), "contained")
    rows = rows.select("file_id", "page_index", reason.alias("reason"))
    status = F.when(F.col("reason") == "not_rendered", "rejected").when(F.col("reason").isNotNull(), "duplicate").otherwise("extracted")
    none = files.select(F.col("id").alias("file_id")).join(mine.select("file_id"), "file_id", "left_anti")
    none = none.select("file_id", F.lit(-1).cast("int").alias("page_index"), F.lit("rejected").alias("status"), F.lit("no_graphical_pages").alias("reason"))
    return rows.select("file_id", F.col("page_index").cast("int").alias("page_index"), status.alias("status"), "reason").union(none)
