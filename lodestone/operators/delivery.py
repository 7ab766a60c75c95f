"""Joins and state changes of the registry between review, extraction and delivery.

Tables: urls (id, url, domain, status, ...), files (id, url_id, sha256, quality, decision, delivered, batch_id, ...), pages
(id, file_id, page_index, sha256, status, ...). State changes come out as rows with their new state; nothing is changed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Url states in which a payload is alive, and those from which files are delivered (fixed values).
LIVE = ("downloaded", "validated", "classified", "reserve", "review", "delivered")
DELIVERABLE = ("classified", "reserve")


def public_access(method: Column, status: Column) -> Column:
    return F.when(method == "wayback", "archived-via-wayback").when(status == 200, "reachable").otherwise("dead")


def retryable(status: Column) -> Column:
    return (status == 403) | (status == 429) | status.between(500, 599)


def deliverable(files: DataFrame, urls: DataFrame, batch: int | None = None) -> DataFrame:
    """Files to deliver with their url's columns: decided, not delivered, and of a deliverable url or already of the batch."""
    own = F.lit(False) if batch is None else F.coalesce(F.col("batch_id") == batch, F.lit(False))
    of = urls.select(F.col("id").alias("url_id"), F.col("status").alias("url_status"), F.col("url").alias("source_url"), F.col("domain").alias("source_domain"))
    return files.where("decision = 'DELIVER' AND NOT delivered").join(of, "url_id").where(F.col("url_status").isin(*DELIVERABLE) | own)


def deliverable_pages(pages: DataFrame, files: DataFrame, urls: DataFrame, batch: int | None = None) -> DataFrame:
    """Extracted pages not yet delivered, with their file's quality and hash and their url: of a deliverable url or already of the batch."""
    own = F.lit(False) if batch is None else F.coalesce(F.col("batch_id") == batch, F.lit(False))
    of = files.select(F.col("id").alias("file_id"), "url_id", "quality", F.col("sha256").alias("source_file_sha256"))
    at = urls.select(F.col("id").alias("url_id"), F.col("status").alias("url_status"), F.col("url").alias("source_url"))
    return pages.where("status = 'extracted' AND NOT delivered").join(of, "file_id").join(at, "url_id").where(F.col("url_status").isin(*DELIVERABLE) | own)


def batch_counts(rows: DataFrame, high: float = 0.7, medium: float = 0.3) -> DataFrame:
    """Per batch_id: total, high, medium and composition_ok (shares within the contract)."""
    out = rows.groupBy("batch_id").agg(F.count("*").alias("total"), F.count_if(F.col("quality") == "HIGH").alias("high"), F.count_if(F.col("quality") == "MEDIUM").alias("medium"))
    return out.withColumn("composition_ok", (F.col("high") / F.col("total") >= F.lit(high)) & (F.col("medium") / F.col("total") <= F.lit(medium)))


def batch_states(batches: DataFrame, size: int) -> DataFrame:
    """Adds state to batches (batch_id, total, composition_ok, age_days): open, packing (full), held (full but out of composition) or due (not full, but open for long)."""
    full = F.col("total") >= size
    return batches.withColumn("state", F.when(full & F.col("composition_ok"), "packing").when(full, "held").when(F.col("age_days") >= 14, "due").otherwise("open"))


def verified(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Adds arrived to local files (name, size): a remote one of the name and size is there."""
    there = remote.select("name", "size").distinct().withColumn("arrived", F.lit(True))
    return local.join(there, ["name", "size"], "left").withColumn("arrived", F.coalesce("arrived", F.lit(False)))


def without_pages(files: DataFrame, pages: DataFrame, states: tuple[str, ...] = ()) -> DataFrame:
    """Files that have no page (of these states, if any are given)."""
    of = pages.where(F.col("status").isin(*states)) if states else pages
    return files.join(of.select(F.col("file_id").alias("id")), "id", "left_anti")


def flagged(compliance: Column) -> Column:
    """Whether a screen (struct with pii, minors, rights) sent a file to review, whatever the case of its verdict."""
    hit = lambda c: F.coalesce(F.upper(compliance[c]).isin("REVIEW", "HIT", "FLAGGED", "TRUE"), F.lit(False))
    return hit("pii") | hit("minors") | hit("rights")


def promoted(files: DataFrame, urls: DataFrame, quality_only: bool = False) -> DataFrame:
    """The review backlog (file_id, url_id) with the decision and url state after promotion; with quality_only, files that a screen flagged stay."""
    of = urls.where("status = 'review'").select(F.col("id").alias("url_id"))
    rows = files.where("decision = 'REVIEW' AND NOT delivered").join(of, "url_id")
    go = ~flagged(F.col("compliance")) if quality_only else F.lit(True)
    return rows.select(F.col("id").alias("file_id"), "url_id", F.when(go, "DELIVER").otherwise("REVIEW").alias("decision"), F.when(go, "classified").otherwise("review").alias("url_status"))


def payload_verdicts(fetched: DataFrame, known: DataFrame, files: DataFrame, urls: DataFrame, allowed: tuple[str, ...] = ("pptx", "ppt"), key: tuple[str, ...] = ("id",)) -> DataFrame:
    """(key columns, verdict) of fetched payloads (id, sha256, magic, method), the first gate that closes: archive (no document from the origin), rejected:bad_magic_bytes, rejected:format_not_allowed:x, duplicate, else downloaded.

    known: (sha256, origin). A hash of another origin than pipeline is always a duplicate; one of the pipeline if another
    live url holds it; and any if a file has it whose url is another or that is delivered. Counted by hash, no pairs are made.
    """
    fmt = F.when(F.col("magic") == "zip", "pptx").when(F.col("magic") == "ole2", "ppt").when(F.col("magic") == "pdf", "pdf")
    origin = known.groupBy("sha256").agg(F.min("origin").alias("origin"))
    side = lambda df, i: df.groupBy("sha256").agg(F.min(i).alias("lo"), F.max(i).alias("hi"))
    live = side(urls.where(F.col("status").isin(*LIVE) & F.col("sha256").isNotNull()), "id").withColumnsRenamed({"lo": "u_lo", "hi": "u_hi"})
    held = files.groupBy("sha256").agg(F.min("url_id").alias("f_lo"), F.max("url_id").alias("f_hi"), F.bool_or("delivered").alias("out"))
    out = fetched.withColumn("_f", fmt).join(origin, "sha256", "left").join(live, "sha256", "left").join(held, "sha256", "left")
    other = lambda lo, hi: F.col(lo).isNotNull() & ((F.col(lo) != F.col("id")) | (F.col(hi) != F.col("id")))
    of_file = F.col("f_lo").isNotNull() & (other("f_lo", "f_hi") | F.col("out"))
    again = F.when(F.col("origin") == "pipeline", other("u_lo", "u_hi") | of_file).when(F.col("origin").isNotNull(), True).otherwise(of_file)
    verdict = (
        F.when(F.col("_f").isNull() & (F.col("method") == "origin"), "archive").when(F.col("_f").isNull(), "rejected:bad_magic_bytes").when(~F.col("_f").isin(*allowed), F.concat(F.lit("rejected:format_not_allowed:"), "_f"))
        .when(again, "duplicate").otherwise("downloaded")
    )
    return out.select(*key, verdict.alias("verdict"))


def delivered(rows: DataFrame, batch: int) -> tuple[DataFrame, DataFrame]:
    """(files and their urls in their state after delivery, the batch's counts)."""
    out = rows.select(F.col("id").alias("file_id"), "url_id", F.lit(batch).alias("batch_id"), F.lit(True).alias("delivered"), F.lit("delivered").alias("url_status"), "quality")
    return out.drop("quality"), batch_counts(out)


def requeued(rows: DataFrame, there: DataFrame) -> DataFrame:
    """Rows (id, name) whose payload is gone: back to discovered, without name and batch."""
    gone = rows.join(there.select("name").distinct(), "name", "left_anti")
    return gone.select("id", F.lit("discovered").alias("status"), F.lit(None).cast("string").alias("delivered_filename"), F.lit(None).cast("long").alias("batch_id"))


def latest(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row of each key: an upsert of all of them in order. Aggregated, so a key's rows meet only as one."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(key, "_r.*")


def added_up(stored: DataFrame, more: DataFrame, key: str, value: str) -> DataFrame:
    """Upsert by addition: (key, value) of both tables summed by key."""
    return stored.select(key, value).union(more.select(key, value)).groupBy(key).agg(F.sum(value).alias(value))


def prune_limit(cap_gb: Column, free_gb: Column, least_gb: Column, safety_gb: float = 3.0) -> Column:
    """Bytes that a backlog may take: its cap, or what the disk holds above its floor and a margin."""
    to_bytes = lambda c: F.floor(c * F.lit(float(1 << 30))).cast("long")
    return F.least(to_bytes(cap_gb.cast("double")), to_bytes(F.greatest(F.lit(0.0), free_gb - least_gb - F.lit(safety_gb))))


def handed_over(urls: DataFrame, share: Column, consumers: int = 1, consumer: int = 0, reason: str = "handoff_export") -> tuple[DataFrame, DataFrame]:
    """(rows of the handoff file, the urls in their state after it): discovered ones of the first `share` of 100 buckets, each for one consumer."""
    from lodestone.functions import urls as U

    b = U.bucket(F.col("url"))
    rows = urls.where("status = 'discovered'").where((b < F.bround(share * 100, 0)) & (b % consumers == consumer))
    return rows.select("url", "domain", "tier", "discovery_source"), rows.select("id", F.lit("filtered_out").alias("status"), F.lit(reason).alias("reject_reason"))


def audit_reason() -> Column:
    """Why an audited image does not pass; null if it does. Columns as for registry.audit_score, and classification."""
    c = F.col
    low = F.when(c("text_density") > F.lit(0.4), "text_heavy").when(c("text_density") > F.lit(0.2), "moderate_text").when(c("colors") <= 2, "low_color_diversity").when((c("pairs") == 0) & (c("lines") < 5), "no_chart_structure").otherwise("low_score")
    return F.when(c("classification") == "reject", low).when(c("classification") == "borderline", "needs_review")


def source_stats(candidates: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """Per discovery_source of candidates (url, discovery_source, n): found, and new ones (urls that are not known yet and that no earlier row brings), within each source's first `limit` rows by n."""
    ranked = candidates.withColumn("_k", F.row_number().over(W.partitionBy("discovery_source").orderBy("n"))).where(F.col("_k") <= limit)
    first = ranked.groupBy("url").agg(F.min_by("discovery_source", "n").alias("discovery_source")).join(known.select("url"), "url", "left_anti")
    new = first.groupBy("discovery_source").agg(F.count("*").alias("new"))
    return ranked.groupBy("discovery_source").agg(F.count("*").alias("found")).join(new, "discovery_source", "left").withColumn("new", F.coalesce("new", F.lit(0).cast("long")))
