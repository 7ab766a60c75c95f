"""Readers: url indexes, seed lists, catalogs, handoff files, hash lists, sidecars, decks and images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import urls as U
from lodestone.sources.decks import pptx_slides  # noqa: F401

CANDIDATE = "url string, domain string, tier int, discovery_source string, metadata map<string,string>"


def url_index(spark: SparkSession, path: str, extensions: tuple[str, ...]) -> DataFrame:
    """(url, fetch_status) of a Parquet url index: fetched with 200 or unknown, with one of the suffixes. Two columns are read; the status is pushed to the scan."""
    rows = spark.read.parquet(path).select("url", "fetch_status").where((F.col("fetch_status") == 200) | F.col("fetch_status").isNull())
    ok = F.lit(False)
    for e in extensions:
        ok = ok | F.lower("url").endswith(e)
    return rows.where(ok)


def undone_parts(parts: DataFrame, cursor: DataFrame) -> DataFrame:
    """Parts (part) that the cursor doesn't hold yet."""
    return parts.join(cursor.select("part"), "part", "left_anti")


def crawl_parts(spark: SparkSession, path: str) -> DataFrame:
    """Part paths of a (gzipped) manifest: Parquet parts of the warc subset."""
    return spark.read.text(path).where(F.col("value").contains("/subset=warc/") & F.col("value").endswith(".parquet")).select(F.trim("value").alias("part"))


def cdx_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a capture index with status 200; lines that don't parse are dropped."""
    rows = spark.read.schema("url string, status string, mime string").option("mode", "DROPMALFORMED").json(path)
    return rows.where("status = '200' AND url IS NOT NULL")


def cdx_array(responses: DataFrame, drop: tuple[str, ...] = ("htm", "html", "pdf", "zip", "doc", "docx")) -> DataFrame:
    """Captures from responses (body): a JSON array of arrays, the first of which names the columns."""
    rows = responses.select(F.from_json("body", "array<array<string>>").alias("a")).where(F.size("a") > 1)
    rows = rows.select(F.col("a")[0].alias("names"), F.explode(F.slice("a", F.lit(2), F.size("a"))).alias("v"))
    rows = rows.select(F.map_from_arrays("names", "v").alias("m")).select(F.col("m")["original"].alias("url"), F.col("m")["timestamp"].alias("timestamp"))
    suffix = F.lower(F.regexp_extract(U.path(F.col("url")), r"\.([A-Za-z0-9]+)$", 1))
    return rows.where(~suffix.isin(*drop))


def seed_domains(spark: SparkSession, path: str, urls: DataFrame) -> DataFrame:
    """Domains of a seed file (# comments, lower-cased) and of known urls without www., sorted."""
    seeds = spark.read.text(path).select(F.lower(F.trim(F.regexp_replace("value", "#.*$", ""))).alias("domain"))
    known = urls.select(F.regexp_replace("domain", r"^www\.", "").alias("domain"))
    return seeds.union(known).where("domain <> ''").distinct().orderBy("domain")


def blocklist(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(domains, regexes) of a blocklist: one entry a line, # comments, re: marks a regex."""
    lines = spark.read.text(path).select(F.trim("value").alias("entry")).where("entry <> '' AND NOT startswith(entry, '#')")
    return lines.where("NOT startswith(entry, 're:')").select(F.lower("entry").alias("entry")), lines.where("startswith(entry, 're:')").select(F.expr("substr(entry, 4)").alias("regex"))


def catalog_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Distinct 64-hex hashes of a text or CSV catalog, lower-cased; # comment lines are left out."""
    lines = spark.read.text(path).where("NOT startswith(trim(value), '#')")
    return lines.select(F.explode(F.regexp_extract_all("value", F.lit(r"\b([0-9A-Fa-f]{64})\b"), F.lit(1))).alias("h")).select(F.lower("h").alias("sha256")).distinct()


def folder_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size) of all files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def handoff(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a handoff CSV; metadata is JSON (bad JSON: empty) and gets handoff=true; blank urls are dropped."""
    rows = spark.read.option("header", "true").option("escape", '"').schema("url string, domain string, tier int, discovery_source string, metadata string").csv(path)
    empty = F.create_map().cast("map<string,string>")
    meta = F.map_filter(F.coalesce(F.from_json("metadata", "map<string,string>"), empty), lambda k, v: k != "handoff")
    return rows.where("trim(url) <> ''").withColumn("metadata", F.map_concat(meta, F.create_map(F.lit("handoff"), F.lit("true"))))


def vectors(spark: SparkSession, path: str) -> DataFrame:
    """First row of each sha256 of a (gzipped) JSON-lines export; lines that don't parse are dropped."""
    rows = spark.read.schema("sha256 string, quality string, format string, slide_count int, decision string, feature_vectors array<map<string,string>>").option("mode", "DROPMALFORMED").json(path)
    return rows.where("length(sha256) = 64").withColumn("_n", F.monotonically_increasing_id()).groupBy("sha256").agg(F.min_by(F.struct("quality", "format", "slide_count", "decision", "feature_vectors"), "_n").alias("r")).select("sha256", "r.*")


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, name, source_url, size) of *.metadata.json below a folder; without hash or name a sidecar is left out, a bad size is 0."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.metadata.json").text(path, wholetext=True)
    j = lambda k: F.get_json_object("value", f"$.{k}")
    size = F.coalesce(F.try_to_number(j("size"), F.lit("999999999999999")).cast("long"), F.try_to_number(j("content_length"), F.lit("999999999999999")).cast("long"), F.lit(0).cast("long"))
    return rows.select(F.lower(F.trim(j("sha256"))).alias("sha256"), F.trim(j("delivered_filename")).alias("name"), j("source_url").alias("source_url"), size.alias("size")).where("sha256 <> '' AND name <> ''")


def doc_links(html: Column) -> Column:
    """Links to presentations in href, src, data-url or file attributes."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)(?:href|src|data-url|file)\s*=\s*["']([^"']+?\.pptx?)(?:\?[^"']*)?["']"""), F.lit(1))


def exploded_files(records: DataFrame, files: str, url: str, extensions: tuple[str, ...], source: str) -> DataFrame:
    """Candidates from repository records that hold an array of file structs: those whose url has one of the suffixes."""
    rows = records.select(F.explode(files).alias("f")).select(F.col(f"f.{url}").alias("url"))
    return rows.where(U.extension_ok(F.col("url"), extensions)).select("url", U.domain(F.col("url")).alias("domain"), F.lit(source).alias("discovery_source"))


def sitemap_walk(spark: SparkSession, roots: DataFrame, pages: DataFrame, depth: int = 4) -> DataFrame:
    """(url, depth) of all <loc> entries reached from roots (url) through pages (url, body): a sitemap's entries that are pages of the table are walked further, each url once."""
    locs = pages.select(F.col("url").alias("parent"), F.explode(F.regexp_extract_all("body", F.lit(r"(?is)<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))).alias("url"))
    seen = now = roots.select("url").distinct().withColumn("depth", F.lit(0))
    for level in range(1, depth + 1):  # bounded by depth; each level is one join
        now = now.select(F.col("url").alias("parent")).join(locs, "parent").select("url").distinct().join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(level))
        seen = seen.union(now)
    return seen


def pictures(spark: SparkSession, path: str) -> DataFrame:
    """Images under a folder, decoded by the JVM: id (the path), width, height and rgb (three bytes a pixel); null pixels for what is no image."""

    @F.pandas_udf("binary")
    def ordered(data: pd.Series, channels: pd.Series) -> pd.Series:
        out = []
        for d, n in zip(data, channels):
            px = np.frombuffer(bytes(d), np.uint8).reshape(-1, int(n)) if n in (1, 3, 4) else None
            # Three or four channels come blue first.
            out.append(None if px is None else (px.repeat(3, 1) if n == 1 else px[:, 2::-1]).tobytes())
        return pd.Series(out, dtype=object)

    i = spark.read.format("image").option("recursiveFileLookup", "true").load(path).select("image.*")
    return i.select(F.col("origin").alias("id"), F.nullif("width", F.lit(-1)).alias("width"), F.nullif("height", F.lit(-1)).alias("height"), ordered("data", "nChannels").alias("rgb"))


def grey(pictures: DataFrame) -> DataFrame:
    """id, width, height and grey (one byte a pixel, luma in 16-bit fixed point) of colour images."""

    @F.pandas_udf("binary")
    def luma(rgb: pd.Series) -> pd.Series:
        mixed = lambda d: ((np.frombuffer(bytes(d), np.uint8).reshape(-1, 3).astype(np.int64) @ np.array([19595, 38470, 7471]) + 0x8000) >> 16).astype(np.uint8)
        return pd.Series([None if d is None else mixed(d).tobytes() for d in rgb], dtype=object)

    return pictures.select("id", "width", "height", luma("rgb").alias("grey"))


def sniffed(content: Column) -> Column:
    """zip, pdf, ole2 or null by the first bytes."""
    head = F.hex(F.substring(content, 1, 8))
    return F.when(head.startswith("504B0304"), "zip").when(head.startswith("25504446"), "pdf").when(head.startswith("D0CF11E0A1B11AE1"), "ole2")
