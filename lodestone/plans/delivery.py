"""Queries of review, extraction and delivery, and their SQL. Adapters: pages as urls, documents with labels as files, embeddings as rendered pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import urls as U
from lodestone.operators import delivery as D

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _cases(c, *values):
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(c, F.lit(len(values))) + 1).cast("int"))


def urls(spark, d) -> DataFrame:
    p, i = _table(spark, d, "pages"), F.col("page_id")
    return p.select(i.alias("id"), "url", U.domain(F.col("url")).alias("domain"), (i % 7 + 1).cast("int").alias("tier"), _cases(i, "classified", "reserve", "review", "delivered", "downloaded", "discovered").alias("status"), F.lit("generic").alias("discovery_source"), F.sha2(F.col("url"), 256).alias("sha256"))


def files(spark, d) -> DataFrame:
    i = F.col("doc_id")
    rows = _table(spark, d, "documents").join(_table(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "left")
    return rows.select(
        i.alias("id"), (i % 50).alias("url_id"), F.sha2("text", 256).alias("sha256"), F.when(F.col("label") == 1, "HIGH").when(F.col("label") == 0, "MEDIUM").alias("quality"), _cases(i, "REVIEW", "REJECT", "DELIVER", "DELIVER").alias("decision"),
        (i % 7 == 0).alias("delivered"), F.floor(i / 100).alias("batch_id"), F.struct(_cases(i, "PASS", "REVIEW", "PASS", "PASS", "PASS").alias("pii"), F.lit("PASS").alias("minors"), _cases(i, "PASS", "PASS", "review").alias("rights")).alias("compliance"))


def pages(spark, d) -> DataFrame:
    i = F.col("vec_id")
    return _table(spark, d, "embeddings").select(i.alias("id"), (i % 300).alias("file_id"), F.floor(i / 300).alias("page_index"), _cases(i, "pending", "duplicate", "extracted", "extracted").alias("status"), (i % 6 == 0).alias("delivered"), F.floor(i / 100).alias("batch_id"))


BASE = """u AS (SELECT page_id AS id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS domain, CAST(page_id % 7 + 1 AS INTEGER) AS tier, ['classified', 'reserve', 'review', 'delivered', 'downloaded', 'discovered'][1 + page_id % 6] AS status, sha256(url) AS sha256 FROM pages),
f AS (SELECT doc_id AS id, doc_id % 50 AS url_id, sha256(text) AS sha256, CASE l.quality WHEN 1 THEN 'HIGH' WHEN 0 THEN 'MEDIUM' END AS quality, ['REVIEW', 'REJECT', 'DELIVER', 'DELIVER'][1 + doc_id % 4] AS decision, doc_id % 7 = 0 AS delivered, doc_id // 100 AS batch_id,
 ['PASS', 'REVIEW', 'PASS', 'PASS', 'PASS'][1 + doc_id % 5] = 'REVIEW' OR doc_id % 3 = 2 AS flagged FROM documents LEFT JOIN labels l USING (doc_id)),
p AS (SELECT vec_id AS id, vec_id % 300 AS file_id, vec_id // 300 AS page_index, ['pending', 'duplicate', 'extracted', 'extracted'][1 + vec_id % 4] AS status, vec_id % 6 = 0 AS delivered, vec_id // 100 AS batch_id FROM embeddings)"""
COUNTS = "count(*) AS total, count(*) FILTER (quality = 'HIGH') AS high, count(*) FILTER (quality = 'MEDIUM') AS medium"


@query(f"WITH {BASE} SELECT f.id, f.batch_id, u.status AS url_status, u.url AS source_url, u.domain AS source_domain FROM f JOIN u ON u.id = f.url_id WHERE decision = 'DELIVER' AND NOT delivered AND (u.status IN ('classified', 'reserve') OR batch_id = 3)")
def deliverable_files(spark, d):
    return D.deliverable(files(spark, d), urls(spark, d), 3).select("id", "batch_id", "url_status", "source_url", "source_domain")


@query(f"WITH {BASE} SELECT p.id, p.file_id, p.page_index, f.quality, f.sha256 AS source_file_sha256, u.url AS source_url FROM p JOIN f ON f.id = p.file_id JOIN u ON u.id = f.url_id WHERE p.status = 'extracted' AND NOT p.delivered AND (u.status IN ('classified', 'reserve') OR p.batch_id = 2)")
def deliverable_pages(spark, d):
    own = files(spark, d).drop("batch_id", "delivered")
    return D.deliverable_pages(pages(spark, d), own, urls(spark, d), 2).select("id", "file_id", "page_index", "quality", "source_file_sha256", "source_url")


@query(f"WITH {BASE}, c AS (SELECT p.batch_id, {COUNTS} FROM p JOIN f ON f.id = p.file_id GROUP BY 1) SELECT *, high / total::DOUBLE >= 0.7::DOUBLE AND medium / total::DOUBLE <= 0.3::DOUBLE AS composition_ok FROM c")
def batch_page_counts(spark, d):
    return D.batch_counts(pages(spark, d).join(files(spark, d).select(F.col("id").alias("file_id"), "quality"), "file_id"))


@query(f"WITH {BASE} SELECT p.id, p.batch_id, f.id AS file_id, f.quality, u.url AS source_url FROM p LEFT JOIN f ON f.id = p.file_id AND f.decision <> 'REJECT' LEFT JOIN u ON u.id = f.url_id AND u.status <> 'review'")
def finalize_rows(spark, d):
    """Delivered pages keep their row though their file or url is gone."""
    f = files(spark, d).where("decision <> 'REJECT'").select(F.col("id").alias("file_id"), "url_id", "quality")
    u = urls(spark, d).where("status <> 'review'").select(F.col("id").alias("url_id"), F.col("url").alias("source_url"))
    p = pages(spark, d).select("id", "batch_id", F.col("file_id").alias("of"))
    return p.join(f, F.col("of") == F.col("file_id"), "left").join(u, "url_id", "left").select("id", "batch_id", "file_id", "quality", "source_url")


@query("WITH l AS (SELECT doc_id AS id, 'f' || doc_id AS name, n_chars AS size FROM documents), r AS (SELECT 'f' || doc_id AS name, n_chars + CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END AS size FROM documents WHERE doc_id % 5 <> 0) SELECT l.id, EXISTS (SELECT 1 FROM r WHERE r.name = l.name AND r.size = l.size) AS arrived FROM l")
def upload_verify(spark, d):
    """What the remote side lists by name and size; some sizes differ, some files are missing."""
    i = F.col("doc_id")
    local = _table(spark, d, "documents").select(i.alias("id"), F.concat(F.lit("f"), i.cast("string")).alias("name"), F.col("n_chars").alias("size"))
    remote = local.where("id % 5 <> 0").select("name", (F.col("size") + F.when(F.col("id") % 9 == 0, 1).otherwise(0)).alias("size"))
    return D.verified(local, remote).select("id", "arrived")


@query(f"WITH {BASE} SELECT id FROM f WHERE decision = 'DELIVER' AND NOT EXISTS (SELECT 1 FROM p WHERE p.file_id = f.id)")
def files_to_extract(spark, d):
    return D.without_pages(files(spark, d).where("decision = 'DELIVER'"), pages(spark, d)).select("id")


@query(f"WITH {BASE} SELECT id FROM f WHERE delivered AND NOT EXISTS (SELECT 1 FROM p WHERE p.file_id = f.id AND p.status IN ('extracted', 'pending'))")
def payload_cleanup(spark, d):
    return D.without_pages(files(spark, d).where("delivered"), pages(spark, d), ("extracted", "pending")).select("id")


@query(f"WITH {BASE}, v AS (SELECT sha256, min(id) AS first FROM f WHERE id % 3 <> 0 GROUP BY sha256) SELECT f.id, v.first AS vectors_of FROM f LEFT JOIN v USING (sha256)")
def vector_lookup(spark, d):
    """Files with the first stored vectors of their hash; null where there are none."""
    f = files(spark, d).select("id", "sha256")
    return f.join(f.where("id % 3 <> 0").groupBy("sha256").agg(F.min("id").alias("vectors_of")), "sha256", "left").select("id", "vectors_of")


@query(f"WITH {BASE} SELECT f.id AS file_id, url_id, CASE WHEN flagged THEN 'REVIEW' ELSE 'DELIVER' END AS decision, CASE WHEN flagged THEN 'review' ELSE 'classified' END AS url_status FROM f JOIN u ON u.id = f.url_id WHERE decision = 'REVIEW' AND NOT delivered AND u.status = 'review'")
def review_promotion(spark, d):
    return D.promoted(files(spark, d), urls(spark, d), quality_only=True)


@query(f"WITH {BASE} SELECT sha256 FROM (SELECT DISTINCT sha256(text) AS sha256 FROM benchmark UNION SELECT sha256 FROM f WHERE id % 2 = 0) WHERE sha256 NOT IN (SELECT sha256 FROM f WHERE decision <> 'REJECT')")
def orphan_payloads(spark, d):
    """Payloads on disk, named by hash, that no live file needs."""
    f = files(spark, d)
    there = _table(spark, d, "benchmark").select(F.sha2("text", 256).alias("sha256")).union(f.where("id % 2 = 0").select("sha256")).distinct()
    return there.join(f.where("decision <> 'REJECT'").select("sha256"), "sha256", "left_anti")


@query(f"""WITH {BASE}, g AS (SELECT doc_id % 50 AS id, doc_id, sha256(text) AS sha256, CASE doc_id % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'ole2' WHEN 2 THEN NULL ELSE 'zip' END AS magic, CASE WHEN doc_id % 5 = 0 THEN 'wayback' ELSE 'origin' END AS method FROM documents),
k AS (SELECT DISTINCT sha256, 'pipeline' AS origin FROM f WHERE id % 3 = 0 UNION SELECT sha256(text), 'catalog_import' FROM documents WHERE doc_id % 11 = 0), ko AS (SELECT sha256, min(origin) AS origin FROM k GROUP BY 1),
live AS (SELECT id % 40 AS id, sha256 FROM f WHERE id % 2 = 0), held AS (SELECT sha256, url_id, delivered FROM f WHERE id % 4 <> 1)
SELECT doc_id, CASE WHEN magic IS NULL AND method = 'origin' THEN 'archive' WHEN magic IS NULL THEN 'rejected:bad_magic_bytes' WHEN magic = 'pdf' THEN 'rejected:format_not_allowed:pdf'
 WHEN CASE WHEN ko.origin = 'pipeline' THEN EXISTS (SELECT 1 FROM live WHERE live.sha256 = g.sha256 AND live.id <> g.id) OR EXISTS (SELECT 1 FROM held WHERE held.sha256 = g.sha256 AND (held.url_id <> g.id OR held.delivered))
  WHEN ko.origin IS NOT NULL THEN true ELSE EXISTS (SELECT 1 FROM held WHERE held.sha256 = g.sha256 AND (held.url_id <> g.id OR held.delivered)) END THEN 'duplicate' ELSE 'downloaded' END AS verdict FROM g LEFT JOIN ko USING (sha256)""")
def payload_gates(spark, d):
    f, i = files(spark, d), F.col("doc_id")
    docs = _table(spark, d, "documents")
    got = docs.select(i, (i % 50).alias("url"), F.sha2("text", 256).alias("sha256"), _cases(i, "pdf", "ole2", None, "zip", "zip", "zip").alias("magic"), F.when(i % 5 == 0, "wayback").otherwise("origin").alias("method"))
    known = f.where("id % 3 = 0").select("sha256", F.lit("pipeline").alias("origin")).union(docs.where("doc_id % 11 = 0").select(F.sha2("text", 256), F.lit("catalog_import")))
    live = f.where("id % 2 = 0").select((F.col("id") % 40).alias("id"), "sha256", F.lit("classified").alias("status"))
    return D.payload_verdicts(got.withColumnsRenamed({"url": "id"}), known, f.where("id % 4 <> 1"), live, key=("doc_id",))


@query(f"WITH {BASE} SELECT coalesce(quality, 'unclassified') AS quality, count(*) AS n FROM f GROUP BY 1")
def quality_counts(spark, d):
    return files(spark, d).groupBy(F.coalesce("quality", F.lit("unclassified")).alias("quality")).agg(F.count("*").alias("n"))


@query(f"WITH {BASE}, c AS (SELECT batch_id, {COUNTS} FROM f WHERE quality IS NOT NULL GROUP BY 1) SELECT batch_id, total, CASE WHEN total >= 40 AND high / total::DOUBLE >= 0.7::DOUBLE AND medium / total::DOUBLE <= 0.3::DOUBLE THEN 'packing' WHEN total >= 40 THEN 'held' WHEN batch_id % 30 >= 14 THEN 'due' ELSE 'open' END AS state FROM c")
def batch_state(spark, d):
    c = D.batch_counts(files(spark, d).where("quality IS NOT NULL")).withColumn("age_days", F.col("batch_id") % 30)
    return D.batch_states(c, 40).select("batch_id", "total", "state")


@query("SELECT doc_id AS id, 'discovered' AS status, CAST(NULL AS VARCHAR) AS delivered_filename, CAST(NULL AS BIGINT) AS batch_id FROM documents WHERE 'f' || doc_id % 97 NOT IN (SELECT 'f' || doc_id % 97 FROM documents WHERE doc_id % 97 < 60)")
def requeue_missing(spark, d):
    i = F.concat(F.lit("f"), (F.col("doc_id") % 97).cast("string"))
    rows = _table(spark, d, "documents").select(F.col("doc_id").alias("id"), i.alias("name"))
    return D.requeued(rows, rows.where("id % 97 < 60"))


@query(f"WITH {BASE} SELECT id AS file_id, url_id, CAST(9 AS INTEGER) AS batch_id, true AS delivered, 'delivered' AS url_status FROM f WHERE quality = 'HIGH' AND decision = 'DELIVER'")
def mark_delivered(spark, d):
    return D.delivered(files(spark, d).where("quality = 'HIGH' AND decision = 'DELIVER'"), 9)[0]


@query("WITH l AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) SELECT user_id, event_type, value FROM l WHERE k = 1")
def latest_rows(spark, d):
    e = _table(spark, d, "events").select("user_id", "event_type", "value", "ts", "event_id")
    return D.latest(e, "user_id", F.struct("ts", "event_id")).select("user_id", "event_type", "value")


@query("SELECT day, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT CAST(ts AS DATE) AS day, CAST(value * 100 AS BIGINT) AS bytes FROM events UNION ALL SELECT CAST(l_shipdate AS DATE), CAST(l_quantity AS BIGINT) FROM lineitem) GROUP BY day")
def budget_upsert(spark, d):
    """Bytes used by day: what is stored and what is added."""
    stored = _table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_quantity").cast("long").alias("bytes"))
    more = _table(spark, d, "events").select(F.to_date("ts").alias("day"), F.round(F.col("value") * 100).cast("long").alias("bytes"))
    return D.added_up(stored, more, "day", "bytes")


@query("SELECT p_partkey, least(CAST(floor(p_size * 1073741824.0::DOUBLE) AS BIGINT), CAST(floor(greatest(0.0::DOUBLE, p_retailprice / 50 - 4 - 3) * 1073741824.0::DOUBLE) AS BIGINT)) AS bytes FROM part")
def prune_limits(spark, d):
    """Parts as machines: their size as the cap, a share of their price as the free space, four to be left."""
    return _table(spark, d, "part").select("p_partkey", D.prune_limit(F.col("p_size"), F.col("p_retailprice") / 50, F.lit(4)).alias("bytes"))


@query(f"WITH {BASE}, b AS (SELECT *, CAST(CAST('0x' || substr(sha1(url), 1, 8) AS UBIGINT) % 100 AS BIGINT) AS b FROM u WHERE status = 'discovered') SELECT id, 'filtered_out' AS status, 'handoff_export' AS reject_reason FROM b WHERE b < 60 AND b % 2 = 1")
def handoff_export(spark, d):
    return D.handed_over(urls(spark, d), F.lit(0.6), 2, 1)[1]


@query("""WITH f AS (SELECT vec_id, abs(embedding[1]::DOUBLE) * 4 AS text_density, CAST(floor(abs(embedding[2]::DOUBLE) * 30) AS INTEGER) AS pairs, CAST(floor(abs(embedding[3]::DOUBLE) * 50) AS INTEGER) AS lines, CAST(floor(abs(embedding[4]::DOUBLE) * 60) AS INTEGER) AS colors FROM embeddings),
c AS (SELECT *, CASE WHEN vec_id % 3 = 0 THEN 'pass' WHEN vec_id % 3 = 1 THEN 'borderline' ELSE 'reject' END AS classification FROM f)
SELECT vec_id, classification, CASE WHEN classification = 'reject' THEN CASE WHEN text_density > 0.4::DOUBLE THEN 'text_heavy' WHEN text_density > 0.2::DOUBLE THEN 'moderate_text' WHEN colors <= 2 THEN 'low_color_diversity' WHEN pairs = 0 AND lines < 5 THEN 'no_chart_structure' ELSE 'low_score' END WHEN classification = 'borderline' THEN 'needs_review' END AS reason FROM c""")
def audit_reasons(spark, d):
    x = lambda i, k: F.floor(F.abs(F.col("embedding")[i].cast("double")) * k).cast("int")
    f = _table(spark, d, "embeddings").select("vec_id", (F.abs(F.col("embedding")[0].cast("double")) * 4).alias("text_density"), x(1, 30).alias("pairs"), x(2, 50).alias("lines"), x(3, 60).alias("colors"), _cases(F.col("vec_id"), "pass", "borderline", "reject").alias("classification"))
    return f.select("vec_id", "classification", D.audit_reason().alias("reason"))


@query("""WITH c AS (SELECT doc_id AS n, 'http://x/' || doc_id % 300 AS url, source AS discovery_source FROM documents), r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY discovery_source ORDER BY n) AS k FROM c) WHERE k <= 120),
g AS (SELECT url, arg_min(discovery_source, n) AS discovery_source FROM r WHERE url NOT IN (SELECT 'http://x/' || page_id FROM pages WHERE page_id % 3 = 0) GROUP BY url)
SELECT r.discovery_source, count(*) AS found, (SELECT count(*) FROM g WHERE g.discovery_source = r.discovery_source) AS new FROM r GROUP BY r.discovery_source""")
def source_stats(spark, d):
    """Sources of documents as sources of urls, each with a limit, against the known ones."""
    name = lambda c: F.concat(F.lit("http://x/"), c.cast("string"))
    c = _table(spark, d, "documents").select(F.col("doc_id").alias("n"), name(F.col("doc_id") % 300).alias("url"), F.col("source").alias("discovery_source"))
    known = _table(spark, d, "pages").where("page_id % 3 = 0").select(name(F.col("page_id")).alias("url"))
    return D.source_stats(c, known, 120)


@query("SELECT page_id, CASE WHEN last = '' THEN 'unnamed' ELSE last END AS name FROM (SELECT page_id, regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) AS last FROM pages)")
def url_file_names(spark, d):
    return _table(spark, d, "pages").select("page_id", U.file_name(F.col("url")).alias("name"))


@query("SELECT event_id, status = 403 OR status = 429 OR status BETWEEN 500 AND 599 AS retry FROM (SELECT event_id, [200, 403, 404, 429, 503, 301, 600][1 + event_id % 7] AS status FROM events)")
def retryable_fetches(spark, d):
    return _table(spark, d, "events").select("event_id", D.retryable(_cases(F.col("event_id"), 200, 403, 404, 429, 503, 301, 600)).alias("retry"))


@query(f"WITH {BASE} SELECT id, page_index FROM p WHERE delivered ORDER BY id DESC LIMIT 100")
def recent_pages(spark, d):
    """The latest delivered pages, of a number fixed by the lookback."""
    return pages(spark, d).where("delivered").orderBy(F.desc("id")).limit(2 * 50).select("id", "page_index")
