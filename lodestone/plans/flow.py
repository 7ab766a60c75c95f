"""Queries of extraction, composed screens and discovery from responses, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import screens as S
from lodestone.functions import urls as U
from lodestone.operators import extraction
from lodestone.operators.dedup import sign_hash
from lodestone.sources import responses as R

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _cases(c, *values):
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(c, F.lit(len(values))) + 1).cast("int"))


@query("""WITH p AS (SELECT vec_id // 7 AS file_id, CAST(vec_id % 7 AS INTEGER) AS page_index, CASE WHEN vec_id % 11 <> 0 THEN sha256(CAST(vec_id % 450 AS VARCHAR)) END AS sha256,
 CASE WHEN vec_id % 11 <> 0 THEN list_sum([CASE WHEN embedding[i] > 0 THEN CAST(1 AS HUGEINT) << (i - 1) ELSE 0 END FOR i IN range(1, 65)]) END AS h FROM embeddings WHERE vec_id % 5 <> 0 AND (vec_id // 7) % 4 <> 0),
r AS (SELECT file_id, page_index, CASE WHEN sha256 IS NULL THEN 'not_rendered' WHEN EXISTS (SELECT 1 FROM p e WHERE e.sha256 = p.sha256 AND (e.file_id < p.file_id OR (e.file_id = p.file_id AND e.page_index < p.page_index))) THEN 'exact'
 WHEN EXISTS (SELECT 1 FROM p e WHERE e.file_id < p.file_id AND bit_count(xor(e.h, p.h)) <= 18) THEN 'near' END AS reason FROM p)
SELECT file_id, page_index, CASE reason WHEN 'not_rendered' THEN 'rejected' WHEN 'exact' THEN 'duplicate' WHEN 'near' THEN 'duplicate' ELSE 'extracted' END AS status, reason FROM r
UNION ALL SELECT DISTINCT vec_id // 7, -1, 'rejected', 'no_graphical_pages' FROM embeddings WHERE vec_id // 7 NOT IN (SELECT file_id FROM p)""")
def extraction_flow(spark, d):
    """Embeddings as pages, seven to a file, of which a fourth has none worth delivering."""
    i = F.col("vec_id")
    rendered = i % 11 != 0
    pages = _table(spark, d, "embeddings").select(
        F.floor(i / 7).alias("file_id"), (i % 7).cast("int").alias("page_index"), ((i % 5 != 0) & (F.floor(i / 7) % 4 != 0)).alias("selected"),
        F.when(rendered, F.sha2((i % 450).cast("string"), 256)).alias("sha256"), F.when(rendered, sign_hash(F.col("embedding"))).alias("phash"))
    return extraction.extracted(pages.select(F.col("file_id").alias("id")).distinct(), pages, 18)


@query(r"""WITH e AS (SELECT doc_id, coalesce(text, '') AS t, doc_id % 3 AS r, CASE WHEN doc_id % 40 = 0 THEN 'example.net' END AS entry, len(list_filter(regexp_extract_all(coalesce(text, ''), '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b'), lambda x: NOT regexp_matches(lower(x), 'info@|contact@|press@|media@|ir@|investor|office@|support@|sales@|hello@|admin@|webmaster@|enquiries@|communications@|pr@|news@'))) AS m,
 len(regexp_extract_all(coalesce(text, ''), '\b\d{3}-\d{2}-\d{4}\b')) AS s, len(regexp_extract_all(coalesce(text, ''), '(?i)\b(?:passport|national id|nationalid|driver''?s licen[cs]e|tax id|nino|ssn)\b[^\n]{0,20}?[:#]?\s*[A-Z0-9][A-Z0-9\-]{5,}')) AS n FROM documents)
SELECT doc_id, CASE WHEN entry IS NULL THEN 'PASS' ELSE 'REJECT' END AS pirate, 'blocklist match: ' || entry AS pirate_detail, CASE r WHEN 1 THEN 'REJECT' ELSE 'PASS' END AS robots,
 CASE r WHEN 1 THEN 'robots.txt disallowed' WHEN 2 THEN 'robots.txt unavailable at fetch time (treated as allow)' END AS robots_detail, CASE WHEN s > 0 OR n > 0 OR m > 3 THEN 'REVIEW' ELSE 'PASS' END AS pii,
 nullif(concat_ws('; ', CASE WHEN s > 0 THEN s || ' SSN-like patterns' END, CASE WHEN n > 0 THEN n || ' ID-number patterns' END, CASE WHEN m > 3 THEN m || ' non-organizational email addresses' END), '') AS pii_detail FROM e""")
def screen_details(spark, d):
    """Screens with what they found; phones and notices need look-around, which the SQL lacks: see screen_findings."""
    i = F.col("doc_id")
    s = S.findings(F.col("text"), _cases(i, "allowed", "disallowed", "unavailable"), F.when(i % 40 == 0, "example.net"), phones=False)
    f = _table(spark, d, "documents").select("doc_id", s.alias("s"))
    return f.select("doc_id", "s.pirate", F.col("s.details")["pirate"].alias("pirate_detail"), "s.robots", F.col("s.details")["robots"].alias("robots_detail"), "s.pii", F.col("s.details")["pii"].alias("pii_detail"))


@query()
def screen_findings(spark, d):
    """All screens of all documents."""
    s = S.findings(F.col("text"), F.lit("allowed"), F.lit(None).cast("string"))
    f = _table(spark, d, "documents").select("doc_id", s.alias("s")).select("doc_id", "s.*")
    return f.withColumn("details", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("details")))))


@query("""SELECT page_id, greatest(CASE WHEN host = 'example.org' OR host LIKE '%.example.org' THEN 5.0::DOUBLE WHEN host = 'blog.example.com' OR host LIKE '%.blog.example.com' THEN 0.5::DOUBLE ELSE 2.0::DOUBLE END,
 [0.0::DOUBLE, 1.0::DOUBLE, 8.0::DOUBLE][1 + page_id % 3]) AS seconds FROM (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host FROM pages)""")
def politeness_delays(spark, d):
    """Seconds between requests to each page's host."""
    own = _cases(F.col("page_id"), 0.0, 1.0, 8.0)
    return _table(spark, d, "pages").select("page_id", U.base_delay(U.domain(F.col("url")), {"example.org": 5.0, "blog.example.com": 0.5}, 2.0, own).alias("seconds"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'F' || page_id WHEN 1 THEN 'G' || page_id ELSE '' END AS folder FROM pages""")
def folder_ids(spark, d):
    """Folders by the two forms of their urls, and urls of other kinds."""
    i = F.col("page_id").cast("string")
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://drive.google.com/drive/folders/F"), i)).when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://drive.google.com/drive/u/0/folders/G"), i, F.lit("/?usp=sharing"))).otherwise(F.col("url"))
    return _table(spark, d, "pages").select("page_id", U.folder_id(url).alias("folder"))


@query("""SELECT CASE WHEN page_id % 3 = 0 THEN 'https://h.example/a' || page_id || '.pptx' WHEN page_id % 3 = 1 THEN 'http://' || 'x' || page_id || '.example/d.ppt' ELSE 'https://o.example/' || page_id // 2 || '.pptx' END AS url,
 CASE WHEN page_id % 3 = 0 THEN 'h.example' WHEN page_id % 3 = 1 THEN 'x' || page_id || '.example' ELSE 'o.example' END AS domain, ['html', 'json', 'oai'][1 + page_id % 3] AS discovery_source FROM pages""")
def response_candidates(spark, d):
    """Pages as responses of three kinds, each of which names a document and something else."""
    i, s = F.col("page_id").cast("string"), F.lit
    html = F.concat(s("<a href='../a"), i, s(".pptx?v=1'>a</a><a href='b.pdf'>b</a>"))
    answer = F.concat(s('{"items": [{"file": {"url": " http://x'), i, s('.example/d.ppt"}}, {"url": "http://x.example/d.txt"}], "n": 1}'))
    record = F.concat(s("<dc:identifier> https://o.example/"), F.floor(F.col("page_id") / 2).cast("string"), s(".pptx </dc:identifier><dc:identifier>doi:1</dc:identifier>"))
    method = _cases(F.col("page_id"), "html", "json", "oai")
    rows = _table(spark, d, "pages").select(method.alias("source"), method.alias("method"), s("https://h.example/x/y").alias("url"), F.when(method == "html", html).when(method == "json", answer).otherwise(record).alias("body"))
    return R.candidates(rows)


@query("""WITH c AS (SELECT label, [embedding[1]::DOUBLE > 0.1::DOUBLE, embedding[1]::DOUBLE < -0.1::DOUBLE] AS b FROM embeddings)
SELECT label, count(*) AS total, count(*) FILTER (b[1]) AS pass, count(*) FILTER (b[2]) AS reject, count(*) FILTER (NOT b[1] AND NOT b[2]) AS borderline,
 CAST(floor(count(*) FILTER (b[1]) * 1000.0::DOUBLE / count(*) + 0.5::DOUBLE) AS BIGINT) AS pass_permille FROM c GROUP BY label""")
def band_totals(spark, d):
    """Totals of the bands of a scoring run, by label."""
    x = F.col("embedding")[0].cast("double")
    band = F.when(x > 0.1, "pass").when(x < -0.1, "reject").otherwise("borderline")
    n = lambda b: F.count_if(F.col("band") == b)
    c = _table(spark, d, "embeddings").select("label", band.alias("band")).groupBy("label")
    return c.agg(F.count("*").alias("total"), *[n(b).alias(b) for b in ("pass", "reject", "borderline")], F.floor(n("pass") * F.lit(1000.0) / F.count("*") + 0.5).alias("pass_permille"))
