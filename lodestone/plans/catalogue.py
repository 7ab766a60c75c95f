"""The engine's own queries: name -> callable(spark, sf_dir), and the SQL that says the same.

Adapters read the driver's tables as the registry's: pages as candidate urls,
lineitem as slides of decks, documents with labels as files, events as fetches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import decks as D
from lodestone.functions import robots, screens as S
from lodestone.functions import urls as U
from lodestone.operators import dedup, delivery, drawings, events as E, filtering, images, packaging, pictures, registry as R
from lodestone.operators.ordered import running
from lodestone.plans import delivery as delivery_plans
from lodestone.plans import flow
from lodestone.sources import sinks

QUERIES: dict = dict(delivery_plans.QUERIES) | flow.QUERIES
SQL: dict[str, str] = dict(delivery_plans.SQL) | flow.SQL


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SOURCES = ("commoncrawl", "zenodo", "federal", "wayback_cdx", "generic")
BLOCKED = ("spam-farm.example.org", "cheap-pills.example.com", "example.info")


def urls(spark, d) -> DataFrame:
    p = table(spark, d, "pages").select(F.col("page_id").alias("id"), "url")
    pick = F.element_at(F.array(*map(F.lit, SOURCES)), (F.col("id") % 5 + 1).cast("int"))
    return p.withColumn("domain", U.domain(F.col("url"))).withColumn("tier", (F.col("id") % 7 + 1).cast("int")).withColumn("discovery_source", pick).withColumn("status", F.when(F.col("id") % 3 == 0, "parked").when(F.col("id") % 11 == 0, "delivered").otherwise("discovered"))


URLS = """urls AS (SELECT page_id AS id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS domain, CAST(page_id % 7 + 1 AS INTEGER) AS tier,
 ['commoncrawl','zenodo','federal','wayback_cdx','generic'][1 + page_id % 5] AS discovery_source, CASE WHEN page_id % 3 = 0 THEN 'parked' WHEN page_id % 11 = 0 THEN 'delivered' ELSE 'discovered' END AS status FROM pages)"""
BLOCKED_SQL = r"""blocked AS (SELECT id, coalesce(first(e ORDER BY length(e) DESC), any_value(re)) AS entry FROM (
 SELECT id, b.e, CASE WHEN regexp_matches(url, '(?i)/77[0-9]+') THEN 're:/77[0-9]+' END AS re FROM urls LEFT JOIN (VALUES ('spam-farm.example.org'), ('cheap-pills.example.com'), ('example.info')) b(e)
 ON regexp_replace(domain, ':.*$', '') = e OR regexp_replace(domain, ':.*$', '') LIKE '%.' || e) GROUP BY id HAVING entry IS NOT NULL)"""
REASONS = rf"""{URLS}, {BLOCKED_SQL}, ex AS (SELECT id, 'example.net' AS entry FROM urls WHERE domain = 'example.net' OR domain LIKE '%.example.net'),
st AS (SELECT urls.*, CASE WHEN tier = 5 THEN 1 ELSE 3 END AS cap, CASE WHEN NOT regexp_matches(url, '^https?://[^/?#]+') THEN 'malformed_url' WHEN blocked.entry IS NOT NULL THEN 'blocklist:' || blocked.entry WHEN ex.entry IS NOT NULL THEN 'excluded_source:' || ex.entry
 WHEN NOT (discovery_source LIKE 'wayback%' OR discovery_source LIKE 'zenodo%') AND NOT ends_with(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '.html') THEN 'extension' END AS s FROM urls LEFT JOIN blocked USING (id) LEFT JOIN ex USING (id) WHERE status = 'discovered'),
base AS (SELECT domain, count(*) AS n FROM urls WHERE status NOT IN ('discovered', 'filtered_out') GROUP BY domain),
u AS (SELECT st.*, coalesce(n, 0) AS base, row_number() OVER (PARTITION BY domain ORDER BY id) AS k FROM st LEFT JOIN base USING (domain) WHERE s IS NULL),
walk AS (SELECT id, domain, k, base < cap AS kept, base + CASE WHEN base < cap THEN 1 ELSE 0 END AS n FROM u WHERE k = 1
 UNION ALL SELECT u.id, u.domain, u.k, walk.n < u.cap, walk.n + CASE WHEN walk.n < u.cap THEN 1 ELSE 0 END FROM walk JOIN u ON u.domain = walk.domain AND u.k = walk.k + 1),
r AS (SELECT st.id, st.domain, discovery_source, coalesce(s, CASE WHEN kept THEN 'kept' ELSE 'domain_cap:' || cap END) AS reason FROM st LEFT JOIN walk USING (id))"""


def _blocked(spark) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, BLOCKED))).alias("entry"))


PATTERNS = ("/77[0-9]+",)


def _reasons(spark, d):
    excluded = spark.range(1).select(F.lit("example.net").alias("entry"))
    return filtering.filter_reasons(urls(spark, d), _blocked(spark), (".html",), 3, {5: 1}, excluded, PATTERNS)


@query(f"WITH RECURSIVE {REASONS} SELECT id, domain, reason FROM r")
def url_filter_reasons(spark, d):
    return _reasons(spark, d).select("id", "domain", "reason")


@query(f"WITH RECURSIVE {REASONS} SELECT discovery_source, regexp_replace(reason, ':.*$', '') AS reason, count(*) AS n FROM r GROUP BY ALL")
def url_filter_summary(spark, d):
    return _reasons(spark, d).groupBy("discovery_source", F.regexp_replace("reason", ":.*$", "").alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {URLS}, {BLOCKED_SQL} SELECT id, entry FROM blocked")
def blocklist_hits(spark, d):
    return filtering.blocklist_entry(urls(spark, d), _blocked(spark), PATTERNS)


@query("""WITH RECURSIVE u AS (SELECT user_id, event_id, CASE WHEN event_id % 5 = 0 THEN 3 ELSE 6 END AS cap, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
r AS (SELECT user_id, event_id, k, cap > 0 AS kept, 1 AS n FROM u WHERE k = 1
UNION ALL SELECT u.user_id, u.event_id, u.k, r.n < u.cap, r.n + CASE WHEN r.n < u.cap THEN 1 ELSE 0 END FROM r JOIN u ON u.user_id = r.user_id AND u.k = r.k + 1)
SELECT event_id, kept FROM r""")
def domain_cap_mixed(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_id") % 5 == 0, 3).otherwise(6).alias("cap"))
    return filtering.mixed_caps(e, [3, 6], "user_id", "event_id").select("event_id", "kept")


@query("""WITH h AS (SELECT event_id, [200, 403, 404, 429, 503, 200, 200][1 + event_id % 7] AS status, CASE WHEN event_type = 'view' THEN 'Text/HTML; charset=utf-8' ELSE 'application/octet-stream' END AS ctype, CAST(value * 1000 AS BIGINT) AS clen FROM events)
SELECT event_id, CASE WHEN status = 429 OR status >= 500 THEN 'retry' WHEN status >= 400 THEN 'ok' WHEN starts_with(trim(split_part(lower(ctype), ';', 1)), 'text/html') THEN 'skip_html' WHEN clen < 10000 OR clen > 90000 THEN 'skip_size' ELSE 'ok' END AS verdict FROM h""")
def head_verdicts(spark, d):
    e = table(spark, d, "events")
    status = F.element_at(F.array(*[F.lit(x) for x in (200, 403, 404, 429, 503, 200, 200)]), (F.col("event_id") % 7 + 1).cast("int"))
    h = e.select("event_id", status.alias("status"), F.when(F.col("event_type") == "view", "Text/HTML; charset=utf-8").otherwise("application/octet-stream").alias("ctype"), F.round(F.col("value") * 1000).cast("long").alias("clen"))
    return h.select("event_id", E.head_verdict(F.col("status"), F.col("ctype"), F.col("clen"), 90_000, 10_000).alias("verdict"))


LINKS = """WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']([^"'']+)["'']', 1)) AS link FROM pages),
a AS (SELECT page_id, link, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link WHEN starts_with(link, '//') THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || link ELSE regexp_extract(url, '^([a-z]+):', 1) || '://' || lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) || link END AS absolute FROM l)"""


def _links(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']([^"']+)["']"""), F.lit(1))).alias("link"))


@query(LINKS + " SELECT page_id, count(*) AS links, count(DISTINCT link) AS distinct_links FROM a GROUP BY page_id")
def link_extraction(spark, d):
    return _links(spark, d).groupBy("page_id").agg(F.count("*").alias("links"), F.count_distinct("link").alias("distinct_links"))


@query(LINKS + " SELECT page_id, link, absolute FROM a")
def absolutize_links(spark, d):
    return _links(spark, d).select("page_id", "link", U.absolute(F.col("url"), F.col("link")).alias("absolute"))


@query(f"WITH {URLS} SELECT id, CAST(CAST('0x' || substr(sha1(domain), 1, 16) AS UHUGEINT) % 4 AS INTEGER) AS owner, CAST(CAST('0x' || substr(sha1(url), 1, 8) AS UBIGINT) % 100 AS BIGINT) AS bucket FROM urls")
def url_shards(spark, d):
    return urls(spark, d).select("id", U.shard(F.col("domain"), 4).alias("owner"), U.bucket(F.col("url")).alias("bucket"))


@query(f"WITH {URLS}, b AS (SELECT id, CAST(CAST('0x' || substr(sha1(url), 1, 8) AS UBIGINT) % 100 AS BIGINT) AS bucket FROM urls) SELECT id, CAST(bucket % 2 AS BIGINT) AS consumer FROM b WHERE bucket < 60")
def handoff_partition(spark, d):
    return urls(spark, d).select("id", U.bucket(F.col("url")).alias("b")).where("b < 60").select("id", (F.col("b") % 2).alias("consumer"))


@query(f"""WITH {URLS} SELECT id, row_number() OVER (ORDER BY CASE WHEN id % 10 = 0 THEN 0 WHEN discovery_source LIKE 'wayback%' THEN 1 ELSE 2 END, id) AS position FROM urls WHERE status = 'discovered' QUALIFY position <= 50""")
def claim_order(spark, d):
    return R.claim(urls(spark, d).where("status = 'discovered'"), F.col("id") % 10 == 0, F.col("discovery_source").startswith("wayback"), 50, gated=True).select("id", "position")


@query("""SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS owner, min(doc_id) OVER (PARTITION BY text) <> doc_id AS is_duplicate FROM documents""")
def exact_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return dedup.first_owner(docs, "sha256", "doc_id").select("doc_id", "owner", "is_duplicate")


@query("SELECT doc_id FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 10 = 0 UNION SELECT text FROM benchmark)")
def known_hash_antijoin(spark, d):
    h = lambda t, c: t.select(F.sha2("text", 256).alias("sha256"))
    docs = table(spark, d, "documents")
    known = h(docs.where("doc_id % 10 = 0"), 0).union(h(table(spark, d, "benchmark"), 0)).distinct()
    return docs.select("doc_id", F.sha2("text", 256).alias("sha256")).join(known, "sha256", "left_anti").select("doc_id")


@query("""WITH h AS (SELECT vec_id, list_sum([CASE WHEN embedding[i] > 0 THEN CAST(1 AS HUGEINT) << (i - 1) ELSE 0 END FOR i IN range(1, 65)]) AS h FROM embeddings)
SELECT a.vec_id AS left_id, b.vec_id AS right_id, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM h a JOIN h b ON a.vec_id < b.vec_id AND bit_count(xor(a.h, b.h)) <= 18""")
def near_dup_pairs(spark, d):
    h = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), dedup.sign_hash(F.col("embedding")).alias("h"))
    return dedup.hamming_pairs(h, 18)


def _screens(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


PII_SQL = r"""e AS (SELECT doc_id, coalesce(text, '') AS t, len(list_filter(regexp_extract_all(coalesce(text, ''), '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b'), lambda x: NOT regexp_matches(lower(x), 'info@|contact@|press@|media@|ir@|investor|office@|support@|sales@|hello@|admin@|webmaster@|enquiries@|communications@|pr@|news@'))) AS emails,
len(regexp_extract_all(coalesce(text, ''), '\b\d{3}-\d{2}-\d{4}\b')) AS ssns FROM documents)"""


@query(f"WITH {PII_SQL} SELECT doc_id, CAST(emails AS BIGINT) AS emails, CAST(ssns AS BIGINT) AS ssns FROM e")
def pii_core(spark, d):
    return _screens(spark, d).select("doc_id", S.emails(F.col("text")).alias("emails"), S.times(F.col("text"), S.SSN).alias("ssns"))


@query()
def pii_full(spark, d):
    t = F.col("text")
    return _screens(spark, d).select("doc_id", S.times(t, S.PHONE).alias("phones"), S.times(t, S.ID_NUMBER).alias("ids"), S.pii(t).alias("screen_pii"))


@query()
def rights(spark, d):
    return _screens(spark, d).select("doc_id", S.times(F.col("text"), S.RIGHTS).alias("notices"), S.rights(F.col("text")).alias("screen_rights"))


@query(r'''SELECT doc_id, CASE WHEN regexp_matches(coalesce(text,''), '(?i)\b(children under 13|under-13|coppa|kindergarten|elementary school students|pupils?''? (names?|records?|data)|student records?|minors?''? personal|child(?:ren)?''s personal (?:data|information))\b') AND regexp_matches(coalesce(text,''), '(?i)\b(name|address|birthdate|date of birth|photo|email|phone)\b') THEN 'REVIEW' ELSE 'PASS' END AS screen_minors,
CASE WHEN c IS NOT NULL THEN 'REJECT' ELSE 'PASS' END AS screen_prohibited, c AS category FROM (SELECT *, CASE WHEN regexp_matches(coalesce(text,''), '(?i)\b(explicit sexual|pornograph\w+|xxx[\s-]rated|escort service)\b') THEN 'adult'
 WHEN regexp_matches(coalesce(text,''), '(?i)\b(beheading|gore video|graphic violence|torture footage|snuff)\b') THEN 'violent' WHEN regexp_matches(coalesce(text,''), '(?i)\b(jihadist propaganda|white supremac\w+|neo-nazi|terrorist recruitment|extremist manifesto)\b') THEN 'extremist' END AS c FROM documents)''')
def minors_prohibited(spark, d):
    return _screens(spark, d).select("doc_id", S.minors(F.col("text")).alias("screen_minors"), S.prohibited(F.col("text")).alias("screen_prohibited"), S.prohibited_category(F.col("text")).alias("category"))


FILES = f"""{PII_SQL}, first AS (SELECT text, min(doc_id) AS owner FROM documents GROUP BY text),
files AS (SELECT d.doc_id AS id, CASE WHEN l.quality = 1 THEN 'HIGH' ELSE 'MEDIUM' END AS quality, sha256(d.text) AS sha256, CASE WHEN e.emails > 3 OR e.ssns > 0 THEN 'REVIEW' ELSE 'DELIVER' END AS decision, d.n_chars AS size
 FROM documents d JOIN labels l USING (doc_id) JOIN first f ON f.text = d.text AND f.owner = d.doc_id JOIN e ON e.doc_id = d.doc_id),
cand AS (SELECT id, quality, sha256, size FROM files WHERE decision = 'DELIVER'),
sel AS (SELECT *, count(*) FILTER (quality = 'HIGH') OVER () AS h, count(*) FILTER (quality = 'MEDIUM') OVER () AS m, row_number() OVER (PARTITION BY quality ORDER BY id) AS k FROM cand),
cap AS (SELECT *, least(floor(50 * 0.3::DOUBLE), floor(h * 0.3::DOUBLE / 0.7::DOUBLE)) AS c FROM sel),
roles AS (SELECT id, quality, sha256, size, CASE WHEN quality = 'MEDIUM' THEN CASE WHEN k <= c THEN 'medium' ELSE 'surplus' END WHEN k <= 50 - least(c, m) THEN 'high' ELSE 'held' END AS role FROM cap)"""


def _files(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.sha2("text", 256).alias("sha256"), F.col("n_chars").alias("size"))
    own = dedup.first_owner(docs, "sha256", "id").where("NOT is_duplicate")
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "HIGH").otherwise("MEDIUM").alias("quality"))
    review = (S.emails(F.col("text")) > 3) | (S.times(F.col("text"), S.SSN) > 0)
    return own.join(labels, "id").withColumn("decision", S.merged(F.lit("DELIVER"), F.lit(False), review)).drop("text")


def _candidates(spark, d):
    return _files(spark, d).where("decision = 'DELIVER'").select("id", "quality", "sha256", "size")


@query(f"WITH {FILES} SELECT id, quality, decision FROM files")
def verdict_merge(spark, d):
    return _files(spark, d).select("id", "quality", "decision")


@query(f"WITH {FILES} SELECT id, quality, role FROM roles")
def batch_selection(spark, d):
    return packaging.batch_selection(_candidates(spark, d), 50).select("id", "quality", "role")


@query(f"""WITH RECURSIVE {FILES}, o AS (SELECT *, row_number() OVER (ORDER BY id) AS k FROM cand),
g AS (SELECT id, k, 0 AS h, 0 AS m, false AS kept FROM (SELECT NULL::BIGINT AS id, 0::BIGINT AS k)
UNION ALL SELECT o.id, o.k, g.h + CASE WHEN o.quality = 'HIGH' THEN 1 ELSE 0 END, g.m + CASE WHEN o.quality = 'MEDIUM' AND g.h > 0 AND g.m < least(floor(1000 * 0.3::DOUBLE), floor(g.h * 0.3::DOUBLE / 0.7::DOUBLE)) THEN 1 ELSE 0 END,
 o.quality = 'HIGH' OR (g.h > 0 AND g.m < least(floor(1000 * 0.3::DOUBLE), floor(g.h * 0.3::DOUBLE / 0.7::DOUBLE))) FROM g JOIN o ON o.k = g.k + 1)
SELECT id, kept FROM g WHERE k > 0""")
def stream_gate(spark, d):
    return packaging.stream_gate(_candidates(spark, d), 1000).select("id", "kept")


@query(f"""WITH {FILES}, n AS (SELECT roles.*, row_number() OVER (ORDER BY id) AS c FROM roles WHERE role IN ('high', 'medium')),
m AS (SELECT n.*, d.text, d.source, e.emails, e.ssns FROM n JOIN documents d ON d.doc_id = n.id JOIN e ON e.doc_id = n.id)
SELECT 'BATCH_01_file_' || lpad(CAST(c AS VARCHAR), 5, '0') || '.txt' AS delivered_filename, sha256, 'https://' || source || '/' || id AS source_url, source AS source_domain, 'https://' || source || '/' || id AS download_url, id || '.txt' AS original_filename, 'txt' AS format,
 '0' AS converted_from_ppt, CAST(len(string_split(text, chr(10))) AS VARCHAR) AS slide_count, quality AS quality_class, '' AS collection_ts, '' AS download_ts, CAST(CASE WHEN id % 9 = 0 THEN 404 ELSE 200 END AS VARCHAR) AS http_status, 'allowed' AS robots_status, CASE WHEN id % 6 = 0 THEN 'wayback' ELSE 'origin' END AS retrieval_method,
 CASE WHEN id % 6 = 0 THEN 'archived-via-wayback' WHEN id % 9 = 0 THEN 'dead' ELSE 'reachable' END AS public_access_status, 'PASS' AS screen_pirate, 'PASS' AS screen_robots, 'PASS' AS screen_rights, CASE WHEN emails > 3 OR ssns > 0 THEN 'REVIEW' ELSE 'PASS' END AS screen_pii,
 'PASS' AS screen_minors, CASE WHEN regexp_matches(text, '(?i)\\b(snuff|neo-nazi|pornograph\\w+)\\b') THEN 'REJECT' ELSE 'PASS' END AS screen_prohibited, '' AS page_index, '' AS image_sha256, '' AS phash, '' AS source_file_sha256, '' AS extraction_method, 'delivered' AS final_status FROM m""")
def manifest(spark, d):
    """All columns of a manifest; the screens are those that the DuckDB side can express (screens says them in full)."""
    chosen = packaging.batch_selection(_candidates(spark, d), 50).where(F.col("role").isin("high", "medium"))
    c = F.row_number().over(W.orderBy("id"))  # a batch, of bounded size
    files = chosen.withColumn("delivered_filename", packaging.file_name(F.lit(1), c, F.lit("txt")))
    t, i = F.col("text"), F.col("id")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    address = F.concat(F.lit("https://"), "source", F.lit("/"), i.cast("string"))
    pii = F.when((S.emails(t) > 3) | (S.times(t, S.SSN) > 0), "REVIEW").otherwise("PASS")
    how = F.when(i % 6 == 0, "wayback").otherwise("origin")
    status = F.when(i % 9 == 0, 404).otherwise(200)
    rows = docs.join(F.broadcast(files), "id").select(
        "delivered_filename", "sha256", address.alias("source_url"), F.col("source").alias("source_domain"), address.alias("download_url"), F.concat(i.cast("string"), F.lit(".txt")).alias("original_filename"), F.lit("txt").alias("format"),
        F.lit(0).alias("converted_from_ppt"), F.size(F.split("text", "\n", -1)).alias("slide_count"), F.col("quality").alias("quality_class"), status.alias("http_status"), F.lit("allowed").alias("robots_status"), how.alias("retrieval_method"),
        delivery.public_access(how, status).alias("public_access_status"), F.lit("PASS").alias("screen_pirate"), F.lit("PASS").alias("screen_robots"), F.lit("PASS").alias("screen_rights"), pii.alias("screen_pii"), F.lit("PASS").alias("screen_minors"),
        S.prohibited(t).alias("screen_prohibited"), F.lit("delivered").alias("final_status"),
    )
    return sinks.manifest_rows(rows)


SLIDES = """slides AS (SELECT l_orderkey AS deck, l_linenumber AS slide, CAST(l_returnflag = 'R' AS INTEGER) AS native_chart, CAST(l_linenumber % 5 = 0 AS INTEGER) AS diagram, CAST(l_quantity > 40 AS INTEGER) AS table_, CAST(l_discount > 0.09 AS INTEGER) AS ole,
 CAST(l_tax > 0.06 AS INTEGER) AS image_analytical, CAST(l_returnflag = 'A' AS INTEGER) AS image_photo, CAST(l_returnflag = 'A' AS INTEGER) + CAST(l_tax > 0.06 AS INTEGER) AS image_count, CAST(l_quantity < 5 AS INTEGER) AS vector, CAST(l_quantity * 20 AS INTEGER) AS text_chars, CAST(l_linenumber AS INTEGER) AS bullets, l_linenumber = 1 AND l_quantity < 25 AS filler FROM lineitem),
flags AS (SELECT *, native_chart + diagram + table_ + ole + image_analytical AS a FROM slides)"""
DECKS = f"""{SLIDES}, mt AS (SELECT deck, count(*) AS slides, count(*) FILTER (NOT filler) AS content, count(*) FILTER (NOT filler AND a > 0) AS analytical, count(*) FILTER (NOT filler AND native_chart + diagram + image_analytical > 0) AS charts,
 count(*) FILTER (NOT filler AND image_photo >= 1 AND a = 0 AND text_chars < 200) AS photos, count(*) FILTER (NOT filler AND a = 0 AND image_count = 0 AND vector = 0) AS texts FROM flags GROUP BY deck),
sh AS (SELECT *, CASE WHEN content > 0 THEN analytical / content::DOUBLE ELSE 0 END AS pa, CASE WHEN content > 0 THEN photos / content::DOUBLE ELSE 0 END AS pp, CASE WHEN content > 0 THEN texts / content::DOUBLE ELSE 0 END AS px FROM mt),
q AS (SELECT *, slides < MINS OR content = 0 AS early, CASE WHEN slides < MINS OR content = 0 OR px >= 0.75::DOUBLE OR pp >= 0.5::DOUBLE OR analytical = 0 THEN 'LOW' WHEN pa >= HI::DOUBLE AND charts >= 3 AND pp < 0.3::DOUBLE THEN 'HIGH' WHEN pa >= 0.4::DOUBLE AND charts >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS quality,
 abs(pa - HI::DOUBLE) <= 0.03::DOUBLE OR abs(pa - 0.4::DOUBLE) <= 0.03::DOUBLE OR abs(pp - 0.3::DOUBLE) <= 0.03::DOUBLE OR abs(px - 0.75::DOUBLE) <= 0.03::DOUBLE OR abs(pp - 0.5::DOUBLE) <= 0.03::DOUBLE AS signal FROM sh),
dec AS (SELECT deck, slides, content, analytical, charts, quality, NOT early AND signal AND (quality <> 'LOW' OR analytical > 0) AS borderline, CASE WHEN NOT early AND signal AND (quality <> 'LOW' OR analytical > 0) THEN 'REVIEW' WHEN quality = 'LOW' THEN 'REJECT' ELSE 'DELIVER' END AS decision FROM q)"""


def _slides(spark, d):
    b = lambda c: c.cast("int")
    li = table(spark, d, "lineitem")
    q, n, f = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_returnflag")
    return li.select(F.col("l_orderkey").alias("deck"), n.alias("slide"), b(f == "R").alias("native_chart"), b(n % 5 == 0).alias("diagram"), b(q > 40).alias("table_"), b(F.col("l_discount") > 0.09).alias("ole"), b(F.col("l_tax") > 0.06).alias("image_analytical"), b(f == "A").alias("image_photo"),
                     (b(f == "A") + b(F.col("l_tax") > 0.06)).alias("image_count"), b(q < 5).alias("vector"), (q * 20).cast("int").alias("text_chars"), n.cast("int").alias("bullets"), ((n == 1) & (q < 25)).alias("filler"))


def _decided(spark, d, t=D.Thresholds(min_slides=3)):
    return D.deck_decision(D.deck_metrics(_slides(spark, d), "deck"), t)


@query(f"WITH {DECKS.replace('MINS', '3').replace('HI::', '0.5::')} SELECT deck, slides, content, analytical, charts, quality, borderline, decision FROM dec")
def deck_decision(spark, d):
    return _decided(spark, d).select("deck", "slides", "content", "analytical", "charts", "quality", "borderline", "decision")


@query(f"WITH a AS (WITH {DECKS.replace('MINS', '3').replace('HI::', '0.5::')} SELECT * FROM dec), b AS (WITH {DECKS.replace('MINS', '3').replace('HI::', '0.7::')} SELECT * FROM dec) SELECT a.quality AS before, b.quality AS after, count(*) AS n FROM a JOIN b USING (deck) WHERE a.quality <> b.quality OR a.decision <> b.decision GROUP BY ALL")
def reclassify_changes(spark, d):
    m = D.deck_metrics(_slides(spark, d), "deck")  # one pass over the slides; the thresholds are expressions over the metrics
    a = D.deck_decision(m, D.Thresholds(min_slides=3)).withColumnsRenamed({"quality": "before", "decision": "d1"}).drop("borderline")
    b = D.deck_decision(a, D.Thresholds(min_slides=3, high=0.7)).withColumnRenamed("quality", "after")
    return b.where("before <> after OR d1 <> decision").groupBy("before", "after").agg(F.count("*").alias("n"))


@query(f"""WITH {SLIDES} SELECT deck, slide, CASE WHEN filler THEN 'filler' WHEN a = 0 AND vector = 0 THEN 'no_analytical_content' WHEN table_ >= 1 AND ole >= 1 AND text_chars > 500 THEN 'spreadsheet_dump' WHEN text_chars > 400 AND bullets > 3 THEN 'text_heavy_with_bullets'
 WHEN a = 1 AND image_analytical = 1 AND text_chars > 400 THEN 'decorative_image_with_text' WHEN table_ >= 1 AND a = table_ AND text_chars > 800 THEN 'table_text_dump' WHEN native_chart + diagram = 0 AND image_analytical < 2 AND ole = 0 AND text_chars > 200 THEN 'weak_analytical_with_text' WHEN a > 0 THEN 'analytical' ELSE 'vector_graphics' END AS reason FROM flags""")
def graphical_pages(spark, d):
    return _slides(spark, d).select("deck", "slide", D.page_reason().alias("reason"))


@query("""WITH e AS (SELECT user_id, event_id, ts, event_type = 'error' AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT event_id, CASE WHEN bad THEN count(*) FILTER (bad) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) ELSE 0 END AS streak FROM e""")
def breaker_streaks(spark, d):
    return E.failure_streaks(table(spark, d, "events"), "user_id", F.col("event_type") == "error", ["ts", "event_id"]).select("event_id", "streak")


@query()
def breaker_machine(spark, d):
    return E.breaker(table(spark, d, "events").select(F.col("user_id").alias("key"), "event_id", "ts", (F.col("event_type") == "error").alias("failed")))


@query("""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN value >= 70 THEN 1 WHEN value <= 56 THEN 0 END AS v FROM events)
SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) = 1 AS paused FROM e""")
def pause_hysteresis(spark, d):
    return E.latch(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("value") >= 70, F.col("value") <= 56, "paused").select("event_id", "paused")


@query("""WITH r AS (SELECT event_id, CAST(ts AS DATE) AS day, sum(CAST(value * 100 AS BIGINT)) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS running FROM events),
k AS (SELECT *, max(running) OVER (PARTITION BY day ORDER BY event_id) FROM r) SELECT event_id, CAST(running AS BIGINT) AS running, running <= 50000 AS kept FROM r""")
def budget_prefix(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", F.to_date("ts").alias("day"), F.round(F.col("value") * 100).cast("long").alias("bytes"))
    return packaging.within_budget(e, "day", ["ts", "event_id"], "bytes", 50_000).select("event_id", "running", "kept")


@query(f"WITH {URLS} SELECT CASE WHEN grouping(tier) = 1 THEN 0 ELSE tier END AS tier, status, count(*) AS n FROM urls GROUP BY GROUPING SETS ((status), (tier, status))")
def status_rollup(spark, d):
    return urls(spark, d).groupingSets([["status"], ["tier", "status"]], "tier", "status").agg(F.count("*").alias("n")).withColumn("tier", F.coalesce("tier", F.lit(0)))


@query(f"""WITH {URLS}, f AS (SELECT doc_id % (SELECT count(*) FROM pages) AS url_id, CASE doc_id % 5 WHEN 0 THEN 'REVIEW' WHEN 1 THEN 'REJECT' ELSE 'DELIVER' END AS decision FROM documents),
s AS (SELECT tier, count(*) AS candidates, count(*) FILTER (decision = 'DELIVER') AS accepted, CAST(sum(length(url)) AS BIGINT) AS bytes FROM urls LEFT JOIN f ON urls.id = f.url_id GROUP BY tier)
SELECT *, round_even(1000.0::DOUBLE * accepted / candidates, 2) AS accepted_per_1k, CAST(round_even(bytes::DOUBLE / nullif(accepted, 0), 0) AS BIGINT) AS bytes_per_accepted FROM s""")
def tier_acceptance(spark, d):
    """A url counts once for each of its files; its length stands for the bytes that were fetched."""
    n = table(spark, d, "pages").count()
    of = F.when(F.col("doc_id") % 5 == 0, "REVIEW").when(F.col("doc_id") % 5 == 1, "REJECT").otherwise("DELIVER")
    files = table(spark, d, "documents").select((F.col("doc_id") % max(n, 1)).alias("url_id"), of.alias("decision"))
    return R.tier_acceptance(urls(spark, d).withColumn("content_length", F.length("url")), files)


@query("SELECT event_type AS kind, count(*) AS n, count(*) FILTER (ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY) AS last_day FROM events GROUP BY event_type")
def incident_counts(spark, d):
    e = table(spark, d, "events")
    asof = e.agg(F.max("ts").alias("asof"))
    return e.crossJoin(F.broadcast(asof)).groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"), F.count_if(F.col("ts") >= F.col("asof") - F.expr("INTERVAL 1 DAY")).alias("last_day"))


FOLDERS = "a AS (SELECT doc_id, sha256(text) AS sha, 'f' || CAST(doc_id % 97 AS VARCHAR) AS name FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id, sha256(text) AS sha, 'f' || CAST(doc_id % 97 AS VARCHAR) AS name FROM documents WHERE doc_id % 2 = 1)"


@query(f"""WITH {FOLDERS} SELECT 'duplicate' AS role, count(*) AS n FROM (SELECT DISTINCT sha FROM a INTERSECT SELECT DISTINCT sha FROM b)
UNION ALL SELECT 'unique_a', count(*) FROM (SELECT DISTINCT sha FROM a EXCEPT SELECT sha FROM b) UNION ALL SELECT 'unique_b', count(*) FROM (SELECT DISTINCT sha FROM b EXCEPT SELECT sha FROM a)
UNION ALL SELECT 'all', count(*) FROM (SELECT sha FROM a UNION SELECT sha FROM b)""")
def folder_compare(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return R.compare_folders(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"))


@query("""SELECT CAST(l_shipdate::DATE AS VARCHAR) AS day, count(*) AS files, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes, round(sum(CAST(l_quantity AS BIGINT)) / 1e9::DOUBLE, 9) AS gb FROM lineitem GROUP BY 1""")
def inventory_cost(spark, d):
    li = table(spark, d, "lineitem")
    b = F.sum(F.col("l_quantity").cast("long"))
    return li.groupBy(F.to_date("l_shipdate").cast("string").alias("day")).agg(F.count("*").alias("files"), b.alias("bytes"), F.round(b / F.lit(1e9), 9).alias("gb"))


@query("""SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL""")
def event_windows(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.floor(F.unix_timestamp("w.start") / 3600).alias("hour"), "event_type", "n")


AUDIT = """f AS (SELECT vec_id, (abs(embedding[1]) * 4)::DOUBLE AS text_density, CAST(floor(abs(embedding[2]::DOUBLE) * 30) AS INTEGER) AS pairs, CAST(floor(abs(embedding[3]::DOUBLE) * 50) AS INTEGER) AS lines, CAST(floor(abs(embedding[4]::DOUBLE) * 60) AS INTEGER) AS colors, (abs(embedding[5]) * 3)::DOUBLE AS long_edges, CAST(floor(abs(embedding[6]::DOUBLE) * 500) AS INTEGER) AS blobs, (abs(embedding[7]) * 5)::DOUBLE AS symmetry, (abs(embedding[8]) * 5)::DOUBLE AS white, CAST(floor(abs(embedding[9]::DOUBLE) * 40) AS INTEGER) AS hues FROM embeddings),
s AS (SELECT vec_id, CAST(greatest(0, least(100, 50 + CASE WHEN text_density > 0.4 THEN -35 WHEN text_density > 0.2 THEN -25 WHEN text_density > 0.1 THEN -15 WHEN text_density > 0.05 THEN -5 ELSE 0 END + CASE WHEN pairs > 5 THEN 25 WHEN pairs > 2 THEN 15 WHEN lines > 10 THEN 10 WHEN lines > 5 THEN 5 ELSE 0 END
 + CASE WHEN colors BETWEEN 4 AND 12 THEN 10 WHEN colors > 12 THEN 5 WHEN colors <= 2 THEN -5 ELSE 0 END + CASE WHEN long_edges > 0.3 THEN 10 WHEN long_edges > 0.15 THEN 5 ELSE 0 END + CASE WHEN blobs BETWEEN 5 AND 100 THEN 10 WHEN blobs > 100 THEN 5 ELSE 0 END + CASE WHEN symmetry > 0.6 THEN 5 ELSE 0 END + CASE WHEN white > 0.5 THEN 5 ELSE 0 END + CASE WHEN hues BETWEEN 3 AND 10 THEN 5 ELSE 0 END)) AS INTEGER) AS score FROM f)"""


def _audited(spark, d):
    x = lambda i: F.abs(F.col("embedding")[i].cast("double"))
    n = lambda i, k: F.floor(x(i) * k).cast("int")
    f = table(spark, d, "embeddings").select("vec_id", (F.abs(F.col("embedding")[0]) * F.lit(4).cast("float")).cast("double").alias("text_density"), n(1, 30).alias("pairs"), n(2, 50).alias("lines"), n(3, 60).alias("colors"), (F.abs(F.col("embedding")[4]) * F.lit(3).cast("float")).cast("double").alias("long_edges"), n(5, 500).alias("blobs"), (F.abs(F.col("embedding")[6]) * F.lit(5).cast("float")).cast("double").alias("symmetry"), (F.abs(F.col("embedding")[7]) * F.lit(5).cast("float")).cast("double").alias("white"), n(8, 40).alias("hues"))
    return f.select("vec_id", R.audit_score().alias("score"))


@query(f"WITH {AUDIT} SELECT vec_id, score, CASE WHEN score >= 70 THEN 'pass' WHEN score >= 40 THEN 'borderline' ELSE 'reject' END AS classification FROM s")
def audit_score(spark, d):
    return _audited(spark, d).withColumn("classification", F.when(F.col("score") >= 70, "pass").when(F.col("score") >= 40, "borderline").otherwise("reject"))


@query(f"WITH {AUDIT} SELECT CAST(least(floor(score / 10.0), 9) AS BIGINT) AS bin, count(*) AS n FROM s GROUP BY 1")
def audit_histogram(spark, d):
    return _audited(spark, d).groupBy(F.least(F.floor(F.col("score") / 10), F.lit(9).cast("long")).alias("bin")).agg(F.count("*").alias("n"))


def _page_hashes(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 7).alias("file_id"), dedup.sign_hash(F.col("embedding")).alias("h"))


PAGE_HASHES = "h AS (SELECT vec_id AS id, vec_id % 7 AS file_id, list_sum([CASE WHEN embedding[i] > 0 THEN CAST(1 AS HUGEINT) << (i - 1) ELSE 0 END FOR i IN range(1, 65)]) AS h FROM embeddings)"


@query(f"WITH {PAGE_HASHES} SELECT id, EXISTS (SELECT 1 FROM h e WHERE e.id < h.id AND e.file_id <> h.file_id AND bit_count(xor(e.h, h.h)) <= 18) AS is_duplicate FROM h")
def near_dup_flags(spark, d):
    """A page is a near duplicate if an earlier page of another file is within the distance."""
    h = _page_hashes(spark, d)
    later = dedup.first_near(h.withColumnRenamed("id", "place"), 18).select(F.col("place").alias("id")).distinct().withColumn("hit", F.lit(True))
    return h.join(later, "id", "left").select("id", F.coalesce("hit", F.lit(False)).alias("is_duplicate"))


@query(r"""SELECT conv_id, turn, CASE WHEN regexp_matches(t, '(?im)^\s*(agenda|outline|contents?|table of contents|today''?s (topics|agenda)|overview of (the )?presentation)\s*$') THEN 'agenda' WHEN regexp_matches(t, '(?i)\b(thank\s*you|thanks|merci|gracias|danke|obrigado|谢谢|ありがとう)\b[\s!.]*$') THEN 'thank_you'
 WHEN regexp_matches(t, '(?im)^\s*(q\s*&\s*a|questions\??|any questions\??|discussion)\s*$') THEN 'qa' WHEN regexp_matches(t, '(?im)^\s*(section|part|chapter|appendix)\s*[:\-]?\s*[\divxIVX]*\s*$') THEN 'divider' WHEN regexp_matches(t, '(?i)\b(safe harbor|forward.looking statements?|disclaimer|legal notice|cautionary statement)\b') THEN 'disclaimer'
 WHEN (turn = lo OR turn = hi) AND chars <= 200 THEN 'title_or_closing' WHEN chars <= 40 THEN 'near_empty_divider' END AS filler_reason
 FROM (SELECT conv_id, turn, trim(coalesce(text, '')) AS t, length(regexp_replace(coalesce(text, ''), '\s', '', 'g')) AS chars, min(turn) OVER (PARTITION BY conv_id) AS lo, max(turn) OVER (PARTITION BY conv_id) AS hi FROM conversations)""")
def filler_flags(spark, d):
    """Turns of a conversation as slides of a deck; the families of patterns are fixed values."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.trim(F.coalesce("text", F.lit(""))).alias("t"))
    w = W.partitionBy("conv_id")
    c = c.withColumn("chars", F.length(F.regexp_replace("t", r"\s", ""))).withColumn("lo", F.min("turn").over(w)).withColumn("hi", F.max("turn").over(w))
    return c.select("conv_id", "turn", D.filler_reason(F.col("t"), F.col("chars"), (F.col("turn") == F.col("lo")) | (F.col("turn") == F.col("hi"))).alias("filler_reason"))


@query("""WITH s AS (SELECT doc_id, n_chars AS size, sum(n_chars) OVER () AS total, sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS running FROM documents) SELECT doc_id, CAST(size AS BIGINT) AS size FROM s WHERE total - (running - size) > 200000""")
def review_prune(spark, d):
    """Oldest first out of the backlog, all documents, until what is left fits the cap."""
    rows = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("size"))
    total = rows.agg(F.sum("size").alias("total"))
    out = running(rows, ["doc_id"], running=("sum", F.col("size"))).crossJoin(F.broadcast(total))
    return out.where(F.col("total") - (F.col("running") - F.col("size")) > 200_000).select("doc_id", "size")


@query(f"WITH {FOLDERS} SELECT a.name, count(*) AS pairs FROM (SELECT DISTINCT name, sha FROM a) a JOIN (SELECT DISTINCT name, sha FROM b) b ON a.name = b.name AND a.sha <> b.sha GROUP BY a.name")
def name_collisions(spark, d):
    """Names that two folders give to different contents, with the number of pairs: counted from totals, no pair is written out."""
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("f"), F.col("doc_id") % 97).alias("name"), F.sha2("text", 256).alias("sha"))
    side = F.bit_or(F.when(F.col("doc_id") % 2 == 0, 1).otherwise(2))
    one = docs.groupBy("name", "sha").agg(side.alias("f"))
    n = one.groupBy("name").agg(F.count_if(F.col("f").isin(1, 3)).alias("a"), F.count_if(F.col("f").isin(2, 3)).alias("b"), F.count_if(F.col("f") == 3).alias("same"))
    return n.select("name", (F.col("a") * F.col("b") - F.col("same")).alias("pairs")).where("pairs > 0")


@query("SELECT DISTINCT sha256(text) AS sha256 FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)")
def catalog_union(spark, d):
    t = lambda n: table(spark, d, n).select(F.sha2("text", 256).alias("sha256"))
    return t("documents").union(t("benchmark")).distinct()


@query("SELECT l_partkey AS name, count(*) AS entries, count(DISTINCT l_suppkey) AS contents, count(DISTINCT l_suppkey) > 1 AS ambiguous FROM lineitem GROUP BY 1")
def same_name_collapse(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("name")).agg(F.count("*").alias("entries"), F.count_distinct("l_suppkey").alias("contents")).withColumn("ambiguous", F.col("contents") > 1)


@query("""WITH n AS (SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 12 HOUR THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM n) SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, d):
    e = table(spark, d, "events").groupBy(F.session_window("ts", "12 hours").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return e.select("user_id", F.unix_timestamp("w.start").alias("start"), "n")


@query("SELECT count(*) FILTER (event_type = 'purchase' AND ts >= m - INTERVAL 1 DAY) AS last_day, count(*) FILTER (event_type = 'purchase') AS total, round((1000000 - count(*) FILTER (event_type = 'purchase')) / CAST(nullif(count(*) FILTER (event_type = 'purchase' AND ts >= m - INTERVAL 1 DAY), 0) AS DOUBLE), 4) AS days_left FROM events, (SELECT max(ts) AS m FROM events)")
def eta(spark, d):
    e = table(spark, d, "events")
    out = e.crossJoin(F.broadcast(e.agg(F.max("ts").alias("m")))).agg(F.count_if((F.col("event_type") == "purchase") & (F.col("ts") >= F.col("m") - F.expr("INTERVAL 1 DAY"))).alias("last_day"), F.count_if(F.col("event_type") == "purchase").alias("total"))
    return out.withColumn("days_left", F.round((1_000_000 - F.col("total")) / F.nullif(F.col("last_day"), F.lit(0)).cast("double"), 4))


@query(f"WITH {URLS}, dom AS (SELECT domain, CASE WHEN min(id) % 4 = 0 THEN 'blacklisted' WHEN min(id) % 4 = 1 THEN 'parked' END AS state FROM urls GROUP BY domain HAVING min(id) % 4 < 2) SELECT DISTINCT urls.domain FROM urls LEFT JOIN dom USING (domain) WHERE coalesce(state, 'active') <> 'blacklisted' AND (status = 'discovered' OR (status = 'parked' AND coalesce(state, 'active') = 'active'))")
def live_domains(spark, d):
    u = urls(spark, d)
    dom = u.groupBy("domain").agg((F.min("id") % 4).alias("k")).where("k < 2").select("domain", F.when(F.col("k") == 0, "blacklisted").otherwise("parked").alias("state"))
    s = F.coalesce("state", F.lit("active"))
    return u.join(dom, "domain", "left").where((s != "blacklisted") & ((F.col("status") == "discovered") | ((F.col("status") == "parked") & (s == "active")))).select("domain").distinct()


@query("""WITH p AS (SELECT label < 5 AS g, i, avg(e::DOUBLE) AS v FROM (SELECT label, unnest(embedding) AS e, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY ALL), n AS (SELECT g, sqrt(sum(v * v)) AS n FROM p GROUP BY g),
x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS e, unnest(range(1, 65)) AS i FROM embeddings), l AS (SELECT vec_id, sqrt(sum(e * e)) AS n FROM x GROUP BY vec_id),
s AS (SELECT x.vec_id, p.g, sum(x.e * p.v) / any_value(n.n) / any_value(l.n) AS s FROM x JOIN p USING (i) JOIN n ON n.g = p.g JOIN l ON l.vec_id = x.vec_id GROUP BY ALL),
q AS (SELECT vec_id, 1 / (1 + exp(100 * (max(s) FILTER (NOT g) - max(s) FILTER (g)))) AS p FROM s GROUP BY vec_id)
SELECT vec_id, round(p, 4) AS p_graphics, CASE WHEN round(p, 4) > 0.70 THEN 'pass' WHEN round(p, 4) > 0.40 THEN 'borderline' ELSE 'reject' END AS band FROM q""")
def zero_shot_bands(spark, d):
    """Two classes by label group: prototypes are normalised means, scores are cosines, softmax at 100."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    mean = e.select((F.col("label") < 5).alias("g"), F.posexplode("v").alias("i", "x")).groupBy("g", "i").agg(F.avg("x").alias("x"))
    proto = mean.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("p"))
    two = proto.agg(F.max(F.when(F.col("g"), F.col("p"))).alias("pg"), F.max(F.when(~F.col("g"), F.col("p"))).alias("pn"))  # one row of fixed size
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cos = lambda a, b: dot(F.col(a), F.col(b)) / F.sqrt(dot(F.col(a), F.col(a))) / F.sqrt(dot(F.col(b), F.col(b)))
    p = F.round(1 / (1 + F.exp(100 * (cos("v", "pn") - cos("v", "pg")))), 4)
    return e.crossJoin(F.broadcast(two)).select("vec_id", p.alias("p_graphics")).withColumn("band", F.when(F.col("p_graphics") > F.lit(0.70), "pass").when(F.col("p_graphics") > F.lit(0.40), "borderline").otherwise("reject"))


@query("""WITH f AS (SELECT sha256(text) AS sha, doc_id, doc_id % 5 = 0 AS delivered FROM documents WHERE doc_id % 3 = 0) SELECT d.doc_id, bool_or(f.doc_id IS NOT NULL AND (f.doc_id <> d.doc_id OR f.delivered)) AS is_duplicate FROM documents d LEFT JOIN f ON f.sha = sha256(d.text) GROUP BY d.doc_id""")
def duplicate_semantics(spark, d):
    """A payload is a duplicate if a file with its hash belongs to another url or was delivered: from counts by hash, no pairs."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    known = docs.where("doc_id % 3 = 0").groupBy("sha").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.bool_or(F.col("doc_id") % 5 == 0).alias("delivered"))
    hit = F.col("lo").isNotNull() & (F.col("delivered") | (F.col("lo") != F.col("doc_id")) | (F.col("hi") != F.col("doc_id")))
    return docs.join(known, "sha", "left").select("doc_id", hit.alias("is_duplicate"))


@query()
def folder_subset_split(spark, d):
    """Of at most eight folders (regions), the subset whose share of customers is nearest to 40 %: all subsets as bit masks over one row."""
    n = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").count()
    one = n.agg(F.array_sort(F.collect_list(F.struct("n_regionkey", "count"))).alias("f"))
    masks = one.withColumn("m", F.explode(F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("f")) - 1)))
    chosen = F.filter("f", lambda x, i: F.getbit(F.col("m").cast("long"), i) == 1)
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x["count"])
    out = masks.select(F.transform(chosen, lambda x: x["n_regionkey"]).alias("folders"), (total(chosen) / total(F.col("f"))).alias("share"))
    return out.orderBy(F.abs(F.col("share") - 0.4), "folders").limit(1)


@query(f"WITH {SLIDES} SELECT deck, slide, a > 0 AS analytical, native_chart + diagram + image_analytical > 0 AS chart_page, image_photo >= 1 AND a = 0 AND text_chars < 200 AS photo_heavy, a = 0 AND image_count = 0 AND vector = 0 AS text_only FROM flags")
def slide_flags(spark, d):
    return D.with_flags(_slides(spark, d)).select("deck", "slide", "analytical", "chart_page", "photo_heavy", "text_only")


@query(f"WITH {DECKS.replace('MINS', '3').replace('HI::', '0.5::')} SELECT * FROM mt")
def deck_metrics(spark, d):
    return D.deck_metrics(_slides(spark, d), "deck")


@query("""WITH f AS (SELECT doc_id, doc_id // 100 + 1 AS batch_id, CASE WHEN doc_id % 7 = 0 THEN doc_id % 100 + 1 END AS c FROM documents), n AS (SELECT *, coalesce(c, coalesce(max(c) OVER (PARTITION BY batch_id), 0) + sum(CASE WHEN c IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY batch_id ORDER BY doc_id)) AS counter FROM f)
SELECT doc_id, batch_id, CAST(counter AS BIGINT) AS counter, 'BATCH_' || lpad(CAST(batch_id AS VARCHAR), CAST(greatest(2, length(CAST(batch_id AS VARCHAR))) AS INTEGER), '0') || '_file_' || lpad(CAST(counter AS VARCHAR), 5, '0') || '.pptx' AS delivered_filename FROM n""")
def batch_names(spark, d):
    i = F.col("doc_id")
    files = table(spark, d, "documents").select("doc_id", (F.floor(i / 100) + 1).alias("batch_id"), F.when(i % 7 == 0, i % 100 + 1).alias("counter"))
    return packaging.with_names(files, "batch_id", "counter", "doc_id", F.lit("pptx"))


@query("SELECT o_orderkey AS largest, node, list_min(list_filter([o_orderkey + 1, o_orderkey + 2, o_orderkey + 3], lambda x: (x - 1) % 3 = node)) AS batch_id FROM orders, (SELECT unnest([0, 1, 2]) AS node)")
def next_batch_ids(spark, d):
    """The batch that each of three nodes would open next, after each known id."""
    known = table(spark, d, "orders").select(F.col("o_orderkey").alias("largest"), F.explode(F.array(*map(F.lit, range(3)))).alias("node"))
    return known.withColumn("batch_id", packaging.next_batch(F.col("largest"), F.col("node"), F.lit(3)))


@query("""WITH l AS (SELECT event_type || '-' || event_id || CASE event_id % 4 WHEN 0 THEN '.jsonl' WHEN 1 THEN '.jsonl.1' WHEN 2 THEN '.jsonl.12' ELSE '.gz' END AS name, ts FROM events),
r AS (SELECT *, row_number() OVER (ORDER BY ts DESC, name DESC) AS k FROM l WHERE regexp_matches(name, '\\.(gz|[0-9]+)$')) SELECT name, ts FROM r WHERE k > 5 AND ts < TIMESTAMP '2024-01-20'""")
def rotated_logs(spark, d):
    i = F.col("event_id")
    end = F.when(i % 4 == 0, ".jsonl").when(i % 4 == 1, ".jsonl.1").when(i % 4 == 2, ".jsonl.12").otherwise(".gz")
    logs = table(spark, d, "events").select(F.concat("event_type", F.lit("-"), i.cast("string"), end).alias("name"), "ts")
    return packaging.stale_logs(logs, F.lit("2024-01-20").cast(logs.schema["ts"].dataType)).select("name", "ts")


@query(f"WITH {PAGE_HASHES} SELECT q.id, arg_min(h.id, (bit_count(xor(q.h, h.h)) * 1000000 + h.id)) AS closest_id, CAST(min(bit_count(xor(q.h, h.h))) AS INTEGER) AS distance FROM h q LEFT JOIN h ON q.file_id <> h.file_id WHERE q.id % 20 = 0 GROUP BY q.id")
def nearest_phash(spark, d):
    """The closest page of another file to every twentieth page."""
    h = _page_hashes(spark, d)
    return dedup.nearest_hash(h.where("id % 20 = 0"), h)


LABELS = ("a chart or graph", "a map or geographic visualization", "a diagram or flowchart", "a text document or slide", "a photograph or photo", "a table or spreadsheet")


@query("""WITH e AS (SELECT vec_id, [abs(embedding[i]::DOUBLE) FOR i IN range(1, 7)] AS s FROM embeddings), p AS (SELECT vec_id, s[1] + s[2] + s[3] + s[5] AS g, s[4] + s[6] AS n FROM e), r AS (SELECT vec_id, CASE WHEN g + n > 0 THEN g / (g + n) ELSE 0.5 END AS p FROM p)
SELECT vec_id, round(p, 4) AS graphics_score, CASE WHEN p >= 0.70::DOUBLE THEN 'pass' WHEN p >= 0.40::DOUBLE THEN 'borderline' ELSE 'reject' END AS classification,
CASE WHEN p >= 0.70::DOUBLE THEN CASE WHEN p > 0.85::DOUBLE THEN 'high_confidence_graphics' ELSE 'moderate_confidence_graphics' END WHEN p >= 0.40::DOUBLE THEN CASE WHEN p > 0.55::DOUBLE THEN 'leaning_graphics_but_uncertain' WHEN p > 0.45::DOUBLE THEN 'even_split' ELSE 'leaning_non_graphics_but_uncertain' END
 WHEN p < 0.25::DOUBLE THEN 'clearly_non_graphics' ELSE 'likely_non_graphics' END AS reasons FROM r""")
def label_score_bands(spark, d):
    """Magnitudes of the first components as scores of labels. A keyword counts inside a word too, so a photograph speaks for graphics."""
    scores = F.transform(F.slice("embedding", 1, len(LABELS)), lambda x: F.abs(x.cast("double")))
    e = table(spark, d, "embeddings").select("vec_id", S.label_share(F.array(*map(F.lit, LABELS)), scores).alias("p"))
    band, reason = S.label_band(F.col("p"))
    return e.select("vec_id", F.round("p", 4).alias("graphics_score"), band.alias("classification"), reason.alias("reasons"))


@query("""WITH RECURSIVE l AS (SELECT page_id, (page_id - 1) // 4 AS parent FROM pages WHERE page_id > 0), w AS (SELECT page_id, 0 AS depth FROM pages WHERE page_id = 0 UNION SELECT l.page_id, depth + 1 FROM l JOIN w ON l.parent = w.page_id WHERE depth < 4)
SELECT 'sitemap-' || page_id || '.xml' AS url, depth FROM w""")
def sitemap_walk(spark, d):
    """Sitemaps numbered as the pages, each an index of the next four."""
    name = lambda c: F.concat(F.lit("sitemap-"), c.cast("string"), F.lit(".xml"))
    ids = table(spark, d, "pages").select("page_id")
    links = ids.where("page_id > 0").select(name(F.floor((F.col("page_id") - 1) / 4)).alias("parent"), name(F.col("page_id")).alias("url"))
    return filtering.walked(ids.where("page_id = 0").select(name(F.col("page_id")).alias("url")), links)


@query("""WITH u AS (SELECT page_id, url, CASE WHEN page_id % 4 < 3 THEN page_id % 4 END AS c, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, CASE c WHEN 0 THEN NOT starts_with(path, '/The') WHEN 1 THEN true WHEN 2 THEN false ELSE true END AS allowed, CASE WHEN c IS NULL THEN 'unavailable' WHEN c = 2 OR (c = 0 AND starts_with(path, '/The')) THEN 'disallowed' ELSE 'allowed' END AS status, CASE WHEN c = 0 THEN 2.0::DOUBLE END AS crawl_delay FROM u""")
def robots_verdicts(spark, d):
    """Answers by turns: rules, a client error, a server error, none."""
    i = F.col("page_id") % 4
    code = F.when(i == 0, 200).when(i == 1, 404).when(i == 2, 503)
    text = F.when(i == 0, "User-agent: *\nCrawl-delay: 2\nDisallow: /The\n")
    return table(spark, d, "pages").select("page_id", robots.verdict(F.col("url"), code, text, "corpusbot").alias("v")).select("page_id", "v.*")


@query()
def page_image_hashes(spark, d):
    """Embeddings as grey pictures of 8 by 8; hashed as they are and by way of a standard square."""
    byte = F.array_join(F.transform(F.slice("embedding", 1, 64), lambda x: F.lpad(F.hex(F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x * 128 + 128))).cast("int")), 2, "0")), "")
    pics = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.lit(8).alias("width"), F.lit(8).alias("height"), F.unhex(byte).alias("grey"))
    return images.difference_hashes(pics).join(images.difference_hashes(pics, 256).withColumnRenamed("h", "h_invariant"), "id")


def _pictures(spark, d):
    """Embeddings as pictures of 48 by 32: the components as bytes, over and over."""
    byte = F.array_join(F.transform(F.slice("embedding", 1, 64), lambda x: F.lpad(F.hex(F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x * 128 + 128))).cast("int")), 2, "0")), "")
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", F.lit(48).alias("width"), F.lit(32).alias("height"), F.unhex(F.repeat(byte, F.lit(72))).alias("rgb"))


@query()
def image_votes(spark, d):
    return pictures.voted(pictures.with_signals(_pictures(spark, d)))


@query()
def image_anomalies(spark, d):
    """Labels as batches."""
    return pictures.batch_anomalies(_pictures(spark, d), "label")


@query()
def plain_image_scores(spark, d):
    return pictures.plain_scores(_pictures(spark, d))


@query(r"""WITH i AS (SELECT l_suppkey AS page_id, l_orderkey // 20 AS drawing_id, CASE l_linenumber % 3 WHEN 1 THEN 'l' WHEN 2 THEN 're' ELSE 'c' END AS kind, abs(l_quantity - 25) AS dx, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS dy FROM lineitem),
p AS (SELECT page_id, drawing_id, count(*) AS n, count(*) FILTER (WHERE kind = 'l' AND (dx < 0.5 OR dy < 0.5) AND dx + dy > 20) AS hv, count(*) FILTER (WHERE kind = 're') AS re FROM i GROUP BY ALL),
g AS (SELECT page_id, count(*) FILTER (WHERE n >= 3) AS vector, CAST(sum(hv) AS BIGINT) AS hv_lines, CAST(sum(re) AS BIGINT) AS rects FROM p GROUP BY ALL),
t AS (SELECT doc_id AS page_id, CAST(length(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g')) AS BIGINT) AS text_chars, CAST(len(regexp_extract_all(coalesce(text, ''), '(?m)^\s*[•▪◦‣·o\-*]\s+\S')) AS BIGINT) AS bullets FROM documents)
SELECT page_id, text_chars, bullets, coalesce(vector, 0) AS vector, coalesce(hv_lines, 0) AS hv_lines, coalesce(rects, 0) AS rects, CAST(coalesce(hv_lines, 0) >= 6 AND coalesce(vector, 0) >= 12 AS INTEGER) AS native_chart, CAST(coalesce(rects, 0) >= 8 AND text_chars > 100 AS INTEGER) AS table_ FROM t LEFT JOIN g USING (page_id)""")
def page_drawings(spark, d):
    """Line items as items of drawings on pages, documents as the pages' texts."""
    n, q = F.col("l_linenumber") % 3, F.col("l_quantity")
    items = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("page_id"), F.floor(F.col("l_orderkey") / 20).alias("drawing_id"), F.when(n == 1, "l").when(n == 2, "re").otherwise("c").alias("kind"),
        q.alias("x0"), F.lit(0.0).alias("y0"), F.lit(25.0).alias("x1"), F.when(F.col("l_returnflag") == "N", 0.0).otherwise(1.0).alias("y1"),
    )
    return drawings.page_facts(table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), "text"), items)
