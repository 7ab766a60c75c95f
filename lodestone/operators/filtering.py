"""URL filter: ordered reasons, blocklist and domain caps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import urls as U
from lodestone.operators.ordered import running


def blocklist_entry(urls: DataFrame, blocked: DataFrame, patterns: tuple[str, ...] = (), id_col: str = "id") -> DataFrame:
    """(id, entry): the longest dot-suffix of the host that the blocklist (entry) holds, else re: and the first pattern found in the url. Equi-join on suffixes, aggregated by id."""
    host = F.regexp_replace(U.domain(F.col("url")), r":.*$", "")
    s = urls.select(id_col, F.explode(U.host_suffixes(host)).alias("entry"))
    out = s.join(blocked, "entry").groupBy(id_col).agg(F.max_by("entry", F.length("entry")).alias("entry"))
    if not patterns:
        return out
    found = F.lit(None).cast("string")
    for p in reversed(patterns):
        found = F.when(F.col("url").rlike("(?i)" + p), "re:" + p).otherwise(found)
    return urls.select(id_col, found.alias("_re")).join(out, id_col, "left").select(id_col, F.coalesce("entry", "_re").alias("entry")).where("entry IS NOT NULL")


def filter_reasons(urls: DataFrame, blocked: DataFrame, extensions: tuple[str, ...], cap: int, tier_caps: dict[int, int] | None = None, excluded: DataFrame | None = None, patterns: tuple[str, ...] = ()) -> DataFrame:
    """Reasons of the discovered ones of urls (id, url, domain, tier, discovery_source, status): malformed_url, blocklist:entry, excluded_source:entry, extension, domain_cap:cap or kept, the first that holds.

    excluded: a second blocklist (entry). A domain's cap is that of the tier or the common one; it counts the rows kept
    before, by id, and all known urls of the domain that are neither discovered nor filtered out.
    """
    fresh = urls.where("status = 'discovered'")
    out = fresh.join(blocklist_entry(fresh, blocked, patterns), "id", "left")
    of = None if excluded is None else blocklist_entry(fresh, excluded).withColumnRenamed("entry", "_excluded")
    out = out.withColumn("_excluded", F.lit(None).cast("string")) if of is None else out.join(of, "id", "left")
    state = (
        F.when(U.malformed(F.col("url")), "malformed_url").when(F.col("entry").isNotNull(), F.concat(F.lit("blocklist:"), "entry")).when(F.col("_excluded").isNotNull(), F.concat(F.lit("excluded_source:"), "_excluded"))
        .when(~U.format_verified(F.col("discovery_source")) & ~U.extension_ok(F.col("url"), extensions), "extension")
    )
    own = F.lit(cap)
    for tier, c in (tier_caps or {}).items():
        own = F.when(F.col("tier") == tier, c).otherwise(own)
    out = out.withColumn("reason", state).withColumn("cap", own).drop("entry", "_excluded")
    base = urls.where("status NOT IN ('discovered', 'filtered_out')").groupBy("domain").agg(F.count("*").alias("base"))
    asking = out.where("reason IS NULL").select("id", "domain", "cap")
    kept = mixed_caps(asking, sorted({cap, *(tier_caps or {}).values()}), base=base).select("id", "kept")
    out = out.join(kept, "id", "left")
    reason = F.coalesce("reason", F.when(F.col("kept"), "kept").otherwise(F.concat(F.lit("domain_cap:"), F.col("cap").cast("string"))))
    return out.withColumn("reason", reason).drop("kept", "cap")


def mixed_caps(rows: DataFrame, caps: list[int], key: str = "domain", order: str = "id", cap_col: str = "cap", base: DataFrame | None = None) -> DataFrame:
    """Adds kept for rows whose caps differ: a row is kept if fewer of its key were kept before it, with those of base (key, base), than its cap. One pass for each distinct cap, in rising order; no pass takes a key's rows into one task."""
    base = rows.select(key).limit(0).withColumn("base", F.lit(0).cast("long")) if base is None else base
    left, done, have = rows, None, base
    for c in sorted(caps):
        ranked = running(left, [order], key=key, _k=("sum", F.lit(1).cast("long")))
        ranked = ranked.join(have, key, "left").withColumn("_in", F.col("_k") <= F.lit(c) - F.coalesce("base", F.lit(0)))
        settled = ranked.where(F.col("_in") | (F.col(cap_col) == c)).select(*rows.columns, F.col("_in").alias("kept"))
        done = settled if done is None else done.union(settled)
        left = ranked.where(~F.col("_in") & (F.col(cap_col) != c)).select(*rows.columns)
        more = ranked.where("_in").groupBy(key).agg(F.count("*").alias("base"))
        have = have.union(more).groupBy(key).agg(F.sum("base").alias("base"))
    return done


def walked(roots: DataFrame, links: DataFrame, depth: int = 4, most: int = 500) -> DataFrame:
    """(url, depth) of the sitemaps reached from roots (url) along links (parent, url): each once at its least depth, at most `most` by depth and url."""
    seen = front = roots.select("url").distinct().withColumn("depth", F.lit(0))
    for k in range(1, depth + 1):
        front = links.join(front.select(F.col("url").alias("parent")), "parent").select("url").distinct().join(seen, "url", "left_anti").withColumn("depth", F.lit(k))
        seen = seen.union(front)
    return seen.orderBy("depth", "url").limit(most)
