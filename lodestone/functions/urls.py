"""URL columns: host, path, gates and hash shards. Nulls give nulls, or '' where a string is asked for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sources whose formats are verified elsewhere (fixed values).
FORMAT_VERIFIED = ("wayback", "zenodo", "figshare", "osf", "internet_archive", "ietf", "govdata")


def domain(url: Column) -> Column:
    """Lower-case network location; '' where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def malformed(url: Column) -> Column:
    return ~F.coalesce(url, F.lit("")).rlike(r"^(?i:https?)://[^/?#]+")


def extension_ok(url: Column, extensions: tuple[str, ...]) -> Column:
    p = F.lower(path(url))
    ok = F.lit(False)
    for e in extensions:
        ok = ok | p.endswith(e)
    return ok


def format_verified(source: Column) -> Column:
    ok = F.lit(False)
    for s in FORMAT_VERIFIED:
        ok = ok | F.coalesce(source, F.lit("")).startswith(s)
    return ok


def host_suffixes(host: Column) -> Column:
    """Dot-suffixes of a host with two labels at least, longest first."""
    labels = F.split(F.regexp_replace(host, r":\d+$", ""), r"\.")
    n = F.size(labels)
    return F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(labels, i, n), "."))).otherwise(F.array().cast("array<string>"))


def file_name(url: Column, most: int = 255) -> Column:
    """Last path segment, percent-decoded (a plus stays one), cut to `most` characters; 'unnamed' where there is none."""
    last = F.regexp_extract(path(url), r"([^/]*)$", 1)
    plain = F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last)
    return F.when(plain == "", "unnamed").otherwise(F.substring(plain, 1, most))


def bucket(url: Column) -> Column:
    """0..99 from sha1."""
    return F.conv(F.substring(F.sha1(url), 1, 8), 16, 10).cast("long") % 100


def shard(host: Column, nodes: int) -> Column:
    """Owner 0..nodes-1 from the first 8 bytes of sha1 of the lower-case host."""
    return (F.conv(F.substring(F.sha1(F.lower(host)), 1, 16), 16, 10).cast("decimal(20,0)") % nodes).cast("int")


def absolute(base: Column, link: Column) -> Column:
    """A link resolved against the url of its page as RFC 3986 says (dot segments, queries, fragments, other schemes); '' without host."""
    part = lambda c, i: F.regexp_extract(c, r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$", i)
    scheme, host, folder = F.lower(part(base, 1)), part(base, 2), part(base, 3)
    own = F.lower(part(link, 1))
    # A scheme equal to the page's, without host, says nothing.
    rest = F.when((own == scheme) & ~link.rlike(r"^[^:]*://"), F.regexp_replace(link, r"^[^:]*:", "")).otherwise(link)
    path, query, mark = part(rest, 3), part(rest, 4), part(rest, 5)
    steps = F.split(path, "/", -1)
    before = F.slice(F.split(folder, "/", -1), F.lit(1), F.size(F.split(folder, "/", -1)) - 1)
    steps = F.when(path.startswith("/"), steps).otherwise(F.concat(F.when(F.size(before) > 0, before).otherwise(F.array(F.lit(""))), steps))
    inner = F.filter(steps, lambda x, i: (x != "") | (i == 0) | (i == F.size(steps) - 1))
    steps = F.when(path.startswith("/"), steps).otherwise(inner)
    stand = F.aggregate(steps, F.array().cast("array<string>"), lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.concat(a, F.array(x))))
    stand = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(stand, F.array(F.lit("")))).otherwise(stand)
    resolved = F.regexp_replace(F.concat(F.lit("/"), F.array_join(stand, "/")), "^//", "/")
    tail = F.concat(F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(mark != "", F.concat(F.lit("#"), mark)).otherwise(""))
    kept = F.concat(folder, F.when((query == "") & (part(base, 4) != ""), F.concat(F.lit("?"), part(base, 4))).otherwise(""), tail)
    out = (
        F.when(link == "", base).when((own != "") & link.rlike(r"^[^:]*://"), link).when((own != "") & (own != scheme), F.lit(""))
        .when(rest.startswith("//"), F.concat(scheme, F.lit(":"), rest)).otherwise(F.concat(scheme, F.lit("://"), host, F.when(path == "", kept).otherwise(F.concat(resolved, tail))))
    )
    return F.when(F.coalesce(domain(out), F.lit("")) == "", F.lit("")).otherwise(out)


def base_delay(host: Column, overrides: dict[str, float], default: float, crawl_delay: Column) -> Column:
    """Seconds between requests to a host: the first override whose name is the host's or one of its suffixes, else the default; never less than the site's own crawl delay."""
    h, out = F.lower(host), F.lit(float(default))
    for name, delay in reversed(overrides.items()):
        out = F.when((h == name) | h.endswith(f".{name}"), F.lit(float(delay))).otherwise(out)
    return F.greatest(out, F.coalesce(crawl_delay.cast("double"), F.lit(0.0)))


def folder_id(url: Column) -> Column:
    """Id of the shared folder that a url of a drive names; '' for other urls and plain names."""
    last = F.element_at(F.split(url, "/folders/"), -1)
    named = url.contains("drive.google.com") & url.contains("/folders/")
    return F.when(named, F.regexp_replace(F.substring_index(last, "?", 1), "^/+|/+$", "")).otherwise("")
