"""Candidate urls out of tables of responses (source, method, url, body): pages, JSON answers, OAI records."""

from __future__ import annotations

import json
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import urls as U
from lodestone.sources.readers import doc_links

# Patterns: fixed values.
OAI_RECORD = r"(?i)<dc:identifier>\s*(https?://[^<]+?)\s*</dc:identifier>"
OAI_TOKEN = r"<resumptionToken[^>]*>([^<]+)</resumptionToken>"
EXTENSIONS = (".pptx", ".ppt")


def oai_identifiers(body: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(OAI_RECORD), F.lit(1))


def oai_token(body: Column) -> Column:
    """Token of the next page of a list, null on the last one."""
    return F.nullif(F.trim(F.regexp_extract(F.coalesce(body, F.lit("")), OAI_TOKEN, 1)), F.lit(""))


def json_urls(body: Column, extensions: tuple[str, ...] = EXTENSIONS, depth: int = 8) -> Column:
    """Urls of documents among the string values of a JSON text, in order, down to `depth` levels; what can't be read gives none."""

    def found(text: str | None) -> list[str]:
        try:
            level = [(json.loads(text), 0)]
        except (TypeError, ValueError, RecursionError):
            return []
        out = []
        while level:
            value, at = level.pop()
            if at > depth:
                continue
            if isinstance(value, (dict, list)):
                level += [(v, at + 1) for v in reversed(list(value.values()) if isinstance(value, dict) else value)]
            elif isinstance(value, str) and value.strip().startswith("http"):
                try:
                    if urlsplit(value.strip()).path.lower().endswith(extensions):
                        out.append(value.strip())
                except ValueError:
                    pass
        return out

    @F.pandas_udf("array<string>")
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(found)

    return walk(body)


def candidates(responses: DataFrame, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """(url, domain, discovery_source) of documents that responses (source, method, url, body) name.

    method: html (links, resolved against the url), json (values) or oai (identifiers); others give nothing. A url that a
    source names twice is one row.
    """
    html = responses.where("method = 'html'").select("source", "url", F.explode(doc_links(F.col("body"))).alias("link")).select("source", U.absolute(F.col("url"), F.col("link")).alias("url"))
    answers = responses.where("method = 'json'").select("source", F.explode(json_urls(F.col("body"), extensions)).alias("url"))
    records = responses.where("method = 'oai'").select("source", F.explode(oai_identifiers(F.col("body"))).alias("url"))
    rows = html.union(answers).union(records).where(U.extension_ok(F.col("url"), extensions) & (U.domain(F.col("url")) != ""))
    return rows.select("url", U.domain(F.col("url")).alias("domain"), F.col("source").alias("discovery_source")).distinct()


def next_requests(responses: DataFrame) -> DataFrame:
    """(source, url, token) of OAI lists that go on: what to ask for next."""
    return responses.where("method = 'oai'").select("source", "url", oai_token(F.col("body")).alias("token")).where("token IS NOT NULL")
