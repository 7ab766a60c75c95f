"""Compliance screens over a text column; null counts as empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and prefixes: fixed values.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
GENERIC = ("info@", "contact@", "press@", "media@", "ir@", "investor", "office@", "support@", "sales@", "hello@", "admin@", "webmaster@", "enquiries@", "communications@", "pr@", "news@")
PHONE = r"(?<![\d.\-])(?:\+?\d{1,3}[\s.\-]?)?(?:\(\d{2,4}\)[\s.\-]?)?\d{3}[\s.\-]\d{3,4}[\s.\-]?\d{0,4}(?![\d.])"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
ID_NUMBER = r"(?i)\b(?:passport|national id|nationalid|driver'?s licen[cs]e|tax id|nino|ssn)\b[^\n]{0,20}?[:#]?\s*[A-Z0-9][A-Z0-9\-]{5,}"
MINOR = r"(?i)\b(children under 13|under-13|coppa|kindergarten|elementary school students|pupils?' (names?|records?|data)|student records?|minors?' personal|child(?:ren)?'s personal (?:data|information))\b"
MINOR_CONTEXT = r"(?i)\b(name|address|birthdate|date of birth|photo|email|phone)\b"
PROHIBITED = (
    ("adult", r"(?i)\b(explicit sexual|pornograph\w+|xxx[\s-]rated|escort service)\b"),
    ("violent", r"(?i)\b(beheading|gore video|graphic violence|torture footage|snuff)\b"),
    ("extremist", r"(?i)\b(jihadist propaganda|white supremac\w+|neo-nazi|terrorist recruitment|extremist manifesto)\b"),
)
RIGHTS = r"(©|\(c\)|copyright)\s*(?:19|20)\d{2}\s+(?!.*(all rights reserved by (the )?author|company confidential))[A-Z][A-Za-z&., ]{3,60}"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def emails(c: Column) -> Column:
    """Number of e-mail addresses that are not an organisation's."""
    generic = lambda e: F.lower(e).rlike("|".join(GENERIC))
    return F.size(F.filter(F.regexp_extract_all(_text(c), F.lit(EMAIL), F.lit(0)), lambda e: ~generic(e))).cast("long")


def times(c: Column, pattern: str) -> Column:
    return F.regexp_count(_text(c), F.lit(pattern)).cast("long")


def pii(c: Column, phones: bool = True) -> Column:
    hit = (times(c, SSN) > 0) | (times(c, ID_NUMBER) > 0) | (emails(c) > 3)
    return F.when(hit | (times(c, PHONE) > 10) if phones else hit, "REVIEW").otherwise("PASS")


def minors(c: Column) -> Column:
    return F.when(_text(c).rlike(MINOR) & _text(c).rlike(MINOR_CONTEXT), "REVIEW").otherwise("PASS")


def prohibited_category(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(PROHIBITED):
        out = F.when(_text(c).rlike(pattern), name).otherwise(out)
    return out


def prohibited(c: Column) -> Column:
    return F.when(prohibited_category(c).isNotNull(), "REJECT").otherwise("PASS")


def rights(c: Column) -> Column:
    return F.when(times(c, RIGHTS) >= 5, "REVIEW").otherwise("PASS")


def merged(decision: Column, rejects: Column, reviews: Column) -> Column:
    """Screens over a decision: a reject always stands, a review holds back what would be delivered."""
    return F.when(rejects, "REJECT").when(reviews & (decision == "DELIVER"), "REVIEW").otherwise(decision)


#: Words of labels that speak for and against graphics (fixed values); the first group goes first.
GRAPHICS = ("chart", "graph", "map", "infographic", "diagram", "flowchart", "visualization")
OTHER = ("text", "photo", "logo", "decorative", "table", "spreadsheet")


def label_share(labels: Column, scores: Column) -> Column:
    """Share of the scores of graphics labels in those of all known labels; 0.5 if they are 0."""
    has = lambda x, known: F.lower(x).rlike("|".join(known))
    total = lambda keep: F.aggregate(F.arrays_zip(labels.alias("l"), scores.alias("s")), F.lit(0.0), lambda a, x: a + F.when(keep(x["l"]), x["s"]).otherwise(0.0))
    g, n = total(lambda x: has(x, GRAPHICS)), total(lambda x: ~has(x, GRAPHICS) & has(x, OTHER))
    return F.when(g + n > 0, g / (g + n)).otherwise(0.5)


def label_band(p: Column, high: float = 0.70, low: float = 0.40) -> tuple[Column, Column]:
    """Band and its reason; bounds of bands belong to the upper one, those of reasons to the lower."""
    band = F.when(p >= F.lit(high), "pass").when(p >= F.lit(low), "borderline").otherwise("reject")
    reason = (
        F.when(band == "pass", F.when(p > F.lit(0.85), "high_confidence_graphics").otherwise("moderate_confidence_graphics"))
        .when(band == "borderline", F.when(p > F.lit(0.55), "leaning_graphics_but_uncertain").when(p > F.lit(0.45), "even_split").otherwise("leaning_non_graphics_but_uncertain"))
        .otherwise(F.when(p < F.lit(0.25), "clearly_non_graphics").otherwise("likely_non_graphics"))
    )
    return band, reason


def findings(c: Column, robots: Column, pirate: Column, phones: bool = True) -> Column:
    """All screens of a text in one struct: a verdict for each, details (screen -> what it found), forces_review, forces_reject.

    robots: how the site answered (disallowed, unavailable, else allowed); pirate: the blocklist entry that the url met,
    null or empty for none. Screens without a finding have no detail, but for rights.
    """
    n = lambda count, least, name: F.when(count >= least, F.concat(count.cast("string"), F.lit(f" {name}")))
    counted = [n(times(c, SSN), 1, "SSN-like patterns"), n(times(c, ID_NUMBER), 1, "ID-number patterns"), n(emails(c), 4, "non-organizational email addresses")]
    counted += [n(times(c, PHONE), 11, "phone-number-like strings")] if phones else []
    listed = F.concat_ws("; ", *counted)
    young = F.slice(F.regexp_extract_all(_text(c), F.lit(MINOR), F.lit(0)), 1, 5)
    context = F.when(_text(c).rlike(MINOR_CONTEXT), "child-focused keywords with personal-data context: ").otherwise("child-related keywords without personal-data context: ")
    word = F.lit(None).cast("string")
    for name, pattern in reversed(PROHIBITED):
        word = F.when(_text(c).rlike(pattern), F.concat(F.lit(f"prohibited content ({name}): matched '"), F.regexp_extract(_text(c), pattern, 0), F.lit("'"))).otherwise(word)
    notices, blocked = times(c, RIGHTS), F.coalesce(pirate, F.lit("")) != ""
    details = {
        "pirate": F.when(blocked, F.concat(F.lit("blocklist match: "), pirate)),
        "robots": F.when(robots == "disallowed", "robots.txt disallowed").when(robots == "unavailable", "robots.txt unavailable at fetch time (treated as allow)"),
        "pii": F.when(listed != "", listed),
        "minors": F.when(F.size(young) > 0, F.concat(context, F.array_join(young, ", "))),
        "prohibited": word,
        "rights": F.coalesce(n(notices, 5, "third-party copyright notices detected"), F.lit("no dense third-party copyright signals; not individually reviewed")),
    }
    verdicts = {
        "pirate": F.when(blocked, "REJECT").otherwise("PASS"),
        "robots": F.when(robots == "disallowed", "REJECT").otherwise("PASS"),
        "rights": F.when(notices >= 5, "REVIEW").otherwise("PASS"),
        "pii": F.when(listed != "", "REVIEW").otherwise("PASS"),
        "minors": minors(c),
        "prohibited": prohibited(c),
    }
    some = lambda names, verdict: F.array_contains(F.array(*[verdicts[k] for k in names]), verdict)
    return F.struct(
        *[v.alias(k) for k, v in verdicts.items()],
        F.map_filter(F.create_map(*[x for k, v in details.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull()).alias("details"),
        some(("rights", "pii", "minors"), "REVIEW").alias("forces_review"),
        some(("pirate", "robots", "prohibited"), "REJECT").alias("forces_reject"),
    )
