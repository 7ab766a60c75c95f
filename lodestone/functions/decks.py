"""Slide flags, deck quality and page selection as column expressions. Thresholds are doubles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    min_slides: int = 5
    text_only: float = 0.75
    photo_low: float = 0.50
    high: float = 0.50
    high_charts: int = 3
    photo_high: float = 0.30
    medium: float = 0.40
    medium_charts: int = 1
    epsilon: float = 0.03


def objects(c=F.col) -> Column:
    return c("native_chart") + c("diagram") + c("table_") + c("ole") + c("image_analytical")


def with_flags(slides: DataFrame) -> DataFrame:
    """Adds analytical, chart_page, photo_heavy, text_only to slides."""
    a = objects() > 0
    return slides.withColumns({
        "analytical": a, "chart_page": F.col("native_chart") + F.col("diagram") + F.col("image_analytical") > 0,
        "photo_heavy": (F.col("image_photo") >= 1) & ~a & (F.col("text_chars") < 200), "text_only": ~a & (F.col("image_count") == 0) & (F.col("vector") == 0),
    })


def deck_metrics(slides: DataFrame, key: str) -> DataFrame:
    """Per deck: slides, content slides (not filler) and counts over content slides."""
    n = lambda c: F.count_if(~F.col("filler") & F.col(c))
    return with_flags(slides).groupBy(key).agg(
        F.count("*").alias("slides"), F.count_if(~F.col("filler")).alias("content"), n("analytical").alias("analytical"), n("chart_page").alias("charts"), n("photo_heavy").alias("photos"), n("text_only").alias("texts"))


def deck_decision(metrics: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Adds quality (HIGH, MEDIUM, LOW), borderline and decision (DELIVER, REVIEW, REJECT)."""
    share = lambda c: F.col(c) / F.col("content").cast("double")
    early = (F.col("slides") < t.min_slides) | (F.col("content") == 0)
    a, p, x = (F.when(F.col("content") > 0, share(c)).otherwise(F.lit(0.0)) for c in ("analytical", "photos", "texts"))
    low = (x >= t.text_only) | (p >= t.photo_low) | (F.col("analytical") == 0)
    high = (a >= t.high) & (F.col("charts") >= t.high_charts) & (p < t.photo_high)
    medium = (a >= t.medium) & (F.col("charts") >= t.medium_charts)
    near = lambda v, at: F.abs(v - F.lit(at)) <= t.epsilon
    signal = near(a, t.high) | near(a, t.medium) | near(p, t.photo_high) | near(x, t.text_only) | near(p, t.photo_low)
    out = metrics.withColumn("quality", F.when(early | low, "LOW").when(high, "HIGH").when(medium, "MEDIUM").otherwise("LOW"))
    review = ~early & signal & ((F.col("quality") != "LOW") | (F.col("analytical") > 0))
    return out.withColumn("borderline", review).withColumn("decision", F.when(review, "REVIEW").when(F.col("quality") == "LOW", "REJECT").otherwise("DELIVER"))


def page_reason() -> Column:
    """Why a page is graphical or not; the first rule that holds. Accepted: analytical, vector_graphics."""
    c = F.col
    a, t = objects(), c("text_chars")
    return (
        F.when(c("filler"), "filler").when((a == 0) & (c("vector") == 0), "no_analytical_content").when((c("table_") >= 1) & (c("ole") >= 1) & (t > 500), "spreadsheet_dump")
        .when((t > 400) & (c("bullets") > 3), "text_heavy_with_bullets").when((a == 1) & (c("image_analytical") == 1) & (t > 400), "decorative_image_with_text")
        .when((c("table_") >= 1) & (a == c("table_")) & (t > 800), "table_text_dump")
        .when((c("native_chart") + c("diagram") == 0) & (c("image_analytical") < 2) & (c("ole") == 0) & (t > 200), "weak_analytical_with_text").when(a > 0, "analytical").otherwise("vector_graphics")
    )


#: Families of filler texts, in order (fixed values).
FILLER = (
    ("agenda", r"(?im)^\s*(agenda|outline|contents?|table of contents|today'?s (topics|agenda)|overview of (the )?presentation)\s*$"),
    ("thank_you", r"(?i)\b(thank\s*you|thanks|merci|gracias|danke|obrigado|谢谢|ありがとう)\b[\s!.]*$"),
    ("qa", r"(?im)^\s*(q\s*&\s*a|questions\??|any questions\??|discussion)\s*$"),
    ("divider", r"(?im)^\s*(section|part|chapter|appendix)\s*[:\-]?\s*[\divxIVX]*\s*$"),
    ("disclaimer", r"(?i)\b(safe harbor|forward.looking statements?|disclaimer|legal notice|cautionary statement)\b"),
)


def filler_reason(text: Column, chars: Column, at_edge: Column, photos: Column | None = None, images: Column | None = None, vectors: Column | None = None, analytical: Column | None = None) -> Column:
    """Why a slide is filler; null where it is not. Slides with analytical objects never are."""
    photos, images, vectors = (F.lit(0) if c is None else c for c in (photos, images, vectors))
    analytical = F.lit(False) if analytical is None else analytical
    out = F.when(at_edge & (chars <= 200) & (photos <= 1), "title_or_closing").when((chars <= 40) & (images == 0) & (vectors == 0), "near_empty_divider")
    for name, pattern in reversed(FILLER):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return F.when(~analytical, out)
