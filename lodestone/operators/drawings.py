"""Facts of PDF pages from their drawings, given as tables: a row for each item of a path, and the pages' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the rules. A path of three items is a vector drawing; lines count if level or upright within 0.5 points and over 20 long.
PATH_ITEMS, SLACK, LINE = 3, 0.5, 20
#: A chart has so many such lines and drawings; a table so many rectangles, beside more than so many characters.
CHART_LINES, CHART_DRAWINGS, TABLE_RECTANGLES, TABLE_CHARS = 6, 12, 8, 100
BULLET = r"(?m)^\s*[•▪◦‣·o\-*]\s+\S"


def page_facts(pages: DataFrame, items: DataFrame) -> DataFrame:
    """page_id, text_chars (not white space), bullets, vector, hv_lines, rects, native_chart and table_ (0 or 1) for each row of pages (page_id, text).

    items: page_id, drawing_id, kind (l: a line, re: a rectangle, others), x0, y0, x1, y1. Pages without items have no
    drawings; null texts no characters; items of unknown pages are left out.
    """
    dx, dy = F.abs(F.col("x0") - F.col("x1")), F.abs(F.col("y0") - F.col("y1"))
    line = (F.col("kind") == "l") & ((dx < SLACK) | (dy < SLACK)) & (dx + dy > LINE)
    paths = items.groupBy("page_id", "drawing_id").agg(F.count("*").alias("n"), F.count_if(line).alias("hv"), F.count_if(F.col("kind") == "re").alias("re"))
    drawn = paths.groupBy("page_id").agg(F.count_if(F.col("n") >= PATH_ITEMS).alias("vector"), F.sum("hv").alias("hv_lines"), F.sum("re").alias("rects"))
    text = F.coalesce("text", F.lit(""))
    out = pages.select("page_id", F.length(F.regexp_replace(text, r"\s", "")).cast("long").alias("text_chars"), F.regexp_count(text, F.lit(BULLET)).cast("long").alias("bullets"))
    out = out.join(drawn, "page_id", "left").na.fill(0, ["vector", "hv_lines", "rects"])
    chart = (F.col("hv_lines") >= CHART_LINES) & (F.col("vector") >= CHART_DRAWINGS)
    table = (F.col("rects") >= TABLE_RECTANGLES) & (F.col("text_chars") > TABLE_CHARS)
    return out.withColumn("native_chart", chart.cast("int")).withColumn("table_", table.cast("int"))
