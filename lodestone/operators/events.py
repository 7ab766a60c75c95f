"""Operators over ordered events: fetch verdicts, failure streaks, breaker, latches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def head_verdict(status: Column, ctype: Column, length: Column, most: int, least: int) -> Column:
    """retry, ok, skip_html or skip_size; what a header doesn't say is no ground to skip."""
    return (
        F.when((status == 429) | (status >= 500), "retry").when(status >= 400, "ok").when(F.trim(F.substring_index(F.lower(F.coalesce(ctype, F.lit(""))), ";", 1)).startswith("text/html"), "skip_html")
        .when(length.isNotNull() & ((length < least) | (length > most)), "skip_size").otherwise("ok")
    )


def failure_streaks(events: DataFrame, key: str, failed: Column, order: list[str]) -> DataFrame:
    """Adds streak: failures in a row so far, 0 at a success."""
    by = W.partitionBy(key).orderBy(*order)
    out = events.withColumn("_f", failed).withColumn("_island", F.count_if(~F.col("_f")).over(by))
    run = F.count_if("_f").over(W.partitionBy(key, "_island").orderBy(*order))
    return out.withColumn("streak", F.when(F.col("_f"), run).otherwise(F.lit(0).cast("long"))).drop("_f", "_island")


def latch(events: DataFrame, key: str, order: list[str], sets: Column, clears: Column, name: str) -> DataFrame:
    """Adds a boolean that `sets` turns on and `clears` turns off, and that stays in between; off at first."""
    v = F.when(sets, True).when(clears, False)
    return events.withColumn(name, F.coalesce(F.last(v, ignorenulls=True).over(W.partitionBy(key).orderBy(*order)), F.lit(False)))


def breaker(events: DataFrame, limit: int = 3, park_hours: int = 48, parks: int = 2) -> DataFrame:
    """Circuit breaker over events (key, event_id, ts, failed): per event the state after it (active, parked, blacklisted).

    The third failure in a row parks the key for 48 hours, the second park blacklists it; events of a parked or
    blacklisted key are skipped (state unchanged). One key's events are replayed in one task, in order.
    """

    def replay(pdf):
        pdf = pdf.sort_values(["ts", "event_id"])
        streak, parked, until, black, out = 0, 0, None, False, []
        for ts, bad in zip(pdf["ts"], pdf["failed"]):
            if until is not None and ts >= until:
                until, streak = None, 0
            if not black and until is None:
                streak = streak + 1 if bad else 0
                if streak >= limit:
                    streak, parked = 0, parked + 1
                    black = parked >= parks
                    until = None if black else ts + __import__("pandas").Timedelta(hours=park_hours)
            out.append("blacklisted" if black else "parked" if until is not None else "active")
        return pdf[["key", "event_id"]].assign(state=out)

    kind = events.schema["key"].dataType.simpleString()
    return events.groupBy("key").applyInPandas(replay, f"key {kind}, event_id long, state string")
