"""Structured Streaming twins: windowed counts, first-seen dedup and the breaker as keyed state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type in tumbling windows; late ones are dropped after the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(payloads: DataFrame, late: str = "2 days") -> DataFrame:
    """Payloads (sha256, ts, ...) whose hash did not come before, within the watermark."""
    return payloads.withWatermark("ts", late).dropDuplicatesWithinWatermark(["sha256"])


def breaker(events: DataFrame, limit: int = 3, park_hours: int = 48, parks: int = 2) -> DataFrame:
    """Circuit breaker over a stream of (key, ts, failed): (key, ts, state) after each event; state per key: streak, parks, parked until, blacklisted."""

    def step(key, batches, state: GroupState):
        import pandas as pd

        streak, parked, until, black = state.get if state.exists else (0, 0, 0, False)
        for b in batches:
            b = b.sort_values("ts")
            out = []
            for ts, bad in zip(b["ts"], b["failed"]):
                now = int(ts.timestamp())
                if until and now >= until:
                    until, streak = 0, 0
                if not black and not until:
                    streak = streak + 1 if bad else 0
                    if streak >= limit:
                        streak, parked = 0, parked + 1
                        black = parked >= parks
                        until = 0 if black else now + park_hours * 3600
                out.append("blacklisted" if black else "parked" if until else "active")
            yield pd.DataFrame({"key": key[0], "ts": b["ts"], "state": out})
        state.update((streak, parked, until, black))

    return events.groupBy("key").applyInPandasWithState(step, "key long, ts timestamp, state string", "streak long, parks long, until long, black boolean", "append", GroupStateTimeout.NoTimeout)
