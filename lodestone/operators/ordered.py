"""Running aggregates over a total order without a single task for all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of spark.checkpoint.dir; a temporary one where unset, as in tests."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(where or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def running(rows: DataFrame, order: list[str], key: str | None = None, **of: tuple[str, Column]) -> DataFrame:
    """Adds name = running `kind` (sum, min or max) of a column, up to and with each row, for each name=(kind, column); with `key`, among its rows.

    Rows are range-sorted, by key first; each partition has its own running value and a total, and the totals of the
    partitions before it are laid over. Only one row for each partition (and key) meets in one task, however many rows a key
    has. Equal rows of the order are taken in any order.
    """
    kinds = {"sum": F.sum, "min": F.min, "max": F.max}
    keys = [] if key is None else [key]
    placed = rows.withColumns({f"_v_{k}": c for k, (_, c) in of.items()}).repartitionByRange(*keys, *order).withColumn("_p", F.spark_partition_id())
    placed = checkpointed(placed)
    totals = placed.groupBy("_p", *keys).agg(*[kinds[kind](f"_v_{k}").alias(f"_t_{k}") for k, (kind, _) in of.items()])
    before = W.partitionBy(*keys).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("_p", *keys, *[kinds[kind](f"_t_{k}").over(before).alias(f"_b_{k}") for k, (kind, _) in of.items()])
    own = W.partitionBy("_p", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = placed.withColumns({k: kinds[kind](f"_v_{k}").over(own) for k, (kind, _) in of.items()})
    out = out.join(F.broadcast(totals), "_p") if key is None else out.join(totals, ["_p", key])

    def laid(k, kind):
        a, b = F.col(k), F.col(f"_b_{k}")
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)) if kind == "sum" else F.least(a, b) if kind == "min" else F.greatest(a, b)

    return out.select(*rows.columns, *[laid(k, kind).alias(k) for k, (kind, _) in of.items()])
