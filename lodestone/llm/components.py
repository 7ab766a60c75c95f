"""Connected components of an edge table, by hooking to neighbours of least hash and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import cut_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b: longs); root is a node of its component, the same for all of it.

    Each round every node hooks to its neighbour of least hash if that is less than its own, labels are followed two steps
    further, and edges between different labels are all that is left for the next round; so edges shrink by a factor, in
    paths as in stars, and hubs are gone after one round. Labels are aggregated before they are shuffled; nothing goes to
    the driver but whether edges are left. Rounds end in written tables, so that neither plans nor their size estimates
    grow. No edges give no rows.
    """
    ordered = lambda df: cut_table(df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    before = (F.xxhash64("b") < F.xxhash64("a")) | ((F.xxhash64("b") == F.xxhash64("a")) & (F.col("b") < F.col("a")))
    now, total = ordered(edges), None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = cut_table(both.groupBy("a").agg(F.min_by("b", F.xxhash64("b")).alias("b")).select(F.col("a").alias("node"), F.when(before, F.col("b")).otherwise(F.col("a")).alias("root")))
        for _ in range(2):
            hooks = cut_table(hooks.join(hooks.select(F.col("node").alias("root"), F.col("root").alias("next")), "root").select("node", F.col("next").alias("root")))
        further = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        total = hooks if total is None else cut_table(total.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        one = now.join(hooks.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        now = ordered(one.join(hooks.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        if now.isEmpty():
            return total
