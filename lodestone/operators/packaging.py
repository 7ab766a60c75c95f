"""Batches: composition, streaming gate, names and budgets, as windows over ordered candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.operators.ordered import running


def composition(high: float, medium: float) -> tuple[float, float]:
    """Shares of HIGH (at least) and MEDIUM (at most) that hold: weaker ones than the contract's are set to it."""
    return max(high, 0.70), min(medium, 0.30)


def batch_selection(candidates: DataFrame, size: int, high: float = 0.7, medium: float = 0.3, order: str = "id", assigned: str | None = None) -> DataFrame:
    """Adds role (high, medium, surplus, held) to candidates (id, quality): rows that have a name (column `assigned`) first and in any case, then MEDIUM up to its cap, HIGH up to the size; other MEDIUM is surplus."""
    named = F.lit(False) if assigned is None else F.col(assigned).isNotNull()
    rows = candidates.withColumn("_named", named)
    of = lambda q, n: F.count_if((F.col("quality") == q) & (F.col("_named") if n else ~F.col("_named")))
    totals = rows.agg(of("HIGH", True).alias("_ah"), of("MEDIUM", True).alias("_am"), of("HIGH", False).alias("_fh"), of("MEDIUM", False).alias("_fm"))  # one row
    first = rows.where("NOT _named").select(order, "quality").withColumn("_k", F.row_number().over(W.partitionBy("quality").orderBy(order))).where(F.col("_k") <= size)
    out = rows.join(first, [order, "quality"], "left").crossJoin(F.broadcast(totals))
    cap = F.least(F.floor(F.lit(float(size)) * medium), F.floor((F.col("_ah") + F.col("_fh")) * F.lit(medium) / F.lit(high)))
    room = F.greatest(F.lit(size) - F.col("_ah") - F.col("_am"), F.lit(0))
    more = F.least(F.greatest(F.least(cap, F.col("_am") + F.col("_fm")) - F.col("_am"), F.lit(0)), room)
    k = F.coalesce("_k", F.lit(size + 1))
    fresh = F.when(F.col("quality") == "MEDIUM", F.when(k <= more, "medium").otherwise("surplus")).when(k <= room - more, "high").otherwise("held")
    role = F.when(F.col("_named"), F.lower("quality")).otherwise(fresh)
    return out.withColumn("role", role).select(*candidates.columns, "role")


def stream_gate(candidates: DataFrame, size: int, high: float = 0.7, medium: float = 0.3, h0: int = 0, m0: int = 0, order: str = "id") -> DataFrame:
    """Adds kept: a HIGH passes; a MEDIUM passes if fewer are in than the HIGH before it allow. Closed form of the recurrence by running sums and a running minimum."""
    is_m = F.col("quality") == "MEDIUM"
    out = running(candidates, [order], _H=("sum", (F.col("quality") == "HIGH").cast("long")), _k=("sum", is_m.cast("long")))
    h = h0 + F.col("_H")
    f = F.when(h <= 0, 0).otherwise(F.least(F.floor(F.lit(float(size)) * medium), F.floor(h * F.lit(medium) / F.lit(high))))
    out = running(out, [order], _g=("min", F.when(is_m, F.greatest(f, F.lit(m0)) - F.col("_k"))))
    # M_k = min(m0 + k, k + least g up to k); the k-th MEDIUM is kept if M grows at it, i.e. M_k > M_(k-1).
    out = out.withColumn("_m", F.when(is_m, F.least(m0 + F.col("_k"), F.col("_k") + F.col("_g"))))
    own = F.when(is_m, F.struct((F.col("_k") + 1).alias("_k"), F.col("_m").alias("_b")))
    before = out.where(is_m).select(own.alias("o")).select("o.*")
    out = out.join(before.withColumn("quality", F.lit("MEDIUM")), ["_k", "quality"], "left")
    kept = F.when(is_m, F.col("_m") > F.coalesce("_b", F.lit(m0))).otherwise(F.col("quality") == "HIGH")
    return out.withColumn("kept", kept).select(*candidates.columns, "kept")


def batch_folder(batch: Column, width: int = 2) -> Column:
    digits = batch.cast("string")
    return F.concat(F.lit("BATCH_"), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), "0"))


def file_name(batch: Column, counter: Column, ext: Column, kind: str = "file", width: int = 2) -> Column:
    """BATCH_01_file_00001.pptx; pages are of the kind img."""
    return F.concat(batch_folder(batch, width), F.lit(f"_{kind}_"), F.lpad(counter.cast("string"), 5, "0"), F.lit("."), ext)


def with_names(files: DataFrame, batch: str, counter: str, order: str, ext: Column, kind: str = "file") -> DataFrame:
    """Fills `counter` and adds delivered_filename: named files keep their counter, others go on after the largest of their batch, in order."""
    new = F.sum(F.col(counter).isNull().cast("long")).over(W.partitionBy(batch).orderBy(order))
    last = F.coalesce(F.max(counter).over(W.partitionBy(batch)), F.lit(0).cast("long"))
    out = files.withColumn("_n", F.coalesce(F.col(counter), last + new)).drop(counter).withColumnRenamed("_n", counter)
    return out.withColumn("delivered_filename", file_name(F.col(batch), F.col(counter), ext, kind))


def next_batch(largest: Column, node: Column, nodes: Column) -> Column:
    """The smallest batch id over the largest known one that a node owns: those with (id - 1) mod nodes = node."""
    return largest + 1 + F.pmod(node - largest, nodes)


def stale_logs(logs: DataFrame, cutoff: Column, keep: int = 5) -> DataFrame:
    """Rotated logs (name, ts) older than the cutoff, but for the `keep` newest of all rotated ones."""
    rotated = logs.where(F.col("name").rlike(r"\.(gz|[0-9]+)$"))
    newest = rotated.orderBy(F.desc("ts"), F.desc("name")).limit(keep)
    return rotated.where(F.col("ts") < cutoff).join(F.broadcast(newest.select("ts", "name")), ["ts", "name"], "left_anti")


def within_budget(rows: DataFrame, key: str, order: list[str], value: str, cap: float) -> DataFrame:
    """Adds running and kept: rows of a key in order until the first whose running total is over the cap. Values are sizes, none below 0."""
    return running(rows, order, key=key, running=("sum", F.col(value))).withColumn("kept", F.col("running") <= cap)
