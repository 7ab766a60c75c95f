"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight; its share of the words is its target. A source's rate
over training time t in [0, 1] is 1 + g (2t - 1) times its mean, with a slope g
of its own; the integral t + g (t^2 - t) is its cumulative demand. Documents
stand in a fixed random order, whose running word count per source, repeated as
often as the target asks, is the supply; inverting the demand at a document's
place in the supply gives its training position, and documents are range-sorted
by position. The word at which the target ends lies inside at most one document
of a source, which is taken in part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import anchored, cut, cut_table, joined_small, table, with_row_key

WEIGHTS = (5, 2, 1)
#: Slopes of the rate over time, for sources in order, repeating.
SLOPES = (-0.5, 0.0, 0.5)
MOST_REPEATS = 3
WHITE = r"[\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, repeats: int = MOST_REPEATS) -> DataFrame:
    """sizes: _source, source, source_size (a row for each source). Adds target and slope.

    Targets share all words by weight and stop at `repeats` times the source's size; what is over is shared again by
    weight among the others: min(cap, level * weight) for the level at which the sum is right.
    """
    n = len(weights)
    order = W.orderBy(F.col("source").isNull(), "source")
    k = F.row_number().over(order) - 1
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col("k"), F.lit(len(values))) + 1).cast("int"))
    out = sizes.withColumn("k", k).withColumn("weight", of([int(w) for w in weights])).withColumn("slope", of([float(s) for s in slopes])).withColumn("cap", F.col("source_size") * repeats)
    ratio = F.col("cap") / F.col("weight").cast("double")
    filled = W.orderBy("ratio", "k")
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    rest = filled.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    out = out.withColumn("ratio", ratio).withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest).cast("double"))
    # The first source, by ratio, that its cap does not stop sets the level for itself and all after it.
    at = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "k", "level"))).over(whole)["level"]
    out = out.withColumn("level_", at)
    return out.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level_") * F.col("weight"))).select("_source", "source_size", F.coalesce("target", F.col("cap").cast("double")).alias("target"), "slope")


def mixed(docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, repeats: int = MOST_REPEATS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """_row, id, size, source_size, target, taken and positions (training position of each copy taken, in [0, 1]).

    One row for each row of docs. Null and empty texts and texts of white space have size 0 and are never taken; a null
    source is a source of its own, last; null ids and repeated rows are kept. Which rows of equal id and size are taken is
    arbitrary. Texts count whole, however long; other columns are not read. An empty table gives no rows.
    """
    keyed = with_row_key(anchored(docs))
    size = F.size(F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), WHITE), "")).cast("long")
    h = F.md5(F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.col("size").cast("string")))
    rows = (
        keyed.select("_row", F.col(id_col).alias("_id"), F.col(source_col).alias("source"), size.alias("size"))
        .withColumn("_source", F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source"))).withColumn("h", h)
    )
    rows = cut_table(rows)
    # Running totals of range-sorted parts: neither a source nor rows of equal id and size stand in one task.
    order = ["h", "_id", "size", "_row"]
    rows = cut_table(rows.repartitionByRange("_source", *order).withColumn("_part", F.spark_partition_id()))
    sums = cut(rows.groupBy("_source", "source", "_part").agg(F.sum("size").alias("s")))
    targets = source_targets(sums.groupBy("_source", "source").agg(F.sum("s").alias("source_size")), weights, slopes, repeats)
    prior = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("_source", "_part", prior("s", W.partitionBy("_source").orderBy("_part")).alias("offset"))
    offsets = cut_table(sums.join(targets, "_source").select("_source", "_part", "offset", "source_size", "target", "slope"))
    placed = joined_small(rows, offsets, ["_source", "_part"]).withColumn("c", F.col("offset") + prior("size", W.partitionBy("_source", "_part").orderBy(*order)))
    goal = F.floor("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    part = F.least(F.greatest(goal - F.col("rounds") * F.col("source_size") - F.col("c"), F.lit(0)), F.col("size"))
    placed = placed.withColumn("rounds", rounds).withColumn("part", part).withColumn("taken", F.col("rounds") * F.col("size") + F.col("part"))
    copies = F.when(F.col("taken") > 0, F.sequence(F.lit(0).cast("long"), F.col("rounds") + (F.col("part") > 0).cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    g = F.col("slope")

    def position(copy):
        u = F.least((copy * F.col("source_size") + F.col("c")) / F.col("target"), F.lit(1.0))
        return F.when(g == 0, u).otherwise(F.abs((F.sqrt((1 - g) * (1 - g) + 4 * g * u) - (1 - g)) / (2 * g)))

    return placed.select("_row", F.col("_id").alias(id_col), "size", "source_size", "target", "taken", F.transform(copies, position).alias("positions"))


def by_position(df: DataFrame) -> DataFrame:
    """Range-sorts by first position; what is not taken comes last."""
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    return df.withColumn("_at", first).repartitionByRange("_at", "_row").sortWithinPartitions("_at", "_row").drop("_at")


def in_order(mix: DataFrame) -> DataFrame:
    """The training order: a row for each copy taken (its columns, copy from 0, position, and words: how many of it are taken), range-sorted by position."""
    whole = F.col("size") - F.greatest((F.col("copy") + 1) * F.col("size") - F.col("taken"), F.lit(0))
    out = mix.select("*", F.posexplode("positions").alias("copy", "position")).withColumn("words", whole).drop("positions")
    return out.repartitionByRange("position", "_row", "copy").sortWithinPartitions("position", "_row", "copy")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = by_position(mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source")))
    # Positions of all copies, as parts of a million millions.
    all_ = F.array_join(F.transform("positions", lambda p: F.floor(p * F.lit(1e12)).cast("string")), ",")
    return out.select("doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("position"), all_.alias("positions"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
hd AS (SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(size AS VARCHAR)) AS h FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + k % 3] AS weight, [-0.5, 0.0, 0.5][1 + k % 3]::DOUBLE AS g, 3 * source_size AS cap FROM s),
r AS (SELECT *, cap::DOUBLE / weight::DOUBLE AS ratio FROM w),
lv AS (SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(sum(cap) OVER (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))::DOUBLE / (CAST(sum(weight) OVER (ORDER BY ratio, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT))::DOUBLE AS level FROM r),
one AS (SELECT level AS lvl FROM lv WHERE level <= ratio ORDER BY ratio, k LIMIT 1),
t AS (SELECT source, source_size, g, coalesce(least(cap::DOUBLE, lvl * weight), cap::DOUBLE) AS target FROM lv LEFT JOIN one ON true),
c AS (SELECT hd.doc_id, size, source_size, target, g, coalesce(CAST(sum(size) OVER (PARTITION BY hd.source ORDER BY h, hd.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS c FROM hd JOIN t ON hd.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS rounds FROM c),
k AS (SELECT *, rounds * size + least(greatest(CAST(floor(target) AS BIGINT) - rounds * source_size - c, 0), size) AS taken FROM q),
u AS (SELECT *, list_transform(range(0, rounds + CASE WHEN taken > rounds * size THEN 1 ELSE 0 END), lambda n: least((n * source_size + c) / target, 1.0)) AS us FROM k),
p AS (SELECT *, CASE WHEN taken > 0 THEN list_transform(us, lambda u: CASE WHEN g = 0 THEN u ELSE abs((sqrt((1 - g) * (1 - g) + 4 * g * u) - (1 - g)) / (2 * g)) END) ELSE [] END AS ps FROM u)
SELECT doc_id, size, source_size, target, taken, ps[1] AS position, array_to_string(list_transform(ps, lambda x: CAST(CAST(floor(x * 1e12) AS BIGINT) AS VARCHAR)), ',') AS positions FROM p
"""
