"""What several operators share: word patterns, row keys, checkpoints."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word in text whose A-Z are as written.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Largest measured size of a table that is joined by broadcast.
BROADCAST_BYTES = 48 << 20
#: A key is hot if more than this share of all rows have it (so there are at most 1 / SHARE hot keys), and HOT_ROWS at least.
HOT_SHARE, HOT_ROWS, SALTS = 1e-4, 20_000, 64


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone; null stays null."""
    return F.translate(c, UPPER, UPPER.lower())


def words(c: Column) -> Column:
    """Array of the words of a text; null and texts without words give an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(c, F.lit(""))), SEPARATORS), "")


def anchored(df: DataFrame) -> DataFrame:
    """df, written out first unless it is a scan or a checkpoint, at most projected and filtered: places in anything else can
    change when a task is run again or a plan is used twice."""
    plain = {"LogicalRelation", "LogicalRDD", "LocalRelation", "Range", "Project", "Filter", "SubqueryAlias", "View", "Union", "DataSourceV2Relation"}
    nodes = [df._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        if node.nodeName().split(" ")[0] not in plain and not node.nodeName().startswith("Relation"):
            return cut_table(df)
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return df


def with_row_key(df: DataFrame, name: str = "_row") -> DataFrame:
    """Adds a long that is unique to each row, whatever doc_id holds.

    It follows from the place in the scanned files, so a task that is run again gives the same keys. Callers hand in what
    anchored() gives.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """_row, _src (a struct of all columns) and _0, _1, ... (the named columns): no name of docs can clash with an operator's."""
    return docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_src"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)])


def unpacked(out: DataFrame, docs: DataFrame, added: dict[str, Column], changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of docs (some changed), then what an operator adds; of equal names the added one stays."""
    changed = changed or {}
    kept = [changed.get(c, F.col("_src").getField(c)).alias(c) for c in docs.columns if c not in added]
    return out.select(*kept, *[v.alias(k) for k, v in added.items()])


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; removed with the folder when the driver ends."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """This application's folder in spark.checkpoint.dir, which all executors share.

    Unset, a temporary folder serves in local mode, as in tests; on a cluster that is an error. The folder goes when the
    driver ends; what a killed driver leaves lies in it alone.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        context.setCheckpointDir(where or tempfile.mkdtemp(prefix="checkpoints-"))
    path = context._jsc.sc().getCheckpointDir().get()
    if path not in _folders:
        _folders.add(path)
        atexit.register(removed, spark, path)
    return path


_folders: set[str] = set()


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system, if the session still runs."""
    context = spark.sparkContext
    if context._jsc is not None:
        there = context._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(context._jsc.hadoopConfiguration()).delete(there, True)


def cut_table(df: DataFrame) -> DataFrame:
    """Like cut(), for larger tables: written compressed as Parquet to the shared folder and read again. Rows and bytes are counted while it is written."""
    spark, seen = df.sparkSession, Observation()
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(size_of(df)).alias("bytes")).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_seen"] = seen.get
    return out


def rows_of(table: DataFrame) -> int:
    """Rows of a table that cut_table() wrote."""
    seen = table.__dict__.get("_seen", {}).get("rows")
    return table.count() if seen is None else seen


def dropped(table: DataFrame) -> None:
    """Deletes the files of a table that cut_table() wrote, once nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        removed(table.sparkSession, path)


def size_of(df: DataFrame) -> Column:
    """About how many bytes a row takes in a broadcast table: strings and arrays by their length."""
    total, element = F.lit(40), {"array<int>": 4, "array<bigint>": 8, "array<double>": 8}
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if kind in ("string", "binary"):
            n = F.octet_length(c)
        elif kind == "array<string>":
            n = F.octet_length(F.array_join(c, "")) + 16 * F.size(c)
        elif kind.startswith(("array", "map")):
            n = element.get(kind, 32) * F.size(c)
        else:
            n = F.lit(0)
        total = total + 8 + F.greatest(F.coalesce(n, F.lit(0)), F.lit(0))
    return total.cast("long")


def small_enough(small: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a written table measures at most `most` bytes."""
    seen = small.__dict__.get("_seen", {})
    if "rows" in seen:
        return (seen.get("bytes") or 0) <= most
    return (small.agg(F.sum(size_of(small))).head()[0] or 0) <= most


def joined_small(big: DataFrame, small: DataFrame, on, how: str = "inner", most: int = BROADCAST_BYTES) -> DataFrame:
    """Join that broadcasts `small` (a written table) only if it measures at most `most` bytes, else shuffles."""
    return big.join(F.broadcast(small) if small_enough(small, most) else small, on, how)


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame | None:
    """The keys of a table of counts that more than HOT_SHARE of the rows have (at most 1 / HOT_SHARE keys), with _hot; None without any."""
    seen = counts.agg(F.sum(n).alias("all"), F.max(n).alias("most")).head()
    least = max(HOT_ROWS, int((seen["all"] or 0) * HOT_SHARE))
    return cut(counts.where(F.col(n) > least).select(*keys, F.lit(True).alias("_hot"))) if (seen["most"] or 0) > least else None


def joined_salted(big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame | None, salt: Column, how: str = "inner") -> DataFrame:
    """Join by keys in which the rows of hot keys are spread over SALTS tasks, by `salt` (a long that differs between rows).

    hot: hot_keys() of some or all of the keys, whose size has a fixed bound; small: few rows a key.
    """
    if hot is None:
        return big.join(small, keys, how)
    of = [c for c in hot.columns if c != "_hot"]
    marked = big.join(F.broadcast(hot), of, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(salt, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop("_hot")
    spread = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    other = small.join(F.broadcast(hot), of, "left").withColumn("_salt", F.explode(spread)).drop("_hot")
    return marked.join(other, [*keys, "_salt"], how).drop("_salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
