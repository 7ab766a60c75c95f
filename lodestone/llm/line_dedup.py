"""Line dedup: repeated runs of lines from a suffix array by distributed prefix doubling.

A document is a sequence of line ids. Round 0 ranks suffixes by their first
line; each round ranks them by twice as many lines, from the pair of ranks at i
and i + depth, in order: distinct pairs are range-sorted and numbered. Suffixes
whose prefix is unique leave, and rounds go on until none is left, so the ranks
order all repeated suffixes. Suffixes of one rank are an interval of longest
common prefix of at least that depth; the first place of the deepest interval
in which a suffix isn't first is its source, and the exact length of the prefix
that they share comes from the ranks of all depths by binary descent. Such a run
can be prolonged to no side; those inside another are left out. Runs are later
copies, and their lines are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import BROADCAST_BYTES, HOT_ROWS, HOT_SHARE, anchored, cut, cut_table, joined_salted, joined_small, packed, rows_of, table, unpacked, with_row_key, words

MIN_LINES = 2
#: A line of more words, or of more bytes (scripts without blanks), is a run by itself.
LONG_WORDS, LONG_BYTES = 50, 500
BLANKS = " \t\n\x0b\f\r"


def place() -> Column:
    """What copies are ordered by: id (null last), row, line."""
    return F.struct("_none", "_id", "_row", "i")


def ranked(rows: DataFrame, keys: list[str], hot: bool = True) -> tuple[DataFrame, bool]:
    """Rows whose key occurs at least twice: _none, _id, _row, i, r (rank of the key, in order), first (the first place that has it); written out. And whether a key is hot: if none was (`hot` false), none of a longer prefix is."""
    classes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(place()).alias("first")).where("n > 1")
    classes = classes.orderBy(*keys).withColumn("r_", F.monotonically_increasing_id())
    if hot:
        classes = cut_table(classes)
        seen = classes.agg(F.sum("n").alias("all"), F.max("n").alias("most")).head()
        least = max(HOT_ROWS, int((seen["all"] or 0) * HOT_SHARE))
        hot = (seen["most"] or 0) > least
    if hot:
        frequent = cut(classes.where(F.col("n") > least).select(*keys, F.lit(True).alias("_hot")))
        out = joined_salted(rows, classes, keys, frequent, F.xxhash64("_row", "i"))
    else:
        out = rows.join(classes, keys)
    more = [c for c in rows.columns if c == "long"]
    return cut_table(out.select("_none", "_id", "_row", "i", F.col("r_").alias("r"), "first", *more)), hot


def levels(lines: DataFrame, min_lines: int) -> list[tuple[int, DataFrame]]:
    """(depth, ranked suffixes that have at least `depth` lines and share them with another), depths rising to the longest repeat."""
    depth, (now, hot) = 1, ranked(lines, ["line"])
    out = [(1, now)]
    while rows_of(now):
        step = min(depth, min_lines - depth) if depth < min_lines else depth
        ahead = now.select("_row", (F.col("i") - step).alias("i"), F.col("r").alias("r2"))
        now, hot = ranked(now.select("_none", "_id", "_row", "i", "r").join(ahead, ["_row", "i"]), ["r", "r2"], hot)
        depth += step
        out.append((depth, now))
    return out[:-1] or out


def later_copies(ranks: list[tuple[int, DataFrame]], min_lines: int) -> DataFrame:
    """(_row, i, n): maximal runs of n >= min_lines lines that stand at an earlier place as a whole."""
    deep = None
    for depth, now in ranks:
        if depth >= min_lines:
            later = now.where(place() != F.col("first")).select("_row", "i", F.lit(depth).alias("n"), F.col("first._row").alias("s_row"), F.col("first.i").alias("s_i"))
            deep = later if deep is None else deep.union(later)
    if deep is None:
        return ranks[0][1].select("_row", "i", F.lit(0).alias("n")).where("n > 0")
    own = deep.groupBy("_row", "i").agg(F.max(F.struct("n", "s_row", "s_i")).alias("m")).select("_row", "i", "m.*")
    by = W.partitionBy("_row").orderBy("i")
    goes_on = (F.lag("i").over(by) == F.col("i") - 1) & (F.lag("s_row").over(by) == F.col("s_row")) & (F.lag("s_i").over(by) == F.col("s_i") - 1)
    heads = own.withColumn("on", F.coalesce(goes_on, F.lit(False))).where("NOT on").drop("on")
    runs = cut_table(heads.withColumn("top", F.col("n")))
    for depth, now in reversed(ranks[:-1]):
        asked = F.explode(F.array(F.struct(F.col("_row").alias("at_row"), (F.col("i") + F.col("n")).alias("at")), F.struct(F.col("s_row").alias("at_row"), (F.col("s_i") + F.col("n")).alias("at"))))
        asks = runs.where(F.col("top") > depth).select("_row", "i", asked.alias("q")).select(F.col("_row").alias("h_row"), F.col("i").alias("h_i"), F.col("q.at_row").alias("_row"), F.col("q.at").alias("i"))
        # Two rows of four longs for each run.
        asks = F.broadcast(asks) if rows_of(runs) * 2 * 80 <= BROADCAST_BYTES else asks
        met = now.select("_row", "i", "r").join(asks, ["_row", "i"]).groupBy("h_row", "h_i").agg(F.count("*").alias("c"), F.min("r").alias("a"), F.max("r").alias("b")).where("c = 2 AND a = b")
        met = met.select(F.col("h_row").alias("_row"), F.col("h_i").alias("i"), F.lit(depth).alias("more"))
        runs = cut_table(runs.join(met, ["_row", "i"], "left").withColumn("n", F.col("n") + F.coalesce("more", F.lit(0))).drop("more"))
    return runs.select("_row", "i", "n")


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, long_lines: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text cut to what stays, and n_lines, n_removed (lines that are not blank), n_runs (deleted runs, none inside another).

    Lines end at \\n. Blank lines (nothing but blanks, tabs and the like) belong to no run, do not part one and are kept. Of
    equal runs the one in the document of the smallest id stays (null ids last, then row order). Null texts stay null, with
    no lines; empty texts have none; repeated rows count as copies of each other; extra columns pass through, those with the
    name of an added one are replaced by it. Runs do not reach over documents. A run has min_lines lines at least; with
    long_lines, one line of over LONG_WORDS words or LONG_BYTES bytes also counts as a run, and such lines side by side as one.
    A text of many lines takes time
    in proportion to them, times the number of rounds.
    """
    docs = anchored(docs)
    # More than LONG_WORDS words take more than twice as many characters; shorter lines aren't split.
    long = (F.octet_length("text_") > LONG_BYTES) | ((F.length("text_") > 2 * LONG_WORDS) & (F.size(words(F.col("text_"))) > LONG_WORDS))
    blank = lambda x: F.length(F.btrim(x, F.lit(BLANKS))) == 0
    split = F.split(F.coalesce(F.col("_1"), F.lit("")), "\n", -1)
    lines = (
        with_row_key(docs.select(id_col, text_col)).select("_row", F.col(id_col).alias("_0"), F.col(text_col).alias("_1"))
        .select("_row", F.col("_0").isNull().alias("_none"), F.col("_0").alias("_id"), F.posexplode(F.filter(split, lambda x: ~blank(x))).alias("i", "text_"))
        .select("_row", "_none", "_id", "i", F.unhex(F.md5("text_")).alias("line"), *([long.alias("long")] if long_lines else []))
    )
    ranks = levels(lines, min_lines)
    runs = later_copies(ranks, min_lines).withColumn("alone", F.lit(False))
    if long_lines:
        runs = runs.union(ranks[0][1].where("long").where(place() != F.col("first")).select("_row", "i", F.lit(1), F.lit(True)))
    before = W.partitionBy("_row").orderBy("i", F.desc("n"), "alone").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("i") + F.col("n")
    runs = runs.withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0))).where(F.col("reach") < end)
    by = W.partitionBy("_row").orderBy("i")
    runs = runs.withColumn("goes_on", F.coalesce(F.col("alone") & F.lag("alone").over(by) & (F.lag("i").over(by) == F.col("i") - 1), F.lit(False)))
    gone = runs.groupBy("_row").agg(F.count_if(~F.col("goes_on")).alias("_runs"), F.array_sort(F.flatten(F.collect_list(F.sequence(F.greatest("i", "reach"), end - 1)))).alias("_gone"))
    out = joined_small(packed(docs, id_col, text_col), cut_table(gone), "_row", "left")
    # Lines and their numbers come out of generators, so that a text is split once for all uses.
    out = out.withColumn("_lines", F.explode(F.array(split)))
    out = out.withColumn("_full", F.explode(F.array(F.array_compact(F.transform("_lines", lambda x, k: F.when(~blank(x), k))))))
    keep = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.transform("_gone", lambda i: F.get("_full", i)))
    rest = F.array_join(F.transform(keep, lambda k: F.get("_lines", k)), "\n")
    added = {"n_lines": F.size("_full").cast("long"), "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"), "n_runs": F.coalesce("_runs", F.lit(0)).cast("long")}
    return unpacked(out, docs, added, {text_col: F.when(F.col("_gone").isNull(), F.col("_1")).otherwise(rest)})


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), long_lines=True)
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
f AS (SELECT r, doc_id, a, list_filter(range(1, len(a) + 1), lambda k: trim(a[k], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') AS nb FROM d),
l AS (SELECT r, list_transform(nb, lambda k: a[k]) AS x FROM f),
dep AS (SELECT 2 ** unnest(range(1, 21)) AS n),
pre AS (SELECT r, i, CAST(n AS BIGINT) AS n, md5(array_to_string(list_slice(x, i, CAST(i + n - 1 AS BIGINT)), chr(10))) AS h FROM (SELECT r, x, unnest(range(1, len(x) + 1)) AS i FROM l) p JOIN dep ON i + n - 1 <= len(x)),
src AS (SELECT r, i, n, min({'r': r, 'i': i}) OVER (PARTITION BY n, h) AS s FROM pre),
own AS (SELECT r, i, max(n) AS n, arg_max(s, n) AS s FROM src WHERE s.r <> r OR s.i <> i GROUP BY r, i),
hd AS (SELECT * FROM (SELECT *, lag(i) OVER w AS pi, lag(s) OVER w AS ps FROM own WINDOW w AS (PARTITION BY r ORDER BY i)) WHERE NOT coalesce(pi = i - 1 AND ps.r = s.r AND ps.i = s.i - 1, false)),
lcp AS (SELECT hd.r, hd.i, max(k) AS n FROM hd JOIN l ON l.r = hd.r JOIN l l2 ON l2.r = hd.s.r, LATERAL (SELECT unnest(range(hd.n, 2 * hd.n)) AS k)
        WHERE hd.i + k - 1 <= len(l.x) AND hd.s.i + k - 1 <= len(l2.x) AND list_slice(l.x, hd.i, hd.i + k - 1) = list_slice(l2.x, hd.s.i, hd.s.i + k - 1) GROUP BY hd.r, hd.i),
one AS (SELECT r, i, x[i] AS line FROM (SELECT r, x, unnest(range(1, len(x) + 1)) AS i FROM l)),
lng AS (SELECT r, i, 1 AS n FROM (SELECT r, i, line, row_number() OVER (PARTITION BY line ORDER BY r, i) AS k FROM one)
        WHERE k > 1 AND (strlen(line) > 500 OR len(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) > 50)),
ru AS (SELECT * FROM (SELECT *, coalesce(max(i + n) OVER (PARTITION BY r ORDER BY i, n DESC, alone ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM (SELECT *, false AS alone FROM lcp UNION ALL SELECT *, true FROM lng)) WHERE reach < i + n),
g AS (SELECT DISTINCT r, i + o AS i FROM ru, LATERAL (SELECT unnest(range(0, n)) AS o)),
c AS (SELECT r, count(*) AS n_removed, list(i) AS gone FROM g GROUP BY r),
nr AS (SELECT r, count(*) FILTER (NOT goes_on) AS n_runs FROM (SELECT r, coalesce(alone AND lag(alone) OVER w AND lag(i) OVER w = i - 1, false) AS goes_on FROM ru WINDOW w AS (PARTITION BY r ORDER BY i)) GROUP BY r),
kept AS (SELECT f.r, array_to_string(list_transform(list_filter(range(1, len(a) + 1), lambda k: NOT coalesce(list_contains(list_transform(gone, lambda i: nb[i]), k), false)), lambda k: a[k]), chr(10)) AS text FROM f LEFT JOIN c USING (r))
SELECT d.doc_id, CAST(len(f.nb) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(kept.text, '')) AS text_sha256
FROM d JOIN f USING (r) LEFT JOIN c USING (r) LEFT JOIN nr USING (r) LEFT JOIN kept USING (r)
"""
