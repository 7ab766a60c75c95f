"""Benchmark decontamination over a distributed positional inverted index.

The index stores postings (row, position) of the training text for the terms of
the benchmark; a term is a word with its successor. The distinct windows of the
benchmark are phrases. Each phrase starts from the posting list of its rarest
term, adjusted by the term's offset; what is left is intersected with the list
of its second rarest term, and then with those of the terms that cover the
phrase, each adjusted by its offset. All lists meet by (row, position, term),
so no list is read into one task, however common its term. Proximity matches
intersect the lists of an item's terms in the same way, but let the adjusted
positions differ by a slack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import BROADCAST_BYTES, anchored, cut, cut_table, hot_keys, joined_salted, joined_small, packed, small_enough, table, unpacked, with_row_key, words

WINDOW = 10
#: An item is near where this share of its distinct terms, or as many as a window has, stand with adjusted positions that
#: differ by at most SLACK words (never by more than twice that); it takes LEAST_TERMS at least, or all if it has fewer.
SHARE, SLACK, LEAST_TERMS = 0.5, 10, 3


def items_of(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_item (key), item (its id as text, '' for null), iw: the words; items without words are left out."""
    item = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return with_row_key(benchmark, "_item").select("_item", item.alias("item"), words(F.col(text_col)).alias("iw")).where(F.size("iw") > 0)


def terms(df: DataFrame, array: str, *keep: str) -> DataFrame:
    """A row for each position: pos, t1 (the word), t2 (its successor; '' at the end)."""
    a = F.col(array)
    zipped = F.arrays_zip(a.alias("t1"), F.slice(a, F.lit(2), F.greatest(F.size(a), F.lit(1))).alias("t2"))
    return df.select(*keep, F.posexplode(zipped).alias("pos", "z")).select(*keep, "pos", F.col("z.t1").alias("t1"), F.coalesce("z.t2", F.lit("")).alias("t2"))


def phrase_terms(df: DataFrame, array: str, *keep: str) -> DataFrame:
    """The terms that a phrase consists of: pairs of words, or the word alone where there is one."""
    return terms(df.withColumn("n", F.size(array)), array, *keep, "n").where((F.col("t2") != "") | (F.col("n") == 1))


#: Tables made of the benchmark (windows, their terms, counts of terms) take at most this many times the bytes of its words.
GROWTH = 64


def with_benchmark(df: DataFrame, small: DataFrame, on, few: bool, how: str = "inner") -> DataFrame:
    """Join with a table made of the benchmark: broadcast where the words of the benchmark are few."""
    return df.join(F.broadcast(small) if few else small, on, how)


def positional_index(docs: DataFrame, dictionary: DataFrame, few: bool) -> DataFrame:
    """Postings (_row, pos, term) of the dictionary's terms, written out. docs: _row, w; dictionary: t1, t2, term."""
    # Out of a generator, so that a text is split once for all uses of its words.
    found = terms(docs.select("_row", F.explode(F.array("w")).alias("w")), "w", "_row")
    postings = with_benchmark(found, dictionary, ["t1", "t2"], few).select("_row", "pos", "term")
    single = dictionary.where("t2 = ''")
    if not single.isEmpty():
        # A pair that ends a text has '' for its successor too, and was found above.
        inner = found.where("t2 <> ''").select("_row", "pos", "t1")
        postings = postings.union(with_benchmark(inner, single.drop("t2"), "t1", few).select("_row", "pos", "term"))
    return cut_table(postings)


def by_term(index: DataFrame, counts: DataFrame, small: DataFrame, few: bool) -> DataFrame:
    """The postings of the terms of `small`, a table made of the benchmark: broadcast if it is small, else the lists of common terms are spread over tasks."""
    if few:
        return index.join(F.broadcast(small), "term")
    return joined_salted(index, small, ["term"], hot_keys(counts, ["term"], "count"), F.xxhash64("_row", "pos"))


def phrases_at(index: DataFrame, counts: DataFrame, phrases: DataFrame, few: bool) -> DataFrame:
    """(_row, win, start, n): where phrases stand, each place once. phrases: win, n (words), o (offset), term; a row for each term."""
    of = W.partitionBy("win")
    ranked = with_benchmark(phrases, counts, "term", few, "left").withColumn("count", F.coalesce("count", F.lit(0)))
    # A phrase of which a term is nowhere is nowhere.
    ranked = ranked.withColumn("least", F.min("count").over(of)).where("least > 0").withColumn("k", F.row_number().over(of.orderBy("count", "o")))
    covers = (F.col("o") % 2 == 0) | (F.col("o") == F.greatest(F.col("n") - 2, F.lit(0)))
    at = F.struct("o", "term")
    plan = ranked.groupBy("win", "n").agg(F.min(F.when(F.col("k") == 1, at)).alias("a"), F.min(F.when(F.col("k") == 2, at)).alias("b"), F.collect_list(F.when(covers & (F.col("k") > 2), at)).alias("rest"))
    plan = cut(plan.select("win", "n", F.col("a.o").alias("o"), F.col("a.term").alias("term"), "b", "rest"))
    start = F.col("pos") - F.col("o")
    first = by_term(index, counts, plan, few).select("_row", "win", "n", start.alias("start"), "b", "rest").where("start >= 0")
    alone = first.where("b IS NULL").select("_row", "win", "start", "n")

    def kept(places: DataFrame, asked) -> DataFrame:
        """Of places, those at which all terms of an array of (o, term) stand. Each posting is met once for each place that asks for it."""
        asks = cut_table(places.select("*", F.explode(asked).alias("e")).select(*places.columns, (F.col("start") + F.col("e.o")).alias("pos"), F.col("e.term").alias("term")))
        # Grows with the corpus, so it is never broadcast: the plan is the same at every size.
        return index.join(asks.hint("merge"), ["_row", "pos", "term"])

    two = kept(first.where("b IS NOT NULL"), F.array("b")).select("_row", "win", "start", "n", "rest")
    two = cut_table(two)
    whole = two.where(F.size("rest") == 0).select("_row", "win", "start", "n")
    met = kept(two.where(F.size("rest") > 0).select("_row", "win", "start", "n", "rest"), F.col("rest"))
    met = met.groupBy("_row", "win", "start", "n").agg(F.count("*").alias("m"), F.first(F.size("rest")).alias("all")).where("m = all").select("_row", "win", "start", "n")
    return cut_table(alone.union(whole).union(met))


def near_matches(index: DataFrame, counts: DataFrame, at: DataFrame, few: bool, size: int = WINDOW) -> DataFrame:
    """Distinct (_row, _item): rows where an item is near. at: _item, p (position), term.

    Of an item's n distinct terms `need` must be there. So of its n - need + s rarest ones s must be, and only rows where
    those stand close are looked at with all terms.
    """
    of_item = W.partitionBy("_item")
    one = with_benchmark(at.select("_item", "term").distinct(), counts, "term", few, "left").select("_item", "term", F.coalesce("count", F.lit(0)).alias("count"))
    n = F.count("*").over(of_item)
    ranked = one.select("_item", "term", n.alias("n"), F.row_number().over(of_item.orderBy("count", "term")).alias("k"))
    ranked = ranked.withColumn("need", F.greatest(F.least("n", F.lit(LEAST_TERMS)), F.least(F.ceil(F.col("n") * SHARE), F.lit(size - 1))).cast("int"))
    ranked = ranked.withColumn("some", F.least("need", F.lit(LEAST_TERMS)))
    placed = cut(at.join(ranked, ["_item", "term"]).select("_item", "term", "p", "need", "some", (F.col("k") <= F.col("n") - F.col("need") + F.col("some")).alias("rare")))
    # A stretch holds 2 * SLACK shifts and begins at each SLACK, so shifts that differ by at most SLACK share one.
    stretch = F.floor((F.col("pos") - F.col("p")) / SLACK)
    rows = ["_row", "_item"]

    def close(found: DataFrame, least: str) -> DataFrame:
        """Rows and items of which `least` distinct terms share a stretch."""
        found = found.select(*rows, "term", least, F.explode(F.array(stretch - 1, stretch)).alias("stretch")).distinct()
        return found.groupBy(*rows, "stretch", least).count().where(F.col("count") >= F.col(least)).select(*rows).distinct()

    likely = cut_table(close(by_term(index, counts, placed.where("rare").select("_item", "term", "p", "some"), few), "some"))
    lists = joined_small(index, likely, "_row").withColumnRenamed("_item", "_wanted")
    every = placed.select(F.col("_item").alias("_wanted"), "term", "p", "need")
    return close(with_benchmark(lists, every, ["_wanted", "term"], few).withColumnRenamed("_wanted", "_item"), "need")


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, near: bool = True) -> DataFrame:
    """_row, hits (word positions, rising), items and near_items (ids as text, sorted; null without near) of rows that have any. docs: _row, w; items: items_of()."""
    n = F.size("iw")
    starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))
    windows = items.select("item", F.explode(F.transform(starts, lambda s: F.slice("iw", s + 1, F.least(F.lit(size), n)))).alias("g"))
    distinct = cut(windows.select("g").distinct().withColumn("win", F.monotonically_increasing_id()))
    owners = windows.join(distinct, "g").select("win", "item").distinct()
    few = small_enough(items, BROADCAST_BYTES // GROWTH)
    of_items = phrase_terms(items, "iw", "_item")
    dictionary = cut(of_items.select("t1", "t2").distinct().withColumn("term", F.monotonically_increasing_id()))
    index = positional_index(docs, dictionary, few)
    counts = cut(index.groupBy("term").count())
    phrases = with_benchmark(phrase_terms(distinct, "g", "win"), dictionary, ["t1", "t2"], few).select("win", "n", F.col("pos").alias("o"), "term")
    there = phrases_at(index, counts, phrases, few)
    # Each hit position comes once: a place adds what lies beyond the farthest end before it.
    before = W.partitionBy("_row").orderBy("start", "n").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    new = there.select("_row", "start", "n").distinct().select("_row", end.alias("end"), F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))).alias("from")).where("from < end")
    hits = new.groupBy("_row").agg(F.array_sort(F.flatten(F.collect_list(F.sequence("from", F.col("end") - 1)))).alias("hits"))
    pairs = there.select("_row", "win").distinct()
    if few:
        pairs = pairs.join(F.broadcast(owners), "win")
    else:
        pairs = joined_salted(pairs, owners, ["win"], hot_keys(pairs.groupBy("win").agg(F.count("*").alias("n")), ["win"]), F.xxhash64("_row"))
    exact = cut_table(pairs.select("_row", "item").distinct())
    names = exact.groupBy("_row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = hits.join(names, "_row")
    if near:
        at = with_benchmark(of_items, dictionary, ["t1", "t2"], few).select("_item", F.col("pos").alias("p"), "term")
        close = with_benchmark(near_matches(index, counts, at, few, size), items.select("_item", "item"), "_item", few).select("_row", "item")
        out = out.join(close.union(exact).distinct().groupBy("_row").agg(F.array_sort(F.collect_list("item")).alias("near_items")), "_row", "full")
    else:
        out = out.withColumn("near_items", F.lit(None).cast("array<string>"))
    return cut_table(out.select("_row", "hits", "items", "near_items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", near: bool = True) -> DataFrame:
    """The columns of docs, and n_words, hits (distinct word positions in benchmark windows), items (distinct item ids as text, sorted) and near_items (those that stand there exactly or nearly: see SHARE; null without `near`).

    Null or empty texts have no words and no hits; items without words match nothing; items with fewer than `size` words
    match whole. Repeated rows are each judged; null item ids stand as ''. An empty benchmark leaves all rows without hits.
    Texts are taken whole, however long; a column of docs with the name of an added one is replaced by it.
    """
    docs, none = anchored(docs), F.array().cast("array<string>")
    items = cut(items_of(anchored(benchmark), item_col, item_text_col))
    found = matches(with_row_key(docs.select(text_col)).select("_row", words(F.col(text_col)).alias("w")), items, size, near)
    rows = packed(docs, text_col).withColumn("n_words", F.size(words(F.col("_0"))).cast("long"))
    out = joined_small(rows, found, "_row", "left")
    added = {
        "n_words": F.col("n_words"), "hits": F.coalesce("hits", F.array().cast("array<int>")), "items": F.coalesce("items", none),
        "near_items": F.coalesce("near_items", none) if near else F.col("near_items"),
    }
    return unpacked(out, docs, added)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows that hold a window of a benchmark item; same columns."""
    out = decontaminated(docs, benchmark, near=False, **options)
    return out.where(F.size("hits") == 0).select(docs.columns)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near"),
    )


OP4_SQL = r"""
WITH pat AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p),
b AS (SELECT row_number() OVER () AS key, coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p) AS w FROM benchmark, pat WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, list_slice(w, s, s + least(10, len(w)) - 1) AS g
        FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p), []) AS w FROM documents, pat),
pos AS (SELECT r, w, unnest(generate_series(1, len(w))) AS s FROM d),
lens AS (SELECT DISTINCT n FROM win),
dg AS (SELECT r, s, n, list_slice(w, s, s + n - 1) AS g FROM pos, lens WHERE s + n - 1 <= len(w)),
occ AS (SELECT dg.r, dg.s, dg.n, win.item FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
hit AS (SELECT r, count(DISTINCT s + k) AS n_hit FROM (SELECT DISTINCT r, s, n FROM occ), LATERAL (SELECT unnest(generate_series(0, n - 1)) AS k) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r),
it AS (SELECT key, item, len(w) AS len, w[s] AS t1, CASE WHEN len(w) > 1 THEN w[s + 1] END AS t2, s FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS s FROM b WHERE len(w) > 0)),
nd AS (SELECT key, greatest(least(n, 3), least(CAST(ceil(n * 0.5::DOUBLE) AS BIGINT), 9)) AS need FROM (SELECT key, count(DISTINCT (t1, t2)) AS n FROM it GROUP BY key)),
dt AS (SELECT r, s, w[s] AS t1, CASE WHEN s < len(w) THEN w[s + 1] END AS t2 FROM pos),
sh AS (SELECT r, key, item, it.t1, it.t2, CAST(floor((dt.s - it.s) / 10.0::DOUBLE) AS BIGINT) AS st FROM it JOIN dt ON it.t1 = dt.t1 AND (it.t2 = dt.t2 OR it.len = 1)),
cl AS (SELECT r, key, item, st, count(DISTINCT (t1, t2)) AS n FROM (SELECT r, key, item, t1, t2, st FROM sh UNION ALL SELECT r, key, item, t1, t2, st - 1 FROM sh) GROUP BY ALL),
nr AS (SELECT r, count(DISTINCT item) AS n_near FROM (SELECT r, item FROM cl JOIN nd USING (key) WHERE n >= need UNION ALL SELECT r, item FROM occ) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r) LEFT JOIN nr USING (r)
"""
