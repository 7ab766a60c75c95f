"""URL filter: segmented host and path words, multinomial naive Bayes, and rules.

Hosts often run words together. A unigram model, counted over the words of the
pages, splits the runs of letters of hosts and paths by Viterbi; the words go
into a multinomial naive Bayes that is trained on the urls which the rules
decide, without the names that the rules themselves look at. Where a rule fits,
its verdict stands; elsewhere the classifier's does. Neither the lexicon nor the
classifier's counts go to the driver: each distinct run meets the words that
stand in it, and each url the odds of its runs.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import anchored, cut_table, hot_keys, joined_salted, joined_small, packed, rows_of, small_enough, table, unpacked, with_row_key

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The unigram model is one of words of 2 to LONGEST letters.
LONGEST = 24
#: Cost of each letter of what is no known word, on top of that of a word seen once.
LETTER = 3.0


class Segmenter:
    """Unigram Viterbi: the most likely split of a run of letters; unknown words cost more with each letter. counts: at least the words that stand in the run; total: of all words."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        self.costs = {w: math.log(total / c) for w, c in counts.items()}
        self.unknown = math.log(total)

    def split(self, run: str) -> list[str]:
        best, back = [0.0] + [math.inf] * len(run), [0] * (len(run) + 1)
        for j in range(1, len(run) + 1):
            for i in range(max(0, j - LONGEST), j):
                w = run[i:j]
                c = best[i] + (self.costs[w] if w in self.costs else self.unknown + LETTER * (j - i))
                if c < best[j]:
                    best[j], back[j] = c, i
        out, j = [], len(run)
        while j:
            out.append(run[back[j] : j])
            j = back[j]
        return out[::-1]


def host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """pages with host and path as the contract takes them."""
    rest = F.when(F.instr(url_col, "://") > 0, F.substr(F.col(url_col), F.instr(url_col, "://") + 3))
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return pages.withColumn("host", F.translate(host, upper, upper.lower())).withColumn("path", F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def ruled(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule and action of the longest rule that fits host and path; null where none does."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for rule, action in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return urls.withColumn("_fit", out).withColumn("rule", F.col("_fit.rule")).withColumn("action", F.col("_fit.action")).drop("_fit")


def lexicon(texts: DataFrame, text_col: str = "html") -> DataFrame:
    """(w, c): all words of the texts, markup left out, that have 2 to LONGEST letters, with their counts; written out."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    w = texts.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("w")).where(F.length("w").between(2, LONGEST))
    return cut_table(w.groupBy("w").agg(F.count("*").alias("c")))


def runs_of(urls: DataFrame, rules=RULES) -> DataFrame:
    """_row, pos, mark (h: host, p: path), run: letters or digits of host and path, without the names that the rules look at. urls: _row, host, path."""
    names = sorted({x for rule, _ in rules for x in re.findall(r"[^\W_]+", rule.lower())})
    runs = lambda c, mark: F.transform(F.regexp_extract_all(c, F.lit(r"(\p{L}+|\p{Nd}+)"), F.lit(1)), lambda x: F.struct(F.lit(mark).alias("mark"), x.alias("run")))
    both = F.filter(F.concat(runs(F.col("host"), "h:"), runs(F.lower("path"), "p:")), lambda x: ~x["run"].isin(*names)) if names else F.concat(runs(F.col("host"), "h:"), runs(F.lower("path"), "p:"))
    return urls.select("*", F.posexplode(both).alias("pos", "x")).select("*", "x.mark", "x.run").drop("x", "host", "path")


def segmented(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, words) of distinct runs; a number is one token by its length. words: (w, c), lexicon(). Written out."""
    total = words.agg(F.sum("c")).head()[0] or 0
    digits = F.col("run").rlike(r"^\p{Nd}")
    n = F.length("run")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.transform(F.sequence(F.lit(2), F.least(F.lit(LONGEST), n - i + 1)), lambda k: F.substring("run", i, k))))
    inside = runs.where(~digits & (n >= 2)).select("run", F.explode(F.array_distinct(parts)).alias("w"))
    if small_enough(words):
        inside = inside.join(F.broadcast(words), "w")
    else:
        inside = joined_salted(inside, words, ["w"], hot_keys(inside.groupBy("w").agg(F.count("*").alias("n")), ["w"]), F.xxhash64("run"))
    known = inside.groupBy("run").agg(F.collect_list("w").alias("w"), F.collect_list("c").alias("c"))

    def split(batches):
        import pyarrow as pa

        for b in batches:
            found = [Segmenter(dict(zip(w or (), c or ())), total).split(run) for run, w, c in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], names=["run", "words"])

    letters = runs.where(~digits).join(known, "run", "left").select("run", "w", "c").mapInArrow(split, "run string, words array<string>")
    numbers = runs.where(digits).select("run", F.array(F.concat(F.lit("#"), F.least(n, F.lit(6)).cast("string"))).alias("words"))
    return cut_table(letters.union(numbers))


def run_odds(used: DataFrame, split: DataFrame, blocked: int, allowed: int) -> tuple[DataFrame, float]:
    """(mark, run, words, odds) of distinct runs, odds (a decimal) being the sum of the log odds for block of its words; and the prior's log odds.

    used: mark, run, n (times in decided urls), b (of them in blocked ones); split: segmented(). Words that no decided url
    has say nothing.
    """
    words = used.join(split, "run").select("mark", "run", "n", "b", F.posexplode("words").alias("at", "w")).withColumn("t", F.concat("mark", "w"))
    counts = cut_table(words.groupBy("t").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).where("n > 0"))
    v = rows_of(counts) + 1
    seen = counts.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).head()
    b, n = seen["b"] or 0, seen["n"] or 0
    log = F.log((F.col("b") + 1) / F.lit(float(b + v))) - F.log((F.col("n") - F.col("b") + 1) / F.lit(float(n - b + v)))
    weights = counts.select("t", F.round(log, 12).cast("decimal(20,12)").alias("log"))
    weighted = joined_small(words.select("mark", "run", "at", "w", "t"), cut_table(weights), "t", "left")
    out = weighted.groupBy("mark", "run").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("words"), F.coalesce(F.sum("log"), F.lit(0).cast("decimal(20,12)")).alias("odds"))
    return cut_table(out), math.log((blocked + 1) / (allowed + 1))


def url_filter(pages: DataFrame, rules=RULES, url_col: str = "url", text_col: str = "html", texts: DataFrame | None = None, decides=None) -> DataFrame:
    """The columns of pages, and host, path, rule, verdict (allow or block), words (segmented), odds (log odds of block by the classifier).

    texts: where the words of the lexicon are counted, pages themselves if not given. decides: a condition on host and path;
    urls that it does not hold for are not trained on (to measure the classifier on them). A null url, or one without ://,
    has an empty host and path: no rule fits it and the classifier's prior decides. Ties go to allow. Each row is judged
    alone, repeated ones alike; urls count whole, however long. Without a url that a rule decides, all odds are 0: allow.
    Extra columns pass, those with the name of an added one are replaced by it; an empty table gives no rows.
    """
    pages = anchored(pages)
    urls = ruled(host_and_path(with_row_key(pages.select(F.col(url_col).alias("url"))), "url"), rules)
    action = F.col("action") if decides is None else F.when(decides, F.col("action"))
    taken = F.col("trained").isNotNull()
    runs = runs_of(urls.select("_row", "host", "path", action.alias("trained")), rules)
    used = cut_table(runs.groupBy("mark", "run").agg(F.count("*").alias("all"), F.count_if(taken).alias("n"), F.count_if(F.col("trained") == "block").alias("b")))
    of = urls.select(action.alias("trained")).agg(F.count_if(F.col("trained") == "block").alias("b"), F.count_if(F.col("trained") == "allow").alias("a")).head()
    split = segmented(used.select("run").distinct(), lexicon(pages if texts is None else texts, text_col))
    odds, prior = run_odds(used, split, of["b"], of["a"])
    if small_enough(odds):
        met = runs.join(F.broadcast(odds), ["mark", "run"])
    else:
        met = joined_salted(runs, odds, ["mark", "run"], hot_keys(used, ["mark", "run"], "all"), F.xxhash64("_row", "pos"))
    scores = met.groupBy("_row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "words"))), lambda x: x["words"])).alias("words"), F.sum("odds").cast("double").alias("odds"))
    rows = ruled(host_and_path(packed(pages, url_col).withColumnRenamed("_0", "url"), "url"), rules)
    out = joined_small(rows, cut_table(scores), "_row", "left")
    score = F.lit(0.0) if not of["a"] + of["b"] else F.lit(prior) + F.coalesce("odds", F.lit(0.0))
    out = out.withColumn("odds", score)
    verdict = F.coalesce("action", F.when(F.col("odds") > 0, "block").otherwise("allow"))
    added = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("rule"), "verdict": verdict, "words": F.coalesce("words", F.array().cast("array<string>")), "odds": F.col("odds")}
    return unpacked(out, pages, added)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter(pages.select("page_id", "url"), texts=pages.select("html")).select("page_id", "host", "path", "rule", "verdict", "odds")
