"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text are binned at quantiles; trees of fixed depth are grown
level by level on histograms of gradients and flattened into arrays, so a batch
is scored by indexing, level after level, with no tree objects.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import cut, packed, table, unpacked

#: Labelled rows that the trees are fitted on, at most (those of the least hash).
SAMPLE = 20_000
BINS, TREES, DEPTH, RATE, LAMBDA, LEAST_WEIGHT = 64, 80, 4, 0.15, 1.0, 2.0
FEATURES = ("bytes", "lines", "words", "word_length", "upper", "digit", "blank", "ascii_mark", "marks_a_word", "high", "distinct_bytes", "entropy", "distinct_words", "top_word", "distinct_pairs", "line_length", "distinct_lines", "ends_with_stop", "capital_words", "shout_words", "odd_words", "pipe", "number_words", "longest_word", "short_words")
_UPPER, _LOWER, _DIGIT = (np.isin(np.arange(256), np.frombuffer(s, np.uint8)) for s in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"))
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\f\v", np.uint8))
_MARK = (np.arange(256) < 128) & (np.arange(256) > 32) & ~_UPPER & ~_LOWER & ~_DIGIT


def statistics(text: str | None) -> list[float]:
    """The features of a text, in order of FEATURES; all 0 for an empty one."""
    data = (text or "").encode(errors="replace")
    words = (text or "").split()
    n, k = len(data), len(words)
    if not k:
        return [float(n)] + [0.0] * (len(FEATURES) - 1)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    p = seen[seen > 0] / n
    lines = [x for x in text.split("\n") if x.strip()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    lengths = [len(w) for w in words]
    return [
        float(n), len(lines), k, sum(lengths) / k, seen[_UPPER].sum() / n, seen[_DIGIT].sum() / n, seen[_BLANK].sum() / n, seen[_MARK].sum() / n, seen[_MARK].sum() / k, seen[128:].sum() / n,
        len(p), float(-(p * np.log2(p)).sum()), len(counts) / k, max(counts.values()) / k, pairs / max(1, k - 1), n / len(lines), len(set(lines)) / len(lines),
        sum(x.rstrip()[-1] in ".!?" for x in lines) / len(lines), sum(w[0].isupper() for w in words) / k, sum(len(w) > 1 and w.isupper() for w in words) / k,
        sum(not w[-1].isalnum() and w[-1] not in ".,;:!?" for w in words) / k, words.count("|") / k, sum(w[0].isdigit() for w in words) / k, float(max(lengths)), sum(x <= 3 for x in lengths) / k,
    ]


class Boosted:
    """Trees as arrays: for tree t and inner node i, split[t, i] (feature) and above[t, i] (goes right if greater); leaf[t, j]."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH):
        self.depth = depth
        inner = 2**depth - 1
        self.split, self.above, self.leaf = np.zeros((trees, inner), np.int32), np.full((trees, inner), np.inf), np.zeros((trees, 2**depth))
        mean = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
        self.start = float(np.log(mean / (1 - mean)))
        if not len(y) or y.min() == y.max():
            return
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
        raw, features = np.full(len(y), self.start), x.shape[1]
        flat = binned + np.arange(features) * BINS
        for t in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            node = np.zeros(len(y), np.int64)  # within its level
            for level in range(depth):
                width = 2**level
                at = (node[:, None] * (features * BINS) + flat).ravel()
                size = width * features * BINS
                gs = np.bincount(at, np.repeat(g, features), size).reshape(width, features, BINS).cumsum(2)
                hs = np.bincount(at, np.repeat(h, features), size).reshape(width, features, BINS).cumsum(2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + LAMBDA) + (gt - gs) ** 2 / (ht - hs + LAMBDA) - gt**2 / (ht + LAMBDA)
                gain[(hs < LEAST_WEIGHT) | (ht - hs < LEAST_WEIGHT)] = 0
                best = gain.reshape(width, -1).argmax(1)
                f, b = best // BINS, best % BINS
                base = width - 1
                for i in range(width):
                    if gain[i, f[i], b[i]] > 1e-9 and b[i] < len(edges[f[i]]):
                        self.split[t, base + i], self.above[t, base + i] = f[i], edges[f[i]][b[i]]
                node = node * 2 + (x[np.arange(len(y)), self.split[t, base + node]] > self.above[t, base + node])
            gs, hs = np.bincount(node, g, 2**depth), np.bincount(node, h, 2**depth)
            self.leaf[t] = -RATE * gs / (hs + LAMBDA)
            raw = raw + self.leaf[t, node]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        raw, rows, inner = np.full(len(x), self.start), np.arange(len(x)), 2**self.depth - 1
        for split, above, leaf in zip(self.split, self.above, self.leaf):
            i = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                i = 2 * i + 1 + (x[rows, split[i]] > above[i])
            raw += leaf[i - inner]
        return 1 / (1 + np.exp(-raw))


def _measured(texts: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([[float(v) for v in statistics(t)] for t in b.column(1).to_pylist()], pa.list_(pa.float64())), b.column(2)], names=["y", "x", "h"])

    return texts.mapInArrow(run, "y int, x array<double>, h long")


def fitted(docs: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Boosted:
    """Trees fitted on at most `sample` labelled rows, of those for which `trains` (a condition on the id) holds.

    Rows with a null id or label are left out; an id that is labelled twice counts with its largest label; all rows of an
    id count, within the bound (those of the least hash of id and statistics). Without labelled rows, or with one label
    alone, every text gets the same score.
    """
    of = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & trains).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
    chosen = cut(of.orderBy(F.xxhash64("_id"), "_id").limit(sample))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id").select("y", "text", F.xxhash64("_id").alias("h"))
    rows = _measured(texts).orderBy("h", F.xxhash64("x")).limit(sample).select("y", "x").toPandas()
    x = np.stack(rows["x"].to_list()) if len(rows) else np.empty((0, len(FEATURES)))
    order = np.lexsort((*x.T, rows["y"].to_numpy()))  # the model doesn't depend on the order of rows
    return Boosted(x[order], rows["y"].to_numpy(float)[order])


def quality(docs: DataFrame, model: Boosted, text_col: str = "text", cutoff: float = 0.5) -> DataFrame:
    """The columns of docs, and score and predicted (1 if score >= cutoff).

    Each row is judged alone, repeated ones alike, whole texts however long; null counts as an empty text, which has all
    statistics 0 and gets a score as well. Extra columns pass, those with the name of an added one are replaced by it.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            x = np.array([statistics(t) for t in b.column(1).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))], names=["_src", "score"])

    rows = packed(docs, text_col)
    out = rows.select("_src", F.col("_0").alias("text")).mapInArrow(run, f"_src {rows.schema['_src'].dataType.simpleString()}, score double")
    return unpacked(out, docs, {"score": F.col("score"), "predicted": (F.col("score") >= cutoff).cast("int")})


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is of the held-out third: crc32 of its id as text, mod 3, is 1. False for null ids."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fitted(docs, table(spark, sf_dir, "labels"), ~held_out())
    return quality(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
