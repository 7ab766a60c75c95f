"""Approximate nearest neighbours: inverted file with product-quantised residuals.

Vectors are assigned to coarse centroids; of what is left of each the length is
kept and the direction is quantised by parts, so that codes tell vectors apart
in narrow and wide lists alike. A query visits the lists of its best centroids,
scores their codes by asymmetric distance tables, and reranks the best exactly
on the original vectors. How many lists are visited is measured: a few queries
are answered exactly, and as many lists are taken as hold the wanted share of
their true neighbours. So is how many are reranked, by the places of those
neighbours in the order of the codes. Neighbouring lists form shards, a large one is split; codes are
shuffled once to their shard, and a query goes to the shards that hold a list
which it visits. Equal vectors are one entry of the index with the smallest ids
that any query can need, which loses nothing.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import cut, cut_table, table

#: Vectors that centroids and codebooks are fitted on; every vector is indexed.
SAMPLE = 20_000
MOST_LISTS, CODES, PART = 65_536, 256, 4
#: Share of the true neighbours that the visited lists are to hold, and of those the share that is to be reranked; queries on
#: which both are measured; least lists visited.
TARGET, RERANKED, MEASURED, LEAST_PROBES = 0.97, 0.99, 128, 16
#: Least entries of a shard that are reranked exactly, for each query.
RERANK = 256
#: Entries of a shard, and queries that meet it at once, about; queries that are scored at once.
SHARD, QUERY_BLOCK, SCORED = 8192, 16_384, 128


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    k = min(k, len(x))
    centers = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = assigned(x, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        times = np.bincount(near, minlength=k)
        full = times > 0
        centers[full] = sums[full] / times[full, None]
    return centers


def assigned(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Nearest centre of each row."""
    half = (centers**2).sum(1) / 2
    return np.concatenate([(x[i : i + 4096] @ centers.T - half).argmax(1) for i in range(0, len(x), 4096)] or [np.empty(0, np.int64)])


class Index:
    """Coarse centroids and codebooks for each part of the residuals' directions."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centers = kmeans(sample, lists)
        left, _ = self.directed(sample, assigned(sample, self.centers))
        self.parts = [slice(i, min(i + PART, sample.shape[1])) for i in range(0, sample.shape[1], PART)]
        self.books = [kmeans(left[:, p], CODES) for p in self.parts]
        self.probes, self.rerank = len(self.centers), RERANK

    def directed(self, x: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Directions and lengths of the residuals; no direction where nothing is left."""
        left = x - self.centers[cells]
        most = np.abs(left).max(1)
        left /= np.where(most > 0, most, 1)[:, None]
        length = np.sqrt((left**2).sum(1))
        return left / np.where(length > 0, length, 1)[:, None], length * most

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cells = assigned(x, self.centers)
        left, lengths = self.directed(x, cells)
        return cells, np.stack([assigned(left[:, p], b).astype(np.uint8) for p, b in zip(self.parts, self.books)], 1), lengths

    def measured(self, q: np.ndarray, cells: list[np.ndarray]) -> None:
        """Sets probes from queries and the lists of their true neighbours."""
        ranks = [np.argsort(np.argsort(-(self.centers @ v)))[c] for v, c in zip(q, cells)]
        ranks = np.sort(np.concatenate(ranks)) if ranks else np.array([])
        need = int(ranks[min(len(ranks) - 1, math.ceil(TARGET * len(ranks)))]) + 1 if len(ranks) else len(self.centers)
        self.probes = min(len(self.centers), max(LEAST_PROBES, need))

    def sharded(self, sizes: np.ndarray, least: int) -> None:
        """Groups neighbouring lists; parts[g] is the number of shards of group g. Raises probes until whatever lists are visited hold `least` entries, or all."""
        self.empty = sizes == 0
        held = np.cumsum(np.sort(sizes[~self.empty]))
        self.probes = min(len(self.centers), max(self.probes, int(np.searchsorted(held, least)) + 1))
        groups = max(1, min(len(self.centers), -(-int(sizes.sum()) // SHARD)))
        self.group = assigned(self.centers, kmeans(self.centers, groups))
        self.parts_of = np.maximum(1, -(-np.bincount(self.group, sizes, groups).astype(np.int64) // SHARD))

    def probed(self, q: np.ndarray) -> np.ndarray:
        scores = q @ self.centers.T
        scores[:, self.empty] = -np.inf
        return np.argpartition(-scores, self.probes - 1, axis=1)[:, : self.probes]

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """For each part, the inner products of the queries with all codes."""
        return [(q[:, p] @ book.T).astype(np.float32) for p, book in zip(self.parts, self.books)]

    def scaled(self, q: np.ndarray) -> np.ndarray:
        """The queries in a scale in which inner products with directions fit single precision; their order stays."""
        return q / np.abs(q).max(1, keepdims=True)

    def scores(self, base: np.ndarray, tables: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Inner products of queries with coded vectors, by tables; base: those with the vectors' centroids."""
        out = np.zeros((len(base), len(codes)), np.float32)
        for m, table_ in enumerate(tables):
            out += table_[:, codes[:, m]]
        return base + out * lengths

    def reranking(self, places: np.ndarray) -> None:
        """Sets rerank from the places of true neighbours within their shards, by codes."""
        if len(places):
            self.rerank = max(RERANK, int(np.sort(places)[math.ceil(RERANKED * len(places)) - 1]))

    def shard_of(self, cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """One number for a group of lists and the part in it."""
        g = self.group[cells]
        return g * int(self.parts_of.max()) + hashes % self.parts_of[g]


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def ann_search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query its k nearest others by inner product, ties to the smaller id.

    is_query: a condition on the id column. Vectors that are null, zero, of another length than the most common one (they
    have no inner product with those), or hold null or non-finite components take no part, nor do null ids. A row given
    twice counts once; an id that has two vectors is two entries, and as a query it has a ranking for each. Other columns
    are not read. Without vectors the result is empty.
    """
    spark = vectors.sparkSession
    x = F.col("v")
    sound = F.forall("v", lambda e: e.isNotNull() & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    all_ = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q")).where(F.col("id").isNotNull() & x.isNotNull())
    all_ = all_.where(F.coalesce(sound, F.lit(False)))
    common = all_.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").head()
    shape = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], shape)
    dim = common["dim"]
    all_ = all_.where(F.size("v") == dim)
    # The k + 1 smallest ids of a vector are all that a query can return of it.
    few = all_.select("v", "id").withColumn("r", F.dense_rank().over(W.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    entries = cut(few.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")).select(F.monotonically_increasing_id().alias("num"), "v", "ids"))
    asked = cut(all_.where("q").select("id", "v").distinct().join(entries.select("v", "num"), "v").select(F.col("id").alias("query_id"), "num"))
    sample = entries.orderBy(F.xxhash64("v"), "num").limit(SAMPLE).select("v").toPandas()["v"]
    index = Index(np.stack(sample.to_list()).astype(np.float64), min(MOST_LISTS, max(1, math.isqrt(entries.count()))))
    shared = spark.sparkContext.broadcast(index)

    def coded(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                v = _matrix(b.column(2), dim)
                cells, codes, lengths = shared.value.encoded(v)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(lengths), pa.array([x.tobytes() for x in v], pa.binary())], names=["num", "first", "cell", "codes", "length", "v"])

    lists = cut_table(entries.select("num", F.col("ids")[0].alias("first"), "v").mapInArrow(coded, "num long, first long, cell int, codes binary, length double, v binary"))
    # A few queries against all entries; each task hands on its best.
    few = asked.select("num").distinct().orderBy(F.xxhash64("num"), "num").limit(MEASURED).join(entries.select("num", "v"), "num").toPandas()
    some = np.stack(few["v"].to_list()).astype(np.float64) if len(few) else np.empty((0, dim))
    own = few["num"].to_numpy(np.int64)

    def nearest(batches):
        import pyarrow as pa

        best = [(np.empty(0), np.empty((0, 2), np.int64)) for _ in own]
        for b in (b.slice(at, 2048) for b in batches for at in range(0, b.num_rows, 2048)):
            num, first, v = b.column(0).to_numpy(), b.column(1).to_numpy(), np.frombuffer(b"".join(b.column(2).to_pylist())).reshape(-1, dim)
            scores = some @ v.T
            scores[own[:, None] == num[None, :]] = -np.inf
            for i, (s, e) in enumerate(best):
                some_of = np.flatnonzero(scores[i] >= np.partition(scores[i], -k)[-k]) if len(num) > k else np.arange(len(num))
                s, e = np.concatenate([s, scores[i, some_of]]), np.concatenate([e, np.stack([-first[some_of], num[some_of]], 1)])
                top = np.lexsort((-e[:, 0], -s))[:k]
                best[i] = s[top], e[top]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(own)), pa.int32()), pa.array([s for s, _ in best], pa.list_(pa.float64())), pa.array([e[:, 0] for _, e in best], pa.list_(pa.int64())), pa.array([e[:, 1] for _, e in best], pa.list_(pa.int64()))], names=["i", "s", "f", "num"])

    true = {}
    if len(own):
        near = lists.select("num", "first", "v").mapInArrow(nearest, "i int, s array<double>, f array<long>, num array<long>").select("i", F.inline(F.arrays_zip("s", "f", "num")))
        near = near.where(F.col("s") > float("-inf")).groupBy("i").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", "f", "num")), asc=False), 1, k).alias("a")).select("i", F.explode("a.num").alias("num"))
        for r in F.broadcast(near).join(lists.select("num", F.xxhash64("num").alias("h"), "cell", "codes", "length"), "num").collect():  # MEASURED * k rows
            true.setdefault(r.i, []).append(r)
        index.measured(some[sorted(true)], [np.array([r.cell for r in true[i]]) for i in sorted(true)])
    sizes = np.zeros(len(index.centers))
    for r in lists.groupBy("cell").count().collect():  # at most MOST_LISTS rows
        sizes[r["cell"]] = r["count"]
    index.sharded(sizes, k + 1)
    aims = []  # of measured queries: their number, then the shards of true neighbours in visited lists, and scores by code
    for i, rows in true.items():
        c, h, lengths = (np.array([r[name] for r in rows]) for name in ("cell", "h", "length"))
        small = index.scaled(some[i : i + 1])
        rough = index.scores(small @ index.centers[c].T, index.tables(small), np.frombuffer(b"".join(r.codes for r in rows), np.uint8).reshape(len(rows), -1), lengths)[0]
        seen = np.isin(c, index.probed(some[i : i + 1])[0])
        aims.append((i, index.shard_of(c, h)[seen], (rough - 1e-9 * np.abs(rough))[seen]))
    shared = spark.sparkContext.broadcast(index)

    def above(batches):
        """How many entries of their shards come before the true neighbours of measured queries."""
        import pyarrow as pa

        ix, counts = shared.value, [np.zeros(len(s), np.int64) for _, s, _ in aims]
        visits, small = np.zeros((len(some), len(ix.centers)), bool), ix.scaled(some)
        np.put_along_axis(visits, ix.probed(some), True, 1)
        tables, base = ix.tables(small), small @ ix.centers.T
        for b in (b.slice(at, 2048) for b in batches for at in range(0, b.num_rows, 2048)):
            hashes, cells, lengths = (b.column(n).to_numpy() for n in (0, 1, 3))
            codes, shard = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(cells), -1), ix.shard_of(cells, hashes)
            rough = np.where(visits[:, cells], ix.scores(base[:, cells], tables, codes, lengths), -np.inf)
            for n, (i, shards, least) in zip(counts, aims):
                n += np.count_nonzero((rough[i] >= least[:, None]) & (shard == shards[:, None]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(aims)), pa.int32()), pa.array(counts, pa.list_(pa.int64()))], names=["a", "n"])

    if aims:
        places = lists.select(F.xxhash64("num"), "cell", "codes", "length").mapInArrow(above, "a int, n array<long>").select("a", F.posexplode("n").alias("j", "n")).groupBy("a", "j").agg(F.sum("n").alias("n"))
        index.reranking(np.array([r.n for r in places.collect()], np.int64))  # MEASURED * k rows at most
    shared = spark.sparkContext.broadcast(index)

    def sent(batches):
        """The groups of lists that each query visits."""
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                q = _matrix(b.column(1), dim)
                to = [np.unique(shared.value.group[p]) for i in range(0, len(q), SCORED) for p in shared.value.probed(q[i : i + SCORED])]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in q], pa.binary()), pa.array(to, pa.list_(pa.int64()))], names=["num", "v", "groups"])

    def searched(_, lists, queries):
        """The nearest of one shard for the queries sent to it."""
        import pandas as pd

        names = ["qnum", "score", "first", "num"]
        if not len(lists) or not len(queries):
            return pd.DataFrame({c: [] for c in names})
        ix, out = shared.value, {c: [] for c in names}
        num, first, cells, lengths = (lists[c].to_numpy() for c in ("num", "first", "cell", "length"))
        codes, v = np.frombuffer(b"".join(lists["codes"]), np.uint8).reshape(len(num), -1), np.frombuffer(b"".join(lists["v"])).reshape(-1, dim)
        order = np.argsort(cells, kind="stable")
        num, first, cells, lengths, codes, v = num[order], first[order], cells[order], lengths[order], codes[order], v[order]
        of, qnum = np.frombuffer(b"".join(queries["v"])).reshape(-1, dim), queries["num"].to_numpy()
        ends = [(c, *np.searchsorted(cells, [c, c + 1])) for c in np.unique(cells)]
        for at in range(0, len(of), SCORED):
            q = of[at : at + SCORED]
            visits = np.zeros((len(q), len(ix.centers)), bool)
            np.put_along_axis(visits, ix.probed(q), True, 1)
            rough = np.full((len(q), len(num)), -np.inf)
            small = ix.scaled(q)
            tables = ix.tables(small)
            for cell, a, z in ends:
                who = np.flatnonzero(visits[:, cell])
                if len(who):
                    rough[who, a:z] = ix.scores((small[who] @ ix.centers[cell])[:, None], [t[who] for t in tables], codes[a:z], lengths[a:z])
            n = min(ix.rerank, len(num))
            best = np.argpartition(-rough, n - 1, axis=1)[:, :n]
            for i in range(len(q)):
                there = best[i][np.isfinite(rough[i, best[i]])]
                exact = v[there] @ q[i]
                top = np.lexsort((first[there], -exact))[: k + 1]
                out["qnum"].append(qnum[at + i]), out["score"].append(exact[top]), out["first"].append(-first[there][top]), out["num"].append(num[there][top])
        return pd.DataFrame(out)

    rows = [(g, int(p)) for g, p in enumerate(index.parts_of)]  # at most MOST_LISTS rows
    groups = F.broadcast(spark.createDataFrame(rows, "g long, parts int"))
    cell_of = F.broadcast(spark.createDataFrame([(c, int(g)) for c, g in enumerate(index.group)], "cell int, g long"))
    asking = asked.select("num").distinct().join(entries.select("num", "v"), "num").select("num", "v").mapInArrow(sent, "num long, v binary, groups array<long>")
    asking = cut_table(asking.select("num", "v", F.explode("groups").alias("g")))
    met = asking.groupBy("g").count().select("g", F.ceil(F.col("count") / QUERY_BLOCK).cast("int").alias("blocks"))
    met = F.broadcast(cut(met))  # at most MOST_LISTS rows
    shards = lists.join(cell_of, "cell").join(groups, "g").join(met, "g").withColumn("part", F.pmod(F.xxhash64("num"), F.col("parts")).cast("int"))
    shards = shards.select("g", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "num", "first", "cell", "codes", "length", "v")
    asking = asking.join(groups, "g").join(met, "g").withColumn("block", F.pmod(F.xxhash64("num"), F.col("blocks")).cast("int"))
    asking = asking.select("g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", "num", "v")
    found = shards.groupBy("g", "part", "block").cogroup(asking.groupBy("g", "part", "block")).applyInPandas(searched, "qnum long, score array<double>, first array<long>, num array<long>")
    best = found.groupBy("qnum").agg(F.flatten(F.collect_list(F.arrays_zip("score", "first", "num"))).alias("a")).select("qnum", F.slice(F.sort_array("a", asc=False), 1, k + 1).alias("a"))
    near = best.select("qnum", F.inline("a")).join(entries.select("num", "ids"), "num").groupBy("qnum").agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("neg"), i.alias("id"))))).alias("a"))
    near = near.select(F.col("qnum").alias("num"), F.slice(F.array_sort("a"), 1, k + 1).alias("a"))
    out = asked.join(near, "num").select("query_id", F.posexplode(F.slice(F.filter("a", lambda e: e["id"] != F.col("query_id")), 1, k)).alias("rank", "e"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), (-F.col("e.neg")).alias("score"))


def op2_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
