"""N-gram Jaccard join with Bayesian pruning of candidates.

Each text is the set of its five-word shingles and has a MinHash signature.
Equal sets are one node. Nodes that share a band of the signature meet in a
bucket; there pairs compare their MinHash values some at a time and are dropped
as soon as the posterior probability that their similarity reaches the
threshold is below the tolerance. What survives is joined into candidate
groups, and all pairs within a group are verified exactly on their shingles,
block against block, without writing pairs out. Links that hold give the
classes and the number of links.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import cut, joined_small, packed, table, unpacked, with_row_key
from lodestone.llm.components import components

WORDS = 5
THRESHOLD = 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8^4)^24 = 3e-6.
BANDS, ROWS = 24, 4
#: Posterior probability below which a pair is dropped, and MinHash values compared at a time.
TOLERANCE, STEP = 1e-6, 16
#: Nodes of a bucket, and nodes and shingles of a candidate group, that one task takes against as many others.
BUCKET_BLOCK, GROUP_BLOCK, GROUP_SHINGLES = 2048, 128, 100_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_M64 = (1 << 64) - 1
_cache: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words; a text of fewer, but not none, is one run."""
    import xxhash

    found = _WORD.findall((text or "").encode(errors="replace").lower())
    if not found:
        return np.empty(0, np.uint64)
    if len(_cache) > 400_000:
        _cache.clear()
    cache, hashed = _cache, xxhash.xxh3_64_intdigest
    codes = np.empty(len(found), np.uint64)
    for i, w in enumerate(found):
        code = cache.get(w)
        if code is None:
            code = cache[w] = hashed(w)
        codes[i] = code
    n = min(words, len(codes))
    h = np.full(len(codes) - n + 1, n, np.uint64)
    for k in range(n):
        h = _mixed(h + codes[k : len(codes) - n + 1 + k])
    return np.unique(h)


def _permutations(k: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = _mixed(np.arange(1, 2 * k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:k] | np.uint64(1), seeds[k:]


def minhash(s: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    a, b = _permutations(k)
    out = np.full(k, _M64, np.uint64)
    for i in range(0, len(s), 4096):
        out = np.minimum(out, (s[None, i : i + 4096] * a[:, None] + b[:, None]).min(1))
    return (out >> np.uint64(32)).astype(np.uint32)


def needed(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, k: int = BANDS * ROWS, step: int = STEP) -> list[int]:
    """For each step, the least number of equal values so far with which P(similarity >= threshold) >= tolerance.

    The prior of the similarity s is uniform; two 8-bit values are equal with probability s + (1 - s) / 256.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    out = []
    for n in range(step, k + 1, step):
        for m in range(n + 1):
            like = m * np.log(p) + (n - m) * np.log1p(-p)
            like = np.exp(like - like.max())
            if like[s >= threshold].sum() >= tolerance * like.sum():
                break
        out.append(m)
    return out


def survivors(signatures: np.ndarray, pivot: int, rest: np.ndarray, need: list[int], step: int = STEP) -> np.ndarray:
    matches = np.zeros(len(rest), np.int64)
    for i, least in enumerate(need):
        part = slice(i * step, (i + 1) * step)
        matches = matches + (signatures[rest, part] == signatures[pivot, part]).sum(1)
        alive = matches >= least
        rest, matches = rest[alive], matches[alive]
    return rest


def forest(n: int, near) -> list[tuple[int, int]]:
    """Edges of a spanning forest; near(i, rest) gives those of rest that i is linked with."""
    rest, out = np.arange(n), []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            got = near(i, rest)
            if len(got):
                out += [(i, j) for j in got]
                queue += list(got)
                rest = rest[~np.isin(rest, got)]
    return out


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of two lists of sets."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    keep = shared[code]
    owner, code = owner[keep], (np.cumsum(shared) - 1)[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 8192
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [start, start + width])
        x = np.zeros((len(sets), width), np.float32)
        x[owner[a:b], code[a:b] - start] = 1
        out += x[: len(left)] @ x[len(left) :].T
    return out


def _signed(rows: DataFrame, words: int) -> DataFrame:
    """rows: _row, _id, text -> _row, _id, set (digest of the shingle set; null without words), n, sig, bands."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            sets, n, sig, bands = [], [], [], []
            for text in b.column(2).to_pylist():
                s = shingles(text, words)
                n.append(len(s))
                if not len(s):
                    sets.append(None), sig.append(None), bands.append(None)
                    continue
                m = minhash(s)
                sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig.append(m.astype(np.uint8).tobytes())
                raw = m.tobytes()
                bands.append([xxhash.xxh3_64_intdigest(raw[4 * ROWS * i : 4 * ROWS * (i + 1)], seed=i) - (1 << 63) for i in range(BANDS)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["_row", "_id", "set", "n", "sig", "bands"])

    return rows.mapInArrow(run, f"_row long, _id {rows.schema['_id'].dataType.simpleString()}, set binary, n long, sig binary, bands array<long>")


def _candidates(nodes: DataFrame, need: list[int]) -> DataFrame:
    """Edges (a, b) of spanning forests of the pairs that survive pruning. nodes: num, sig, bands."""
    placed = nodes.select("num", F.explode("bands").alias("key"))
    buckets = placed.groupBy("key").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("num")).alias("x"), F.bit_xor(F.xxhash64("num", F.lit(1))).alias("y")).where("c > 1")
    # Of buckets with the same nodes one is enough.
    buckets = cut(buckets.groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("c") / BUCKET_BLOCK).alias("blocks")))
    members = placed.join(buckets, "key").join(nodes.select("num", "sig"), "num")
    block = F.pmod(F.xxhash64("num"), F.col("blocks"))
    members = members.withColumn("at", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    groups = members.groupBy("key", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j")).agg(F.collect_list(F.struct("num", "sig")).alias("members"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            a, z = [], []
            lists = b.column(0)
            for k in range(len(lists)):
                v = lists[k].values
                num = v.field("num").to_numpy(zero_copy_only=False)
                sig = np.frombuffer(b"".join(v.field("sig").to_pylist()), np.uint8).reshape(len(num), -1)
                order = np.argsort(num)  # so that buckets of one group agree on their pivot, and edges repeat
                num, sig = num[order], sig[order]
                for i, j in forest(len(num), lambda i, rest: survivors(sig, i, rest, need)):
                    a.append(num[i]), z.append(num[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["a", "b"])

    return groups.select("members").mapInArrow(run, "a long, b long")


def _verified(texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """Rows (a, b, links): links of a in one block pair (b null), or an edge of a spanning forest (links null).

    texts: root, num, copies, n, text; a row for each node of a candidate group.
    """
    sizes = cut(texts.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / GROUP_BLOCK, F.sum("n") / GROUP_SHINGLES)).alias("blocks")))
    rows = texts.join(sizes, "root").withColumn("at", F.pmod(F.xxhash64("num"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    groups = rows.groupBy("root", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j")).agg(F.collect_list(F.struct("num", "copies", "at", "text")).alias("members"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            one, two, links = [], [], []
            lists, i_, j_ = b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()
            for k in range(len(lists)):
                v = lists[k].values
                num, copies, at = (v.field(c).to_numpy(zero_copy_only=False) for c in ("num", "copies", "at"))
                sets = [shingles(t, words) for t in v.field("text").to_pylist()]
                size = np.array([len(s) for s in sets], np.float64)
                left, right = np.flatnonzero(at == i_[k]), np.flatnonzero(at == j_[k])
                if not len(left) or not len(right):
                    continue
                both = common([sets[x] for x in left], [sets[x] for x in right]).astype(np.float64)
                ok = both >= threshold * (size[left][:, None] + size[right][None, :] - both) - 1e-9
                ok &= num[left][:, None] != num[right][None, :]
                full = np.zeros((len(num), len(num)), bool)
                full[np.ix_(left, right)] = ok
                full |= full.T
                held = full.astype(np.int64) @ copies
                for x in np.flatnonzero(held):
                    one.append(num[x]), two.append(None), links.append(held[x])
                order = np.argsort(num)
                num, full = num[order], full[np.ix_(order, order)]
                for x, y in forest(len(num), lambda x, rest: rest[full[x, rest]]):
                    one.append(num[x]), two.append(num[y]), links.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(links, pa.int64())], names=["a", "b", "links"])

    return groups.select("members", "i", "j").mapInArrow(run, "a long, b long, links long")


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_row, id, class_id (smallest id of the class), n_links (other rows that it is linked with), n_copies (those with the same shingles), first (the row that stands for its class).

    Two rows are linked if the Jaccard similarity of their shingle sets is at least the threshold; classes are the
    connected components. Texts without words (null, empty) are linked with none and are classes of their own (class_id
    is their id). Texts of fewer than five words are one shingle. Null ids come last for class_id and first.
    """
    rows = with_row_key(docs.select(id_col, text_col)).select("_row", F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    signed = cut(_signed(rows, words))
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
    nodes = signed.where("set is not null").groupBy("set").agg(F.count("*").alias("copies"), F.min(place).alias("first"), F.first(F.struct("n", "sig", "bands")).alias("s"))
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("num"), "set", "copies", "first", "s.n", "s.sig", "s.bands"))
    groups = components(_candidates(nodes, needed(threshold)))
    chosen = cut(nodes.join(groups.withColumnRenamed("node", "num"), "num").select("num", "root", "copies", "n", F.col("first._row").alias("_row")))
    checked = cut(_verified(joined_small(rows.select("_row", "text"), chosen, "_row"), words, threshold))
    classes = components(checked.where("b is not null").select("a", "b"))
    links = checked.where("links is not null").groupBy(F.col("a").alias("num")).agg(F.sum("links").alias("links"))
    member = nodes.select("num", "copies", "first").join(classes.withColumnRenamed("node", "num"), "num").join(links, "num", "left")
    least = cut(member.groupBy("root").agg(F.min("first").alias("least")))
    member = member.select("num", "root", "links").join(least, "root").select("num", "least", "links")
    whole = nodes.select("num", "set", "copies", "first").join(cut(member), "num", "left")
    whole = cut(whole.select("set", "copies", F.coalesce("least", "first").alias("least"), F.coalesce("links", F.lit(0)).alias("links")))
    out = signed.select("_row", "_id", "set").join(whole, "set", "left")
    return out.select(
        "_row", F.col("_id").alias(id_col), F.when(F.col("least").isNull(), F.col("_id")).otherwise(F.col("least._id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"), F.coalesce(F.col("copies") - 1, F.lit(0)).cast("long").alias("n_copies"),
        (F.col("least").isNull() | (F.col("least._row") == F.col("_row"))).alias("first"),
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class, that of the smallest id; same columns."""
    kept = near_duplicates(docs, **options).where("first").select("_row")
    return unpacked(packed(docs).join(kept, "_row", "left_semi"), docs, {})


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")
