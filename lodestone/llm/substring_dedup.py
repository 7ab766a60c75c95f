"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 8 bytes places chunk ends, so an insertion
moves only the chunks that touch it. Runs of consecutive chunks that just reach
`min_bytes`, from each chunk on and back from each, are compared by digest over
all documents; those that occurred earlier as a whole are deleted. Hashes are computed for a whole text at once by
doubling the window.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import anchored, cut_table, hot_keys, joined_salted, table, with_row_key

#: Mean distance of places where a chunk may end, least and greatest bytes of a chunk, least bytes of a deleted run.
MEAN, LEAST, MOST, MIN_BYTES = 24, 4, 256, 96

_seed = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_seed = (_seed ^ (_seed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
GEAR = ((_seed ^ (_seed >> np.uint64(29))) >> np.uint64(24)).astype(np.uint32)


def chunk_ends(data: bytes, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends (exclusive) of the chunks of a text; the last is its length, none for no bytes."""
    if not data:
        return []
    h = GEAR[np.frombuffer(data, np.uint8)]
    for w in (1, 2, 4):
        more = h.copy()
        more[w:] += h[:-w] << np.uint32(w)
        h = more
    places = (np.flatnonzero((h >> np.uint32(16)) < (1 << 16) // mean) + 1).tolist()
    out, last = [], 0
    for p in [*places, len(data)]:
        while p - last > most:
            last += most
            out.append(last)
        if p - last >= least:
            out.append(p)
            last = p
    if last < len(data):
        out.append(len(data))
    return out


def runs_of(ends: list[int], min_bytes: int) -> list[int]:
    """Sorted places (start << 32 | length) of the shortest runs of chunks of at least min_bytes from each chunk on and back from each."""
    e = np.array(ends, np.int64)
    s = np.concatenate([[0], e[:-1]]) if ends else e
    on, back = np.searchsorted(e, s + min_bytes), np.searchsorted(s, e - min_bytes, "right") - 1
    there, reached = on < len(e), back >= 0
    starts, stops = np.concatenate([s[there], s[back[reached]]]), np.concatenate([e[on[there]], e[reached]])
    return np.unique(starts << 32 | (stops - starts)).tolist()


#: Runs that a Python worker hands on at once, and rows whose kept texts it hands on at once: they bound its memory.
BLOCK, ROWS = 1 << 14, 256


def _runs(rows: DataFrame, min_bytes: int, half: bool = False) -> DataFrame:
    """A row for each of runs_of(): _row, _id, its digest (128 bits: d and e) and its place (at), from _row, _id, text; with `half` d alone, from text."""

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_128_digest as digest

        def block(b, digests, counts, places):
            d, e = (np.frombuffer(b"".join(digests), ">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64).reshape(-1, 2).T.copy()
            if half:
                return pa.RecordBatch.from_arrays([pa.array(d)], names=["d"])
            of = pa.array(np.repeat(list(counts), list(counts.values())))
            return pa.RecordBatch.from_arrays([b.column(0).take(of), b.column(1).take(of), pa.array(d), pa.array(e), pa.array(places, pa.int64())], names=["_row", "_id", "d", "e", "at"])

        for b in batches:
            digests, counts, places = [], {}, []
            for i, t in enumerate(b.column(b.num_columns - 1)):
                data = (t.as_py() or "").encode(errors="replace")
                at = runs_of(chunk_ends(data), min_bytes)
                lo = 0
                while lo < len(at):
                    now = at[lo : lo + BLOCK - len(digests)]
                    lo += len(now)
                    digests += [digest(data[(a := x >> 32) : a + (x & 0xFFFFFFFF)]) for x in now]
                    counts[i] = len(now)
                    if not half:
                        places += now
                    if len(digests) == BLOCK:
                        yield block(b, digests, counts, places)
                        digests, counts, places = [], {}, []
            if digests:
                yield block(b, digests, counts, places)

    if half:
        return rows.select("text").mapInArrow(run, "d long")
    return rows.mapInArrow(run, f"_row long, _id {rows.schema['_id'].dataType.simpleString()}, d long, e long, at long")


def trimmed(data: bytes, a: int, e: int) -> tuple[int, int]:
    """The range cut to whole characters."""
    while a < e and data[a] & 0xC0 == 0x80:
        a += 1
    while e > a and e < len(data) and data[e] & 0xC0 == 0x80:
        e -= 1
    return a, e


def substring_dedup(docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text (what is kept), n_bytes, dup_bytes, spans (deleted byte ranges of the text), dup_of (sorted ids that hold the first copies), is_dup.

    The first copy of a run is that in the row of the smallest id (null ids last, then row order), at the smallest place;
    later ones in the same text are deleted as well. Runs that touch make one span: each byte of it lies in a run that
    stands earlier as a whole. Null texts stay null with 0 bytes; repeated rows are copies of each
    other; a text that is all copies becomes ''; empty texts have no runs. Texts are taken whole, up to 4 GiB; columns
    other than these two are not read. Two runs of one 128-bit digest count as equal.
    """
    rows = with_row_key(anchored(docs).select(id_col, text_col)).select("_row", F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    # Half of the digest finds runs that may repeat; only those are written, with the whole digest.
    often = cut_table(_runs(rows, min_bytes, half=True).groupBy("d").agg(F.count("*").alias("n")).where("n > 1"))
    hot, salt = hot_keys(often, ["d"]), F.xxhash64("_row", "at")
    # at: start and length of a run in one long, which also orders the runs of a text.
    placed = cut_table(joined_salted(_runs(rows, min_bytes), often.select("d"), ["d"], hot, salt))
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row", "at")
    first = cut_table(placed.groupBy("d", "e").agg(F.min(place).alias("first")))
    start = F.shiftright("at", 32)
    later = joined_salted(placed, first, ["d", "e"], hot, salt).where(place != F.col("first")).select("_row", start.alias("start"), (start + F.col("at").bitwiseAND(0xFFFFFFFF)).alias("end"), F.col("first._id").alias("of"))
    by_place = W.partitionBy("_row").orderBy("start", "end")
    # A run that begins later never ends earlier.
    later = later.withColumn("new", F.coalesce(F.col("start") > F.lag("end").over(by_place), F.lit(True)).cast("long"))
    runs = later.withColumn("run", F.sum("new").over(by_place)).groupBy("_row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("of").alias("of"))
    runs = runs.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("of")))).alias("of"))

    def run(batches):
        import pyarrow as pa

        names = ["_id", "text", "n_bytes", "dup_bytes", "spans", "dup_of"]
        for b in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            out = {c: [] for c in names}
            for id_, text, found, of in zip(*(b.column(k).to_pylist() for k in range(4))):
                data = (text or "").encode(errors="replace")
                spans = [trimmed(data, x["start"], x["end"]) for x in found or []]
                kept, last = [], 0
                for a, e in spans:
                    kept.append(data[last:a])
                    last = e
                kept.append(data[last:])
                for k, v in zip(names, (id_, text if not spans else b"".join(kept).decode(), len(data), sum(e - a for a, e in spans), [{"start": a, "end": e} for a, e in spans], of or [])):
                    out[k].append(v)
            id_type = b.schema.field(0).type
            types = [id_type, pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(id_type)]
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(names, types)], names=names)

    joined = rows.join(runs, "_row", "left").select("_id", "text", "runs", "of")
    out = joined.mapInArrow(run, f"_id {kind}, text string, n_bytes long, dup_bytes long, spans array<struct<start:long,end:long>>, dup_of array<{kind}>")
    return out.select(F.col("_id").alias(id_col), "text", "n_bytes", "dup_bytes", "spans", "dup_of", (F.col("dup_bytes") > 0).alias("is_dup"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "dup_bytes", F.size("spans").cast("long").alias("n_spans"), "is_dup", "dup_of", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
