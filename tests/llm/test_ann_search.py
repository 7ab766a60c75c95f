"""Recall against brute force, on vectors without and with clusters, and ties."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import ann_search


def recall(spark, df):
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).collect()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got = {}
    for r in ann_search.ann_search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r)
    right = total = 0
    for i, v in rows:
        if i % 20 == 0:
            s = x @ v
            s[ids == i] = -np.inf
            want = ids[np.lexsort((ids, -s))[:20]]
            mine = sorted(got[i], key=lambda r: r["rank"])
            assert [r["rank"] for r in mine] == list(range(1, len(want) + 1)) and all(abs(r.score - s[ids == r.vec_id][0]) < 1e-12 for r in mine)
            right, total = right + len(set(want) & {r.vec_id for r in mine}), total + len(want)
    return right / total


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no tables here")
def test_recall_of_the_table(spark):
    assert recall(spark, spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")) >= 0.9


def test_clusters_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(ann_search, "SHARD", 256)
    monkeypatch.setattr(ann_search, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 24)) * 4
    x = centres[rng.integers(0, 40, 2400)] + rng.normal(size=(2400, 24))
    x[:800] = centres[0] + rng.normal(size=(800, 24)) * 0.1  # one hot cluster
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert recall(spark, df) >= 0.9


def test_ties_go_to_smaller_ids(spark):
    v = [[1.0, 0.0], [0.0, 1.0]]
    rows = [(i, v[0]) for i in range(70)] + [(100 + i, v[1]) for i in range(30)]
    got = {}
    for r in ann_search.ann_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got[0] == [(i, 1.0) for i in range(1, 21)] and got[20] == [(i, 1.0) for i in range(20)] and got[60] == [(i, 1.0) for i in range(20)]
    assert got[100] == [(100 + i, 1.0) for i in range(1, 21)] and got[120] == [(100 + i, 1.0) for i in range(20)]


@pytest.mark.parametrize("factor", [1e25, 1e-25])
def test_large_and_small_numbers(spark, factor):
    """Inner products of 1e50 and 1e-50 have no single precision."""
    x = np.random.default_rng(5).normal(size=(400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = lambda df: {(r.query_id, r["rank"], r.vec_id) for r in ann_search.ann_search(df, F.col("vec_id") % 20 == 0).collect()}
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    scaled = plain.withColumn("embedding", F.transform("embedding", lambda e: e * factor))
    want = found(plain)
    assert len(want) == 400 and len(found(scaled) & want) >= 360


def test_each_query_gets_its_number(spark):
    """Nearly equal vectors fall into one list; four queries that point elsewhere visit others first."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 8)) * 1e-10
    x[:, 0] += 1e6
    x[::1500] = [[-1, 0.1, 0.2, 0, 0, 0, 0, 0], [-1, 0, 0, 0.3, 0, 0, 0, 0], [-2, 0, 0.1, 0, 0, 0.2, 0, 0], [-1, 0, 0, 0, 0.5, 0, 0, 0]]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    counts = ann_search.ann_search(df, F.col("vec_id") % 20 == 0).groupBy("query_id").count().collect()
    assert len(counts) == 300 and {r["count"] for r in counts} == {20}


def test_clusters_of_different_widths(spark):
    """In a narrow cluster of many vectors, codes made for wide ones don't tell them apart."""
    rng = np.random.default_rng(6)
    of, width = rng.integers(0, 10, 8000), np.where(np.arange(10) < 7, 10.0 ** -np.arange(1, 11), 1)
    x = rng.normal(size=(10, 16))[of] + rng.normal(size=(8000, 16)) * width[of, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert recall(spark, df) >= 0.95
