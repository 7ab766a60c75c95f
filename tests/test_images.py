"""Hashes and containment of images, robots verdicts, names and nearest hashes against plain loops."""

import numpy as np
from pyspark.sql import functions as F

from lodestone.functions import robots
from lodestone.operators import dedup, images, packaging

IMAGE = "id long, width int, height int, grey binary"


def row(i, px):
    return (i, px.shape[1], px.shape[0], bytearray(px.astype(np.uint8).tobytes()))


def textured(h, w, seed):
    rough = np.random.default_rng(seed).integers(0, 255, (h // 8, w // 8))
    return np.kron(rough, np.ones((8, 8)))


def test_hash(spark):
    ramp = np.tile(np.arange(90)[::-1] * 2, (80, 1))
    rows = [row(1, ramp), row(2, ramp[:, ::-1]), row(3, np.full((20, 30), 7)), (4, 3, 3, bytearray(b"12")), (5, None, 3, None), row(6, np.array([[9]]))]
    got = {r.id: r.h for r in images.difference_hashes(spark.createDataFrame(rows, IMAGE)).collect()}
    assert got == {1: -1, 2: 0, 3: 0, 4: None, 5: None, 6: 0}
    px = textured(160, 240, 3)
    two = [row(1, px), row(2, np.kron(px, np.ones((2, 2))))]
    h = [r.h for r in images.difference_hashes(spark.createDataFrame(two, IMAGE), 256).collect()]
    assert bin((h[0] ^ h[1]) & (2**64 - 1)).count("1") <= 4


def test_hash_empty(spark):
    assert images.difference_hashes(spark.createDataFrame([], IMAGE)).count() == 0


def test_sub_image(spark):
    large = textured(200, 240, 1)
    pages = [row(1, large[40:120, 60:160]), row(2, textured(80, 104, 2)), row(3, np.full((50, 50), 9)), (4, 5, 5, None)]
    out = images.sub_images(spark.createDataFrame(pages, IMAGE), spark.createDataFrame([row(9, large)], IMAGE)).collect()
    assert [(r.id, r.of) for r in out] == [(1, 9)] and out[0].score > 0.99


def test_match_is_normalised_correlation():
    rng = np.random.default_rng(5)
    big, small = rng.normal(size=(14, 17)), rng.normal(size=(4, 5))
    want = max(np.corrcoef(big[i : i + 4, j : j + 5].ravel(), small.ravel())[0, 1] for i in range(11) for j in range(13))
    assert abs(images._best_match(big, small) - want) < 1e-9


def test_robots(spark):
    text = "User-agent: bot\nDisallow: /private\n\nUser-agent: *\nCrawl-delay: 3\nDisallow: /"
    rows = [("http://a.org/x", 200, text), ("http://a.org/private/y", 200, text), ("http://a.org/x", 500, None), ("http://a.org/x", 404, text), ("http://a.org/x", None, None), (None, 200, text)]
    df = spark.createDataFrame(rows, "url string, code int, text string").select(robots.verdict(F.col("url"), F.col("code"), F.col("text"), "bot").alias("v")).select("v.*")
    assert [r.status for r in df.collect()] == ["allowed", "disallowed", "disallowed", "allowed", "unavailable", "allowed"]


def test_names_and_batches(spark):
    files = spark.createDataFrame([(1, 1, None), (2, 1, 4), (3, 1, None), (4, 100, None)], "id long, batch long, counter long")
    got = [r.delivered_filename for r in packaging.with_names(files, "batch", "counter", "id", F.lit("png"), "img").orderBy("id").collect()]
    assert got == ["BATCH_01_img_00005.png", "BATCH_01_img_00004.png", "BATCH_01_img_00006.png", "BATCH_100_img_00001.png"]
    nodes = spark.range(0, 12).select("id", packaging.next_batch(F.col("id"), F.lit(1), F.lit(3)).alias("b")).collect()
    assert [r.b for r in nodes] == [next(x for x in range(r.id + 1, 99) if (x - 1) % 3 == 1) for r in nodes]


def test_nearest_hash(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 3, int(h)) for i, h in enumerate(rng.integers(-(2**62), 2**62, 60))] + [(60, 1, None)]
    df = spark.createDataFrame(rows, "id long, file_id long, h long")
    got = {r.id: (r.distance, r.closest_id) for r in dedup.nearest_hash(df, df, most=7).collect()}
    bits = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    for i, f, h in rows[:-1]:
        assert got[i] == min((bits(h, g), j) for j, k, g in rows[:-1] if k != f)
    assert got[60] == (None, None)


def test_nearest_hash_has_no_product(spark):
    """Queries by hashes as rows of a join were shuffled and spilled in proportion to the pairs."""
    rows = [(i, i % 2, h) for i, h in enumerate([5, 5, 7, -1, -2, 5, 2**62])] + [(7, None, 5), (8, 0, None)]
    df = spark.createDataFrame(rows, "id long, file_id long, h long")
    got = dedup.nearest_hash(df, df)
    plan = got._jdf.queryExecution().toString()
    assert "Join Cross" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert {tuple(r) for r in got.collect()} == {(0, 1, 0), (1, 0, 0), (2, 1, 1), (3, 4, 1), (4, 3, 1), (5, 0, 0), (6, 1, 3), (7, None, None), (8, None, None)}
