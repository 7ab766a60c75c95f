"""Signals, votes, anomalies and plain scores of colour images, facts of drawings, and the image reader."""

import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import drawings, pictures
from lodestone.operators.images import resized
from lodestone.sources import readers

PICTURE = "id long, width int, height int, rgb binary"


def row(i, px):
    return (i, px.shape[1], px.shape[0], bytearray(px.astype(np.uint8).tobytes()))


def chart(h=120, w=160):
    px = np.full((h, w, 3), 255)
    px[5 : h - 10, 20:22] = 0
    px[h - 12 : h - 10, 10 : w - 5] = 0
    for k in range(5):
        px[h - 20 - 15 * k : h - 12, 40 + 20 * k : 50 + 20 * k] = (200, 30, 30)
    return px


def photo(h=120, w=160):
    rng = np.random.default_rng(4)
    return np.clip(resized(rng.normal(128, 90, (h // 3, w // 3)), w, h)[..., None] + rng.normal(0, 40, (h, w, 3)), 0, 255)


def runs(v):
    best = now = 0
    for x in v:
        now = now + 1 if x else 0
        best = max(best, now)
    return best


def test_longest_runs():
    dark = np.random.default_rng(1).random((30, 12)) < 0.7
    assert pictures.longest_runs(dark).tolist() == [runs(dark[:, x]) for x in range(12)]


def test_signals_by_loops():
    px = chart().astype(np.uint8)
    h, w = px.shape[:2]
    used, straight, axis, background = pictures.signals(px)
    assert used == len({tuple(p >> 4) for p in px.reshape(-1, 3)}) / 4096
    grey = px.astype(np.float32) @ np.array([0.299, 0.587, 0.114], np.float32)
    dark = grey < grey.mean() - 0.75 * grey.std() - 1e-6
    assert axis == min(max(runs(dark[:, x]) / h for x in range(w // 3)), max(runs(dark[y]) / w for y in range(2 * h // 3, h)))
    assert background == pytest.approx(np.mean(grey > 245)) and straight > 0.9


def test_votes(spark):
    rows = [row(1, chart()), row(2, photo()), row(3, np.zeros((20, 90, 3))), (4, 40, 40, bytearray(b"x")), (5, None, None, None), row(6, chart(600, 700))]
    measured = pictures.with_signals(spark.createDataFrame(rows, PICTURE))
    got = {r.id: r for r in pictures.voted(measured).collect()}
    assert got[1].label == got[6].label == "analytical" and got[1].votes_analytical == 4 and got[1].votes_photo == 0
    assert got[2].votes_photo >= 2 and got[2].label in ("photo", "ambiguous")
    for i in (3, 4, 5):
        assert (got[i].unique_color_ratio, got[i].votes_analytical, got[i].votes_photo, got[i].label) == (None, 0, 0, "ambiguous")
    mixed = spark.createDataFrame([(1, 0.5, 0.5, 0.0, 0.05)], "id long, " + pictures.SIGNALS)
    for density, label in ((0.2, "analytical"), (0.01, "photo"), (0.1, "ambiguous"), (None, "ambiguous")):
        assert pictures.voted(mixed, F.lit(density).cast("double")).head().label == label
    assert pictures.with_signals(spark.createDataFrame([], PICTURE)).count() == 0


def test_anomalies(spark):
    flat, noise = np.full((40, 50, 3), 90), np.random.default_rng(2).integers(0, 256, (128, 128, 3))
    rows = [(*row(1, flat), "a"), (*row(2, noise), "b"), (3, 9, 9, None, "b")]
    df = spark.createDataFrame(rows, PICTURE + ", batch string")
    got = {r.id: r for r in pictures.with_anomalies(df).collect()}
    p = [np.bincount(noise[..., c].ravel(), minlength=256) / 128**2 for c in range(3)]
    entropy = sum(-sum(x * math.log2(x) for x in q if x > 0) for q in p) / 24
    assert got[2].color_score == pytest.approx(2 * (1 - entropy)) and got[1].color_score == 1.0 and got[3].score == 0
    assert got[1].noise_score > 0.9 and got[2].noise_score > 0
    batches = {r.batch: (r.n, r.anomaly_fraction, r.flagged) for r in pictures.batch_anomalies(df, "batch").collect()}
    assert batches == {"a": (1, 1.0, True), "b": (2, 0.0, False)}


def test_cosines():
    m = pictures._cosines(16)
    assert np.allclose(m @ m.T, np.eye(16))


def test_plain_scores(spark):
    blank = np.full((60, 60, 3), 255)
    half = blank.copy()
    half[:, ::30] = (250, 0, 0)
    half[20:, 10:40] = (20, 60, 200)
    rows = [row(1, blank), row(2, half), (3, 2, 2, None)]
    got = {r.id: r for r in pictures.plain_scores(spark.createDataFrame(rows, PICTURE)).collect()}
    assert (got[1].graphics_score, got[1].classification) == (0.05, "reject")
    grey = half.mean(axis=2)
    assert got[2].edge_density == pytest.approx(((np.abs(np.diff(grey, axis=0)) > 20).mean() + (np.abs(np.diff(grey, axis=1)) > 20).mean()) / 2)
    assert (got[2].graphics_score, got[2].classification, got[2].reasons) == (0.9, "pass", "heuristic_graphics")
    assert (got[3].graphics_score, got[3].non_graphics_score, got[3].reasons) == (0.0, 1.0, "heuristic_error")


def test_page_facts(spark):
    path = [(1, d, "l", 0.0, float(k), 30.0, float(k)) for d in range(12) for k in range(3)]
    items = path + [(2, k, "re", 0.0, 0.0, 9.0, 9.0) for k in range(8)] + [(2, 9, "l", 0.0, 0.0, 20.0, 0.0), (2, 9, "l", 0.0, 0.0, 30.0, 30.0), (7, 1, "l", 0.0, 0.0, 99.0, 0.0)]
    pages = [(1, "• one\n  - two\nplain"), (2, "x y" * 60), (3, None)]
    df = drawings.page_facts(spark.createDataFrame(pages, "page_id long, text string"), spark.createDataFrame(items, "page_id long, drawing_id long, kind string, x0 double, y0 double, x1 double, y1 double"))
    got = {r.page_id: tuple(r)[1:] for r in df.collect()}
    assert got == {1: (13, 2, 12, 36, 0, 1, 0), 2: (120, 0, 0, 0, 8, 0, 1), 3: (0, 0, 0, 0, 0, 0, 0)}


def test_reader(spark, tmp_path):
    def part(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    px = np.random.default_rng(0).integers(0, 256, (5, 7, 3)).astype(np.uint8)
    raw = b"".join(b"\0" + r.tobytes() for r in px)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 7, 5, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b""))
    (tmp_path / "in" / "b.png").write_bytes(b"no image")
    got = {r.id[-5]: r for r in readers.pictures(spark, str(tmp_path)).collect()}
    assert (got["a"].width, got["a"].height, bytes(got["a"].rgb)) == (7, 5, px.tobytes())
    assert (got["b"].width, got["b"].height, got["b"].rgb) == (None, None, None)
    grey = {r.id[-5]: r.grey for r in readers.grey(readers.pictures(spark, str(tmp_path))).collect()}
    assert bytes(grey["a"]) == bytes((19595 * int(r) + 38470 * int(g) + 7471 * int(b) + 32768) >> 16 for r, g, b in px.reshape(-1, 3)) and grey["b"] is None
