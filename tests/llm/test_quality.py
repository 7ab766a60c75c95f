"""Trees against plain traversal and an exhaustive split search; the bound on fitted rows."""

import numpy as np
from pyspark.sql import functions as F

from lodestone.llm import quality


def traversed(model, row):
    raw = model.start
    for t in range(len(model.split)):
        node, level = 0, 0
        while level < model.depth:
            node = 2 * node + (2 if row[model.split[t, node]] > model.above[t, node] else 1)
            level += 1
        raw += model.leaf[t, node - (2**model.depth - 1)]
    return 1 / (1 + np.exp(-raw))


def test_scores_are_plain_traversal():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = quality.Boosted(x, y, trees=12, depth=3)
    got = model.scores(x)
    assert np.allclose(got, [traversed(model, r) for r in x]) and ((got > 0.5) == y).mean() > 0.95


def test_first_split_is_the_best():
    rng = np.random.default_rng(2)
    for _ in range(5):
        x, y = rng.integers(0, 9, (120, 4)).astype(float), rng.integers(0, 2, 120).astype(float)
        model = quality.Boosted(x, y, trees=1, depth=1)
        p = np.full(120, y.mean())
        g, h = p - y, p * (1 - p)
        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + quality.LAMBDA)
        gains = {}
        for f in range(4):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                if h[left].sum() >= quality.LEAST_WEIGHT and h[~left].sum() >= quality.LEAST_WEIGHT:
                    gains[f, cut] = score(left) + score(~left) - score(left | True)
        f, above = model.split[0, 0], model.above[0, 0]
        left = x[:, f] <= above
        assert abs(score(left) + score(~left) - score(left | True) - max(gains.values())) < 1e-9
        want = [-quality.RATE * g[m].sum() / (h[m].sum() + quality.LAMBDA) for m in (left, ~left)]
        assert np.allclose(model.leaf[0], want)


def test_bound_holds_for_rows(spark, monkeypatch):
    seen = []
    boosted = quality.Boosted
    monkeypatch.setattr(quality, "Boosted", lambda x, y: seen.append(len(x)) or boosted(x, y))
    docs = spark.createDataFrame([(i % 3, f"text {i} " * (1 + i % 5)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    quality.fitted(docs, labels, F.lit(True), sample=50)
    assert seen == [50]


def test_null_and_empty_texts_have_a_score(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "Some words here.", "x")] * 2, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 0), (4, 1)], "doc_id long, quality int")
    out = quality.quality(docs, quality.fitted(docs, labels, F.lit(True)))
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "score", "predicted"] and len(rows) == 8 and all(0 <= r.score <= 1 for r in rows) and len({(r.doc_id, r.score) for r in rows}) == 4
