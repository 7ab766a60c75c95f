"""Training order of all copies, and rows of equal id and size."""

import pytest

from lodestone.llm import mixing


def test_order_of_copies(spark):
    docs = spark.createDataFrame([(i % 5, "w " * (i % 7), "a" if i % 3 else None) for i in range(90)] + [(3, "x y z", "b")] * 200, "doc_id long, text string, source string")
    mix = mixing.mixed(docs).cache()
    order = mixing.in_order(mix).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    words = {}
    for r in order:
        words.setdefault(r._row, []).append((r.copy, r.words))
    for r in mix.collect():
        mine = sorted(words.get(r._row, []))
        assert [c for c, _ in mine] == list(range(len(r.positions))) and sum(n for _, n in mine) == r.taken
        assert all(n == r.size for _, n in mine[:-1]) and all(0 < n <= r.size for _, n in mine)
    total = {s: (t, taken) for s, t, taken in mix.groupBy("source_size").agg({"target": "max", "taken": "sum"}).select("source_size", "max(target)", "sum(taken)").collect()}
    assert all(taken == pytest.approx(t, abs=1) for t, taken in total.values())
