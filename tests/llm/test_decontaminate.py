"""Exact and proximity matches of benchmark items against loops over all places."""

import math
import random
import re

import pytest

from lodestone.llm import common, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def looped(texts, items, size=10, share=0.5, slack=10, least=3):
    """For each text: hit positions, exact items, near items."""
    out = []
    for t in texts:
        x = WORD.findall((t or "").lower())
        hit, exact, near = set(), set(), set()
        pairs = list(zip(x, x[1:] + [None]))
        for name, b in items:
            y = WORD.findall((b or "").lower())
            if not y:
                continue
            for s in range(max(len(y) - size, 0) + 1):
                w = y[s : s + size]
                for p in range(len(x) - len(w) + 1):
                    if x[p : p + len(w)] == w:
                        hit |= set(range(p, p + len(w)))
                        exact.add(name)
            terms = list(zip(y, y[1:])) or [(y[0], None)]
            need = max(min(len(set(terms)), least), min(math.ceil(len(set(terms)) * share), size - 1))
            close = {}
            for p, (a, b2) in enumerate(terms):
                for q, (c, d) in enumerate(pairs):
                    if a == c and (b2 is None or b2 == d):
                        for k in (0, 1):
                            close.setdefault((q - p) // slack - k, set()).add((a, b2))
            if any(len(v) >= need for v in close.values()):
                near.add(name)
        out.append((sorted(hit), sorted(exact), sorted(near | exact)))
    return out


@pytest.mark.parametrize("small", [True, False])
def test_against_loops(spark, monkeypatch, small):
    if not small:  # as with a large benchmark and common terms: no broadcast, salted lists
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(common, "HOT_ROWS", 2)
    rnd = random.Random(17)
    prose = lambda n, k: " ".join(rnd.choice("abcdefgh"[:k]) + rnd.choice("xyz"[: max(1, k - 1)]) for _ in range(n))
    items = [(str(i), prose(rnd.randint(1, 30), 3 + i % 5)) for i in range(14)] + [("20", "ax"), ("21", ""), ("22", None)] + [(str(30 + i), "ax " * (12 + i)) for i in range(6)]
    texts = [prose(rnd.randint(0, 120), 2 + i % 6) for i in range(25)] + ["ax " * 300, None, "", "ax"]
    for name, b in items[:8]:  # planted whole, cut, and with a word changed
        w = b.split()
        texts += [prose(9, 8) + " " + b + " " + prose(9, 8), " ".join(w[3:17]), " ".join("zz" if k % 7 == 3 else v for k, v in enumerate(w))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(int(a), b) for a, b in items], "item_id long, text string")
    got = {r.doc_id: (list(r.hits), list(r["items"]), list(r.near_items)) for r in decontaminate.decontaminated(docs, bench).collect()}
    want = looped(texts, items)
    assert [got[i] for i in range(len(texts))] == want
    assert any(near != exact for _, exact, near in want) and any(exact for _, exact, _ in want)
    kept = decontaminate.without_benchmark(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, w in enumerate(want) if not w[0]}


def test_one_repeated_word(spark):
    docs = spark.createDataFrame([(1, "a " * 900), (2, "b")], "doc_id long, text string")
    bench = spark.createDataFrame([(i, "a " * i) for i in range(12, 24)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminated(docs, bench).collect()}
    assert list(got[1].hits) == list(range(900)) and len(got[1]["items"]) == len(got[1].near_items) == 12 and got[2].hits == []


def test_rows_of_a_shuffle(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * 12) for i in range(40)], "doc_id long, text string").repartition(7).distinct()
    bench = spark.createDataFrame([(i, f"w{i} " * 12) for i in range(0, 40, 3)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.decontaminated(docs, bench, near=False).where("size(hits) > 0").collect()} == set(range(0, 40, 3))
