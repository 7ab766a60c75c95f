"""Deleted spans against a loop over all runs."""

import random
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql.types import LongType

from lodestone.llm import common, substring_dedup


def looped(rows, min_bytes):
    """For rows (id, text) in order of copies: spans and ids of first copies."""
    first, out = {}, []
    for r, (i, t) in enumerate(rows):
        data = (t or "").encode()
        for x in substring_dedup.runs_of(substring_dedup.chunk_ends(data), min_bytes):
            a, n = x >> 32, x & 0xFFFFFFFF
            first.setdefault(data[a : a + n], (r, a, i))
    for r, (i, t) in enumerate(rows):
        data, spans, of = (t or "").encode(), [], set()
        for x in substring_dedup.runs_of(substring_dedup.chunk_ends(data), min_bytes):
            a, n = x >> 32, x & 0xFFFFFFFF
            s, b, owner = first[data[a : a + n]]
            if (s, b) != (r, a):
                of.add(owner)
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], a + n)
                else:
                    spans.append([a, a + n])
        out.append((i, [substring_dedup.trimmed(data, *s) for s in spans], sorted(of)))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_against_loops(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(common, "HOT_ROWS", 3)
    rnd = random.Random(8)
    prose = lambda n: " ".join("".join(rnd.choice(["th", "an", "er", "ß", "on", "语"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))
    passages = [prose(n) for n in (30, 60, 120, 200)]
    rows = []
    for i in range(60):
        parts = [prose(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            parts += [p if rnd.random() < 0.7 else p[a:], prose(rnd.randint(0, 20))]
        rows.append((i, " ".join(parts)))
    rows += [(60, None), (61, ""), (62, rows[3][1]), (63, "a" * 3000), (64, "b" + "a" * 3000), (65, passages[3] * 2)]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, [(s.start, s.end) for s in r.spans], list(r.dup_of)) for r in got) == looped(rows, substring_dedup.MIN_BYTES)
    for r in got:
        data, kept, last = (rows[r.doc_id][1] or "").encode(), b"", 0
        for s in r.spans:
            kept, last = kept + data[last : s.start], s.end
        assert (r.text or "") == (kept + data[last:]).decode() and r.dup_bytes == len(data) - len((r.text or "").encode())


def test_memory_of_a_batch():
    """A worker holds the runs of a part of a batch, not those of all its texts: 4,000 texts of 2,500 bytes have some 500,000 runs."""
    rnd = random.Random(9)
    texts = [rnd.randbytes(1250).hex() for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(range(4000)), pa.array(texts)], names=["_row", "_id", "text"])
    rows = SimpleNamespace(schema={"_id": SimpleNamespace(dataType=LongType())}, mapInArrow=lambda run, shape: run)
    run = substring_dedup._runs(rows, substring_dedup.MIN_BYTES)
    tracemalloc.start()
    found = sum(out.num_rows for out in run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    assert found == sum(len(substring_dedup.runs_of(substring_dedup.chunk_ends(t.encode()), substring_dedup.MIN_BYTES)) for t in texts)


def test_runs_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 7)
    monkeypatch.setattr(substring_dedup, "ROWS", 2)
    rnd = random.Random(10)
    texts = [None, "", *(rnd.randbytes(n).hex() for n in (300, 10, 700, 900))]
    rows = list(enumerate([*texts, texts[4][100:], texts[5] + texts[2], "ß" * 400]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.substring_dedup(docs).collect()
    assert sorted((r.doc_id, [(s.start, s.end) for s in r.spans], list(r.dup_of)) for r in got) == looped(rows, substring_dedup.MIN_BYTES)
