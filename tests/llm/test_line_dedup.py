"""Maximal repeated runs of lines against loops."""

import random
import re

import pytest

from lodestone.llm import line_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def looped(rows, m, long_lines):
    """For rows (id, text) in order of copies: (lines, removed, runs, text)."""
    blank = lambda x: not x.strip(" \t\n\x0b\f\r")
    docs = [(t or "").split("\n") for _, t in rows]
    full = [[k for k, x in enumerate(a) if not blank(x)] for a in docs]
    x = [[a[k] for k in f] for a, f in zip(docs, full)]
    first, depths, d = {}, [], m
    while any(len(y) >= d for y in x):
        depths.append(d)
        d *= 2
    for r, y in enumerate(x):
        for i in range(len(y)):
            for d in [1, *depths]:
                if i + d <= len(y):
                    first.setdefault((d, tuple(y[i : i + d])), (r, i))
    out = []
    for r, (a, f, y) in enumerate(zip(docs, full, x)):
        runs = []
        for i in range(len(y)):
            own = [d for d in depths if i + d <= len(y) and first[d, tuple(y[i : i + d])] != (r, i)]
            if own:
                s, j = first[own[-1], tuple(y[i : i + own[-1]])]
                n = 0
                while i + n < len(y) and j + n < len(x[s]) and y[i + n] == x[s][j + n]:
                    n += 1
                runs.append((i, n, False))
            long = len(y[i].encode()) > 500 or len(WORD.findall(y[i].lower())) > 50
            if long_lines and long and first[1, (y[i],)] != (r, i):
                runs.append((i, 1, True))
        runs.sort(key=lambda z: (z[0], -z[1], z[2]))
        kept, reach = [], 0
        for i, n, alone in runs:
            if i + n > reach:
                kept.append((i, n, alone))
                reach = i + n
        gone = {f[k] for i, n, _ in kept for k in range(i, i + n)}
        count = len(kept) - sum(a[2] and b[2] and a[0] + 1 == b[0] for a, b in zip(kept, kept[1:]))
        text = rows[r][1] if not gone else "\n".join(z for k, z in enumerate(a) if k not in gone)
        out.append((len(f), len(gone), count, text))
    return out


@pytest.mark.parametrize("m,long_lines,hot", [(2, True, False), (2, False, True), (1, False, False), (3, True, False), (5, False, False)])
def test_against_loops(spark, monkeypatch, m, long_lines, hot):
    if hot:
        monkeypatch.setattr(line_dedup, "HOT_ROWS", 3)
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    rnd = random.Random(5 + m)
    rows = []
    for i in range(40):
        lines = [rnd.choice("ABCDEFGHIJ") for _ in range(rnd.randint(0, 12))]
        rows.append("\n".join(x for y in lines for x in ([y, rnd.choice(["", "\t", " \x0b"])] if rnd.random() < 0.2 else [y])))
    block = [f"line {k}" for k in range(23)]
    long = "word " * 60
    rows += ["\n".join(block), "x\n" + "\n".join(block[3:20]) + "\ny", "\n".join(block[:11] + ["new"] + block[11:]), "\n".join(block + block), None, "", "\t\n ", long, long + "\nend", "u\n" + long + "\nv", "é" * 400, "q\n" + "é" * 400]
    rows += ["A1\nB1", "B1\nC1", "A1\nB1\nC1", "\n".join(["same"] * 40), "\n".join(["same"] * 17)]
    docs = spark.createDataFrame([(i if i != 7 else None, t, len(t or "")) for i, t in enumerate(rows)] + [(3, rows[3], 0)], "doc_id long, text string, n_lines long")
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_lines == 0))
    got = line_dedup.line_dedup(docs, m, long_lines)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed", "n_runs"]
    want = [(r.doc_id, *w) for r, w in zip(order, looped([(r.doc_id, r.text) for r in order], m, long_lines))]
    assert sorted(map(repr, ((r.doc_id, r.n_lines, r.n_removed, r.n_runs, r.text) for r in got.collect()))) == sorted(map(repr, want))
    if m == 2:
        chain = next(w for w in want if w[0] == 40 + 12 + 2)
        assert chain[2:4] == (3, 2)  # A B and B C stand earlier, in different documents: two runs that overlap
