"""Truth tables and closed forms against plain loops."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lodestone.functions import decks as D
from lodestone.functions import screens as S
from lodestone.functions import urls as U
from lodestone.operators import dedup, events, filtering, packaging, registry


def test_stream_gate_is_the_loop(spark):
    rnd = random.Random(4)
    for size, h0, m0 in ((1000, 0, 0), (10, 0, 0), (40, 3, 1)):
        q = ["HIGH" if rnd.random() < 0.6 else "MEDIUM" for _ in range(80)]
        want, h, m = [], h0, m0
        for x in q:
            if x == "HIGH":
                h += 1
                want.append(True)
            else:
                ok = h > 0 and m < min(int(size * 0.3), int(h * 0.3 / 0.7))
                m += ok
                want.append(ok)
        df = spark.createDataFrame(list(enumerate(q)), "id long, quality string")
        assert [r.kept for r in packaging.stream_gate(df, size, h0=h0, m0=m0).orderBy("id").collect()] == want


def test_batch_selection(spark):
    for highs, mediums, size, want in ((10, 10, 20, (10, 4, 6)), (3, 20, 25, (3, 1, 19))):
        df = spark.createDataFrame([(i, "HIGH" if i < highs else "MEDIUM") for i in range(highs + mediums)], "id long, quality string")
        n = {r.role: r["count"] for r in packaging.batch_selection(df, size).groupBy("role").count().collect()}
        assert (n.get("high", 0), n.get("medium", 0), n.get("surplus", 0)) == want


def test_mixed_caps_is_the_loop(spark):
    rnd = random.Random(9)
    rows = [(i, f"d{rnd.randrange(4)}", rnd.choice([2, 5])) for i in range(120)]
    kept, want = {}, {}
    for i, d, c in rows:
        want[i] = kept.get(d, 0) < c
        kept[d] = kept.get(d, 0) + want[i]
    got = filtering.mixed_caps(spark.createDataFrame(rows, "id long, domain string, cap int"), [2, 5]).collect()
    assert {r.id: r.kept for r in got} == want


def test_head_verdicts(spark):
    rows = [(403, None, None, "ok"), (429, None, None, "retry"), (500, "text/html", 5, "retry"), (200, "text/html; x", 50, "skip_html"), (200, None, 5, "skip_size"), (200, None, 500, "skip_size"), (200, None, None, "ok"), (200, "application/zip", 50, "ok")]
    df = spark.createDataFrame(rows, "s int, c string, n long, want string")
    assert df.where(events.head_verdict(F.col("s"), F.col("c"), F.col("n"), 100, 10) != F.col("want")).count() == 0


def test_hamming_pairs_find_all(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(63) for _ in range(30)]
    hashes = [(i, b) for i, b in enumerate(base)] + [(100 + i, b ^ sum(1 << k for k in rnd.sample(range(63), i % 12))) for i, b in enumerate(base)]
    want = {(a, b, (x ^ y).bit_count()) for a, x in hashes for b, y in hashes if a < b and (x ^ y).bit_count() <= 8}
    got = dedup.hamming_pairs(spark.createDataFrame([(i, h) for i, h in hashes] + [(999, None)], "id long, h long"), 8).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_hashes_meet_without_a_join(spark):
    """At 18 bits nearly all hashes share a band: joins by bands made more rows than there are pairs."""
    rnd = random.Random(4)
    base = [rnd.getrandbits(63) for _ in range(20)]
    rows = [(i, i % 3, rnd.choice(base) ^ sum(1 << k for k in rnd.sample(range(64), rnd.randrange(12))) if i % 2 else rnd.getrandbits(64)) for i in range(700)]
    rows = [(i, f, h - (1 << 64) if h >> 63 else h) for i, f, h in rows] + [(700, 1, None)]
    bits = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    df = spark.createDataFrame(rows, "id long, file_id long, h long")
    pairs = dedup.hamming_pairs(df, 18)
    assert "Join" not in pairs._jdf.queryExecution().toString()
    want = {(a, b, bits(x, y)) for a, _, x in rows[:-1] for b, _, y in rows[:-1] if a < b and bits(x, y) <= 18}
    assert sorted(map(tuple, pairs.collect())) == sorted(want) == sorted(map(tuple, dedup.hamming_pairs(df, 18, most=90).collect()))
    first = {}
    for a, f, x in rows[:-1]:
        there = [b for b, g, y in rows[:a] if g != f and bits(x, y) <= 18]
        if there:
            first[a] = min(there)
    for most in (None, 90):
        assert {r.place: r.first for r in dedup.first_near(df.withColumnRenamed("id", "place"), 18, most).collect()} == first
    assert 0 < len(first) < 700


def test_breaker_and_latch(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, i, t + timedelta(hours=h), f) for i, (h, f) in enumerate([(0, True), (1, True), (2, True), (3, True), (60, True), (61, False), (62, True), (63, True), (64, True), (200, False)])]
    got = events.breaker(spark.createDataFrame(rows, "key long, event_id long, ts timestamp, failed boolean")).orderBy("event_id").collect()
    assert [r.state for r in got] == ["active", "active", "parked", "parked", "active", "active", "active", "active", "blacklisted", "blacklisted"]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1500, 1250, 1100, 1400])], "k int, t int, v int")
    assert [r.p for r in events.latch(df, "k", ["t"], F.col("v") >= 1500, F.col("v") <= 1200, "p").orderBy("t").collect()] == [True, True, False, False]


def test_deck_decisions(spark):
    names = "deck slide native_chart diagram table_ ole image_analytical image_photo image_count vector text_chars bullets filler".split()
    chart = (1, 0, 0, 0, 0, 0, 0, 0, 50, 0, False)
    text = (0, 0, 0, 0, 0, 0, 0, 0, 500, 2, False)
    photo = (0, 0, 0, 0, 0, 1, 1, 0, 20, 0, False)
    decks = {"a": [chart] * 5 + [text] * 3, "b": [photo] * 7, "c": [text] * 8, "d": [chart] * 5 + [text] * 5, "e": [chart] * 2}
    df = spark.createDataFrame([(k, i, *s) for k, ss in decks.items() for i, s in enumerate(ss)], "deck string, slide int, " + ", ".join(f"{c} int" for c in names[2:-1]) + ", filler boolean")
    got = {r.deck: (r.quality, r.decision) for r in D.deck_decision(D.deck_metrics(df, "deck")).collect()}
    assert got == {"a": ("HIGH", "DELIVER"), "b": ("LOW", "REJECT"), "c": ("LOW", "REJECT"), "d": ("HIGH", "REVIEW"), "e": ("LOW", "REJECT")}


def test_screens(spark):
    rights = "\n".join(f"copyright 20{i:02d} Acme Holdings" for i in range(5))
    rows = [("a@x.com b@x.com c@x.com d@x.com", "REVIEW", "PASS", "PASS"), ("amir@x.com info@x.com a@x.com b@x.com c@x.com", "PASS", "PASS", "PASS"), ("ssn 123-45-6789", "REVIEW", "PASS", "PASS"), (rights, "PASS", "PASS", "REVIEW"), ("snuff", "PASS", "REJECT", "PASS"), (None, "PASS", "PASS", "PASS")]
    t = F.col("t")
    got = spark.createDataFrame([(r[0],) for r in rows], "t string").select(S.pii(t), S.prohibited(t), S.rights(t)).collect()
    assert [tuple(r) for r in got] == [r[1:] for r in rows]


def test_urls_and_registry(spark):
    df = spark.createDataFrame([("HTTPS://WWW.Ex.org:80/a/B.PPTX?x=1",), ("ftp://x/y",), ("/path",), (None,)], "u string")
    got = df.select(U.domain(F.col("u")), U.malformed(F.col("u")), U.extension_ok(F.col("u"), (".pptx",))).collect()
    assert [tuple(r) for r in got] == [("www.ex.org:80", False, True), ("x", True, False), ("", True, False), ("", True, False)]
    old = spark.createDataFrame([("a", 1)], "url string, id int")
    new = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "url string, id int")
    assert [tuple(r) for r in registry.insert_or_ignore(old, new, "url", "id").collect()] == [("b", 3)]
    up = registry.merged_updates(spark.createDataFrame([(1, "x", "y"), (2, "x", "y")], "id int, p string, q string"), spark.createDataFrame([(2, "z")], "id int, p string"), "id")
    assert sorted(map(tuple, up.collect())) == [(1, "x", "y"), (2, "z", "y")]
    names = spark.createDataFrame([(1,), (99,), (100,)], "b int").select(packaging.batch_folder(F.col("b"))).collect()
    assert [r[0] for r in names] == ["BATCH_01", "BATCH_99", "BATCH_100"]
