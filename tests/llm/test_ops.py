"""The ten operators against plain loops, and on odd rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import ann_search, decontaminate, license_scan, line_dedup, mixing, ngram_jaccard, quality, substring_dedup, token_counts, url_filter
from lodestone.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, _src string, n_removed string, score string, w int, hits int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def prose(rnd, n):
    return " ".join("".join(rnd.choice(["th", "an", "er", "on", "re", "ß", "it"]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def texts():
    rnd = random.Random(11)
    base = [prose(rnd, n) for n in (3, 8, 40, 120, 300, 5000)]
    near = base[3].split()
    near[5] = "changed"
    lines = ["\n".join(prose(rnd, 9) for _ in range(5)) for _ in range(3)]
    out = base + [base[3], base[3], " ".join(near), None, None, "", "  \n \n", "!!!", "Über", lines[0], lines[1] + "\n\n" + lines[0], lines[0] + "\n" + lines[2], base[4] + " " + base[2]]
    out += ["x under the MIT license. CC BY-NC, Apache License, Version 2.0 " + base[0], "MIT mit under the mit licenses", "SPDX-License-Identifier: GPL-3.0"]
    return out


def table(spark, rows=None):
    t = texts() if rows is None else rows
    data = [(i if i != 4 else None, x, "en", [None, "a", "b", "c"][i % 4], len(x or ""), 7, "s", "r", "q", 1, 2) for i, x in enumerate(t)]
    return spark.createDataFrame(data + data[2:4] if data else [], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_token_counts(spark, docs, none):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    lib, path = Tokenizer.from_file(P.path("word_bpe_49k.json")), P.path("word_bpe_49k.json")
    got = token_counts.token_counts(docs, path).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
    assert [tuple(r)[:3] for r in got] == want
    assert token_counts.token_counts(none, path).count() == 0
    m, rnd = token_counts.transducer(path), random.Random(3)
    parts = ["a", "the", "ing", " ", "\n", "'", "'s", "'re", "'r", "'ll", "don't", "12", "!", "É", "ß", "İ", "Σ", "ς", "日本", "🙂", "é", "\x1c", "\x85", "<|endoftext|>", "<|", "क्षि", "\x00"]
    for _ in range(500):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert m.count(s) == len(lib.encode(s, add_special_tokens=False).ids), s
    long = prose(rnd, 30_000) + "x" * 70_000  # several chunks, one without white space
    assert m.count(long) == len(lib.encode(long, add_special_tokens=False).ids)


def test_ann_search(spark):
    rnd = np.random.default_rng(5)
    v = [(i, list(map(float, rnd.normal(size=16)))) for i in range(400)]
    v += [(500 + i, v[0][1]) for i in range(60)] + [v[0], (1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [None] + [1.0] * 15), (1080, [1.0]), (None, v[1][1])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = {}
    for r in ann_search.ann_search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = dict(v[:400]) | {500 + i: v[0][1] for i in range(60)}
    assert set(got) == {i for i in good if i % 20 == 0}
    found = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and all(abs(np.dot(good[q], good[i]) - s) < 1e-9 for _, i, s in rows)
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        want = sorted((-np.dot(good[q], x), i) for i, x in good.items() if i != q)[:20]
        found += len({i for _, i in want} & {i for _, i, _ in rows})
    assert found >= 0.9 * 20 * len(got)
    assert [r[1] for r in got[0]][:20] == [500 + i for i in range(20)] or 0 in got  # ties to smaller ids
    assert ann_search.ann_search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_ngram_jaccard(spark, docs, none):
    rows = docs.collect()
    sets = [set(ngram_jaccard.shingles(r.text).tolist()) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        k = root(i)
        least[k] = min([x for x in (least.get(k), r.doc_id) if x is not None], default=None)
    got = ngram_jaccard.near_duplicates(docs).orderBy("_row").collect()
    assert [(r.doc_id, r.class_id, r.n_links) for r in got] == [(r.doc_id, least[root(i)], links[i]) for i, r in enumerate(rows)]
    kept = ngram_jaccard.without_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len({root(i) for i in range(len(rows))})
    assert ngram_jaccard.near_duplicates(none).count() == 0
    need = ngram_jaccard.needed()
    assert need == sorted(need) and need[-1] < 0.8 * 96


def test_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(ngram_jaccard, "GROUP_BLOCK", 8)
    rnd = random.Random(8)
    base = prose(rnd, 200).split()
    rows = []
    for i in range(60):
        w = list(base)
        w[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 59)}


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(90)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 50)]
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            parent[root(a)] = root(b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set(parent) and len({(root(n), r) for n, r in got.items()}) == len({root(n) for n in got}) == len(set(got.values()))


def test_decontaminate(spark, docs, none):
    t = texts()
    w = t[4].split()
    items = [(1, " ".join(w[10:40])), (2, " ".join(w[100:105])), (3, "Über"), (4, None), (5, "!!"), (6, "not there at all but ten words long it is really so"), (None, " ".join(w[20:31])), (10, " ".join(w[10:40]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminated(docs, bench).collect()
    for r, g in zip(docs.collect(), got):
        x, hit, its = words(r.text), set(), set()
        for i, b in items:
            y = words(b)
            for s in range(max(len(y) - 9, 1) if y else 0):
                win = y[s : s + 10]
                for p in range(len(x) - len(win) + 1):
                    if x[p : p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        its.add("" if i is None else str(i))
        match = [q for q in got if q.doc_id == r.doc_id and q.n_words == len(x)]
        assert any(set(q.hits) == hit and q["items"] == sorted(its) for q in match), r.doc_id
    assert len(got) == docs.count() and decontaminate.decontaminated(none, bench).count() == 0
    assert decontaminate.decontaminated(docs, bench.limit(0)).where("size(hits) > 0").count() == 0


def test_line_dedup(spark, docs, none):
    for n in (1, 2, 3):
        rows = sorted(enumerate(docs.collect()), key=lambda x: (x[1].doc_id is None, x[1].doc_id or 0, x[0]))
        seen, want = set(), {}
        for k, r in rows:
            all_ = (r.text or "").split("\n")
            full = [i for i, x in enumerate(all_) if x.strip(" ")]
            gone = set()
            for s in range(len(full) - n + 1):
                run = tuple(all_[i] for i in full[s : s + n])
                if run in seen:
                    gone |= set(full[s : s + n])
                seen.add(run)
            want[k] = (r.doc_id, len(full), len(gone), r.text if not gone else "\n".join(x for i, x in enumerate(all_) if i not in gone))
        out = line_dedup.line_dedup(docs, n)
        assert sorted(map(repr, ((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()))) == sorted(map(repr, want.values()))
    assert out.columns.count("n_removed") == 1 and out.where("_src <> 's' OR _row <> 7").count() == 0
    assert line_dedup.line_dedup(none).count() == 0


def test_quality(spark, docs, none):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, 60).capitalize() + "." if i % 3 else "AB!! CD!! " * 30, int(i % 3 > 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    model = quality.fitted(df.drop("quality"), labels, ~quality.held_out())
    out = quality.quality(df, model).withColumn("h", quality.held_out())
    assert out.where("h AND predicted = quality").count() >= 0.98 * out.where("h").count() > 0
    odd = quality.quality(docs, model)
    assert odd.count() == docs.count() and odd.where("score BETWEEN 0 AND 1").count() == docs.count() and odd.columns.count("score") == 1
    assert quality.quality(none, quality.fitted(none, labels.limit(0), F.lit(True))).count() == 0


def test_url_filter(spark):
    urls = ["http://a.net/x", "http://www.EXAMPLE.net/en/1", "http://example.net/en", "https://b.example.com/de/?q", "http://x.org/fr/", "http://x.org/de/#a", "http://net", None, "no url", "ftp://notnet/", "http://cheap-pills.example.com/en/1"]
    df = spark.createDataFrame([(i, u, f"<p>cheap pills words {i}</p>", "c") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    got = {r.page_id: r for r in url_filter.url_filter(df.union(df.limit(1))).collect()}
    assert [got[i].rule for i in range(11)] == ["net/", "example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None, None, None, None]
    assert [got[i].verdict for i in range(5)] == ["block", "allow", "block", "block", "allow"] and {r.verdict for r in got.values()} <= {"allow", "block"}
    assert (got[1].host, got[1].path, got[3].path, got[7].host, got[8].path) == ("www.example.net", "/en/1", "/de/", "", "")
    assert url_filter.url_filter(df.limit(0)).count() == 0
    s = url_filter.Segmenter({"spam": 9, "farm": 9, "cheap": 5, "a": 3})
    assert s.split("spamfarmcheap") == ["spam", "farm", "cheap"] and s.split("") == []


def test_substring_dedup(spark, docs, none):
    rnd = random.Random(6)
    passage = prose(rnd, 90)
    rows = [(i, prose(rnd, 200) + (" " + passage + " " + prose(rnd, 30) if i in (3, 7, 9) else "")) for i in range(12)]
    out = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in out.items() if r.is_dup} == {7, 9} and out[9].dup_of == [3]
    for i, t in rows:  # what is kept and the spans make up the text
        data, kept, last = t.encode(), b"", 0
        for s in out[i].spans:
            kept, last = kept + data[last : s.start], s.end
        assert (kept + data[last:]).decode() == out[i].text
    odd = substring_dedup.substring_dedup(docs)
    assert odd.count() == docs.count() and odd.where("doc_id = 9 AND text IS NULL AND n_bytes = 0").count() == 1
    assert substring_dedup.substring_dedup(none).count() == 0
    data = prose(rnd, 500).encode()
    a, b = substring_dedup.chunk_ends(data), substring_dedup.chunk_ends(b"inserted " + data)
    assert a[-1] == len(data) and len({x + 9 for x in a} & set(b)) > 0.9 * len(a)  # an insertion moves few ends


def test_mix(spark, docs, none):
    out = mixing.mixed(docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r, d in zip(sorted(out, key=lambda r: r._row), docs.collect()):
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) and 0 <= r.taken <= 3 * r.size
        assert all(0 <= p <= 1 for p in r.positions)
        by.setdefault(d.source, []).append(r)
    for rows in by.values():
        assert sum(r.size for r in rows) == rows[0].source_size and abs(sum(r.taken for r in rows) - rows[0].target) <= 1
    total = sum(r.size for r in out)
    assert abs(sum(rows[0].target for rows in by.values()) - total) < 1e-6 * total
    assert mixing.mixed(none).count() == 0
    blank = docs.withColumn("text", F.lit(" "))
    assert mixing.by_position(mixing.mixed(blank)).where("taken <> 0 OR target <> 0").count() == 0


def test_license_scan(spark, docs, none):
    phrases = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
    out = license_scan.license_scan(docs)
    got = sorted(map(repr, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out.collect())))
    want = []
    for r in docs.collect():
        w = words(r.text)
        hits = [(k, label) for label, p in phrases for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want.append((r.doc_id, len(w), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({x for _, x in hits}))))
    assert got == sorted(map(repr, want))
    assert out.where("labels LIKE '%gpl-3%'").count() == 1 and out.columns.count("score") == 1
    assert out.where("score < 0 OR score > 1").count() == 0 and license_scan.license_scan(none).count() == 0
    assert len(license_scan.rules()) > 250
    one = license_scan.license_scan(spark.createDataFrame([("licensed under cc by nc sa 4.0",)], "text string")).first()
    assert one.labels == "cc-by-nc,cc-by-nc-sa"  # the base label stays though its detection is contained


def test_sha_of_items(spark, docs):
    assert hashlib.sha256(b"").hexdigest() == docs.select(F.sha2(F.array_join(F.array().cast("array<string>"), ","), 256)).first()[0]


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "ngram_jaccard", "decontaminate", "mix"]
    spark.createDataFrame([(i, int(i != 13), 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, texts()[2])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for rows in (docs, docs.limit(0)):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            before, now = now.count(), stage(spark, now, str(tmp_path))
            if name != "mix":
                assert now.columns == docs.columns and now.count() <= before
            now = now.cache()
        assert now.count() == before
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where("doc_id = 2").count() == 0 and out.where("doc_id = 3").count() == 1


def test_long_lines(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(21)
    passage, short, wide = prose(rnd, 60), prose(rnd, 40), "語" * 200
    around = lambda x: "\n".join([prose(rnd, 8), x, prose(rnd, 8)])
    rows = [(0, passage), (1, passage), (2, around(passage)), (3, around(short)), (4, around(short)), (5, around(wide)), (6, around(wide)), (7, passage + "\n" + passage)]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.n_removed, r.n_runs, r.text) for r in line_dedup.line_dedup(df, long_lines=True).collect()}
    without = lambda t: "\n".join(t.split("\n")[::2])
    assert got == {0: (0, 0, passage), 1: (1, 1, ""), 2: (1, 1, without(rows[2][1])), 3: (0, 0, rows[3][1]), 4: (0, 0, rows[4][1]), 5: (0, 0, rows[5][1]), 6: (1, 1, without(rows[6][1])), 7: (2, 1, "")}
    assert line_dedup.line_dedup(df).where("n_removed > 0").count() == 0
    kept = corpus_pipeline.line_stage(spark, df, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} == {0, 2, 3, 4, 5, 6} and all(r.n_chars == len(r.text) for r in kept)


def test_near_items(spark):
    rnd = random.Random(31)
    item, other = [f"w{i}" for i in range(30)], [f"v{i}" for i in range(5)]
    changed = [f"x{i}" if i % 6 == 3 else x for i, x in enumerate(item)]  # no window of ten words is left
    inserted = [y for i, x in enumerate(item) for y in ([x, "new"] if i % 7 == 4 else [x])]
    part = item[4:23]
    part[9] = "y"
    pairs = [y for i in range(0, 28, 2) for y in [*item[i : i + 2], *prose(rnd, 40).split()]]  # half of the pairs, but far from each other
    rows = [item, changed, inserted, part, pairs, ["w8", "w9"], item[::-1], other, ["v0", "v1", "v2", "z", "v4"], []]
    docs = spark.createDataFrame([(i, " ".join(prose(rnd, 9).split() + x + prose(rnd, 9).split())) for i, x in enumerate(rows)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other)), (3, None), (None, "v3 v4")], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in decontaminate.decontaminated(docs, bench).collect()}
    assert got == {0: (["1"], ["1"]), 1: ([], ["1"]), 2: ([], ["1"]), 3: ([], ["1"]), 4: ([], []), 5: ([], []), 6: ([], []), 7: (["", "2"], ["", "2"]), 8: ([], []), 9: ([], [])}


NOTICES = {
    "under the terms of the GNU General Public License as published by the Free Software Foundation": "gpl", "GNU General Public License, version 3": "gpl-3", "GNU General Public License v2.0 or later": "gpl-2",
    "GNU General Public License v3": "gpl-3", "the GNU Lesser General Public License": "lgpl", "GNU Library General Public License": "lgpl", "GNU Lesser General Public License version 2.1": "lgpl-2.1", "GNU Lesser General Public License v3.0": "lgpl-3",
    "GNU Affero General Public License v3": "agpl-3", "under the GNU Affero General Public License": "agpl-3", "Eclipse Public License 2.0": "epl-2", "Eclipse Public License - v 1.0": "epl-1", "Eclipse Public License": "epl",
    "under the GNU Free Documentation License": "fdl", "Mozilla Public License 2.0": "mpl-2", "the terms of the Mozilla Public License, v. 2.0.": "mpl-2", "Mozilla Public License 1.1": "mpl-1.1", "Mozilla Public License": "mpl",
    "Apache License 2.0": "apache-2", "Apache Software License 1.1": "apache-1.1", "Apache License": "apache", "Artistic License 2.0": "artistic-2", "Elastic License 2.0": "elastic-2", "Boost Software License - Version 1.0": "bsl-1", "The Unlicense": "unlicense",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by", "Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License": "cc-by-nc-sa", "Creative Commons Attribution-NoDerivs License": "cc-by-nd",
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International Public License": "cc-by-nc-nd", "under the terms of the Common Development and Distribution License": "cddl", "European Union Public Licence v. 1.2": "eupl", "Open Software License 3.0": "osl-3",
    "Academic Free License v3.0": "afl-3", "Universal Permissive License": "upl", "Server Side Public License": "sspl", "Business Source License 1.1": "busl", "Open Data Commons Open Database License": "odbl", "Public Domain Dedication and License": "pddl",
    "NCSA Open Source License": "ncsa", "MIT No Attribution License": "mit-0", "SIL Open Font License 1.1": "ofl", "Microsoft Public License": "ms-pl", "Python Software Foundation License": "python-2", "GNU GPL license": "gpl", "MIT license": "mit", "3-Clause BSD License": "bsd-3",
    "a general public of mozilla readers and gnu herds": "", "eclipse of the public license office": "",
}


def test_full_names(spark):
    rows = spark.createDataFrame([(k, f"and {k} so") for k in NOTICES], "doc_id string, text string")
    assert {r.doc_id: r.labels for r in license_scan.license_scan(rows).collect()} == NOTICES
    dead = [label for label, _, name, _ in license_scan.LICENSES if "public license" in license_scan.with_license(name) and license_scan.with_license(name).endswith("licen[cs]es?")]
    assert dead == []


def test_runs_stand_earlier_as_a_whole(spark):
    rnd = random.Random(4)
    for _ in range(500):
        data = prose(rnd, 400).replace("ß", "s").encode()
        ends = substring_dedup.chunk_ends(data)
        cut = [data[a:e] for a, e in zip([0, *ends], ends)]
        k = next((k for k in range(1, len(cut) - 8) if all(12 <= len(x) <= 44 for x in cut[k : k + 8])), None)
        parts = cut[k : k + 8] if k else []
        pairs = [a + b for a, b in zip(parts, parts[1:])]
        if k and all(substring_dedup.chunk_ends(p) == [len(a), len(p)] for a, p in zip(parts, pairs)):
            break
    run = b"".join(parts).decode()
    rows = [(i, p.decode()) for i, p in enumerate(pairs)] + [(50, run), (60, run), (70, prose(rnd, 50) + run + run[:60] + prose(rnd, 50))]
    out = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in out.items() if r.is_dup} == {60, 70}  # of 50 each chunk, but no run of 96 bytes stands earlier
    assert out[60].text == "" and out[60].dup_of == out[70].dup_of == [50] and 96 <= out[70].dup_bytes <= len(run)
    for _ in range(200):  # a repeated stretch of chunks is covered from its first to its last end
        ends = substring_dedup.chunk_ends(prose(rnd, rnd.randint(1, 60)).encode())
        places = [(x >> 32, (x >> 32) + (x & 0xFFFFFFFF)) for x in substring_dedup.runs_of(ends, 96)]
        assert all(e - a >= 96 for a, e in places) and [e for _, e in places] == sorted(e for _, e in places)
        assert ends[-1] < 96 or (places[0][0] == 0 and places[-1][1] == ends[-1] and all(b[0] <= a[1] for a, b in zip(places, places[1:])))
