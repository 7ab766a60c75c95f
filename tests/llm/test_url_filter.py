"""Segmentation against all splits, odds against a plain naive Bayes, and the classifier's accuracy on urls it did not see."""

import math
import os
import random
import re
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from lodestone.llm import common, url_filter

RUN = re.compile(r"[^\W\d_]+|\d+")


def best_split(run, counts, total):
    cost = lambda w: math.log((total + 1) / counts[w]) if w in counts else math.log(total + 1) + 3.0 * len(w)
    splits = []
    for cuts in product([0, 1], repeat=max(0, len(run) - 1)):
        words, last = [], 0
        for k, c in enumerate([*cuts, 1], 1):
            if c:
                words.append(run[last:k])
                last = k
        splits.append((sum(map(cost, words)), words))
    return min(splits)


def test_viterbi_against_all_splits():
    rnd = random.Random(3)
    for _ in range(60):
        counts = {"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 4))): rnd.randint(1, 50) for _ in range(8)}
        run, total = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))), sum(counts.values())
        got = url_filter.Segmenter(counts).split(run)
        want, _ = best_split(run, counts, total)
        cost = sum(math.log((total + 1) / counts[w]) if w in counts else math.log(total + 1) + 3.0 * len(w) for w in got)
        assert "".join(got) == run and abs(cost - want) < 1e-9


@pytest.mark.parametrize("small", [True, False])
def test_odds_against_plain_bayes(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(common, "HOT_ROWS", 3)
        monkeypatch.setattr(url_filter, "small_enough", lambda df: False)
    rnd = random.Random(9)
    words = ["spam", "farm", "news", "blog", "cheap", "pills", "wiki"]
    urls = []
    for i in range(150):
        host = rnd.choice(["", "www.", "m."]) + rnd.choice(words) + rnd.choice(["", rnd.choice(words)]) + rnd.choice([".net", ".org", ".com", ".example.net", ".example.com"])
        urls.append(f"http://{host}/{rnd.choice(['en', 'de', 'fr', 'x1'])}/{rnd.choice(words)}{rnd.choice(words)}-{rnd.randrange(3000)}?q")
    urls += [None, "no url", "ftp:///", "http://é.com/ß"]
    html = [" ".join(rnd.choice(words) for _ in range(20)) + "<b>bold</b>" for _ in urls]
    df = spark.createDataFrame([(i, u, t, "c") for i, (u, t) in enumerate(zip(urls, html))], "page_id long, url string, html string, odds string")
    got = {r.page_id: r for r in url_filter.url_filter(df).collect()}
    counts = Counter(w for t in html for w in re.findall(r"[^\W\d_]+", re.sub("<[^>]*>", " ", t).lower()) if 2 <= len(w) <= 24)
    names = {"net", "example", "en", "com", "de", "org", "fr"}
    segmenter, tokens = url_filter.Segmenter(dict(counts)), {}
    for i, r in got.items():
        tokens[i] = []
        for mark, part in (("h:", r.host), ("p:", r.path.lower())):
            for run in RUN.findall(part):
                if run not in names:
                    tokens[i] += [mark + "#" + str(min(len(run), 6))] if run[0].isdigit() else [mark + w for w in segmenter.split(run)]
    label = {i: got[i].verdict for i in got if got[i].rule}
    block, allow = (Counter(t for i, v in label.items() if v == x for t in tokens[i]) for x in ("block", "allow"))
    v = len({*block, *allow}) + 1
    prior = math.log((sum(x == "block" for x in label.values()) + 1) / (sum(x == "allow" for x in label.values()) + 1))
    for i, r in got.items():
        want = prior + sum(math.log((block[t] + 1) / (block.total() + v)) - math.log((allow[t] + 1) / (allow.total() + v)) for t in tokens[i] if t in block or t in allow)
        assert r.odds == pytest.approx(want, abs=1e-9) and list(r.words) == [t[2:] for t in tokens[i]]
        assert r.verdict == label.get(i, "block" if r.odds > 0 else "allow")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_held_out_urls(spark):
    """Trained on two thirds of the hosts and paths that rules decide; on the others it is better than always the commoner verdict."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    seen = F.crc32(F.concat("host", "path")) % 3 != 1
    out = url_filter.url_filter(pages, decides=seen).where("rule IS NOT NULL").where(~seen)
    n, right, blocks = out.agg(F.count("*"), F.count_if((F.col("odds") > 0) == (F.col("verdict") == "block")), F.count_if(F.col("verdict") == "block")).first()
    print("held-out urls", n, "right", right, "blocks", blocks)
    assert n > 0 and right >= 0.5 * n
