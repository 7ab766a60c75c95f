"""Extraction against a loop, composed screens against re, walks of responses."""

import json
import random
import re

from pyspark.sql import functions as F

from lodestone.functions import screens as S
from lodestone.functions import urls as U
from lodestone.operators.extraction import extracted
from lodestone.sources import responses as R


def test_extraction_follows_a_loop(spark):
    rng = random.Random(3)
    hashes = [rng.getrandbits(63) for _ in range(6)]
    pages = []
    for f in range(20):
        for i in range(rng.randrange(5)):
            rendered = rng.random() < 0.9
            near = rng.choice(hashes) ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) if rng.random() < 0.4 else rng.getrandbits(63)
            pages.append((f, i, rng.random() < 0.8, f"s{rng.randrange(60)}" if rendered else None, near if rendered else None))
    inside = {(f, i) for f, i, *_ in pages if rng.random() < 0.2}
    want, seen = set(), []
    for f in range(20):
        mine = [p for p in pages if p[0] == f and p[2]]
        if not mine:
            want.add((f, -1, "rejected", "no_graphical_pages"))
        for _, i, _, sha, h in mine:
            if sha is None:
                want.add((f, i, "rejected", "not_rendered"))
                continue
            reason = None
            if any(s == sha for _, s, _ in seen):
                reason = "exact"
            elif any(g != f and (h ^ o).bit_count() <= 4 for g, _, o in seen):
                reason = "near"
            elif (f, i) in inside:
                reason = "contained"
            want.add((f, i, "duplicate" if reason else "extracted", reason))
            seen.append((f, sha, h))
    files = spark.range(20)
    rows = spark.createDataFrame(pages, "file_id long, page_index int, selected boolean, sha256 string, phash long")
    got = extracted(files, rows, 4, spark.createDataFrame(sorted(inside), "file_id long, page_index int")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {r for _, _, _, r in want} >= {None, "exact", "near", "contained", "not_rendered", "no_graphical_pages"}


def test_extraction_of_nothing(spark):
    empty = spark.createDataFrame([], "file_id long, page_index int, selected boolean, sha256 string, phash long")
    assert [tuple(r) for r in extracted(spark.range(1), empty, 4).collect()] == [(0, -1, "rejected", "no_graphical_pages")]
    assert extracted(spark.range(0), empty, 4).count() == 0


TEXTS = [
    None, "", "plain words", "mail a@b.org c@d.org e@f.org g@h.org info@x.org", "ssn 123-45-6789 and 987-65-4321", "passport no: AB123456",
    "call " + " ".join(f"555-123-{i:04d}," for i in range(11)), "student records with date of birth", "kindergarten songs", "escort service and neo-nazi",
    " \n".join(f"Copyright 20{i} Some Company" for i in range(10, 16)), "copyright 2010 Some Company",
]


def test_findings_are_those_of_re(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = {r.i: r.s for r in rows.select("i", S.findings(F.col("text"), F.lit("unavailable"), F.lit(None).cast("string")).alias("s")).collect()}
    for i, t in enumerate(TEXTS):
        t, d = t or "", {"robots": "robots.txt unavailable at fetch time (treated as allow)"}
        mails = [m for m in re.findall(S.EMAIL, t) if not any(g in m.lower() for g in S.GENERIC)]
        counts = [(len(re.findall(S.SSN, t)), 1, "SSN-like patterns"), (len(re.findall(S.ID_NUMBER, t)), 1, "ID-number patterns"), (len(mails), 4, "non-organizational email addresses"), (sum(1 for _ in re.finditer(S.PHONE, t)), 11, "phone-number-like strings")]
        pii = "; ".join(f"{n} {name}" for n, least, name in counts if n >= least)
        notices, young = sum(1 for _ in re.finditer(S.RIGHTS, t)), [m[0] for m in re.finditer(S.MINOR, t)]
        near = bool(young and re.search(S.MINOR_CONTEXT, t))
        bad = next(((k, m[0]) for k, p in S.PROHIBITED if (m := re.search(p, t))), None)
        if pii:
            d["pii"] = pii
        if young:
            d["minors"] = f"child-{'focused' if near else 'related'} keywords {'with' if near else 'without'} personal-data context: {', '.join(young[:5])}"
        if bad:
            d["prohibited"] = f"prohibited content ({bad[0]}): matched '{bad[1]}'"
        d["rights"] = f"{notices} third-party copyright notices detected" if notices >= 5 else "no dense third-party copyright signals; not individually reviewed"
        assert got[i].details == d
        assert (got[i].forces_review, got[i].forces_reject) == (bool(pii or near or notices >= 5), bool(bad))
    stop = rows.where("i = 2").select(S.findings(F.col("text"), F.lit("disallowed"), F.lit("bad.org")).alias("s")).head().s
    assert (stop.pirate, stop.robots, stop.forces_reject, stop.details["pirate"]) == ("REJECT", "REJECT", True, "blocklist match: bad.org")


def test_json_walk_stops_at_its_depth(spark):
    url = "http://h/a.pptx"
    nested = lambda n: [nested(n - 1)] if n else url
    bodies = [json.dumps(nested(8)), json.dumps(nested(9)), json.dumps({"http://h/key.ppt": [f" {url} ", "http://h/b.PPT?x=1", "ftp://h/c.ppt", "http://h/d.pdf", 3, None]}), "{broken", None, json.dumps(url), '"http://[h/a.ppt"']
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    got = {r.i: r.u for r in rows.select("i", R.json_urls(F.col("body")).alias("u")).collect()}
    assert got == {0: [url], 1: [], 2: [url, "http://h/b.PPT?x=1"], 3: [], 4: [], 5: [url], 6: []}


def test_lists_go_on_by_their_token(spark):
    more, last = '<resumptionToken cursor="0"> t&amp;1 </resumptionToken>', "<resumptionToken/>"
    rows = spark.createDataFrame([("a", "oai", "u", more), ("b", "oai", "u", last), ("c", "html", "u", more), ("d", "oai", "u", None)], "source string, method string, url string, body string")
    assert [tuple(r) for r in R.next_requests(rows).collect()] == [("a", "u", "t&amp;1")]
    assert R.candidates(rows).count() == 0


def test_delays_and_folders(spark):
    rows = spark.createDataFrame([("A.org", None), ("x.a.org", 9.0), ("ba.org", 1.0)], "h string, d double")
    assert [r[0] for r in rows.select(U.base_delay(F.col("h"), {"a.org": 5, "x.a.org": 7}, 2, F.col("d"))).collect()] == [5.0, 9.0, 2.0]
    urls = spark.createDataFrame([("https://drive.google.com/drive/folders/Q/?a=b",), ("https://drive.google.com/file/Q",), ("name",), (None,)], "u string")
    assert [r[0] for r in urls.select(U.folder_id(F.col("u"))).collect()] == ["Q", "", "", ""]
