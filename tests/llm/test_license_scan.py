"""Which detections stand, against a loop; and sentences of licenses."""

import random
import re

from lodestone.llm import license_scan


def looped(found):
    found = sorted(found, key=lambda d: (d[2], -d[3], -d[1], d[0]))  # start, longest first, priority, rule
    left, reach = [], -1
    for d in found:
        if d[3] > reach:
            left.append(d)
            reach = d[3]
    stand = []
    for d in sorted(left, key=lambda d: (-d[1], d[2], d[0])):
        if not any(y[2] < d[3] and d[2] < y[3] for y in stand):
            stand.append(d)
    return sorted(stand)


def test_priority_against_a_loop(spark):
    rnd, rows, want = random.Random(2), [], {}
    for row in range(120):
        found = []
        for rule in range(rnd.randint(1, 14)):
            start = rnd.randrange(30)
            found.append((rule, rnd.choice([30, 50, 70, 90]), start, start + rnd.randint(1, 7)))
        rows += [(row, r, f"l{r}", p, False, a, e) for r, p, a, e in found]
        want[row] = looped(found)
    got = {}
    for r in license_scan.resolved(spark.createDataFrame(rows, "_row long, rule int, label string, priority int, base boolean, start int, end int")).collect():
        got.setdefault(r._row, []).append((r.rule, r.priority, r.start, r.end))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_chain(spark):
    rule = lambda i, label, pattern, n: {"rule": i, "label": label, "keyword": "dd", "stem": "dd", "pattern": f"(?<= ){pattern}(?= )", "priority": n, "base": False}
    wanted = [rule(0, "a", "aa bb cc dd", 90), rule(1, "b", "dd ee ff", 80), rule(2, "c", "ff gg", 70)]
    df = spark.createDataFrame([("aa bb cc dd ee ff gg",), ("",), (None,), ("dd ee ff gg",)], "text string")
    assert [r.labels for r in license_scan.license_scan(df, wanted).collect()] == ["a,c", "", "", "b"]


SENTENCES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
    "Neither the name of Acme Inc. nor the names of its contributors may be used to endorse or promote products derived from this software": "bsd-3",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa", "https://creativecommons.org/publicdomain/zero/1.0/": "cc0",
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl-3",
    "You should have received a copy of the GNU Affero General Public License along with this program": "agpl-3",
    "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.": "zlib",
    "No part of this publication may be reproduced in any form": "proprietary", "may not be used for commercial purposes": "non-commercial",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "permission to speak was granted to the person": "", "the software is provided with documentation files": "",
}


def test_sentences(spark):
    rows = spark.createDataFrame([(k, f"and {k} so") for k in SENTENCES], "doc_id string, text string")
    assert {r.doc_id: r.labels for r in license_scan.license_scan(rows).collect()} == SENTENCES


def test_keywords_are_words_of_their_rules():
    for r in license_scan.rules():
        assert r["keyword"] in re.split("[^a-z0-9]+", r["pattern"]), r
    assert len(license_scan.SENTENCES) > 60 and len({r["pattern"] for r in license_scan.rules()}) > 400
