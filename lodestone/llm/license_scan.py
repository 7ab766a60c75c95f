"""License scan by ordered signature rules.

Hundreds of regexes, each with a priority, match the words of a document joined
by single blanks. A keyword prefilter gates them: a rule is tried on a document
only if the rule's keyword is one of its words and the rule's stem stands in
it. Detections are intervals of words; those contained in another are
suppressed, equal intervals go to the higher priority. What is left is taken in
order of priority: a detection yields to those it overlaps in part that were
taken before it, and to no other.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import anchored, cut_table, joined_small, packed, table, unpacked, with_row_key, words

#: (label, keyword, name as a regex over words, SPDX identifier as words). The keyword is a word of every text that the name matches.
LICENSES = (
    ("mit", "mit", "mit", "mit"), ("mit", "expat", "expat", "expat"), ("mit-0", "0", "mit 0", "mit 0"), ("x11", "x11", "x11", "x11"), ("isc", "isc", "isc", "isc"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version | v ?| )2(?: 0)?", "apache 2 0"), ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version | v ?| )1 1", "apache 1 1"), ("apache", "apache", "apache(?: software)?", "apache"),
    ("bsd-2", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd)", "bsd 2 clause"), ("bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)", "bsd 3 clause"), ("bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd)", "bsd 4 clause"), ("0bsd", "0bsd", "0bsd", "0bsd"), ("bsd", "bsd", "bsd", "bsd"),
    ("gpl-3", "gnu", "gnu general public license(?: version | v ?| )3(?: 0)?", "gnu gpl 3 0"), ("gpl-3", "gpl", "gpl(?: version | v ?| )3(?: 0)?", "gpl 3 0"), ("gpl-3", "gplv3", "gplv3", "gplv3"),
    ("gpl-2", "gnu", "gnu general public license(?: version | v ?| )2(?: 0)?", "gnu gpl 2 0"), ("gpl-2", "gpl", "gpl(?: version | v ?| )2(?: 0)?", "gpl 2 0"), ("gpl-2", "gplv2", "gplv2", "gplv2"), ("gpl", "gnu", "gnu gpl", "gnu gpl"), ("gpl", "gnu", "gnu general public license", "gnu general"), ("gpl", "gpl", "gpl", "gpl"),
    ("lgpl-2.1", "lgpl", "lgpl(?: version | v ?| )2 1", "lgpl 2 1"), ("lgpl-3", "lgpl", "lgpl(?: version | v ?| )3(?: 0)?", "lgpl 3 0"), ("lgpl-2.1", "gnu", "gnu lesser general public license(?: version | v ?| )2 1", "gnu lgpl 2 1"), ("lgpl-3", "gnu", "gnu lesser general public license(?: version | v ?| )3(?: 0)?", "gnu lgpl 3 0"), ("lgpl", "gnu", "gnu (?:lesser|library) general public license", "gnu lesser"), ("lgpl", "lgpl", "lgpl", "lgpl"),
    ("agpl-3", "affero", "(?:gnu )?affero general public license(?:(?: version | v ?| )3(?: 0)?)?", "affero"), ("agpl-3", "agpl", "agpl(?:(?: version | v ?| )3(?: 0)?)?", "agpl 3 0"), ("fdl", "gfdl", "gfdl", "gfdl"), ("fdl", "documentation", "gnu free documentation license", "gnu fdl documentation"),
    ("mpl-2", "mozilla", "mozilla public license(?: version | v ?| )2(?: 0)?", "mozilla 2 0"), ("mpl-2", "mpl", "mpl(?: version | v ?| )2(?: 0)?", "mpl 2 0"), ("mpl-1.1", "mpl", "mpl(?: version | v ?| )1 1", "mpl 1 1"), ("mpl-1.1", "mozilla", "mozilla public license(?: version | v ?| )1 1", "mozilla 1 1"), ("mpl", "mozilla", "mozilla public", "mozilla"), ("mpl", "mpl", "mpl", "mpl"),
    ("epl-2", "eclipse", "eclipse public license(?: version | v ?| )2(?: 0)?", "eclipse 2 0"), ("epl-1", "eclipse", "eclipse public license(?: version | v ?| )1(?: 0)?", "eclipse 1 0"), ("epl", "eclipse", "eclipse public", "eclipse"), ("epl", "epl", "epl", "epl"), ("cddl", "cddl", "cddl(?: 1 [01])?", "cddl 1 0"), ("eupl", "eupl", "eupl(?: v?1 2)?", "eupl 1 2"), ("cecill", "cecill", "cecill", "cecill"),
    ("cc-by-nc-sa", "nc", "cc by nc sa(?: [1234](?: [05])?)?", "cc by nc sa 4 0"), ("cc-by-nc-nd", "nc", "cc by nc nd(?: [1234](?: [05])?)?", "cc by nc nd 4 0"), ("cc-by-nc", "nc", "cc by nc(?: [1234](?: [05])?)?", "cc by nc 4 0"), ("cc-by-sa", "sa", "cc by sa(?: [1234](?: [05])?)?", "cc by sa 4 0"), ("cc-by-nd", "nd", "cc by nd(?: [1234](?: [05])?)?", "cc by nd 4 0"), ("cc-by", "cc", "cc by(?: [1234](?: [05])?)?", "cc by 4 0"),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?", "creative attribution noncommercial sharealike"), ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported| generic)?", "creative attribution noncommercial noderivs"), ("cc-by-nc", "creative", "creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?", "creative attribution noncommercial"), ("cc-by-sa", "creative", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?", "creative attribution sharealike"), ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported| generic)?", "creative attribution noderivs"), ("cc-by", "creative", "creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?", "creative attribution"), ("cc0", "cc0", "cc0(?: 1 0)?", "cc0 1 0"), ("cc0", "creative", "creative commons zero", "creative zero"), ("cc", "creative", "creative commons", "creative"),
    ("zlib", "zlib", "zlib", "zlib"), ("bsl-1", "boost", "boost software", "boost"), ("unlicense", "unlicense", "unlicense", "unlicense"), ("wtfpl", "wtfpl", "wtfpl", "wtfpl"), ("artistic-2", "artistic", "artistic(?: license)?(?: 2(?: 0)?)?", "artistic 2 0"), ("ofl", "ofl", "(?:sil )?ofl(?: 1 1)?", "ofl 1 1"), ("ofl", "sil", "sil open font", "sil"), ("odbl", "odbl", "odbl(?: 1 0)?", "odbl 1 0"), ("pddl", "pddl", "pddl", "pddl"), ("python-2", "python", "python(?: software foundation)?", "python 2 0"), ("postgresql", "postgresql", "postgresql", "postgresql"), ("openssl", "openssl", "openssl", "openssl"), ("ms-pl", "microsoft", "microsoft public", "microsoft public"), ("ms-rl", "microsoft", "microsoft reciprocal", "microsoft reciprocal"), ("osl-3", "osl", "osl(?: 3(?: 0)?)?", "osl 3 0"), ("afl-3", "afl", "afl(?: 3(?: 0)?)?", "afl 3 0"), ("upl", "upl", "upl", "upl 1 0"), ("sspl", "sspl", "sspl", "sspl 1 0"), ("elastic-2", "elastic", "elastic(?: license)?(?: 2(?: 0)?)?", "elastic 2 0"), ("busl", "busl", "busl(?: 1 1)?", "busl 1 1"), ("ncsa", "ncsa", "ncsa", "ncsa"), ("php", "php", "php", "php 3 01"), ("ruby", "ruby", "ruby", "ruby"), ("vim", "vim", "vim", "vim"),
    ("cddl", "distribution", "common development and distribution license(?:(?: version | v ?| )1 [01])?", "distribution"), ("eupl", "european", "european union public licen[cs]e(?:(?: version | v ?| )1 [12])?", "european"), ("osl-3", "open", "open software license(?:(?: version | v ?| )3(?: 0)?)?", "open"), ("afl-3", "academic", "academic free license(?:(?: version | v ?| )3(?: 0)?)?", "academic"), ("upl", "permissive", "universal permissive license", "permissive"), ("sspl", "server", "server side public license", "server"), ("busl", "business", "business source license", "business"), ("odbl", "database", "open database license", "database"), ("pddl", "dedication", "public domain dedication and license", "dedication"), ("ncsa", "ncsa", "ncsa open source license", "ncsa"), ("mit-0", "attribution", "mit no attribution license", "attribution"),
)
#: (name, priority, regex with N for the license's name and L for the name with the word license in or after it, stem that must stand in the text)
FORMS = (
    ("identifier", 100, "spdx license identifier {I}", "spdx"),
    ("licensed-under", 90, "licensed under (?:the |an? )?(?:terms (?:and conditions )?of (?:the )?)?{N}(?: public)?(?: licen[cs]es?)?", "licensed under"),
    ("released-under", 85, "(?:released|distributed|available|published|provided|covered|governed|made available|shared) (?:under|by) (?:the |an? )?(?:terms (?:and conditions )?of (?:the )?)?{N}(?: public)?(?: licen[cs]es?)?", "licen"),
    ("under", 80, "under (?:the |an? )?(?:terms (?:and conditions )?of (?:the )?)?{L}", "licen"),
    ("named", 70, "{L}", "licen"),
)
#: (label, keyword, regex, priority, stem): rules that name no license of the table.
OTHERS = (
    ("public-domain", "domain", "(?:in|into|to) the public domain", 75, "public domain"),
    ("all-rights-reserved", "rights", "all rights reserved", 40, "reserved"),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 30, "copyright"),
    ("proprietary", "proprietary", "proprietary and confidential", 60, "confidential"),
    ("proprietary", "permission", "without (?:the )?prior written permission", 50, "written"),
    ("non-commercial", "commercial", "(?:for )?non commercial use only", 55, "non commercial"),
)
#: (label, keyword, regex, stem): sentences of the licenses' own texts and of the notices that they ask for.
SENTENCES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free"),
    ("mit", "notice", "the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions", "permission notice"),
    ("mit-0", "furnished", "to whom the software is furnished to do so the software is provided as is", "furnished to do so the"),
    ("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("isc", "appear", "provided that the above copyright notice and this permission notice appear in all copies", "appear in all copies"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd", "redistributions", "redistributions (?:of source code must retain|in binary form must reproduce) the above copyright notice this list of conditions", "list of conditions"),
    ("bsd-3", "endorse", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products derived from this software", "neither the name"),
    ("bsd-4", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment", "advertising materials"),
    ("0bsd", "sacrificed", "sacrificed to the public without conditions", "sacrificed"),
    ("apache-2", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "in compliance with"),
    ("apache-2", "apache", "you may obtain a copy of the license at (?:https? )?www apache org licenses license 2 0", "www apache org"),
    ("apache-2", "apache", "apache license version 2 0 january 2004", "january 2004"),
    ("apache", "apache", "this product includes software developed by the apache software foundation", "apache software foundation"),
    ("gpl-2", "gnu", "gnu general public license as published by the free software foundation (?:either )?version 2(?: of the license)?(?: or (?:at your option )?any later version)?", "version 2"),
    ("gpl-3", "gnu", "gnu general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or (?:at your option )?any later version)?", "version 3"),
    ("gpl", "gnu", "you should have received a copy of the gnu general public license along with this (?:program|package|file|library)", "should have received a copy"),
    ("gpl", "gnu", "free software licensed under the gnu gpl", "gnu gpl"),
    ("gpl-3", "gnu", "gnu general public license version 3 29 june 2007", "29 june 2007"),
    ("gpl-2", "gnu", "gnu general public license version 2 june 1991", "june 1991"),
    ("lgpl-2.1", "gnu", "gnu lesser general public license as published by the free software foundation (?:either )?version 2 1(?: of the license)?(?: or (?:at your option )?any later version)?", "version 2 1"),
    ("lgpl-3", "gnu", "gnu lesser general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or (?:at your option )?any later version)?", "version 3"),
    ("lgpl", "gnu", "you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:program|package|file|library)", "should have received a copy"),
    ("agpl-3", "affero", "gnu affero general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or (?:at your option )?any later version)?", "version 3"),
    ("agpl-3", "affero", "you should have received a copy of the gnu affero general public license along with this program", "should have received a copy"),
    ("fdl", "documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "modify this document"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0", "source code form"),
    ("mpl-2", "mozilla", "if a copy of the mpl was not distributed with this file you can obtain one at (?:https? )?mozilla org mpl 2 0", "mozilla org mpl"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1", "contents of this file"),
    ("epl-2", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0", "accompanying materials"),
    ("epl-1", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "accompanying materials"),
    ("cddl", "distribution", "the contents of this file are subject to the terms of the common development and distribution license", "contents of this file"),
    ("eupl", "eupl", "licensed under the eupl version 1 [12](?: or as soon they will be approved by the european commission)?", "eupl"),
    ("cecill", "cecill", "this software is governed by the cecill(?: b| c)? license under french law", "french law"),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1234] [05]", "licenses by sa"),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1234] [05]", "licenses by nc"),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1234] [05]", "licenses by nd"),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1234] [05]", "by nc sa"),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1234] [05]", "by nc nd"),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1234] [05]", "licenses by"),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0", "publicdomain zero"),
    ("cc0", "waived", "has waived all (?:of his or her )?(?:rights|copyright and related or neighboring rights)", "waived all"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "must not be misrepresented"),
    ("zlib", "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "plainly marked"),
    ("bsl-1", "boost", "distributed under the boost software license version 1 0", "boost software"),
    ("bsl-1", "boost", "see accompanying file license 1 0 txt or copy at (?:https? )?www boost org license 1 0 txt", "www boost org"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("unlicense", "unlicense", "for more information please refer to (?:https? )?unlicense org", "unlicense org"),
    ("wtfpl", "want", "do what the fuck you want to public license", "want to public license"),
    ("artistic-2", "artistic", "this package is free software you may redistribute it and or modify it under the (?:terms of the )?artistic license 2 0", "artistic license"),
    ("ofl", "sil", "this font software is licensed under the sil open font license version 1 1", "font software"),
    ("ofl", "faq", "this license is also available with a faq at (?:https? )?(?:scripts sil org|openfontlicense org)", "with a faq at"),
    ("odbl", "odbl", "made available under the open database license (?:https? )?opendatacommons org licenses odbl 1 0", "opendatacommons org"),
    ("pddl", "dedication", "made available under the public domain dedication and license(?: version)? v?1 0", "public domain dedication"),
    ("python-2", "python", "python software foundation license version 2", "foundation license"),
    ("postgresql", "postgresql", "this software is released under the postgresql licen[cs]e", "postgresql"),
    ("openssl", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", "openssl toolkit"),
    ("ms-pl", "microsoft", "this source is subject to the microsoft public license", "subject to the microsoft"),
    ("ms-rl", "microsoft", "this source is subject to the microsoft reciprocal license", "subject to the microsoft"),
    ("upl", "universal", "licensed under the universal permissive license v 1 0", "universal permissive"),
    ("sspl", "server", "terms of the server side public license version 1 as published by mongodb", "server side"),
    ("elastic-2", "elastic", "you may not use this file except in compliance with the elastic license 2 0", "elastic license"),
    ("busl", "licensor", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", "non production use"),
    ("ncsa", "deal", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish", "deal with the software"),
    ("php", "php", "this source file is subject to version 3 01? of the php license", "php license"),
    ("php", "php", "this product includes php software freely available from (?:https? )?www php net software", "php software"),
    ("proprietary", "trade", "contains (?:confidential and proprietary information|trade secrets) of", "trade secrets"),
    ("proprietary", "reproduced", "no part of this (?:publication|document|work|book) may be reproduced (?:distributed or transmitted |stored in a retrieval system or transmitted )?in any form", "may be reproduced"),
    ("public-domain", "dedicated", "(?:is|are|has been) (?:hereby )?dedicated to the public domain", "public domain"),
    ("non-commercial", "noncommercial", "for noncommercial (?:use|purposes) only", "noncommercial"),
    ("non-commercial", "commercial", "may not be used for commercial purposes", "commercial purposes"),
)
#: Priority of sentences: over names, under identifiers.
SENTENCE = 92
#: Base phrases and their labels.
BASE = (("mit", "mit", "under the mit license"), ("apache-2", "apache", "apache license version 2"), ("cc-by-nc", "nc", "cc by nc"))


def with_license(name: str) -> str:
    """Regex of the name with the word license, which stands in it or follows."""
    own, after = name.replace("(?: license)?", " license"), f"{name}(?: public)? licen[cs]es?"
    if own != name:
        return f"(?:{own}|{after})"
    return name if "licen" in name else after


def rules() -> list[dict]:
    """All rules: rule (their order), label, keyword, stem, pattern, priority, base."""
    whole = r"(?<= )(?:{})(?= )".format
    out = [{"label": a, "keyword": k, "stem": p, "pattern": whole(p), "priority": 95, "base": True} for a, k, p in BASE]
    for label, keyword, name, identifier in LICENSES:
        for form, priority, pattern, stem in FORMS:
            if form == "identifier" and keyword not in identifier.split():
                continue
            out.append({"label": label, "keyword": keyword, "stem": stem, "pattern": whole(pattern.replace("{N}", name).replace("{L}", with_license(name)).replace("{I}", identifier)), "priority": priority, "base": False})
    out += [{"label": a, "keyword": k, "stem": s, "pattern": whole(p), "priority": n, "base": False} for a, k, p, n, s in OTHERS]
    out += [{"label": a, "keyword": k, "stem": s, "pattern": whole(p), "priority": SENTENCE, "base": False} for a, k, p, s in SENTENCES]
    return [{"rule": i, **r} for i, r in enumerate(out)]


def rule_table(spark: SparkSession, wanted: list[dict]) -> DataFrame:
    kind = "array<struct<rule:int,label:string,keyword:string,stem:string,pattern:string,priority:int,base:boolean>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(wanted)), kind)))


def detections(texts: DataFrame, wanted: list[dict]) -> DataFrame:
    """A row for each match: _row, rule, label, priority, base, start, end (words, end exclusive). texts: _row, w.

    Within a partition the rules are tried one after the other, so each regex is compiled once, not for each row.
    """
    keywords = sorted({r["keyword"] for r in wanted})
    gated = texts.withColumn("keyword", F.array_intersect("w", F.array(*map(F.lit, keywords)))).where(F.size("keyword") > 0)
    gated = gated.select("_row", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("t"), F.explode("keyword").alias("keyword"))
    tried = gated.join(F.broadcast(rule_table(texts.sparkSession, wanted)), "keyword").where(F.col("t").contains(F.col("stem"))).sortWithinPartitions("rule")
    # Each match is marked: \x01 before, \x02 behind. Out of generators, which stay behind the sort.
    tried = tried.withColumn("m", F.explode(F.array(F.regexp_replace("t", F.col("pattern"), F.lit("\x01$0\x02"))))).where(F.instr("m", "\x01") > 0)
    tried = tried.select("_row", "rule", "label", "priority", "base", F.explode(F.array(F.split("m", "\x01"))).alias("p"))
    blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    # After the first, each part is a match, \x02 and what follows it; the blanks before a match number its first word.
    sums = F.aggregate(
        "p", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")),
        lambda a, x: F.struct((a["at"] + blanks(x)).alias("at"), F.when(F.instr(x, "\x02") > 0, F.concat(a["out"], F.array(F.struct((a["at"] - 1).alias("start"), (a["at"] + blanks(F.substring_index(x, "\x02", 1))).alias("end"))))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"],
    )
    return tried.select("_row", "rule", "label", "priority", "base", F.inline(sums))


def resolved(found: DataFrame) -> DataFrame:
    """The detections that stand: contained ones go (of equal ones all but the first by priority, then rule); of what is left each, by falling priority, then place, stands if none that stands overlaps it.

    Only detections that hang together by overlaps are looked at together.
    """
    order = W.partitionBy("_row").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
    left = found.withColumn("reach", F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))).where(F.col("reach").isNull() | (F.col("reach") < F.col("end")))
    # Starts and ends rise now; a chain of overlaps ends where a start is not before the last end.
    left = left.withColumn("fresh", F.coalesce((F.col("start") >= F.lag("end").over(W.partitionBy("_row").orderBy("start"))).cast("int"), F.lit(1)))
    left = left.withColumn("chain", F.sum("fresh").over(W.partitionBy("_row").orderBy("start")))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("priority")).alias("p"), "start", "rule", "end", "label", "priority", "base")))
    chains = left.groupBy("_row", "chain").agg(ranked.alias("c"))
    none = F.filter("c", lambda x: F.lit(False))
    stand = F.aggregate("c", none, lambda a, x: F.when(F.exists(a, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])), a).otherwise(F.concat(a, F.array(x))))
    return chains.select("_row", F.inline(stand)).select("_row", "rule", "label", "priority", "base", "start", "end")


def license_scan(docs: DataFrame, wanted: list[dict] | None = None, text_col: str = "text") -> DataFrame:
    """The columns of docs, and n_words, n_base, first_word, last_word (of base phrases), base_labels, labels (sorted, comma-joined), score.

    Null and empty texts have no words, no labels ('') and score 0; repeated rows are each scanned; texts are scanned whole,
    however long. Extra columns pass, those with the name of an added one are replaced by it; an empty table gives no rows.
    score: the highest priority of what is left after suppression, over 100.
    """
    wanted, docs = wanted or rules(), anchored(docs)
    found = cut_table(detections(with_row_key(docs.select(text_col)).select("_row", words(F.col(text_col)).alias("w")), wanted))
    columns = ["_row", "label", "priority", "start"]
    marks = found.where("base").select(*columns, F.lit(True).alias("base"), F.lit(False).alias("kept")).union(resolved(found).select(*columns, F.lit(False), F.lit(True)))
    base = F.col("base")
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    by_row = marks.groupBy("_row").agg(
        F.sum(base.cast("long")).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.lit(True)).alias("labels"), (F.max(F.when(F.col("kept"), F.col("priority"))) / 100.0).alias("score"),
    )
    out = joined_small(packed(docs, text_col).withColumn("n_words", F.size(words(F.col("_0"))).cast("long")), cut_table(by_row), "_row", "left")
    filled = {"n_base": F.lit(0).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    added = {c: F.coalesce(F.col(c), filled[c]) if c in filled else F.col(c) for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
    return unpacked(out, docs, added)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
