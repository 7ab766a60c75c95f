"""Payload validation, decks, link resolution, selection with named files, url filter against a loop."""

import io
import random
import zipfile
from urllib.parse import urljoin, urlsplit

from pyspark.sql import functions as F

from lodestone.functions import urls as U
from lodestone.operators import delivery, events, filtering, ordered, packaging
from lodestone.sources import decks

MAIN, REL, PKG = "http://schemas.openxmlformats.org/drawingml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006/relationships"
CHART, OLE = "http://schemas.openxmlformats.org/drawingml/2006/chart", "http://schemas.openxmlformats.org/presentationml/2006/ole"


def rels(**of):
    return f'<Relationships xmlns="{PKG}">' + "".join(f'<Relationship Id="{k}" Target="{v}"/>' for k, v in of.items()) + "</Relationships>"


def paragraph(text, style=""):
    return f"<a:p>{style}<a:r><a:t>{text}</a:t></a:r></a:p>"


def zipped(parts):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for k, v in parts.items():
            z.writestr(k, v)
    return buf.getvalue()


def deck(bodies, order=None):
    order = order or list(range(1, len(bodies) + 1))
    parts = {"ppt/presentation.xml": f'<p xmlns:r="{REL}">' + "".join(f'<sldId r:id="r{i}"/>' for i in order) + "</p>", "ppt/_rels/presentation.xml.rels": rels(**{f"r{i}": f"slides/slide{i}.xml" for i in order})}
    for i, (body, known) in enumerate(bodies, 1):
        parts[f"ppt/slides/slide{i}.xml"] = f'<s xmlns:a="{MAIN}" xmlns:r="{REL}">{body}</s>'
        parts[f"ppt/slides/_rels/slide{i}.xml.rels"] = rels(**known)
    parts["ppt/notesSlides/notesSlide1.xml"] = f'<n xmlns:a="{MAIN}"><a:t>said</a:t></n>'
    parts["ppt/charts/_rels/chart1.xml.rels"] = rels(x="../media/preview.png")
    parts["docProps/core.xml"] = "<c><title> Plan </title><other>x</other></c>"
    return zipped(parts)


def test_slides(spark):
    chart = f'<a:graphicData uri="{CHART}"><c r:id="c"/></a:graphicData>'
    first = chart + '<a:blip r:embed="m"/><a:blip r:embed="v"/><a:blip r:embed="m"/><Fallback><a:blip r:embed="f"/>' + chart + "</Fallback>" + paragraph("one", "<a:pPr><a:buAutoNum/></a:pPr>") + paragraph("two", '<a:pPr lvl="1"/>') + paragraph("three", '<a:pPr lvl="1"><a:buNone/></a:pPr>') + paragraph(" ")
    ole = lambda p: f'<a:graphicData uri="{OLE}"><oleObj progId="{p}"/></a:graphicData>'
    content = deck([(first, {"c": "../charts/chart1.xml", "m": "../media/a.png", "v": "../media/preview.png", "f": "../media/b.png", "n": "../notesSlides/notesSlide1.xml"}), (ole("Excel.Sheet.12") + ole("Word.Document"), {})], order=[2, 1])
    df = spark.createDataFrame([("x", bytearray(content)), ("y", bytearray(b"PK\x03\x04bad"))], "path string, content binary")
    rows = decks.pptx_slides(df).orderBy("path", "slide").collect()
    assert [(r.slide, r.native_chart, r.ole, r.image_count, r.bullets, r.text_chars, r.notes) for r in rows[:2]] == [(1, 0, 1, 0, 0, 0, ""), (2, 1, 0, 1, 2, 11, "said")]
    assert rows[2].path == "y" and rows[2].error
    assert {r.path: r.properties for r in decks.doc_properties(df).collect()} == {"x": {"title": "Plan"}, "y": {}}


def test_decks_end_to_end(spark):
    chart = (f'<a:graphicData uri="{CHART}"/>' + paragraph("sales"), {})
    text = (paragraph("word " * 120), {})
    title = (paragraph("Thank you"), {})
    rows = {"chart": deck([title, *[chart] * 5, text, text, text, title]), "text": deck([title, *[text] * 8]), "few": deck([chart] * 3), "bad": b"no deck"}
    got = {r.path: r for r in decks.classified(spark.createDataFrame([(k, bytearray(v)) for k, v in rows.items()], "path string, content binary")).collect()}
    assert {k: (r.quality, r.decision) for k, r in got.items()} == {"chart": ("HIGH", "DELIVER"), "text": ("LOW", "REJECT"), "few": ("LOW", "REJECT"), "bad": ("LOW", "REJECT")}
    assert got["chart"].slides == 10 and got["chart"].content == 8 and got["chart"].charts == 5 and got["bad"].error and got["chart"].full_text.startswith("Thank you\nsales")


def test_payloads(spark):
    ok, head = deck([(paragraph("a"), {})] * 2), b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
    broken = bytearray(ok)
    broken[ok.index(b"<sldId")] ^= 1
    rows = {
        "ok": (ok, (True, "pptx", None, 2)), "crc": (bytes(broken), (False, None, "corrupt zip member: ppt/presentation.xml", None)), "cut": (ok[:200], (False, None, "bad zip", None)),
        "docx": (zipped({"word/document.xml": "<x/>"}), (False, None, "OOXML but not a presentation (docx/xlsx)", None)), "zip": (zipped({"a": "b"}), (False, None, "zip without ppt/presentation.xml", None)),
        "xml": (zipped({"ppt/presentation.xml": "<x"}), (False, None, "presentation.xml unparseable", None)), "html": (b"<html>", (False, None, "unknown magic bytes", None)), "empty": (b"", (False, None, "empty or missing payload", None)),
        "ppt": (head + b"\0" * 22 + b"\x09\0" + b"\0" * 5000, (True, "ppt", None, None)), "small": (head, (False, None, "ole2 file too small (8B)", None)), "shift": (head + b"\0" * 22 + b"\x07\0" + b"\0" * 5000, (False, None, "ole2 bad sector shift 7", None)),
        "pdf": (b"%PDF-1.4 << /Type /Page >> << /Type /Pages >> %%EOF", (True, "pdf", None, 1)), "half": (b"%PDF-1.4 <<", (False, None, "pdf open failed", None)),
    }
    got = {r.path: tuple(r)[1:] for r in decks.validated(spark.createDataFrame([(k, bytearray(v)) for k, (v, _) in rows.items()], "path string, content binary")).collect()}
    assert got == {k: want for k, (_, want) in rows.items()}


def test_links_are_resolved(spark):
    bases = ["http://h/a/b.html", "http://h/a/", "http://h", "http://h/a?x=1", "HTTP://h/a/", "https://H:80/a/b/c?q#f", "http://h/a/./b"]
    links = ["../c.pptx", "?q=1", "#f", "mailto:a@b", "x", "./x", "../../../y", "/r/../s", "//o/p?q", "http://z/a", "", "a/b/../c", "..", ".", "a//b", "javascript:void(0)", "x?y#z", "/", "http:foo", "x/..", "?"]
    for r in spark.createDataFrame([(b, x) for b in bases for x in links], "b string, l string").select("b", "l", U.absolute(F.col("b"), F.col("l")).alias("o")).collect():
        want = urljoin(r.b, r.l)
        assert r.o == (want if urlsplit(want).netloc else ""), (r.b, r.l)
    names = spark.createDataFrame([("http://h/a%20b+c.pptx?x", "a b+c.pptx"), ("http://h/", "unnamed"), ("http://h/%zz", "%zz"), (None, "unnamed"), ("http://h/" + "x" * 300, "x" * 255)], "u string, want string")
    assert names.where(U.file_name(F.col("u")) != F.col("want")).count() == 0


def test_filter_is_the_loop(spark):
    rnd = random.Random(6)
    rows = [(i, f"http://{rnd.choice('abc')}.org/{rnd.choice(['x', 'zz'])}{i}.pptx", rnd.randint(1, 5), "s", rnd.choice(["discovered"] * 5 + ["delivered", "filtered_out"])) for i in range(150)] + [(150, "/p", 1, "s", "discovered"), (151, "http://sub.bad.org:80/a.pptx", 1, "s", "discovered"), (152, "http://ex.org/a.pptx", 1, "s", "discovered"), (153, "http://q.org/a.txt", 1, "s", "discovered"), (154, "http://q.org/a.txt", 1, "zenodo_x", "discovered")]
    have, want = {}, {}
    for i, u, tier, s, status in rows:
        d = urlsplit(u).netloc
        if status not in ("discovered", "filtered_out"):
            have[d] = have.get(d, 0) + 1
    for i, u, tier, s, status in rows:
        if status != "discovered":
            continue
        d, cap = urlsplit(u).netloc, {5: 4, 2: 9}.get(tier, 12)
        if not d:
            want[i] = "malformed_url"
        elif d == "sub.bad.org:80":
            want[i] = "blocklist:bad.org"
        elif "/zz" in u:
            want[i] = "blocklist:re:/zz[0-9]"
        elif d == "ex.org":
            want[i] = "excluded_source:ex.org"
        elif u.endswith(".txt") and not s.startswith("zenodo"):
            want[i] = "extension"
        elif have.get(d, 0) >= cap:
            want[i] = f"domain_cap:{cap}"
        else:
            have[d] = have.get(d, 0) + 1
            want[i] = "kept"
    df = spark.createDataFrame(rows, "id long, url string, tier int, discovery_source string, status string").withColumn("domain", U.domain(F.col("url")))
    one = lambda e: spark.createDataFrame([(e,)], "entry string")
    got = filtering.filter_reasons(df, one("bad.org"), (".pptx",), 12, {5: 4, 2: 9}, one("ex.org"), ("/zz[0-9]",)).collect()
    assert {r.id: r.reason for r in got} == want


def test_named_files_come_first(spark):
    rows = [(i, q, n) for i, (q, n) in enumerate([("MEDIUM", "a"), ("LOW", "b"), ("HIGH", None), ("HIGH", None), ("MEDIUM", None), ("HIGH", "c"), ("MEDIUM", None), ("HIGH", None)])]
    df = spark.createDataFrame(rows, "id long, quality string, name string")
    got = [r.role for r in packaging.batch_selection(df, 5, assigned="name").orderBy("id").collect()]
    assert got == ["medium", "low", "high", "high", "surplus", "high", "surplus", "high"]
    assert packaging.composition(0.0, 1.0) == packaging.composition(0.6, 0.35) == (0.70, 0.30) and packaging.composition(0.8, 0.25) == (0.8, 0.25)


def test_small_rules(spark):
    one = spark.range(1)
    limit = lambda *x: one.select(delivery.prune_limit(*[F.lit(float(v)) for v in x])).head()[0]
    assert [limit(8, 20, 4) >> 30, limit(40, 10, 4) >> 30, limit(8, 4, 4), limit(1, 500, 2) >> 30] == [8, 3, 0, 1]
    assert one.select(events.head_verdict(F.lit(200), F.lit(" TEXT/HTML ; x"), F.lit(50), 100, 10)).head()[0] == "skip_html"
    df = spark.createDataFrame([(k, i, i % 3) for i in range(60) for k in ("a", "b")], "k string, i int, v int")
    got = {(r.k, r.i): r.s for r in ordered.running(df, ["i"], key="k", s=("sum", F.col("v"))).collect()}
    assert all(got[k, i] == sum(j % 3 for j in range(i + 1)) for k in "ab" for i in range(60))
