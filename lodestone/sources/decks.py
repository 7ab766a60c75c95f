"""Presentations as tables: validation of payloads, slide facts in order, notes and document properties, decks end to end."""

from __future__ import annotations

import io
import posixpath
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import decks as D

# Namespaces, suffixes and names of properties: fixed values.
DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
RASTER = (".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tif", ".tiff", ".webp")
PROPERTIES = ("title", "creator", "subject", "description", "keywords", "lastModifiedBy", "created", "modified", "language", "category", "Company", "Application", "Manager", "Template")
SLIDE = "slide int, native_chart int, diagram int, table_ int, ole int, image_count int, text_chars int, bullets int, text string, notes string"


def tag(node) -> str:
    return node.tag.rsplit("}", 1)[-1]


def visible(node) -> Iterator:
    """A node and all below it, but for what stands in Fallback elements: pictures of objects that are counted themselves."""
    yield node
    for child in node:
        if tag(child) != "Fallback":
            yield from visible(child)


class Deck:
    """A presentation's parts, read as asked for."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())

    def xml(self, part: str):
        return ElementTree.fromstring(self.zip.read(part))

    def related(self, part: str) -> dict[str, str]:
        """Parts that a part refers to, by the id of the relation."""
        folder, name = posixpath.split(part)
        table = f"{folder}/_rels/{name}.rels"
        if table not in self.names:
            return {}
        inner = (r for r in self.xml(table) if r.get("TargetMode") != "External" and r.get("Id"))
        return {r.get("Id"): posixpath.normpath(posixpath.join(folder, r.get("Target", ""))) for r in inner}

    def slides(self) -> list[str]:
        """In the order of the presentation's list, by number where there is none."""
        listed = []
        if "ppt/presentation.xml" in self.names:
            try:
                known = self.related("ppt/presentation.xml")
                listed = [known[i] for n in self.xml("ppt/presentation.xml").iter() if tag(n) == "sldId" and (i := n.get(RELATION + "id")) in known]
            except ElementTree.ParseError:
                listed = []
        numbers = {int(m[1]): n for n in self.names if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n))}
        return listed or [numbers[k] for k in sorted(numbers)]

    def facts(self, part: str) -> tuple:
        root, known = self.xml(part), self.related(part)
        kinds, previews, pictures, paragraphs, bullets = {}, set(), {}, [], 0
        for node in visible(root):
            kind = tag(node)
            if kind == "graphicData":
                what = next((k for k in ("chart", "diagram", "table", "ole") if re.search(rf"/{k}(ex)?$|/{k}/", node.get("uri", ""))), None)
                if what == "ole" and not re.search("(?i)excel|sheet", " ".join(n.get("progId", "") for n in node.iter() if tag(n) == "oleObj")):
                    continue
                kinds[what] = kinds.get(what, 0) + 1
                if what == "chart":
                    previews |= {p for n in node.iter() if (i := n.get(RELATION + "id")) in known for p in self.related(known[i]).values()}
            elif kind == "blip" and known.get(node.get(RELATION + "embed"), "").lower().endswith(RASTER):
                pictures[known[node.get(RELATION + "embed")]] = True
            elif node.tag == DRAWING + "p" and (text := "".join(t.text or "" for t in node.iter(DRAWING + "t"))).strip():
                paragraphs.append(text)
                style = node.find(DRAWING + "pPr")
                marks = set() if style is None else {tag(n) for n in style}
                bullets += bool(marks & {"buChar", "buAutoNum"}) or (style is not None and style.get("lvl", "0") != "0" and "buNone" not in marks)
        note = next((p for p in known.values() if posixpath.basename(p).startswith("notesSlide") and p in self.names), None)
        notes = "\n".join(t.text or "" for t in self.xml(note).iter(DRAWING + "t")) if note else ""
        text = "\n".join(paragraphs)
        images = sum(p not in previews for p in pictures)
        return (*(kinds.get(k, 0) for k in ("chart", "diagram", "table", "ole")), images, len(re.sub(r"\s", "", text)), bullets, text, notes)

    def properties(self) -> dict[str, str]:
        out = {}
        for part in {"docProps/core.xml", "docProps/app.xml"} & self.names:
            try:
                out |= {tag(n): n.text.strip()[:500] for n in self.xml(part).iter() if tag(n) in PROPERTIES and (n.text or "").strip()}
            except ElementTree.ParseError:
                continue
        return out


def checked(content: bytes | None) -> tuple[bool, str | None, str | None, int | None]:
    """(ok, format, reason, slide_count) of a payload, by its bytes alone."""
    data = bytes(content or b"")
    if not data:
        return False, None, "empty or missing payload", None
    if data.startswith(b"PK\x03\x04"):
        try:
            deck = Deck(data)
            if "ppt/presentation.xml" not in deck.names:
                other = {"word/document.xml", "xl/workbook.xml"} & deck.names
                return False, None, "OOXML but not a presentation (docx/xlsx)" if other else "zip without ppt/presentation.xml", None
            if (bad := deck.zip.testzip()) is not None:
                return False, None, f"corrupt zip member: {bad}", None
            deck.xml("ppt/presentation.xml")
            return True, "pptx", None, len(deck.slides())
        except ElementTree.ParseError:
            return False, None, "presentation.xml unparseable", None
        except zipfile.BadZipFile:
            return False, None, "bad zip", None
        except Exception as e:  # truncated members raise errors of many kinds; the payload is bad, the job goes on
            return False, None, f"corrupt zip: {type(e).__name__}", None
    if data.startswith(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"):
        if len(data) < 4096:
            return False, None, f"ole2 file too small ({len(data)}B)", None
        (shift,) = struct.unpack_from("<H", data, 30)
        return (True, "ppt", None, None) if shift in (9, 12) else (False, None, f"ole2 bad sector shift {shift}", None)
    if data.startswith(b"%PDF"):
        pages = len(re.findall(rb"/Type\s*/Page(?![a-zA-Z])", data))
        if b"/Encrypt" in data:
            return False, None, "password-protected PDF", None
        return (True, "pdf", None, pages or None) if b"%%EOF" in data[-2048:] else (False, None, "pdf open failed", None)
    return False, None, "unknown magic bytes", None


def validated(files: DataFrame) -> DataFrame:
    """path, ok, format, reason, slide_count of payloads (path, content). PDF files are looked at from outside: their end, encryption and page objects."""

    def run(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame([(p, *checked(c)) for p, c in zip(b["path"], b["content"])], columns=["path", "ok", "format", "reason", "slide_count"]).astype({"slide_count": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, ok boolean, format string, reason string, slide_count int")


def pptx_slides(files: DataFrame) -> DataFrame:
    """Slide facts of .pptx files (path, content): path, slide (from 1, in the presentation's order), native_chart, diagram, table_, ole (spreadsheets), image_count, text_chars, bullets, text, notes; bad files give one row with error."""

    def run(batches):
        import pandas as pd

        names = ["path", *(x.split()[0] for x in SLIDE.split(", ")), "error"]
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    deck = Deck(content)
                    out += [(path, i, *deck.facts(s), None) for i, s in enumerate(deck.slides(), 1)]
                except Exception as e:  # a broken file is a row, not a failed job
                    out.append((path, 0, 0, 0, 0, 0, 0, 0, 0, "", "", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=names)

    return files.select("path", "content").mapInPandas(run, f"path string, {SLIDE}, error string")


def doc_properties(files: DataFrame) -> DataFrame:
    """path and properties (a map) of .pptx files; empty for bad ones."""

    @F.udf("map<string,string>")
    def read(content):
        try:
            return Deck(content).properties()
        except Exception:  # a broken file has none
            return {}

    return files.select("path", read("content").alias("properties"))


def classified(files: DataFrame, t: D.Thresholds = D.Thresholds()) -> DataFrame:
    """Decks (path, content) end to end: path, quality, decision, borderline, slides, content, analytical, charts, full_text (slides, then notes) and error; what can't be read is LOW and rejected."""
    slides = pptx_slides(files)
    good = slides.where("error IS NULL").withColumns({"image_analytical": F.lit(0), "image_photo": F.lit(0), "vector": F.lit(0)})
    ends = good.groupBy("path").agg(F.max("slide").alias("last"))
    good = good.join(ends, "path")
    objects = F.col("native_chart") + F.col("diagram") + F.col("table_") + F.col("ole") > 0
    reason = D.filler_reason(F.trim("text"), F.col("text_chars"), (F.col("slide") == 1) | (F.col("slide") == F.col("last")), F.col("image_photo"), F.col("image_count"), F.col("vector"), objects)
    decided = D.deck_decision(D.deck_metrics(good.withColumn("filler", reason.isNotNull()), "path"), t)
    ordered = lambda c: F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("slide", c))), lambda x: x[c]), lambda x: x != ""), "\n")
    texts = good.groupBy("path").agg(ordered("text").alias("text"), ordered("notes").alias("notes"))
    full = F.concat("text", F.when(F.col("notes") != "", F.concat(F.lit("\n\n"), "notes")).otherwise(""))
    out = decided.join(texts, "path").select("path", "quality", "decision", "borderline", "slides", "content", "analytical", "charts", full.alias("full_text"), F.lit(None).cast("string").alias("error"))
    bad = slides.where("error IS NOT NULL")
    zero = F.lit(0).cast("long")
    return out.union(bad.select("path", F.lit("LOW"), F.lit("REJECT"), F.lit(False), zero, zero, zero, zero, F.lit(""), "error"))
