"""Readers and sinks on small files, streams on small tables."""

import gzip
import io
import json
import zipfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lodestone.sources import readers as R
from lodestone.sources import sinks
from lodestone.streaming import streams

SHA = "a" * 64


def test_readers(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    spark.createDataFrame([("http://x/A.PPTX", 200, 1), ("http://x/b.pptx", 404, 1), ("http://x/c.pptx", None, 1), ("http://x/d.pdf", 200, 1)], "url string, fetch_status int, other int").write.parquet(p("index"))
    assert {r.url for r in R.url_index(spark, p("index"), (".pptx",)).collect()} == {"http://x/A.PPTX", "http://x/c.pptx"}
    with gzip.open(p("m.gz"), "wt") as f:
        f.write("a/subset=warc/1.parquet\na/subset=robots/2.parquet\n")
    parts = R.crawl_parts(spark, p("m.gz"))
    assert [r.part for r in parts.collect()] == ["a/subset=warc/1.parquet"] and R.undone_parts(parts, parts).count() == 0
    (tmp_path / "cdx.json").write_text('{"url": "u1", "status": "200"}\nbad\n{"url": "u2", "status": "404"}\n')
    assert [r.url for r in R.cdx_lines(spark, p("cdx.json")).collect()] == ["u1"]
    body = json.dumps([["original", "timestamp"], ["http://x/a.pptx", "1"], ["http://x/b.html", "2"]])
    assert [r.url for r in R.cdx_array(spark.createDataFrame([(body,), ("x",)], "body string")).collect()] == ["http://x/a.pptx"]
    (tmp_path / "seeds.txt").write_text("# c\nB.org # x\n\na.org\n")
    assert [r.domain for r in R.seed_domains(spark, p("seeds.txt"), spark.createDataFrame([("www.c.org",)], "domain string")).collect()] == ["a.org", "b.org", "c.org"]
    (tmp_path / "block.txt").write_text("# c\nBad.org\nre:.*\\.zip$\n")
    a, b = R.blocklist(spark, p("block.txt"))
    assert [r[0] for r in a.collect()] == ["bad.org"] and [r[0] for r in b.collect()] == [".*\\.zip$"]
    (tmp_path / "cat.csv").write_text(f"name,SHA256\nx,{SHA.upper()}\n# {'b' * 64}\n")
    assert [r.sha256 for r in R.catalog_hashes(spark, p("cat.csv")).collect()] == [SHA]
    (tmp_path / "h.csv").write_text('url,domain,tier,discovery_source,metadata\nhttp://x/1,x,4,g,"{""k"": ""v""}"\n ,x,4,g,{}\nhttp://x/2,x,4,g,bad\n')
    assert sorted((r.url, tuple(sorted(r.metadata.items()))) for r in R.handoff(spark, p("h.csv")).collect()) == [("http://x/1", (("handoff", "true"), ("k", "v"))), ("http://x/2", (("handoff", "true"),))]
    (tmp_path / "side" / "s").mkdir(parents=True)
    (tmp_path / "side" / "s" / "1.metadata.json").write_text(json.dumps({"sha256": SHA.upper(), "delivered_filename": " f1 ", "size": "x", "content_length": 7}))
    (tmp_path / "side" / "2.metadata.json").write_text("broken")
    assert [tuple(r) for r in R.sidecars(spark, p("side")).collect()] == [(SHA, "f1", None, 7)]
    assert R.folder_hashes(spark, p("side")).count() == 2
    pages = spark.createDataFrame([("r", "<loc> s1 </loc><loc>p1</loc>"), ("s1", "<loc>p2</loc><loc>r</loc>")], "url string, body string")
    assert sorted(map(tuple, R.sitemap_walk(spark, spark.createDataFrame([("r",)], "url string"), pages).collect())) == [("p1", 1), ("p2", 2), ("r", 0), ("s1", 1)]
    html = spark.createDataFrame([('<a href="/a.pptx?x=1"><img src="b.png"><a data-url=\'c.PPT\'>',)], "h string")
    assert html.select(R.doc_links(F.col("h"))).first()[0] == ["/a.pptx", "c.PPT"]
    rec = spark.createDataFrame([([("http://z/a.pptx",), ("http://z/b.txt",)],)], "files array<struct<u:string>>")
    assert [tuple(r) for r in R.exploded_files(rec, "files", "u", (".ppt", ".pptx"), "zenodo").collect()] == [("http://z/a.pptx", "z", "zenodo")]


def test_decks_and_vectors(spark, tmp_path):
    a = "http://schemas.openxmlformats.org/drawingml/2006"
    slide = f'<s xmlns:a="{a}/main"><a:graphicData uri="{a}/chart"/><a:p><a:pPr><a:buChar/></a:pPr><a:t>Hi there</a:t></a:p></s>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for i in (2, 10, 1):
            z.writestr(f"ppt/slides/slide{i}.xml", slide if i == 1 else f'<s xmlns:a="{a}/main"/>')
    df = spark.createDataFrame([("x", bytearray(buf.getvalue())), ("y", bytearray(b"%PDF"))], "path string, content binary")
    rows = R.pptx_slides(df).orderBy("path", "slide").collect()
    assert [(r.path, r.slide, r.native_chart, r.text_chars, r.bullets, r.error is None) for r in rows] == [("x", 1, 1, 7, 1, True), ("x", 2, 0, 0, 0, True), ("x", 3, 0, 0, 0, True), ("y", 0, 0, 0, 0, False)]
    assert [r[0] for r in df.select(R.sniffed(F.col("content"))).collect()] == ["zip", "pdf"]
    with gzip.open(tmp_path / "v.json.gz", "wt") as f:
        f.write(json.dumps({"sha256": SHA, "quality": "HIGH"}) + "\nbad\n" + json.dumps({"sha256": SHA, "quality": "LOW"}) + "\n")
    assert [(r.sha256, r.quality) for r in R.vectors(spark, str(tmp_path / "v.json.gz")).collect()] == [(SHA, "HIGH")]


def test_sinks(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    df = spark.createDataFrame([("b", SHA, 1, 5), ("a", "b" * 64, 1, 9)], "delivered_filename string, sha256 string, batch_id int, score int")
    sinks.write_manifest(df, p("m"))
    got = spark.read.option("header", "true").csv(p("m"))
    assert got.columns == list(sinks.MANIFEST) and len(got.columns) == 28 and [r.delivered_filename for r in got.collect()] == ["a", "b"]
    sinks.write_hashes(df, p("h"))
    assert [r.value for r in spark.read.text(p("h")).collect()] == [SHA, "b" * 64]
    sinks.write_sidecars(df, p("s"))
    assert {json.loads(r.value)["delivered_filename"] for r in spark.read.text(p("s")).collect()} == {"a", "b"}
    sinks.append_audit(df, p("a")), sinks.append_audit(df, p("a"))
    assert spark.read.parquet(p("a")).count() == 4
    sinks.write_report(df.withColumn("classification", F.lit("pass")), p("r"))
    assert [int(r.score) for r in spark.read.option("header", "true").csv(p("r")).collect()] == [9, 5]


def test_streams(spark, tmp_path):
    t = datetime(2024, 1, 1)
    spark.createDataFrame([(1, t + timedelta(hours=h), f, "error", SHA, 1) for h, f in ((0, True), (1, True), (2, True), (3, False))], "key long, ts timestamp, failed boolean, event_type string, sha256 string, user_id int").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))

    def ran(df, mode="append"):
        name = f"q{len(list(tmp_path.iterdir()))}"
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(60)
        return spark.table(name)

    assert [r.state for r in ran(streams.breaker(stream.select("key", "ts", "failed"))).orderBy("ts").collect()] == ["active", "active", "parked", "parked"]
    assert ran(streams.first_seen(stream)).count() == 1
    assert ran(streams.windowed_counts(stream), "complete").agg(F.sum("n")).first()[0] == 4
    assert ran(streams.sessions(stream), "complete").count() == 4
