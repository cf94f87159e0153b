import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lexmill.operators.gazette import act_documents, acts
from lexmill.sources import files as I
from lexmill.streaming.loads import issue_stream, load_stream, status_stream, windowed_status

ACT = "\nLoi n° {n} du 3 janvier 2023 portant x.\nVu la Constitution ;\nArticle 1er. — A.\n"


def issue(folder, lang, year, number, name="markdown.md", text="x"):
    at = folder / f"OCR-{lang}" / str(year) / f"{lang.upper()}{year}{number:03d}.pdf"
    at.mkdir(parents=True, exist_ok=True)
    (at / name).write_text(text, encoding="utf-8")


def test_issues_and_inventory(spark, tmp_path):
    issue(tmp_path, "Fr", 2023, 1, text="un")
    issue(tmp_path, "Fr", 2023, 1, "FR2023001.md", "autre")
    issue(tmp_path, "Ar", 2006, 15, "AR2006015.md", "نص")
    issue(tmp_path, "Fr", "index", 2)
    files = I.whole_texts(spark, str(tmp_path), "*.md")
    rows = {(r.language, r.year, r.issue): r.text for r in I.parsed_issues(files.filter(F.endswith("path", F.lit("markdown.md")))).collect()}
    assert rows["FR", 2023, "001"] == "un"
    assert {(r.year, r.issue, r.language) for r in I.parsed_issues(files, 1999, "9", "AR").collect()} == {(1999, "9", "AR")}
    got = [(r.language, r.year, r.issue, r.path.rsplit("/", 1)[1]) for r in I.issue_inventory(files).collect()]
    assert got == [("AR", 2006, "015", "AR2006015.md"), ("FR", 2023, "001", "markdown.md")]


def test_pages_nodes_and_binaries(spark, tmp_path):
    page = tmp_path / "2010" / "issue_02" / "pages" / "page-3"
    page.mkdir(parents=True)
    (page / "markdown.md").write_text("p3")
    for name in ("nid_7_b", "nid_7_a", "nid_7.pdf", "nid_8.pdf", "other"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "markdown.md").write_text(name)
    (tmp_path / "f.pdf").write_bytes(b"%PDF-1.4")
    files = I.whole_texts(spark, str(tmp_path), "*.md")
    assert [(r.issue_year, r.issue_number, r.page_no, r.text) for r in I.issue_pages(files).collect()] == [(2010, 2, 3, "p3")]
    assert {(r.nid, r.text) for r in I.node_ocr(files).collect()} == {(7, "nid_7_a"), (8, "nid_8.pdf")}
    assert [(r["size"], bytes(r.content[:4])) for r in I.binary_files(spark, str(tmp_path)).collect()] == [(8, b"%PDF")]
    rows = spark.createDataFrame([(1, "raw/x/markdown.md"), (2, None)], "id int, raw_path string")
    assert {(r.id, r.html is None) for r in I.archived_pages(files.filter(F.contains("path", F.lit("page-3"))), rows).collect()} == {(1, False), (2, True)}


def test_payloads(spark, tmp_path):
    df = spark.createDataFrame([('{"pages":[{"markdown":"a"},{"markdown":"b"}]}',), ('{"data":{"pages":[{"markdown":"c"}]}}',), ("x",)], "j string")
    assert [r.d for r in df.select(I.ocr_document(F.col("j")).alias("d")).collect()] == ["a\n\n---\n\nb", "c", None]
    xml = spark.createDataFrame([("<loc>https://x/%D9%85</loc><loc>b</loc>",)], "x string")
    assert xml.select(I.sitemap_urls(F.col("x")).alias("u")).first().u == ["https://x/م", "b"]
    (tmp_path / "s.json").write_text('[{"nid": 3, "type": "a"}]')
    assert I.seed_list(spark, str(tmp_path / "s.json")).first().nid == 3


def test_stream_load_is_idempotent(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    for n in range(1, 4):
        issue(source, "Fr", 2023, n, text=ACT.format(n=n))

    def parse(batch):
        return act_documents(acts(I.parsed_issues(batch))).select("canonical_id", "title", F.lit(1).alias("seq"))

    for _ in range(2):
        load_stream(issue_stream(spark, str(source), 2), parse, target, ["canonical_id"], "seq", str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(target).count() == 3
    load_stream(issue_stream(spark, str(source), 2), parse, target, ["canonical_id"], "seq", str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(target).count() == 3


def test_stream_load_survives_replays_and_stops_at_unreadable_targets(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    for n in range(1, 4):
        issue(source, "Fr", 2023, n, text=ACT.format(n=n))

    def parse(batch):
        return act_documents(acts(I.parsed_issues(batch))).select("canonical_id", "title", F.lit(1).alias("seq"))

    def load(checkpoint):
        load_stream(issue_stream(spark, str(source), 2), parse, str(target), ["canonical_id"], "seq", str(tmp_path / checkpoint)).awaitTermination()

    load("c")
    last = sorted((tmp_path / "c" / "commits").glob("[0-9]*"))[-1]
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    last.unlink()  # as if the driver were lost after the write, before the commit
    load("c")
    assert spark.read.parquet(str(target)).count() == 3
    for file in target.rglob("*.parquet"):
        file.write_bytes(b"broken")
    for file in target.rglob(".*.crc"):
        file.unlink()
    with pytest.raises(StreamingQueryException):
        load("d")


def test_status_stream(spark, tmp_path):
    rows = [("a", "found", "2025-01-01 00:00:00"), ("a", "found", "2025-01-01 00:00:00"), ("b", "error", "2025-01-01 00:10:00")]
    spark.createDataFrame(rows, "url string, status string, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.parquet(str(tmp_path / "log"))
    log = spark.readStream.schema("url string, status string, at timestamp").parquet(str(tmp_path / "log"))
    query = status_stream(log, "url", "at", "1 hour").writeStream.format("memory").queryName("seen").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "k")).start()
    query.awaitTermination()
    assert spark.table("seen").count() == 2
    query = windowed_status(log, "at", "0 seconds", "5 minutes").writeStream.format("memory").queryName("windows").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "w")).start()
    query.awaitTermination()
    assert {r["status"]: r.n for r in spark.table("windows").collect()}.get("found") == 2
