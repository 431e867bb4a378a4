from ledgerloom.plans import pipeline
from ledgerloom.sources import files
from ledgerloom.streaming import ingest


def _folder(path):
    (path / "memos").mkdir(parents=True)
    (path / "memos/a.txt").write_text("TAX MEMORANDUM\n\n" + "Nexus analysis for fiscal year 2023. " * 40)
    (path / "memos/b.csv").write_text("x,y\n1,2\n")
    (path / "memos/page.html").write_text("<html><script>no</script><body><p>One</p><p>Two words of text</p></body></html>")
    (path / "memos/m.eml").write_text("Subject: Illinois nexus\nFrom: Ana <a@x.com>\nTo: Bo <b@x.com>\nDate: Mon, 17 Aug 2026 09:02:11 -0500\n\nPlease see the memo about nexus.\n")
    (path / "memos/archive.zip").write_bytes(b"PK")
    (path / "memos/s.docx").write_bytes(b"PK")
    return str(path / "memos")


def test_pipeline(spark, tmp_path):
    folder, out = _folder(tmp_path / "in"), str(tmp_path / "out")
    assert files.list_files(spark, folder, limit=2).count() == 2
    status = pipeline.run(spark, folder, out, size=150, overlap=30).collect()
    counts = {s: sum(r["status"] == s for r in status) for s in ("INDEXED", "FAILED", "SKIPPED")}
    assert counts == {"INDEXED": 4, "FAILED": 1, "SKIPPED": 1}
    assert all(r["error"] for r in status if r["status"] == "FAILED")
    previous = spark.read.parquet(f"{out}/normalized")
    again = pipeline.run(spark, folder, str(tmp_path / "again"), previous=previous, size=150, overlap=30).collect()
    assert sum(r["status"] == "UNCHANGED" for r in again) == 4
    dry = pipeline.run(spark, folder, str(tmp_path / "dry"), dry_run=True).collect()
    assert sum(r["status"] == "DRY_RUN" for r in dry) == 4 and not (tmp_path / "dry/index").exists()


def test_rerun_keeps_the_index(spark, tmp_path):
    folder, first, second, third = _folder(tmp_path / "in"), *(str(tmp_path / x) for x in ("first", "second", "third"))
    pipeline.run(spark, folder, first, size=150, overlap=30)
    read = lambda at, table: spark.read.parquet(f"{at}/{table}")
    rows = lambda at: sorted(map(tuple, read(at, "index").select("chunk_id", "content").collect()))
    for old in (read(first, "index"), None):
        again = pipeline.run(spark, folder, second, previous=read(first, "normalized"), previous_index=old, size=150, overlap=30).collect()
        assert rows(second) == rows(first) and all(r["chunks"] > 0 for r in again if r["status"] == "UNCHANGED")
    (tmp_path / "in/memos/b.csv").write_text("x,y\n3,4\n")
    (tmp_path / "in/memos/page.html").unlink()
    status = {r["document_id"]: r["status"] for r in pipeline.run(spark, folder, third, previous=read(first, "normalized"), previous_index=read(first, "index"), size=150, overlap=30).collect()}
    assert sorted(status.values()) == ["FAILED", "INDEXED", "SKIPPED", "UNCHANGED", "UNCHANGED"]
    text = " ".join(c for _, c in rows(third))
    assert "3" in text and "Two words" not in text and "Nexus analysis" in text
    assert {r["document_id"] for r in read(third, "index").collect()} == {d for d, s in status.items() if s in ("INDEXED", "UNCHANGED")}


def test_mails_are_cleaned(spark, tmp_path):
    (tmp_path / "in").mkdir()
    body = "Please call 312-555-0142 about the nexus memo.\n\nBest regards,\nAna Lopez\nTax Manager\nAcme Ltd\n\nThis e-mail is confidential and intended only for you."
    old = "From: Bo Roe <b@x.com>\nSent: Monday, August 17, 2026 9:02 AM\nTo: Ana Lopez <a@x.com>\nSubject: Nexus\n\nThis message is privileged and intended only for the addressee."
    (tmp_path / "in/m.eml").write_text(f"Subject: Nexus\nFrom: Ana Lopez <a@x.com>\nTo: Bo <b@x.com>\nDate: Mon, 17 Aug 2026 10:02:11 -0500\n\n{body}\n\n{old}\n")
    out = str(tmp_path / "out")
    pipeline.run(spark, str(tmp_path / "in"), out)
    row = spark.read.parquet(f"{out}/normalized").first()
    for text in [row["content"], *(m["body"] for m in row["messages"]), *(r["content"] for r in spark.read.parquet(f"{out}/index").collect())]:
        assert "nexus memo" in text or "removed" in text
        assert not any(x in text for x in ("312-555", "Tax Manager", "confidential", "privileged"))


def test_extra_extractor(spark, tmp_path):
    rows = files.extract_files(spark, _folder(tmp_path / "in"), {".docx": lambda content: ("text of a file", {})}).collect()
    assert next(r for r in rows if r["path"].endswith(".docx"))["text"] == "text of a file"


def test_stream(spark, sf, tmp_path):
    source = spark.read.parquet(f"{sf}/email_messages.parquet")
    source.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = ingest.read_messages(spark, str(tmp_path / "in"), f"{sf}/email_messages.parquet")
    ingest.append_messages(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == source.count()
    assert ingest.hourly_volume(stream).isStreaming


def test_enrichment_policy(spark, tmp_path):
    from pyspark.sql import functions as F

    folder = _folder(tmp_path / "in")
    failed = lambda docs: docs.withColumn("enrichment_status", F.when(F.col("path").endswith("a.txt"), "failed").otherwise("ok"))
    for policy, indexed in (("index_anyway", 4), ("fail", 3)):
        status = pipeline.run(spark, folder, str(tmp_path / policy), enrich=failed, on_enrichment_failure=policy).collect()
        assert sum(r["status"] == "INDEXED" for r in status) == indexed
    assert any(r["error"] == "not enriched: failed" for r in status)
    few = pipeline.run(spark, folder, str(tmp_path / "few"), prefix="/memos/", limit=2).collect()
    assert len(few) == 2
