import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning, headers


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


def body(spark, value, **options):
    return cleaning.clean_message_body(spark.createDataFrame([(value,)], "body string"), **options).first()["body"]


def test_redaction(spark):
    assert "[phone removed]" in one(spark, "Call (312) 555-0142 today", cleaning.redact_contact)
    assert one(spark, "311 South Example Drive, Suite 5300", cleaning.redact_contact) == "[address removed]"
    assert one(spark, "Springfield, IL 60606", cleaning.redact_contact) == "[address removed]"
    assert "ana@example.com" in one(spark, "Write to ana@example.com", cleaning.redact_contact)
    assert "[email removed]" in one(spark, "Write to ana@example.com", lambda c: cleaning.redact_contact(c, emails=True))


def test_bodies(spark):
    assert "confidential" not in body(spark, "Body text.\n\nThis e-mail is confidential and intended solely for the addressee.")
    assert "circular" not in body(spark, "Body.\n\nIRS Circular 230 disclosure applies here.").lower()
    assert ">" not in body(spark, "> quoted line\nnormal line")
    assert "PL 86-272" in body(spark, "Under PL 86-272 the work exceeds solicitation.\n\nThanks,\nAna")
    signed = "Thanks Ana.\n\nBest regards,\nJo Smith\nTax Manager\nAcme Inc\n311 South Example Drive\nSpringfield, IL 60606\n(312) 555-0142\njo@example.com"
    kept = cleaning.cut_signature(signed)
    assert "Thanks Ana." in kept and "555-0142" not in kept and "Example Drive" not in kept


def test_documents(spark):
    text = "\n".join(f"Acme Confidential\nBody {c}" for c in "ABCD")
    docs = spark.createDataFrame([(text, "pdf"), (None, "pdf"), ("", "txt")], "content string, document_type string")
    rows = [r["content"] for r in cleaning.clean_document_text(docs).collect()]
    assert "Acme" not in rows[0] and "Body A" in rows[0]
    assert one(spark, "a b\r\nc   d  \n\n\n\ne​ ", cleaning.normalize_whitespace) == "a b\nc  d\n\ne"


def test_long_text_is_linear(spark):
    assert len(one(spark, "12 words and more " * 20_000, cleaning.redact_contact)) > 100


@pytest.mark.parametrize(("value", "want"), [("RE: FW: Re: Illinois nexus", "Illinois nexus"), ("", "n/a"), (None, "n/a"), ("AW: x", "x")])
def test_subjects(spark, value, want):
    assert one(spark, value, headers.normalize_subject) == want


@pytest.mark.parametrize(("value", "want"), [("A B <a@x.com>; C D <c@x.com>", 2), ("Doe, Jane <j@x.com>", 1), ("", 0), (None, 0), ("n/a", 0), ("Doe, Jane <j@x.com>, Roe, Al <a@x.com>", 2)])
def test_recipients(spark, value, want):
    assert len(one(spark, value, headers.split_recipients)) == want


def test_metadata(spark):
    allowed = ["New York", "Texas", "Illinois"]
    assert [one(spark, v, lambda c: headers.coerce(c, allowed)) for v in ("texas", "State of Illinois", "york", "n/a", None, "Mars")] == ["Texas", "Illinois", "New York", "n/a", "n/a", "n/a"]
    assert one(spark, "Tax year: 2024 and FY 2025", cleaning.tax_year) == "2024"
    assert one(spark, "NaN", headers.confidence) == 0.0 and one(spark, "7", headers.confidence) == 1.0 and one(spark, "x", headers.confidence) == 0.0
    assert one(spark, "a-b c d e f g", headers.slug) == "A_B_C_D_E_F"


@pytest.mark.parametrize("line", ["From: a", "**From:** a", "**From: a**", "__From:__ a", "## From: a", "> From: a", "- **From:** a", "-----Original Message-----", "On Mon, Aug 17, 2026, Jo Doe wrote:"])
def test_thread_signals(spark, line):
    assert one(spark, line, headers.thread_signals) == 1


@pytest.mark.parametrize("line", ["prose", "| a | b |", "## Background", "-----", "> The taxpayer"])
def test_no_thread_signals(spark, line):
    assert one(spark, line, headers.thread_signals) == 0
