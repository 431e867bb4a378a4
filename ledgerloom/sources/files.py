"""Files as rows: listing, and text extraction by suffix through a registry of extractors."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator
from email import policy
from email.parser import BytesParser
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.headers import document_type, suffix
from ledgerloom.vocabulary import DOCUMENT_TYPES

EXTRACTED = "path string, text string, extractor string, metadata map<string,string>, error string"
Extractor = Callable[[bytes], tuple[str, dict[str, str]]]


class _Text(HTMLParser):
    """All text nodes but those of scripts and styles."""

    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data: str) -> None:
        if not self.hidden and data.strip():
            self.parts.append(data.strip())


def html_text(raw: str) -> str:
    parser = _Text()
    parser.feed(raw)
    return "\n".join(parser.parts)


def plain(content: bytes) -> tuple[str, dict[str, str]]:
    text = content.decode("utf-8", "replace")
    return text, {"line_count": str(text.count("\n") + 1)}


def table(content: bytes) -> tuple[str, dict[str, str]]:
    text = content.decode("utf-8-sig", "replace")
    rows = list(csv.reader(io.StringIO(text), delimiter="\t" if "\t" in text.split("\n", 1)[0] else ","))
    if not rows:
        raise ValueError("the table is empty")
    shown = [" | ".join(r) for r in rows]
    return "\n".join([shown[0], " | ".join("---" for _ in rows[0]), *shown[1:]]), {"rows": str(len(rows))}


def web_page(content: bytes) -> tuple[str, dict[str, str]]:
    return html_text(content.decode("utf-8", "replace")), {}


def mail(content: bytes) -> tuple[str, dict[str, str]]:
    message = BytesParser(policy=policy.default).parsebytes(content)
    body = message.get_body(("plain", "html"))
    text = body.get_content() if body else ""
    if body and body.get_content_type() == "text/html":
        text = html_text(text)
    heads = [f"{label}: {message[label]}" for label in ("Subject", "From", "To", "Cc", "Date") if message[label]]
    names = [a.get_filename() or "" for a in message.iter_attachments()]
    return "\n".join([*heads, "---", text.strip()]), {"subject": str(message["Subject"] or "n/a"), "attachments": ";".join(names)}


#: Extractors by suffix; parsers of other formats are added by whoever has them.
EXTRACTORS: dict[str, Extractor] = {".txt": plain, ".log": plain, ".json": plain, ".md": plain, ".csv": table, ".tsv": table, ".html": web_page, ".htm": web_page, ".eml": mail}


def list_files(spark: SparkSession, folder: str, prefix: str = "", limit: int | None = None) -> DataFrame:
    """``(path, modified, length, suffix, document_type, supported)``; contents are not read, files of no bytes are not listed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    listed = files.select("path", F.col("modificationTime").alias("modified"), "length").where(F.col("path").contains(prefix))
    listed = listed.withColumns({"suffix": suffix(F.col("path")), "document_type": document_type(F.col("path"))}).withColumn("supported", F.col("suffix").isin(*DOCUMENT_TYPES))
    return listed.orderBy("path").limit(limit) if limit else listed


def _extract(extractors: dict[str, Extractor]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, kind, content in zip(batch["path"], batch["suffix"], batch["content"], strict=True):
                try:
                    text, facts = extractors[kind](bytes(content))
                    rows.append((path, text, kind[1:], facts, None))
                except KeyError:
                    rows.append((path, None, None, {}, f"no extractor for {kind}; there are {', '.join(sorted(extractors))}"))
                except Exception as e:  # noqa: BLE001, a bad file is a failed row and not a failed run
                    rows.append((path, None, kind[1:], {}, f"{type(e).__name__}: {e}"[:1000]))
            yield pd.DataFrame(rows, columns=["path", "text", "extractor", "metadata", "error"])

    return run


def extract_files(spark: SparkSession, folder: str, extra: dict[str, Extractor] | None = None) -> DataFrame:
    """The text of every supported file; what fails has an error instead."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", suffix(F.col("path")).alias("suffix"), "content")
    return files.where(F.col("suffix").isin(*DOCUMENT_TYPES)).mapInPandas(_extract(EXTRACTORS | (extra or {})), EXTRACTED)


def choose_engine(text_chars: Column, mail_signals: Column, has_table: Column) -> Column:
    """The engine for a PDF file, from probes: OCR without a text layer, else text for mails, tables, text."""
    return F.when(text_chars < 100, "pdf_ocr").when(mail_signals >= 2, "pdf_text").when(has_table, "pdf_table").otherwise("pdf_text")
