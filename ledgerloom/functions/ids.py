"""Stable identities: the same parts give the same key on any machine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix`` and the SHA-256 of the parts joined by ``|``; NULL if a part is NULL."""
    joined = parts[0].cast("string")
    for p in parts[1:]:
        joined = F.concat(joined, F.lit("|"), p.cast("string"))
    return F.concat(F.lit(prefix), F.sha2(joined, 256))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def document_id(source_path: Column) -> Column:
    return stable_id("doc_", source_path)


def source_id(document: Column) -> Column:
    return stable_id("src_", document)
