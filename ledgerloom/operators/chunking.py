"""Texts cut into citable chunks of about a number of tokens, with an overlap of whole units."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.headers import known
from ledgerloom.functions.ids import stable_id
from ledgerloom.operators.threads import message_header
from ledgerloom.vocabulary import NA

SIZE, OVERLAP = 800, 120
CHARS_PER_TOKEN = 4

PIECES = "array<struct<content:string,char_start:int,token_count:int>>"


def token_count(text: Column) -> Column:
    """Tokens by the rule of four characters; a tokenizer can take its place."""
    return F.greatest(F.lit(1), F.floor(F.char_length(text) / CHARS_PER_TOKEN)).cast("int")


_GAP = re.compile(r"\n\s*\n")
_SENTENCE_GAP = re.compile(r"(?<=[.!?])\s+")


def _between(text: str, gaps: re.Pattern, begin: int, end: int) -> np.ndarray:
    """The spans, one a row, that the gaps leave of ``text[begin:end]``, without blanks at their edges; blank ones go."""
    cuts = [(m.start(), m.end()) for m in gaps.finditer(text, begin, end)]
    edges = np.array([begin, *(x for cut in cuts for x in cut), end], np.int64).reshape(-1, 2)
    inner = [text[x:y] for x, y in edges]
    lead = np.array([len(x) - len(x.lstrip()) for x in inner], np.int64)
    size = np.array([len(x.strip()) for x in inner], np.int64)
    return np.stack([edges[:, 0] + lead, edges[:, 0] + lead + size], axis=1)[size > 0]


def _tokens(sizes: np.ndarray) -> np.ndarray:
    return np.maximum(sizes // CHARS_PER_TOKEN, 1)


def _units(text: str, size: int) -> list[tuple[int, str]]:
    """Where each unit begins, and its text: paragraphs, and of those above ``size`` runs of their sentences.

    A run ends where the prefix sums of sentence lengths pass the size; the last run of a paragraph
    is sliced if it alone is too long.
    """
    out = []
    for begin, end in _between(text, _GAP, 0, len(text)):
        if (end - begin) // CHARS_PER_TOKEN <= size:
            out.append((int(begin), text[begin:end]))
            continue
        sentences = _between(text, _SENTENCE_GAP, begin, end)
        # joined by one blank: a run of sentences i..j has reach[j] - reach[i] - 1 characters
        reach = np.concatenate([[0], np.cumsum(sentences[:, 1] - sentences[:, 0] + 1)])
        room, first = (size + 1) * CHARS_PER_TOKEN, 0
        while first < len(sentences):
            after = max(first + 1, int(np.searchsorted(reach, reach[first] + room, "right")) - 1)
            run = " ".join(text[x:y] for x, y in sentences[first:after])
            at, first = int(sentences[first, 0]), after
            if first < len(sentences) or len(run) < room:
                out.append((at, run))
            else:
                step = size * CHARS_PER_TOKEN
                out += [(at + k, part) for k in range(0, len(run), step) if (part := run[k : k + step].strip())]
    return out


def pieces_of(text: str | None, size: int = SIZE, overlap: int = OVERLAP) -> list[dict]:
    """The chunks of a text and where they begin; NULL and blank texts have none.

    A chunk is a range of units: it ends before the unit that passes the size, and the next one
    begins with the longest suffix of the range whose tokens the overlap holds.
    """
    units = _units(text, size) if text else []
    if not units:
        return []
    total = np.concatenate([[0], np.cumsum(_tokens(np.array([len(u) for _, u in units])))])
    out, first, past = [], 0, 0
    while past < len(units):
        past = max(past + 1, int(np.searchsorted(total, total[first] + size, "right")) - 1)
        content = "\n\n".join(u for _, u in units[first:past])
        out.append({"content": content, "char_start": units[first][0], "token_count": max(len(content) // CHARS_PER_TOKEN, 1)})
        first = max(first, int(np.searchsorted(total, total[past] - overlap, "left")))
    return out


def chunk_pieces(size: int = SIZE, overlap: int = OVERLAP):
    """An Arrow function from texts to their chunks: filling is sequential within a text."""
    if not size > overlap >= 0:
        raise ValueError("the size must exceed the overlap, and the overlap must not be negative")

    @F.pandas_udf(PIECES)
    def cut(text: pd.Series) -> pd.Series:
        return text.map(lambda t: pieces_of(t, size, overlap))

    return cut


def enrichment_guard(documents: DataFrame, required: bool = True) -> DataFrame:
    """``documents(enrichment_status)`` with ``guard_error`` where the enrichment that chunking requires is missing."""
    missing = F.lit(required) & (F.coalesce("enrichment_status", F.lit("")) != "ok")
    return documents.withColumn("guard_error", F.when(missing, F.concat(F.lit("not enriched: "), known(F.col("enrichment_status")))))


def found_at(piece: Column, content: Column, shown: int = 60) -> Column:
    """Where a message's piece begins in the text of its document, by its first characters; 0 where it is not found."""
    return F.greatest(F.lit(0), F.position(F.substring(piece, 1, shown), content) - 1)


def chunk_documents(documents: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """``documents(document_id, source_file, content)`` to chunks with stable keys and citations."""
    cut = documents.withColumn("pieces", chunk_pieces(size, overlap)("content"))
    rows = cut.select("document_id", "source_file", F.size("pieces").alias("total_chunks"), F.posexplode("pieces").alias("at", "piece"))
    number = F.col("at") + 1
    return rows.select(
        stable_id("chk_", F.col("document_id"), number).alias("chunk_id"),
        "document_id",
        number.alias("chunk_number"),
        "total_chunks",
        F.col("piece.content").alias("content"),
        F.col("piece.token_count").alias("token_count"),
        F.col("piece.char_start").alias("char_start"),
        F.concat("source_file", F.lit("#chunk="), number.cast("string")).alias("citation"),
        F.lit("token").alias("chunk_strategy"),
    )


def message_citation(file: Column, index: Column, page: Column, part: Column, parts: Column) -> Column:
    page_part = F.when(page.isNotNull(), F.concat(F.lit("&page="), page.cast("string"))).otherwise(F.lit(""))
    number = F.when(parts > 1, F.concat(F.lit("&part="), part.cast("string"))).otherwise(F.lit(""))
    return F.concat(file, F.lit("#message="), index.cast("string"), page_part, number)


def chunk_messages(messages: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Messages (with ``document_id, source_file, author``) to a chunk each, or more where one is too long."""
    head = message_header(F.col("sender"), F.col("recipients"), F.col("cc"), F.col("message_date"), F.col("subject"))
    cut = messages.withColumns({"head": head, "pieces": chunk_pieces(size, overlap)("body")}).where(F.size("pieces") > 0)
    rows = cut.select("*", F.size("pieces").alias("parts"), F.posexplode("pieces").alias("at", "piece")).withColumn("part", F.col("at") + 1)
    in_document = Window.partitionBy("document_id")
    content = F.concat(F.col("head"), F.lit("\n\n"), F.col("piece.content"))
    return rows.select(
        stable_id("chk_", F.col("document_id"), F.lit("msg"), F.col("message_index"), F.col("part")).alias("chunk_id"),
        "document_id",
        F.row_number().over(in_document.orderBy("message_index", "part")).alias("chunk_number"),
        F.count("*").over(in_document).alias("total_chunks"),
        content.alias("content"),
        token_count(content).alias("token_count"),
        F.when(F.col("sender").isin("", NA) | F.col("sender").isNull(), known(F.col("author"))).otherwise(F.col("sender")).alias("author"),
        "message_index",
        F.col("piece.content").alias("piece"),
        message_citation(F.col("source_file"), F.col("message_index"), F.col("page_number"), F.col("part"), F.col("parts")).alias("citation"),
        F.lit("email_message").alias("chunk_strategy"),
    )


def chunk_stats(chunks: DataFrame, size: int = SIZE) -> DataFrame:
    return chunks.groupBy("chunk_strategy").agg(
        F.count("*").alias("chunks"),
        F.min("token_count").alias("least"),
        F.floor(F.avg("token_count")).alias("average"),
        F.max("token_count").alias("most"),
        F.count_if(F.col("token_count") > size).alias("over_budget"),
    )
