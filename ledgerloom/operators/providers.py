"""Models behind plain functions: classification, question understanding and embeddings in batches.

A provider takes a list of texts and returns a list of results of the same length.  It runs inside
tasks, is asked again after a failure, and a batch that keeps failing gives rows with an error;
the run goes on.  Outward calls are at least once: key their effects by the row's key.
"""

from __future__ import annotations

import json
import re
import time
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.headers import coerce, confidence, known, merge
from ledgerloom.vocabulary import AUTHORITY_LEVELS, JURISDICTIONS, NA, TOPICS

ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 3, 2.0, 20.0
BATCH = 16
CONTENT_CAP = 12_000


def ask(provider: Callable[[Sequence[str]], Sequence], texts: Sequence[str], attempts: int = ATTEMPTS, wait: float = FIRST_WAIT) -> tuple[Sequence, str | None]:
    """The provider's results, or an error after so many attempts with growing waits."""
    error = None
    for n in range(attempts):
        try:
            got = provider(texts)
            if len(got) != len(texts):
                raise ValueError(f"{len(got)} results for {len(texts)} texts")
            return got, None
        except Exception as e:  # noqa: BLE001, any failure of a provider is a failed batch
            error = f"{type(e).__name__}: {e}"[:1000]
            if n + 1 < attempts:
                time.sleep(min(LONGEST_WAIT, wait * 2**n))
    return [None] * len(texts), error


def answered(rows: DataFrame, key: str, text: str, provider: Callable[[Sequence[str]], Sequence[dict | None]], *, size: int = BATCH, attempts: int = ATTEMPTS, wait: float = FIRST_WAIT) -> DataFrame:
    """``(key, answer, error)``: the provider's answers as JSON, asked in batches of ``BATCH``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), size):
                part = batch.iloc[begin : begin + size]
                got, error = ask(provider, [t or "" for t in part["text"]], attempts, wait)
                yield pd.DataFrame({"key": part["key"], "answer": [None if g is None else json.dumps(g) for g in got], "error": [error] * len(part)})

    return rows.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(run, "key string, answer string, error string")


def prompt(file: Column, kind: Column, subject: Column, participants: Column, content: Column) -> Column:
    """What a classifier is told of a document: at most ten participants and the head of its text."""
    people = F.array_join(F.slice(F.array_sort(F.array_distinct(participants)), 1, 10), ", ")
    return F.concat_ws("\n", F.concat(F.lit("File: "), file), F.concat(F.lit("Type: "), kind), F.concat(F.lit("Subject: "), subject), F.concat(F.lit("Participants: "), people), F.lit(""), F.substring(content, 1, CONTENT_CAP))


def classified(documents: DataFrame, answers: DataFrame) -> DataFrame:
    """Documents (with ``document_id, scenario_id, tax_year``) and the labels of their answers, mapped to the closed lists.

    What a document knows of its scenario and year stays; failed answers keep ``n/a`` and the error.
    """
    field = lambda name: F.get_json_object("answer", f"$.{name}")
    joined = documents.join(answers.withColumnRenamed("key", "document_id"), "document_id", "left")
    status = F.when(F.col("answer").isNotNull(), "ok").when(F.col("error").isNotNull(), "failed").otherwise("skipped")
    return joined.select(
        "document_id",
        status.alias("enrichment_status"),
        coerce(field("tax_topic"), TOPICS, "Other").alias("tax_topic"),
        coerce(field("jurisdiction"), JURISDICTIONS).alias("jurisdiction"),
        coerce(field("authority_level"), AUTHORITY_LEVELS).alias("authority_level"),
        F.substring(known(field("legal_entity")), 1, 200).alias("legal_entity"),
        merge(known(field("scenario_id")), F.col("scenario_id")).alias("scenario_id"),
        merge(known(field("tax_year")), F.col("tax_year")).alias("tax_year"),
        confidence(field("confidence")).alias("confidence"),
        "error",
    )


#: A draft of an understood question: these fields and no others.
DRAFT_FIELDS = ["intent", "topic", "subtopic", "entities", "jurisdictions", "material_facts", "internal_search_query", "external_search_query", "clarification_needed"]
ALIASES = {"entity": "entities", "jurisdiction": "jurisdictions", "facts": "material_facts"}


def understood(answers: DataFrame) -> DataFrame:
    """``answers(key, answer)`` to typed drafts: single values become lists, blanks go, unknown fields are named."""
    parsed = answers.select("key", F.from_json("answer", "map<string,string>").alias("m"))

    def listed(name: str) -> Column:
        raw = F.coalesce(F.try_element_at("m", F.lit(name)), *(F.try_element_at("m", F.lit(a)) for a, n in ALIASES.items() if n == name))
        many = F.coalesce(F.from_json(F.when(raw.startswith("["), raw), "array<string>"), F.array(raw))
        return F.filter(F.transform(many, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))

    value = lambda name: F.nullif(F.trim(F.try_element_at("m", F.lit(name))), F.lit(""))
    allowed = F.array(*(F.lit(f) for f in [*DRAFT_FIELDS, *ALIASES]))
    return parsed.select(
        F.col("key").alias("request_id"),
        value("intent").alias("intent"),
        value("topic").alias("topic"),
        listed("entities").alias("entities"),
        listed("jurisdictions").alias("jurisdictions"),
        listed("material_facts").alias("material_facts"),
        value("internal_search_query").alias("internal_search_query"),
        F.array_except(F.map_keys("m"), allowed).alias("unknown_fields"),
    )


def hash_vector(text: str | None, width: int) -> list[float] | None:
    """A unit vector of hashed words: an embedding without a model.  NULL and blank texts have none."""
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return None
    out = np.zeros(width)
    for w in words:
        code = zlib.crc32(w.encode())
        out[code % width] += 1.0 if code >> 31 else -1.0
    size = np.linalg.norm(out)
    return (out / size).tolist() if size else None


def embedder(width: int = 64, embed: Callable[[str | None, int], list[float] | None] = hash_vector):
    """An Arrow function from texts to vectors; vectors of another width are an error."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(text: pd.Series) -> pd.Series:
        vectors = text.map(lambda t: embed(t, width))
        if any(v is not None and len(v) != width for v in vectors):
            raise ValueError(f"vectors must have {width} values")
        return vectors

    return run


def hit_at(ranked: Column, wanted: Column, k: int) -> Column:
    """Whether one of the first ``k`` sources is wanted."""
    return F.coalesce(F.arrays_overlap(F.slice(ranked, 1, k), wanted), F.lit(False))


def varying_fields(runs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``(key, field, values)``: how many different values repeated runs gave."""
    counts = runs.groupBy(key).agg(*(F.countDistinct(F.coalesce(F.col(f).cast("string"), F.lit(NA))).alias(f) for f in fields))
    return counts.unpivot([key], fields, "field", "values")
