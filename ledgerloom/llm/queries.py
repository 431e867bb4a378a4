"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import table

from . import history, leaks, names, near_duplicates, packing, private_data, scan_noise, subjects

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with its SQL where there is one."""

    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


@query()
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails, and documents, whose three-word sequences agree by 60 % or more."""
    records = near_duplicates.text_records(table(spark, sf_dir, "email_messages"), table(spark, sf_dir, "normalized_docs"))
    return near_duplicates.near_duplicate_pairs(records).select("id_a", "id_b")


@query()
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running heads, page numbers, broken and misread words in scanned records."""
    return scan_noise.noise_lines(table(spark, sf_dir, "extracted"), table(spark, sf_dir, "normalized_docs"))


@query()
def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned records as continuous paragraphs."""
    return scan_noise.repaired(table(spark, sf_dir, "extracted"), table(spark, sf_dir, "normalized_docs"))


@query()
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the sender of each mail newly wrote."""
    return history.newly_written(history.mail_texts(table(spark, sf_dir, "email_messages"), table(spark, sf_dir, "extracted")))


@query()
def p3_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines each step removes from the mails."""
    return history.removed_lines(history.mail_texts(table(spark, sf_dir, "email_messages"), table(spark, sf_dir, "extracted")))


@query()
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of senders and recipients that mean the same person or organisation."""
    return names.name_pairs(names.name_strings(table(spark, sf_dir, "email_messages")))


def _private(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    messages, documents = table(spark, sf_dir, "email_messages"), table(spark, sf_dir, "normalized_docs")
    records = near_duplicates.text_records(messages, documents).select(F.col("id").alias("record_id"), "text")
    return records, private_data.name_lexicon(names.name_strings(messages))


@query()
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Private data in mails and documents, as it stands."""
    return private_data.found_values(*_private(spark, sf_dir))


@query()
def p6_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails and documents with typed placeholders in the place of private data."""
    return private_data.redacted(*_private(spark, sf_dir))


_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
_RUNS = "array_to_string(w[k:k + 12], ' ') as run from (select {0}, w, unnest(range(1, len(w) - 11)) as k from {1})"


@query(
    f"""
    with item as (select test_id, {_WORDS.format("t")} as w from (select test_id, unnest([question, passage]) as t from eval_cases where test_id is not null)),
    document as (select doc_id, {_WORDS.format("text")} as w from documents where doc_id is not null),
    i as (select distinct test_id, {_RUNS.format("test_id", "item")}), d as (select distinct doc_id, {_RUNS.format("doc_id", "document")})
    select distinct doc_id, test_id from d join i using (run)
    """
)
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 13 consecutive words of an evaluation item."""
    return leaks.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_cases"))


@query()
def p8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage or question of an evaluation item with about one edit in ten words."""
    found = leaks.near_leaks(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text"), leaks.item_texts(table(spark, sf_dir, "eval_cases")))
    return found.select(F.col("key").cast("bigint").alias("doc_id"), F.col("item").alias("test_id"), F.round("similarity", 4).alias("similarity"))


@query()
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects that a fifth of each document's sentences deal with."""
    return subjects.document_subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels")).select("doc_id", "subject")


@query()
def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in containers of every capacity."""
    return packing.packed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "token_windows"))


@query()
def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each capacity are."""
    windows = table(spark, sf_dir, "token_windows")
    return packing.fill_report(packing.packed(table(spark, sf_dir, "documents"), windows), windows)


@query()
def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How near the packed containers of each capacity come to the mixture of all sources."""
    windows = table(spark, sf_dir, "token_windows")
    return packing.mixture_report(packing.packed(table(spark, sf_dir, "documents"), windows), windows)
