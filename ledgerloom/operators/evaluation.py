"""Scores of classified questions and counters of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intent_accuracy(cases: DataFrame) -> DataFrame:
    """Accuracy over cases without an error; NULL where nothing was scored."""
    scored, right = F.col("error").isNull(), F.col("expected_intent") == F.col("actual_intent")
    return cases.agg(F.count("*").alias("cases"), F.count_if(scored).alias("scored"), F.count_if(scored & F.coalesce(right, F.lit(False))).alias("correct"), F.round(F.avg(F.when(scored, F.coalesce(right, F.lit(False)).cast("double"))), 4).alias("accuracy"))


def confusion(cases: DataFrame) -> DataFrame:
    wrong = cases.where("error is null and actual_intent is not null and expected_intent <> actual_intent")
    return wrong.groupBy("expected_intent", "actual_intent").agg(F.count("*").alias("n"))


def run_summary(documents: DataFrame) -> DataFrame:
    """Documents by enrichment status and kind."""
    return documents.groupBy(F.col("metadata.enrichment_status").alias("status"), F.col("metadata.source_type").alias("source_type")).agg(F.count("*").alias("documents"), F.sum("char_count").alias("chars"))


def field_coverage(documents: DataFrame, fields: list[str]) -> DataFrame:
    """``(field, known, total)``: how often a metadata field says something."""
    counts = [F.count_if(~F.coalesce(F.col(f"metadata.{f}"), F.lit("n/a")).isin("", "n/a")).alias(f) for f in fields]
    return documents.agg(*counts, F.count("*").alias("total")).unpivot(["total"], fields, "field", "known").select("field", "known", "total")


def critical_cases(cases: DataFrame, ids: list[str]) -> DataFrame:
    """``(test_id, scored, correct)`` of the cases that must not fail."""
    right = F.coalesce(F.col("expected_intent") == F.col("actual_intent"), F.lit(False))
    return cases.where(F.col("test_id").isin(ids)).select("test_id", F.col("error").isNull().alias("scored"), (F.col("error").isNull() & right).alias("correct"))
