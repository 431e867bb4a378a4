"""Files to chunks in stages, with a row of status for each document and stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning, headers, ids
from ledgerloom.operators import chunking, index, threads
from ledgerloom.session import cut_lineage
from ledgerloom.sources import files


def normalize(extracted: DataFrame) -> DataFrame:
    """``extracted(path, text, error)`` to documents with keys, clean content and messages; failures keep their error."""
    kind = headers.document_type(F.col("path"))
    rows = extracted.withColumns({"document_id": ids.document_id(F.col("path")), "document_type": kind, "source_file": F.regexp_extract("path", "([^/]+)$", 1)})
    is_thread = (kind == "email") | ((headers.thread_signals(F.coalesce("text", F.lit(""))) >= 1) & kind.isin("pdf", "docx", "text", "html", "markdown"))
    rows = rows.withColumn("is_email_thread", is_thread).withColumn("subject", F.regexp_extract("text", r"(?im)^subject:[ \t]*(.+?)[ \t]*$", 1))
    rows = rows.withColumn("messages", threads.split_thread("text", "subject"))
    each = threads.cleaned_messages(rows.where("is_email_thread").select("path", F.explode("messages").alias("m")), "path")
    clean = each.groupBy("path").agg(F.array_sort(F.collect_list(F.struct(*threads.MESSAGE.fieldNames()))).alias("clean"))
    none = F.array().cast(rows.schema["messages"].dataType)
    rows = rows.join(clean, "path", "left").withColumn("messages", F.when(F.col("is_email_thread"), F.coalesce("clean", none)).otherwise(F.col("messages"))).drop("clean")
    rows = cleaning.clean_document_text(rows.withColumn("content", F.col("text")))
    content = F.when(F.col("is_email_thread") & (F.size("messages") > 0), threads.render_thread(F.col("messages"))).otherwise(F.col("content"))
    rows = rows.withColumn("content", content).withColumn("error", F.coalesce("error", F.when(F.coalesce(F.col("content"), F.lit("")) == "", F.lit("the document is empty"))))
    return rows.withColumn("content_hash", ids.content_hash(F.col("content")))


def run(spark: SparkSession, folder: str, out: str, *, previous: DataFrame | None = None, previous_index: DataFrame | None = None, force: bool = False, dry_run: bool = False, size: int = chunking.SIZE, overlap: int = chunking.OVERLAP, enrich: Callable[[DataFrame], DataFrame] | None = None, on_enrichment_failure: str = "index_anyway", prefix: str = "", limit: int | None = None) -> DataFrame:
    """List, extract, normalise, enrich and chunk a folder of files; each stage is a table below ``out``.

    Returns the status of each document: ``(document_id, status, chunks, error)``.  Unsupported files
    are skipped, failures go on as rows; a dry run stops after chunking.  Unless forced, unchanged
    documents of ``previous`` keep their chunks of ``previous_index`` and are cut anew where it has
    none; chunks of changed and deleted documents go.  Each run writes the whole index, so ``out`` is
    another folder than that of the run before.  ``enrich`` adds ``enrichment_status``; under the policy ``fail``
    documents whose status is not ``ok`` fail, under ``index_anyway`` they go on.  Keys are stable, so a repeated stage writes the same rows.
    """
    if on_enrichment_failure not in ("index_anyway", "fail"):
        raise ValueError("the policy is index_anyway or fail")
    listed = files.list_files(spark, folder, prefix, limit)
    skipped = listed.where("not supported").select(ids.document_id(F.col("path")).alias("document_id"), F.lit("SKIPPED").alias("status"), F.lit(0).cast("bigint").alias("chunks"), F.lit(None).cast("string").alias("error"))
    extracted = files.extract_files(spark, folder)
    extracted = extracted.join(listed.select("path"), "path", "left_semi") if prefix or limit else extracted
    normalize(extracted).write.mode("overwrite").parquet(f"{out}/normalized")
    documents = spark.read.parquet(f"{out}/normalized")
    good = documents.where("error is null")
    same = index.unchanged(good, previous) if previous is not None and not force else good.where(F.lit(False))
    kept = previous_index.join(same.select("document_id"), "document_id", "left_semi") if previous_index is not None else None
    todo = good.join(kept.select("document_id").distinct(), "document_id", "left_anti") if kept is not None else good
    todo = enrich(todo) if enrich else todo
    refused = todo.select("document_id", F.lit(None).cast("string").alias("guard_error")).where(F.lit(False))
    if enrich:
        guarded = cut_lineage(chunking.enrichment_guard(todo, on_enrichment_failure == "fail"))
        refused, todo = guarded.where("guard_error is not null").select("document_id", "guard_error"), guarded.where("guard_error is null")
    plain = chunking.chunk_documents(todo.where("not is_email_thread or size(messages) = 0"), size, overlap).select("chunk_id", "document_id", "chunk_number", "total_chunks", "content", "token_count", "citation", "chunk_strategy")
    mails = todo.where("is_email_thread").select("document_id", "source_file", F.lit("n/a").alias("author"), F.explode("messages").alias("m")).select("document_id", "source_file", "author", "m.*")
    every = plain.unionByName(chunking.chunk_messages(mails, size, overlap).select(*plain.columns))
    every = every.unionByName(kept.select(*plain.columns)) if kept is not None else every
    every.write.mode("overwrite").parquet(f"{out}/chunks")
    chunks = spark.read.parquet(f"{out}/chunks")
    counts = chunks.groupBy("document_id").agg(F.count("*").alias("chunks"))
    status = F.when(F.col("error").isNotNull(), "FAILED").when(F.col("same").isNotNull(), "UNCHANGED").when(F.lit(dry_run), "DRY_RUN").otherwise("INDEXED")
    documents = documents.join(refused, "document_id", "left").withColumn("error", F.coalesce("error", "guard_error"))
    done = documents.join(same.select("document_id", F.lit(1).alias("same")), "document_id", "left").join(counts, "document_id", "left")
    if not dry_run:
        chunks.write.mode("overwrite").parquet(f"{out}/index")
    return done.select("document_id", status.alias("status"), F.coalesce("chunks", F.lit(0).cast("bigint")).alias("chunks"), "error").unionByName(skipped)
