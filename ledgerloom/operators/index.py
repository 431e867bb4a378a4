"""A keyed index of Parquet rows: upsert, latest status, clearing, unchanged inputs, write checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.vocabulary import FACETS, INDEX_FIELDS, REQUIRED_ON_WRITE


def latest(log: DataFrame, keys: list[str], at: str, ties: list[str]) -> DataFrame:
    """The last row of each key: an aggregate that combines before it moves, so that no hot key is sorted."""
    rest = [c for c in log.columns if c not in keys]
    order = F.struct(at, *ties)
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("row")).select(*keys, "row.*")


def status_view(log: DataFrame) -> DataFrame:
    """``log(document_id, status, at, error)`` to the present status of each document with its first and last moment."""
    order = F.struct("at", "status")
    return log.groupBy("document_id").agg(F.max_by("status", order).alias("status"), F.min("at").alias("created"), F.max("at").alias("updated"), F.substring(F.max_by("error", order), 1, 1000).alias("error"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows in place of old ones of the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def clear(rows: DataFrame, condition: Column) -> DataFrame:
    """What is left when the rows that meet the condition are deleted; unknown is kept."""
    return rows.where(~F.coalesce(condition, F.lit(False)))


def unchanged(new: DataFrame, old: DataFrame) -> DataFrame:
    """Documents whose content hash is what it was."""
    return new.join(old.select("document_id", "content_hash").distinct(), ["document_id", "content_hash"], "left_semi")


def orphans(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks of documents that are gone."""
    return chunks.join(documents.select("document_id").distinct(), "document_id", "left_anti")


def missing_on_write(rows: DataFrame, fields: list[str] = REQUIRED_ON_WRITE) -> DataFrame:
    """``(field, missing)``: how many rows lack a required field."""
    lacks = lambda f: F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "") if f in rows.columns else F.lit(True)
    counts = [F.count_if(lacks(f)).alias(f) for f in fields]
    return rows.agg(*counts).unpivot([], fields, "field", "missing")


def schema() -> T.StructType:
    """The index as a schema; what can be done with a field is in its metadata."""
    names = {"k": "key", "s": "searchable", "f": "filterable", "c": "facetable", "o": "sortable"}
    return T.StructType([T.StructField(f, T._parse_datatype_string(kind), metadata={n: c in can for c, n in names.items()}) for f, (kind, can) in INDEX_FIELDS.items()])


def contract(rows: DataFrame) -> DataFrame:
    """``(field, known, total)`` of the fields of the index that ``rows`` has: how many rows say something."""
    here = [f for f in INDEX_FIELDS if f in rows.columns]
    counts = [F.count_if(~F.coalesce(F.col(f).cast("string"), F.lit("")).isin("", "n/a", "[]")).alias(f) for f in here]
    return rows.agg(*counts, F.count("*").alias("total")).unpivot(["total"], here, "field", "known").select("field", "known", "total")


def metadata_rows(documents: DataFrame, facets: list[str] = FACETS, most: int = 32_000) -> DataFrame:
    """A row for each document, the last delivered: its facets, and its metadata as JSON of at most ``most`` characters."""
    rows = documents.select("document_id", "upload_timestamp", *(F.col(f"metadata.{f}").alias(f) for f in facets), F.substring(F.to_json("metadata"), 1, most).alias("metadata_json"))
    return latest(rows.where("document_id is not null"), ["document_id"], "upload_timestamp", ["metadata_json"])


def resolved(rows: DataFrame, asked: DataFrame, key: str, size: int) -> DataFrame:
    """``asked(prefix)``, prefixes of ``size`` characters, to ``(prefix, key, status)``: found, ambiguous or missing."""
    known = rows.select(F.substring(key, 1, size).alias("prefix"), key).distinct().groupBy("prefix").agg(F.count("*").alias("n"), F.min(key).alias(key))
    found = asked.select("prefix").distinct().join(known, "prefix", "left")
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").otherwise("found")
    return found.select("prefix", F.when(F.col("n") == 1, F.col(key)).alias(key), status.alias("status"))


def embedding_preview(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", shown: int = 8) -> DataFrame:
    """Width and first values; never whole vectors."""
    return vectors.select(key, F.size(column).alias("dimensions"), F.slice(column, 1, shown).alias("preview"))


def wrong_width(vectors: DataFrame, width: int, column: str = "embedding") -> DataFrame:
    return vectors.where(F.coalesce(F.size(column), F.lit(-1)) != width)


def manifest_lookup(blobs: DataFrame, manifest: DataFrame) -> DataFrame:
    """The scenarios of each blob: by its full name, else by its base name, else none; repeated keys are united."""
    clean = F.filter(F.coalesce("scenario_ids", F.array().cast("array<string>")), lambda s: s.isNotNull() & ~s.isin("", "n/a"))
    lists = manifest.where("key is not null").select("key", F.explode(clean).alias("s")).groupBy("key").agg(F.array_sort(F.collect_set("s")).alias("ids"))
    by_name = lists.select(F.col("key").alias("name"), F.col("ids").alias("by_name"))
    by_base = lists.select(F.col("key").alias("base"), F.col("ids").alias("by_base"))
    rows = blobs.select("name").distinct().withColumn("base", F.regexp_extract("name", r"([^/]+)$", 1))
    ids = F.coalesce("by_name", "by_base", F.array().cast("array<string>"))
    return rows.join(by_name, "name", "left").join(by_base, "base", "left").select("name", ids.alias("scenario_ids"), F.coalesce(F.get(ids, F.lit(0)), F.lit("n/a")).alias("scenario_id"))
