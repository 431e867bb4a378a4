"""Hybrid search over an index of chunks: typed filters, BM25, vectors, fusion, boosts, facets."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.vocabulary import BOOST_ONLY, FILTERABLE, NA

K1, B = 1.2, 0.75
#: The constant of reciprocal rank fusion (Cormack, Clarke, Buettcher 2009).
FUSION = 60
BOOST = 0.5
#: Vectors compared at once in a task.
BLOCK = 1_000


@dataclass(frozen=True)
class Filters:
    """Hard filters, all of which must hold; ``boost_jurisdictions`` only raises scores."""

    entities: tuple[str, ...] = ()
    business_units: tuple[str, ...] = ()
    tax_topic: str | None = None
    source_ids: tuple[str, ...] = ()
    sent_from: datetime | None = None
    sent_to: datetime | None = None
    boost_jurisdictions: tuple[str, ...] = field(default=())

    def is_empty(self) -> bool:
        return not (self.entities or self.business_units or self.tax_topic or self.source_ids or self.sent_from or self.sent_to)


def assert_filterable(name: str) -> None:
    if name in BOOST_ONLY:
        raise ValueError(f"{name} only boosts, it never filters")
    if name not in FILTERABLE:
        raise ValueError(f"{name} is not filterable")


def any_of(name: str, values: tuple[str, ...]) -> Column:
    """Whether an array column holds one of the values; NULL arrays do not."""
    assert_filterable(name)
    return F.coalesce(F.arrays_overlap(F.col(name), F.array(*(F.lit(v) for v in values))), F.lit(False))


def build_filter(filters: Filters) -> Column | None:
    clauses = []
    if filters.entities:
        clauses.append(any_of("entities", filters.entities))
    if filters.business_units:
        clauses.append(any_of("business_units", filters.business_units))
    if filters.tax_topic:
        assert_filterable("tax_topic")
        clauses.append(F.col("tax_topic") == filters.tax_topic)
    if filters.source_ids:
        clauses.append(F.col("source_id").isin(*filters.source_ids))
    if filters.sent_from:
        clauses.append(F.col("sent_date") >= F.lit(filters.sent_from))
    if filters.sent_to:
        clauses.append(F.col("sent_date") <= F.lit(filters.sent_to))
    return reduce(lambda a, b: a & b, clauses) if clauses else None


def apply_filter(index: DataFrame, filters: Filters) -> DataFrame:
    condition = build_filter(filters)
    return index if condition is None else index.where(condition)


def query_terms(question: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"[a-z0-9]+", question.lower())))


def _times(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == term))


def bm25(chunks: DataFrame, question: str, text: str = "content", key: str = "chunk_id") -> DataFrame:
    """``(key, keyword_score)`` of chunks with a term of the question.

    One scan counts the terms of the question in each chunk where it stands; only the counts of
    matching chunks move, and the statistics of the collection are one aggregate.
    """
    terms = query_terms(question)
    # one array of counts for each text: the transform holds the split words, so that they are made once
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    count = F.transform(F.array(words), lambda w: F.array(F.size(w), *(_times(w, t) for t in terms)))[0]
    counted = chunks.select(key, F.explode(F.array(count)).alias("c")).select(key, F.col("c")[0].alias("length"), *(F.col("c")[n + 1].alias(f"t{n}") for n in range(len(terms))))
    if not terms:
        return counted.select(key, F.lit(0.0).alias("keyword_score")).where(F.lit(False))
    stats = counted.agg(F.count("*").alias("total"), F.avg("length").alias("mean"), *(F.count_if(F.col(f"t{n}") > 0).alias(f"df{n}") for n in range(len(terms))))
    score = F.lit(0.0)
    for n in range(len(terms)):
        idf = F.log(F.lit(1.0) + (F.col("total") - F.col(f"df{n}") + 0.5) / (F.col(f"df{n}") + 0.5))
        score = score + idf * F.col(f"t{n}") * (K1 + 1) / (F.col(f"t{n}") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    found = counted.where(reduce(lambda a, b: a | b, (F.col(f"t{n}") > 0 for n in range(len(terms)))))
    # the statistics are one row: joined by a constant, they travel with each task
    one = found.withColumn("_one", F.lit(1)).join(F.broadcast(stats.withColumn("_one", F.lit(1))), "_one")
    return one.select(key, score.alias("keyword_score"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; NULL where the widths differ or one is a null vector."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda n, v: n + v)
    x, y = a.cast("array<double>"), b.cast("array<double>")
    dot = total(F.zip_with(x, y, lambda p, q: p * q))
    size = F.sqrt(total(F.transform(x, lambda v: v * v))) * F.sqrt(total(F.transform(y, lambda v: v * v)))
    return F.when((F.size(a) == F.size(b)) & (size > 0), dot / size)


def vector_scores(vectors: DataFrame, query: list[float], key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(key, vector_score)`` of every vector, exactly."""
    target = F.array(*(F.lit(float(v)) for v in query))
    return vectors.select(key, cosine(F.col(column), target).alias("vector_score")).where("vector_score is not null")


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for width, same in batch.groupby(batch["vector"].map(len)):
            for k in range(0, len(same), BLOCK):
                part = same.iloc[k : k + BLOCK]
                yield pd.DataFrame({"keys": [part["key"].to_numpy()], "vectors": [np.concatenate(part["vector"].tolist())], "width": [width]})


def _best_of_blocks(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, vectors, asked, queries, width in zip(batch["keys"], batch["vectors"], batch["asked"], batch["queries"], batch["width"], strict=True):
                v, q = (np.asarray(x, np.float64).reshape(-1, width) for x in (vectors, queries))
                scores = (q / np.linalg.norm(q, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
                order = np.lexsort((np.broadcast_to(keys, scores.shape), -scores), axis=1)[:, :k]
                yield pd.DataFrame({"query_id": np.repeat(asked, order.shape[1]), "key": np.asarray(keys)[order].ravel(), "vector_score": np.take_along_axis(scores, order, axis=1).ravel()})

    return run


def vector_top(queries: DataFrame, vectors: DataFrame, k: int, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(query_id, key, vector_score, rank)``: the ``k`` vectors nearest to each query, exactly, ties by key.

    Blocks of queries meet blocks of vectors in tasks, which keep ``k`` of each block for a query; the
    work is that of all pairs.  NULL and null vectors have no neighbours, nor have those of other widths.
    """
    fit = lambda df: df.select(F.col(key).cast("bigint").alias("key"), F.col(column).alias("vector")).where(f"key is not null and size(vector) > 0 and exists(vector, v -> v <> 0) and not exists(vector, v -> v is null)")
    block = lambda df: fit(df).mapInPandas(_blocks, "keys array<bigint>, vectors array<float>, width int")
    asked = block(queries).select(F.col("keys").alias("asked"), F.col("vectors").alias("queries"), F.col("width").alias("query_width"))
    met = block(vectors).crossJoin(asked).where("width <= query_width and width >= query_width").drop("query_width")
    best = met.mapInPandas(_best_of_blocks(k), "query_id bigint, key bigint, vector_score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("vector_score"), "key")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).withColumnRenamed("key", key)


def top(scores: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The ``k`` best, ties by key, with their rank: a limit first, so that ranks need one small window."""
    best = scores.orderBy(F.desc(score), key).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), key)))


def reciprocal_rank_fusion(legs: list[DataFrame], key: str, constant: int = FUSION) -> DataFrame:
    """``(key, fused)`` from ranked lists ``(key, rank)``."""
    every = reduce(DataFrame.unionByName, (leg.select(key, (F.lit(1.0) / (constant + F.col("rank"))).alias("part")) for leg in legs))
    return every.groupBy(key).agg(F.sum("part").alias("fused"))


def boosted(scores: DataFrame, score: str, column: str, values: tuple[str, ...], weight: float = BOOST) -> DataFrame:
    """Scores raised by ``weight`` where an array column holds a value; nothing is left out."""
    if not values:
        return scores
    hit = F.coalesce(F.arrays_overlap(F.col(column), F.array(*(F.lit(v) for v in values))), F.lit(False))
    return scores.withColumn(score, F.col(score) * F.when(hit, 1.0 + weight).otherwise(1.0))


#: Buckets of the hashed vectors.
WIDTH = 256


def hashed_words(chunks: DataFrame, text: str, key: str) -> DataFrame:
    """``(key, bucket, n)``: sparse vectors, the words of each text counted in ``WIDTH`` buckets of their MD5."""
    words = F.explode(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")).alias("word")
    bucket = F.conv(F.substring(F.md5(F.encode("word", "UTF-8")), 1, 2), 16, 10).cast("int")
    return chunks.select(key, words).groupBy(key, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def hashed_scores(chunks: DataFrame, question: str, text: str = "content", key: str = "chunk_id") -> DataFrame:
    """``(key, vector_score)``: the cosine of TF-IDF vectors of hashed words, for chunks that share a bucket with the question.

    A vector leg that needs no model, over the keys of the keyword leg; where embeddings are at
    hand :func:`vector_scores` takes its place.
    """
    counts = hashed_words(chunks, text, key)
    total = chunks.select(F.count("*").cast("double").alias("total"))
    weights = counts.groupBy("bucket").agg(F.count("*").alias("df")).join(F.broadcast(total), F.lit(True)).select("bucket", (F.log((F.col("total") + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    asked = hashed_words(chunks.sparkSession.createDataFrame([(question,)], "question string").withColumn("one", F.lit(1)), "question", "one").select("bucket", F.col("n").alias("q"))
    both = counts.join(F.broadcast(weights), "bucket").join(F.broadcast(asked), "bucket", "left")
    size = F.sqrt(F.sum((F.col("n") * F.col("idf")) ** 2))
    dots = both.groupBy(key).agg(F.sum(F.col("n") * F.coalesce("q", F.lit(0)) * F.col("idf") ** 2).alias("dot"), size.alias("size"))
    asked_size = asked.join(F.broadcast(weights), "bucket").agg(F.sqrt(F.sum((F.col("q") * F.col("idf")) ** 2)).alias("q_size"))
    return dots.where("dot > 0").join(F.broadcast(asked_size), F.lit(True)).select(key, (F.col("dot") / (F.col("size") * F.col("q_size"))).alias("vector_score"))


def hybrid(chunks: DataFrame, question: str, text: str = "content", key: str = "chunk_id", depth: int = 50) -> DataFrame:
    """``(key, fused, total)``: keyword and vector ranks of the same keys fused; ``total`` is how many chunks match at all."""
    words = bm25(chunks, question, text, key).select(key, F.round("keyword_score", 9).alias("s"))
    vectors = hashed_scores(chunks, question, text, key).select(key, F.round("vector_score", 9).alias("s"))
    matched = words.select(key).union(vectors.select(key)).distinct().select(F.count("*").alias("total"))
    fused = reciprocal_rank_fusion([top(words, "s", key, depth), top(vectors, "s", key, depth)], key)
    return fused.join(F.broadcast(matched), F.lit(True))


def search(index: DataFrame, question: str, filters: Filters = Filters(), k: int = 10) -> DataFrame:  # noqa: B008
    """The ``k`` best chunks of the filtered index by keyword and vector, boosts applied, as typed evidence with the ``total`` before the cut."""
    kept = apply_filter(index, filters)
    scored = hybrid(kept, question).join(kept.drop("search_score"), "chunk_id").withColumnRenamed("fused", "search_score")
    best = top(boosted(scored, "search_score", "jurisdictions", filters.boost_jurisdictions), "search_score", "chunk_id", k)
    return evidence(best)


def preview(index: DataFrame, question: str, condition: Column | None = None, k: int = 5, shown: int = 300) -> DataFrame:
    """The best chunks by keyword under any condition, with the first characters of their text."""
    kept = index if condition is None else index.where(condition)
    best = top(bm25(kept, question), "keyword_score", "chunk_id", k)
    return best.join(kept.select("chunk_id", F.substring("content", 1, shown).alias("preview")), "chunk_id").select("rank", "chunk_id", "keyword_score", "preview")


def filters_of(draft: dict) -> Filters:
    """The filters of an understood question: entities and topic must hold, jurisdictions only raise."""
    return Filters(entities=tuple(draft.get("entities") or ()), tax_topic=draft.get("topic") or None, boost_jurisdictions=tuple(draft.get("jurisdictions") or ()))


def search_understood(index: DataFrame, draft: dict, k: int = 10) -> DataFrame:
    return search(index, draft["internal_search_query"], filters_of(draft), k)


def evidence(rows: DataFrame) -> DataFrame:
    """NULL lists empty, unknown types ``OTHER``, unknown states ``UNKNOWN``."""
    lists = ["entities", "business_units", "jurisdictions", "tax_concepts", "material_facts"]
    filled = {c: F.coalesce(c, F.array().cast("array<string>")) for c in lists if c in rows.columns}
    state = F.when(F.coalesce("semantic_state", F.lit(NA)).isin("", NA), F.lit("UNKNOWN")).otherwise(F.col("semantic_state"))
    kind = F.when(F.coalesce("evidence_type", F.lit(NA)).isin("", NA), F.lit("OTHER")).otherwise(F.col("evidence_type"))
    return rows.withColumns(filled | {"semantic_state": state, "evidence_type": kind})


def citation_label() -> Column:
    """By message, else by page, else by file."""
    day = F.coalesce(F.date_format("sent_date", "yyyy-MM-dd"), F.lit("undated"))
    by_message = F.concat(F.col("source_file"), F.lit(" ("), F.coalesce("sender", F.lit("unknown sender")), F.lit(", "), day, F.lit(")"))
    by_page = F.concat(F.col("source_file"), F.lit(", p. "), F.col("page_number").cast("string"))
    return F.when(F.col("message_id").isNotNull(), by_message).when(F.col("page_number").isNotNull(), by_page).otherwise(F.col("source_file"))


def facets(index: DataFrame, names: list[str]) -> DataFrame:
    """``(field, value, n)``: one scan for all fields, counted before anything moves."""
    entries = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in names))).alias("f")
    return index.select(entries).select("f.field", "f.value").where("value is not null").groupBy("field", "value").agg(F.count("*").alias("n"))


def ranked_sources(evidence_rows: DataFrame, score: str = "search_score") -> DataFrame:
    """``(source_id, best_score)`` of sources by their best chunk."""
    return evidence_rows.where(F.col(score).isNotNull()).groupBy("source_id").agg(F.max(score).alias("best_score"))


def source_ranks(ranked: DataFrame) -> DataFrame:
    """``ranked(source_id, rank)`` to each source with its best rank."""
    return ranked.groupBy("source_id").agg(F.min("rank").alias("rank"))


def cited_by_origin(rows: DataFrame, origin: Column) -> DataFrame:
    """``(origin, source_id)``: the different sources of each origin."""
    return rows.select(origin.alias("origin"), "source_id").where("source_id is not null").distinct()


def invented_citations(claims: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Cited sources that were not retrieved: ``claims(request_id, source_id)`` without ``retrieved``."""
    return claims.join(retrieved, ["request_id", "source_id"], "left_anti").distinct()
