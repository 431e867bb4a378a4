"""The registered queries of the core, each over the whole of its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning, headers, ids
from ledgerloom.operators import chunking, evaluation, index, instants, providers, search, threads
from ledgerloom.registry import ORACLE_SQL, QUERIES, query
from ledgerloom.session import spread, table
from ledgerloom.vocabulary import DOCUMENT_TYPES, FACETS, JURISDICTION_ALIASES, JURISDICTIONS, NA, SOURCE_TYPES

__all__ = ["ORACLE_SQL", "QUERIES"]

#: The question of the search queries.
QUESTION = "payroll factor of the combined group"
_WORDS = "list_filter(regexp_split_to_array(lower(coalesce({0}, '')), '[^a-z0-9]+'), lambda w: w <> '')"


def _case(mapping: dict[str, str], key: str, other: str) -> str:
    return f"case {key} " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + f" else '{other}' end"


_SUFFIX = r"lower(regexp_extract(name, '(\.[^./]+)$', 1))"


@query()
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The UTC instant of every mail and document."""
    names = ("email_messages", "normalized_docs", "sites")
    return instants.record_instants(*(table(spark, sf_dir, n) for n in names)).select("record_id", "instant")


# ---------------------------------------------------------------- sources and identity


@query(f"select name, {_SUFFIX} as suffix, {_case(DOCUMENT_TYPES, _SUFFIX, 'unknown')} as document_type, {_SUFFIX} in ({', '.join(repr(s) for s in DOCUMENT_TYPES)}) as supported from blobs")
def s4_supported_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every blob with its suffix and document type, and whether an extractor takes it."""
    name = F.col("name")
    return table(spark, sf_dir, "blobs").select("name", headers.suffix(name).alias("suffix"), headers.document_type(name).alias("document_type"), headers.suffix(name).isin(*DOCUMENT_TYPES).alias("supported"))


@query(r"select name, 'doc_' || sha256('tax-source/' || name) as document_id, 'src_' || sha256('doc_' || sha256('tax-source/' || name)) as source_id, regexp_replace(name, '[^\p{L}\p{N}._-]', '_', 'g') as safe_name from blobs")
def s17_blob_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable keys and a safe file name of every blob."""
    document = ids.document_id(F.concat(F.lit("tax-source/"), "name"))
    safe = F.regexp_replace("name", r"[^\p{L}\p{N}._-]", "_")
    return table(spark, sf_dir, "blobs").select("name", document.alias("document_id"), ids.source_id(document).alias("source_id"), safe.alias("safe_name"))


@query("select document_id, document_id = 'doc_' || sha256(source_path) as id_agrees, sha256(content) as content_hash, length(content) as chars from normalized_docs")
def n6_content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, content hash and length of every document, computed again."""
    docs = table(spark, sf_dir, "normalized_docs")
    return docs.select("document_id", (F.col("document_id") == ids.document_id(F.col("source_path"))).alias("id_agrees"), ids.content_hash(F.col("content")).alias("content_hash"), F.char_length("content").cast("bigint").alias("chars"))


@query(
    """
    with l as (select key, list_sort(list(distinct s)) as ids from (select key, unnest(scenario_ids) as s from manifest where key is not null) where s is not null and s not in ('', 'n/a') group by key),
    b as (select distinct name, regexp_extract(name, '([^/]+)$', 1) as base from blobs)
    select b.name, array_to_string(coalesce(f.ids, g.ids, []), ';') as scenario_ids, coalesce(f.ids[1], g.ids[1], 'n/a') as scenario_id
    from b left join l f on f.key = b.name left join l g on g.key = b.base
    """
)
def n7_manifest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenarios of every blob, by its name or base name."""
    found = index.manifest_lookup(table(spark, sf_dir, "blobs"), table(spark, sf_dir, "manifest"))
    return found.withColumn("scenario_ids", F.array_join("scenario_ids", ";"))


@query(
    r"""
    select document_id, case when is_email_thread then 'Email Thread' else """
    + _case(SOURCE_TYPES, r"lower(regexp_extract(source_path, '(\.[^./]+)$', 1))", "Other")
    + r""" end as source_type,
    coalesce(nullif(regexp_extract(content, '(?i)\b(?:tax\s+year|fiscal\s+year|taxable\s+year|TY|FY)\s*[:\-]?\s*(\d{4})\b', 1), ''),
             nullif(regexp_extract(content, '(?i)\bfor\s+the\s+(?:tax|fiscal)\s+year\s+(?:ended\s+)?\w*\s*(\d{4})\b', 1), ''), 'n/a') as tax_year
    from normalized_docs
    """
)
def n4_document_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source type and first stated tax year of every document."""
    docs = table(spark, sf_dir, "normalized_docs")
    return docs.select("document_id", headers.source_type(F.col("source_path"), F.col("is_email_thread")).alias("source_type"), cleaning.tax_year(F.col("content")).alias("tax_year"))


@query(
    r"""
    with m as (select path, thread_subject, list_sort(list_transform(messages, lambda x: {'i': x.message_index, 'd': x.message_date, 's': x.sender})) as ms from extracted where is_email_thread),
    k as (select path, thread_subject, len(ms) as n, list_filter(ms, lambda x: x.d is not null and x.d not in ('', 'n/a')) as ds, list_filter(ms, lambda x: x.s is not null and x.s not in ('', 'n/a')) as ss from m)
    select path, coalesce(ds[1].d, 'n/a') as source_date, coalesce(ds[-1].d, 'n/a') as message_date, coalesce(ss[1].s, 'n/a') as author,
    coalesce(nullif(trim(regexp_replace(coalesce(thread_subject, ''), '(?i)^(\s*(re|fw|fwd|aw|antwort)\s*:\s*)+', '')), ''), 'n/a') as thread_subject, n as message_count from k
    """
)
def n3_thread_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last date, author and subject of every thread."""
    return threads.thread_facts(table(spark, sf_dir, "extracted"))


@query(
    """
    select distinct e.document_id from (select 'doc_' || sha256(source_path) as document_id, sha256(text) as content_hash from extracted) e
    join normalized_docs n on n.document_id = e.document_id and n.content_hash = e.content_hash
    """
)
def n9_unchanged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted files whose text is what was normalised before: a rerun leaves them alone."""
    new = table(spark, sf_dir, "extracted").select(ids.document_id(F.col("source_path")).alias("document_id"), ids.content_hash(F.col("text")).alias("content_hash"))
    return index.unchanged(new, table(spark, sf_dir, "normalized_docs")).select("document_id").distinct()


# ---------------------------------------------------------------- cleaning


@query(
    rf"""
    select message_id, ingested_ts, regexp_replace(regexp_replace(body, '{cleaning.PHONE}', '[phone removed]', 'g'), '{cleaning.EMAIL}', '[email removed]', 'g') as redacted from email_messages
    """
)
def c3_redacted_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails without phone numbers and addresses of mail."""
    body = cleaning.redact_emails(cleaning.redact_phones(F.col("body")))
    return table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", body.alias("redacted"))


@query(rf"select message_id, ingested_ts, regexp_replace(body, '{cleaning.DISCLAIMER}', chr(10) || '[disclaimer removed]') as body from email_messages")
def c2_without_disclaimers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails cut at their first disclaimer."""
    return table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", cleaning.strip_disclaimers(F.col("body")).alias("body"))


@query(r"select message_id, ingested_ts, regexp_replace(body, '(?m)^\s*>+\s?', '', 'g') as body from email_messages")
def c13_without_quote_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails without the marks of quoted lines."""
    return table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", cleaning.strip_quote_marks(F.col("body")).alias("body"))


@query(
    r"""
    select path, line, count(*) as n from (select path, text, trim(unnest(string_split(text, chr(10))), ' ') as line from extracted)
    where length(line) between 4 and 89 and not regexp_matches(line, '^[#|*-]') group by path, text, line having count(*) >= 4
    """
)
def c12_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a text has four times or more: heads and feet of pages."""
    lines = table(spark, sf_dir, "extracted").select("path", F.xxhash64("text").alias("text"), F.monotonically_increasing_id().alias("row"), F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.trim("line"))
    kept = lines.where(F.length("line").between(4, 89) & ~F.col("line").rlike(r"^[#|*-]"))
    counted = kept.groupBy("path", "text", "row", "line").agg(F.count("*").alias("once"))
    return counted.groupBy("path", "text", "line").agg(F.sum("once").alias("n")).where("n >= 4").select("path", "line", "n")


@query()
def c14_clean_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails after all steps of cleaning."""
    return cleaning.clean_message_body(spread(table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", F.col("body").alias("clean"))), "clean")


@query()
def c15_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after all steps of cleaning."""
    docs = table(spark, sf_dir, "normalized_docs").select("document_id", "document_type", F.col("content").alias("clean"))
    return cleaning.clean_document_text(docs, "clean").select("document_id", "clean")


@query()
def c16_cleaning_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines cleaning removes or redacts, by document type."""
    docs = table(spark, sf_dir, "normalized_docs").select("document_type", "content", F.col("content").alias("clean"))
    both = cleaning.clean_document_text(docs, "clean")
    before, after = F.split("content", "\n"), F.split("clean", "\n")
    counts = both.select("document_type", F.size(F.array_except(before, after)).alias("removed"), F.size(F.filter(after, lambda x: x.contains(" removed]"))).alias("redacted"))
    return counts.groupBy("document_type").agg(F.sum("removed").alias("lines_removed"), F.sum("redacted").alias("lines_redacted"))


# ---------------------------------------------------------------- headers and threads


@query(
    r"""
    with l as (select distinct path, unnest(string_split(text, chr(10))) as line from extracted),
    h as (select path, line, trim(regexp_extract(line, '^(?:To|Cc): (.*)$', 1)) as v from l where regexp_matches(line, '^(To|Cc): '))
    select path, line, array_to_string(list_filter(list_transform(case when contains(v, ';') then string_split(v, ';')
        else string_split(regexp_replace(regexp_replace(v, '([@<][^,]*),', '\1;', 'g'), '\s*,\s*', ', ', 'g'), ';') end, lambda p: trim(p)), lambda p: p <> ''), '|') as recipients
    from h where v not in ('', 'n/a')
    """
)
def e5_recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every recipient header in the text of every file, split at semicolons or commas."""
    lines = table(spark, sf_dir, "extracted").select("path", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike("^(To|Cc): ")).distinct()
    value = lines.withColumn("v", F.trim(F.regexp_extract("line", "^(?:To|Cc): (.*)$", 1))).where("v not in ('', 'n/a')")
    return value.select("path", "line", F.array_join(headers.split_recipients(F.col("v")), "|").alias("recipients"))


@query(r"select message_id, ingested_ts, coalesce(nullif(trim(regexp_replace(coalesce(subject, ''), '(?i)^(\s*(re|fw|fwd|aw|antwort)\s*:\s*)+', '')), ''), 'n/a') as thread_subject from email_messages")
def e11_thread_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects without their prefixes."""
    return table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", headers.normalize_subject(F.col("subject")).alias("thread_subject"))


@query(
    r"""
    select message_id, ingested_ts, t = '' or regexp_matches(t, '^\s*<?[\w.+-]+@[\w.-]+>?\s*$')
      or (coalesce(sender, '') in ('', 'n/a') and length(t) < 25 and (regexp_matches(t, '^\s*[A-Z][\w.''-]+(?:,\s*[A-Z][\w.''-]+){0,2}\s*$') or length(t) < 15)) as junk
    from (select message_id, ingested_ts, sender, trim(coalesce(body, '')) as t from email_messages)
    """
)
def e6_junk_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which messages are artefacts of an export."""
    return table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", headers.is_junk(F.col("sender"), F.col("body")).alias("junk"))


@query()
def e8_split_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages found in the text of every thread file, by their own headers."""
    files = spread(table(spark, sf_dir, "extracted").where("is_email_thread").select(F.col("path").alias("document_id"), "text", F.col("thread_subject").alias("subject")))
    return threads.thread_messages(files).select("document_id", "message_index", "sender", "message_date", "subject", F.length("body").alias("chars"))


@query(
    r"""
    with h as (select path, list_transform(messages, lambda m: concat_ws(chr(10), '[Message ' || m.message_index::varchar || ']',
        case when coalesce(m.sender, 'n/a') not in ('', 'n/a') then 'From: ' || m.sender end, case when array_to_string(coalesce(m.recipients, []), '; ') not in ('', 'n/a') then 'To: ' || array_to_string(m.recipients, '; ') end,
        case when array_to_string(coalesce(m.cc, []), '; ') not in ('', 'n/a') then 'Cc: ' || array_to_string(m.cc, '; ') end, case when coalesce(m.message_date, 'n/a') not in ('', 'n/a') then 'Date: ' || m.message_date end,
        case when coalesce(m.subject, 'n/a') not in ('', 'n/a') then 'Subject: ' || m.subject end, chr(10) || coalesce(m.body, ''))) as parts from extracted where is_email_thread)
    select path, array_to_string(parts, chr(10) || chr(10) || '---' || chr(10) || chr(10)) as rendered from h
    """
)
def e10_rendered_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thread as one text."""
    return table(spark, sf_dir, "extracted").where("is_email_thread").select("path", threads.render_thread(F.col("messages")).alias("rendered"))


@query(
    r"""
    select e.event_id, e.user_id, e.ts, p.value as last_purchase from events e asof left join
    (select user_id, ts, max(value) as value from events where event_type = 'purchase' group by user_id, ts) p on e.user_id = p.user_id and e.ts >= p.ts where e.event_type <> 'purchase'
    """
)
def e13_asof_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last purchase of its user at or before it: the as-of join of page lookups."""
    events = table(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("last_purchase"))
    rest = events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    return threads.asof_backward(rest, bought, ["user_id"], "ts", ["last_purchase"])


# ---------------------------------------------------------------- metadata


def _coerce_sql(column: str) -> str:
    allowed = "[" + ", ".join(f"'{a}'" for a in JURISDICTIONS) + "]"
    return (
        f"case when t is null or t in ('', 'n/a', 'none', 'null', 'unknown', 'na') then 'n/a' else coalesce(list_filter({allowed}, lambda a: lower(a) = t)[1], "
        f"list_filter({allowed}, lambda a: contains(lower(a), t) or contains(t, lower(a)))[1], 'n/a') end"
    )


@query(f"select document_id, raw, {_coerce_sql('raw')} as jurisdiction from (select document_id, metadata.jurisdiction as raw, lower(trim(metadata.jurisdiction)) as t from normalized_docs)")
def m4_coerced_jurisdictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jurisdictions mapped to the closed list."""
    docs = table(spark, sf_dir, "normalized_docs").select("document_id", F.col("metadata.jurisdiction").alias("raw"))
    return docs.withColumn("jurisdiction", headers.coerce(F.col("raw"), JURISDICTIONS))


@query(
    r"""
    select document_id, case when len(w) = 0 then 'n/a' else array_to_string(w[1:6], '_') end as slug, greatest(0.0::double, least(1.0::double, coalesce(c, 0.0::double))) as confidence
    from (select document_id, list_filter(string_split(upper(regexp_replace(coalesce(metadata.thread_subject, ''), '[^A-Za-z0-9]+', '_', 'g')), '_'), lambda x: x <> '') as w, metadata.enrichment_confidence as c from normalized_docs)
    """
)
def m7_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenario slugs and clamped confidences."""
    docs = table(spark, sf_dir, "normalized_docs")
    return docs.select("document_id", headers.slug(F.col("metadata.thread_subject")).alias("slug"), headers.confidence(F.col("metadata.enrichment_confidence").cast("string")).alias("confidence"))


@query("select path, array_to_string(list_sort(list_distinct(list_filter(list_transform(messages, lambda m: m.sender), lambda s: s is not null and s not in ('', 'n/a')))), '|') as participants from extracted where is_email_thread")
def m9_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known senders of every thread, sorted."""
    senders = F.filter(F.transform("messages", lambda m: m["sender"]), lambda s: s.isNotNull() & ~s.isin("", NA))
    return table(spark, sf_dir, "extracted").where("is_email_thread").select("path", F.array_join(F.array_sort(F.array_distinct(senders)), "|").alias("participants"))


# ---------------------------------------------------------------- chunks


@query()
def k11_token_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are no threads, in chunks."""
    docs = table(spark, sf_dir, "normalized_docs").where("not is_email_thread").select("document_id", F.col("source_file_name").alias("source_file"), "content").dropDuplicates(["document_id"])
    return chunking.chunk_documents(docs).select("chunk_id", "document_id", "chunk_number", "total_chunks", "token_count", "char_start", "citation")


def _message_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = index.latest(table(spark, sf_dir, "email_messages"), ["message_id"], "ingested_ts", ["body"])
    authors = table(spark, sf_dir, "normalized_docs").groupBy("document_id").agg(F.min("metadata.author").alias("author"), F.min("source_file_name").alias("source_file"))
    return chunking.chunk_messages(messages.join(authors, "document_id", "left").withColumn("source_file", F.coalesce("source_file", F.lit(NA))))


@query()
def k6_message_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as chunks with their heads and citations."""
    return _message_chunks(spark, sf_dir).select("chunk_id", "document_id", "chunk_number", "total_chunks", "author", "token_count", "citation")


@query()
def k14_chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of chunks by strategy."""
    docs = table(spark, sf_dir, "normalized_docs").where("not is_email_thread").select("document_id", F.col("source_file_name").alias("source_file"), "content").dropDuplicates(["document_id"])
    every = chunking.chunk_documents(docs).select("chunk_strategy", "token_count").unionByName(_message_chunks(spark, sf_dir).select("chunk_strategy", "token_count"))
    return chunking.chunk_stats(every)


@query("select document_id, greatest(1, length(content) // 4)::integer as tokens from normalized_docs where content is not null")
def k2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the four-character rule."""
    return table(spark, sf_dir, "normalized_docs").where("content is not null").select("document_id", chunking.token_count(F.col("content")).alias("tokens"))


@query(
    r"""
    with n as (select message_id, ingested_ts, list_transform(coalesce(recipients, []), lambda r: trim(regexp_replace(r, '<[^>]*>', '', 'g'))) as names from email_messages),
    m as (select message_id, ingested_ts, list_transform(names, lambda s: case when regexp_matches(s, '^\S+@\S+$') then split_part(s, '@', 1) else s end) as names from n)
    select message_id, ingested_ts, array_to_string(names[1:4], ', ') || case when len(names) > 4 then ' (+' || (len(names) - 4)::varchar || ' more)' else '' end as shown from m
    """
)
def k9_recipient_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipients as the head of a chunk shows them."""
    return table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", headers.format_recipients(F.col("recipients")).alias("shown"))


# ---------------------------------------------------------------- search

_TERMS = search.query_terms(QUESTION)
_BM25 = f"""
    with w as (select chunk_id, {_WORDS.format("content")} as ws from search_docs),
    c as (select chunk_id, len(ws) as l, {", ".join(f"len(list_filter(ws, lambda x: x = '{t}')) as t{n}" for n, t in enumerate(_TERMS))} from w),
    s as (select count(*)::double as total, avg(l) as mean, {", ".join(f"(count(*) filter (t{n} > 0))::double as df{n}" for n in range(len(_TERMS)))} from c),
    k as (select chunk_id, {" + ".join(f"ln(1.0::double + (total - df{n} + 0.5::double) / (df{n} + 0.5::double)) * t{n} * 2.2::double / (t{n} + 1.2::double * (0.25::double + 0.75::double * l / mean))" for n in range(len(_TERMS)))} as score
          from c, s where {" or ".join(f"t{n} > 0" for n in range(len(_TERMS)))})
"""


@query(_BM25 + "select chunk_id, round(score, 6) as score from k order by score desc, chunk_id limit 10")
def q8a_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best chunks for a question by keyword."""
    scores = search.bm25(table(spark, sf_dir, "search_docs"), QUESTION)
    return search.top(scores, "keyword_score", "chunk_id", 10).select("chunk_id", F.round("keyword_score", 6).alias("score"))


_COSINE = """
    q as (select embedding::double[] as e from embeddings order by vec_id limit 1),
    v as (select vec_id, list_dot_product(embedding::double[], q.e) / (sqrt(list_dot_product(embedding::double[], embedding::double[])) * sqrt(list_dot_product(q.e, q.e))) as score from embeddings, q)
"""


def _first_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return table(spark, sf_dir, "embeddings").orderBy("vec_id").select("embedding").first()["embedding"]


@query("with " + _COSINE + "select vec_id, round(score, 6) as score from v order by score desc, vec_id limit 10")
def q8b_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to the first one, exactly."""
    scores = search.vector_scores(table(spark, sf_dir, "embeddings"), _first_vector(spark, sf_dir))
    return search.top(scores, "vector_score", "vec_id", 10).select("vec_id", F.round("vector_score", 6).alias("score"))


@query(
    """
    with v as (select vec_id, embedding::double[] as e from embeddings),
    s as (select q.vec_id as query_id, v.vec_id, list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))) as score from v join v q on q.vec_id % 50 = 0)
    select query_id, vec_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, round(score, 6) as score from s qualify rank <= 10
    """
)
def q8c_vector_topk_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to every vector whose id is divisible by 50, exactly."""
    vectors = table(spark, sf_dir, "embeddings")
    return search.vector_top(vectors.where("vec_id % 50 = 0"), vectors, 10).select("query_id", "vec_id", "rank", F.round("vector_score", 6).alias("score"))


_HYBRID = (
    _BM25
    + f"""
    , tok as (select chunk_id, unnest({_WORDS.format("content")}) as word from search_docs),
    b as (select chunk_id, ('0x' || substr(md5(word), 1, 2))::int as bucket, count(*)::double as n from tok group by all),
    idf as (select bucket, ln(((select count(*) from search_docs)::double + 1) / (count(*) + 1)) + 1 as idf from b group by bucket),
    qb as (select ('0x' || substr(md5(word), 1, 2))::int as bucket, count(*)::double as q from (select unnest({_WORDS.format(f"'{QUESTION}'")}) as word) group by all),
    dots as (select chunk_id, sum(n * coalesce(q, 0) * idf * idf) as dot, sqrt(sum((n * idf) ** 2)) as size from b join idf using (bucket) left join qb using (bucket) group by chunk_id),
    v as (select chunk_id, dot / (size * (select sqrt(sum((q * idf) ** 2)) from qb join idf using (bucket))) as score from dots where dot > 0),
    kr as (select chunk_id, row_number() over (order by round(score, 9) desc, chunk_id) as r from k qualify r <= 50),
    vr as (select chunk_id, row_number() over (order by round(score, 9) desc, chunk_id) as r from v qualify r <= 50),
    fused as (select chunk_id, sum(1.0::double / (60 + r)) as fused from (select * from kr union all select * from vr) group by chunk_id)
    """
)


@query(_HYBRID + "select chunk_id, round(fused, 9) as fused, (select count(*) from (select chunk_id from k union select chunk_id from v)) as total from fused order by round(fused, 9) desc, chunk_id limit 10")
def q8_hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword and vector ranks of the same chunks fused: the ten best, and how many match before the cut."""
    fused = search.hybrid(table(spark, sf_dir, "search_docs"), QUESTION)
    return fused.select("chunk_id", F.round("fused", 9).alias("fused"), "total").orderBy(F.desc("fused"), "chunk_id").limit(10)


@query(
    """
    select chunk_id, tax_topic, sent_date from search_docs where list_has_any(entities, ['Selvane Bearings', 'Hexbridge Logistics'])
    and sent_date >= timestamptz '2020-01-01 00:00:00+00' and sent_date <= timestamptz '2024-12-31 00:00:00+00'
    """
)
def q5_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that name one of two entities, within a range of dates."""
    from datetime import UTC, datetime

    filters = search.Filters(entities=("Selvane Bearings", "Hexbridge Logistics"), sent_from=datetime(2020, 1, 1, tzinfo=UTC), sent_to=datetime(2024, 12, 31, tzinfo=UTC))
    return search.apply_filter(table(spark, sf_dir, "search_docs"), filters).select("chunk_id", "tax_topic", "sent_date")


@query("select chunk_id, round(search_score * case when coalesce(list_has_any(jurisdictions, ['Texas', 'Ohio']), false) then 1.5::double else 1.0::double end, 6) as score from search_docs order by score desc nulls last, chunk_id limit 25")
def q7_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of two jurisdictions raised, none left out."""
    raised = search.boosted(table(spark, sf_dir, "search_docs"), "search_score", "jurisdictions", ("Texas", "Ohio"))
    return raised.select("chunk_id", F.round("search_score", 6).alias("score")).orderBy(F.desc_nulls_last("score"), "chunk_id").limit(25)


_FILTERED = _HYBRID.replace("from search_docs", "from docs").replace("with w as", "with docs as (select * from search_docs where tax_topic = 'Apportionment'), w as", 1)


@query(
    _FILTERED
    + """select row_number() over (order by round(s, 9) desc, chunk_id) as rank, chunk_id, round(s, 6) as score, total from (
    select f.chunk_id, fused * case when coalesce(list_has_any(jurisdictions, ['Ohio']), false) then 1.5::double else 1.0::double end as s,
    (select count(*) from (select chunk_id from k union select chunk_id from v)) as total from fused f join docs using (chunk_id)) order by rank limit 10"""
)
def q9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered, boosted hybrid search with its total."""
    found = search.search(table(spark, sf_dir, "search_docs"), QUESTION, search.Filters(tax_topic="Apportionment", boost_jurisdictions=("Ohio",)))
    return found.select("rank", "chunk_id", F.round("search_score", 6).alias("score"), "total")


@query(
    _FILTERED
    + """select row_number() over (order by round(s, 9) desc, chunk_id) as rank, chunk_id, round(s, 6) as score,
    case when message_id is not null then source_file || ' (' || coalesce(sender, 'unknown sender') || ', ' || coalesce(strftime(sent_date, '%Y-%m-%d'), 'undated') || ')'
         when page_number is not null then source_file || ', p. ' || page_number::varchar else source_file end as citation from (
    select docs.*, fused * case when coalesce(list_has_any(jurisdictions, ['Ohio']), false) then 1.5::double else 1.0::double end as s from fused f join docs using (chunk_id)) order by rank limit 10"""
)
def q10_understood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search by an understood question: its topic filters, its jurisdictions raise."""
    draft = {"internal_search_query": QUESTION, "topic": "Apportionment", "jurisdictions": ["Ohio"]}
    found = search.search_understood(table(spark, sf_dir, "search_docs"), draft)
    return found.select("rank", "chunk_id", F.round("search_score", 6).alias("score"), search.citation_label().alias("citation"))


@query(_BM25.replace("from search_docs", "from search_docs where evidence_type = 'Tax Memo'") + "select row_number() over (order by score desc, chunk_id) as rank, k.chunk_id, round(score, 6) as score, substring(content, 1, 300) as preview from k join search_docs using (chunk_id) order by rank limit 5")
def q13_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best memos by keyword, with the beginning of their text."""
    found = search.preview(table(spark, sf_dir, "search_docs"), QUESTION, F.col("evidence_type") == "Tax Memo")
    return found.select("rank", "chunk_id", F.round("keyword_score", 6).alias("score"), "preview")


@query(" union all ".join(f"select '{f}' as field, metadata.{f} as value, count(*) as n from normalized_docs where metadata.{f} is not null group by metadata.{f}" for f in FACETS))
def q11_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of values of the seven facets in one scan."""
    return search.facets(table(spark, sf_dir, "normalized_docs").select("metadata.*"), FACETS)


@query("select chunk_id from search_docs s where not exists (select 1 from email_messages m where m.document_id = s.thread_id)")
def q12_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose thread is not among the mails."""
    chunks = table(spark, sf_dir, "search_docs").withColumn("document_id", F.col("thread_id"))
    return index.orphans(chunks, table(spark, sf_dir, "email_messages")).select("chunk_id")


@query(
    """
    select chunk_id, case when coalesce(semantic_state, 'n/a') in ('', 'n/a') then 'UNKNOWN' else semantic_state end as semantic_state,
    case when coalesce(evidence_type, 'n/a') in ('', 'n/a') then 'OTHER' else evidence_type end as evidence_type, len(coalesce(entities, [])) as entities,
    case when message_id is not null then source_file || ' (' || coalesce(sender, 'unknown sender') || ', ' || coalesce(strftime(sent_date, '%Y-%m-%d'), 'undated') || ')'
         when page_number is not null then source_file || ', p. ' || page_number::varchar else source_file end as citation from search_docs
    """
)
def q16_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as typed evidence with a citation."""
    rows = search.evidence(table(spark, sf_dir, "search_docs"))
    return rows.select("chunk_id", "semantic_state", "evidence_type", F.size("entities").cast("bigint").alias("entities"), search.citation_label().alias("citation"))


@query("select source_id, min(r) as rank from (select source_id, row_number() over (order by search_score desc, chunk_id) as r from search_docs where search_score is not null qualify r <= 100) group by source_id")
def q17_ranked_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of the hundred best chunks, each with its best rank."""
    best = search.top(table(spark, sf_dir, "search_docs").where("search_score is not null"), "search_score", "chunk_id", 100)
    return search.source_ranks(best)


@query("select source_id, max(search_score) as best_score from search_docs where search_score is not null group by source_id")
def q17_source_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with the score of their best chunk."""
    return search.ranked_sources(table(spark, sf_dir, "search_docs"))


@query("select distinct case when message_id is not null then 'mail' else 'file' end as origin, source_id from search_docs where source_id is not null")
def r11_sources_by_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The different sources of chunks from mails and from files."""
    return search.cited_by_origin(table(spark, sf_dir, "search_docs"), F.when(F.col("message_id").isNotNull(), "mail").otherwise("file"))


@query("select distinct source_id from search_docs where semantic_state = 'SUPERSEDED'")
def q18_superseded_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with superseded chunks."""
    return table(spark, sf_dir, "search_docs").where("semantic_state = 'SUPERSEDED'").select("source_id").distinct()


@query("select distinct unnest(jurisdictions) as jurisdiction from search_docs")
def q19_jurisdictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jurisdictions of the index."""
    return table(spark, sf_dir, "search_docs").select(F.explode("jurisdictions").alias("jurisdiction")).distinct()


# ---------------------------------------------------------------- index


@query(
    """
    select message_id as document_id, (max({'at': ingested_ts, 's': s, 'e': subject})).s as status, min(ingested_ts) as created, max(ingested_ts) as updated, (max({'at': ingested_ts, 's': s, 'e': subject})).e as error
    from (select *, case when coalesce(body, '') = '' then 'FAILED' else 'EXTRACTED' end as s from email_messages) group by message_id
    """
)
def s20_delivery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The present status of every message by the log of its deliveries, with its first and last moment."""
    log = table(spark, sf_dir, "email_messages").select(F.col("message_id").alias("document_id"), F.when(F.coalesce("body", F.lit("")) == "", "FAILED").otherwise("EXTRACTED").alias("status"), F.col("ingested_ts").alias("at"), F.col("subject").alias("error"))
    return index.status_view(log)


@query(
    "select document_id, "
    + ", ".join(f"r.{f} as {f}" for f in ("jurisdiction", "tax_topic", "authority_level", "source_type", "legal_entity", "business_unit", "scenario_id"))
    + " from (select document_id, metadata as r, row_number() over (partition by document_id order by upload_timestamp desc nulls last) as k from normalized_docs where document_id is not null) where k = 1"
)
def s21_metadata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facets of every document, by its last delivery."""
    return index.metadata_rows(table(spark, sf_dir, "normalized_docs")).drop("upload_timestamp", "metadata_json")


@query(
    """
    select substring(document_id, 1, 8) as prefix, case when count(distinct document_id) = 1 then min(document_id) end as document_id,
    case when count(distinct document_id) > 1 then 'ambiguous' else 'found' end as status from normalized_docs group by 1
    """
)
def s23_resolved_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents the first eight characters of their key name, and which prefixes are ambiguous."""
    docs = table(spark, sf_dir, "normalized_docs")
    return index.resolved(docs, docs.select(F.substring("document_id", 1, 8).alias("prefix")), "document_id", 8)


_CONTRACT = ["content", "source_id", "source_file", "page_number", "tax_topic"]


@query(
    "select 'chunk_id' as field, count(chunk_id) as known, count(*) as total from search_docs union all "
    + " union all ".join(f"select '{f}', count(*) filter (coalesce({f}::varchar, '') not in ('', 'n/a', '[]')), count(*) from search_docs" for f in _CONTRACT)
)
def s19_index_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the index that the chunks have, and how many chunks say something."""
    return index.contract(table(spark, sf_dir, "search_docs"))


@query("select message_id, ingested_ts, scenario_id, body from (select *, row_number() over (partition by message_id order by ingested_ts desc, body desc) as r from email_messages) where r = 1")
def s18_latest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last delivery of every message replaces those before."""
    return index.latest(table(spark, sf_dir, "email_messages").select("message_id", "ingested_ts", "scenario_id", "body"), ["message_id"], "ingested_ts", ["body"]).select("message_id", "ingested_ts", "scenario_id", "body")


@query("select vec_id, len(embedding)::integer as dimensions, list_transform(embedding[1:8], lambda v: round(v::double, 6))[1] as first_value from embeddings")
def s16_embedding_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and first value of every vector."""
    rows = index.embedding_preview(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "dimensions", F.round(F.col("preview")[0].cast("double"), 6).alias("first_value"))


@query("select chunk_id, source_id, semantic_state, tax_topic from search_docs where not coalesce(semantic_state = 'DRAFT', false)")
def s22_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after its drafts are cleared."""
    return index.clear(table(spark, sf_dir, "search_docs"), F.col("semantic_state") == "DRAFT").select("chunk_id", "source_id", "semantic_state", "tax_topic")


@query(
    " union all ".join(f"select '{f}' as field, count(*) filter ({f} is null or trim({f}) = '') as missing from search_docs" for f in ("chunk_id", "source_id", "source_file", "content"))
    + " union all select 'content_vector', count(*) from search_docs"
)
def r18_missing_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows lack a field that a write requires; the chunks at hand have no vectors yet."""
    return index.missing_on_write(table(spark, sf_dir, "search_docs"))


@query(
    """
    select distinct m.document_id as request_id, m.scenario_id as source_id from email_messages m where m.scenario_id is not null and m.document_id is not null
    and not exists (select 1 from (select document_id, unnest(metadata.scenario_ids) as s from normalized_docs) n where n.document_id = m.document_id and n.s = m.scenario_id)
    """
)
def r7_invented_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios that mails claim and their documents do not list: citations without a source."""
    claims = table(spark, sf_dir, "email_messages").select(F.col("document_id").alias("request_id"), F.col("scenario_id").alias("source_id")).where("request_id is not null and source_id is not null")
    known = table(spark, sf_dir, "normalized_docs").select(F.col("document_id").alias("request_id"), F.explode("metadata.scenario_ids").alias("source_id"))
    return search.invented_citations(claims, known)


# ---------------------------------------------------------------- evaluation and reports


@query(
    """
    select count(*) as cases, count(*) filter (error is null) as scored, count(*) filter (error is null and coalesce(expected_intent = actual_intent, false)) as correct,
    round(avg(case when error is null then coalesce(expected_intent = actual_intent, false)::integer::double end), 4) as accuracy from eval_cases
    """
)
def a1_intent_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of classified questions."""
    return evaluation.intent_accuracy(table(spark, sf_dir, "eval_cases"))


@query("select expected_intent, actual_intent, count(*) as n from eval_cases where error is null and actual_intent is not null and expected_intent <> actual_intent group by all")
def a2_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong classifications by pair."""
    return evaluation.confusion(table(spark, sf_dir, "eval_cases"))


@query(r"select test_id, trim(regexp_replace(question, '\s+', ' ', 'g')) as question from eval_cases")
def a5_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with blanks collapsed."""
    return table(spark, sf_dir, "eval_cases").select("test_id", F.trim(F.regexp_replace("question", r"\s+", " ")).alias("question"))


@query("select metadata.enrichment_status as status, metadata.source_type as source_type, count(*) as documents, sum(char_count)::bigint as chars from normalized_docs group by all")
def a6_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by status and type."""
    return evaluation.run_summary(table(spark, sf_dir, "normalized_docs"))


_FIELDS = ["tax_topic", "jurisdiction", "author", "legal_entity", "business_unit"]


@query(" union all ".join(f"select '{f}' as field, count(*) filter (coalesce(metadata.{f}, 'n/a') not in ('', 'n/a')) as known, count(*) as total from normalized_docs" for f in _FIELDS))
def a7_field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often metadata fields say something."""
    return evaluation.field_coverage(table(spark, sf_dir, "normalized_docs"), _FIELDS)


@query(
    """
    with r as (select tax_topic, source_id, row_number() over (partition by tax_topic order by best desc, source_id) as k from
      (select tax_topic, source_id, max(search_score) as best from search_docs where search_score is not null and tax_topic is not null group by all)),
    w as (select tax_topic, source_id from search_docs where semantic_state = 'SETTLED' and tax_topic is not null)
    select tax_topic, count(*) filter (exists (select 1 from w where w.tax_topic = r.tax_topic and w.source_id = r.source_id)) > 0 as hit from r where k <= 3 group by tax_topic
    """
)
def a8_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether one of the three best sources of each topic is settled."""
    rows = table(spark, sf_dir, "search_docs").where("tax_topic is not null")
    best = rows.where("search_score is not null").groupBy("tax_topic", "source_id").agg(F.max("search_score").alias("best"))
    ranked = best.groupBy("tax_topic").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.negative("best").alias("b"), "source_id"))), lambda x: x["source_id"]).alias("ranked"))
    wanted = rows.where("semantic_state = 'SETTLED'").groupBy("tax_topic").agg(F.collect_set("source_id").alias("wanted"))
    return ranked.join(wanted, "tax_topic", "left").select("tax_topic", providers.hit_at(F.col("ranked"), F.coalesce("wanted", F.array().cast("array<string>")), 3).alias("hit"))


_CRITICAL = [f"TC-{k:04}" for k in (1, 2, 3, 4, 5)]


@query(f"select test_id, error is null as scored, error is null and coalesce(expected_intent = actual_intent, false) as correct from eval_cases where test_id in ({', '.join(map(repr, _CRITICAL))})")
def a3_critical_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five cases that must not fail."""
    return evaluation.critical_cases(table(spark, sf_dir, "eval_cases"), _CRITICAL)


# ---------------------------------------------------------------- headers, pages, aliases


@query(
    r"""
    with l as (select path, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no from (select distinct path, text from extracted)),
    m as (select path, no, regexp_extract(line, '(?i)^\[?page (\d+)(?: of \d+)?\]?$', 1)::int as page from l where regexp_matches(line, '(?i)^\[?page (\d+)(?: of \d+)?\]?$')),
    f as (select path, no, line from l where starts_with(line, 'From: '))
    select f.path, f.no, m.page from f asof left join (select path, no, max(page) as page from m group by all) m on f.path = m.path and f.no >= m.no
    """
)
def e13_pages_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page on which each head of a mail stands: that of the last page marker at or before it."""
    lines = table(spark, sf_dir, "extracted").select("path", "text").distinct().select("path", F.posexplode(F.split("text", "\n")).alias("no", "line")).withColumn("no", F.col("no") + 1)
    marker = F.regexp_extract("line", r"(?i)^\[?page (\d+)(?: of \d+)?\]?$", 1)
    pages = lines.where(marker != "").groupBy("path", "no").agg(F.max(marker.cast("int")).alias("page"))
    heads = lines.where(F.col("line").startswith("From: ")).select("path", "no")
    return threads.asof_backward(heads, pages, ["path"], "no", ["page"], span=10_000)


@query(r"select path, len(regexp_extract_all(substring(text, 1, 8000), '(?im)^(?:from|sent|to|subject):[^\S\n]*\S|^-{2,}[^\S\n]*original message')) >= 2 as looks_like_mail from extracted")
def e15_printed_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts look like printed mails."""
    return table(spark, sf_dir, "extracted").select("path", (headers.mail_signals(F.col("text")) >= 2).alias("looks_like_mail"))


@query()
def e9_native_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of every mail file: its own headers for the newest, the quoted history for the rest."""
    files = spread(table(spark, sf_dir, "extracted").where("is_email_thread").select(F.col("path").alias("document_id"), "text"))
    return threads.native_threads(files).select("document_id", "message_index", "sender", F.array_join("recipients", "|").alias("recipients"), "message_date", "subject", F.length("body").alias("chars"))


@query(
    "select document_id, raw, case when t is null or t in ('', 'n/a', 'none', 'null', 'unknown', 'na') then 'n/a' else coalesce("
    + "list_filter([" + ", ".join(f"'{a}'" for a in JURISDICTIONS) + "], lambda a: lower(a) = t)[1], case "
    + " ".join("when contains(t, '{}') then '{}'".format(k.replace("'", "''"), v) for k, v in JURISDICTION_ALIASES.items())
    + " end, list_filter([" + ", ".join(f"'{a}'" for a in JURISDICTIONS) + "], lambda a: contains(lower(a), t) or contains(t, lower(a)))[1], 'n/a') end as jurisdiction"
    + " from (select document_id, metadata.jurisdiction as raw, lower(trim(metadata.jurisdiction)) as t from normalized_docs)"
)
def m5_aliased_jurisdictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jurisdictions mapped to the closed list, by aliases before the nearest entry."""
    docs = table(spark, sf_dir, "normalized_docs").select("document_id", F.col("metadata.jurisdiction").alias("raw"))
    return docs.withColumn("jurisdiction", headers.coerce(F.col("raw"), JURISDICTIONS, aliases=JURISDICTION_ALIASES))


@query("select document_id, enrichment_status as status, guard_error from (select document_id, metadata.enrichment_status as enrichment_status, case when coalesce(metadata.enrichment_status, '') <> 'ok' then 'not enriched: ' || coalesce(nullif(trim(metadata.enrichment_status), ''), 'n/a') end as guard_error from normalized_docs) where guard_error is not null")
def k5_not_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a strict run does not cut into chunks."""
    docs = table(spark, sf_dir, "normalized_docs").select("document_id", F.col("metadata.enrichment_status").alias("enrichment_status"))
    return chunking.enrichment_guard(docs).where("guard_error is not null").select("document_id", F.col("enrichment_status").alias("status"), "guard_error")


@query("select distinct m.message_id, m.ingested_ts, greatest(0, strpos(n.content, substring(m.body, 1, 60)) - 1)::int as char_start from email_messages m join normalized_docs n on n.document_id = m.document_id where coalesce(m.body, '') <> ''")
def k12_message_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each message begins in the text of its document."""
    messages = table(spark, sf_dir, "email_messages").where("coalesce(body, '') <> ''").select("message_id", "ingested_ts", "document_id", "body")
    docs = table(spark, sf_dir, "normalized_docs").select("document_id", "content")
    return messages.join(docs, "document_id").select("message_id", "ingested_ts", chunking.found_at(F.col("body"), F.col("content")).cast("int").alias("char_start")).distinct()
