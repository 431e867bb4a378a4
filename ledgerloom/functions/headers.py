"""Mail headers, subjects, recipients and metadata rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.vocabulary import DOCUMENT_TYPES, HEADER_LABELS, NA, SOURCE_TYPES

_LABELS = "|".join(HEADER_LABELS)
_LEAD, _GAP = r"[>\-*#|\s_]*", r"[*_\s]*"
HEADER_LINE = rf"(?i)^{_LEAD}(?:{_LABELS})[*_\s]*:"
LABEL_ONLY = rf"(?i)^{_LEAD}(?:{_LABELS}){_GAP}:[*_\s|]*$"
THREAD_SIGNAL = rf"(?im)^(?:{_LEAD}from{_GAP}:{_GAP}.+|[>*#|\s_]*-{{2,}}\s*(?:original|forwarded)\s+message\s*-{{2,}}[*_\s|]*|{_LEAD}on\s+.{{4,80}}\s+wrote\s*:)[^\S\n]*$"
MAIL_SIGNAL = r"(?im)^(?:from|sent|to|subject):[^\S\n]*\S|^-{2,}[^\S\n]*original message"
SUBJECT_PREFIXES = r"(?i)^(\s*(re|fw|fwd|aw|antwort)\s*:\s*)+"


def known(value: Column) -> Column:
    """The value, or ``n/a`` where it is NULL or blank."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(NA))


def strip_decoration(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(value), r"[*_\s|]+$", ""))


def normalize_subject(subject: Column) -> Column:
    return known(F.regexp_replace(F.coalesce(subject, F.lit("")), SUBJECT_PREFIXES, ""))


def thread_signals(text: Column) -> Column:
    return F.regexp_count(text, F.lit(THREAD_SIGNAL))


def mail_signals(text: Column, head: int = 8_000) -> Column:
    """How many lines at the beginning of a text look like those of a printed mail."""
    return F.regexp_count(F.substring(text, 1, head), F.lit(MAIL_SIGNAL))


def suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^./]+)$", 1))


def _from_map(mapping: dict[str, str], key: Column, other: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv)), key), F.lit(other))


def document_type(name: Column) -> Column:
    return _from_map(DOCUMENT_TYPES, suffix(name), "unknown")


def source_type(name: Column, is_thread: Column) -> Column:
    return F.when(is_thread, F.lit("Email Thread")).otherwise(_from_map(SOURCE_TYPES, suffix(name), "Other"))


def split_recipients(value: Column) -> Column:
    """Recipients of a header: by semicolons, else by commas with ``Last, First`` joined again."""
    by_semicolon = F.transform(F.split(value, ";"), lambda x: F.trim(x))
    pieces = F.transform(F.split(value, ","), lambda x: F.trim(x))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(state: Column, piece: Column) -> Column:
        joined = F.when(state["open"] == "", piece).otherwise(F.concat(state["open"], F.lit(", "), piece))
        whole = piece.contains("@") | piece.contains("<")
        done = F.when(whole, F.concat(state["done"], F.array(joined))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.when(whole, F.lit("")).otherwise(joined).alias("open"))

    by_comma = F.aggregate(pieces, start, step, lambda s: F.concat(s["done"], F.array(s["open"])))
    parts = F.when(value.contains(";"), by_semicolon).otherwise(by_comma)
    kept = F.filter(parts, lambda p: (p != "") & ~p.rlike(LABEL_ONLY))
    return F.when(value.isNull() | (value == NA) | (F.trim(value) == ""), F.array().cast("array<string>")).otherwise(kept)


def is_junk(sender: Column, body: Column, least: int = 25) -> Column:
    """Export artefacts: nothing, a label, an address, or an unattributed scrap."""
    text = F.trim(F.coalesce(body, F.lit("")))
    nobody = F.coalesce(sender, F.lit("")).isin("", NA)
    scrap = nobody & (F.length(text) < least) & (text.rlike(r"^\s*[A-Z][\w.'-]+(?:,\s*[A-Z][\w.'-]+){0,2}\s*$") | (F.length(text) < 15))
    return (text == "") | text.rlike(LABEL_ONLY) | text.rlike(r"^\s*<?[\w.+-]+@[\w.-]+>?\s*$") | scrap


def flattened_table(value: Column) -> Column:
    labels = F.lit(0)
    for label in HEADER_LABELS:
        labels = labels + F.when(value.rlike(rf"(?i)\b{label}\s*:"), 1).otherwise(0)
    semicolons = F.length(value) - F.length(F.replace(value, F.lit(";"), F.lit("")))
    return (labels >= 2) | (F.length(value) > 120) | ((labels >= 1) & (F.length(value) > 60)) | (semicolons >= 2)


def sanitize_subject(value: Column) -> Column:
    after = F.regexp_replace(strip_decoration(value), r"(?i)^.*\bsubject\s*:\s*", "")
    cut = F.trim(F.regexp_replace(after, rf"(?i)\b(?:{_LABELS})\s*:.*$", ""))
    return F.when((cut == "") | (F.length(cut) > 200) | cut.isNull(), F.lit(NA)).otherwise(cut)


def display_name(value: Column) -> Column:
    """A name without its address; a bare address gives its local part."""
    text = F.trim(F.coalesce(value, F.lit("")))
    shown = F.trim(F.regexp_replace(text, r"<[^>]*>", ""))
    return F.when(shown.rlike(r"^\S+@\S+$"), F.split_part(shown, F.lit("@"), F.lit(1))).when(shown != "", shown).otherwise(F.regexp_extract(text, r"<([^@>]*)", 1))


def format_recipients(values: Column, limit: int = 4) -> Column:
    names = F.transform(F.coalesce(values, F.array().cast("array<string>")), display_name)
    first = F.array_join(F.slice(names, 1, limit), ", ")
    return F.when(F.size(names) > limit, F.concat(first, F.lit(" (+"), (F.size(names) - limit).cast("string"), F.lit(" more)"))).otherwise(first)


def coerce(value: Column, allowed: list[str], fallback: str = NA, aliases: dict[str, str] | None = None) -> Column:
    """The entry of a closed list: exact without case, else that of the first alias in the value, else the first entry that contains the value or lies in it."""
    text = F.lower(F.trim(value))
    entries = F.array(*(F.lit(a) for a in allowed))
    exact = F.filter(entries, lambda a: F.lower(a) == text)
    near = F.filter(entries, lambda a: F.lower(a).contains(text) | text.contains(F.lower(a)))
    also = [F.when(text.contains(alias), F.lit(entry)) for alias, entry in (aliases or {}).items()]
    nothing = text.isNull() | text.isin("", NA, "none", "null", "unknown", "na")
    return F.when(nothing, F.lit(NA)).otherwise(F.coalesce(F.get(exact, F.lit(0)), *also, F.get(near, F.lit(0)), F.lit(fallback)))


def slug(value: Column, parts: int = 6) -> Column:
    """An upper-case key of the first words of a value."""
    words = F.filter(F.split(F.upper(F.regexp_replace(F.coalesce(value, F.lit("")), "[^A-Za-z0-9]+", "_")), "_"), lambda w: w != "")
    return F.when(F.size(words) == 0, F.lit(NA)).otherwise(F.array_join(F.slice(words, 1, parts), "_"))


def confidence(value: Column) -> Column:
    """A share between 0 and 1; what is none counts as 0."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def merge(base: Column, override: Column) -> Column:
    """The override unless it says nothing."""
    return F.coalesce(F.nullif(F.nullif(override, F.lit("")), F.lit(NA)), base)
