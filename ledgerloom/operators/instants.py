"""Timestamps typed in many ways, normalised to one UTC instant per record.

1. Each value is reduced to a *shape mask* by its character classes (a run of letters is
   ``a``, a digit ``9``, a run of blanks one blank).
2. Each **distinct** mask is mapped to a parser once: which run of digits is the year, the
   month, the hour ..., and whether a zone may follow.  Masks stay in Spark; they join back.
3. The fields are picked by position and converted with built-in functions, through a table of
   zone transitions that names the version of the zone data it was built from.

Defined results: NULL, empty or unreadable values, unknown sites and impossible dates give no
row.  A local time that occurs twice is the earlier one; one that never occurs is read with the
offset before the change.  Repeated rows give one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from importlib import metadata
from pathlib import Path
from zoneinfo import TZPATH, ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: month names and abbreviations in English, German and Spanish ---
MONTHS = {
    1: "jan january januar jän jänner ene enero",
    2: "feb february februar febrero",
    3: "mar march mär märz mrz marzo",
    4: "apr april abr abril",
    5: "may mai mayo",
    6: "jun june juni junio",
    7: "jul july juli julio",
    8: "aug august ago agosto",
    9: "sep sept september septiembre setiembre",
    10: "oct october okt oktober octubre",
    11: "nov november noviembre",
    12: "dec december dez dezember dic diciembre",
}
#: Words after a time that name no zone.
LOCAL_WORDS = "uhr hrs h local"
#: Zone words that mean the same everywhere.
UTC_WORDS = "z utc gmt ut zulu"
#: German names of zone abbreviations.
ZONE_ALIASES = {"mez": "cet", "mesz": "cest", "wez": "wet", "wesz": "west", "oez": "eet", "oesz": "eest"}
# --- end of fixed values ---

FIRST_YEAR, LAST_YEAR = 1900, 2100

TIME = r"(?P<hh>9{1,2}):(?P<mi>99)(?::(?P<ss>99)(?:[.,]9{1,9})?)?"
ZONE = r"(?: ?(?P<offset>a?[+-]99(?::?99)?)| ?\(?(?P<zone>a)\)?)"
TAIL = rf"(?P<noon> a(?=$| a| \(a\)))?{ZONE}?(?: \(a\))?"
LEAD = r"(?:a: ?)?"
DATES = [
    (r"(?P<y>9999)[-/.](?P<m>99?)[-/.](?P<d>99?)", "[ a]"),
    (r"(?P<p>99?)(?P<sep>[-/.])(?P<q>99?)(?P=sep)(?P<r>9999|99)", ",? "),
    (r"(?:a,? )?(?P<d>99?)\.? (?:a )?(?P<month>a) (?:a )?(?P<y>9999),?", "(?: a)? "),
    (r"(?:a,? )?(?P<month>a)\.? (?P<d>99?),? (?P<y>9999),?", "(?: a)? "),
    (r"(?P<d>99?)-(?P<month>a)-(?P<y>9999)", " "),
]
PARSERS = [re.compile(rf"^{LEAD}{date}(?:{gap}{TIME}{TAIL})?$") for date, gap in DATES]
PACKED = {
    re.compile(r"^9{8}a9{6}(?P<zone>a)?$"): "packed",
    re.compile(r"^9{14}$"): "packed",
    re.compile(r"^9{8}$"): "packed",
    re.compile(r"^9{10}$"): "seconds",
    re.compile(r"^9{13}$"): "millis",
}
FIELDS = ("y", "m", "d", "p", "q", "r", "hh", "mi", "ss")
PLAN_SCHEMA = "mask string, kind string, " + ", ".join(f"at_{f} int" for f in FIELDS) + ", has_month boolean, has_offset boolean, has_zone boolean"


def shape_mask(value: Column) -> Column:
    """The character classes of a value, as a short string."""
    mask = F.regexp_replace(F.trim(value), r"\p{L}+", "a")
    return F.trim(F.regexp_replace(F.regexp_replace(mask, r"[0-9]", "9"), r"\s+", " "))


def plan_mask(mask: str) -> dict | None:
    """The parser of one mask: the 1-based position of each field among the runs of digits."""
    plan = dict.fromkeys(["mask", "kind", *(f"at_{f}" for f in FIELDS)]) | {"mask": mask, "has_month": False, "has_offset": False, "has_zone": False}
    for pattern, kind in PACKED.items():
        if found := pattern.match(mask):
            return plan | {"kind": kind, "has_zone": bool(found.groupdict().get("zone"))}
    for pattern in PARSERS:
        if found := pattern.match(mask):
            runs = [run.start() for run in re.finditer("9+", mask)]
            groups = found.groupdict()
            at = {f"at_{f}": runs.index(found.start(f)) + 1 for f in FIELDS if groups.get(f)}
            return plan | at | {"kind": "fields", "has_month": bool(groups.get("month")), "has_offset": bool(groups.get("offset")), "has_zone": bool(groups.get("zone") or groups.get("noon"))}
    return None


def _plan_masks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in PLAN_SCHEMA.split(", ")]
    for batch in batches:
        yield pd.DataFrame([p for m in batch["mask"] if (p := plan_mask(m))], columns=columns).astype({c: "Int32" for c in columns if c.startswith("at_")})


def zone_data_version() -> str:
    """The release of the zone data at hand."""
    for folder in TZPATH:
        for name in ("+VERSION", "tzdata.zi"):
            if (file := Path(folder, name)).exists():
                return file.read_text().split("\n", 1)[0].removeprefix("# version ").strip()
    try:
        return metadata.version("tzdata")
    except metadata.PackageNotFoundError:
        return "unknown"


def zone_periods(name: str, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> list[tuple[int, int, str]]:
    """(first local second, offset, abbreviation) of each period of a zone, in order.

    A period begins, in local time, at its UTC start plus the larger of the two offsets: so an
    hour that occurs twice and one that is skipped both belong to the period before.
    """
    zone = ZoneInfo(name)

    def at(second: int) -> tuple[int, str]:
        moment = datetime.fromtimestamp(second, UTC).astimezone(zone)
        return int(moment.utcoffset().total_seconds()), moment.tzname() or ""

    begin, end = (int(datetime(y, 1, 1, tzinfo=UTC).timestamp()) for y in (first, last + 1))
    step = int(timedelta(days=7).total_seconds())
    periods = [(begin - 86400, *at(begin))]
    for low in range(begin, end, step):
        high = low + step
        if at(high) == at(low):
            continue
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if at(middle) != at(low) else (middle, high)
        before, after = at(low), at(high)
        periods.append((high + max(before[0], after[0]), *after))
    return periods


TRANSITIONS_SCHEMA = "time_zone string, local_year int, periods array<struct<local_start:bigint,offset_s:int,abbr:string>>, zone_data string"


def _transitions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    version = zone_data_version()
    starts = {y: int(datetime(y, 1, 1, tzinfo=UTC).timestamp()) for y in range(FIRST_YEAR, LAST_YEAR + 2)}
    for batch in batches:
        rows = []
        for name in batch["time_zone"]:
            try:
                periods = zone_periods(name)
            except (KeyError, ValueError, OSError):
                continue
            for year in range(FIRST_YEAR, LAST_YEAR + 1):
                begun = [p for p in periods if p[0] <= starts[year]][-1:] or periods[:1]
                of_year = begun + [p for p in periods if starts[year] < p[0] < starts[year + 1]]
                rows.append((name, year, [dict(zip(("local_start", "offset_s", "abbr"), p, strict=True)) for p in of_year], version))
        yield pd.DataFrame(rows, columns=["time_zone", "local_year", "periods", "zone_data"])


def zone_transitions(sites: DataFrame) -> DataFrame:
    """The transition table of the zones of ``sites``: a row for each zone and local year."""
    return sites.select("time_zone").where("time_zone is not null").distinct().mapInPandas(_transitions, TRANSITIONS_SCHEMA)


def _lookup(mapping: dict[str, int]) -> Column:
    return F.create_map(*(x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))))


def to_instants(values: DataFrame, sites: DataFrame) -> DataFrame:
    """``values(record_id, value, site_id)`` to distinct ``(record_id, instant, zone_data)``."""
    typed = values.select("record_id", F.trim("value").alias("value"), "site_id").where("record_id is not null and value is not null").withColumn("mask", shape_mask(F.col("value")))
    plans = typed.select("mask").distinct().mapInPandas(_plan_masks, PLAN_SCHEMA)
    zones = sites.select(F.col("site_id").alias("site"), "time_zone", F.upper("date_order").alias("date_order")).dropDuplicates(["site"])
    rows = typed.join(plans, "mask").join(zones, F.col("site_id") == F.col("site"), "left")

    runs, words = F.expr("regexp_extract_all(value, '[0-9]+', 0)"), F.expr("regexp_extract_all(lower(value), '\\\\p{L}+', 0)")
    rows = rows.withColumns({"runs": runs, "words": words})

    def run(field: str) -> Column:
        return F.when(F.col(f"at_{field}").isNotNull(), F.get("runs", F.col(f"at_{field}") - 1).cast("int"))

    months = _lookup({w: k for k, names in MONTHS.items() for w in names.split()})
    month_word = F.try_element_at(F.filter(F.transform("words", lambda w: F.try_element_at(months, w)), lambda m: m.isNotNull()), F.lit(1))
    packed = F.regexp_replace("value", "[^0-9]", "")

    def cut(start: int, size: int) -> Column:
        return F.when(F.col("kind") == "packed", F.expr("try_cast(" + f"nullif(substring(regexp_replace(value, '[^0-9]', ''), {start}, {size}), '') as int)"))

    order = F.coalesce("date_order", F.lit("MDY"))
    p, q, r = run("p"), run("q"), run("r")
    year = F.coalesce(run("y"), F.when(F.length(F.get("runs", F.col("at_r") - 1)) == 4, r), F.when(order == "YMD", p + 2000), r + 2000, cut(1, 4))
    numeric_month = F.when((order == "DMY") | ((order == "YMD") & (F.length(F.get("runs", F.col("at_r") - 1)) == 2)), q).otherwise(p)
    numeric_day = F.when(order == "DMY", p).when((order == "YMD") & (F.length(F.get("runs", F.col("at_r") - 1)) == 2), r).otherwise(q)
    month = F.when(F.col("has_month"), month_word).otherwise(F.coalesce(run("m"), numeric_month, cut(5, 2)))
    day = F.coalesce(run("d"), numeric_day, cut(7, 2))
    noon = F.try_element_at(F.filter("words", lambda w: w.isin("am", "pm")), F.lit(1))
    typed_hour = F.coalesce(run("hh"), cut(9, 2), F.lit(0))
    hour = F.when(noon.isNull(), typed_hour).when((typed_hour < 1) | (typed_hour > 12), F.lit(None)).otherwise(typed_hour % 12 + F.when(noon == "pm", 12).otherwise(0))
    minute, second = F.coalesce(run("mi"), cut(11, 2), F.lit(0)), F.coalesce(run("ss"), cut(13, 2), F.lit(0))
    rows = rows.withColumns({"year": year, "hour": hour, "minute": minute, "second": second, "month_": month, "day_": day, "packed": packed})
    date = F.expr("try_cast(concat_ws('-', lpad(cast(year as string), 4, '0'), lpad(cast(month_ as string), 2, '0'), lpad(cast(day_ as string), 2, '0')) as date)")
    rows = rows.withColumn("date", F.when(F.col("year").between(FIRST_YEAR, LAST_YEAR) & F.col("hour").between(0, 23) & F.col("minute").between(0, 59) & F.col("second").between(0, 59), date))
    local = F.unix_date("date").cast("bigint") * 86400 + F.col("hour") * 3600 + F.col("minute") * 60 + F.col("second")

    sign = F.expr("regexp_extract(value, '([+-])[0-9]{2}(:?[0-9]{2})?( *\\\\([^)]*\\\\))?$', 1)")
    shift = F.expr("regexp_extract(value, '[+-]([0-9]{2}:?([0-9]{2})?)( *\\\\([^)]*\\\\))?$', 1)")
    digits = F.rpad(F.regexp_replace(shift, ":", ""), 4, "0")
    rows = rows.withColumns({"local": local, "sign": sign, "digits": digits})
    offset = F.when(F.col("has_offset"), F.expr("(try_cast(substring(digits, 1, 2) as int) * 3600 + try_cast(substring(digits, 3, 2) as int) * 60) * if(sign = '-', -1, 1)"))
    # the last word is a zone unless it is AM or PM, a local marker or the T of ISO
    last = F.try_element_at("words", F.lit(-1))
    word = F.when(F.col("has_zone") & ~last.isin("am", "pm", *LOCAL_WORDS.split()), last)
    word = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in ZONE_ALIASES.items() for x in kv)), word), word)
    rows = rows.withColumns({"offset_s": offset, "zone_word": word, "local_year": F.year("date")})

    table = zone_transitions(sites)
    rows = rows.join(table, ["time_zone", "local_year"], "left")
    named = F.try_element_at(F.filter("periods", lambda x: F.lower(x["abbr"]) == F.col("zone_word")), F.lit(-1))["offset_s"]
    begun = F.try_element_at(F.filter("periods", lambda x: x["local_start"] <= F.col("local")), F.lit(-1))["offset_s"]
    used = F.when(F.col("offset_s").isNotNull(), F.col("offset_s")).when(F.col("zone_word").isNull(), begun).otherwise(F.coalesce(named, F.when(F.col("zone_word").isin(*UTC_WORDS.split()), 0)))
    epoch = F.when(F.col("kind") == "seconds", F.col("packed").cast("bigint")).when(F.col("kind") == "millis", F.floor(F.col("packed").cast("bigint") / 1000)).otherwise(F.col("local") - used)
    rows = rows.withColumn("epoch", epoch.cast("bigint")).where("epoch is not null")
    return rows.select("record_id", instant_text(F.col("epoch")).alias("instant"), F.lit(zone_data_version()).alias("zone_data")).distinct()


def instant_text(epoch: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of seconds since 1970, whatever the session's time zone is."""
    days = F.floor(epoch / 86400).cast("int")
    rest = epoch - days.cast("bigint") * 86400
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(F.date_from_unix_date(days).cast("string"), F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest / 60) % 60), F.lit(":"), two(rest % 60), F.lit("Z"))


def record_instants(messages: DataFrame, documents: DataFrame, sites: DataFrame) -> DataFrame:
    """Instants of ``email_messages.message_date`` and ``normalized_docs.metadata.source_date``."""
    mail = messages.select(F.col("message_id").alias("record_id"), F.col("message_date").alias("value"), "site_id")
    docs = documents.select(F.col("document_id").alias("record_id"), F.col("metadata.source_date").alias("value"), "site_id")
    return to_instants(mail.unionByName(docs), sites)
