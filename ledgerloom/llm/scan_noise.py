"""Noise in text from scanned pages: running heads, page numbers, broken and misrecognised words.

1. The layout of each record shows page numbers, running heads at the edges of pages (damaged
   copies of the title or of one another, short lines without an end) and line ends that break a
   word.  Long lines beside a page number are heads if the corpus repeats them at its edges.
2. The words of running text are counted in scanned records and in all others.  An *anagram hash*
   (the sum of a hash of each character) turns a confusion such as ``rn`` for ``m`` into a fixed
   difference, wherever it stands in a word: rare words join frequent ones on
   ``hash - difference`` in SQL, for one confusion and for two.
3. A word broken at a line end loses its hyphen unless the texts write it with one, within lines, more
   often than without; before a conjunction the hyphen and a blank stay.
4. Candidates are verified by replacing, and ranked by fewer confusions and then by frequency.

Defined results: NULL and empty texts give no row; records that were not scanned give none;
repeated deliveries count once; a word without a frequent variant stays as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import combinations_with_replacement

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

from .words import in_slabs

# --- fixed values: what a character is taken for ---
CONFUSIONS = [
    ("e", "c"), ("a", "@"), ("t", "f"), ("o", "0"), ("i", "l"), ("s", "5"), ("l", "1"), ("n", "ri"), ("u", "ii"), ("d", "cl"), ("g", "9"), ("m", "rn"), ("h", "li"), ("w", "vv"),
    ("b", "6"), ("b", "8"), ("s", "$"), ("cl", "d"), ("rn", "m"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("ffi", "ﬃ"), ("ff", "ﬀ"), ("i", "1"), ("q", "9"), ("z", "2"), ("l", "i"), ("c", "e"), ("o", "c"), ("vv", "w"), ("ri", "n"), ("f", "t"), ("li", "h"), ("ii", "u"),
]
EXTRACTORS = ["ocr", "pdf_ocr"]
CONJUNCTIONS = "and or und oder".split()
# --- end of fixed values ---

#: A word is frequent from this count on, and a variant of it is rare below this share.
FREQUENT, RARE_SHARE = 3, 0.02
#: Records taken apart at once in a task.
SLAB = 100
#: A long line beside a page number is a head if so many records have it there.
EDGE_RECORDS = 3

_PAGE_WORD = r"[p][a@][gq9][ec]"
_PAGE = re.compile(rf"(?:[-—–]\s*)?\d{{1,4}}(?:\s*[-—–])?|p\.? ?[\dlo]{{1,4}}|[\dlo]{{1,4}}/[\dlo]{{1,4}}|\[{_PAGE_WORD} ?[\dlo]{{1,4}}\]|{_PAGE_WORD} [\dlo]{{1,4}}(?: [o0][f] [\dlo]{{1,4}})?|[ivxl1]{{1,6}}", re.I)
_BESIDE = re.compile(rf"(?P<head>\S.*?\S)\s{{2,}}(?P<page>{_PAGE.pattern})|(?P<page2>{_PAGE.pattern})\s{{2,}}(?P<head2>\S.*?\S)", re.I)
_BREAK = re.compile(r"[-­¬‐] ?$")
_TOKEN = re.compile(r"[^\W_]+(?:[@$][^\W_]*)*|[@$][^\W_]+(?:[@$][^\W_]*)*|@")
_LAST = re.compile(r"[^\W_]+$")
_PLAIN = str.maketrans("@$01568", "asolsbb")

LINES = "record_id string, line_no int, noise string, edge string, words array<struct<word:string,line:int,next:int,cut:int>>"


def _folded(line: str) -> str:
    return re.sub(r"[^a-z]", "", line.lower().translate(_PLAIN).replace("rn", "m"))


def _alike(a: str, b: str) -> bool:
    return bool(a) and bool(b) and (a == b or (min(len(a), len(b)) > 0.6 * max(len(a), len(b)) and SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.72))


def layout(lines: list[str]) -> tuple[dict[int, set[str]], dict[int, str], list[int]]:
    """Noise of each line, long lines at an edge, and the lines of running text, counted from 0."""
    noise: dict[int, set[str]] = {}
    full = [k for k, x in enumerate(lines) if x.strip()]
    if not full:
        return {}, {}, []
    title = full[0]
    width = max((len(lines[k].rstrip()) for k in full[1:]), default=0)
    heads: list[str] = [_folded(lines[title])]
    alone = []
    for k in full[1:]:
        text = lines[k].strip()
        if _PAGE.fullmatch(text):
            noise[k] = {"page"}
            alone.append(k)
        elif (found := _BESIDE.fullmatch(text)) and not (found["head"] or found["head2"]).endswith((".", ",")):
            noise[k] = {"page", "header"}
            heads.append(_folded(found["head"] or found["head2"]))
        elif text == "\f" or text == "":
            noise[k] = set()
            alone.append(k)

    def open_line(k: int) -> bool:
        text = lines[k].strip()
        return k != title and k not in noise and len(text) <= 80 and not text.endswith((".", ",", ";", "?", "!", ":")) and not _BREAK.search(lines[k])

    edge: dict[int, str] = {}
    for k in alone:
        for j in (k - 1, k + 1):
            if 0 <= j < len(lines) and lines[j].strip() and open_line(j):
                key = _folded(lines[j])
                if any(_alike(key, h) for h in heads) or len(lines[j].strip()) <= 0.7 * width:
                    noise[j] = {"header"}
                    heads.append(key)
                else:
                    edge[j] = key
    seen: dict[str, int] = {}
    for k in full[1:]:
        if open_line(k) and len(lines[k].strip()) <= 0.7 * width and 4 <= len(key := _folded(lines[k])):
            if any(_alike(key, h) for h in heads):
                noise[k] = {"header"}
            elif key in seen:
                noise[k] = noise[seen[key]] = {"header"}
                heads.append(key)
            seen.setdefault(key, k)
    for k in list(edge):
        if any(_alike(edge[k], h) for h in heads[1:]):
            noise[k] = {"header"}
            del edge[k]
    running = [k for k in full if k != title and k not in noise]
    return noise, edge, running


def _layout_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in in_slabs(batches, SLAB):
        rows = []
        for record_id, text in zip(batch["record_id"], batch["text"], strict=True):
            lines = text.split("\n")
            noise, edge, running = layout(lines)
            rows += [(record_id, k + 1, kind, None, None) for k, kinds in noise.items() for kind in kinds]
            pending: tuple[str, int] | None = None
            flow = [k for k in running if k not in edge] or running
            after = dict(zip(flow, flow[1:], strict=False))
            for k in running:
                words = [(m.start(), m.group()) for m in _TOKEN.finditer(lines[k])]
                out = []
                if pending and words:
                    begin, first = words.pop(0)
                    out.append({"word": (pending[0] + first).lower(), "line": pending[1] + 1, "next": k + 1, "cut": len(pending[0])})
                pending = None
                if k in after and words and _BREAK.search(lines[k]):
                    following = _TOKEN.match(lines[after[k]].strip())
                    if following and following.group().lower() not in CONJUNCTIONS and not following.group()[0].isupper():
                        rows.append((record_id, k + 1, "hyphen", None, None))
                        pending = (words.pop()[1], k)
                out += [{"word": w.lower(), "line": k + 1, "next": k + 1, "cut": 0} for _, w in words]
                rows.append((record_id, k + 1, None, edge.get(k), out))
        yield pd.DataFrame(rows, columns=["record_id", "line_no", "noise", "edge", "words"])


def anagram_hash(word: Column) -> Column:
    """The sum of a hash of each character: no order, and a fixed difference for each confusion."""
    return F.aggregate(F.filter(F.split(word, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda n, c: n + F.shiftright(F.xxhash64(c), 10))


def misread_as(right: str, wrong: str, confusions: int) -> bool:
    """Whether ``wrong`` comes from ``right`` by exactly so many confusions."""
    if not confusions:
        return right == wrong
    for a, b in CONFUSIONS:
        at = right.find(a)
        while at >= 0:
            if wrong.startswith(right[:at] + b) and misread_as(right[at + len(a) :], wrong[at + len(b) :], confusions - 1):
                return True
            at = right.find(a, at + 1)
    return False


def _confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ok = [misread_as(f, r, int(n)) for f, r, n in zip(batch["frequent"], batch["rare"], batch["confusions"], strict=True)]
        yield batch[ok]


def corrections(scanned_words: DataFrame, clean_words: DataFrame) -> DataFrame:
    """``(rare, frequent, same)`` of words with their counts: the best frequent variant and how many characters both begin with."""
    spark = scanned_words.sparkSession
    frequent = clean_words.where(F.col("n") >= FREQUENT).select(F.col("word").alias("frequent"), F.col("n").alias("often"), anagram_hash(F.col("word")).alias("hash"))
    known = clean_words.select(F.col("word").alias("rare"), F.col("n").alias("clean"))
    letters = F.length(F.regexp_replace("rare", "[^\\p{L}@$]", ""))
    rare = scanned_words.select(F.col("word").alias("rare")).where((letters > 0) & (2 * letters >= F.length("rare"))).join(known, "rare", "left").na.fill(0, ["clean"])
    rare = rare.withColumn("rare_hash", anagram_hash(F.col("rare")))
    pairs = [(1, a, b) for a, b in CONFUSIONS] + [(2, a + c, b + d) for (a, b), (c, d) in combinations_with_replacement(CONFUSIONS, 2)]
    # a fixed table of some 600 differences, the same for any input
    steps = spark.createDataFrame(pairs, "confusions int, before string, after string").select("confusions", (anagram_hash(F.col("after")) - anagram_hash(F.col("before"))).alias("step")).distinct().collect()
    step = F.explode(F.array(*(F.struct(F.lit(r["confusions"]).alias("confusions"), F.lit(r["step"]).alias("step")) for r in steps))).alias("s")
    wanted = rare.select("rare", "clean", "rare_hash", step).select("rare", "clean", "s.confusions", (F.col("rare_hash") - F.col("s.step")).alias("hash"))
    met = wanted.join(frequent, "hash").where((F.col("clean") <= RARE_SHARE * F.col("often")) & (F.col("rare") != F.col("frequent")))
    sure = met.select("rare", "frequent", "often", "confusions").mapInPandas(_confirmed, "rare string, frequent string, often bigint, confusions int")
    best = sure.groupBy("rare").agg(F.min_by("frequent", F.struct("confusions", F.negative("often").alias("o"), "frequent")).alias("frequent"))
    same = F.expr("aggregate(sequence(1, least(length(rare), length(frequent))), 0, (n, i) -> if(n = i - 1 and substring(rare, i, 1) = substring(frequent, i, 1), i, n))")
    return best.select("rare", "frequent", same.alias("same"))


def scans(extracted: DataFrame, documents: DataFrame) -> DataFrame:
    """``(record_id, text, scanned)`` of both tables."""
    from_scan = F.col("extractor").isin(EXTRACTORS)
    files = extracted.select(F.col("path").alias("record_id"), "text", from_scan.alias("scanned"), F.coalesce("is_email_thread", F.lit(False)).alias("mail"))
    docs = documents.select(F.col("document_id").alias("record_id"), F.col("content").alias("text"), from_scan.alias("scanned"), F.coalesce("is_email_thread", F.lit(False)).alias("mail"))
    return files.unionByName(docs).where("record_id is not null and text is not null and text <> ''")


def _scanned(records: DataFrame) -> DataFrame:
    """Different scanned texts, dealt out by their number: rows of work for Python, not bytes."""
    parts = max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), records.sparkSession.sparkContext.defaultParallelism)
    return records.where("scanned").select("record_id", "text").repartition(parts, "record_id").dropDuplicates(["record_id", "text"])


def kept_hyphens(records: DataFrame, words: DataFrame) -> DataFrame:
    """``(record_id, form)``: words broken at a hyphen that the texts write with one, within a line, more often than without."""
    broken = words.where("cut > 0 and cut < length(word)").select("record_id", "word", F.concat(F.substring("word", F.lit(1), F.col("cut")), F.lit("-"), F.expr("substring(word, cut + 1)")).alias("form")).distinct()
    hyphenated = records.select(F.explode(F.expr(r"regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+-[\\p{L}\\p{N}]+', 0)")).alias("form"))
    joined = records.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("word"))
    forms = hyphenated.groupBy("form").agg(F.count("*").alias("with"))
    plain = joined.groupBy("word").agg(F.count("*").alias("without"))
    return broken.join(forms, "form").join(plain, "word", "left").where(F.col("with") > F.coalesce("without", F.lit(0))).select("record_id", "form")


def _analysed(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines = cut_lineage(_scanned(records).mapInPandas(_layout_rows, LINES))
    words = lines.where("words is not null").select("record_id", "line_no", F.explode("words").alias("w")).select("record_id", "line_no", "w.*")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    clean = records.where("not scanned and not mail").select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}@$]+")).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return lines, words, cut_lineage(corrections(counts, clean))


def _noise(lines: DataFrame, words: DataFrame, fixes: DataFrame) -> DataFrame:
    at_edge = lines.where("edge is not null and edge <> ''").select("record_id", "line_no", "edge")
    repeated = at_edge.groupBy("edge").agg(F.countDistinct("record_id").alias("n")).where(F.col("n") >= EDGE_RECORDS).select("edge")
    heads = at_edge.join(repeated, "edge").select("record_id", "line_no", F.lit("header").alias("noise"))
    wrong = words.join(fixes, words["word"] == fixes["rare"]).select("record_id", F.when(F.col("same") >= F.col("cut"), F.col("next")).otherwise(F.col("line")).alias("line_no"), F.lit("misread").alias("noise"))
    wrong = wrong.distinct().join(heads.select("record_id", "line_no"), ["record_id", "line_no"], "left_anti")
    return lines.where("noise is not null").select("record_id", "line_no", "noise").unionByName(heads).unionByName(wrong).distinct()


def noise_lines(extracted: DataFrame, documents: DataFrame) -> DataFrame:
    """``(record_id, line_no, noise)`` of scanned records."""
    return _noise(*_analysed(scans(extracted, documents)))


def _rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for text, noise, fixes, kept in zip(batch["text"], batch["noise"], batch["fixes"], batch["kept"], strict=True):
            kept = set(kept) if kept is not None else set()
            drop = {n["line_no"] for n in noise} if noise is not None else set()
            better = {f["rare"]: f["frequent"] for f in fixes} if fixes is not None else {}
            out: list[str] = []
            glue, gap = "", False
            for no, line in enumerate(text.split("\n"), 1):
                if no in drop:
                    continue
                if not line.strip():
                    gap = gap or bool(out)
                    continue
                ended = not out or out[-1].rstrip().endswith((".", "?", "!", ":")) or len(out) == 1
                if glue == "" and (not out or (gap and ended)):
                    out.append(line.strip())
                elif _BREAK.search(out[-1]) and line.strip()[:1].islower():
                    before, after = _BREAK.sub("", out[-1]), line.strip()
                    left, right = _LAST.search(before), _TOKEN.match(after)
                    if right and right.group().lower() in CONJUNCTIONS:
                        out[-1] = f"{before}- {after}"
                    else:
                        form = f"{left.group()}-{right.group()}".lower() if left and right else ""
                        out[-1] = f"{before}-{after}" if form in kept else before + after
                else:
                    out[-1] += " " + line.strip()
                gap = False
            joined = "\n\n".join(out)
            if better:
                joined = _TOKEN.sub(lambda m: _cased(m.group(), better), joined)
            texts.append(joined)
        yield batch[["record_id"]].assign(repaired=texts)


def _cased(word: str, better: dict[str, str]) -> str:
    new = better.get(word.lower())
    if new is None:
        return word
    return new.upper() if word.isupper() and len(word) > 1 else new.capitalize() if word[0].isupper() or (not word[0].isalpha() and word[1:].isupper()) else new


def repaired(extracted: DataFrame, documents: DataFrame) -> DataFrame:
    """``(record_id, repaired)``: scanned records as continuous paragraphs."""
    records = scans(extracted, documents)
    lines, words, fixes = _analysed(records)
    gone = _noise(lines, words, fixes).where("noise in ('header', 'page')").groupBy("record_id").agg(F.collect_set(F.struct("line_no")).alias("noise"))
    used = words.select("record_id", "word").distinct().join(fixes, F.col("word") == F.col("rare")).groupBy("record_id").agg(F.collect_set(F.struct("rare", "frequent")).alias("fixes"))
    kept = kept_hyphens(records, words).groupBy("record_id").agg(F.collect_set("form").alias("kept"))
    return _scanned(records).join(gone, "record_id", "left").join(used, "record_id", "left").join(kept, "record_id", "left").mapInPandas(_rebuild, "record_id string, repaired string")
