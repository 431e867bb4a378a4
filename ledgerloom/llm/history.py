"""Quoted history, signatures and boilerplate removed from mails.

1. All lines of a mail, quoted ones without their marks, are joined to paragraphs and split into
   sentences.  A sentence of ``MIN_WORDS`` words gets a fingerprint of its words and a print of 256
   bits, one for each pair of neighbouring characters that it has.  A sentence whose fingerprint an
   earlier mail of the thread has is inherited; this removes most of the quoted history.
2. One edit changes at most four bits of a print, so that within a thread no near-match is lost:
   different sentences with the same figures meet there, and those whose lengths and prints allow
   it are compared.  Sentences below a signature, or below the sender's name, meet across threads, on
   ``BANDS`` anchors of ``ROWS`` minima over their runs of three characters.
3. Near-matches are verified by their edit distance.  A sentence that an earlier mail of the
   thread already said is inherited, unless its figures are others; a sentence below a signature
   that ``SHARED_BY`` mails close with is boilerplate.  A line of which every sentence is either is
   not newly written.  Shorter sentences count as boilerplate too, but are never inherited:
   greetings and answers such as "Will do." are written anew each time.
4. What no earlier mail holds is left to the layout (:mod:`own_lines`): lines that introduce a
   quotation, quotations of mails that are not there, signatures and footers.  :func:`removed_lines`
   says how many lines each step removes.

Sentences below signatures are counted before they are compared, so that a disclaimer on a third
of all mails is one row and no hot key.

Defined results: NULL and empty texts give no row; repeated deliveries of a record count once;
mails without a known sender lose a signature only where its shape shows it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spread, written

from .own_lines import is_name, is_quoted, own_lines, sender_tokens
from .words import mix, words_of

MIN_WORDS = 6
BANDS, ROWS = 40, 3
#: Edits by which two sentences may differ, as a share of the longer one.
EDITS = 0.15
#: Sentences below a signature that so many mails share are boilerplate.
SHARED_BY = 5

SENTENCES = "record_id string, thread bigint, position int, own boolean, tail boolean, said bigint, lines array<int>, sentence string, figures string, print array<bigint>"
#: Mails and characters that a task works on at once.
MAILS, SLAB = 500, 50_000
_END = re.compile(r"[.!?]\s+")
_FIGURES = re.compile(r"\d+")
_MARKS = re.compile(r"^\s*(?:[>|]\s?)+")
_FACTORS = mix(np.arange(1, 2 * BANDS * ROWS, 2, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mix(np.arange(2, 2 * BANDS * ROWS + 1, 2, dtype=np.uint64))
#: ASCII letters and digits in lower case, blanks for the rest.
_PLAIN = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else 32 for c in range(256))


def _slabs(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The characters of some of the texts after each other, and where each text begins and the last one ends."""
    begin = size = 0
    for k, text in enumerate(texts, 1):
        size += len(text)
        if size >= SLAB or k == len(texts):
            some = texts[begin:k]
            characters = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            yield characters, np.cumsum([0, *map(len, some)])
            begin, size = k, 0


def _prints(sentences: list[str]) -> np.ndarray:
    """256 bits for each sentence, set for its pairs of neighbouring characters."""
    found = [np.empty((0, 4), np.int64)]
    for c, at in _slabs(sentences):
        of = np.repeat(np.arange(len(at) - 1), np.diff(at))
        places = of[:-1] * 256 + (mix(c[:-1] * np.uint64(0x110000) + c[1:]) & np.uint64(255)).astype(np.int64)
        bits = np.zeros((len(at) - 1) * 256, np.uint8)
        bits[places[of[:-1] == of[1:]]] = 1
        found.append(np.packbits(bits).view(np.int64).reshape(-1, 4))
    return np.concatenate(found)


def _anchors(sentences: list[str]) -> np.ndarray:
    """``BANDS`` keys for each sentence, each of the least values of ``ROWS`` hash functions over the runs of three characters."""
    found = [np.empty((0, BANDS), np.int64)]
    for c, at in _slabs([f"  {x}  " for x in sentences]):
        runs = mix(mix(c[:-2] * np.uint64(0x110000) + c[1:-1]) + c[2:])
        minima = np.array([(runs[begin : end - 2, None] * _FACTORS + _SHIFTS).min(axis=0) for begin, end in zip(at[:-1], at[1:], strict=True)])
        anchors = np.arange(1, BANDS + 1, dtype=np.uint64)
        for k in range(ROWS):
            anchors = mix(anchors + minima[:, k::ROWS])
        found.append(anchors.view(np.int64))
    return np.concatenate(found)


def _said(sentence: str) -> int | None:
    """The fingerprint of the words of a sentence that has ``MIN_WORDS``."""
    if sentence.isascii():
        words = sentence.encode().translate(_PLAIN).split()
        joined = b" ".join(words)
    else:
        words = words_of(sentence)
        joined = " ".join(words)
    return xxhash.xxh3_64_intdigest(joined) - (1 << 63) if len(words) >= MIN_WORDS else None


def sentences_of(lines: list[str], own: list[int]) -> Iterator[tuple[list[int], str]]:
    """The sentences of the paragraphs of ``own`` lines, with the lines that each covers."""
    run: list[int] = []
    for k in [*own, -1]:
        if run and k != run[-1] + 1:
            text, at = "", []
            for j in run:
                at.append(len(text))
                text += lines[j].strip() + " "
            text, begin = text.rstrip(), 0
            for m in [*_END.finditer(text), None]:
                end = len(text) if m is None else m.start() + 1
                if end > begin:
                    yield run[bisect_right(at, begin) - 1 : bisect_left(at, end)], text[begin:end]
                begin = len(text) if m is None else m.end()
            run = []
        run.append(k)


def _lists(values: np.ndarray, there: np.ndarray) -> pa.ListArray:
    """A list for each row of ``values`` where ``there`` is set, NULL elsewhere."""
    ends = np.concatenate([[0], np.cumsum(there) * values.shape[1]]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, values.ravel(), mask=pa.array(~there))


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, MAILS):
            mails = batch.slice(begin, MAILS)
            rows = [(k, *row) for k, mail in enumerate(zip(*(mails.column(c).to_pylist() for c in ("headed", "sender", "text")), strict=True)) for row in _mail(*mail)]
            if not rows:
                continue
            of, own, tail, said, lines, sentence, figures = zip(*rows, strict=True)
            printed = np.array([x is not None for x in figures])
            kept = mails.select(["record_id", "thread", "position"]).take(pa.array(of))
            prints = _prints([x for x, there in zip(sentence, printed, strict=True) if there])
            made = [pa.array(own), pa.array(tail), pa.array(said, pa.int64()), pa.array(lines, pa.list_(pa.int32())), pa.array(sentence, pa.string()), pa.array(figures, pa.string()), _lists(prints, printed)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], [*kept.schema.names, "own", "tail", "said", "lines", "sentence", "figures", "print"])


def _mail(headed: bool, sender: str | None, text: str) -> Iterator[tuple[bool, bool, int | None, list[int], str | None, str | None]]:
    """``(own, tail, said, lines, sentence, figures)`` for each sentence of a mail."""
    skip = 0
    if headed:
        head, mark, body = text.partition("\n---\n")
        if mark:
            skip, text = head.count("\n") + 2, body
            sender = next((x[5:].strip() for x in head.split("\n") if x[:5].lower() == "from:"), None)
    lines = text.split("\n")
    own = own_lines(text, sender)
    mine, above, tails = set(own), None, set()
    for k, line in enumerate(lines):
        if line.strip():
            if k in mine and above is not None and (above in tails or (above not in mine and not is_quoted(lines[above]))):
                tails.add(k)
            above = k
    tokens = sender_tokens(sender)
    bare = [_MARKS.sub("", x) if is_quoted(x) else x for x in lines]
    named = next((k for k, (x, y) in enumerate(zip(lines, bare, strict=True)) if x == y and is_name(x, tokens)), len(lines))
    rest = [k for k, x in enumerate(bare) if k not in mine and x.strip()]
    for numbers, of in ((own, True), (rest, False)):
        for covered, sentence in sentences_of(bare, numbers):
            said, tail = _said(sentence), of and (covered[0] in tails or covered[0] > named)
            if not (of or said is not None):
                continue  # left to the layout
            compared = of and said is not None
            figures = " ".join(sorted(_FIGURES.findall(sentence))) if compared else None
            yield of, tail, said, [skip + k + 1 for k in covered], sentence if compared or tail else None, figures


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchors = _anchors(batch.column("sentence").to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.columns, _lists(anchors, np.ones(batch.num_rows, bool))], ["sentence", "mails", "anchors"])


def _most(a: str, b: str) -> Column:
    return F.floor(F.greatest(F.length(a), F.length(b)) * EDITS).cast("int")


def _near(a: str, b: str) -> Column:
    return (F.col(a) == F.col(b)) | (F.levenshtein(F.col(a), F.col(b)) <= _most(a, b))


def boilerplate(sentences: DataFrame) -> DataFrame:
    """``(sentence)``: what stands below the signatures of ``SHARED_BY`` mails, in nearly these words."""
    below = sentences.where("tail and sentence is not null").select("record_id", "sentence").distinct().groupBy("sentence").agg(F.count("*").alias("mails"))
    keyed = written(below.mapInArrow(_anchored, "sentence string, mails bigint, anchors array<bigint>")).select("sentence", "mails", F.explode("anchors").alias("anchor"))
    other = keyed.select(F.col("sentence").alias("other"), F.col("mails").alias("other_mails"), "anchor")
    met = keyed.join(other, "anchor").where(F.abs(F.length("sentence") - F.length("other")) <= _most("sentence", "other")).select("sentence", "other", "other_mails").distinct()
    near = met.where(_near("sentence", "other"))
    return near.groupBy("sentence").agg(F.sum("other_mails").alias("n")).where(F.col("n") >= SHARED_BY).select("sentence")


def repeated(sentences: DataFrame) -> DataFrame:
    """``(sentence_id)`` of sentences whose words an earlier mail of the thread has, by their fingerprints."""
    said = sentences.where("said is not null and thread is not null and position is not null")
    first = said.groupBy("thread", "said").agg(F.min("position").alias("since"), F.max("position").alias("last")).where("since < last")
    return said.select("thread", "said", "position", "sentence_id").join(first, ["thread", "said"]).where("position > since").select("sentence_id").distinct()


def inherited(sentences: DataFrame) -> DataFrame:
    """``(sentence_id)`` of the layout's sentences that an earlier mail of the thread said in nearly these words, with the same figures."""
    said = sentences.where("print is not null and thread is not null and position is not null")
    spans = said.groupBy("thread").agg(F.min("position").alias("begin"), F.max("position").alias("end")).where("begin < end").select("thread")
    texts = said.join(spans, "thread").groupBy("thread", "figures", "sentence").agg(F.min("position").alias("first"), F.max("position").alias("last"), F.any_value("print").alias("print"))
    texts = written(texts)
    earlier = texts.select("thread", "figures", F.col("sentence").alias("said"), F.col("first").alias("since"), F.col("print").alias("said_print"))
    most = _most("sentence", "said")
    different = sum((F.bit_count(F.get("print", F.lit(k)).bitwiseXOR(F.get("said_print", F.lit(k)))) for k in range(4)), F.lit(0))
    may = (F.col("since") < F.col("last")) & (F.abs(F.length("sentence") - F.length("said")) <= most) & (different <= 4 * most)
    found = texts.join(earlier, ["thread", "figures"]).where(may & _near("sentence", "said")).groupBy("thread", "sentence").agg(F.min("since").alias("since"))
    return said.join(found, ["thread", "sentence"]).where("position > since").select("sentence_id").distinct()


def _analysed(mails: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sentences of all mails, and ``(sentence_id, step)`` of those that fingerprints remove."""
    texts = spread(mails.where("record_id is not null and text is not null and text <> ''"))
    sentences = written(texts.mapInArrow(_sentences, SENTENCES).withColumn("sentence_id", F.xxhash64("record_id", "lines", "said", "sentence")))
    shared = written(boilerplate(sentences))
    tails = sentences.where("tail and sentence is not null").select("sentence_id", "sentence").join(shared, "sentence").select("sentence_id")
    steps = [(repeated(sentences), "repeated"), (inherited(sentences), "nearly repeated"), (tails, "boilerplate")]
    gone = [df.select("sentence_id", F.lit(step).alias("step")) for df, step in steps]
    return sentences, written(gone[0].unionByName(gone[1]).unionByName(gone[2]).groupBy("sentence_id").agg(F.max("step").alias("step")))


def newly_written(mails: DataFrame) -> DataFrame:
    """``mails(record_id, thread, position, headed, sender, text)`` to ``(record_id, line_no)``."""
    sentences, dropped = _analysed(mails)
    kept = sentences.where("own").select("record_id", "lines", "sentence_id").join(dropped, "sentence_id", "left_anti")
    return kept.select("record_id", F.explode("lines").alias("line_no")).distinct()


def removed_lines(mails: DataFrame) -> DataFrame:
    """``(step, lines)``: how many lines each step removes; a line that fingerprints remove is not counted for the layout."""
    sentences, dropped = _analysed(mails)
    of_lines = sentences.join(dropped, "sentence_id", "left").select("record_id", "own", "step", F.explode("lines").alias("line_no"))
    # a line stays if one of its sentences is the sender's own
    by_line = of_lines.groupBy("record_id", "line_no").agg(F.max(F.when(F.col("own") & F.col("step").isNull(), "written")).alias("kept"), F.max("step").alias("step"))
    counted = by_line.select(F.coalesce("kept", "step", F.lit("layout")).alias("step")).groupBy("step").agg(F.count("*").alias("lines"))
    filled = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    every = mails.where("record_id is not null and text is not null").select("record_id", "text").distinct().agg(F.sum(filled).alias("lines"))
    seen = counted.where("step <> 'layout'")
    layout = every.unionByName(seen.select(F.negative("lines").alias("lines"))).agg(F.sum("lines").alias("lines")).select(F.lit("layout").alias("step"), "lines")
    return seen.unionByName(layout)


def mail_texts(messages: DataFrame, extracted: DataFrame) -> DataFrame:
    """The bodies of messages and the texts of mail files, placed in their threads."""
    bodies = messages.select(F.col("message_id").alias("record_id"), F.when(F.col("document_id").isNotNull(), F.xxhash64("document_id")).alias("thread"), F.col("message_index").alias("position"), F.lit(False).alias("headed"), "sender", F.col("body").alias("text"))
    document = F.concat(F.lit("doc_"), F.sha2(F.col("source_path"), 256))
    files = extracted.where("is_email_thread").select(F.col("path").alias("record_id"), F.xxhash64(document).alias("thread"), F.size("messages").alias("position"), F.lit(True).alias("headed"), F.lit(None).cast("string").alias("sender"), "text")
    return bodies.unionByName(files)
