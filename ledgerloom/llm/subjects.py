"""Subject areas of documents, by labels propagated over a document graph.

The graph has documents and the terms (words and two-word phrases) they share; two documents are
as similar as the terms between them say, so one step from documents to terms and back is a step
over the document-similarity graph, whose own edges would be quadratic in the documents of a
subject.  Terms are verified before they carry anything: those that documents of any subject use
alike are no edges.

1. Terms are learnt from all documents.  A term belongs to a subject if the documents rated so have it
   beyond chance (a likelihood ratio of ``EVIDENCE``) and clearly more than those of any other.  In
   ``LEARNING`` further rounds the terms label the documents that they reach, rated ones by their
   ratings only, and these teach further terms, with the documents that nothing reaches as evidence
   against; each round counts every document in tasks, a task sends a row for each term and subject it
   has met, the sums meet in Spark.
2. One scan of all documents finds every occurrence of every term learnt, a list for each
   document; these lists are the edges of the graph.
3. Labels go from documents to terms and back in ``ROUNDS`` rounds over all documents: a task has
   the edges of its documents and adds up its terms, the sums are merged in Spark.  Rated documents
   are clamped to their ratings each time, all of them, and a document keeps every subject above
   ``KEEP``.  The subject of each term goes to the tasks; the terms learnt are a vocabulary,
   which grows far slower than the documents.
4. A sentence deals with the subjects of its terms; the labels that the last step brings back to a
   document are the subjects that a fifth of its sentences deal with.  Trusted seeds stay: a rating
   that its document's terms bear out at all (``KEEP``) is given whatever its share, and a document
   rated ``none`` gets no subject below ``DOUBT``.  Raters err, so other ratings give way.

Defined results: NULL or empty texts have no subject; unlabelled corpora give no rows; ratings of
unknown documents and ratings ``none`` carry no subject; repeated ratings count once per rater, and a
document that is stored several times with one text counts once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage, spread, written

from .words import hash_words, mix

LEARNING, ROUNDS = 2, 2
#: A term is learnt from so many documents of its subject at least: rated ones, and reached ones.
MIN_DOCUMENTS, MIN_REACHED = 2, 5
#: The log likelihood ratio of a term against chance.
EVIDENCE = 4.5
#: The share of a term's sentences in rated documents, and in all, that stand in documents of its subject, and how many times that of the next subject it is.
PURITY, REACHED, MARGIN = 0.45, 0.5, 1.8
KEEP, SHARE, DOUBT = 0.12, 0.2, 0.35
MIN_WORDS = 4
#: Bytes of documents scanned at once in a task, where each document counts as so many at least.
SLAB, LEAST = 2_500_000, 1_000
#: Rows of counts that a task adds up before it sends them, and sends at once.
HELD, SENT = 1_500_000, 50_000
#: Ratings of so many documents are broadcast; beyond that Spark joins them as it sees fit.
MAX_BROADCAST = 500_000
#: Only for ``sampled``, which nothing here uses.
MAX_LABELLED = 20_000

#: Bits of the table that terms are looked up in first, at most.
MAX_BITS = 24

LETTER, MARK, BLANK, LINE_END, OTHER = range(5)
#: What each byte of a text is; those of letters and digits beyond ASCII are letters, what else is beyond it gives way to a blank or a dash.
_KINDS = bytes(LETTER if k > 127 or chr(k).isalnum() else MARK if chr(k) in ".!?" else LINE_END if k == 10 else BLANK if chr(k).isspace() else OTHER for k in range(256))
_NO_LETTER = re.compile(r"[^\x00-\x7f\w]")
#: Bytes of a word that are compared eight at a time; longer ones are hashed as they are.
LONG_WORD = 256
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: The lists of a document are the bytes of its numbers: one value for Spark to move, not one for each word.
WORDS = "doc_id bigint, rated array<string>, words binary, sizes binary"
TERMS = "doc_id bigint, rated array<string>, sentences int, at binary, terms binary"
COUNTS = "term bigint, subject int, docs bigint, n bigint"
LABELS = "doc_id bigint, subject string, share double"
SUMS = "term int, subject int, n bigint"


class Found(NamedTuple):
    """The words and phrases of a batch, each once in a sentence, ordered by term and sentence."""

    terms: np.ndarray  # the hash of each different one
    which: np.ndarray  # the place among them of each occurrence
    sentence: np.ndarray  # its sentence, counted through the batch
    rows: np.ndarray  # the row of each sentence
    counts: np.ndarray  # the number of sentences of each row


def _slabs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches in pieces of ``SLAB`` bytes; a longer document is a piece of its own or the last of one."""
    for batch in batches:
        lists = batch[next(x for x in ("text", "words", "terms") if x in batch)]
        size = np.fromiter((len(x) + LEAST if x else LEAST for x in lists), np.int64, len(batch))
        bounds = [0, *np.flatnonzero(np.diff((np.cumsum(size) - size) // SLAB)) + 1, len(batch)]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end > begin:
                yield batch.iloc[begin:end].reset_index(drop=True)


def _sentences(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the words in all sentences of a batch, and the number of words and the row of each sentence; from its texts, or as ``_read`` has kept them.

    A sentence ends at a line end and at a blank after one of the marks ``.!?``.
    """
    if "words" in batch:
        return _flat(batch["words"], np.uint64)[0], *_flat(batch["sizes"], np.int32)
    texts = [x.lower() if x else "" for x in batch["text"]]
    encoded = [(x if x.isascii() else _NO_LETTER.sub(lambda m: " " if m[0].isspace() else "-", x)).encode("utf-8", "surrogatepass") for x in texts]
    text = b"\n".join(encoded) + b"\n"
    kinds = np.frombuffer(text.translate(_KINDS), np.uint8)
    edges = np.flatnonzero(np.diff(kinds == LETTER, prepend=False))
    begin, end = edges[::2], edges[1::2]
    ends = kinds == LINE_END
    ends[1:] |= (kinds[1:] == BLANK) & (kinds[:-1] == MARK)
    last = np.flatnonzero(ends)
    sizes = np.diff(np.searchsorted(begin, last), prepend=0)
    long = sizes >= MIN_WORDS
    after = np.cumsum([len(x) + 1 for x in encoded], dtype=np.int64)
    taken = np.repeat(long, sizes)
    return _word_hashes(text, begin[taken], end[taken]), sizes[long], np.searchsorted(after, last[long], side="right")


def _word_hashes(text: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``hash_words`` of the words from ``begin`` to ``end``; each different one is taken from the text once.

    Words of up to eight bytes are their own keys, longer ones have a 64-bit hash of them, which holds in this call only.
    """
    eights = np.ndarray((len(text),), np.uint64, text + bytes(8), strides=(1,))  # the eight bytes from each place
    size = end - begin
    key = eights[begin] & _FIRST_BYTES[np.minimum(size, 8)]
    rest, at = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
    while len(rest):
        key[rest] = mix(mix(key[rest] + np.uint64(at)) + (eights[begin[rest] + at] & _FIRST_BYTES[np.minimum(size[rest] - at, 8)]))
        at += 8
        rest = rest[size[rest] > at]
    for k in np.flatnonzero(size > LONG_WORD):
        key[k] = xxhash.xxh3_64_intdigest(text[begin[k] : end[k]])
    code, different = pd.factorize(key)
    first = np.zeros(len(different), np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    words = [text[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
    return hash_words(words)[code]


def _split(values: np.ndarray, rows: np.ndarray, n: int) -> list[np.ndarray]:
    """The values of each of ``n`` rows; ``rows`` has the row of each value, in order."""
    bounds = np.searchsorted(rows, np.arange(n + 1))
    return [values[bounds[k] : bounds[k + 1]] for k in range(n)]


def _packed(lists: list[np.ndarray]) -> list[bytes]:
    return [x.tobytes() for x in lists]


def _flat(packed: pd.Series, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists, and the row of each."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // np.dtype(kind).itemsize
    values = np.frombuffer(b"".join(packed), kind)
    return values if kind is np.uint64 else values.astype(np.int64), np.repeat(np.arange(len(packed)), sizes)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each text, for several scans."""
    for batch in _slabs(batches):
        hashes, sizes, rows = _sentences(batch)
        words = _split(hashes, np.repeat(rows, sizes), len(batch))
        yield batch.drop(columns="text").assign(words=_packed(words), sizes=_packed(_split(sizes.astype(np.int32), rows, len(batch))))


def _found(batch: pd.DataFrame) -> Found:
    hashes, sizes, rows = _sentences(batch)
    of = np.repeat(np.arange(len(sizes)), sizes)
    code, different = pd.factorize(hashes)
    m, inside = max(len(different), 1), of[:-1] == of[1:]
    every = np.concatenate([code, (code[:-1] * m + code[1:] + m)[inside]]).astype(np.int64)
    kinds, bits = None, len(sizes).bit_length()
    if (m * m + m).bit_length() + bits > 63:
        every, kinds = pd.factorize(every)
    key = (every << bits) | np.concatenate([of, of[:-1][inside]])
    key.sort()
    key = key[np.diff(key, prepend=-1) > 0]
    term = key >> bits
    first = np.diff(term, prepend=-1) > 0
    kind = term[first] if kinds is None else kinds[term[first]]
    left, right = np.divmod(np.maximum(kind - m, 0), m)
    terms = np.where(kind < m, different[np.minimum(kind, m - 1)], mix(different[left] * np.uint64(3) + different[right])).view(np.int64)
    return Found(terms, np.cumsum(first) - 1, key & ((1 << bits) - 1), rows, np.bincount(rows, minlength=len(batch)))


def _places(known: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The place of each term among the known ones, which are sorted, else -1."""
    if not len(known):
        return np.full(len(terms), -1)
    place = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    return np.where(known[place] == terms, place, -1)


def _counted(found: Found, labels: np.ndarray, new: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """How many documents and sentences have each term, by the documents' subjects and (as subject -1) at all; term 0 counts the documents themselves.

    ``labels`` has a row for each document and a column for each subject; only terms that are ``new`` count, where given.
    """
    names = labels.shape[1]
    row = found.rows[found.sentence]
    begin = np.flatnonzero((np.diff(found.which, prepend=-1) > 0) | (np.diff(row, prepend=-1) != 0))
    n = np.diff(begin, append=len(row))
    if new is not None:
        n, begin = n[new[found.which[begin]]], begin[new[found.which[begin]]]
    which = found.which[begin]
    labelled, subject = np.nonzero(labels)
    size = np.bincount(labelled, minlength=len(labels))
    many = size[row[begin]]
    pair = np.repeat(np.arange(len(begin)), many)  # a document's term goes to each subject of the document
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
    cell = which[pair] * names + subject[(np.cumsum(size) - size)[row[begin]][pair] + nth]
    sums = lambda at, n, size: (np.bincount(at, minlength=size), np.bincount(at, n, minlength=size).astype(np.int64))
    (docs, total), (own_docs, own) = sums(which, n, len(found.terms)), sums(cell, n[pair], len(found.terms) * names)
    any_, of = np.flatnonzero(docs), np.flatnonzero(own_docs)
    base = np.array([len(labels), *labels.sum(axis=0)], np.int64)
    return (
        np.concatenate([found.terms[any_], found.terms[of // max(names, 1)], np.zeros(len(base), np.int64)]),
        np.concatenate([np.full(len(any_), -1), of % max(names, 1), np.arange(-1, names)]).astype(np.int32),
        np.concatenate([docs[any_], own_docs[of], base]).astype(np.int32),
        np.concatenate([total[any_], own[of], base]).astype(np.int32),
    )


def _added(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pd.DataFrame]:
    """The counts of a task, added up while they are few enough to hold."""
    held: list[tuple[np.ndarray, ...]] = []

    def added() -> tuple[np.ndarray, ...]:
        term, subject, docs, n = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        key = pd.factorize(term)[0].astype(np.int64) * (int(subject.max()) + 2) + subject + 1
        order = np.argsort(key)
        begin = np.flatnonzero(np.diff(key[order], prepend=-1))
        one = order[begin]
        return term[one], subject[one], np.add.reduceat(docs[order], begin), np.add.reduceat(n[order], begin)

    def sent(counts: tuple[np.ndarray, ...]) -> Iterator[pd.DataFrame]:
        for k in range(0, len(counts[0]), SENT):
            yield pd.DataFrame(dict(zip(("term", "subject", "docs", "n"), (x[k : k + SENT] for x in counts), strict=True)))

    for part in parts:
        held.append(part)
        if sum(len(x[0]) for x in held) > HELD:
            held.append(added())
            if len(held[0][0]) > HELD // 2:
                yield from sent(held.pop())
    if held:
        yield from sent(added())


def _ratings(rated: pd.Series, names: list[str]) -> np.ndarray:
    """The ratings of a batch as a table of documents and subjects; documents without one have them all."""
    code = {x: k for k, x in enumerate(names)}
    out = np.ones((len(rated), len(names)), bool)
    for k, r in enumerate(rated):
        if r is not None:
            out[k] = False
            out[k, [code[x] for x in r]] = True
    return out


def _rated_counts(names: list[str]):
    """Counts over rated documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _added(_counted(_found(batch), _ratings(batch["rated"], names)) for batch in _slabs(batches))

    return run


def _reached_counts(known: np.ndarray, subject: np.ndarray, names: list[str]):
    """Counts over documents whose sentences the known terms reach; documents that none reaches count against every subject."""

    def counted(batch: pd.DataFrame) -> tuple[np.ndarray, ...]:
        found = _found(batch)
        place = _places(known, found.terms)
        hit = place[found.which] >= 0
        said = np.unique(found.sentence[hit] * len(names) + subject[place[found.which[hit]]])
        cell = found.rows[said // len(names)] * len(names) + said % len(names)
        share = np.bincount(cell, minlength=len(batch) * len(names)).reshape(len(batch), -1) / np.maximum(found.counts, 1)[:, None]
        return _counted(found, (share >= SHARE - 1e-9) & _ratings(batch["rated"], names), place < 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _added(map(counted, _slabs(batches)))

    return run


def _occurrences(known: np.ndarray):
    """Every known term of each sentence, once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = (1 << min(MAX_BITS, (16 * len(known)).bit_length())) - 1
        likely = np.zeros(mask + 1, bool)
        likely[known & mask] = True
        for batch in _slabs(batches):
            hashes, sizes, rows = _sentences(batch)
            of = np.repeat(np.arange(len(sizes)), sizes)
            inside = np.flatnonzero(of[:-1] == of[1:])
            terms = np.concatenate([hashes, mix(hashes[inside] * np.uint64(3) + hashes[inside + 1])]).view(np.int64)
            at = np.flatnonzero(likely[terms & mask])
            place = _places(known, terms[at])
            sentence = np.concatenate([of, of[inside]])[at]
            key = np.unique(sentence[place >= 0] * max(len(known), 1) + place[place >= 0])
            sentence, place = key // max(len(known), 1), (key % max(len(known), 1)).astype(np.int32)
            row, counts = rows[sentence], np.bincount(rows, minlength=len(batch))
            number = (sentence - (np.cumsum(counts) - counts)[row]).astype(np.int32)
            kept = batch[[x for x in ("doc_id", "rated") if x in batch]]
            yield kept.assign(sentences=counts.astype(np.int32), at=_split(number, row, len(batch)), terms=_split(place, row, len(batch)))

    return run


def _edges(known: np.ndarray):
    """``_occurrences`` as they are stored."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in _occurrences(known)(batches):
            yield found.assign(at=_packed(found["at"]), terms=_packed(found["terms"]))

    return run


def _said(batch: pd.DataFrame, subject: np.ndarray, names: int) -> np.ndarray:
    """The share of the sentences of each document that have a term of each subject."""
    terms, rows = _flat(batch["terms"], np.int32)
    sentences, _ = _flat(batch["at"], np.int32)
    of = subject[terms]
    rows, sentences, of = rows[of >= 0], sentences[of >= 0], of[of >= 0]
    width = int(sentences.max(initial=0)) + 1
    different = np.unique((rows * width + sentences) * names + of)
    counts = np.bincount(different // names // width * names + different % names, minlength=len(batch) * names).reshape(len(batch), names)
    return counts / np.maximum(batch["sentences"].to_numpy(), 1)[:, None]


def _clamped(subject: np.ndarray, names: list[str]):
    """``(doc_id, subject, share)``: the labels of the last step, trusted ratings among them."""
    code = {x: k for k, x in enumerate(names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slabs(batches):
            share = _said(batch, subject, len(names))
            least = np.full(share.shape, SHARE - 1e-9)
            for k, rated in enumerate(batch["rated"]):
                if rated is not None:
                    least[k] = least[k] if len(rated) else DOUBT
                    least[k, [code[x] for x in rated]] = KEEP
            row, which = np.nonzero(share >= least)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[row], "subject": np.array(names, object)[which], "share": share[row, which]})

    return run


def _term_sums(subject: np.ndarray, names: list[str]):
    """How often each term stands in documents of each subject, and (as subject -1) at all."""
    code = {x: k for k, x in enumerate(names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(names) + 1, len(subject)), np.int64)
        for batch in _slabs(batches):
            labels = _said(batch, subject, len(names)) >= KEEP
            for k, rated in enumerate(batch["rated"]):
                if rated is not None:
                    labels[k] = False
                    labels[k, [code[x] for x in rated]] = True
            terms, rows = _flat(batch["terms"], np.int32)
            for k in range(len(names)):
                sums[k] += np.bincount(terms[labels[rows, k]], minlength=len(subject))
            sums[-1] += np.bincount(terms, minlength=len(subject))
        which, term = np.nonzero(sums)
        yield pd.DataFrame({"term": term.astype(np.int32), "subject": np.where(which == len(names), -1, which).astype(np.int32), "n": sums[which, term]})

    return run


def _next_subjects(sums: pd.DataFrame, terms: int, names: int) -> np.ndarray:
    """The one subject of each term that is clearly its own, else -1."""
    counts = np.zeros((terms, names + 2))
    counts[sums["term"], sums["subject"]] = sums["n"]  # -1 is the last column; the one before it stays empty
    purity = counts[:, : names + 1] / np.maximum(counts[:, -1:], 1)
    ranked = np.sort(purity, axis=1)
    clear = (ranked[:, -1] >= PURITY) & (ranked[:, -1] >= MARGIN * ranked[:, -2])
    return np.where(clear, purity.argmax(axis=1), -1)


def seeds(labels: DataFrame) -> DataFrame:
    """``(doc_id, subject)``: what raters say, unless as many say ``none``."""
    votes = labels.where("doc_id is not null and subject is not null").select("doc_id", "subject", "labelled_by").distinct().groupBy("doc_id", "subject").agg(F.count("*").alias("n"))
    none = votes.where("subject = 'none'").select("doc_id", F.col("n").alias("against"))
    return votes.where("subject <> 'none'").join(none, "doc_id", "left").where("against is null or n > against").select("doc_id", "subject")


def sampled(rated_docs: DataFrame) -> DataFrame:
    """At most ``MAX_LABELLED`` rated documents, by a hash; ``document_subjects`` learns from all and does not use it."""
    return rated_docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)


def learnt_terms(sums: DataFrame, least: int, purity: float, margin: float) -> DataFrame:
    """``(term, subject)``: the one subject that each term clearly belongs to, by ``sums(term, subject, docs, n)``."""
    cells = sums.repartition("term").groupBy("term", "subject").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    own = F.col("subject") >= 0
    by_term = cells.groupBy("term").agg(
        F.max(F.when(own, F.struct("n", "docs", "subject"))).alias("best"),
        F.sort_array(F.collect_list(F.when(own, F.col("n"))), asc=False).alias("ranked"),
        F.max(F.when(~own, F.col("docs"))).alias("all_docs"),
        F.max(F.when(~own, F.col("n"))).alias("total"),
        F.collect_list(F.when(F.col("term") == 0, F.struct("subject", "docs"))).alias("base"),
    )
    kept = cut_lineage(by_term.where((F.col("best.docs") >= least) | (F.col("term") == 0)))
    base = {x["subject"]: x["docs"] for r in kept.where("term = 0").select("base").collect() for x in r["base"]}  # one for each subject
    size = F.lit(float(max(base.get(-1, 0), 1)))
    chance = F.element_at(F.create_map(*(F.lit(x) for k, n in (base or {-1: 0}).items() for x in (k, float(n)))), F.col("subject")) / size
    found = kept.where("term <> 0").select("term", "best.*", F.coalesce(F.get("ranked", F.lit(1)), F.lit(0)).alias("second"), "all_docs", "total").withColumn("chance", chance)
    share, rest = F.col("docs") / F.col("all_docs"), F.col("all_docs") - F.col("docs")
    ratio = F.col("docs") * F.log(share / F.col("chance")) + F.when(rest > 0, rest * F.log((1 - share) / (1 - F.col("chance")))).otherwise(0.0)
    clear = (F.col("n") >= purity * F.col("total")) & (F.col("n") >= margin * F.col("second"))
    return found.where(clear & (share > F.col("chance")) & (ratio >= EVIDENCE)).select("term", "subject")


def _once(texts: DataFrame) -> DataFrame:
    """``texts`` without rows that are stored again; only documents that have several rows are compared."""
    again = cut_lineage(texts.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return texts
    return written(texts.join(again, "doc_id", "left_anti").unionByName(texts.join(again, "doc_id", "left_semi").distinct()))


def _rated_words(texts: DataFrame, clamps: DataFrame) -> DataFrame:
    """The words of each text and its ratings (NULL where there is none), written for several scans."""
    few = clamps.count() <= MAX_BROADCAST
    return written(spread(texts).join(F.broadcast(clamps) if few else clamps, "doc_id", "left").mapInPandas(_read, WORDS))


def document_subjects(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, subject, share)`` of the subjects that at least ``SHARE`` of a document's sentences deal with."""
    rated = cut_lineage(seeds(labels))
    names = sorted(r["subject"] for r in rated.select("subject").distinct().collect())
    none = labels.where("subject = 'none'").select("doc_id")
    rated_docs = labels.where("doc_id is not null").select("doc_id").distinct().join(rated.select("doc_id").unionByName(none).distinct(), "doc_id", "left_semi")
    clamps = cut_lineage(rated_docs.join(rated, "doc_id", "left").groupBy("doc_id").agg(F.collect_set("subject").alias("rated")))
    words = _rated_words(_once(documents.select("doc_id", "text").where("doc_id is not null")).where("text is not null"), clamps)
    # terms are known by their place from here on
    learnt = learnt_terms(words.where("rated is not null").mapInPandas(_rated_counts(names), COUNTS), MIN_DOCUMENTS, PURITY, MARGIN).toPandas()
    for _ in range(LEARNING):
        learnt = learnt.sort_values("term", ignore_index=True)
        if len(learnt):
            reached = words.mapInPandas(_reached_counts(learnt["term"].to_numpy(np.int64), learnt["subject"].to_numpy(np.int64), names), COUNTS)
            learnt = pd.concat([learnt, learnt_terms(reached, MIN_REACHED, REACHED, MARGIN).toPandas()])
    learnt = learnt.sort_values("term", ignore_index=True)
    known, subject = learnt["term"].to_numpy(np.int64), learnt["subject"].to_numpy(np.int64)
    if not len(known):
        return rated.select("doc_id", "subject", F.lit(1.0).alias("share")).where(F.lit(False))
    found = written(words.mapInPandas(_edges(known), TERMS))
    for _ in range(ROUNDS):
        sums = found.select("sentences", "at", "terms", "rated").mapInPandas(_term_sums(subject, names), SUMS).groupBy("term", "subject").agg(F.sum("n").alias("n"))
        subject = _next_subjects(sums.toPandas(), len(known), len(names))
    # a rating that the terms bear out stays, whatever its share
    shares = found.select("doc_id", "sentences", "at", "terms", "rated").mapInPandas(_clamped(subject, names), LABELS)
    return shares.groupBy("doc_id", "subject").agg(F.max("share").alias("share"))
