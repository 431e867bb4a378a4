"""Records that say nearly the same, by Golay-code fuzzy hashing.

Each text gets ``BANDS`` segments of 23 bits, a SimHash of its words weighted by how often they
occur.  A segment decodes to the Golay codewords within distance 4, one or six of them, so that
two segments that differ in at most two bits share a codeword.  The errors between two similar
texts spread over the segments: by the pigeonhole principle some segments have two or fewer.

A codeword has only 12 bits, far too few for a key of its own among millions of texts, and at the
similarity asked for (0.6) every eighth bit differs, so that keys of several segments would hardly
ever meet.  Each band therefore has an anchor, the minima of ``ROWS`` hash functions over the
three-word sequences: texts meet on the anchor and must have one of their codewords in common
there: the join on (anchor, codeword) is made as one on the anchor with the six codewords packed
into the row, as a row for each codeword would be five times as many.  Bits of 64 minima, kept in
the same row, drop the pairs that cannot be similar enough (``MAX_DIFFERENT`` lies four standard
deviations above what a similarity of 0.6 gives).  The rest is verified exactly on whole texts.

Exact copies are put into classes first and only class representatives are compared.  Links come
back for all members of classes of up to ``EXPAND`` copies; a larger class (one text may be a
third of the corpus) is given as its representative linked to each member, which keeps every
link between different texts without listing all pairs.

Defined results: texts that are NULL or have fewer than ``MIN_WORDS`` words give no pair; repeated
rows of one id count once; a record is never paired with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

from .golay import DATA, KEYS, near_codewords
from .words import hash_words, in_slabs, mix, shingle_hashes, words_of

SHINGLE = 3
SIMILARITY = 0.6
MIN_WORDS = 40
BANDS, ROWS = 26, 3
#: Bits of minima that travel with a text: a word of 64, and 52 beside a codeword.
BITS = (64, 52)
#: Of these bits of two texts that are similar enough, at most so many differ.
MAX_DIFFERENT = 43
EXPAND = 64
#: Words sketched, and records taken apart, at once in a task.
SLAB, RECORDS = 20_000, 250
#: A task forgets which texts it has sketched, and the sequences of texts, when it holds so many; the first are only a thinning, the others a cache.
SEEN, CACHE = 200_000, 4_000

SKETCH = "row_hash bigint, anchors array<bigint>, codewords array<bigint>, mixed array<bigint>, bits bigint"


def _segments(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """``BANDS`` 23-bit words for each text: the majority of the bits of its words."""
    different, place = np.unique(hashes, return_inverse=True)
    lanes = -(-BANDS * 24 // 64)
    spread = np.stack([mix(different + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) for k in range(lanes)], axis=1)
    bits = np.unpackbits(spread.view(np.uint8), axis=1)[:, : BANDS * 24].astype(np.float32) * 2 - 1
    counts = np.bincount(owner * len(different) + place, minlength=texts * len(different)).reshape(texts, -1).astype(np.float32)
    majority = (counts @ bits > 0).reshape(texts, BANDS, 24)[:, :, :23]
    return majority @ (1 << np.arange(23, dtype=np.int64))


_FACTORS = mix(np.arange(1, 2 * BANDS * ROWS, 2, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mix(np.arange(2, 2 * BANDS * ROWS + 1, 2, dtype=np.uint64))


def _minima(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the word sequences of each text."""
    shingles = mix(mix(mix(hashes[:-2]) + hashes[1:-1]) * np.uint64(3) + hashes[2:])
    # a sequence across the end of a text takes the value of that text's last one
    last = np.repeat(starts + lengths - SHINGLE, lengths)
    shingles = shingles[np.minimum(np.arange(len(hashes)), last)]
    return np.stack([np.minimum.reduceat(shingles * f + s, starts) for f, s in zip(_FACTORS, _SHIFTS, strict=True)], axis=1)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: set[int] = set()
    for batch in in_slabs(batches, RECORDS):
        # copies within a task are sketched once, so that no text of many records is a hot key
        batch = batch[~batch["row_hash"].isin(known)].drop_duplicates("row_hash", ignore_index=True)
        known = known if len(known) < SEEN else set()
        known.update(batch["row_hash"])
        words = [words_of(t) for t in batch["text"]]
        sizes = np.array([len(w) for w in words], np.int64)
        fit = np.flatnonzero(sizes >= MIN_WORDS)
        slabs = np.cumsum(sizes[fit]) // SLAB
        for slab in np.unique(slabs):
            at = fit[slabs == slab]
            lengths = sizes[at]
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            hashes = hash_words([w for i in at for w in words[i]])
            minima = _minima(hashes, starts, lengths)
            segments = _segments(hashes, np.repeat(np.arange(len(at)), lengths), len(at))
            # texts of one kind only meet
            kinds = hash_words(list(batch["kind"].iloc[at]))
            anchors = mix(kinds[:, None] + np.arange(1, BANDS + 1, dtype=np.uint64))
            for k in range(ROWS):
                anchors = mix(anchors + minima[:, k::ROWS])
            near = near_codewords(segments.ravel())
            near = np.where(near < 0, near[:, :1], near).astype(np.uint64).reshape(len(at), BANDS, KEYS)
            five = sum(near[:, :, k] << np.uint64(DATA * k) for k in range(KEYS - 1))
            low, high = (np.packbits((minima[:, :64] >> np.uint64(k) & np.uint64(1)).astype(bool), axis=1).view(np.uint64).ravel() for k in (20, 40))
            sixth = near[:, :, KEYS - 1] | (high << np.uint64(DATA))[:, None]
            sketch = {"anchors": list(anchors.view(np.int64)), "codewords": list(five.view(np.int64)), "mixed": list(sixth.view(np.int64)), "bits": low.view(np.int64)}
            yield batch.iloc[at][["row_hash"]].assign(**sketch)


def _verify(similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, np.ndarray] = {}
        for batch in in_slabs(batches, RECORDS):
            seen = seen if len(seen) < CACHE else {}
            values = []
            for a, b, text_a, text_b in zip(*(batch[c] for c in ("hash_a", "hash_b", "text_a", "text_b")), strict=True):
                for key, text in ((a, text_a), (b, text_b)):
                    if key not in seen:
                        seen[key] = np.unique(shingle_hashes(hash_words(words_of(text)), SHINGLE))
                both = len(np.intersect1d(seen[a], seen[b], assume_unique=True))
                values.append(both / (len(seen[a]) + len(seen[b]) - both))
            kept = batch[["hash_a", "hash_b"]].assign(similarity=values)
            yield kept[kept["similarity"] >= similarity - 1e-12]

    return run


def _digested(records: DataFrame) -> DataFrame:
    """``(kind, id, row_hash, text)``: the hash is that of the kind and the whole text."""
    texts = records.where("id is not null and text is not null")
    return texts.select("kind", "id", F.xxhash64("kind", F.md5(F.encode("text", "UTF-8"))).alias("row_hash"), "text")


def classes(records: DataFrame) -> DataFrame:
    """``(kind, id, row_hash, representative, copies)``: the class of exact copies of each record that is long enough."""
    long_enough = _digested(records).where(F.regexp_count(F.lower("text"), F.lit(r"[\p{L}\p{N}]+")) >= MIN_WORDS)
    marked = long_enough.select("kind", "id", "row_hash").distinct()
    heads = marked.groupBy("row_hash").agg(F.min("id").alias("representative"), F.count("*").alias("copies"))
    return marked.join(heads, "row_hash")


def _codewords(side: str) -> Column:
    """The six codewords of a segment: five in one word, the last in the low bits of another."""
    five = (F.shiftrightunsigned(F.col(f"{side}.codewords"), DATA * k).bitwiseAND(F.lit((1 << DATA) - 1)) for k in range(KEYS - 1))
    return F.array(*five, F.col(f"{side}.mixed").bitwiseAND(F.lit((1 << DATA) - 1)))


def candidates(sketches: DataFrame) -> DataFrame:
    """``(hash_a, hash_b)``: texts that meet on an anchor, share a codeword there and may be similar enough."""
    # one exchange by anchor serves the removal of copies and both sides of the join
    bands = sketches.select("row_hash", "bits", F.inline(F.arrays_zip("anchors", "codewords", "mixed")).alias("anchor", "codewords", "mixed"))
    bands = bands.repartition("anchor").dropDuplicates(["anchor", "row_hash"])
    differ = lambda x, drop=0: F.bit_count(F.shiftrightunsigned(F.col(f"a.{x}").bitwiseXOR(F.col(f"b.{x}")), drop))
    may = (F.col("a.row_hash") < F.col("b.row_hash")) & (differ("bits") + differ("mixed", DATA) <= MAX_DIFFERENT)
    met = bands.alias("a").join(bands.alias("b"), "anchor").where(may & F.arrays_overlap(_codewords("a"), _codewords("b")))
    return met.select(F.col("a.row_hash").alias("hash_a"), F.col("b.row_hash").alias("hash_b")).distinct()


def links(records: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(hash_a, hash_b, similarity)``: pairs of different texts of one kind, by the hashes of their classes."""
    texts = _digested(records).select("row_hash", "kind", "text")
    pairs = candidates(texts.mapInPandas(_sketch, SKETCH))
    # one text for each class, moved once: both sides of the verification read the same exchange
    heads = texts.select("row_hash", "text").dropDuplicates(["row_hash"])
    left, right = heads.toDF("hash_a", "text_a"), heads.toDF("hash_b", "text_b")
    both = pairs.join(left, "hash_a").join(right, "hash_b").select("hash_a", "hash_b", "text_a", "text_b")
    return both.mapInPandas(_verify(similarity), "hash_a bigint, hash_b bigint, similarity double")


def near_duplicate_pairs(records: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(kind, id_a, id_b)`` of records of one kind that say nearly the same, the smaller id first."""
    member = cut_lineage(classes(records))
    found = cut_lineage(links(records, similarity))
    shown = member.where((F.col("copies") <= EXPAND) | (F.col("id") == F.col("representative"))).select("row_hash", "kind", "id")
    one, two = shown.select(F.col("row_hash").alias("hash_a"), "kind", F.col("id").alias("x")), shown.select(F.col("row_hash").alias("hash_b"), F.col("id").alias("y"))
    across = found.join(one, "hash_a").join(two, "hash_b").select("kind", "x", "y")
    few = member.where(F.col("copies").between(2, EXPAND))
    within = few.select("row_hash", "kind", F.col("id").alias("x")).join(few.select("row_hash", F.col("id").alias("y")), "row_hash").where("x < y").select("kind", "x", "y")
    star = member.where((F.col("copies") > EXPAND) & (F.col("id") != F.col("representative"))).select("kind", F.col("representative").alias("x"), F.col("id").alias("y"))
    every = across.unionByName(within).unionByName(star).where("x <> y")
    return every.select("kind", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def text_records(messages: DataFrame, documents: DataFrame) -> DataFrame:
    """The bodies of mails and the contents of documents as ``(kind, id, text)``."""
    mail = messages.select(F.lit("mail").alias("kind"), F.col("message_id").alias("id"), F.col("body").alias("text"))
    return mail.unionByName(documents.select(F.lit("document").alias("kind"), F.col("document_id").alias("id"), F.col("content").alias("text")))
