import itertools
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import golay, history, leaks, names, near_duplicates, own_lines, packing, private_data, scan_noise, subjects
from ledgerloom.llm.words import hash_words, window_prints, words_of

RNG = random.Random(7)
VOCABULARY = [f"w{k}" for k in range(400)]


def sentence(n=12):
    return " ".join(RNG.choices(VOCABULARY, k=n))


# ---------------------------------------------------------------- 1


def test_golay_shares_a_codeword_within_two_bits():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 3000)
    a, b = rng.integers(0, 23, 3000), rng.integers(0, 23, 3000)
    other = words ^ (1 << a) ^ np.where(a == b, 0, 1 << b)
    near, far = golay.near_codewords(words), golay.near_codewords(other)
    assert set(np.unique((near >= 0).sum(axis=1))) == {1, 6}
    assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(near, far, strict=True))


def _pairs(rows):
    sets = {}
    for kind, key, text in rows:
        w = words_of(text)
        if key is not None and len(w) >= 40:
            sets[kind, key] = set(zip(w, w[1:], w[2:], strict=False))
    return {(a[0], a[1], b[1]) for a in sets for b in sets if a[0] == b[0] and a[1] < b[1] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}


def test_near_duplicates_against_all_pairs(spark):
    rows = [("mail", None, sentence(50)), ("mail", "null", None), ("mail", "empty", ""), ("mail", "short", sentence(10)), ("document", "short2", "x")]
    for k in range(40):
        text = [sentence() for _ in range(12)]
        rows.append(("mail", f"a{k}", ". ".join(text)))
        for v in range(3):
            edited = " ".join(text).split()
            for _ in range(RNG.randint(0, 9)):
                edited[RNG.randrange(len(edited))] = RNG.choice(VOCABULARY)
            rows.append((RNG.choice(["mail", "document"]), f"b{k}-{v}", " ".join(edited)))
    rows += [("mail", f"copy{k}", rows[6][2]) for k in range(3)]
    rows.append(("mail", "long", sentence(30_000)))
    frame = spark.createDataFrame(rows + rows[:9], "kind string, id string, text string").withColumn("digest", F.lit("clash"))
    got = {tuple(r) for r in near_duplicates.near_duplicate_pairs(frame).select("kind", "id_a", "id_b").collect()}
    want = _pairs(rows)
    assert got <= want and len(got) >= 0.97 * len(want)


def test_large_class_is_a_star(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "EXPAND", 3)
    text = sentence(60)
    frame = spark.createDataFrame([("mail", f"c{k}", text) for k in range(6)], "kind string, id string, text string")
    got = {tuple(r) for r in near_duplicates.near_duplicate_pairs(frame).select("id_a", "id_b").collect()}
    assert got == {("c0", f"c{k}") for k in range(1, 6)}
    assert near_duplicates.near_duplicate_pairs(frame.where("false")).count() == 0


def test_copies_meet_once(spark, monkeypatch):
    text = sentence(80)
    near = [" ".join([*text.split()[:-k], *sentence(k).split()]) for k in (3, 5)]
    rows = [("mail", f"c{k:03}", text) for k in range(100)] + [("mail", f"n{k}", x) for k, x in enumerate(near)] + [("mail", f"o{k}", sentence(80)) for k in range(150)]
    records = spark.createDataFrame(rows, "kind string, id string, text string")
    seen, candidates = [], near_duplicates.candidates
    monkeypatch.setattr(near_duplicates, "candidates", lambda sketches: seen.append(sketches.count()) or candidates(sketches))
    got = {(r["id_a"], r["id_b"]) for r in near_duplicates.near_duplicate_pairs(records.repartition(4)).collect()}
    assert 153 <= seen[0] <= 156  # once in each task
    assert {("c000", f"c{k:03}") for k in range(1, 100)} <= got and {("c000", "n0"), ("c000", "n1"), ("n0", "n1")} <= got


# ---------------------------------------------------------------- 2


def test_layout():
    lines = "FILE NOTE: NEXUS\n\nThe payroll manager treats the appeal as conse- \nrvative and wants more than the others would\nlike to give in this long line of running text.\nFlle Note: Nexus   p. 2\n\nNot for onward use\n- 3 -\n\nBoth pre-\nand post-closing periods are covered here, as far as\nwe know.".split("\n")
    noise, _, running = scan_noise.layout(lines)
    assert noise[5] == {"page", "header"} and noise[8] == {"page"} and noise[7] == {"header"} and 0 not in noise and 0 not in running


def test_misread_words():
    assert scan_noise.misread_as("would", "w0uld", 1) and scan_noise.misread_as("amount", "arnount", 1) and scan_noise.misread_as("department", "Departmcrit".lower(), 2)
    assert not scan_noise.misread_as("would", "could", 1)


def test_scans(spark):
    clean = [(f"c{k}", "The auditor would accrue the amount in the department. " * 5, "text", False) for k in range(10)]
    scan = "TITLE\n\nThe auditor w0uld accrue the arnount in the depart­\nment as it would\n\n   Page 1 of 1"
    rows = [*clean, ("s1", scan, "ocr", False), ("s1", scan, "ocr", False), ("s2", None, "ocr", False), ("s3", "", "pdf_ocr", None)]
    extracted = spark.createDataFrame(rows, "path string, text string, extractor string, is_email_thread boolean")
    documents = extracted.select(F.col("path").alias("document_id"), F.col("text").alias("content"), "extractor", "is_email_thread").where("false")
    got = {tuple(r) for r in scan_noise.noise_lines(extracted, documents).collect()}
    assert got == {("s1", 3, "misread"), ("s1", 3, "hyphen"), ("s1", 6, "page")}
    text = {r["record_id"]: r["repaired"] for r in scan_noise.repaired(extracted, documents).collect()}
    assert text == {"s1": "TITLE\n\nThe auditor would accrue the amount in the department as it would"}


def test_hyphen_evidence(spark):
    rows = [(f"c{k}", "A long-term plan and a post-entry rule for the department. It is a pre-tax figure.", "text", False) for k in range(4)]
    rows.append(("s", "TITLE\n\nThe long-\nterm plan of the depart-\nment covers pre-\nand post-closing periods here.", "ocr", False))
    extracted = spark.createDataFrame(rows, "path string, text string, extractor string, is_email_thread boolean")
    documents = extracted.select(F.col("path").alias("document_id"), F.col("text").alias("content"), "extractor", "is_email_thread").where("false")
    text = {r["record_id"]: r["repaired"] for r in scan_noise.repaired(extracted, documents).collect()}
    assert text == {"s": "TITLE\n\nThe long-term plan of the department covers pre- and post-closing periods here."}


# ---------------------------------------------------------------- 3

MAIL = """Hi Bo,
The schedule for the plant is ready for your review now.

Best regards,
Ana Lopez
Tax Manager
Acme Ltd

Nobody outside may rely on this text in any way at all.

On Mon, Aug 17, 2026 at 9:02 AM, Bo Roe <bo@x.com> wrote:
> Please send it.
"""


def test_own_lines():
    assert own_lines.own_lines(MAIL, "Lopez, Ana") == [0, 1, 8]
    assert own_lines.own_lines("> a\n\nNew words below.", "n/a") == [2]
    assert own_lines.own_lines("New.\n\nFrom: A B\nTo: C D\nSubject: x\n\nOld text.", None) == [0]


def test_newly_written(spark):
    schema = "record_id string, thread bigint, position int, headed boolean, sender string, text string"
    rows = [(f"m{k}", k, 1, False, "Ana Lopez", MAIL.replace("schedule", f"schedule number {k}")) for k in range(6)]
    said = "The quick controller reviewed seven binders before the long weekend."
    rows += [("t1", 99, 1, False, "Bo Roe", said), ("t2", 99, 2, False, "Ana Lopez", f"I agree with you on that.\n\n{said}"), ("x", None, None, False, None, None), ("y", 5, 1, False, None, "")]
    rows.append(("f", 77, 1, True, None, "Subject: s\nFrom: Ana Lopez\n---\nOne new line here."))
    got = {}
    for r in history.newly_written(spark.createDataFrame(rows + rows[:2], schema)).collect():
        got.setdefault(r["record_id"], set()).add(r["line_no"])
    assert got == {**{f"m{k}": {1, 2} for k in range(6)}, "t1": {1}, "t2": {1}, "f": {4}}


def test_inherited_against_edit_distance(spark):
    """Every near-match in a thread by brute force; other figures and short sentences are written anew."""
    rng = random.Random(3)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def edited(text):
        for _ in range(rng.randint(1, int(len(text) * 0.2))):
            k = rng.randrange(len(text) - 1)
            text = text[:k] + rng.choice(["", "x", "qz"]) + text[k + rng.randint(0, 1) :]
        return f"{text.strip(' .')}."

    said = [" ".join(rng.choice(["ledger", "über", "freight", "invoice", "of", "to", "plant", "quarter", "nexus", "binder"]) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(6, 25))) + "." for _ in range(60)]
    again = [edited(x) for x in said]
    rows = [(f"a{k}", k % 7, 1, False, None, x) for k, x in enumerate(said)] + [(f"b{k}", k % 7, 2, False, None, x) for k, x in enumerate(again)]
    rows += [("c1", 90, 1, False, None, "Hi both,\n\nThe ledger of plant 12 was closed in the third quarter."), ("c2", 90, 2, False, None, "Hi both,\n\nThe ledger of plant 13 was closed in the third quarter.")]
    rows += [("d1", None, 1, False, None, said[0]), ("d2", None, 2, False, None, said[0])]
    near = {f"b{k}" for k, x in enumerate(again) if any(edits(x, y) <= int(max(len(x), len(y)) * history.EDITS) for j, y in enumerate(said) if j % 7 == k % 7)}
    assert 10 < len(near) < 55
    got = {(r["record_id"], r["line_no"]) for r in history.newly_written(spark.createDataFrame(rows, "record_id string, thread bigint, position int, headed boolean, sender string, text string")).collect()}
    assert {f"b{k}" for k in range(60)} - {r for r, _ in got} == near
    assert {("c2", 1), ("c2", 3), ("d2", 1)} <= got


def test_boilerplate_retyped_and_short(spark):
    long = "Nobody outside of the {} may rely on this text in any way at all."
    rows = [(f"m{k}", k, 1, False, "Ana Lopez", MAIL.replace("Nobody outside may rely on this text in any way at all.", f"{long.format(word)}\n\nDo not forward.")) for k, word in enumerate(["firm", "company", "office", "group", "plant"])]
    got = {(r["record_id"], r["line_no"]) for r in history.newly_written(spark.createDataFrame(rows, "record_id string, thread bigint, position int, headed boolean, sender string, text string")).collect()}
    assert got == {(f"m{k}", n) for k in range(5) for n in (1, 2)}


def test_repeated_whatever_the_batch(spark):
    """A fingerprint has all its bits, whatever else the batch of a mail holds."""
    schema = "record_id string, thread bigint, position int, headed boolean, sender string, text string"
    said = ["The quick controller reviewed seven binders before the long weekend.", "Über dem Lager der Firma liegt seit gestern ein neues Dach."]
    rows = [(f"a{k}", k, 1, False, None, x) for k, x in enumerate(said)] + [(f"b{k}", k, 2, False, None, f"Will do.\n\n{x.upper()}") for k, x in enumerate(said)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        got = {(r["record_id"], r["line_no"]) for r in history.newly_written(spark.createDataFrame(rows, schema)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {("a0", 1), ("a1", 1), ("b0", 1), ("b1", 1)}


def test_sentences_by_definition(monkeypatch):
    """Sentences, lines, fingerprints, prints and anchors against plain loops; prints of many sentences are made at once."""
    rng = random.Random(8)
    mix, calls = history.mix, []
    monkeypatch.setattr(history, "mix", lambda x: calls.append(1) or mix(x))
    words = ["Ledger", "über", "x", "12", "plan_b", "A.B.", "done.", "why?!", "日本。", "İ", "ends. ", "...", "", "\x1c", "\u00a0"]
    texts = ["\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 8))) for _ in range(400)]
    sentences = []
    for text in texts:
        lines = text.split("\n")
        own = [k for k in range(len(lines)) if rng.random() < 0.8]
        want = []
        for k in own:
            if k - 1 not in own:
                run = [k]
                while run[-1] + 1 in own:
                    run.append(run[-1] + 1)
                at = [(j, c) for j in run for c in lines[j].strip() + " "]
                whole = "".join(c for _, c in at).rstrip()
                begin = 0
                for m in [*re.finditer(r"(?<=[.!?])\s+", whole), None]:
                    end = len(whole) if m is None else m.start()
                    if end > begin:
                        want.append((sorted({j for j, _ in at[begin:end]}), whole[begin:end]))
                    begin = len(whole) if m is None else m.end()
        assert list(history.sentences_of(lines, own)) == want
        sentences += [x for _, x in want]
    for x in sentences:
        w = words_of(x)
        assert history._said(x) == (xxhash.xxh3_64_intdigest(" ".join(w)) - (1 << 63) if len(w) >= history.MIN_WORDS else None)
    assert len(sentences) > 500 and not calls
    prints, anchors = history._prints(sentences), history._anchors(sentences)
    assert len(calls) < 50
    monkeypatch.setattr(history, "SLAB", 1)
    assert (history._prints(sentences) == prints).all() and (history._anchors(sentences) == anchors).all()
    for x, got in zip(sentences[:200], prints, strict=False):
        bits = np.zeros(256, np.uint8)
        for a, b in zip(x, x[1:], strict=False):
            bits[int(mix(np.array([ord(a) * 0x110000 + ord(b)], np.uint64))[0]) & 255] = 1
        assert (np.packbits(bits).view(np.int64) == got).all()
    assert history._prints([]).shape == (0, 4) and history._anchors([]).shape == (0, history.BANDS)


def test_names_on_a_line():
    tokens = own_lines.sender_tokens("Lopez, Ana")
    assert [x for x in ["Ana Lopez", "Ana", "A. Lopes", "von Lopez", "Ana Lopez,", "Ana lopez", "Ana Lopez 2", "Ana@x", "Ana B C D E F", "", "12", "The ledger", "Bo Roe"] if own_lines.is_name(x, tokens)] == ["Ana Lopez", "Ana", "A. Lopes", "von Lopez"]
    assert not own_lines.is_name("Ana", own_lines.sender_tokens("n/a")) and not own_lines.is_name("Ana", own_lines.sender_tokens(None))


# ---------------------------------------------------------------- 4


def test_names(spark):
    same = [
        ["Patricia Nolfoggerson", "Nolfoggerson, Patricia", "patricia nolfoggerson", "P. Nolfoggerson", "Patricia Nolfogegrson", "Trish Nolfoggerson", "patricia.nolfoggerson@x.example", "Dr. Patricia Nolfoggerson", "PNolfoggerson"],
        ["Robert Nolfoggerson", "Nolfoggerson Robert", "'Robert Nolfoggerson'"],
        ["Huntisteka Coatings Ltd", "Huntisteka Coat. Ltd", "HUNTISTEKA COATINGS LIMITED", "office@huntisteka-coatings.example", "The Huntisteka Coatings Co."],
        ["Huntisteka Logistics GmbH", "Huntisteka Logistics - Accounts Payable"],
    ]
    rows = [(n,) for group in same for n in group] + [(None,), ("",), ("n/a",), ("J.",)]
    found = spark.createDataFrame(rows * 2, "name string").where("name is not null").distinct()
    got = {tuple(r) for r in names.name_pairs(found).collect()}
    assert got == {(a, b) for group in same for a in group for b in group if a < b}
    assert names.name_pairs(found.where("false")).count() == 0


def test_one_edit_and_alignment():
    assert all(names.one_edit("margaret", x) for x in ("margaret", "margret", "margaaret", "mragaret", "nargaret"))
    assert not names.one_edit("margaret", "mragarte")
    assert names.align(["j", "smith"], ["john", "smith"]) < names.align(["j", "smyth"], ["john", "smith"]) < names.MAX_COST < names.align(["mary", "smith"], ["john", "smith"])


# ---------------------------------------------------------------- 6

TEXT = "Hi Samuel,\nwrite to ana.lopez (at) x.example or B@Y.EXAMPLE, call +1 312-555-0142 ext. 12 before noon. SSN 950 19 4440, tax id 00 521 547 168, voucher T68/757711, registration 00-7404896.\nSend it to 311 South Example Drive, Suite 5300, Tolliver, IL 00417, says A. Lopez of Lopez Logistics.\nBrenmoor, WI 00210\nP.O. Box 12"


def test_private_data(spark):
    headers = spark.createDataFrame([("Ana Lopez <ana.lopez@x.example>",), ("Samuel Lopez",), ("Lopez Logistics GmbH",)], "name string")
    records = spark.createDataFrame([("r", TEXT), ("r", TEXT), ("n", None), ("e", "")], "record_id string, text string")
    lexicon = private_data.name_lexicon(headers)
    want = {
        ("r", "EMAIL", "ana.lopez (at) x.example"), ("r", "EMAIL", "B@Y.EXAMPLE"), ("r", "PHONE", "+1 312-555-0142 ext. 12"), ("r", "IDNUM", "950 19 4440"), ("r", "IDNUM", "00 521 547 168"),
        ("r", "ADDRESS", "311 South Example Drive, Suite 5300, Tolliver, IL 00417"), ("r", "ADDRESS", "Brenmoor, WI 00210"), ("r", "ADDRESS", "P.O. Box 12"), ("r", "NAME", "Samuel"), ("r", "NAME", "A. Lopez"),
    }
    assert {tuple(r) for r in private_data.found_values(records, lexicon).collect()} == want
    assert {tuple(r) for r in private_data.found_values(records, lexicon, max_lexicon=0).collect()} == want
    text = private_data.redacted(records, lexicon).first()["redacted"]
    assert "[EMAIL]" in text and "950 19" not in text and "T68/757711" in text and "Lopez Logistics" in text


def test_names_of_other_alphabets_and_unknown_names(spark):
    headers = spark.createDataFrame([("Goran Kovačević <goran.kovačević@x.example>",), ("Łukasz Kowalski",), ("Šárka Kowalski",), ("Jan Kowalski <jan.kowalski@x.example>",)], "name string")
    text = "Goran Kovačević met Łukasz Kowalski; Šárka was there, and Dr. Qwertowska too.\nTolliver, IL 00417\nref 12.5-3 on 2026-08-17, X1234567L, AB 12 34 56 C"
    records = spark.createDataFrame([("r", text), ("r", "Jan only")], "record_id string, text string")
    want = {("NAME", x) for x in ("Goran Kovačević", "Łukasz Kowalski", "Šárka", "Qwertowska", "Jan")} | {("ADDRESS", "Tolliver, IL 00417"), ("IDNUM", "X1234567L"), ("IDNUM", "AB 12 34 56 C")}
    lexicon = private_data.name_lexicon(headers)
    for most in (0, private_data.MAX_LEXICON):
        assert {(r["kind"], r["found_text"]) for r in private_data.found_values(records, lexicon, max_lexicon=most).collect()} == want


# ---------------------------------------------------------------- 7


def test_pack_keeps_everything_and_fills():
    rng = random.Random(1)
    items = [(rng.randint(1, 511), k) for k in range(3000)]
    sources = [rng.choice("aaab") for _ in items]
    windows = packing.pack(items, sources, {"a": 0.75, "b": 0.25}, {}, 512)
    assert sorted(k for w in windows for k in w) == list(range(3000))
    assert all(sum(items[k][0] for k in w) <= 512 for w in windows)
    assert sum(n for n, _ in items) / (512 * len(windows)) > 0.95


def test_packed(spark):
    texts = [(k, sentence(RNG.randint(0, 900)), RNG.choice(["a", None])) for k in range(60)] + [(100, None, "a"), (101, "", None), (102, sentence(9000), "b")]
    documents = spark.createDataFrame(texts + texts[:5], "doc_id bigint, text string, source string")
    windows = spark.createDataFrame([("small", 512), ("large", 8192)], "window_name string, capacity_tokens int")
    got = packing.packed(documents, windows).toPandas()
    sizes = {r["doc_id"]: r["n_tokens"] for r in packing.sized(documents).collect()}
    for name, capacity in (("small", 512), ("large", 8192)):
        part = got[got.window_name == name]
        assert set(part.doc_id) == set(sizes) and part.groupby("container_id").n_tokens.sum().max() <= capacity
        assert part.groupby("doc_id").n_tokens.sum().to_dict() == sizes
        pieces = part.groupby("doc_id").size()
        assert all(pieces[k] == max(1, -(-n // capacity)) for k, n in sizes.items())
    report = {r["window_name"]: r["fill"] for r in packing.fill_report(packing.packed(documents, windows), windows).collect()}
    assert report["small"] > 0.85


def test_opening_deficits_over_blocks(spark):
    rng = random.Random(3)
    rows = [(w, n, s, rng.random() * 1000, rng.randint(0, 1000)) for w in ("x", "y") for n in range(97) for s in ("a", "b", "") if rng.random() < 0.8]
    sums = spark.createDataFrame(rows, "window_name string, number long, source string, target double, tokens long")
    want = {(w, n, s): sum(t - k for v, m, r, t, k in rows if v == w and r == s and m < n) for w, n, s, _, _ in rows}
    for block in (1, 10, 1_000):
        got = {(r["window_name"], r["number"], r["source"]): r["opening"] for r in packing.opening_deficits(sums, block).collect()}
        assert got == pytest.approx(want, abs=1e-3)


# ---------------------------------------------------------------- 8


def test_window_prints():
    words = sentence(40).split()
    prints = window_prints(hash_words(words), 13)
    assert len(prints) == 28 and prints[5] == window_prints(hash_words(words[5:18]), 13)[0]
    assert len(window_prints(hash_words(words[:12]), 13)) == 0


@pytest.mark.parametrize("most", [leaks.MAX_BROADCAST_WINDOWS, 0])
def test_leaks_against_search(spark, most):
    items = [(f"T{k}", sentence(60)) for k in range(8)] + [("T8", None), (None, sentence(40)), ("T9", sentence(5))]
    docs = [(k, f"{sentence(50)} {' '.join(items[k % 8][1].split()[10 : 10 + 9 + k % 9])} {sentence(30)}") for k in range(40)] + [(90, None), (91, ""), (92, items[0][1].upper())]
    documents, cases = spark.createDataFrame(docs + docs[:3], "key bigint, text string"), spark.createDataFrame(items, "key string, text string")

    def windows(text):
        w = words_of(text)
        return {tuple(w[i : i + 13]) for i in range(len(w) - 12)}

    want = {(str(d), t) for d, x in docs for t, y in items if t and windows(x) & windows(y)}
    found = leaks.leaked_windows(documents, cases, max_broadcast=most).where("words = item_words")
    assert {tuple(r) for r in found.select("key", "item").distinct().collect()} == want


def test_near_leaks_with_planted_edits(spark):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("led", "fac", "nex", "rec", "pay", "bin", "aud", "cus") for b in ("ger", "tor", "us", "eipt", "roll", "der", "it", "toms", "ing", "ed")]
    items = [(f"T{k}", " ".join(rng.choices(words, k=rng.choice([20, 60])))) for k in range(60)] + [("T60", None), (None, "x " * 40), ("T61", "too short")]
    docs, want = [], set()
    for k, (item, text) in enumerate(items[:60]):
        part = text.split()
        for at in rng.sample(range(len(part)), len(part) // 10):
            part[at] = rng.choice(words)
        docs.append((k, " ".join([*rng.choices(words, k=30), *part, *rng.choices(words, k=30)])))
        want.add((str(k), item))
    docs += [(100, None), (101, ""), (102, " ".join(rng.choices(words, k=3000)))]
    got = {(r["key"], r["item"]) for r in leaks.near_leaks(spark.createDataFrame(docs + docs[:3], "key bigint, text string"), spark.createDataFrame(items, "key string, text string")).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got - want) <= 2
    nothing = spark.createDataFrame([("a", "few words")], "key string, text string")
    assert leaks.near_leaks(nothing, nothing).count() == 0 and leaks.leaked_windows(nothing, nothing).count() == 0


# ---------------------------------------------------------------- 9


def test_subjects_held_out(spark):
    areas = {s: [f"{s}term{k} matter" for k in range(12)] for s in ("alpha", "beta", "gamma", "delta", "epsilon")}
    office = ["the binder was moved to another room today", "coffee is served from nine in the hall", "comments on the draft are due soon enough"]

    def text(parts):
        return ". ".join(f"we looked at {RNG.choice(areas[s])} in the file" if s else RNG.choice(office) for s in parts) + "."

    docs, truth, labels = [], set(), []
    for k in range(300):
        chosen = RNG.sample(sorted(areas), RNG.choice([0, 1, 1, 2]))
        parts = [s for s in chosen for _ in range(5)] + [None] * 5
        RNG.shuffle(parts)
        docs.append((k, text(parts)))
        truth |= {(k, s) for s in chosen}
        if k < 90:
            labels += [(k, s, "r1") for s in chosen or ["none"]]
    docs += [(900, None), (901, "")]
    frame = spark.createDataFrame(docs + docs[:4], "doc_id bigint, text string")
    rated = spark.createDataFrame(labels + labels[:3] + [(5000, "alpha", "r1"), (None, "beta", "r2")], "doc_id bigint, subject string, labelled_by string")
    got = {(r["doc_id"], r["subject"]) for r in subjects.document_subjects(frame, rated).collect()}
    held = lambda pairs: {p for p in pairs if p[0] >= 90}
    assert len(held(got) & held(truth)) >= 0.95 * len(held(truth)) and len(held(got) - held(truth)) <= 0.05 * len(held(truth))
    assert subjects.document_subjects(frame, rated.where("false")).count() == 0


def test_every_occurrence_is_an_edge():
    known = np.sort(hash_words(["nexus", "payroll", "receipts"]).view(np.int64))
    text = "the nexus payroll and the receipts nexus. no such words are here. all of the payroll payroll is due"
    got = next(subjects._occurrences(known)(iter([pd.DataFrame({"doc_id": [1, 2], "text": [text, None]})])))
    place = {w: int(np.searchsorted(known, hash_words([w]).view(np.int64)[0])) for w in ("nexus", "payroll", "receipts")}
    assert set(zip(got["at"][0], got["terms"][0], strict=True)) == {(0, place["nexus"]), (0, place["payroll"]), (0, place["receipts"]), (2, place["payroll"])}
    assert len(got["terms"][0]) == 4 and got["sentences"].tolist() == [3, 0] and not len(got["terms"][1])


def test_all_ratings_are_seeds(spark, monkeypatch):
    monkeypatch.setattr(subjects, "MAX_LABELLED", 20)
    labels = spark.createDataFrame([(k, "none" if k % 2 else "alpha", "r1") for k in range(100)], "doc_id bigint, subject string, labelled_by string")
    assert {r["doc_id"] for r in subjects.seeds(labels).collect()} == set(range(0, 100, 2))
    few = [r["doc_id"] for r in subjects.sampled(labels.select("doc_id")).collect()]
    assert len(few) == 20 and 4 <= sum(k % 2 for k in few) <= 16


def test_terms_are_learnt_from_all_documents(spark):
    ids = [r[0] for r in spark.range(4320).orderBy(F.xxhash64("id"), "id").collect()]
    office = ["the binder was moved to another room today", "coffee is served from nine in the hall", "comments on the draft are due soon enough"]
    labels = [(k, s, "r1") for n, s in enumerate(["alpha"] * 15 + ["beta"] * 15) for k in [ids[n]]]
    docs = [(k, f"we looked at {s}duty in the file. {office[0]}. the {s}duty was raised again") for k, s, _ in labels]
    docs += [(k, ". ".join(office)) for k in ids[30:4300]]
    # the last ones by their hash: documents that the rated word reaches teach another, which the last of all have alone
    docs += [(k, f"we looked at alphaduty in the file. {office[1]}. a zetacharge was due then") for k in ids[4300:4310]]
    docs += [(k, f"{office[2]}. no zetacharge was due then") for k in ids[4310:]]
    got = {(r["doc_id"], r["subject"]) for r in subjects.document_subjects(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, subject string, labelled_by string")).collect()}
    assert got == {(k, s) for k, s, _ in labels} | {(k, "alpha") for k in ids[4300:]}


def test_terms_are_counted_as_written_out(monkeypatch):
    words = ["nexus", "tax", "Größe", "a_b", "x1"]
    ends = [" ", " ", ". ", "? ", "\n", "!\x1d", "-", ".", ".) ", "\x01"]
    rng = random.Random(11)
    texts = ["".join(rng.choice(words) + rng.choice(ends) for _ in range(60)) for _ in range(9)]
    texts = texts[:4] + [x.replace("Größe", "Size") for x in texts[4:]] + [None, ""]
    labels = np.array([[rng.random() < 0.5 for _ in range(2)] for _ in texts])
    want = {}
    for row, text in enumerate(texts):
        sentences = [x for x in (words_of(x) for x in re.split(r"(?<=[.!?])\s+|\n+", text or "")) if len(x) >= subjects.MIN_WORDS]
        seen = [{(w,) for w in x} | set(itertools.pairwise(x)) for x in sentences]
        for term in set().union(*seen) | {()}:
            for k in [-1, *np.flatnonzero(labels[row])]:
                docs, n = want.get((term, k), (0, 0))
                want[term, k] = (docs + 1, n + (sum(term in x for x in seen) if term else 1))

    def key(term):
        h = hash_words(list(term))
        return 0 if not term else int((h if len(term) == 1 else subjects.mix(h[:1] * np.uint64(3) + h[1:])).view(np.int64)[0])

    parts = [subjects._counted(subjects._found(pd.DataFrame({"text": texts[a:b]})), labels[a:b]) for a, b in ((0, 5), (5, 11))]
    got = {(r.term, r.subject): (r.docs, r.n) for r in pd.concat(subjects._added(iter(parts))).itertuples()}
    assert {k: v for k, v in got.items() if v != (0, 0)} == {(key(t), k): v for (t, k), v in want.items()}
    monkeypatch.setattr(subjects, "HELD", 10)  # what a task can't hold is sent in parts with the same sums
    few = pd.concat(subjects._added(iter(parts))).groupby(["term", "subject"])[["docs", "n"]].sum()
    assert {k: tuple(v) for k, v in few.iterrows()} == got


def test_subjects_hash_each_different_word_once(monkeypatch):
    rng, asked = random.Random(3), []
    alphabet = ["a", "B", "é", "ß", "İ", "Σ", "中", "𝔘", "😀", "\u3000", "–", "_", "-", ".", "!", " ", " ", " ", "\n", "\x1d", "٣", "x" * 9, "y" * 17, "z" * 300]
    texts = ["".join(rng.choice(alphabet) for _ in range(200)) for _ in range(60)] + [None, ""] + ["the same words again and again"] * 300
    want = [[x for x in (words_of(x) for x in re.split(r"(?<=[.!?])\s+|\n+", (text or "").lower())) if len(x) >= subjects.MIN_WORDS] for text in texts]
    monkeypatch.setattr(subjects, "hash_words", lambda words: asked.extend(words) or hash_words(words))
    kept = pd.concat(subjects._read(iter([pd.DataFrame({"doc_id": range(len(texts)), "text": texts})])))
    assert [np.frombuffer(x, np.uint64).tolist() for x in kept["words"]] == [[int(h) for s in x for h in hash_words(s)] for x in want]
    assert [np.frombuffer(x, np.int32).tolist() for x in kept["sizes"]] == [[len(s) for s in x] for x in want]
    assert sorted(asked) == sorted({w for x in want for s in x for w in s})


def test_slabs_are_cut_by_size(monkeypatch):
    monkeypatch.setattr(subjects, "SLAB", 10_000)
    sizes = [0, 5_000, 60_000, 60_000, 0] + [3_000] * 40 + [0] * 30
    slabs = list(subjects._slabs(iter([pd.DataFrame({"doc_id": range(len(sizes)), "text": ["x" * n or None for n in sizes]})])))
    assert [k for x in slabs for k in x["doc_id"]] == list(range(len(sizes))) and len(slabs) > 15
    assert all(sum(len(t or "") for t in x["text"][:-1]) + subjects.LEAST * (len(x) - 1) <= 10_000 for x in slabs)


# ---------------------------------------------------------------- queries


def test_found_columns(spark, sf):
    from ledgerloom.llm.queries import QUERIES

    columns = {"p1_found": "id_a id_b", "p2_found": "record_id line_no noise", "p3_found": "record_id line_no", "p4_found": "name_a name_b", "p6_found": "record_id kind found_text", "p8_found": "doc_id test_id", "p9_found": "doc_id subject"}
    for name, want in columns.items():
        frame = QUERIES[name](spark, sf)
        assert frame.columns == want.split()
        rows = Counter(map(tuple, frame.collect()))
        assert not rows or max(rows.values()) == 1
    assert isinstance(pd.DataFrame(), pd.DataFrame)
