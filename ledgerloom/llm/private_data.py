"""Mail addresses, phones, identity numbers, street addresses and names of people in free text.

One Aho-Corasick automaton runs over each text and finds *anchors*: at-signs in their spellings,
schemes, street, box and town cues, honorifics, and the cues of numbers (two digits around one
separator, a digit beside a letter that identity numbers have there).  From each anchor a
deterministic local parser expands to the left and right, to the boundaries of the value, and
validates it; no other pattern runs over a text.  Names are anchored by honorifics and by the words
that mail headers prove to be given or family names, by way of addresses of the form
``given.family@`` and of display names that share a token with them; capital letters are those of
any alphabet.

The lexicon of names is broadcast while it has at most ``MAX_LEXICON`` tokens; beyond that the
capitalised words of each record, found by the same function, are joined with it: the same rows.

Defined results: NULL and empty texts give no row; equal values of a record are one row of
:func:`found_values`; overlapping values keep the first kind of ``KINDS``; repeated rows are
harmless.  Placeholders are ``[EMAIL]``, ``[PHONE]`` and so on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .names import LEGAL, fold, parse_form

KINDS = ["EMAIL", "ADDRESS", "PHONE", "IDNUM", "NAME"]
_RANK = {k: n for n, k in enumerate(KINDS)}
MAX_LEXICON = 300_000

# --- fixed values ---
AT_SIGNS = ["@", "(at)", "[at]", " at "]
SCHEMES = ["tel:", "callto:", "sms:", "fax:"]
HONORIFICS = ["Mr. ", "Mr ", "Mrs. ", "Mrs ", "Ms. ", "Ms ", "Miss ", "Dr. ", "Dr ", "Prof. ", "Prof ", "Herr ", "Herrn ", "Frau ", "Sr. ", "Sra. ", "Don ", "Doña ", "Señor ", "Señora "]
STREETS = "Street St Avenue Ave Road Rd Boulevard Blvd Lane Ln Drive Dr Court Ct Parkway Pkwy Way Place Pl Square Sq Terrace Highway Hwy".split()
STREET_ENDINGS = "weg straße strasse platz gasse allee ufer damm".split()
STREET_BEGINNINGS = "Calle Avenida Plaza Paseo Carrera Camino".split()
BOXES = ["P.O. Box", "P. O. Box", "PO Box", "Postfach", "Apartado"]
ROOMS = r"Suite|Ste\.?|Apt\.?|Apartment|Floor|Fl\.?|Unit|Room|Rm\.?|#"
TRADES = "logistics castings bearings holdings rail parts coatings machining engineering advisory audit consulting services freight group gmbh ltd llc inc limited incorporated".split()
# --- end of fixed values ---

#: The capital letters of all alphabets, as a class of a pattern.
_UP = "[" + "".join(c for c in map(chr, range(0x41, 0x2000)) if c.isupper()) + "]"
_TOWN = rf"{_UP}[\w.'-]*(?: {_UP}[\w.'-]*){{0,3}}, [A-Z]{{2}} \d{{5}}(?:-\d{{4}})?\b"
_REST = rf"(?:,? (?:{ROOMS}) ?\d+[A-Z]?\b)?(?:, \d+\.º)?(?:, {_TOWN})?"
_AVE = r"(?:Ave\.|(?:" + "|".join(STREETS) + r")\b)"
_STREET = re.compile(rf"(?<![\w.,-])\d{{1,5}} (?:{_UP}[\w'-]* ){{1,4}}?{_AVE}{_REST}")
_BEFORE_STREET = re.compile(rf"(?<![\w.,-])\d{{1,5}}(?: {_UP}[\w'-]*){{1,4}}$")
_ENDING = re.compile(rf"(?<!\w){_UP}[\w-]*(?:{'|'.join(STREET_ENDINGS)}) \d{{1,4}}[a-z]?\b{_REST}")
_BEGINNING = re.compile(rf"(?<!\w)(?:{'|'.join(STREET_BEGINNINGS)})(?: (?:de|del|la|los|las))* {_UP}[\w'-]*(?: {_UP}[\w'-]*)*,? \d{{1,4}}\b{_REST}")
_BOX = re.compile(rf"(?:{'|'.join(map(re.escape, BOXES))}) \d+\b{_REST}")
_TOWN_LINE = re.compile(rf"[> |\t]*({_TOWN})[ \t]*")
_LOCAL = re.compile(r"[\w.+'-]+$")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\s?[\[(](?:dot|punkt)[\])]\s?| dot )[A-Za-z0-9-]+)+", re.I)
_NUMBER = re.compile(
    r"(?<![\w+/-])(?<!\d[.,])(?:"
    r"(?P<phone>(?:\+\d{1,3}[ .-])?(?:\(\d{2,5}\) ?|\d{2,5}[ .-])\d{3,5}[ .-]\d{3,4}(?![ .-]?\d)(?: ?(?:x|ext\.?|Ext\.?|extension) ?\d{1,5})?)"
    r"|(?P<id>\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|\d{2} \d{3} \d{3} \d{3}|[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?\d\d ?\d\d ?\d\d ?[A-D]|QQ ?\d\d ?\d\d ?\d\d ?[A-D]|[XYZ]-?\d{7}(?:-?[A-Z])?)"
    r")(?![\w/-])(?![.,]\d)"
)
#: What numbers are written with, the letters before them, and the room that an extension takes.
_IN_NUMBER, _BEFORE_NUMBER, _EXTENSION = frozenset("0123456789 .-()+"), 4, 20
_CAPITAL = re.compile(rf"\b((?:{_UP}\. )*)({_UP}\w+)")
_TITLED = re.compile(rf"((?:{_UP}\. )*{_UP}[^\W\d_]+)(?: ({_UP}[^\W\d_]+))?")
_NEXT_WORD = re.compile(r" (\w+)")


def _automaton() -> ahocorasick.Automaton:
    digits, capitals = "0123456789", [chr(c) for c in range(65, 91)]
    numbers = [f"{a}{gap}{b}" for a in digits for gap in " .-" for b in digits]
    numbers += [f"{d}{gap}{x}" for d in digits for gap in ("", " ") for x in "ABCD"] + [f"{x}{d}" for x in "XYZ" for d in f"{digits}-"]
    towns = [f", {a}{b} " for a in capitals for b in capitals]
    cues = {"at": AT_SIGNS, "street": [f" {s}" for s in STREETS], "ending": STREET_ENDINGS, "beginning": [f"{b} " for b in STREET_BEGINNINGS], "box": BOXES, "town": towns, "number": numbers, "scheme": SCHEMES, "honorific": HONORIFICS}
    found = ahocorasick.Automaton()
    for kind, words in cues.items():
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


_ANCHORS = _automaton()
Span = tuple[int, int, str]


def _mail(text: str, start: int, end: int) -> Span | None:
    """The mail address around an at-sign."""
    before = text[max(0, start - 80) : start].rstrip(" ") if text[start] != "@" else text[max(0, start - 80) : start]
    gap = start - len(text[:start].rstrip(" ")) if text[start] != "@" else 0
    local = _LOCAL.search(before)
    after = end + (text[end : end + 1] == " " and text[start] != "@")
    domain = _DOMAIN.match(text, after)
    if not local or not domain or (text[start:end] == " at " and " dot " not in domain.group().lower()):
        return None
    word = local.group().lstrip("'.-")
    return (start - gap - len(word), domain.end(), "EMAIL") if word else None


def _address(text: str, kind: str, start: int, end: int) -> Span | None:
    """The street, box or town line around its cue."""
    if kind == "street":
        left = None if text[end : end + 1].isalnum() else _BEFORE_STREET.search(text, max(0, start - 90), start)
        found = left and _STREET.match(text, left.start())
    elif kind == "ending":
        while start > 0 and (text[start - 1].isalnum() or text[start - 1] in "_-"):
            start -= 1
        found = _ENDING.match(text, start)
    elif kind == "town":
        line_end = text.find("\n", end)
        found = _TOWN_LINE.fullmatch(text, text.rfind("\n", 0, start) + 1, len(text) if line_end < 0 else line_end)
        return found and (*found.span(1), "ADDRESS")
    else:
        found = (_BEGINNING if kind == "beginning" else _BOX).match(text, start)
    return found and (*found.span(), "ADDRESS")


def _numbers(text: str, start: int, end: int) -> tuple[list[Span], int]:
    """The phones and identity numbers in the run of digits and separators around a cue, and where the run ends."""
    while start > 0 and text[start - 1] in _IN_NUMBER:
        start -= 1
    while end < len(text) and text[end] in _IN_NUMBER:
        end += 1
    out = []
    for m in _NUMBER.finditer(text, max(0, start - _BEFORE_NUMBER), min(len(text), end + _EXTENSION)):
        if m.lastgroup == "id" or 9 <= sum(c.isdigit() for c in re.split("[xe]", m.group())[0]) <= 14:
            out.append((*m.span(), "PHONE" if m.lastgroup == "phone" else "IDNUM"))
    return out, end


class _Names:
    """Chains of name words, by the lexicon."""

    def __init__(self, lexicon: dict[str, str]) -> None:
        self.lexicon, self.kinds = lexicon, {}

    def kind(self, word: str) -> str:
        if (k := self.kinds.get(word)) is None:
            if len(self.kinds) > 200_000:
                self.kinds.clear()
            k = self.kinds[word] = self.lexicon.get(fold(word), "")
        return k

    def __call__(self, text: str) -> Iterator[Span]:
        """Given name, given and family name, family name, or initials and family name."""
        kinds, open_, until = self.kinds, None, -1
        for m in _CAPITAL.finditer(text):
            word = m[2]
            kind = kinds.get(word)
            if kind is None:
                kind = self.kind(word)
            if not kind:
                continue
            start, end = m.span(2)
            if open_ is not None:
                gap = text[until : m.start()]
                if kind == "family" and (gap == " " or (gap[:1] == "\n" and not m[1] and gap[1:].strip("> |") == "")):
                    yield from self._unless_firm(text, open_, end)
                    open_ = None
                    continue
                yield from self._unless_firm(text, open_, until)
                open_ = None
            if kind == "given":
                open_, until = start, end
            else:
                yield from self._unless_firm(text, m.start(), end)
        if open_ is not None:
            yield from self._unless_firm(text, open_, until)

    def titled(self, text: str, at: int) -> Span | None:
        """The name behind an honorific, where the lexicon does not know it."""
        found = _TITLED.match(text, at)
        if not found or self.kind(found[1].rsplit(" ", 1)[-1]):
            return None
        more = found[2] and found[2].lower() not in TRADES
        return at, (found.end() if more else found.end(1)), "NAME"

    @staticmethod
    def _unless_firm(text: str, start: int, end: int) -> Iterator[Span]:
        after = _NEXT_WORD.match(text, end)
        if not after or after[1].lower() not in TRADES:
            yield start, end, "NAME"


def spans_of(text: str, names: _Names) -> list[Span]:
    """The values of a text, in order, without overlaps."""
    found: list[Span] = []
    counted = 0  # where the last run of digits ends
    for last, (kind, size) in _ANCHORS.iter(text):
        start, end = last + 1 - size, last + 1
        if kind == "number" or kind == "scheme":
            if end > counted or kind == "scheme":
                numbers, counted = _numbers(text, end if kind == "scheme" else start, end)
                found += numbers
        elif kind == "at":
            found.append(_mail(text, start, end))
        elif kind == "honorific":
            found.append(names.titled(text, end))
        else:
            found.append(_address(text, kind, start, end))
    found = list({s for s in found if s})
    found.extend(names(text))
    found.sort(key=lambda s: (_RANK[s[2]], s[0], -s[1]))
    kept: list[Span] = []
    taken = bytearray(len(text))
    for start, end, kind in found:
        if taken.find(1, start, end) < 0:
            kept.append((start, end, kind))
            taken[start:end] = b"\1" * (end - start)
    return sorted(kept)


def _scan(lexicon: Broadcast | None, redact: bool) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = None if lexicon is None else _Names(lexicon.value)
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                names = shared or _Names(dict(zip(r.known_tokens, r.known_roles, strict=True)) if r.known_tokens is not None else {})
                spans = spans_of(r.text, names)
                if redact:
                    parts, at = [], 0
                    for start, end, kind in spans:
                        parts += [r.text[at:start], f"[{kind}]"]
                        at = end
                    rows.append((r.record_id, "".join(parts) + r.text[at:], len(spans)))
                else:
                    rows.extend((r.record_id, *v) for v in dict.fromkeys((kind, r.text[start:end]) for start, end, kind in spans))
            yield pd.DataFrame(rows, columns=["record_id", "redacted", "replaced"] if redact else ["record_id", "kind", "found_text"])

    return run


def _header_roles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    legal = set(LEGAL.split()) | set(TRADES)
    for batch in batches:
        rows = []
        for name in batch["name"]:
            tokens, _ = parse_form(name)
            mail = re.search(r"([^\W\d_]+)\.([^\W\d_]+)@", name)
            if mail:
                rows += [(fold(mail.group(1)), "given", None), (fold(mail.group(2)), "family", None)]
            if len(tokens) == 2 and not legal & {w.lower() for w in re.findall(r"\w+", name)}:
                rows += [(tokens[0], "either", tokens[1]), (tokens[1], "either", tokens[0])]
        yield pd.DataFrame(rows, columns=["token", "role", "other"])


def name_lexicon(names: DataFrame) -> DataFrame:
    """``names(name)``, strings of mail headers, to ``(token, role)``: the folded given and family names they prove."""
    said = names.mapInPandas(_header_roles, "token string, role string, other string")
    proven = said.where("role <> 'either'").groupBy("token", "role").agg(F.count("*").alias("n"))
    proven = proven.groupBy("token").agg(F.max_by("role", F.struct("n", "role")).alias("role"))
    beside = said.where("role = 'either'").select("token", "other").distinct().join(proven.select(F.col("token").alias("other"), F.col("role").alias("other_role")), "other")
    # the partner of a given name is a family name, and the other way round
    guessed = beside.groupBy("token").agg(F.max("other_role").alias("r")).select("token", F.when(F.col("r") == "given", "family").otherwise("given").alias("role"))
    return proven.unionByName(guessed.join(proven, "token", "left_anti")).where(F.length("token") >= 3)


def _capitalised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        tokens = [sorted({fold(m[2]) for m in _CAPITAL.finditer(t)} | {fold(m[1].rsplit(" ", 1)[-1]) for m in _TITLED.finditer(t)}) for t in batch["text"]]
        yield pd.DataFrame({"record_id": batch["record_id"].repeat([len(x) for x in tokens]), "token": [w for x in tokens for w in x]})


def _prepared(records: DataFrame, lexicon: DataFrame, max_lexicon: int) -> tuple[DataFrame, Broadcast | None]:
    texts = records.select(F.col("record_id").cast("string").alias("record_id"), "text").where("record_id is not null and text is not null and text <> ''").distinct()
    first = lexicon.limit(max_lexicon + 1).collect()
    if len(first) <= max_lexicon:
        return texts, records.sparkSession.sparkContext.broadcast({r["token"]: r["role"] for r in first})
    # keyed by record and text: one id may have two texts
    texts = texts.withColumn("text_hash", F.xxhash64("record_id", "text"))
    words = texts.select(F.col("text_hash").cast("string").alias("record_id"), "text").mapInPandas(_capitalised, "record_id string, token string").select(F.col("record_id").cast("bigint").alias("text_hash"), "token")
    known = words.join(lexicon, "token").groupBy("text_hash").agg(F.collect_list("token").alias("known_tokens"), F.collect_list("role").alias("known_roles"))
    return texts.join(known, "text_hash", "left").drop("text_hash"), None


def found_values(records: DataFrame, lexicon: DataFrame, max_lexicon: int = MAX_LEXICON) -> DataFrame:
    """``records(record_id, text)`` to distinct ``(record_id, kind, found_text)``."""
    texts, known = _prepared(records, lexicon, max_lexicon)
    return texts.mapInPandas(_scan(known, False), "record_id string, kind string, found_text string").distinct()


def redacted(records: DataFrame, lexicon: DataFrame, max_lexicon: int = MAX_LEXICON) -> DataFrame:
    """``records(record_id, text)`` to ``(record_id, redacted, replaced)``: placeholders in the place of values, and their number."""
    texts, known = _prepared(records, lexicon, max_lexicon)
    return texts.mapInPandas(_scan(known, True), "record_id string, redacted string, replaced int")
