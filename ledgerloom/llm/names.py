"""Variant spellings of the people and organisations in mail headers.

1. Each distinct string is parsed to a *form*: its folded full tokens and its initials.  Where an
   address names the person its spelling wins over the display name; honorifics, legal suffixes,
   departments and remarks in brackets are left out, nicknames become the given name.
2. Forms with the same tokens are one *key*, supported by as many strings as spell it.
3. A symmetric-delete index over tokens finds keys with a token one edit away: two tokens within
   one edit (insertion, deletion, substitution, transposition) always share the token itself or
   a string left after one deletion.  Each index entry holds a neighbouring token as well, whole
   or as its first letter, so that a common given name alone gathers nothing.
4. Candidates are aligned token by token by the cheapest assignment, which permits typos,
   initials and abbreviations.  A key joins the better supported key it aligns with most cheaply,
   if that is one key only; ambiguous initials stay alone.

Defined results: NULL, empty and ``n/a`` strings give no pair; repeated strings count once; a
string that names nobody (only initials, only a legal suffix) is linked to nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

# --- fixed values ---
HONORIFICS = "dr mr mrs ms miss prof herr frau sr sra don dona ing dipl"
LEGAL = "ltd limited llc llp inc incorporated gmbh gesellschaft mbh co corp corporation plc ag kg sa sl company the"
ROLES = "accounts accounting tax office info mail contact admin billing finance payables invoices service support"
DEPARTMENTS = ["accounts payable", "accounts receivable"]
NICKNAMES = {
    "alexandra": "sasha alex lexi sandra", "anthony": "tony", "benjamin": "ben benny", "christopher": "chris kit", "daniel": "dan danny", "deborah": "deb debbie",
    "edward": "ed ted eddie ned", "elizabeth": "liz beth eliza betty lisa", "francisca": "paca paquita fran", "gerhard": "gerd", "jennifer": "jen jenny", "joaquin": "quino ximo",
    "katherine": "kate kathy katie kat", "lawrence": "larry laurie", "margaret": "maggie peggy meg", "michael": "mike mick", "nicholas": "nick nico", "patricia": "trish pat patty",
    "priyanka": "priya", "rebecca": "becky becca", "robert": "rob bob bobby", "samuel": "sam sammy", "susanna": "sue susi", "thomas": "tom tommy", "victoria": "vicky tori",
    "wolfgang": "wolf", "yolanda": "yoli", "oluwaseun": "seun", "hiroshi": "hiro", "ingrid": "inga", "william": "will bill", "richard": "rick dick", "james": "jim", "john": "jack",
}
# --- end of fixed values ---
_FORMAL = {nick: formal for formal, nicks in NICKNAMES.items() for nick in nicks.split()}
_DROP = set(f"{HONORIFICS} {LEGAL}".split())
_ROLES = set(ROLES.split())

#: Costs of aligning two tokens, and of leaving one out.
TYPO, SHORT, MISSING, SPARE_INITIAL = 0.5, 0.6, 0.7, 0.05
MAX_COST = 1.35
#: Tokens from this length on may hold a typo.
TYPO_LENGTH = 4
#: A key that as many strings spell is taken for a name of its own, not for a typo of another, unless the other has SUPPORT_RATIO times as many.
OWN_SUPPORT, SUPPORT_RATIO = 3, 3.0

FORM = "name string, tokens array<string>, initials array<string>"


def fold(token: str) -> str:
    """Lower case without accents; a spelt-out umlaut at the end becomes a plain vowel."""
    plain = unicodedata.normalize("NFKD", token.lower().replace("ß", "ss"))
    plain = "".join(c for c in plain if not unicodedata.combining(c))
    return re.sub("([aou])e$", r"\1", plain)


def _split(text: str) -> tuple[list[str], list[str]]:
    full, initials = [], []
    text = re.sub(r"\b([A-Z])([A-Z][a-z]{2,})\b", r"\1 \2", text)
    for token in re.findall(r"[^\W\d_]+", text):
        low = token.lower()
        if low in _DROP:
            continue
        if len(token) == 1:
            initials.append(fold(token))
        else:
            full.append(fold(_FORMAL.get(low, low)))
    return full, initials


def parse_form(name: str) -> tuple[list[str], list[str]]:
    """The folded full tokens, in order, and the initials of a typed name."""
    text = unicodedata.normalize("NFC", name).strip()
    mail = re.search(r"<?\s*([^\s<>@;,\"']+)@([^\s<>;,\"']+?)\.[a-z]+\s*>?$", text, re.I)
    shown = text[: mail.start()] if mail else text
    shown = re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", shown).strip(" '\"-")
    for words in DEPARTMENTS:
        shown = re.sub(rf"(?i)[-,:]?\s*\b{words}\b", " ", shown)
    if mail:
        local, domain = mail.group(1), mail.group(2).split(".")[-1]
        parts = [p for p in re.split(r"[._-]+", local) if p]
        if len(parts) >= 2 and all(p.isalpha() for p in parts):
            return _split(" ".join(parts).lower())
        if parts and parts[0].lower() in _ROLES:
            of_domain = _split(" ".join(re.split(r"[_-]+", domain)))
            of_shown = _split(shown)
            return of_shown if len(of_shown[0]) > len(of_domain[0]) else of_domain
        if not shown.strip():
            return ([fold(local[1:])], [fold(local[0])]) if len(local) > 3 and local.isalpha() else ([], [])
    return _split(shown)


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for name in batch["name"]:
            full, initials = parse_form(name)
            if full and len(full) + len(initials) >= 2:
                rows.append((name, sorted(set(full)), initials[:1] if len(full) == 1 else []))
        yield pd.DataFrame(rows, columns=["name", "tokens", "initials"])


def one_edit(a: str, b: str) -> bool:
    """Within one insertion, deletion, substitution or transposition of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[at + 1 :] == b[at + 1 :] or a[at + 1 :] == b[at:] or a[at:] == b[at + 1 :] or (a[at + 2 :] == b[at + 2 :] and a[at : at + 2] == b[at : at + 2][::-1])


def _shortens(short: str, full: str) -> bool:
    """An initial, a cut-off word or a word without some of its inner letters."""
    if not short or short[0] != full[0] or len(short) >= len(full) - 1:
        return False
    letters = iter(full)
    return len(short) == 1 or full.startswith(short) or (len(short) <= 5 and all(c in letters for c in short))


@lru_cache(50_000)
def token_cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    if _shortens(a, b) or _shortens(b, a):
        return SHORT
    if min(len(a), len(b)) >= TYPO_LENGTH and one_edit(a, b):
        return TYPO
    return 9.0


def align(a: list[str], b: list[str]) -> float:
    """The cost of the cheapest assignment of the tokens of ``a`` to those of ``b``, each used once."""
    best = {0: 0.0}
    for x in a:
        step: dict[int, float] = {}
        for used, cost in best.items():
            for k, y in enumerate(b):
                if not used >> k & 1 and (c := cost + token_cost(x, y)) < step.get(used | 1 << k, 9.0):
                    step[used | 1 << k] = c
            spare = cost + (SPARE_INITIAL if len(x) == 1 else MISSING)
            if spare < step.get(used, 9.0):
                step[used] = spare
        best = step
    return min((cost + sum(MISSING for k in range(len(b)) if not used >> k & 1) for used, cost in best.items()), default=9.0)


def _index(own: bool):
    """Index entries of keys: ``own`` are the keys to be joined, the rest those that join."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, tokens, initials in zip(batch["key"], batch["tokens"], batch["initials"], strict=True):
                entries = set()
                for anchor in tokens:
                    left = {anchor} | ({anchor[:k] + anchor[k + 1 :] for k in range(len(anchor))} if len(anchor) >= TYPO_LENGTH else set())
                    others = [t for t in tokens if t != anchor] + list(initials)
                    for x in left:
                        entries.update(f"{x}|{o[0]}" for o in others)
                        if x != anchor or own:
                            entries.update(f"{x}||{o}" for o in others)
                rows.extend((key, e) for e in entries)
            yield pd.DataFrame(rows, columns=["key", "entry"])

    return run


def _costs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        costs = [align([*t, *i], list(u)) for t, i, u in zip(batch["tokens"], batch["initials"], batch["own_tokens"], strict=True)]
        kept = batch[["key", "own_key", "support", "own_support"]].assign(cost=costs)
        yield kept[kept["cost"] <= MAX_COST]


def name_strings(messages: DataFrame) -> DataFrame:
    """Every distinct string in sender, recipients and cc."""
    every = F.explode(F.concat(F.array("sender"), F.coalesce("recipients", F.array()), F.coalesce("cc", F.array())))
    return messages.select(every.alias("name")).where("name is not null and lower(trim(name)) not in ('', 'n/a')").distinct()


def name_groups(names: DataFrame) -> DataFrame:
    """``names(name)`` to ``(name, entity)``: strings with one entity mean the same person or organisation."""
    forms = names.mapInPandas(_forms, FORM).withColumn("key", F.concat(F.array_join("tokens", " "), F.lit("/"), F.array_join("initials", "")))
    keys = forms.groupBy("key", "tokens", "initials").agg(F.count("*").alias("support"))
    whole = keys.where(F.size("tokens") >= 2)
    joining = keys.mapInPandas(_index(False), "key string, entry string")
    joined = whole.mapInPandas(_index(True), "key string, entry string").withColumnRenamed("key", "own_key")
    pairs = joining.join(joined, "entry").where("key <> own_key").select("key", "own_key").distinct()
    pairs = pairs.join(keys, "key").join(whole.select(F.col("key").alias("own_key"), F.col("tokens").alias("own_tokens"), F.col("support").alias("own_support")), "own_key")
    # upwards only: to the better supported key; initials always join a whole name
    upwards = (F.size("initials") > 0) | (F.struct("own_support", "own_key") > F.struct("support", "key")) & ((F.col("support") < OWN_SUPPORT) | (F.col("own_support") >= SUPPORT_RATIO * F.col("support")))
    costs = pairs.where(upwards).select("key", "tokens", "initials", "own_tokens", "own_key", "support", "own_support").mapInPandas(_costs, "key string, own_key string, support bigint, own_support bigint, cost double")
    parents = costs.groupBy("key").agg(F.min("cost").alias("least"), F.collect_list(F.struct("cost", F.negative("own_support").alias("rank"), "own_key")).alias("found"))
    nearest = F.filter("found", lambda c: c["cost"] < F.col("least") + 0.04)
    parents = parents.select("key", F.array_sort(nearest).alias("near")).withColumn("parent", F.col("near")[0]["own_key"])
    return _roots(forms, keys, parents)


def _roots(forms: DataFrame, keys: DataFrame, parents: DataFrame) -> DataFrame:
    """Follow each key to its root; a key whose nearest keys have several roots stays alone."""
    options = cut_lineage(parents.select("key", F.explode("near").alias("n")).select("key", F.col("n.own_key").alias("root")))
    for _ in range(4):
        above = options.groupBy("key").agg(F.min("root").alias("up"), F.countDistinct("root").alias("n")).where("n = 1").select(F.col("key").alias("root"), "up")
        # each round reads the one before twice
        options = cut_lineage(options.join(above, "root", "left").select("key", F.coalesce("up", "root").alias("root")).distinct())
    single = options.groupBy("key").agg(F.min("root").alias("root"), F.countDistinct("root").alias("n")).where("n = 1").select("key", "root")
    return forms.join(single, "key", "left").select("name", F.coalesce("root", "key").alias("entity"))


def name_pairs(names: DataFrame) -> DataFrame:
    """``(name_a, name_b)``: different strings that mean the same, the smaller first in byte order."""
    groups = name_groups(names)
    a, b = groups.select("entity", F.col("name").alias("name_a")), groups.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b").distinct()
