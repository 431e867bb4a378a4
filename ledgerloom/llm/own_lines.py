"""The lines of one mail that its layout shows to be written by its sender: a small helper of :mod:`history`."""

from __future__ import annotations

import re
from functools import lru_cache

from .names import fold, one_edit, parse_form

# --- fixed values ---
CLOSINGS = {
    "best", "cheers", "rgds", "thanks", "kind regards", "regards", "sincerely", "best regards", "many thanks", "thank you", "with appreciation", "warm regards", "yours sincerely",
    "viele grüße", "mit freundlichen grüßen", "mfg", "beste grüße", "freundliche grüße", "vg", "lg", "gruß", "atentamente", "saludos cordiales", "un saludo", "saludos", "gracias", "un cordial saludo", "yours", "all the best", "br", "thx",
}
HEADS = "from|sent|to|cc|bcc|subject|date|von|gesendet|an|betreff|datum|de|enviado|para|asunto|fecha|reply-to"
WROTE = "wrote|schrieb|escribió|said|writes|sagte|dijo"
DEVICES = r"(?:sent|typed|get|gesendet|getippt|enviado|escrito) (?:from|on|the mail app|von|mit|auf|desde|en) ?(?:my|a|for|meine|mi|un)?.{0,60}"
DISCLAIMERS = (
    r"confidentiality notice|notice: this (?:message|e-?mail)|this (?:e-?mail|message)(?: and any \w+ with it)? (?:is|are) (?:confidential|intended)|if you are not the (?:intended|named)|nothing in this message is a formal"
    r"|think of the trees|please consider the environment|any advice in this|views in this (?:message|mail)|diese (?:nachricht|e-?mail) ist vertraulich|este (?:mensaje|correo) es confidencial|disclaimer\b"
)
# --- end of fixed values ---

_HEAD = re.compile(rf"\s*[*_]{{0,2}}(?:{HEADS})\s*[*_]{{0,2}}:", re.I)
_FROM = re.compile(r"\s*[*_]{0,2}(?:from|von|de)\s*[*_]{0,2}:\s*\S|\s*[*_]{0,2}(?:from|von|de):[*_]{0,2}", re.I)
_SEPARATOR = re.compile(r"\s*(?:-{3,}\s*(?:original|forwarded|ursprüngliche|weitergeleitete|mensaje)[^-]*-{3,}|begin forwarded message:|_{20,}|-{20,})\s*$", re.I)
_INTRO_END = re.compile(rf"(?:\b(?:{WROTE})\b[^.?!]*:|<[^>]+>:)\s*$", re.I)
_INTRO_START = re.compile(r"\s*(?:On|Am|El|Le|Il)\s.*\d")
_NAME_COLON = re.compile(r"\s*[A-ZÀ-Þ][\wÀ-ÿ.'-]*(?: [A-ZÀ-Þ][\wÀ-ÿ.'-]*){0,4}(?: <[^>]+>)?:\s*$")
_DELIMITER = re.compile(r"\s*(?:-- ?|—{1,3}|_{5,19}|\*{3,}|={3,}|~{3,})\s*$")
_DEVICE = re.compile(rf"\s*(?:{DEVICES})$", re.I)
_DISCLAIMER = re.compile(rf"\s*(?:{DISCLAIMERS})", re.I)
_CONTACT = re.compile(r"@|\+?\(?\d{2,5}\)?[ .-]\d{3,5}[ .-]\d{3,4}|, [A-Z]{2} \d{5}|^\s*(?:P\.? ?O\.? Box|\d{1,5} [A-ZÀ-Þ]\w+ |[A-ZÀ-Þ]\w+(?:weg|straße|platz|gasse) \d|Calle )|\b(?:Ltd|LLC|GmbH|Inc|Incorporated|Limited)\.?\s*$")
_WORD = re.compile(r"[^\W\d_]+")
_NO_NAME = re.compile(r"\d|@")
_DASH_NAME = re.compile(r"\s*[-–—] ?[A-ZÀ-Þ]\w+\s*$")
_TITLE = re.compile(r"\s*[A-ZÀ-Þ][\wÀ-ÿ.&,-]*(?: (?:of|de|und|and|für|[A-ZÀ-Þ&][\wÀ-ÿ.&,-]*)){0,5}\s*$")


def is_quoted(line: str) -> bool:
    return line.lstrip()[:1] in (">", "|")


def is_name(line: str, tokens: frozenset[str]) -> bool:
    """The sender's own name alone on a line."""
    if not tokens or line.rstrip().endswith((",", ":", "?", "!", ";")):
        return False
    words: list[str] = []
    for m in _WORD.finditer(line):  # most lines end at their second word
        w = m.group()
        if len(words) == 5 or not (w[0].isupper() or w in ("von", "de", "the")):
            return False
        words.append(w)
    if _NO_NAME.search(line):
        return False
    full = [fold(w) for w in words if len(w) > 1]
    return any(w in tokens or (len(w) > 4 and any(one_edit(w, t) for t in tokens)) for w in full)


def _contact(line: str, tokens: frozenset[str]) -> bool:
    text = line.strip()
    if len(text) > 70:
        return False
    return bool(_CONTACT.search(text) or _TITLE.match(text) or is_name(text, tokens) or _DELIMITER.match(text))


@lru_cache(20_000)
def sender_tokens(sender: str | None) -> frozenset[str]:
    if not sender or sender.strip().lower() == "n/a":
        return frozenset()
    full, _ = parse_form(sender)
    return frozenset(t for t in full if len(t) > 1)


def own_lines(text: str, sender: str | None) -> list[int]:
    """The numbers, from 0, of the lines that the layout shows to be the sender's."""
    lines = text.split("\n")
    tokens = sender_tokens(sender)
    n = len(lines)
    quoted = [is_quoted(x) for x in lines]
    blank = [not x.strip() for x in lines]
    after = [n] * (n + 1)  # the next line that is not blank
    for i in range(n - 1, -1, -1):
        after[i] = after[i + 1] if blank[i] else i
    drop = [q or b for q, b in zip(quoted, blank, strict=True)]
    i = 0
    while i < n:
        if drop[i]:
            i += 1
            continue
        line = lines[i]
        head = ":" in line and _FROM.match(line) and sum(bool(_HEAD.match(lines[k])) for k in range(i, min(n, i + 5))) >= 2
        separator = _SEPARATOR.match(line) and after[i + 1] < n and (_HEAD.match(lines[after[i + 1]]) or quoted[after[i + 1]])
        if head or separator:
            written = not all(drop[:i])
            while i < n and (blank[i] or _SEPARATOR.match(lines[i]) or _HEAD.match(lines[i]) or (lines[i].lstrip().startswith(("<",)) and not quoted[i])):
                drop[i] = True
                i += 1
            if i < n and (written or not quoted[i]):
                drop[i:] = [True] * (n - i)  # below the sender's text, or without marks, history runs to the end
                break
            continue
        intro = _intro(lines, quoted, blank, after, i)
        if intro:
            drop[i:intro] = [True] * (intro - i)
            i = intro
            if after[i] < n and not quoted[after[i]]:
                drop[i:] = [True] * (n - i)
                break
            continue
        if _DEVICE.match(line):
            drop[i] = True
        elif _DISCLAIMER.match(line):
            while i < n and not blank[i] and not quoted[i]:
                drop[i] = True
                i += 1
            continue
        elif signature := _signature(lines, quoted, blank, after, i, tokens):
            drop[i:signature] = [True] * (signature - i)
            i = signature
            continue
        i += 1
    return [k for k in range(n) if not drop[k]]


def _intro(lines: list[str], quoted: list[bool], blank: list[bool], after: list[int], i: int) -> int:
    """Where the lines that introduce a quotation end, if they begin here."""
    for size in (1, 2, 3):
        end = i + size
        if end > len(lines) or blank[end - 1] or quoted[end - 1]:
            return 0
        last = lines[end - 1]
        colon = last.rstrip().endswith(":")
        if colon and _INTRO_END.search(last) and (size == 1 or _INTRO_START.match(lines[i])):
            follows = after[end]
            if follows < len(lines) and (quoted[follows] or _INTRO_START.match(lines[i])):
                return end
            return 0
        if colon and size == 1 and _NAME_COLON.match(last) and end < len(lines) and quoted[end]:
            return end
        if last.rstrip().endswith((".", "?", "!")):
            return 0
    return 0


def _signature(lines: list[str], quoted: list[bool], blank: list[bool], after: list[int], i: int, tokens: frozenset[str]) -> int:
    """Where the closing formula, name and contact lines end, if they begin here."""
    n, line = len(lines), lines[i].strip()
    closing = line.lower().rstrip(",.! ") in CLOSINGS and not line.endswith(".")
    if not closing and len(line) <= 24 and line.endswith(",") and after[i + 1] < n and is_name(lines[after[i + 1]], tokens):
        closing = any(one_edit(line.lower().rstrip(","), c) for c in CLOSINGS)
    delimiter = bool(_DELIMITER.match(lines[i]))
    dash_name = bool(_DASH_NAME.match(lines[i])) and (not tokens or is_name(line.lstrip("-–— "), tokens))
    own_name = is_name(line, tokens)
    after_me = after[i + 1]
    if own_name and not closing:
        # a name needs contact lines below it, or nothing of its paragraph
        own_name = (i + 1 >= n or blank[i + 1] or quoted[i + 1] or _contact(lines[i + 1], tokens)) and (i == 0 or blank[i - 1] or i + 1 >= n or blank[i + 1] or _contact(lines[i + 1], tokens))
    unknown_name = not tokens and bool(_TITLE.match(line)) and 1 <= len(line.split()) <= 4 and i + 2 < n and _contact(lines[i + 1], tokens) and _contact(lines[i + 2], tokens) and not line.endswith(",")
    if not (closing or delimiter or dash_name or own_name or unknown_name):
        return 0
    end = i + 1
    if (closing or delimiter) and after_me < n and not quoted[after_me] and _contact(lines[after_me], tokens) and not _HEAD.match(lines[after_me]) and after_me - end <= 2 and not _SEPARATOR.match(lines[after_me]):
        if is_name(lines[after_me], tokens) or after_me == i + 1 or delimiter or not tokens or _TITLE.match(lines[after_me].strip()):
            end = after_me
    while end < n and not blank[end] and not quoted[end] and _contact(lines[end], tokens) and not (_HEAD.match(lines[end]) and _FROM.match(lines[end])) and not _SEPARATOR.match(lines[end]) and not _DEVICE.match(lines[end]):
        end += 1
    return end
