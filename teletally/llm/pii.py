"""Personal data by anchors that are expanded and validated.

One automaton pass over a text finds the anchors: at-signs, schemes, cues such as ``iban`` or
``account``, a plus before a digit, a dot between digits, two digits with at most one blank or
hyphen between. Only there a parser looks at the text: it grows a candidate to both sides by fixed
character sets, without backtracking, and validates it. Text without anchors is never parsed.

Kinds, in the order used for sorting and joining:

* ``email``, ``ip``, ``card``, ``phone``: leftmost and non-overlapping within the kind; a candidate that
  fails its validation is dropped without a second try, and the search goes on behind it.
* ``url`` (scheme, host, no white space), ``iban`` (country, check digits by modulo 97), ``account`` (6 to
  18 digits or capitals behind a cue), ``secret`` (value behind a password, token or key cue),
  ``address`` (house number, one to three capitalised words, street cue).
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.llm.common import map_rows, text_or_empty

Span = tuple[int, int]

# Kinds in order, character sets of the base kinds, cues of the others.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "account", "secret", "address")
BASE = KINDS[:4]
DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
CAPITALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
LABEL = LETTERS | DIGITS | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
SPACES = frozenset(" \t\n\r\x0b\x0c")
SCHEMES = ("http://", "https://", "ftp://")
IBAN_CUES = ("iban", "IBAN", "Iban")
ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "Konto", "konto", "compte", "cuenta")
SECRET_CUES = ("password=", "passwd=", "token=", "secret=", "api_key=", "apikey=", "access_key=")
STREET_CUES = (" Street", " Avenue", " Road", " Lane", " Boulevard", " Drive", " St.", " Ave.", " Rd.")

_RIGHT_TRIM = frozenset(".,;:!?'\")]}>")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_holds(text: str) -> bool:
    """Whether country, length and check digits of an account number without blanks hold."""
    if not (15 <= len(text) <= 34 and set(text[:2]) <= CAPITALS and set(text[2:4]) <= DIGITS):
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _run(text: str, at: int, allowed: frozenset[str]) -> int:
    """End of the run of allowed characters that starts at ``at``."""
    end, size = at, len(text)
    while end < size and text[end] in allowed:
        end += 1
    return end


def _email(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None, floor
    labels = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in LABEL:
        end, labels = _run(text, end + 1, LABEL), labels + 1
    return ((start, end), end) if labels else (None, floor)


def _ip(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    start = at
    while start > floor and text[start - 1] in DIGITS:
        start -= 1
    if start == at:
        return None, at + 1
    end, dots = at, 0
    while dots < 3 and end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS:
        end, dots = _run(text, end + 1, DIGITS), dots + 1
    if dots < 3:
        return None, end  # nor can one begin at a later of these numbers, with still fewer dots to come
    # Long runs of zeros are compared without being parsed as numbers.
    parts = [part.lstrip("0") for part in text[start:end].split(".")]
    holds = all(len(part) < 3 or (len(part) == 3 and part <= "255") for part in parts)
    return ((start, end) if holds else None), end


def _card(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    end, size = at + 1, len(text)
    while end < size:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    digits = text[at:end].replace(" ", "").replace("-", "")
    return ((at, end) if 12 <= len(digits) <= 19 and luhn(digits) else None), end


def _phone(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    end = _run(text, at + 2, PHONE)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:
        return None, at + 1
    count = sum(c in DIGITS for c in text[at:end])
    return ((at, end) if 9 <= count <= 15 else None), end


def _until_space(text: str, at: int) -> int:
    end = at
    while end < len(text) and text[end] not in SPACES and text[end] not in "<>\"'":
        end += 1
    while end > at and text[end - 1] in _RIGHT_TRIM:
        end -= 1
    return end


def _url(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    host = text.index("//", at) + 2
    end = _until_space(text, host)
    return ((at, end), end) if end > host and text[host] in LABEL else (None, host)


def _behind(text: str, cue_end: int) -> int:
    """First character of a value behind a cue: past up to 12 letters and 12 signs and blanks."""
    start = cue_end
    while start < min(cue_end + 12, len(text)) and text[start] in LETTERS:
        start += 1
    stop = min(start + 12, len(text))
    while start < stop and text[start] in " :.#=\tnNoOr":
        start += 1
    return start


def _iban(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    start = _behind(text, at + 4)
    end, found = start, []
    while end < len(text) and len(found) < 34:
        if text[end] in DIGITS or text[end] in CAPITALS:
            found.append(text[end])
        elif text[end] != " " or end + 1 >= len(text) or not (text[end + 1] in DIGITS or text[end + 1] in CAPITALS):
            break
        end += 1
    # Capitals of the next word may follow; the longest valid number counts.
    while found:
        if text[end - 1] != " ":
            if iban_holds("".join(found)):
                return (start, end), end
            found.pop()
        end -= 1
    return None, at + 4


def _account(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    start = _behind(text, at)
    end = start
    while end < len(text) and (text[end] in DIGITS or text[end] in CAPITALS or text[end] == "-"):
        end += 1
    while end > start and text[end - 1] == "-":
        end -= 1
    value = text[start:end].replace("-", "")
    holds = 6 <= len(value) <= 18 and sum(c in DIGITS for c in value) >= 6
    return ((start, end) if holds else None), max(end, at + 1)


def _secret(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    start = text.index("=", at) + 1
    end = _until_space(text, start)
    return ((start, end) if end - start >= 6 else None), max(end, start)


def _address(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """Words back from the street cue to the house number."""
    end = _run(text, at + 1, LETTERS | frozenset("."))
    start, words = at, 0
    while start > floor and words < 4:
        word = start
        while word > floor and text[word - 1] not in SPACES and start - word < 24:
            word -= 1
        part = text[word:start]
        if words and part and set(part) <= DIGITS and len(part) <= 5:
            return (word, end), end
        if not part or part[0] not in CAPITALS or word <= floor or text[word - 1] != " ":
            break
        start, words = word - 1, words + 1
    return None, end


Parser = Callable[[str, int, int], tuple[Span | None, int]]
PARSERS: dict[str, Parser] = {
    "email": _email,
    "ip": _ip,
    "card": _card,
    "phone": _phone,
    "url": _url,
    "iban": _iban,
    "account": _account,
    "secret": _secret,
    "address": _address,
}


def _anchors() -> ahocorasick.Automaton:
    """Anchors to (kind, distance from the anchor's last character to where its parser begins)."""
    digits = sorted(DIGITS)
    found = [("email", "@", 0)]
    found += [("phone", "+" + d, 1) for d in digits]
    found += [("ip", f"{a}.{b}", 1) for a in digits for b in digits]
    found += [("card", a + sign + b, 1 + len(sign)) for a in digits for sign in ("", " ", "-") for b in digits]
    found += [("url", scheme, len(scheme) - 1) for scheme in SCHEMES]
    found += [("iban", cue, len(cue) - 1) for cue in IBAN_CUES]
    # The value stands behind the cue, and so does its anchor.
    found += [("account", cue, -1) for cue in ACCOUNT_CUES]
    found += [("secret", cue, len(cue) - 1) for cue in SECRET_CUES]
    found += [("address", cue, len(cue) - 1) for cue in STREET_CUES]
    automaton = ahocorasick.Automaton()
    for kind, anchor, back in found:
        automaton.add_word(anchor, (kind, back))
    automaton.make_automaton()
    return automaton


_automaton: ahocorasick.Automaton | None = None


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data, by start and then kind; code points, end exclusive."""
    global _automaton
    if _automaton is None:
        _automaton = _anchors()
    found: list[tuple[str, int, int]] = []
    # Where the next candidate of a kind may begin.
    floors = dict.fromkeys(KINDS, 0)
    for last, (kind, back) in _automaton.iter(text):
        at = last - back
        if at < floors[kind]:
            continue
        span, floors[kind] = PARSERS[kind](text, at, floors[kind])
        if span:
            found.append((kind, *span))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def masked(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlaps are covered once.

    The kind that starts first names the replacement.
    """
    parts, at, end = [], 0, 0
    for kind, start, stop in found:
        if start >= end:
            parts += [text[at:start], f"<{kind}>"]
        end = max(end, stop)
        at = end
    return "".join([*parts, text[at:]])


def printed(found: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for kind, start, end in found])


def find(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of every whole text: ``doc_id``, ``spans`` (array of kind, start, end, value).

    One row per input row, repeated ones included. A null text counts as empty; rows without personal
    data have an empty array; an empty table gives an empty result; other columns are ignored.
    """

    def rows(batch: dict[str, list]) -> dict[str, list]:
        found = [
            [{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in spans(text)] for text in batch["text"]
        ]
        return {"doc_id": batch["doc_id"], "spans": found}

    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>"
    return map_rows(_named(docs, id_column, text_column), schema, rows)


def mask(docs: DataFrame, *, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """The table with personal data in its texts replaced by its kind, as in ``<email>``.

    All columns are kept in order and type, whatever their names; null texts stay null. The length
    column, if it is there, is set to the new text's code points.
    """

    @F.pandas_udf("string")
    def cleaned(texts):
        return texts.map(lambda t: masked(t, spans(t)), na_action="ignore")

    result = docs.withColumn(text_column, cleaned(F.col(text_column)))
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        result = result.withColumn(length_column, F.length(text_column).cast(kind))
    return result


def digests(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts of the base kinds, a SHA-256 over their spans, and all spans, for every row.

    Rows, nulls and clashes as in ``find``.
    """

    def rows(batch: dict[str, list]) -> dict[str, list]:
        found = [spans(text) for text in batch["text"]]
        base = [[s for s in one if s[0] in BASE] for one in found]
        counts = {f"n_{k}": [sum(s[0] == k for s in one) for one in base] for k in BASE}
        digest = [sha256(printed(one).encode()).hexdigest() for one in base]
        return {"doc_id": batch["doc_id"], **counts, "base_sha256": digest, "spans": [printed(one) for one in found]}

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_rows(_named(docs, id_column, text_column), schema, rows)


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
