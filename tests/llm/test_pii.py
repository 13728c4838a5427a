"""Personal data: base kinds against regular expressions, the others by example."""

import random
import re
from hashlib import sha256

import pytest

from teletally.llm import pii
from tests.llm.cases import ODD, docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(p) <= 255 for p in text.split(".")),
        "card": 12 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def brute(text):
    found = [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if holds(kind, m.group())
    ]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def base(text):
    return [s for s in pii.spans(text) if s[0] in pii.BASE]


ALPHABET = [*"0123456789" * 2, *"..  --++()@@ab%_é\n٣", "1.2.3.4", "255.", "@x.yz", "4242424242424242", "+1 (415) 555-0100"]


@pytest.mark.parametrize("seed", range(4))
def test_base_kinds_equal_the_patterns(seed):
    rng = random.Random(seed)
    for _ in range(8000):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 40)))
        assert base(text) == brute(text), text


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 OK", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("IBAN: DE89 3704 0044 0532 0130 01 OK", []),
        ("see https://a.b/c?d=e, now", [("url", "https://a.b/c?d=e")]),
        ("account no: 12345678.", [("account", "12345678")]),
        ("on account of 12 things", []),
        ("at 221 Baker Street, London", [("address", "221 Baker Street")]),
        ("the Street", []),
        ("password=9e5d262097 x", [("secret", "9e5d262097")]),
    ],
)
def test_other_kinds(text, found):
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)] == found


def test_masking_covers_overlaps_once():
    text = "mail a.b@c.de or +1 (415) 555-0100 at http://u@h.example/x"
    clean = pii.masked(text, pii.spans(text))
    assert clean == "mail <email> or <phone> at <url>"


def test_long_runs_are_linear():
    for part in ("account", "1.", "a@", "+1", "1 ", "http://", "A Street ", "iban", "0"):
        pii.spans(part * 30_000)


def test_query_columns_and_odd_rows(spark):
    rows = [*ODD, (20, "x a.b@c.de 1.2.3.4 y")]
    found = pii.digests(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        for doc_id, text in rows:
            if doc_id == row.doc_id and doc_id not in (None, 5):
                spans = brute(text or "")
                assert row.base_sha256 == sha256(pii.printed(spans).encode()).hexdigest()
                assert row.n_email == sum(s[0] == "email" for s in spans)
    assert pii.digests(docs(spark, [])).count() == 0
    spans = {r.doc_id: r.spans for r in pii.find(docs(spark, rows)).collect()}
    assert [(s.kind, s.value) for s in spans[20]] == [("email", "a.b@c.de"), ("ip", "1.2.3.4")]


def test_masked_table_keeps_its_columns(spark):
    table = docs(spark, [*ODD, (20, "x a.b@c.de y")])
    clean = pii.mask(table)
    assert clean.schema == table.schema or clean.columns == table.columns
    row = clean.where("doc_id = 20").first()
    assert row.text == "x <email> y" and row.n_chars == len(row.text)
    assert clean.where("doc_id = 1").first().text is None
    assert clean.count() == table.count()
