"""Base kinds against the plain patterns; the method's kinds; odd rows."""

import random
import re

from pennyflow.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def brute(text):
    found = [
        (m.start(), list(PLAIN).index(kind), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text)
        if passes(kind, m.group())
    ]
    return sorted(found)


def test_base_kinds_equal_the_plain_patterns():
    rnd = random.Random(5)
    parts = ["a", "b.c", "@", "@x.de", ".", "..", "1", "22", "255", "256", "0001", " ", "-", "+", "+1", "(5)", "4111 1111 1111 1111", "x@y.z@w.v", "%", "é", "\n"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 14)))
        assert [(s, k, e) for s, k, e, _, base in pii.find(text) if base] == brute(text), text


def test_checksums_and_context():
    def kinds(text):
        return [pii.KINDS[k] for _, k, _, _, base in pii.find(text) if not base]

    assert kinds("my IBAN is DE89 3704 0044 0532 0130 00.") == ["iban"]
    assert kinds("my IBAN is DE88 3704 0044 0532 0130 00.") == []
    assert kinds("social security number 123-45-6789") == ["national_id"]
    assert kinds("part number 123-45-6789") == []
    low, high = (pii.find(t)[0][3] for t in ("order 4111111111111111", "credit card 4111111111111111"))
    assert low < high


def test_long_runs_take_linear_time():
    for run in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "@" * 100_000):
        pii.find(run)


def test_odd_rows(odd, nothing):
    rows = pii.personal_data(odd).collect()
    assert len(rows) == odd.count() and all(r["found"] == [] for r in rows if r["doc_id"] is None)
    assert pii.personal_data(nothing).count() == 0


def test_ibans_before_capitals_and_digits():
    for text, want in (
        ("IBAN DE89 3704 0044 0532 0130 00 EUR 500", ["DE89 3704 0044 0532 0130 00"]),
        ("DE89370400440532013000 BIC COBADEFF", ["DE89370400440532013000"]),
        ("AB12 DE89370400440532013000 GB82 WEST 1234 5698 7654 32", ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]),
        ("DE88 3704 0044 0532 0130 00 EUR", []),
    ):
        assert [text[s:e] for s, k, e, *_ in pii.find(text) if pii.KINDS[k] == "iban"] == want
