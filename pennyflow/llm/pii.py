"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Six kinds. For `email`, `ip`, `card` and `phone` the pattern and its check (parts of an address, Luhn's
sum, the number of digits) decide alone, and such a span always stays; `iban` (mod 97) and
`national_id` (grouped digits without a checksum) stay if the score reaches `threshold`. A score starts
from the kind's prior, gains what a passed checksum is worth, and gains or loses for words within
`CONTEXT` code points before the span.

A null text counts as empty; an empty text has no spans. Rows are independent of each other, so repeated
rows and repeated ids give repeated results. Work is linear in the length of a text, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pennyflow.llm.common import arrow_map, own_columns

# Kinds in the order of listing, priors, worth of a checksum, context words.
KINDS = ("email", "ip", "card", "phone", "iban", "national_id")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "national_id": 0.2}
CHECKSUM_WORTH = 0.5
CONTEXT_WORTH = 0.35
CONTEXT = 40
CONTEXT_WORDS = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "national_id": ("ssn", "social", "security", "taxpayer", "national"),
}
AGAINST_WORDS = ("order", "invoice", "version", "serial", "part", "isbn", "tracking")
IBAN_LENGTHS = range(15, 35)
#: Letters and digits of an IBAN by its country.
COUNTRY_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match from inside a run of digits would end as the one from its start does, so only starts are tried.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LETTERS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The checksum of an IBAN: country and check digits moved to the end, letters as 10 to 35."""
    code = code.replace(" ", "")
    return len(code) in IBAN_LENGTHS and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The part before an @ starts where its run of allowed characters does, or where the last match ended."""
    last, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > last and text[start - 1] in LOCAL:
                start -= 1
        if start < at:
            last = domain.end()
            yield start, last
        at = text.find("@", max(last, at + 1))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """What follows an IBAN may look like more of it, so it is cut to its country's length, or else at the last
    space that leaves a right checksum if the country is not listed. After a failure the next start is tried."""
    m = IBAN.search(text)
    while m:
        whole, next_at = m.group(), m.start() + 1
        length, ends = COUNTRY_LENGTHS.get(whole[:2]), [i for i, c in enumerate(whole) if c == " "] + [len(whole)]
        own = [i for i in ends if len(whole[:i].replace(" ", "")) == length] if length else ends[::-1]
        for end in [*own, len(whole)]:
            if mod97(whole[:end]):
                next_at = m.start() + end
                yield m.start(), next_at
                break
        m = IBAN.search(text, next_at)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _proposed(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, kind, end, whether a checksum confirmed it) of what passes the kind's own check."""
    for start, end in _emails(text):
        yield start, 0, end, False
    for m in ADDRESS.finditer(text):
        if all(map(_small, m.group().split("."))):
            yield m.start(), 1, m.end(), False
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), 2, m.end(), True
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
                yield m.start(), 3, m.end(), False
    for start, end in _ibans(text):
        yield start, 4, end, True
    for m in NATIONAL_ID.finditer(text):
        yield m.start(), 5, m.end(), False


def score(text: str, start: int, kind: int, confirmed: bool) -> float:
    """Between 0 and 1: prior, checksum, and the words that stand before the span."""
    words = {w.lower() for w in LETTERS.findall(text[max(0, start - CONTEXT) : start])}
    value = PRIOR[KINDS[kind]] + CHECKSUM_WORTH * confirmed
    value += CONTEXT_WORTH * bool(words.intersection(CONTEXT_WORDS[KINDS[kind]]))
    value -= CONTEXT_WORTH * bool(words.intersection(AGAINST_WORDS))
    return min(1.0, max(0.0, value))


def find(text: str | None, threshold: float = 0.5) -> list[tuple[int, int, int, float, bool]]:
    """(start, kind, end, score, whether it is of a base kind) in order of start, then kind."""
    found = []
    for start, kind, end, confirmed in _proposed(text or ""):
        value = score(text, start, kind, confirmed)
        if kind < 4 or value >= threshold:
            found.append((start, kind, end, value, kind < 4))
    found.sort()
    return found


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """A row per row of `df`: its id and `found`, an array of spans (kind, start, end, score, base)."""
    kept = own_columns(df, id_col, text_col)
    kind = dict(kept.dtypes)[id_col]

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [
                [{"kind": KINDS[k], "start": s, "end": e, "score": v, "base": b} for s, k, e, v, b in find(text, threshold)]
                for text in batch.column(text_col).to_pylist()
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(found, pa.list_(SPAN))], [id_col, "found"]
            )

        return step

    span = "struct<kind: string, start: bigint, end: bigint, score: double, base: boolean>"
    return arrow_map(kept, text_col, f"`{id_col}` {kind}, found array<{span}>", start)
