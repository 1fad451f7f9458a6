"""Personal data: patterns propose spans, checksums confirm them, context sets the score.

Kinds, in this order: ``email``, ``ip`` (parts up to 255), ``card`` (16 to 19 digits that pass Luhn),
``phone`` (international form, 8 to 15 digits) and ``iban`` (has its country's length and passes
mod 97; of a country not listed the longest run of whole words that passes). Matches are
leftmost and do not overlap within a kind; one that fails its check is dropped. A span's score is
that of its kind, raised by words such as "card" or "call" close before or after it.

Every scan is linear in the text: an address is sought from its ``@`` outwards and runs of
digits are taken whole, because a search for the plain pattern from every
character would need quadratic time on a long run of letters or digits.

Defined results: null and empty texts have no spans; repeated rows are scanned alike; an empty table gives an
empty one; a column named like ``into`` is replaced, other columns stay, whatever their names. Offsets count code points, the end is excluded.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .arrays import blocks
from .names import fresh

KINDS = ("email", "ip", "card", "phone", "iban")
#: Score without context, by kind.
PRIOR = {"email": 0.9, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": ("email", "mail", "contact", "write"),
    "ip": ("ip", "server", "host", "address"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
}
CONTEXT_CHARS = 40
#: What a context word takes off the distance to 1.
CONTEXT_WEIGHT = 0.5

SPANS = "spans array<struct<kind: string, start: int, end: int, score: double>>"

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}))")
WORD_GOES_ON = re.compile(r"[A-Za-z0-9]")
#: Characters of an IBAN by country, as registered.
IBAN_CHARS = {
    country: chars
    for chars, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # end of the last match
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        parts = run[0].split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in DIGITS.finditer(text):
        if run.end() - run.start() >= 16:
            digits = NOT_DIGIT.sub("", run[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for run in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", run[0])) <= 15:
            yield run.span()


def mod_97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # end of the last match
    for head in IBAN.finditer(text):
        if head.start() < free:
            continue
        chars, found, own = head[0], None, IBAN_CHARS.get(head[0][:2])
        for at in range(head.end(), head.end(1)):
            if text[at] == " ":
                continue
            chars += text[at]
            if len(chars) >= 15 and own in (None, len(chars)) and not WORD_GOES_ON.match(text, at + 1) and mod_97(chars):
                found = at + 1
        if found:
            yield head.start(), found
            free = found


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": ibans}
NEARBY = {kind: re.compile(rf"(?i)\b(?:{'|'.join(words)})") for kind, words in CONTEXT.items()}


def find_spans(text: str, kinds: tuple[str, ...] = KINDS) -> list[dict]:
    out = []
    for kind in kinds:
        for start, end in FINDERS[kind](text):
            around = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
            score = PRIOR[kind]
            if NEARBY[kind].search(around):
                score += (1 - score) * CONTEXT_WEIGHT
            out.append({"kind": kind, "start": start, "end": end, "score": score})
    return out


def personal_spans(text: Column) -> Column:
    """A struct ``SPANS`` per text."""
    kind = to_arrow_type(StructType.fromDDL(SPANS))
    digit = np.zeros(256, dtype=bool)
    digit[ord("0") : ord("9") + 1] = True

    @F.arrow_udf(SPANS)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for data, offsets in blocks(batch):
                # most texts have neither an @ nor a digit
                marks = np.cumsum(np.concatenate([[0], (data == ord("@")).astype(np.int32)]))
                digits = np.cumsum(np.concatenate([[0], digit[data].astype(np.int32)]))
                has_at, has_digit = np.diff(marks[offsets]) > 0, np.diff(digits[offsets]) > 0
                for r in range(len(offsets) - 1):
                    kinds = ("email",) * bool(has_at[r]) + KINDS[1:] * bool(has_digit[r])
                    spans = find_spans(data[offsets[r] : offsets[r + 1]].tobytes().decode(), kinds) if kinds else []
                    rows.append({"spans": spans})
            yield pa.array(rows, kind)

    return compute(text)["spans"]


def find_pii(docs: DataFrame, text_column: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with the spans found in the text, as an array ``into``."""
    return docs.withColumn(into, personal_spans(F.col(text_column)))


def mask_pii(docs: DataFrame, text_column: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` with every span that scores ``least`` or more replaced by its kind in brackets."""

    @F.arrow_udf("string")
    def compute(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            yield pa.array([masked(t.as_py(), s.as_py(), least) for t, s in zip(texts, found)], pa.string())

    spans = fresh(docs, "_pii")
    found = find_pii(docs, text_column, spans)
    return found.withColumn(text_column, compute(F.col(text_column), F.col(spans))).drop(spans)


def masked(text: str | None, spans: list[dict] | None, least: float) -> str | None:
    out, at = [], 0
    for span in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
        if span["score"] >= least and span["start"] >= at:
            out += [text[at : span["start"]], f"[{span['kind']}]"]
            at = span["end"]
    return "".join([*out, text[at:]]) if out else text
