"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Each pattern reads a text in time proportional to its length: runs are taken whole, and what starts inside a
run that has failed is not tried again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, packed, slices, with_first

#: Order of kinds in results. The first four are kept whatever their score.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "birth")
BASE = KINDS[:4]

#: A span of another kind counts from this score on.
THRESHOLD = 0.6
#: Characters before and after a span in which words are looked for.
BEFORE, AFTER = 48, 24

# Score of a pattern alone, and what a checksum and a word nearby add.
PATTERN_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.3, "phone": 0.6, "iban": 0.2, "ssn": 0.4, "birth": 0.3}
CHECKSUM_ADDS = 0.5
CONTEXT_ADDS = 0.3

CONTEXT = {
    "email": ("mail", "contact", "kontakt", "contacto"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "birth": ("born", "birth", "dob", "geboren", "geburtstag", "né", "née", "naissance", "nacido", "nacimiento"),
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?: ?[A-Z0-9]){11,30}))")
_LETTERS = re.compile(r"[A-Za-z0-9]")
#: Characters of an account number in international form, by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_BIRTH = re.compile(r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9/-])")
_WORD = re.compile(r"\w+")
_DIGITS = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Span:
    """Code points [start, end) of a text that hold personal data of a kind."""

    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number in international form has the remainder 1."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A name goes back from its @ as far as its characters do, but not into the match before."""
    done = 0
    for domain in _DOMAIN.finditer(text):
        at = domain.start()
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at:
            done = domain.end()
            yield begin, done


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Numbers as long as their country has them; where it has none, to the last end that the checksum confirms."""
    done = 0
    for head in _IBAN.finditer(text):
        start = head.start()
        if start < done:
            continue
        ends = [i for i in range(head.end(), head.end(1)) if text[i] != " "]
        known = IBAN_LENGTHS.get(text[start : start + 2])
        for length in [known] if known else range(len(ends) + 4, 14, -1):
            if length > len(ends) + 4:
                continue
            end = ends[length - 5] + 1
            if not _LETTERS.match(text, end) and mod97(text[start:end].replace(" ", "")):
                done = end
                yield start, end
                break


def _octet(part: str) -> bool:
    significant = part.lstrip("0")
    return len(significant) <= 3 and int(significant or "0") <= 255


def _proposed(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Kind, start, end and whether a checksum holds, of what the patterns and exclusions leave."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end, False
    if not _DIGITS.search(text):
        return
    if "." in text:
        for m in _IP.finditer(text):
            if all(map(_octet, m.group().split("."))):
                yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m.group())) <= 15:
                yield "phone", m.start(), m.end(), False
    for start, end in _ibans(text):
        yield "iban", start, end, True
    for kind, pattern in (("ssn", _SSN), ("birth", _BIRTH)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end(), False


def find_spans(text: str | None) -> list[Span]:
    """Spans of a whole text by kind, then start. Null and empty texts have none.

    Spans of different base kinds may overlap; one of a further kind is left out where a base span is.
    """
    spans: list[Span] = []
    for kind, start, end, confirmed in _proposed(text or ""):
        words = _WORD.findall((text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]).lower())
        near = not set(CONTEXT[kind]).isdisjoint(words)
        score = min(1.0, PATTERN_SCORE[kind] + CHECKSUM_ADDS * confirmed + CONTEXT_ADDS * near)
        if kind not in BASE:
            if score < THRESHOLD or any(s.kind in BASE and s.start < end and start < s.end for s in spans):
                continue
        spans.append(Span(kind, start, end, round(score, 3)))
    return spans


def mask(text: str | None) -> str | None:
    """The text with every span, overlapping ones as one, replaced by its kind in brackets."""
    spans = sorted(find_spans(text), key=lambda s: (s.start, -s.end))
    if not spans:
        return text
    parts, done = [], 0
    for s in spans:
        if s.start >= done:
            parts += [text[done : s.start], f"[{s.kind.upper()}]"]
        done = max(done, s.end)
    return "".join([*parts, text[done:]])


_SPANS = "array<struct<kind string, start long, end long, score double>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        spans = [[vars(s) for s in find_spans(t)] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN_TYPE)], ["doc_id", "spans"])


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end in code points, score) of each document.

    A null or empty text has no spans. Null and repeated ids are rows like any other; other columns are
    not read; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_found, f"doc_id long, spans {_SPANS}")


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def span_counts(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans and all spans as text."""

    def listed(kinds: tuple[str, ...]):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(F.filter("spans", lambda s: s["kind"].isin(*kinds)), one), ",")

    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return spans.select("doc_id", *counts, F.sha2(listed(BASE), 256).alias("base_sha256"), listed(KINDS).alias("spans"))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = pa.array([mask(t) for t in batch.column(1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["row", "text"])


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with personal data masked; `length_col`, where there is one, follows the new text.

    Texts without personal data, null ones too, stay as they are, and so do all other columns.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(packed(docs).alias("row"), col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_masked, with_first("row", rows, "text string"))
    original = F.col("row").getField(text_col)
    changed = ~F.col("text").eqNullSafe(original)
    columns = []
    for field in docs.schema.fields:
        value = F.col("row").getField(field.name)
        if field.name == text_col:
            value = F.when(changed, F.col("text")).otherwise(value).cast(field.dataType)
        elif field.name == length_col:
            value = F.when(changed, F.char_length("text")).otherwise(value).cast(field.dataType)
        columns.append(value.alias(field.name))
    return out.select(*columns)
