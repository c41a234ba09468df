import hashlib
import random
import re

import pytest

from cityflow.llm.pii import BASE, KINDS, find_spans, luhn, mask, mask_pii, mod97, pii_spans, span_counts

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def by_hand(text):
    """Base spans by the plain patterns, leftmost and not overlapping within a kind."""
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if _passes(k, m.group())]


def base(text):
    return [(s.kind, s.start, s.end) for s in find_spans(text) if s.kind in BASE]


def test_against_plain_patterns():
    rng = random.Random(8)
    bits = ["a", "b.c", "@", ".", "x@y.z", "1", "25", "255", "256", "0001", "4111 1111 1111 1111", "4111-1111-1111-1111", "+", "+1 (555) 010-9999", "-", " ", "(", ")", "%", "é", "1.2.3.4", "9" * 5, "\n", "_"]
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=rng.randrange(12)))
        assert base(text) == by_hand(text), text


def test_checksums():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82WEST12345698765432") and not mod97("GB82WEST12345698765431")


def test_further_kinds():
    assert [(s.kind, s.start, s.end) for s in find_spans("pay to GB82 WEST 1234 5698 7654 32 now") if s.kind == "iban"] == [("iban", 7, 34)]
    assert [s.kind for s in find_spans("her ssn is 078-05-1120")] == ["ssn"]
    assert find_spans("part 078-05-1120") == []
    assert [s.kind for s in find_spans("geboren am 03.04.1975 in")] == ["birth"]
    assert find_spans("version of 03.04.1975") == []


@pytest.mark.parametrize("number", ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"])
@pytest.mark.parametrize("behind", ["", ".", " BIC COBADEFFXXX", " EUR 500", " 500 EUR", " 1 250", " USD", " now", "\nBIC COBADEFFXXX"])
@pytest.mark.parametrize("before", ["IBAN ", "KONTO AB12 ", "NR 12 "])
def test_iban_ends_where_it_ends(before, number, behind):
    text = before + number + behind
    assert [(s.start, s.end) for s in find_spans(text) if s.kind == "iban"] == [(len(before), len(before) + len(number))]
    assert mask(text) == before + "[IBAN]" + behind


def test_iban_of_a_wrong_length_or_checksum_is_none():
    for text in ("IBAN DE88 3704 0044 0532 0130 00 BIC COBADEFFXXX", "IBAN DE89 3704 0044 0532 0130 001", "IBAN DE89 3704 0044 0532 0130"):
        assert not [s for s in find_spans(text) if s.kind == "iban"]
    # A country without a length of its own.
    assert mask("KONTO ZZ33 1234 5678 9012 345 EUR 500") == "KONTO [IBAN] EUR 500"
    both = "GB82WEST12345698765432 DE89370400440532013000"
    assert mask("IBAN " + both) == "IBAN [IBAN] [IBAN]"


def test_words_nearby_raise_the_score():
    plain, near = find_spans("see 10.0.0.1 there")[0], find_spans("the host 10.0.0.1 there")[0]
    assert near.score > plain.score


def test_long_runs_take_no_longer_than_their_length():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + "(" * 300_000, "a.b@" + "c" * 300_000, "1 " * 150_000, "A" * 300_000):
        find_spans(text)


def test_mask():
    assert mask("mail a.b@c.org or 10.0.0.1!") == "mail [EMAIL] or [IP]!"
    assert mask(None) is None and mask("clean text") == "clean text"


def test_spans_and_digests(odd_docs, odd_rows, spark):
    found = pii_spans(odd_docs).collect()
    assert len(found) == len(odd_rows) and not any(r.spans for r in found)
    text = "né à 1.2.3.4, x@y.zz y@z.org, ssn 078-05-1120"
    row = span_counts(pii_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in by_hand(text))
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (2, 1, 0, 0)
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert row.spans == listed + f",ssn:{text.index('078')}:{len(text)}"
    assert [s.split(":")[0] for s in row.spans.split(",")] == sorted((s.split(":")[0] for s in row.spans.split(",")), key=KINDS.index)


def test_masked_documents(spark, odd_docs):
    docs = spark.createDataFrame([(1, "to x@y.org", 10, "k"), (2, "clean", 99, "k"), (3, None, None, "k")], "doc_id long, text string, n_chars int, row string")
    found = {r.doc_id: r for r in mask_pii(docs).collect()}
    assert mask_pii(docs).schema == docs.schema
    assert (found[1].text, found[1].n_chars) == ("to [EMAIL]", 10)
    assert (found[2].text, found[2].n_chars) == ("clean", 99) and found[3].text is None and found[3].n_chars is None
    assert mask_pii(odd_docs).schema.simpleString() == odd_docs.schema.simpleString()
    assert sorted(map(repr, mask_pii(odd_docs).collect())) == sorted(map(repr, odd_docs.collect()))


@pytest.mark.parametrize("operator", [pii_spans, mask_pii])
def test_empty(no_docs, operator):
    assert operator(no_docs).count() == 0
