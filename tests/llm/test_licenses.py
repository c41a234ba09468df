import random
import re

from pyspark.sql import functions as F

from cityflow.llm.licenses import PHRASES, TEMPLATES, Grams, agreement, license_spans, scan_licenses, words_of

WORD = re.compile("[0-9a-z\u0080-\U0010ffff]+")


def words_by_hand(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base_by_hand(text):
    words = words_by_hand(text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def common(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def quotes(text, template):
    """Whether some window of the text agrees in four of five words with the template, by trying all."""
    words, wanted = words_by_hand(text), words_by_hand(template)
    least, most = -(-4 * len(wanted) // 5), 5 * len(wanted) // 4
    for begin in range(len(words)):
        for size in range(least, min(most, len(words) - begin) + 1):
            if 5 * common(words[begin : begin + size], wanted) >= 4 * max(size, len(wanted)):
                return True
    return False


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], ["changed"], [words[at], "added"]])
    return words


def test_base_against_brute_force(spark):
    rng = random.Random(1)
    pieces = ["MIT", "mit", "License", "license", "Apache", "general", "PUBLIC", "GNU", "x", "é", "mité", "9", "-", "\n", ".", "license's"]
    texts = [rng.choice([" ", "-", "", "_", "\x7f"]).join(rng.choices(pieces, k=rng.randrange(40))) for _ in range(400)]
    texts += ["", None, "mit license", "MIT-License mit_license", "mit licenses", "general public license" * 3, "mit mit license license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan_licenses(docs).collect()}
    assert found == {i: base_by_hand(t) for i, t in enumerate(texts)}
    for t in texts:
        assert [w.decode() for w in words_of(t or "")] == words_by_hand(t)


def test_templates_in_edited_quotes(spark):
    """Whole and edited quotes are found, also several in a long text, and texts of the same words in other order are not."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)] + words_by_hand(" ".join(TEMPLATES.values()))
    rows, expected = [], {}
    for name, text in TEMPLATES.items():
        wanted = words_by_hand(text)
        for edits in (0, len(wanted) // 10, len(wanted) // 7):
            filler = lambda: rng.choices(vocabulary, k=rng.randint(0, 200))
            rows.append(" ".join([*filler(), *edited(rng, wanted, edits), *filler()]))
            expected[len(rows) - 1] = name
    rows += [" ".join(rng.sample(words_by_hand(t), len(words_by_hand(t)))) for t in TEMPLATES.values() if len(t) > 200]
    long_one = " ".join(rng.choices(vocabulary, k=70_000))
    rows.append(" ".join([long_one, TEMPLATES["bsd"], long_one, TEMPLATES["mit"], "tail"]))
    expected[len(rows) - 1] = "mit"
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for doc, name in expected.items():
        assert name in found[doc].labels.split(","), (doc, name)
        assert 0.8 <= found[doc].score <= 1
    assert set(found[len(rows) - 1].labels.split(",")) >= {"bsd", "mit"}
    for i, row in enumerate(rows):
        if len(words_by_hand(row)) < 300:
            told = set(filter(None, found[i].labels.split(","))) - set(PHRASES.values())
            for name in told - {"mit"}:
                assert quotes(row, TEMPLATES[name]), (i, name)


def test_all_windows_against_brute_force(spark):
    """Random edits of a template: what is found has four of five words, and what has them and 20 words or more is found."""
    rng = random.Random(3)
    text = TEMPLATES["mpl-2.0"]
    rows = [" ".join([*rng.choices("abcdef", k=5), *edited(rng, words_by_hand(text), rng.randrange(14)), *rng.choices("abcdef", k=5)]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: "mpl-2.0" in r.labels for r in scan_licenses(docs, templates={"mpl-2.0": text}).collect()}
    assert found == {i: quotes(r, text) for i, r in enumerate(rows)}
    assert 10 < sum(found.values()) < 60


def test_copies_and_edges(spark, odd_docs, no_docs):
    assert scan_licenses(no_docs).count() == 0
    assert scan_licenses(odd_docs).count() == odd_docs.count()
    same = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("Intro. " + TEMPLATES["isc"]).alias("text"), F.lit(1).alias("d1"), F.lit("x").alias("labels"))
    rows = scan_licenses(same).collect()
    assert len(rows) == 400 and {(r.labels, r.score) for r in rows} == {("isc", 1.0)}
    texts = same.select(F.lit(1).cast("long").alias("d1"), F.lit(2).cast("long").alias("d2"), "text")
    spans = license_spans(texts).collect()
    assert [(r.label, r.first, r.last) for r in spans] == [("isc", 1, 1 + len(words_of(TEMPLATES["isc"])))]


def test_hashes_are_those_of_the_words():
    words = words_of("a b c d a b c d e")
    hashes = Grams(4).of(words).tolist()
    assert len(hashes) == 6 and hashes[0] == hashes[4] and len(set(hashes)) == 5
    assert Grams(4).of(words[:3]).tolist() == []


def test_agreement():
    wanted = "a b c d e f g h i j".encode().split()
    assert agreement(wanted, wanted) == (1.0, 0, 10)
    share, first, last = agreement([b"x", *wanted[:4], b"y", *wanted[5:], b"a"], wanted)
    assert (share, first, last) == (0.9, 1, 11)
