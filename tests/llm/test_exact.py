import hashlib
from collections import defaultdict

import pytest

from cityflow.llm.exact import content_sort, drop_copies

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups_of(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(LOWER)].append(doc)
    return groups


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_as_by_hand(odd_docs, odd_rows, keep):
    found = content_sort(odd_docs, keep=keep).collect()
    assert len(found) == len(odd_rows)
    expected = []
    for text, ids in groups_of(odd_rows).items():
        real = [i for i in ids if i is not None]
        kept = (min if keep == "smallest" else max)(real) if real else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, kept, len(ids), digest) for i in ids]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == sorted(expected, key=repr)
    assert sum(r.kept for r in found) == len(groups_of(odd_rows))
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_one_text_in_every_range(spark):
    """A text of nearly all rows goes over all range borders and is one group still."""
    rows = [(i, "Same" if i % 10 else f"other {i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = content_sort(docs, keep="largest").collect()
    same = [r for r in found if r.group_size > 1]
    assert len(same) == 3600 and {(r.keep_id, r.group_size) for r in same} == {(3999, 3600)}
    assert [r.doc_id for r in same if r.kept] == [3999]
    assert drop_copies(docs).count() == 401
    assert drop_copies(docs).where("text = 'Same'").first().doc_id == 1


def test_copies_go_and_columns_stay(odd_docs, odd_rows):
    left = drop_copies(odd_docs)
    assert left.schema.simpleString() == odd_docs.schema.simpleString()
    rows = left.collect()
    assert len(rows) == len(groups_of(odd_rows))
    assert all(r["key"] == "key!" and r["a.b"] == 1 for r in rows)


def test_empty(no_docs):
    assert content_sort(no_docs).count() == 0 and drop_copies(no_docs).count() == 0


def test_unknown_rule(odd_docs):
    with pytest.raises(ValueError):
        content_sort(odd_docs, keep="first")
