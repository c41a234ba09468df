import random
import shutil
import subprocess
import sys
from pathlib import Path

import public_tokenizers

import corpus_pipeline
from cityflow.llm.pii import mask
from cityflow.llm.tokens import encode
from cityflow.llm.toxicity import learned, score_documents

from .test_near import shingles

REPO = Path(__file__).resolve().parents[2]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tables(spark, folder):
    rng = random.Random(12)
    words = ["".join(rng.choices(["ta", "re", "mi", "lo", "su", "ke"], k=rng.randint(1, 4))) for _ in range(400)]
    rows = []
    for i in range(500):
        text = rng.choices(words, k=rng.randint(25, 120))
        if i % 5 == 0:
            for _ in range(4):
                text[rng.randrange(len(text))] = "zgrub"
        rows.append([i, " ".join(text), int(i % 5 == 0)])
    for i in range(500, 560):  # exact copies but for case, some masked data, blanks
        rows.append([i, rows[i - 400][1].upper(), rows[i - 400][2]])
    for i in range(560, 600):
        rows.append([i, rows[i - 300][1] + f" mail x{i}@y.org", rows[i - 300][2]])
    rows += [[600, None, 0], [601, "", 0], [602, " ", 0], [None, "a row without an id", 0]]
    docs = [(d, t, "en", "s", len(t or "")) for d, t, _ in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, x) for d, _, x in rows if d is not None and d % 2], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_run_against_brute_force(spark, tmp_path):
    tables(spark, tmp_path)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    # The network is what is learned from the same tables; every later decision is made over by hand.
    scores = score_documents(docs, learned(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))).collect()
    toxic = {r.doc_id for r in scores if r.predicted}
    left = {}
    for row in sorted((r for r in docs.collect() if r.doc_id not in toxic), key=lambda r: (r.doc_id is None, r.doc_id)):
        left.setdefault((row.text or "").translate(LOWER), row)
    sets = {r.doc_id: shingles(r.text) for r in left.values()}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    order = lambda d: (d is None, d or 0)
    ids = sorted(sets, key=order)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root(a) != root(b):
                low, high = sorted((root(a), root(b)), key=order)
                parent[high] = low
    stays = [r for r in left.values() if root(r.doc_id) == r.doc_id]
    path = public_tokenizers.path("byte_bpe_50k.json")
    expected = {r.doc_id: len(encode(path, [mask(r.text) or ""])[0]) // 4 + 1 for r in stays}
    lengths = {}
    for r in found:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == expected
    assert len({r.sequence_id for r in found}) <= -(-sum(lengths.values()) // 1024) + 2


def test_stages_keep_the_columns(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_empty_tables_missing_labels_and_clashing_columns(spark, tmp_path):
    """Stages pass on what there is: no documents, no usable labels, documents with columns named like working ones."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, tag string, root int, row string, fp int, score double, label string, n int, place int"
    row = ["en", "s", 3, "t", 1, "r", 2, 0.5, "l", 4, 5]
    texts = ["one two three four five six seven", "ONE two three four five six seven", None, "", "mail a@b.org now and then"]
    for name, rows in (("none", []), ("some", [(i, t, *row) for i, t in enumerate(texts)])):
        folder = tmp_path / name
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(7, None, None), (None, 1, 1)] if rows else [], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for stage_name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(folder))
            assert docs.schema.simpleString() == spark.read.parquet(f"{folder}/documents.parquet").schema.simpleString(), stage_name
        assert sorted(r.doc_id for r in docs.collect()) == ([0, 2, 4] if rows else [])
        assert {r.doc_id for r in corpus_pipeline.run(spark, str(folder)).collect()} == ({0, 2, 4} if rows else set())


def test_rest_works_without_the_subpackage(tmp_path):
    """The entry module still loads, with all other queries, where the subpackage is not installed."""
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse"))
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') for q in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"],
        cwd=copy,
        env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)},
        capture_output=True,
        text=True,
        check=True,
    )
    count, operators, known = said.stdout.split()
    assert int(count) > 70 and operators == "False" and known == "True"


def test_queries_have_their_names():
    from cityflow.llm.queries import QUERIES, SQL

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)
