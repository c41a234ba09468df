"""License scans by diagonal voting.

Every rolling k-gram of words of every document is joined, by its hash, with the places where license templates
have it. A shared k-gram votes for a diagonal: its place in the document less its place in the template. Votes are counted
per text, template and diagonal; a span that quotes a template with some words put in or left out spreads its votes over
neighbouring diagonals, so these are merged around the strongest. What has the votes that an agreement of four in
five words must leave is verified against the words of the text.

Equal texts are one text to the votes: k-grams carry a 128-bit digest of their text and not the document's id, so a text that a
third of all rows share is counted once per task and verified once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityflow.llm.common import UPPER_TO_LOWER, bounded_batches, col, slices, stored

#: Words of a k-gram.
GRAM = 4
#: Agreement of a span with its template, as a fraction: of the template's words, and of the span's.
OVER, UNDER = 4, 5
#: K-grams that go to Spark as one row.
PIECE = 1 << 16
SEED = 42

_WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)

# Phrases and the labels they stand for.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices and license texts as they are commonly written, by the label of the method.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-attribution": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means.""",
}


def words_of(text: str | bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased."""
    data = text.encode() if isinstance(text, str) else text
    return _WORDS.findall(data.translate(UPPER_TO_LOWER))


class Grams:
    """Hashes of the rolling k-grams of words."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        """One hash for each place where a k-gram starts."""
        n = len(words) - self.size + 1
        if n <= 0:
            return np.empty(0, np.int64)
        known = self.known
        if len(known) > 400_000:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word, SEED)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        total = np.zeros(n, np.uint64)
        for i in range(self.size):
            total = (total + hashes[i : i + n]) * _BASE
            total ^= total >> np.uint64(29)
        return total.view(np.int64)


def _texts(values: pa.Array) -> Iterator[bytes]:
    return (v.as_buffer().to_pybytes() if v.is_valid else b"" for v in values)


def base_places(words: list[bytes], phrases: Mapping[str, str]) -> tuple[list[int], set[str]]:
    """Starts of all places where the words of a phrase stand one after another, and the labels of these phrases."""
    places, labels = [], set()
    held = set(words)
    for phrase, label in phrases.items():
        wanted = words_of(phrase)
        if not held.issuperset(wanted):
            continue
        at = -1
        while True:
            try:
                at = words.index(wanted[-1], at + 1)
            except ValueError:
                break
            start = at - len(wanted) + 1
            if start >= 0 and words[start : at + 1] == wanted:
                places.append(start)
                labels.add(label)
    return places, labels


def _counted(phrases: Mapping[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for text in _texts(batch.column(3)):
                words = words_of(text)
                places, labels = base_places(words, phrases)
                rows.append((len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)))
            columns = list(zip(*rows, strict=True))
            kinds = [*[pa.int64()] * 4, pa.list_(pa.string())]
            names = ["doc_id", "d1", "d2", "n_words", "n_base", "first_word", "last_word", "base"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    return run


def _rolled(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(size)
        for batch in slices(batches, "text"):
            d1, d2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            one, two, starts, found = [], [], [], []
            for a, b, text in zip(d1, d2, _texts(batch.column(2)), strict=True):
                hashes = grams.of(words_of(text))
                for at in range(0, len(hashes), PIECE):
                    one.append(a)
                    two.append(b)
                    starts.append(at)
                    found.append(hashes[at : at + PIECE])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(starts, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                ["d1", "d2", "begin", "grams"],
            )

    return run


def template_places(spark: SparkSession, templates: Mapping[str, str], size: int = GRAM) -> DataFrame:
    """Every place of a k-gram in a template; as many rows as the templates have words at most."""
    grams, rows = Grams(size), []
    for name, text in templates.items():
        words = words_of(text)
        reach = max(1, len(words) * (UNDER - OVER) // UNDER)
        rows += [(int(h), name, i, len(words), reach) for i, h in enumerate(grams.of(words).tolist())]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["gram", "template", "place", "size", "reach"]
    return spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names))


def agreement(words: list[bytes], template: list[bytes]) -> tuple[float, int, int]:
    """(agreement, first, last) of the span that best quotes the template: the share of both that the common words make up.

    The span is what lies between the first and the last common word; stray common words far from the rest are left out.
    """
    matched = [m for m in SequenceMatcher(None, words, template, autojunk=False).get_matching_blocks() if m.size]
    best = (0.0, 0, 0)
    for i in range(len(matched)):
        common = 0
        for j in range(i, len(matched)):
            common += matched[j].size
            first, last = matched[i].a, matched[j].a + matched[j].size
            found = common / max(len(template), last - first)
            if found > best[0]:
                best = (found, first, last)
    return best


def _verified(templates: Mapping[str, str]):
    held = {name: words_of(text) for name, text in templates.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            spots = batch.column(3).to_pylist()
            for a, b, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2)), spots, strict=True):
                words = words_of(text)
                for spot in wanted:
                    template = held[spot["template"]]
                    begin = max(0, spot["diagonal"] - spot["reach"])
                    end = max(0, spot["diagonal"] + len(template) + spot["reach"])
                    share, first, last = agreement(words[begin:end], template)
                    if share * UNDER >= OVER:
                        out.append((a, b, spot["template"], share, begin + first, begin + last))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            names = ["d1", "d2", "label", "agreement", "first", "last"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text: Column = F.coalesce(col(text_col).cast("string"), F.lit(""))
    digests = F.xxhash64(text).alias("d1"), F.xxhash64(F.lit("second"), text).alias("d2")
    return docs.select(col(id_col).cast("long").alias("doc_id"), *digests, text.alias("text"))


def license_spans(texts: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """Spans of the distinct texts (d1, d2, text) that quote a template: d1 and d2 (digests of the text), label, agreement, first and last (words, the last excluded).

    Only texts with spans have rows. Every span with four in five words in common is found where it is in one piece; a
    template with fewer words than a k-gram is never found.
    """
    spark = texts.sparkSession
    rolled = texts.select("d1", "d2", "text").mapInArrow(_rolled(GRAM), "d1 long, d2 long, begin long, grams array<long>")
    placed = rolled.select("d1", "d2", "begin", F.posexplode("grams").alias("at", "gram"))
    places = template_places(spark, templates)
    met = placed.join(places, "gram").withColumn("spot", F.col("begin") + F.col("at"))
    # Copies of a text vote for the same spots, once.
    votes = met.select("d1", "d2", "template", "size", "reach", (F.col("spot") - F.col("place")).alias("diagonal"), "spot").distinct()
    counted = votes.groupBy("d1", "d2", "template", "size", "reach", "diagonal").agg(F.count("*").alias("votes"))
    # Neighbours are as far apart as words may have been put in or left out.
    scaled = F.col("diagonal").cast("double") / F.col("reach")
    near = Window.partitionBy("d1", "d2", "template").orderBy("scaled").rangeBetween(-1, 1)
    merged = counted.withColumn("scaled", scaled).withColumns({"all": F.sum("votes").over(near), "strongest": F.max(F.struct("votes", (-F.col("diagonal")).alias("least"))).over(near)})
    # An agreement of four in five words leaves so many k-grams whole.
    least = F.greatest(F.lit(1), F.col("size") - (GRAM - 1) - GRAM * F.floor(F.col("size") * (UNDER - OVER) / UNDER))
    heads = merged.where((F.col("votes") == F.col("strongest.votes")) & (-F.col("diagonal") == F.col("strongest.least")) & (F.col("all") >= least))
    # A text has fewer of these than words.
    spots = heads.groupBy("d1", "d2").agg(F.collect_list(F.struct("template", "diagonal", "reach")).alias("spots"))
    spots = stored(spots)
    wanted = texts.join(spots.select("d1", "d2"), ["d1", "d2"], "left_semi").groupBy("d1", "d2").agg(F.min("text").alias("text"))
    read = wanted.join(spots, ["d1", "d2"]).select("d1", "d2", "text", "spots")
    return read.mapInArrow(_verified(templates), "d1 long, d2 long, label string, agreement double, first long, last long")


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """License phrases and quoted license texts of every document.

    Returns one row for each row of `docs`: doc_id, n_words, n_base (all places of phrases), first_word and last_word (their
    smallest and largest start, else null), base_labels, labels (those of quoted templates too; both sorted and
    comma-joined, empty without any) and score: the best agreement with a template, at least a half where there is a phrase, else 0.
    A null text is empty. Rows that repeat an id are rows of their own, a null id stays null, other columns are not read, and
    an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    texts = _digested(docs, id_col, text_col)
    counted = texts.select("doc_id", "d1", "d2", "text").mapInArrow(
        _counted(phrases), "doc_id long, d1 long, d2 long, n_words long, n_base long, first_word long, last_word long, base array<string>"
    )
    spans = stored(license_spans(texts, templates))
    found = spans.groupBy("d1", "d2").agg(F.collect_set("label").alias("more"), F.max("agreement").alias("best"))
    both = counted.join(stored(found), ["d1", "d2"], "left")
    joined = lambda names: F.array_join(F.array_sort(names), ",")
    phrase = F.when(F.size("base") > 0, 0.5).otherwise(0.0)
    none = F.array().cast("array<string>")
    return both.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined(F.col("base")).alias("base_labels"),
        joined(F.array_union("base", F.coalesce("more", none))).alias("labels"),
        F.greatest(phrase, F.coalesce("best", F.lit(0.0))).alias("score"),
    )
