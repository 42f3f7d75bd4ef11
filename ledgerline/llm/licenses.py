"""License scans by diagonal voting.

Words are runs of digits, ASCII letters (lowered) and all non-ASCII characters. Every run of
k words of every document, as a rolling hash, joins the positions at which the license
templates have that run; the words themselves are compared too, so a vote is never a
collision of hashes. A vote at document word i and template word j lies on the diagonal
i - j. Votes add up per diagonal; diagonals a few words apart (a word put in or left out) are
merged; and a merged place stands if the runs that voted cover enough of the template's words.

Two kinds of templates: a phrase must stand word for word (``share`` 1, no merging), a text
may have words changed, put in or left out. Templates of under four words vote by pairs of
words, others by runs of four.

What moves: words are cut and hashed where the documents lie, runs join the templates there,
and only votes and one row per document are shuffled, by document. The templates are broadcast
up to ``BROADCAST_RUNS`` runs; beyond that Spark shuffles both sides of the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.batches import lists, raw, text_slices
from ledgerline.llm.decontamination import words
from ledgerline.llm.shipping import ship_package

#: Words of a run: for templates of that many words or more, and for shorter ones.
LONG, SHORT = 4, 2
#: Diagonals of a template that lie at most so many words apart are one place.
SLACK = 3
#: Template runs that are broadcast at most (some 100 bytes each).
BROADCAST_RUNS = 100_000
#: Word hashes that a task remembers (results do not depend on it).
REMEMBERED = 200_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Template:
    """``share``: part of the template's words that a place must cover. ``base``: counted
    apart from the others."""

    label: str
    text: str
    share: float = 1.0
    base: bool = False


# Phrases and notices of well-known licenses.
PHRASES = [
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
]
NOTICES = [
    Template("apache-2.0", "apache license version 2 0"),
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("agpl", "gnu affero general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mpl", "mozilla public license"),
    Template("bsd", "bsd license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        0.6,
    ),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        0.6,
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        0.6,
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        0.6,
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        0.6,
    ),
]
TEMPLATES = [*PHRASES, *NOTICES]


class WordHashes(dict):
    """XXH64 of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Signed 64-bit hash of every run of ``size`` words; none if there are fewer."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(size if n > 0 else 0):
        out = (out ^ hashes[i : i + n]) * FACTOR
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def run_length(n_words: int) -> int:
    return LONG if n_words >= LONG else SHORT


def _cut(sizes: Sequence[int]) -> Column:
    """Column function: words of a text, and hashes of its runs of ``sizes[0]`` words, then
    of ``sizes[1]`` words, and so on."""

    @F.arrow_udf("struct<words:array<string>, runs:array<bigint>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = WordHashes()
        for texts in text_slices(batches):
            own = [words(t) for t in raw(texts)]
            runs = []
            for w in own:
                hashes = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
                runs.append(np.concatenate([np.zeros(0, np.int64), *(rolling(hashes, size) for size in sizes)]))
                if len(known) > REMEMBERED:
                    known.clear()
            flat = pa.array([x for w in own for x in w], pa.binary()).cast(pa.string())
            numbers = np.concatenate([np.zeros(0, np.int64), *runs])
            yield pa.StructArray.from_arrays([lists(flat, [len(w) for w in own]), lists(numbers, [len(r) for r in runs])], ["words", "runs"])

    return cut


def _template_runs(docs: DataFrame, templates: Sequence[Template]) -> tuple[DataFrame, int]:
    """One row per run of a template (hash, words, place in the template, the template), and
    the number of rows."""
    rows = []
    for number, template in enumerate(templates):
        own = words(template.text.encode())
        if len(own) < SHORT:
            raise ValueError(f"a template needs {SHORT} words: {template.text!r}")
        size = run_length(len(own))
        hashes = rolling(np.array([xxhash.xxh64_intdigest(w) for w in own], np.uint64), size)
        slack = 0 if template.share >= 1 else SLACK
        kind = (number, template.label, template.base, len(own), size, slack, math.ceil(template.share * len(own)))
        rows += [(int(h), b" ".join(own[i : i + size]).decode(), size, i, kind) for i, h in enumerate(hashes)]
    kind = "struct<number:int,label:string,base:boolean,n_words:int,size:int,slack:int,least:int>"
    table = docs.sparkSession.createDataFrame(rows, f"run bigint, run_words string, run_size int, at int, template {kind}")
    return table, len(rows)


def _votes(docs: DataFrame, templates: Sequence[Template], text: str) -> DataFrame:
    """One row per vote (``template``, ``diagonal``, ``at``) and at least one per document
    (``template`` NULL), with ``row``, ``doc_id`` and ``n_words``."""
    sizes = sorted({run_length(len(words(t.text.encode()))) for t in templates})
    cut = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _cut(sizes)(F.col(text)).alias("cut"))
    cut = cut.select("row", "doc_id", F.col("cut.words").alias("words"), F.col("cut.runs").alias("runs"))
    n_words = F.size("words").cast("bigint")
    runs = cut.select("row", "doc_id", n_words.alias("n_words"), "words", F.posexplode_outer("runs").alias("pos", "run"))
    # Runs of each length follow each other in one array.
    start, size, before = F.col("pos"), F.lit(sizes[0]), F.lit(0).cast("bigint")
    for one, following in zip(sizes, sizes[1:]):
        before = before + F.greatest(F.col("n_words") - (one - 1), F.lit(0))
        start = F.when(F.col("pos") >= before, F.col("pos") - before).otherwise(start)
        size = F.when(F.col("pos") >= before, F.lit(following)).otherwise(size)
    # A run votes only where its length is the template's.
    runs = runs.withColumns({"start": start.cast("bigint"), "size": size})
    own_words = F.array_join(F.slice("words", F.col("start").cast("int") + 1, F.col("size")), " ")
    table, n_runs = _template_runs(docs, templates)
    if n_runs <= BROADCAST_RUNS:  # rows stay where they are, so words are looked up for votes alone
        joined = runs.join(F.broadcast(table), "run", "left")
    else:  # both sides are shuffled: a row takes its own words along, not those of its document
        runs = runs.withColumn("own_words", own_words).drop("words")
        joined, own_words = runs.join(table, "run", "left"), F.col("own_words")
    same = (F.col("size") == F.col("run_size")) & (own_words == F.col("run_words"))
    is_vote = F.col("template").isNotNull() & same
    return joined.where(is_vote | F.col("pos").isNull() | (F.col("pos") == 0)).select(
        "row", "doc_id", "n_words", F.when(is_vote, F.col("template")).alias("template"),
        F.when(is_vote, F.col("start") - F.col("at")).alias("diagonal"), F.when(is_vote, F.col("at")).alias("at"),
    )


def places(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> DataFrame:
    """For each row of ``docs``: ``doc_id``, ``n_words``, ``places`` (where a template stands:
    label, base, first word, word after the last, covered share), by start.

    NULL and empty texts have no words and no places. Repeated rows, and rows without id, are
    rows of their own. Long texts are scanned whole; a document's votes meet in one task.
    Places of different templates may overlap. No templates, and templates of one word, are
    refused; an empty table has no rows. Other columns of ``docs`` are not carried."""
    if not templates:
        raise ValueError("no templates")
    ship_package(docs.sparkSession)
    votes = _votes(docs, templates, text).repartition("row")
    diagonals = votes.groupBy("row", "doc_id", "n_words", "template", "diagonal").agg(F.collect_set("at").alias("at"))
    before = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(before) > F.col("template.slack")
    runs = diagonals.withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("_place", F.sum("_new").over(before))
    words_of = F.flatten(F.transform("at", lambda a: F.sequence(a, a + F.col("template.size") - 1)))
    merged = runs.groupBy("row", "doc_id", "n_words", "template", "_place").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(words_of)))).alias("covered"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("at") + F.col("template.size")).alias("stop"),
    )
    share = F.col("covered") / F.col("template.n_words")
    place = F.struct("start", "stop", "template.label", "template.base", share.alias("share"))
    verified = F.when(F.col("covered") >= F.col("template.least"), place)
    found = merged.groupBy("row", "doc_id", "n_words").agg(F.sort_array(F.collect_list(verified)).alias("places"))
    return found.select("doc_id", "n_words", "places")


def summary(found: DataFrame) -> DataFrame:
    """What a document says in all: ``n_base`` places of base templates, their least and
    largest start (NULL if none), labels of base templates and of all (distinct, sorted,
    comma-joined), and ``score``, the largest share (0 without a place)."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])

    def named(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), named(base).alias("base_labels"), named(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )
