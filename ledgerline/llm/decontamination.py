"""Benchmark decontamination: documents that hold passages of test items.

Words are runs of digits, ASCII letters (lowered) and all non-ASCII characters. A window is
ten consecutive words of an item, or all words of a shorter one. Every task holds the
windows as a hash set over the items' vocabulary: document words become word numbers (none
for words that no item has), each run of window length becomes a rolling hash, and runs
whose hash is known are compared word by word. So each hit is verified, and whole documents
pass once, without a shuffle.

The set is broadcast only as far as its size is bounded: distinct items are taken in blocks
of about ``BLOCK_BYTES`` of text, and documents are scanned once per block, each in a job of
its own whose hits are staged; so a task holds one block, however many there are. Hits of a
text (by a 128-bit hash of it) in several blocks are merged and joined to its rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.batches import lists, raw, text_slices
from ledgerline.llm.names import free_names
from ledgerline.llm.shipping import ship_package
from ledgerline.sinks.files import Stage

WINDOW = 10
#: Bytes of item text in one broadcast block (its hash set takes some 30 times as much).
BLOCK_BYTES = 4 << 20
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SCAN = "struct<n_words:bigint, spans:array<struct<start:bigint,stop:bigint>>, items:array<string>>"


def words(text: bytes) -> list[bytes]:
    """In UTF-8 every byte of a non-ASCII character is a word byte, so bytes do."""
    return WORDS.findall(text.lower())


class Windows:
    """Hash set of the windows of some items, by window length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1 if size else 0):
                owners = found.setdefault(tuple(ids[start : start + size]), set())
                if item_id is not None:
                    owners.add(item_id)
        self.by_size = {}
        for size in sorted({len(k) for k in found}):
            rows = [k for k in found if len(k) == size]
            table = np.array(rows, np.int64).reshape(len(rows), size)
            hashes = self.rolling(table.ravel(), size)[::size]
            order = np.argsort(hashes, kind="stable")
            self.by_size[size] = (hashes[order], table[order], [found[rows[i]] for i in order])

    @staticmethod
    def rolling(ids: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of ``size`` words."""
        n = len(ids) - size + 1
        out = np.zeros(max(n, 0), np.uint64)
        for i in range(size if n > 0 else 0):
            out = (out + (ids[i : i + n].astype(np.uint64) + np.uint64(1))) * FACTOR
            out ^= out >> np.uint64(29)
        return out

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """Start, size and items of every window that occurs in ``ids`` (-1: no item's word)."""
        known = ids >= 0
        for size, (hashes, table, owners) in self.by_size.items():
            if len(ids) < size:
                continue
            inner = np.concatenate([[0], np.cumsum(known)])
            starts = np.flatnonzero(inner[size:] - inner[:-size] == size)
            if not len(starts):
                continue
            runs = ids[starts[:, None] + np.arange(size)]
            own = self.rolling(runs.ravel(), size)[::size]
            low, high = np.searchsorted(hashes, own), np.searchsorted(hashes, own, side="right")
            for at in np.flatnonzero(high > low):
                for row in range(low[at], high[at]):  # more than one only if hashes collide
                    if np.array_equal(table[row], runs[at]):
                        yield int(starts[at]), size, owners[row]

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
        """For each text: number of words, merged hit spans of word positions, item ids."""
        cut = [words(t) for t in texts]
        counts = [len(c) for c in cut]
        spans, items = [], []
        for own in cut:
            ids = np.fromiter(map(self.vocabulary.get, own, repeat(-1)), np.int64, len(own))
            merged: list[tuple[int, int]] = []
            found: set[str] = set()
            for start, size, owners in sorted(self.hits(ids), key=lambda h: h[0]):
                found |= owners
                if merged and start <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(merged[-1][1], start + size))
                else:
                    merged.append((start, start + size))
            spans.append(merged)
            items.append(sorted(found))
        return counts, spans, items


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Distinct items (item_id, text) in blocks of about ``block_bytes`` of text, one block on the
    driver at a time. Items are dealt by a hash into as many blocks as their size asks for."""
    rows = items.where("text IS NOT NULL").select(F.col("item_id").cast("string").alias("id"), "text").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-2 * total // block_bytes) if total > block_bytes else 1
    for block in range(n_blocks):
        part = rows if n_blocks == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block)
        yield [(r["id"], r["text"].encode()) for r in part.toLocalIterator()]


def _scanner(windows) -> Column:
    @F.arrow_udf(SCAN)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own: Windows = windows.value
        for texts in text_slices(batches):
            n_words, spans, items = own.scan(raw(texts))
            flat = np.array([e for s in spans for e in s], np.int64).reshape(-1, 2)
            edges = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "stop"])
            names = pa.array([i for own_items in items for i in own_items], pa.string())
            yield pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), lists(edges, [len(s) for s in spans]), lists(names, [len(i) for i in items])],
                ["n_words", "spans", "items"],
            )

    return scanned


def _merged(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    return F.aggregate(
        spans, F.array().cast("array<struct<start:bigint,stop:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["stop"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def scan(
    docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, stage: Stage | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged word positions that windows cover),
    ``n_hit`` and ``items`` (ids of items with a window in the text, sorted as strings).

    NULL texts have no words; texts of any length are scanned whole. Items that are NULL or
    have no words have no windows; an item without id marks words, but is not named. Repeated
    items count once; repeated rows of ``docs`` all stay. Without documents or items nothing
    is hit. Columns of ``docs`` that have the names of results are replaced, all others stay.
    Items beyond ``block_bytes`` need a stage (one of its own if none is given)."""
    spark = docs.sparkSession
    ship_package(spark)
    own, k1, k2, earlier = free_names(docs, "_scan", "_k1", "_k2", "_earlier")
    text_key = [F.xxhash64(F.col(text)).alias(k1), F.xxhash64(F.lit(1), F.col(text)).alias(k2)]
    blocks = item_blocks(items, block_bytes)
    scanner, staged = None, []
    for i, block in enumerate(blocks):
        if scanner is not None:  # of all blocks but the last, only hits are kept, one row a text
            stage = stage or Stage(spark)
            hits = docs.select(*text_key, scanner(F.col(text)).alias(own)).where(F.size(f"{own}.spans") > 0)
            staged.append(stage.save(hits.groupBy(k1, k2).agg(F.first(own).alias(own)), f"hits-{i}"))
            shared.destroy()
        shared = spark.sparkContext.broadcast(Windows(block, window))
        scanner = _scanner(shared)
    docs = docs.withColumn(own, scanner(F.col(text)))
    spans, found = F.col(f"{own}.spans"), F.col(f"{own}.items")
    if staged:
        hits = staged[0]
        for more in staged[1:]:
            hits = hits.unionAll(more)
        hits = hits.groupBy(k1, k2).agg(F.collect_list(own).alias(earlier))
        docs = docs.withColumns({k1: text_key[0], k2: text_key[1]}).join(hits, [k1, k2], "left")
        before = F.coalesce(earlier, F.array().cast(f"array<{SCAN}>"))
        spans = _merged(F.array_sort(F.concat(F.flatten(F.transform(before, lambda h: h["spans"])), spans)))
        found = F.array_sort(F.array_distinct(F.concat(F.flatten(F.transform(before, lambda h: h["items"])), found)))
    docs = docs.withColumns({"n_words": F.col(f"{own}.n_words"), "spans": spans, "items": found})
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return docs.withColumn("n_hit", n_hit).drop(own, k1, k2, earlier)


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which nothing is hit, with their own columns.

    Rows with a NULL or empty text, and repeated rows, stay; no documents give none."""
    scanned = scan(docs.select(F.struct("*").alias("_row"), F.col("text")), items, **options)
    return scanned.where("n_hit = 0").select("_row.*")


@F.arrow_udf(T.StringType())
def _cut_out(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, cut in zip(texts.to_pylist(), spans.to_pylist()):
        if not cut or text is None:
            out.append(text)
            continue
        data = text.encode()
        places = [m.span() for m in WORDS.finditer(data.lower())]
        kept, at = [], 0
        for span in cut:
            kept.append(data[at : places[span["start"]][0]])
            at = places[span["stop"] - 1][1]
        out.append(b"".join([*kept, data[at:]]).decode())
    return pa.array(out, pa.string())


def without_spans(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """All rows of ``docs``; the words that windows cover are cut out of ``text``.

    NULL and empty texts stay as they are, repeated rows all stay, long texts are cut whole."""
    scanned = scan(docs.select(F.struct("*").alias("_row"), F.col("text")), items, **options)
    cleaned = scanned.withColumn("text", _cut_out("text", "spans"))
    return cleaned.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
