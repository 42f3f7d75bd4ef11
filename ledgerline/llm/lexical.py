"""Ranked lexical search with the Best Position Algorithm.

Terms are runs of digits, ASCII letters (lowered) and non-ASCII characters. Each query term
has an impact list: the documents that hold it, highest impact first. Sorted access reads all
lists of a query in parallel; every document that turns up is looked up in all its lists
at once (direct access), which gives its exact score and its position in each of them. A
list's best position is the end of the unbroken run of seen positions from its top; whoever
opens it is past the last row read, because direct accesses have seen rows further down. No
unseen document can score more than the sum of the impacts that follow the best positions, so
reading stops once that sum lies strictly below the k-th best score (an equal one could still
win its tie by doc_id).

Scale: the first pass cuts every text once and stages, per document, the query terms it holds.
Counts over all documents (N, L, and df of the query terms) come from that stage. In the second
pass tasks read the stage in shards of bounded size, build the shard's impact lists as flat
arrays, and search them with all queries; the k-th score carries over from shard to shard. Only
each task's k best per query are shuffled. Queries come in blocks of bounded text, so what is
broadcast is bounded too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.batches import lists, raw, text_slices
from ledgerline.llm.shipping import ship_package
from ledgerline.sinks.files import Stage

BEST = 10
#: Bytes of query text in one block.
BLOCK_BYTES = 4 << 20
#: Postings of a shard (a document is never split).
SHARD_POSTINGS = 1_500_000
#: Rows of each list in the first round of sorted access; every round reads twice as many.
FIRST_ROWS = 64
TERMS = re.compile(rb"[0-9a-z\x80-\xff]+")
FOUND = "query bigint, doc_id bigint, score bigint"


@dataclass(frozen=True)
class Query:
    number: int
    #: Term numbers, and how often the query has each.
    terms: np.ndarray
    times: np.ndarray


class QueryBlock:
    """The vocabulary of some queries, and the queries in its numbers."""

    def __init__(self, texts: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.queries = []
        for number, text in texts:
            counts = Counter(self.vocabulary.setdefault(t, len(self.vocabulary)) for t in TERMS.findall(text.lower()))
            if counts:
                self.queries.append(Query(number, np.array([*counts], np.int64), np.array([*counts.values()], np.int64)))


def _held(block) -> Column:
    """Column function: number of terms of a text, and the block's terms in it with their counts."""

    @F.arrow_udf("struct<n:bigint, terms:array<int>, counts:array<int>>")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary: dict[bytes, int] = block.value.vocabulary
        known = vocabulary.keys()
        for texts in text_slices(batches):
            n, terms, counts, sizes = [], [], [], []
            for text in raw(texts):
                words = TERMS.findall(text.lower())
                own = Counter(words)
                shared = own.keys() & known
                n.append(len(words))
                sizes.append(len(shared))
                terms += map(vocabulary.__getitem__, shared)
                counts += map(own.__getitem__, shared)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), lists(np.array(terms, np.int32), sizes), lists(np.array(counts, np.int32), sizes)], ["n", "terms", "counts"]
            )

    return held


class Shard:
    """Impact lists of some documents. ``doc``, ``impact`` and ``rank`` (position in the impact
    list) lie by term and document; ``by_impact`` lists them by term and falling impact."""

    def __init__(self, doc_ids: list[int | None], length_class: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray):
        self.doc_ids, n = doc_ids, len(doc_ids)
        owner = np.repeat(np.arange(n), sizes)
        impact = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * length_class[owner]))
        scoring = impact > 0
        owner, terms, impact = owner[scoring], terms[scoring], impact[scoring]
        by_term = np.lexsort((owner, terms))
        self.doc, self.impact = owner[by_term], impact[by_term]
        self.edges = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(weights)))])
        terms = terms[by_term]
        self.by_impact = np.lexsort((self.doc, -self.impact, terms))
        self.rank = np.empty(len(terms), np.int64)
        self.rank[self.by_impact] = np.arange(len(terms)) - self.edges[terms]

    def search(self, query: Query, k: int, best: list[tuple[int, bool, int, int]], first_rows: int = FIRST_ROWS) -> int:
        """Put the shard's best documents into ``best`` (sorted, at most ``k``): tuples of
        negative score, whether there is an id, id, and a running number. Returns how many
        rows sorted access has read from each list at most."""
        runs = [(int(self.edges[t]), int(self.edges[t + 1]), int(c)) for t, c in zip(query.terms, query.times)]
        runs = [r for r in runs if r[1] > r[0]]
        seen_docs = np.zeros(len(self.doc_ids), bool)
        seen = [np.zeros(b - a, bool) for a, b, _ in runs]
        best_position = [0] * len(runs)
        read, step = 0, first_rows
        while runs:
            rows = np.concatenate([self.by_impact[a + read : min(b, a + read + step)] for a, b, _ in runs])
            read, step = read + step, 2 * step
            fresh = self.doc[rows]
            fresh = np.unique(fresh[~seen_docs[fresh]])
            seen_docs[fresh] = True
            scores = np.zeros(len(fresh), np.int64)
            limit = 0
            for i, (a, b, times) in enumerate(runs):
                at = a + np.searchsorted(self.doc[a:b], fresh)
                here = at < b
                here[here] = self.doc[at[here]] == fresh[here]
                scores[here] += times * self.impact[at[here]]
                seen[i][self.rank[at[here]]] = True
                rest = seen[i][best_position[i] :]
                best_position[i] += len(rest) if rest.all() else int(rest.argmin())
                if best_position[i] < b - a:
                    limit += times * int(self.impact[self.by_impact[a + best_position[i]]])
            self._keep(fresh, scores, k, best)
            if limit == 0 or (len(best) == k and limit < -best[-1][0]):
                break
        return read

    def _keep(self, docs: np.ndarray, scores: np.ndarray, k: int, best: list[tuple]) -> None:
        if len(best) == k:
            good = scores >= -best[-1][0]
            docs, scores = docs[good], scores[good]
        if len(docs) > k:  # all that tie with the k-th stay
            good = scores >= np.partition(scores, -k)[-k]
            docs, scores = docs[good], scores[good]
        ids = [self.doc_ids[d] for d in docs.tolist()]
        best += [(-s, i is not None, i or 0, len(best) + j) for j, (s, i) in enumerate(zip(scores.tolist(), ids))]
        best.sort()
        del best[k:]


def shards(batches: Iterator[pa.RecordBatch], postings: int) -> Iterator[pa.Table]:
    """Consecutive documents with at most ``postings`` terms in all (or a single document)."""
    held: list[pa.RecordBatch] = []
    n_held = 0
    for batch in batches:
        sizes = np.diff(batch.column("terms").offsets.to_numpy())
        parts = np.cumsum(sizes, dtype=np.int64) // postings
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(sizes)]
        for start, stop in zip(cuts, cuts[1:]):
            n = int(sizes[start:stop].sum())
            if held and n_held + n > postings:
                yield pa.Table.from_batches(held)
                held, n_held = [], 0
            held.append(batch.slice(start, stop - start))
            n_held += n
    if held:
        yield pa.Table.from_batches(held)


def _searcher(block, weights, k: int, postings: int):
    """Task function: rows of the stage to the task's best documents per query."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: list[Query] = block.value.queries
        best: list[list[tuple]] = [[] for _ in queries]
        for table in shards(batches, postings):
            terms, counts = (table.column(c).combine_chunks() for c in ("terms", "counts"))
            shard = Shard(
                table.column("doc_id").to_pylist(), table.column("length_class").to_numpy(), np.diff(terms.offsets.to_numpy()),
                terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64), weights.value,
            )
            for query, own in zip(queries, best):
                shard.search(query, k, own)
        rows = [(q.number, i if has else None, -s) for q, own in zip(queries, best) for s, has, i, _ in own]
        columns = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return searched


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def query_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """Numbered texts (query, text) in blocks of bounded size, one at a time on the driver."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-2 * total // block_bytes) if total > block_bytes else 1
    for block in range(n_blocks):
        part = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == block)
        yield [(r["query"], r["text"].encode()) for r in part.toLocalIterator()]


def _best_of_block(docs: DataFrame, block: QueryBlock, stage: Stage, name: str, k: int, postings: int) -> DataFrame:
    """``query``, ``doc_id``, ``score``, ``rank`` of the best ``k`` documents of each query."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(block)
    cut = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _held(shared)(F.col("text")).alias("held"))
    held = stage.save(cut.select("doc_id", "held.*").where("n > 0"), name)
    n_docs, n_terms = held.agg(F.count("*"), F.sum("n")).first()
    weights = np.zeros(len(block.vocabulary), np.int64)
    # One number per term of the block comes to the driver.
    for term, df in held.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = weight(df, n_docs)
    length_class = F.expr(f"25 + (cast(75 as decimal(20,0)) * n * {n_docs}) div {max(1, n_terms or 0)}")
    rows = held.where(F.size("terms") > 0).select("doc_id", length_class.alias("length_class"), "terms", "counts")
    found = rows.mapInArrow(_searcher(shared, spark.sparkContext.broadcast(weights), k, postings), FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, stage: Stage, k: int = BEST, block_bytes: int = BLOCK_BYTES, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: for each row of ``items`` (item_id,
    text) its ``k`` best rows of ``docs`` (doc_id, text), those that score above 0.

    Equal scores go by doc_id, NULL first. Repeated documents are documents of their own, and
    repeated items are answered once each. NULL texts, and texts without a term, neither
    count as documents nor find any; terms that no document holds find nothing. Texts of any
    length are read whole. An empty table on either side gives no rows. Other columns are not
    looked at. Ids of documents are integers."""
    ship_package(docs.sparkSession)
    folded = items.where("text IS NOT NULL").groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    numbered = stage.save(folded.withColumn("query", F.monotonically_increasing_id()), "queries")
    found = None
    for i, texts in enumerate(query_blocks(numbered, block_bytes)):
        best = _best_of_block(docs, QueryBlock(texts), stage, f"held-{i}", k, shard_postings)
        found = best if found is None else found.union(best)
    named = found.join(numbered.select("query", "item_id", "copies"), "query")
    rows = named.select("item_id", "rank", "doc_id", "score", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return rows.select("item_id", "rank", "doc_id", "score")
