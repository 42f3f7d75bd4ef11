"""Source divergence audit: how far the word use of a language's sources lies apart.

Every language keeps the terms that at least ``MIN_DOCS`` of its documents hold. A group (a
language's source) and the language itself give each kept term a smoothed share in billionths,
``1 + (1000000000 * (count + 5)) div (N + 5 * V)``. Two sources lie apart by the sum of the
differences of these shares over all V terms.

That sum is a sparse matrix product row by row, after Gustavson. The rows are groups, their
entries the terms that occur in them. Each row scatters its terms through the term-major index
into one dense accumulator with a cell per peer, so no pair of postings is ever a row of
a table. Entries that a group lacks are not zero but its baseline ``1 + (5000000000) div (N +
5 * V)``: every pair begins as if no term occurred in either, terms of one side are corrected
by sums over sorted shares, and the scatter corrects the terms of both. All numbers are
integers.

Scale: documents become counts in the tasks that read them, and counts add up before each
shuffle. Terms are dealt by a hash into slices, and sources by a hash into blocks; a task has the rows
of one block and the index of another for one slice, so its memory is bounded whatever the
number of terms and sources, and what it returns is one number per pair of groups.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.batches import raw, slices
from ledgerline.llm.shipping import ship_package
from ledgerline.sinks.files import Stage

MIN_DOCS, TOP_TERMS = 30, 50
#: Terms: runs of ASCII letters (lowered) and non-ASCII characters.
TERMS = re.compile(rb"[a-z\x80-\xff]+")
#: Counts that a task holds before it passes them on.
HELD = 400_000
#: Sources in a block, and entries that a slice has on average in a block.
BLOCK_SOURCES, SLICE_ENTRIES = 256, 20_000
#: Index entries that a row meets at a time.
MET = 1 << 20
TALLY = "lang string, source string, term string, n bigint, n_docs bigint"
_SCALE = "cast(1000000000 as decimal(20,0))"


def tally(docs: DataFrame) -> DataFrame:
    """Partial counts: occurrences and documents of a term in a group (NULL term: the group
    itself, with its documents)."""
    ship_package(docs.sparkSession)

    def rows(counts: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, n_docs) in counts.items():
            terms = pa.array([*n, None], pa.binary()).cast(pa.string())
            size = len(n) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), size), pa.repeat(pa.scalar(source, pa.string()), size), terms,
                 pa.array([*n.values(), 0], pa.int64()), pa.array([*map(n_docs.__getitem__, n), n_docs[None]], pa.int64())],
                ["lang", "source", "term", "n", "n_docs"],
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            groups, at = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())), 0
            for texts in slices(batch.column("text")):
                for text in raw(texts):
                    n, n_docs = counts.setdefault(groups[at], (Counter(), Counter()))
                    before = len(n)
                    words = TERMS.findall(text.lower())
                    n.update(words)
                    n_docs.update({*words, None})
                    held += len(n) - before
                    at += 1
                if held > HELD:
                    yield from rows(counts)
                    counts, held = {}, 0
        yield from rows(counts)

    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*columns, "text").mapInArrow(counted, TALLY)


def _kept(docs: DataFrame, min_docs: int) -> DataFrame:
    """Counts of the kept terms by group, with those of the language (``lang_n``); ``first``
    marks one row of each term. Rows of groups have a NULL term."""
    counts = tally(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = counts.withColumns({"lang_n": F.sum("n").over(of_term), "_docs": F.sum("n_docs").over(of_term), "_least": F.min("source").over(of_term)})
    kept = counts.where(F.col("term").isNull() | (F.col("_docs") >= min_docs))
    return kept.select("lang", "source", "term", "n", "lang_n", (F.col("_least") == F.col("source")).alias("first"))


def _groups(kept: DataFrame) -> DataFrame:
    """One row per group: ``total`` (N) of the group and ``lang_total`` of its language,
    ``n_terms`` (V), and numbers of sources and entries of the language."""
    is_term = F.col("term").isNotNull()
    groups = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if(is_term & F.col("first")).alias("_terms"), F.count_if(is_term).alias("_entries")
    )
    langs = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.sum("_terms").alias("n_terms"), F.sum("_entries").alias("n_entries"), F.count("*").alias("n_sources")
    )
    return groups.select("lang", "source", "total").join(langs, "lang")


def _share(count: str, total: str) -> F.Column:
    """The smoothed share, exact: products are decimals."""
    return F.expr(f"1 + ({_SCALE} * ({count} + 5)) div ({total} + 5 * n_terms)")


class Index:
    """Entries of some sources, term-major: the sources that hold a term lie together."""

    def __init__(self, term: np.ndarray, owner: np.ndarray, share: np.ndarray, n_terms: int):
        order = np.argsort(term, kind="stable")
        self.owner, self.share = owner[order], share[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))])

    def met_by(self, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of entries of ``terms`` and of the term each belongs to, some at a time."""
        lengths = self.starts[terms + 1] - self.starts[terms]
        parts = np.cumsum(lengths) // MET
        for own in np.split(np.arange(len(terms)), np.flatnonzero(np.diff(parts)) + 1):
            n = lengths[own]
            which = np.repeat(own, n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(self.starts[terms[own]], n) + inside, which


def _one_sided(owner: np.ndarray, share: np.ndarray, base: np.ndarray, others: np.ndarray) -> np.ndarray:
    """By source and other baseline: sum over the source's terms of |share - other| less
    |base - other|. Sorted shares and their running sums answer all others at once."""
    out = np.zeros((len(base), len(others)), np.int64)
    order = np.lexsort((share, owner))
    owner, share = owner[order], share[order]
    edges = np.searchsorted(owner, np.arange(len(base) + 1))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        own = share[a:b]
        sums = np.concatenate([[0], np.cumsum(own)])
        below = np.searchsorted(own, others)
        above = sums[-1] - sums[below] - (b - a - below) * others
        out[i] = above + below * others - sums[below] - (b - a) * np.abs(base[i] - others)
    return out


def accumulate(rows: dict[str, np.ndarray], peers: dict[str, np.ndarray], n_terms: int) -> np.ndarray:
    """Row by row: part of the sums that the terms given here add, by row and peer.

    Both sides have ``base`` (baseline by source) and entries ``term``, ``owner``, ``share``."""
    index = Index(peers["term"], peers["owner"], peers["share"], n_terms)
    out = _one_sided(rows["owner"], rows["share"], rows["base"], peers["base"])
    out += _one_sided(peers["owner"], peers["share"], peers["base"], rows["base"]).T
    order = np.argsort(rows["owner"], kind="stable")
    edges = np.searchsorted(rows["owner"][order], np.arange(len(rows["base"]) + 1))
    for i, base in enumerate(rows["base"]):
        own = order[edges[i] : edges[i + 1]]
        accumulator = np.zeros(len(peers["base"]), np.int64)
        for at, which in index.met_by(rows["term"][own]):
            mine, peer = rows["share"][own][which], index.owner[at]
            theirs, peer_base = index.share[at], peers["base"][peer]
            both = np.abs(mine - theirs) - np.abs(mine - peer_base) - np.abs(base - theirs) + np.abs(base - peer_base)
            np.add.at(accumulator, peer, both)
        out[i] += accumulator
    return out


def _side(table: pa.Table, codes: np.ndarray, inside: np.ndarray) -> tuple[dict[str, np.ndarray], list[str]]:
    """Arrays and sources of the rows ``inside``. Rows without a term carry the baselines."""
    header = table.column("term").is_null().to_numpy(zero_copy_only=False) & inside
    entry = np.flatnonzero(inside & ~header)
    share = table.column("share").to_numpy()
    names = table.column("source").combine_chunks()
    sources = names.filter(pa.array(header))
    owner = pc.index_in(names.take(pa.array(entry)), value_set=sources).to_numpy(zero_copy_only=False).astype(np.int64)
    return {"base": share[header], "term": codes[entry], "owner": owner, "share": share[entry]}, sources.to_pylist()


def _summed(table: pa.Table) -> pa.Table:
    """One slice of the rows of one block and of the index of another (or the same)."""
    encoded = table.column("term").combine_chunks().dictionary_encode()
    codes = pc.fill_null(encoded.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block, row_block, peer_block = (table.column(c).to_numpy() for c in ("block", "row_block", "peer_block"))
    rows, sources = _side(table, codes, block == row_block)
    peers, others = _side(table, codes, block == peer_block)
    sums = accumulate(rows, peers, len(encoded.dictionary))
    # Only the first slice of a language has its V (others 0), so each pair begins once.
    sums += table.column("n_terms").to_numpy().max() * np.abs(rows["base"][:, None] - peers["base"][None, :])
    n, m = sums.shape
    return pa.table({
        "lang": pa.repeat(table.column("lang")[0], n * m), "source": pa.array(np.repeat(np.array(sources, object), m), pa.string()),
        "item": pa.array(np.tile(np.array(others, object), n), pa.string()), "value": pa.array(sums.ravel()),
    })


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` for every two sources of a language."""
    n_blocks = F.ceil(F.col("n_sources") / BLOCK_SOURCES).cast("int")
    # A slice returns a number per pair of its sources, so it gets several times as many entries.
    size = F.greatest(F.lit(SLICE_ENTRIES), 4 * F.pow(F.least("n_sources", F.lit(BLOCK_SOURCES)), F.lit(2)))
    n_slices = F.greatest(F.lit(1), F.ceil(F.col("n_entries") / (size * n_blocks))).cast("int")
    block = F.pmod(F.xxhash64("source"), n_blocks).cast("int")
    base = F.when(F.col("n_terms") > 0, F.expr(f"1 + ({_SCALE} * 5) div nullif(total + 5 * n_terms, 0)")).otherwise(0)
    # Every slice has all groups: their baselines count even where a group has no term.
    headers = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), base.alias("share"), block.alias("block"), n_blocks.alias("n_blocks"),
        F.explode(F.sequence(F.lit(0), n_slices - 1)).alias("slice"), F.col("n_terms"),
    ).withColumn("n_terms", F.when(F.col("slice") == 0, F.col("n_terms")).otherwise(0))
    held = entries.select(
        "lang", "source", "term", "share", block.alias("block"), n_blocks.alias("n_blocks"),
        F.pmod(F.xxhash64("term"), n_slices).cast("int").alias("slice"), F.lit(0).cast("bigint").alias("n_terms"),
    )
    # A row of block b meets the peers of every block, and as a peer the rows of every block.
    blocks = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    meetings = F.concat(
        F.transform(blocks, lambda j: F.struct(F.col("block").alias("row_block"), j.alias("peer_block"))),
        F.transform(F.filter(blocks, lambda i: i != F.col("block")), lambda i: F.struct(i.alias("row_block"), F.col("block").alias("peer_block"))),
    )
    dealt = headers.unionByName(held).select("*", F.inline(meetings)).drop("n_blocks")
    parts = dealt.groupBy("lang", "slice", "row_block", "peer_block").applyInArrow(_summed, "lang string, source string, item string, value bigint")
    return parts.where("source <> item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, stage: Stage, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` (from 1).

    Part ``pair``: each other source of the language, by how far it lies apart. Part ``term``:
    the ``top`` terms of which the source has a greater share than its language, by the
    difference. Equal values go by the item's bytes.

    NULL in ``lang`` and ``source`` (of any type) is the empty string; NULL and empty texts
    have no terms, but their groups are there. Each row is a document, repeated ones too. Long texts
    are read whole. A language without kept terms has pairs of value 0; a lone source has no
    pairs; an empty table gives no rows. Other columns are not looked at."""
    ship_package(docs.sparkSession)
    kept = stage.save(_kept(docs, min_docs), "counts")
    groups = stage.save(_groups(kept), "groups")
    entries = kept.where("term IS NOT NULL").join(groups, ["lang", "source"])
    entries = entries.withColumns({"share": _share("n", "total"), "lang_share": _share("lang_n", "lang_total")})
    excess = entries.where("n > 0 AND share > lang_share").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("share") - F.col("lang_share")).alias("value"))
    pairs = _pairs(entries, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).union(excess.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
