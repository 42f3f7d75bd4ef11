"""SimHash near-duplicates: fingerprints, a trie self-join, and components of the links.

Fingerprint: words are runs without ASCII white space, A-Z lowered; shingles are runs of
four words (fewer words: all of them), repeats included; each is hashed with XXH64 (seed 42)
and a bit is set if more than half of the hashes have it. Without words it is zero.

Join: equal fingerprints fold into one row first. Two fingerprints within four bits agree on
at least two of six blocks of 10 or 11 bits, so each goes to the 15 buckets of its block
pairs. In a bucket the fingerprints form a binary trie, with the shared blocks on top. Pairs
of trie nodes descend together, add up the bits in which they differ, and are dropped as
soon as these exceed the budget or both nodes lie wholly in one component; pairs of single
fingerprints are compared in full. All buckets of a partition descend at once in numpy.

Scale: a bucket has 21 or 22 fixed bits, so random fingerprints hardly meet. A bucket emits
no pair lists but a forest: each fingerprint once, with the least one of its local component.
Clusters of near copies soon become one component, after which their node pairs fall away. A
bucket of over ``BUCKET_ROWS`` fingerprints is cut into parts by a hash, and each pair of parts
is a task of its own, so that a task's size is bounded however large a cluster is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.batches import raw, text_slices
from ledgerline.llm.components import components
from ledgerline.llm.shipping import ship_package
from ledgerline.sinks.files import Stage

SHINGLE, SEED, BUDGET, BITS = 4, 42, 4, 64
#: Bit ranges of the six blocks, from the lowest bit; pairs of them make the buckets.
BLOCKS = [(0, 10), (10, 21), (21, 32), (32, 43), (43, 54), (54, 64)]
PAIRS = list(combinations(range(len(BLOCKS)), 2))
#: Bits that any two blocks have at least: the trie below them is descended.
FIXED = 20
#: Node pairs that descend at a time, and pair cells compared in full at a time.
FRONTIER, CELLS = 1 << 18, 1 << 21
#: Fingerprints of a bucket, and of each part of a larger one.
BUCKET_ROWS = 1 << 15
#: Rows of whole buckets that descend together.
TOGETHER = 1 << 18
#: Node pairs of at most so many fingerprint pairs are compared in full at once.
LEAF_CELLS = 16
ALL = np.uint64(2**64 - 1)


def fingerprint_of(text: bytes, size: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: ASCII white space and ASCII case only
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    last = min(size, len(words)) - 1
    stops = (ends[last:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


@F.arrow_udf(T.LongType())
def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Fingerprint of each text as a signed 64-bit integer (NULL: zero)."""
    for texts in text_slices(batches):
        yield pa.array(np.array([fingerprint_of(t) for t in raw(texts)], np.uint64).view(np.int64))


def arranged(values: np.ndarray, pair: int) -> np.ndarray:
    """The bits of the pair's blocks moved to the top, the others below in their order."""
    first = PAIRS[pair]
    order = [*first, *(b for b in range(len(BLOCKS)) if b not in first)]
    out, at = np.zeros(len(values), np.uint64), BITS
    for low, high in (BLOCKS[b] for b in order):
        at -= high - low
        mask = np.uint64((1 << (high - low)) - 1)
        out |= ((values >> np.uint64(low)) & mask) << np.uint64(at)
    return out


class Forest:
    """Components of positions 0..n-1 under batches of links, as flat arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                break
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(root, shorter := root[root]):
                root = shorter
        self.root = root


class TrieJoin:
    """Self-join of sorted ``values`` (bits arranged, distinct per bucket) from ``depth`` on.

    A trie node is a range of ``values`` with one prefix; its children are found by binary
    search for the prefix that has the next bit set."""

    def __init__(self, values: np.ndarray, budget: int):
        self.values, self.budget = values, budget
        self.forest = Forest(len(values))
        self.renumber()

    def renumber(self) -> None:
        root = self.forest.root
        self.changes = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])]) if len(root) else root

    def one_component(self, pairs: np.ndarray) -> np.ndarray:
        a, a_end, b, b_end = pairs[:, 0], pairs[:, 1], pairs[:, 2], pairs[:, 3]
        same = self.forest.root[a] == self.forest.root[b]
        return same & (self.changes[a_end - 1] == self.changes[a]) & (self.changes[b_end - 1] == self.changes[b])

    def run(self, nodes: np.ndarray, depth: int) -> None:
        """Join the fingerprints within each of ``nodes`` (start, end)."""
        nodes = nodes[nodes[:, 1] - nodes[:, 0] > 1]
        # Rows: start and end of both nodes, differing bits so far.
        own = np.concatenate([nodes, nodes, np.zeros((len(nodes), 1), np.int64)], axis=1)
        # Depth first: of the pairs made last some descend together.
        waiting = [(depth, own[at : at + FRONTIER]) for at in range(0, len(own), FRONTIER)]
        while waiting:
            depth, pairs = waiting.pop()
            pairs = pairs[~self.one_component(pairs)]
            cells = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
            small = (cells <= LEAF_CELLS) | (depth == BITS)
            self.compare(pairs[small])
            if small.all():
                continue
            pairs = self.children(pairs[~small], depth)
            # Nearest pairs last, so that they are taken first and merge components early.
            pairs = pairs[np.argsort(-pairs[:, 4], kind="stable")]
            waiting.extend((depth + 1, pairs[at : at + FRONTIER]) for at in range(0, len(pairs), FRONTIER))

    def children(self, pairs: np.ndarray, depth: int) -> np.ndarray:
        a, a_end, b, b_end, differ = pairs.T
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        middle = [self.split(s, e, bit) for s, e in ((a, a_end), (b, b_end))]
        own = a == b
        halves = [((a, middle[0]), (middle[0], a_end)), ((b, middle[1]), (middle[1], b_end))]
        out = []
        for i in (0, 1):
            for j in (0, 1):
                (s, e), (t, f) = halves[0][i], halves[1][j]
                kept = (s < e) & (t < f) & (differ + (i != j) <= self.budget)
                if i > j:
                    kept &= ~own  # of a node with itself only one order
                kept &= ~((s == t) & (e - s < 2))
                out.append(np.stack([s, e, t, f, differ + (i != j)], axis=1)[kept])
        return np.concatenate(out)

    def split(self, start: np.ndarray, end: np.ndarray, bit: np.uint64) -> np.ndarray:
        """First position of the node whose next bit is set (``end`` if none is)."""
        low, high = start.copy(), end.copy()
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high) // 2
            is_set = (self.values[np.minimum(middle, len(self.values) - 1)] & bit) != 0
            high = np.where(open_ & is_set, middle, high)
            low = np.where(open_ & ~is_set, middle + 1, low)

    def compare(self, pairs: np.ndarray) -> None:
        """Full comparison of all fingerprint pairs of node pairs, some cells at a time."""
        if not len(pairs):
            return
        width = pairs[:, 3] - pairs[:, 2]
        cells = (pairs[:, 1] - pairs[:, 0]) * width
        total = np.cumsum(cells)
        start = 0
        while start < len(pairs):
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + CELLS, side="right")))
            n = cells[start:end]
            row = np.repeat(np.arange(start, end), n)
            cell = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            a = pairs[row, 0] + cell // width[row]
            b = pairs[row, 2] + cell % width[row]
            near = (a != b) & (np.bitwise_count(self.values[a] ^ self.values[b]) <= self.budget)
            if near.any():
                self.forest.link(a[near], b[near])
            start = end
        self.renumber()


def links_in(values: np.ndarray, pairs: np.ndarray, parts: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints that lie in buckets of their block ``pairs`` and ``parts``: each
    member and the least position of its local component. All buckets descend together."""
    keys = np.zeros(len(values), np.uint64)
    for pair in np.unique(pairs):
        keys[pairs == pair] = arranged(values[pairs == pair], int(pair))
    order = np.lexsort((keys, parts, pairs))
    keys, values, pairs, parts = keys[order], values[order], pairs[order], parts[order]
    prefix = keys >> np.uint64(BITS - FIXED)
    changes = (prefix[1:] != prefix[:-1]) | (pairs[1:] != pairs[:-1]) | (parts[1:] != parts[:-1])
    edges = np.flatnonzero(np.concatenate([[True], changes, [True]]))
    join = TrieJoin(keys, budget)
    join.run(np.stack([edges[:-1], edges[1:]], axis=1), FIXED)
    root = join.forest.root
    linked = np.flatnonzero(root != np.arange(len(root)))
    return values[linked], values[root[linked]]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints (``fp``, ``pair``, ``key``, ``part``), bucket after bucket, to links ``a``, ``b``.

    Whole buckets descend together once ``TOGETHER`` rows are held, so a task holds those rows
    and one bucket, however many buckets its partition has."""
    held = np.zeros((4, 0), np.int64)

    def linked(rows: np.ndarray) -> pa.RecordBatch:
        a, b = links_in(rows[0].view(np.uint64), rows[1], rows[3])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for piece in _pieces(batches):
        held = np.concatenate([held, piece], axis=1)
        if held.shape[1] > TOGETHER:
            changes = np.flatnonzero((held[1:, 1:] != held[1:, :-1]).any(axis=0))
            if len(changes):
                end = int(changes[-1]) + 1
                yield linked(np.ascontiguousarray(held[:, :end]))
                held = held[:, end:].copy()
    if held.shape[1]:
        yield linked(held)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The columns of about ``TOGETHER`` rows at a time."""
    some, n = [], 0
    for batch in batches:
        some.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("fp", "pair", "key", "part")]))
        n += batch.num_rows
        if n >= TOGETHER:
            yield np.concatenate(some, axis=1)
            some, n = [], 0
    if some:
        yield np.concatenate(some, axis=1)


def fingerprint_links(fingerprints: DataFrame, stage: Stage, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a``, ``b`` among distinct ``fp``: whatever lies within the budget is connected."""
    def key(pair: int):
        parts = [F.shiftrightunsigned("fp", BLOCKS[b][0]).bitwiseAND(F.lit((1 << (BLOCKS[b][1] - BLOCKS[b][0])) - 1)) for b in PAIRS[pair]]
        return F.struct(F.lit(pair).cast("tinyint").alias("pair"), (F.shiftleft(parts[0], 11) + parts[1]).cast("int").alias("key"))

    ship_package(fingerprints.sparkSession)
    buckets = fingerprints.select("fp", F.explode(F.array(*[key(p) for p in range(len(PAIRS))])).alias("k")).select("fp", "k.*")
    counts = buckets.groupBy("pair", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows)
    large = stage.save(counts.select("pair", "key", F.ceil(F.col("n") / bucket_rows).alias("n_parts")), "large-buckets")
    own = F.pmod(F.xxhash64("fp"), F.col("n_parts"))
    meetings = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1),
        lambda other: F.least(own, other) * F.col("n_parts") + F.greatest(own, other),
    )
    parts = F.when(F.col("n_parts").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(meetings)
    dealt = buckets.join(large, ["pair", "key"], "left").select("fp", "pair", "key", F.explode(parts).alias("part"))
    dealt = dealt.repartition("pair", "key", "part").sortWithinPartitions("pair", "key", "part")
    return dealt.select("fp", "pair", "key", "part").mapInArrow(_joined, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, stage: Stage, text: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (signed) and ``component_id`` for each row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, its own included (NULL only if
    no row of the component has one). Links join fingerprints within four bits. NULL and
    empty texts have fingerprint zero and link like any other. Repeated rows stay rows."""
    ship_package(docs.sparkSession)
    prints = stage.save(docs.select("doc_id", fingerprint(F.col(text)).alias("fp")), "fingerprints")
    return stage_components(prints, stage)


def stage_components(prints: DataFrame, stage: Stage) -> DataFrame:
    """Components of ``prints`` (doc_id, fp), which are staged already."""
    distinct = stage.save(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    linked = with_roots(distinct, stage).select("fp", "first_id", "root")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = stage.save(linked.join(least, "root").select("fp", "component_id"), "members")
    return prints.join(member, "fp").select("doc_id", "fp", "component_id")


def with_roots(distinct: DataFrame, stage: Stage) -> DataFrame:
    """``distinct`` (one row per ``fp``) with ``root``, the least fingerprint it reaches."""
    roots = stage.save(components(fingerprint_links(distinct.select("fp"), stage), stage), "roots")
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))


def without_near_duplicates(docs: DataFrame, stage: Stage) -> DataFrame:
    """One row of each component of ``docs``: that of its smallest doc_id (of several texts
    with that id the one whose hash is least; of exact repeats one). NULL ids come last."""
    ship_package(docs.sparkSession)
    # A row goes by a 128-bit hash of its id and text, so the texts move only once.
    row_key = [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("_k2")]
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_k1", "_k2")
    prints = docs.select("doc_id", *row_key, fingerprint(F.col("text")).alias("fp"))
    distinct = stage.save(prints.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    firsts = with_roots(distinct, stage).groupBy("root").agg(F.min("first").alias("first"))
    kept = firsts.select("first._k1", "first._k2")
    # Exact repeats of a row fold in the map tasks, so that no one task gets all of them.
    rows = docs.select(F.struct("*").alias("_row"), *row_key).dropDuplicates(["_k1", "_k2"])
    return rows.join(kept, ["_k1", "_k2"], "left_semi").select("_row.*")
