"""Byte-level BPE: encoding and decoding with given ranks (no training).

A text is cut into the matches of a pattern, and each match is merged on its own. Matches
that occur for the first time are encoded together: the byte ids of equally long ones (in
buckets of widths) form the rows of a padded matrix. Each round looks up all neighbouring
pairs of all rows in one hashed table, merges in every row the leftmost pair of least rank
and closes the gap; rows without a pair leave. A match that is a token is that token, as in
the tiktoken library. Rows of over ``WIDEST`` bytes (runs without white space or
punctuation) would cost the square of their length that way, so the same merges are chosen
there with a heap over linked positions.

Each task holds the tables (some MB) and a bounded memory of known matches; texts pass in
slices. Nothing is shuffled.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterator, Sequence
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.batches import lists, offsets, raw, text_slices
from ledgerline.llm.names import free_names
from ledgerline.llm.shipping import ship_package

#: Entries of the younger half of a task's memory (results do not depend on it).
YOUNG = 150_000
#: Places to cut a text before it is matched, and a sign of blanks that are none.
CUTS, ODD_BLANK = re.compile(r" (?=\S)"), re.compile(r" (?!\S)")
WIDEST = 2048
CELLS = 1 << 20
ABSENT = np.int32(2**31 - 1)
IDS_TYPE = "array<int>"


class PairTable:
    """Open-addressing hash table from a pair of ids to the id (and rank) of their union."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.values = np.full(size, ABSENT, np.int32)
        left, at = np.arange(len(keys)), self.slot(keys)
        while len(left):
            # Of the keys that want the same free slot one gets it; the others go on.
            free = self.keys[at] == np.uint64(2**64 - 1)
            self.keys[at[free]] = keys[left[free]]
            placed = self.keys[at] == keys[left]
            self.values[at[placed]] = values[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & int(self.mask)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(29))) & self.mask).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, ABSENT for unknown keys."""
        at = self.slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], ABSENT)
        todo = np.flatnonzero((seen != keys) & (seen != np.uint64(2**64 - 1)))
        while len(todo):
            at[todo] = (at[todo] + 1) & int(self.mask)
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (seen != np.uint64(2**64 - 1))]
        return out


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 token, blank, rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Memory(dict):
    """Known ids in two generations: what was not used for a while is forgotten."""

    def __init__(self):
        super().__init__()
        self.old: dict[str, bytes] = {}

    def missing(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` to learn; known old ones become young again."""
        new = keys.difference(self)
        again = new.intersection(self.old) if self.old else ()
        self.update((k, self.old[k]) for k in again)
        return list(new.difference(again))

    def age(self) -> None:
        if len(self) > YOUNG:
            self.old = dict(self)
            self.clear()


class Codec:
    """Encoder and decoder of one rank table; one per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.cut = ranks, regex.compile(pattern).findall
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.table = PairTable(np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        self.tokens = dict((rank, token) for token, rank in ranks.items())
        # Ids (as bytes) of matches, of first chunks of a text and of chunks after a blank.
        self.known, self.first, self.later = Memory(), Memory(), Memory()

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts in a row, and their number in each."""
        cut = [self._chunks(t) for t in texts]
        first = {c[0] for c in cut}
        later = set().union(*(c[1:] for c in cut))
        self._learn(self.first.missing(first), self.first, "")
        self._learn(self.later.missing(later), self.later, " ")
        joined = [self.first[c[0]] + b"".join(map(self.later.__getitem__, c[1:])) for c in cut]
        for memory in (self.first, self.later, self.known):
            memory.age()
        return np.frombuffer(b"".join(joined), np.int32), [len(j) // 4 for j in joined]

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """The text cut at blanks that start a match: those before something visible. The
        blank itself goes; matches never reach over such a place, so chunks are independent."""
        return text.split(" ") if ODD_BLANK.search(text) is None else CUTS.split(text)

    def _learn(self, chunks: list[str], memory: Memory, blank: str) -> None:
        """Put the ids of new chunks (which follow a ``blank``) into ``memory``."""
        matches = [self.cut(blank + c) for c in chunks]
        self._learn_matches(self.known.missing(set().union(*matches)))
        known = self.known.__getitem__
        memory.update((c, b"".join(map(known, m))) for c, m in zip(chunks, matches))

    def _learn_matches(self, matches: list[str]) -> None:
        data = [m.encode() for m in matches]
        ranks = list(map(self.ranks.get, data))
        self.known.update((m, r.to_bytes(4, "little")) for m, r in zip(matches, ranks) if r is not None)
        rows = [(len(d), d, m) for m, d, r in zip(matches, data, ranks) if r is None]
        rows.sort(key=itemgetter(0))
        start = 0
        while start < len(rows):
            shortest = rows[start][0]
            if shortest > WIDEST:
                self.known[rows[start][2]] = self._merge_long(rows[start][1]).tobytes()
                start += 1
                continue
            width = min(WIDEST, shortest + max(2, shortest // 4))
            end = start
            while end < len(rows) and rows[end][0] <= width and (end - start) * width < CELLS:
                end += 1
            bucket = rows[start:end]
            self.known.update(zip((r[2] for r in bucket), self._merge_rows([r[1] for r in bucket])))
            start = end

    def _merge_rows(self, rows: list[bytes]) -> list[bytes]:
        """One bucket: all rows merge in step. Cells beyond a row's length are padding."""
        lengths = np.array([len(r) for r in rows], np.int64)
        width = int(lengths.max())
        filled = np.arange(width) < lengths[:, None]
        ids = np.zeros((len(rows), width), np.int32)
        ids[filled] = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        ranks = np.full((len(rows), width), ABSENT, np.int32)
        inner = np.arange(width - 1) < lengths[:, None] - 1
        ranks[:, :-1][inner] = self.table.get(pair_keys(ids[:, :-1][inner], ids[:, 1:][inner]))
        done = []
        number = np.arange(len(rows))
        while True:
            best = ranks.argmin(axis=1)  # the first of equal ranks
            row = np.arange(len(best))
            rank = ranks[row, best]
            over = rank == ABSENT
            if over.any():
                own = np.arange(ids.shape[1]) < lengths[over][:, None]
                done.append((number[over], lengths[over], ids[over][own]))
                alive = ~over
                ids, ranks, lengths, number = ids[alive], ranks[alive], lengths[alive], number[alive]
                best, rank = best[alive], rank[alive]
                row = np.arange(len(best))
            if not len(row):
                break
            # Compaction: what stands right of the merged pair moves one cell to the left.
            width = int(lengths.max())
            cell = np.arange(width - 1)
            source = cell + (cell > best[:, None])
            ids[row, best] = rank
            ids = np.take_along_axis(ids, source, axis=1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            lengths -= 1
            for at, there in ((best - 1, best > 0), (best, best < lengths - 1)):
                changed = row[there]
                left = at[there]
                ranks[changed, left] = self.table.get(pair_keys(ids[changed, left], ids[changed, left + 1]))
            ranks[row, lengths - 1] = ABSENT
        order = np.argsort(np.concatenate([d[0] for d in done]))
        ends = offsets(4 * np.concatenate([d[1] for d in done])).tolist()
        data = np.concatenate([d[2] for d in done]).tobytes()
        return [data[ends[i] : ends[i + 1]] for i in order.tolist()]

    def _merge_long(self, data: bytes) -> np.ndarray:
        """The same merges for one long row: a heap of (rank, position) over linked cells."""
        ids = self.byte_ids[np.frombuffer(data, np.uint8)].tolist()
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := pairs.get(rank << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := pairs.get(ids[before[i]] << 32 | rank)) is not None:
                heapq.heappush(heap, (r, before[i]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def decode(self, ids: np.ndarray, lengths: Sequence[int]) -> list[bytes]:
        """Bytes of consecutive runs of ids. An id outside the table raises."""
        token, out, start = self.tokens.__getitem__, [], 0
        for n in lengths:
            out.append(b"".join(map(token, ids[start : start + n].tolist())))
            start += n
        return out


@functools.lru_cache(maxsize=2)
def codec(name: str, pattern: str) -> Codec:
    """The codec of a file that :func:`ship` sent to every machine; kept by the worker."""
    return Codec(read_ranks(SparkFiles.get(name)), pattern)


def ship(spark: SparkSession, ranks_path: str) -> str:
    """Send the rank file from the driver to every executor; the name to open it by."""
    ship_package(spark)
    spark.sparkContext.addFile(ranks_path)
    return ranks_path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of its whole texts (NULL: empty) as ``array<int>``.

    All other columns pass through; one named ``ids`` is replaced. No special tokens."""
    name = ship(docs.sparkSession, ranks_path)

    @F.arrow_udf(IDS_TYPE)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            yield lists(*codec(name, pattern).encode([t.decode() for t in raw(texts)]), pa.int32())

    return docs.withColumn(ids, encoded(F.col(text)))


def decode(docs: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of its token ids (NULL or empty: no bytes)."""
    name = ship(docs.sparkSession, ranks_path)

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arrays in batches:
            own = codec(name, pattern)
            lengths = [0 if n is None else n for n in arrays.value_lengths().to_pylist()]
            yield pa.array(own.decode(arrays.flatten().to_numpy(zero_copy_only=False), lengths), pa.binary())

    return docs.withColumn(decoded, bytes_of(F.col(ids)))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` as of :func:`encode` and ``decoded`` as of :func:`decode`, in one
    pass: the same worker decodes the ids that it has just made. NULL and empty texts have no
    ids and no bytes, repeated rows all stay, an empty table stays empty."""
    name = ship(docs.sparkSession, ranks_path)

    @F.arrow_udf(f"struct<ids:{IDS_TYPE}, decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            own = codec(name, pattern)
            ids, lengths = own.encode([t.decode() for t in raw(texts)])
            decoded = pa.array(own.decode(ids, lengths), pa.binary())
            yield pa.StructArray.from_arrays([lists(ids, lengths, pa.int32()), decoded], ["ids", "decoded"])

    (own,) = free_names(docs, "_both")
    coded = docs.withColumn(own, both(F.col(text)))
    return coded.withColumns({c: F.col(f"{own}.{c}") for c in ("ids", "decoded")}).drop(own)
