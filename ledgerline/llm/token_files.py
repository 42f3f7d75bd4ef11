"""Token ids as Arrow files of fixed-size-list batches.

Documents are put in order of ``doc_id`` by a range partitioning, tokenised, closed with an
end id and laid end to end; each partition cuts its stream into sequences of equal length
and writes them to one Arrow IPC file. A row of the file is a sequence: its ids (fixed-size
list), its mask (fixed-size list; false for the padding of the last sequence of a file) and
the ids and lengths of the documents that begin in it. Lists of fixed size lie flat in
the file, so sequence *i* of a memory-mapped file is a view, without reading the rest.

Recovery: each task attempt writes a file of its own name below the shared folder and only
then returns its manifest row; Spark commits one row per partition, so files of lost or
repeated attempts are never read. File systems are those that pyarrow opens by URI.
"""

from __future__ import annotations

import functools
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.batches import raw, slices
from ledgerline.llm.shipping import ship_package
from ledgerline.sinks.files import Stage, new_folder

SEQUENCE = 1024
ROWS_PER_BATCH = 256
END_ID = 1
#: Words that a task keeps in each of two generations (results do not depend on it).
YOUNG = 300_000
#: New words that the tokenizer gets as one text.
LINES = 1000
# The normalizer and the splits under which words are tokenised alone.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": SPLITS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}
#: Words of ASCII characters and the letters from U+00C0 to U+00FF, which no normalization
#: changes but lower case; and the splits above within these characters.
PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")
#: Byte-level spelling: bytes that are no printable Latin-1 character become U+0100 and on.
SPELLING = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
MANIFEST = "part int, path string, n_docs bigint, n_tokens bigint, n_sequences bigint"
DOCUMENT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class Encoder:
    """The tokenizer, asked once per word between white space, or even per piece of a word.

    A tokenizer with the normalizer and the splits named above drops white space before it
    matches, so words are independent and are remembered. Of a word in plain letters, digits and
    marks the splits are known too: its pieces go straight to the tokenizer's model. Any other
    word goes through the whole tokenizer, as do whole texts under any other tokenizer.
    ``tests`` compare with whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        config = json.loads(self.tokenizer.to_str())
        self.added = [t["content"].encode() for t in config["added_tokens"]]
        self.by_words = (
            [config[k] for k in ("normalizer", "pre_tokenizer", "truncation", "padding")] == [NORMALIZER, PRE_TOKENIZER, None, None]
            and not any(t.split() != [t] for t in self.added)
            and not any(t["lstrip"] or t["rstrip"] for t in config["added_tokens"])
        )
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_words:
            return [np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, self.kind) for t in texts]
        # bytes.split() cuts at ASCII white space only; other white space stays in a word.
        cut = [t.split() for t in texts]
        new = set().union(*cut).difference(self.young) if cut else set()
        again = new.intersection(self.old)
        self.young.update((w, self.old[w]) for w in again)
        self.learn(list(new.difference(again)))
        get = self.young.__getitem__
        out = [np.frombuffer(b"".join(map(get, c)), self.kind) for c in cut]
        if len(self.young) > YOUNG:
            self.old, self.young = self.young, {}
        if len(self.pieces) > YOUNG:
            self.pieces = {}
        return out

    def learn(self, words: list[bytes]) -> None:
        """Ids of new words: plain ones from their pieces, others by the whole tokenizer."""
        added = re.compile(b"|".join(map(re.escape, self.added))).search if self.added else lambda word: None
        plain = [w for w in words if PLAIN.fullmatch(w) and not added(w)]
        if len(plain) < len(words):
            self.learn_lines(list(set(words).difference(plain)))
        if not plain:
            return
        # All words at once, a line each: the line ends stay among the pieces and have no ids.
        pieces = PIECES.findall(b"\n".join([*plain, b""]).decode().lower())
        self.pieces["\n"] = b""
        for piece in set(pieces).difference(self.pieces):
            self.pieces[piece] = self.piece(piece)
        coded = [*map(self.pieces.__getitem__, pieces)]
        places = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))
        ends = places[[i for i, p in enumerate(pieces) if p == "\n"]].tolist()
        data = b"".join(coded)
        self.young.update(zip(plain, [data[a:b] for a, b in zip([0, *ends], ends)]))

    def piece(self, piece: str) -> bytes:
        """Ids that the model gives one piece, which it reads as bytes spelled in letters."""
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(SPELLING)
        return array(np.dtype(self.kind).char, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def learn_lines(self, words: list[bytes]) -> None:
        """Tokenise new words a line each, many lines at a time; a token's place names its word."""
        for at in range(0, len(words), LINES):
            lines = [w.decode() for w in words[at : at + LINES]]
            coded = self.tokenizer.encode("\n".join(lines), add_special_tokens=False)
            starts = np.cumsum([0, *(len(x) + 1 for x in lines)])
            places = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(coded))[::2]
            ends = (np.searchsorted(places, starts) * np.dtype(self.kind).itemsize).tolist()
            data = np.array(coded.ids, self.kind).tobytes()
            self.young.update(zip(words[at : at + LINES], [data[a:b] for a, b in zip(ends, ends[1:])]))


@functools.lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(SparkFiles.get(name))


def file_schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length)),
        ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
    ])


class FileWriter:
    """Packs documents into sequences and writes full batches as they come."""

    def __init__(self, stream, kind: np.dtype, length: int):
        self.schema = file_schema(kind, length)
        self.writer = pa.ipc.new_file(stream, self.schema)
        self.kind, self.length = kind, length
        self.pending: list[np.ndarray] = []
        self.n_pending = self.n_tokens = self.n_docs = self.n_sequences = 0
        self.begun: list[tuple[int, int | None, int]] = []  # sequence, document, length

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.begun.append((self.n_tokens // self.length, doc_id, len(ids)))
        self.n_docs += 1
        self.n_tokens += len(ids)
        self.n_pending += len(ids)
        self.pending.append(ids)
        if self.n_pending >= 2 * ROWS_PER_BATCH * self.length:
            # Whole batches only, so that the place of a sequence follows from its number.
            self.flush(self.n_pending // self.length // ROWS_PER_BATCH * ROWS_PER_BATCH)

    def flush(self, n_rows: int) -> None:
        flat = np.concatenate(self.pending) if self.pending else np.zeros(0, self.kind)
        for at in range(0, n_rows, ROWS_PER_BATCH):
            rows = min(ROWS_PER_BATCH, n_rows - at)
            own = flat[at * self.length : (at + rows) * self.length]
            n_own, size = len(own), rows * self.length
            ids = np.concatenate([own, np.zeros(size - n_own, self.kind)])
            mask = pa.array(np.arange(size) < n_own)
            first = self.n_sequences
            docs: list[list] = [[] for _ in range(rows)]
            lengths: list[list] = [[] for _ in range(rows)]
            n_here = 0
            for sequence, doc_id, n in self.begun:
                if sequence >= first + rows:
                    break
                docs[sequence - first].append(doc_id)
                lengths[sequence - first].append(n)
                n_here += 1
            del self.begun[:n_here]
            self.writer.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length),
                pa.array(docs, pa.list_(pa.int64())), pa.array(lengths, pa.list_(pa.int64())),
            ], schema=self.schema))
            self.n_sequences += rows
        rest = flat[n_rows * self.length :]
        self.pending, self.n_pending = [rest] if len(rest) else [], len(rest)

    def close(self) -> None:
        self.flush(-(-self.n_pending // self.length))
        self.writer.close()


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path; Hadoop's names of the S3 scheme are read as pyarrow's."""
    uri = re.sub("^s3[an]://", "s3://", uri)
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write(docs: DataFrame, tokenizer_path: str, folder: str, stage: Stage, end_id: int = END_ID, length: int = SEQUENCE) -> DataFrame:
    """Write the files of ``docs`` (doc_id, text); the manifest, one row per file in order.

    Order: doc_id (NULL first), then a hash of the text, so that repeated ids may lie in
    several files. NULL texts are empty: only the end id. An empty table writes no file."""
    spark = docs.sparkSession
    ship_package(spark)
    spark.sparkContext.addFile(tokenizer_path)
    name = tokenizer_path.rsplit("/", 1)[-1]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out, path, stream = encoder(name), None, None, None
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids, at = batch.column("doc_id").to_pylist(), 0
            for texts in slices(batch.column("text")):
                for tokens in own.encode(raw(texts)):
                    if out is None:
                        system, root = _opened(folder)
                        system.create_dir(root, recursive=True)
                        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
                        stream = system.open_output_stream(_opened(path)[1])
                        out = FileWriter(stream, own.kind, length)
                    out.add(ids[at], np.append(tokens, own.kind(end_id)))
                    at += 1
        if out is not None:
            out.close()
            stream.close()
            row = [[part], [path], [out.n_docs], [out.n_tokens], [out.n_sequences]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "path", "n_docs", "n_tokens", "n_sequences"])

    # Rows alike in both may be many, so a third key lets ranges cut between them.
    order = ["doc_id", "_hash", "_row"]
    placed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row")).repartitionByRange(*order)
    ordered = placed.sortWithinPartitions(*order).select("doc_id", "text")
    return stage.save(ordered.mapInArrow(written, MANIFEST), "manifest")


def offsets_of(manifest: DataFrame) -> DataFrame:
    """The manifest with ``first``: ids in all files before. One row per file is summed."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_file(path: str) -> pa.ipc.RecordBatchFileReader:
    """Reader of one file; local files are mapped, so lists are views of the file."""
    system, local = _opened(path)
    if isinstance(system, pafs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(local))
    return pa.ipc.open_file(system.open_input_file(local))


def sequence(path: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``i``; only its batch is touched."""
    reader = read_file(path)
    batch = reader.get_batch(i // ROWS_PER_BATCH)
    row = i % ROWS_PER_BATCH
    ids = batch.column("ids")
    size = ids.type.list_size
    flat = ids.values.slice((ids.offset + row) * size, size).to_numpy(zero_copy_only=True)
    return flat, batch.column("mask")[row].values.to_numpy(zero_copy_only=False)


def documents_in(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a file in order, with their ids; one document is held at a time."""
    reader = read_file(path)
    waiting: list[tuple[int | None, int]] = []
    parts: list[np.ndarray] = []
    held = 0
    for number in range(reader.num_record_batches):
        batch = reader.get_batch(number)
        for docs, lengths in zip(batch.column("doc_ids").to_pylist(), batch.column("doc_lengths").to_pylist()):
            waiting.extend(zip(docs, lengths))
        ids, mask = batch.column("ids").flatten().to_numpy(), batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        fresh = ids if mask.all() else ids[mask]
        parts.append(fresh)
        held += len(fresh)
        if waiting and held < waiting[0][1]:
            continue
        flat, at, n_done = np.concatenate(parts), 0, 0
        for doc_id, n in waiting:
            if at + n > len(flat):
                break
            yield doc_id, flat[at : at + n]
            at, n_done = at + n, n_done + 1
        del waiting[:n_done]
        parts, held = [flat[at:]], len(flat) - at


def read(manifest: DataFrame) -> DataFrame:
    """Documents as the files hold them: ``doc_id``, ``start`` (ids of all documents before
    it), ``n_tokens`` and ``ids_crc32`` (of the ids as little-endian 32-bit integers)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                out: list[tuple] = []
                for doc_id, ids in documents_in(path):
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(out) == 10_000:
                        yield _table(out)
                        out = []
                yield _table(out)

    def _table(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    ship_package(manifest.sparkSession)
    files = offsets_of(manifest).select("path", "first")
    # One task per file: a count of its own, because merging by size would see only paths.
    return files.repartition(max(1, manifest.count())).mapInArrow(rows, DOCUMENT)


def export(docs: DataFrame, tokenizer_path: str, folder: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Write the files of ``docs`` and read them back: (manifest, documents)."""
    spark: SparkSession = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    manifest = write(docs, tokenizer_path, folder, Stage(spark), **options)
    return manifest, read(manifest)
