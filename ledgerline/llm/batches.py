"""Text columns inside tasks: Arrow arrays in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into Python objects at a time (one row may be larger).
SLICE_BYTES = 2 << 20


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of a string array with about ``max_bytes`` each; none if empty."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes, dtype=np.int64) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield texts.slice(start, end - start)


def text_slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """All batches of a task in slices: what a column function returns may be cut otherwise
    than what it gets, so neither texts nor results of a whole batch are ever held at once."""
    for texts in batches:
        yield from slices(texts)


def raw(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; NULL is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [t or b"" for t in texts.cast(kind).to_pylist()]


def offsets(lengths) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def lists(values: np.ndarray, lengths, kind: pa.DataType | None = None) -> pa.ListArray:
    """List array of consecutive runs of ``values``."""
    return pa.ListArray.from_arrays(pa.array(offsets(lengths).astype(np.int32)), pa.array(values, kind))
