"""Stand-ins for random values that depend on the row's key alone.

A re-run, a retried task and a second copy of a row all get the same value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(key: Column, purpose: str) -> Column:
    """32 hex digits; a different ``purpose`` gives independent digits."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{purpose}")))


def number(hex_digits: Column, word: int = 0) -> Column:
    """One of the four 32-bit numbers in a digest."""
    return F.conv(F.substring(hex_digits, 1 + 8 * word, 8), 16, 10).cast("bigint")


def choose(hex_digits: Column, n: int, word: int = 0) -> Column:
    """Number in ``0 .. n-1``."""
    return F.pmod(number(hex_digits, word), F.lit(n))


def jitter(hex_digits: Column, word: int) -> Column:
    """Offset in [-0.01, 0.01)."""
    return choose(hex_digits, 20000, word) / F.lit(1e6) - F.lit(0.01)


def uuid_shaped(hex_digits: Column) -> Column:
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(hex_digits, at, length) for at, length in parts])


def assign(key: Column, values: Sequence[str], purpose: str = "account") -> Column:
    """Spread rows over a short list of values by key."""
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, choose(digest(key, purpose), len(values)).cast("int"))
