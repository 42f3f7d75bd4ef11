"""Names of helper columns beside columns that a caller brings."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, made longer where ``df`` has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
