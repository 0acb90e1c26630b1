"""Working columns beside a caller's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it (in either case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
