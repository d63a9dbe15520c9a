"""Content hashes used as change detectors and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.specs import quoted

SEPARATOR = "||"


def hash_key(*cols: Column | str, null_token: str | None = None) -> Column:
    """SHA-256 over the text of the columns, joined by ``||``.

    NULLs are skipped, so ``(a, NULL, b)`` and ``(a, b, NULL)`` hash alike; give a
    ``null_token`` to tell them apart.
    """
    parts = []
    for col in cols:
        text = (F.col(quoted(col)) if isinstance(col, str) else col).cast("string")
        parts.append(text if null_token is None else F.coalesce(text, F.lit(null_token)))
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
