"""Row identity for joins back to texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``key``, ``id`` (the key as text, never null), ``h`` (hash of the text) and ``text``.

    ``id`` and ``h`` tell rows apart even where keys are null or repeat; rows
    equal in both have equal texts and so equal results.
    """
    return docs.select(
        docs[f"`{key}`"].alias("key"),
        F.coalesce(docs[f"`{key}`"].cast("string"), F.lit("\0")).alias("id"),
        F.xxhash64(docs[f"`{text}`"]).alias("h"),
        docs[f"`{text}`"].alias("text"),
    )
