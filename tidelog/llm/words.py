"""Words as the operators count them: runs of code points other than space and U+0009 to U+000D."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java pattern of what separates words.
GAP = r"[ \t-\r]+"


def words(text: Column) -> Column:
    """Array of the words of a text; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")
