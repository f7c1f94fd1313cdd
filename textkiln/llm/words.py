"""Native expressions shared by the word-based operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Maximal runs of characters other than ``SPACES``; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\x09-\\x0D]+"))


def word_count(text: Column) -> Column:
    """Number of words, without keeping the words."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, "[ \\x09-\\x0D]+"))).cast("long")
