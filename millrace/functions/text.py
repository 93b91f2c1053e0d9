"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters, digits, underscores and apostrophes
# (Unicode); the letter variant splits on everything that is not a letter.
WORD_PATTERN = r"[\p{L}\p{N}_']+"
NON_LETTER_PATTERN = r"[^\p{L}]+"
STORAGE_PATH_PATTERN = r"gs://.*/.*"


def matches_whole(value: Column, pattern: str) -> Column:
    """True when the whole text matches; ``rlike`` alone only searches."""
    return value.rlike(f"^(?:{pattern})$")


def words(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(WORD_PATTERN), F.lit(0))


def letter_words(value: Column) -> Column:
    return F.filter(F.split(value, NON_LETTER_PATTERN), lambda w: w != "")


def whitespace_words(value: Column) -> Column:
    """Pieces between runs of white space; none for blank text."""
    return F.filter(F.split(value, r"\s+"), lambda w: w != "")
