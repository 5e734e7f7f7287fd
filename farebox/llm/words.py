"""Lower-cased words of a text, with Spark functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# fixed values: every ASCII character but lower-case letters and digits separates words
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; null becomes empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column) -> Column:
    """The words in order."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def count_words(text: Column) -> Column:
    """How many words there are."""
    return F.size(words(text)).cast("bigint")
