"""Column expressions that several native operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two word patterns of the operators' contracts; the last is the second one before lower-casing.
SPACED_WORDS = r"[^\x20\x09-\x0D]+"
PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. All-ASCII texts take the fast built-in, which is equal for them."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def word_list(text: Column, pattern: str) -> Column:
    """Words of a text in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def nulls_and_all(*values: Column) -> list[Column]:
    """Values to hash, each behind its null flag: a hash skips nulls, so without flags a value could slip to its neighbour."""
    return [c for v in values for c in (v.isNull(), v)]
