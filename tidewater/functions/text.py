"""Text expressions on whole columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_LETTERS = r"[^\p{L} ]"
LETTER_GAPS = r"[^\p{L}]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: Column | str) -> Column:
    """Lower-case words of letters in any script, without empty tokens."""
    spaced = F.regexp_replace(F.lower(_c(c)), NOT_LETTERS, " ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def trigrams(c: Column | str) -> Column:
    """Distinct three-letter grams of a string, padded with two blanks before and one after."""
    padded = F.concat(F.lit("  "), F.lower(_c(c)), F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - 2, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(3))))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
