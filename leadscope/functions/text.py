"""String helpers expressed as Catalyst expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col, ColumnOrName


# The characters Python's str.strip() treats as whitespace.
WHITESPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        "
              "        　")


def strip(c: ColumnOrName) -> Column:
    """Trim leading/trailing whitespace as Python's ``str.strip()`` does
    (Spark's one-argument ``trim`` only removes spaces)."""
    return F.trim(col(c), F.lit(WHITESPACE))


def filled(c: ColumnOrName) -> Column:
    """Truthy and not blank: non-NULL and non-empty after stripping whitespace."""
    return F.coalesce(F.length(strip(col(c).cast("string"))) > 0, F.lit(False))


def is_upper(c: ColumnOrName) -> Column:
    """Has at least one cased character and no lowercase one."""
    x = col(c)
    return (x == F.upper(x)) & (x != F.lower(x))


def digits(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), r"[^0-9]", "")


def distinct_chars(c: ColumnOrName) -> Column:
    """Number of distinct characters of a string."""
    x = col(c)
    return F.when(F.length(x) == 0, F.lit(0)).otherwise(
        F.size(F.array_distinct(F.split(x, ""))))


def lcs_length(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Length of the longest common subsequence, by the classic dynamic
    program written with SQL higher-order functions: the outer ``aggregate``
    walks the characters of ``a`` carrying the previous DP row, the inner one
    builds the current row left to right. O(len(a) * len(b)) per pair; meant
    for short strings such as e-mail domains."""
    a, b = col(a), col(b)
    la, lb = F.length(a), F.length(b)
    zeros = F.array_repeat(F.lit(0), lb + 1)

    def row(prev, i):
        def cell(cur, j):
            same = F.substring(a, i, 1) == F.substring(b, j, 1)
            v = F.when(same, prev[j - 1] + 1).otherwise(F.greatest(prev[j], cur[j - 1]))
            return F.concat(cur, F.array(v))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(lb, F.lit(1))), F.array(F.lit(0)),
                           lambda cur, j: F.when(j <= lb, cell(cur, j)).otherwise(cur))

    out = F.aggregate(F.sequence(F.lit(1), F.greatest(la, F.lit(1))), zeros,
                      lambda prev, i: F.when(i <= la, row(prev, i)).otherwise(prev))
    return F.when((la == 0) | (lb == 0), F.lit(0)).otherwise(F.element_at(out, lb + 1))


def fuzzy_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Similarity 0-100: ``round_half_even(100 * 2*LCS / (len a + len b))``,
    the indel-distance ratio; 0 when both strings are empty."""
    a, b = col(a), col(b)
    total = F.length(a) + F.length(b)
    r = (F.lit(2) * lcs_length(a, b)).cast("double") / total.cast("double")
    return F.when(total == 0, F.lit(0)).otherwise(F.bround(r * 100.0, 0).cast("int"))
