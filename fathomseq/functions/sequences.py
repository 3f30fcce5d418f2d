"""Expressions over sequences, CIGAR strings, flags and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the SAM format: bits of the flag, operation letters, and those that move along the reference.
UNMAPPED, REVERSE = 4, 16
CIGAR_OPS, REFERENCE_OPS = "MIDNSHPX=", "MDN=X"


def leading_a_run(seq: Column) -> Column:
    """Number of upper-case A at the start; 0 for null or empty."""
    return F.coalesce(F.length(F.regexp_extract(seq, "^A*", 0)), F.lit(0)).cast("long")


def a_richness(seq: Column, short: int = 6, long: int = 19) -> Column:
    """Number of A in the first ``short`` characters plus that in the first ``long``; null for null."""
    count = lambda n: F.regexp_count(F.substring(seq, 1, n), F.lit("A"))
    return (count(short) + count(long)).cast("long")


def share_of(seq: Column, base: str) -> Column:
    """Share of ``base`` in a sequence; null where there is none."""
    count = F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))
    return F.try_divide(count.cast("double"), F.length(seq).cast("double"))


def last_op_length(cigar: Column, soft_only: bool = False) -> Column:
    """Length of the last operation, whatever it is, or of a soft clip only."""
    return F.regexp_extract(cigar, rf"(\d+)[{'S' if soft_only else CIGAR_OPS}]$", 1).try_cast("long")


def first_op_length(cigar: Column, soft_only: bool = False) -> Column:
    return F.regexp_extract(cigar, rf"^(\d+)[{'S' if soft_only else CIGAR_OPS}]", 1).try_cast("long")


def is_mapped(flag: Column) -> Column:
    return flag.bitwiseAND(UNMAPPED) == 0


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(REVERSE) != 0


def is_spliced(cigar: Column) -> Column:
    return cigar.contains("N")


def last_tag_within(tags: Column, threshold: float) -> Column:
    """Whether the third ``:`` field of the last tag is at most ``threshold``.

    True where there is no such field or it is empty; other text is compared
    as text, so that it is above any number.
    """
    value = F.get(F.split(F.try_element_at(tags, F.lit(-1)), ":"), F.lit(2))
    number = value.try_cast("double")
    text = value <= F.lit(f"{threshold:g}")
    return F.when(value.isNull() | (value == ""), True).when(number.isNotNull(), number <= threshold).otherwise(text)


def barcode(tags: Column, prefix: str = "XC:Z:") -> Column:
    """The third tag from the end, without ``prefix``; null if there are fewer."""
    return F.replace(F.try_element_at(tags, F.lit(-3)), F.lit(prefix), F.lit(""))


def chromosome_number(name: Column) -> Column:
    """M, Y and X as 25, 24 and 23, others unchanged."""
    return F.when(name == "M", "25").when(name == "Y", "24").when(name == "X", "23").otherwise(name)


def suffixed_id(name: Column, chromosome: Column) -> Column:
    """An id made unique by ten zeros and the chromosome's number."""
    return F.concat(name, F.lit("0000000000"), chromosome_number(chromosome))


def plain_category(category: Column) -> Column:
    """Hyphens and underscores as spaces."""
    return F.translate(category, "-_", "  ")
