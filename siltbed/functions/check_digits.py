"""Mod-10 check digits of alphanumeric security identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_PATTERN = "^[A-Z]{2}[A-Z0-9]{9}[0-9]$"


def _weighted_sum(code: Column) -> Column:
    # Letters count as 10..35, so one character may give two digits.
    expanded = F.array_join(
        F.transform(
            F.split(code, ""),
            lambda ch: F.when(ch.between("A", "Z"), (F.ascii(ch) - 55).cast("string")).otherwise(ch),
        ),
        "",
    )
    # Every second digit from the right is doubled, and its own digits summed.
    terms = F.transform(
        F.split(F.reverse(expanded), ""),
        lambda ch, i: F.when(i % 2 == 0, ch.cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), ch.cast("int") + 1)
        ),
    )
    return F.aggregate(terms, F.lit(0), lambda total, term: total + term)


def has_valid_check_digit(code: Column) -> Column:
    """True where the code is well formed and its last digit checks; NULL stays NULL."""
    return F.when(code.rlike(CODE_PATTERN), _weighted_sum(code) % 10 == 0).when(code.isNotNull(), False)


def check_digit(stem: Column) -> Column:
    """The digit that completes an upper-case alphanumeric stem."""
    return F.pmod(-_weighted_sum(F.concat(stem, F.lit("0"))), F.lit(10)).cast("int")
