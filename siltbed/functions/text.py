"""Cleaning and typing of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's trim strips spaces only; source files also carry tabs and line ends.
BLANKS = " \t\r\n\f\x0b"

# Sector spellings and the sector name each one is reported under.
SECTOR_ALIASES = {
    "Industrials": ["AUTOMOBILES", "AUTOMOBILE"],
    "Materials": ["CHEMICALS", "CHEMICAL"],
    "Health Care": ["PHARMACEUTICALS", "PHARMA"],
    "Technology": ["INFORMATION TECHNOLOGY", "IT"],
    "Financials": ["FINANCIAL SERVICES", "BANKING"],
    "Communication Services": ["TELECOMMUNICATIONS", "TELECOM"],
}


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def standardize_code(code: Column) -> Column:
    """Trimmed upper-case identifier; an empty or blank one is NULL."""
    return blank_to_null(F.upper(trimmed(code)))


def harmonize(text: Column, aliases: dict[str, list[str]]) -> Column:
    """Replace known spellings by their canonical name, trim all others."""
    key = F.upper(trimmed(text))
    mapped = None
    for canonical, spellings in aliases.items():
        branch = key.isin(spellings)
        mapped = F.when(branch, canonical) if mapped is None else mapped.when(branch, canonical)
    return trimmed(text) if mapped is None else mapped.otherwise(trimmed(text))


def harmonize_sector(text: Column) -> Column:
    return harmonize(text, SECTOR_ALIASES)


def to_decimal(number: Column, precision: int = 18, scale: int = 3) -> Column:
    """Fixed-point value, rounded half up; overflow is an error under ANSI mode."""
    return number.cast(f"decimal({precision},{scale})")


def typed(text: Column, data_type: str, strict: bool) -> Column:
    """Cast text; a value that does not parse fails (strict) or becomes NULL."""
    if data_type == "string":
        return text
    return text.cast(data_type) if strict else text.try_cast(data_type)
