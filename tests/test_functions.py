from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltbed.functions.check_digits import check_digit, has_valid_check_digit
from siltbed.functions.text import harmonize_sector, standardize_code, to_decimal, typed


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [(" de0001 ", "DE0001"), ("\tde\r\n", "DE"), ("", None), (" \t\r\n", None), (None, None)],
)
def test_standardize_code(spark, given, expected):
    assert value(spark, standardize_code(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("automobile", "Industrials"),
        (" Chemicals", "Materials"),
        ("PHARMA", "Health Care"),
        ("it", "Technology"),
        ("Banking ", "Financials"),
        ("Telecom", "Communication Services"),
        ("  Energy ", "Energy"),
        (None, None),
    ],
)
def test_harmonize_sector(spark, given, expected):
    assert value(spark, harmonize_sector(F.lit(given).cast("string"))) == expected


def test_decimal_rounds_half_up_and_overflow_fails(spark):
    assert value(spark, to_decimal(F.lit(1.0005))) == Decimal("1.001")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        value(spark, to_decimal(F.lit(1e18)))


def test_strict_and_lenient_casts(spark):
    assert value(spark, typed(F.lit("n/a"), "double", strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, typed(F.lit("n/a"), "double", strict=True))


# Public identifiers of widely known securities.
@pytest.mark.parametrize("code", ["US0378331005", "DE0007236101", "GB0002634946", "AU0000XVGZA3"])
def test_check_digit_of_known_codes(spark, code):
    assert value(spark, has_valid_check_digit(F.lit(code)))
    assert value(spark, check_digit(F.lit(code[:-1]))) == int(code[-1])
    wrong = code[:-1] + str((int(code[-1]) + 3) % 10)
    assert value(spark, has_valid_check_digit(F.lit(wrong))) is False


def test_malformed_codes(spark):
    assert value(spark, has_valid_check_digit(F.lit("de0007236101"))) is False
    assert value(spark, has_valid_check_digit(F.lit("DE00"))) is False
    assert value(spark, has_valid_check_digit(F.lit(None).cast("string"))) is None
