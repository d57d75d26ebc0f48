"""Edge rows of the column expressions."""

import hashlib
import math

import pytest

from terrace.functions import bad_postal, coordinate, coordinate_malformed, masked, percentage


def _values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    ("code", "country", "flagged"),
    [
        ("12345", "united states", False),
        ("12345-6789", "united states", False),
        ("12345-", "united states", False),
        ("12345\n", "united states", False),
        ("12345-12", "united states", True),
        ("1234", "united states", True),
        (" 12345", "united states", True),
        ("", "united states", True),
        (None, "united states", False),
        ("bad", "ireland", False),
        ("bad", None, False),
    ],
)
def test_bad_postal(spark, code, country, flagged):
    df = spark.createDataFrame([(code, country)], "postal_code string, country string")
    assert _values(df, bad_postal()) == [flagged]


def test_bad_postal_per_country(spark):
    df = spark.createDataFrame(
        [("D02", "ireland"), ("12345", "ireland"), ("123", "united states")],
        "postal_code string, country string",
    )
    patterns = {"united states": "^[0-9]{5}$", "ireland": "^[A-Z][0-9]{2}$"}
    assert _values(df, bad_postal(patterns)) == [False, True, True]


def test_a_long_pattern_table_gives_the_same_flags(spark):
    codes = [("D02", "c3"), ("12345", "c3"), ("123", "c190"), ("1", "elsewhere"), (None, "c1"), ("1", None)]
    df = spark.createDataFrame(codes, "postal_code string, country string")
    table = {f"c{k}": "^[0-9]{5}$" if k > 100 else "^[A-Z][0-9]{2}$" for k in range(200)}
    few = {k: table[k] for k in ("c1", "c3", "c190")}
    assert _values(df, bad_postal(table)) == _values(df, bad_postal(few)) == [False, True, True, False, False, False]


def test_coordinates(spark):
    texts = ["35.1", "", None, "abc", " 2 ", "nan", "0", "  ", "-97.46818222"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    found = _values(df, coordinate("c"))
    assert math.isnan(found.pop(5))
    assert found == [35.1, None, None, None, 2.0, 0.0, None, -97.46818222]
    assert _values(df, coordinate_malformed("c")) == [t == "abc" for t in texts]


def test_mask(spark):
    df = spark.createDataFrame([("555",), (None,), ("",)], "phone string")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert _values(df, masked("phone")) == [digest("555"), None, digest("")]
    assert _values(df, masked("phone", "s")) == [digest("s555"), None, digest("s")]


def test_percentage_rounds_half_up_in_decimals(spark):
    # 201 / 20000 is 1.005 percent: binary arithmetic would round it down.
    df = spark.createDataFrame([(201, 20000), (1, 3), (0, 5), (4, 0), (None, 5)], "part long, whole long")
    assert _values(df, percentage("part", "whole")) == [1.01, 33.33, 0.0, None, None]
    assert df.select(percentage("part", "whole")).schema[0].dataType.simpleString() == "double"
