"""Scalar functions on their edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from longitab.functions import dates as D
from longitab.functions import recode as R
from longitab.functions import score as SC
from longitab.functions import text as TX


def values(spark, rows, ddl, expr):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


def test_recode_unlisted(spark):
    codes = [(1,), (2,), (9,), (None,)]
    assert values(spark, codes, "x int", R.recode("x", {1: "a", 2: "b"})) == ["a", "b", None, None]
    assert values(spark, codes, "x int", R.recode("x", {1: 10}, keep_unmatched=True)) == [10, 2, 9, None]


def test_labels(spark):
    x = [("low",), ("high",), ("odd",), (None,)]
    assert values(spark, x, "x string", R.rank_of("x", ["low", "high"])) == [1, 2, None, None]
    assert values(spark, x, "x string", R.only_levels("x", ["low"])) == ["low", None, None, None]
    assert values(spark, x, "x string", R.null_if("x", "odd")) == ["low", "high", None, None]
    assert values(spark, [("Other", None), ("Other", "t"), ("a", "t"), (None, "t")], "x string, o string",
                  R.other_text("x", "o")) == [None, "t", "a", None]
    assert values(spark, [(1, 0), (2, 0), (None, 0)], "id int, x int", R.override("x", "id", [2], 1)) == [0, 1, 0]


def test_paste_null(spark):
    x = [("a", None), ("a", 1)]
    assert values(spark, x, "a string, b int", TX.paste("a", "b", sep="_")) == ["a_NA", "a_1"]
    assert values(spark, x, "a string, b int", TX.paste("a", "b", null_text=None)) == [None, "a 1"]


def test_trim_all_white_space(spark):
    x = [("\t a b \n ",), ("　",), ("",), (None,)]
    assert values(spark, x, "x string", TX.trim_all("x")) == ["a b", "", "", None]


def test_regex_functions(spark):
    x = [("ab12cd34",), ("none",), (None,), ("line\n7",)]
    assert values(spark, x, "x string", TX.extract_first("x", r"\d+")) == ["12", None, None, "7"]
    assert values(spark, x, "x string", TX.extract_first("x", r"(?<=cd)\d")) == ["3", None, None, None]
    assert values(spark, x, "x string", TX.replace_first("x", r"\d", "$0\\")) == ["ab$0\\2cd34", "none", None, "line\n$0\\"]
    assert values(spark, x, "x string", TX.replace_first("x", "a|z", "")) == ["b12cd34", "none", None, "line\n7"]


def test_split_item(spark):
    x = [("Doe, Jo",), ("Doe",), ("a.b, c, d",), (None,)]
    assert values(spark, x, "x string", TX.split_item("x", ", ", 2)) == ["Jo", None, "c", None]


def test_normalise_list(spark):
    x = [("aclr 2010 (index), mua;",), ("(12) x (a, b)",), ("a;;",), (None,)]
    assert values(spark, x, "x string", TX.normalise_list("x")) == ["aclr  ; mua", "() x ", "a;", None]
    assert values(spark, x, "x string", TX.normalise_list("x", notes=False, closing=False))[0] == "aclr  (index); mua;"


def test_plain_text_of_numbers(spark):
    x = [(1.0,), (0.5,), (-3.0,), (1e7,), (123456789.25,), (0.0,), (None,)]
    assert values(spark, x, "x double", TX.plain_text("x", "double")) == ["1", "0.5", "-3", "10000000", "123456789.25", "0", None]


@pytest.mark.parametrize("start, end, years", [
    ("2000-02-29", "2001-02-28", 0), ("2000-02-29", "2001-03-01", 1), ("2000-02-29", "2004-02-29", 4),
    ("1990-06-15", "2020-06-14", 29), ("1990-06-15", "2020-06-15", 30), ("2020-06-15", "2018-06-16", -1),
])
def test_completed_years(spark, start, end, years):
    assert values(spark, [(start, end)], "a string, b string",
                  D.years_completed(D.parse_date("a"), D.parse_date("b"))) == [years]


def test_fractional_years(spark):
    x = [("2020-01-01", "2021-07-02"), ("2021-07-02", "2020-01-01"), ("2000-02-29", "2001-02-28"), (None, "2001-02-28")]
    got = values(spark, x, "a string, b string", D.years_fractional(D.parse_date("a"), D.parse_date("b")))
    assert got == [pytest.approx(1 + 182 / 365), pytest.approx(-1 - 182 / 365), pytest.approx(1.0), None]


def test_elapsed(spark):
    x = [("2024-01-01", "2024-02-29"), ("2024-02-29", "2024-01-01")]
    assert values(spark, x, "a string, b string", D.weeks_between(D.parse_date("a"), D.parse_date("b"))) == [8.43, -8.43]


def test_parsing(spark):
    x = [("2024-02-29 10:00:00",), ("2024-02-29",), ("2024-02-30",), ("[not completed]",), ("2024-02-29 10:00",), (None,)]
    day = dt.date(2024, 2, 29)
    assert values(spark, x, "x string", D.parse_date("x")) == [day, day, None, None, day, None]
    assert [v is not None for v in values(spark, x, "x string", D.parse_timestamp("x"))] == [True] + [False] * 5


def test_scores(spark):
    x = [(0, 4), (1, 1), (None, 2), (None, None)]
    ddl = "a int, b int"
    assert values(spark, x, ddl, SC.subscale(["a", "b"])) == [50.0, 75.0, None, None]
    assert values(spark, x, ddl, SC.subscale(["a", "b"], skip_null=True)) == [50.0, 75.0, 50.0, None]
    assert values(spark, x, ddl, SC.row_sum(["a", "b"])) == [4, 2, None, None]
    assert values(spark, x, ddl, SC.either_or("a", "b")) == [None, None, 2, None]
    assert values(spark, x, ddl, SC.any_true([F.col("a") > 0, F.col("b") > 3])) == [1, 1, 0, 0]
    assert values(spark, [(-1.7,), (1.7,), (None,)], "x double", SC.truncate("x")) == [-1, 1, None]
    assert values(spark, [(float("nan"),), (1.0,)], "x double", SC.nan_to_null("x")) == [None, 1.0]
