"""Literal fixtures for text repair and constraints."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabwright.functions.text import number_or_null
from tabwright.operators import cleaning, constraints


def column(frame, name):
    return [r[name] for r in frame.orderBy("i").collect()]


def frame(spark, **columns):
    names = list(columns)
    rows = [(i, *row) for i, row in enumerate(zip(*columns.values()))]
    return spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in names))


def test_strings_without_digits_become_null(spark):
    df = frame(spark, A=["abc", "def123", "g_hi", "456", "jkl789"], B=["xyz", "123abc", "uvw", "789", "rs$t"])
    out = cleaning.convert_non_numeric_strings_to_nan(df, ["A", "B"])
    assert column(out, "A") == [None, "def123", None, "456", "jkl789"]
    assert column(out, "B") == [None, "123abc", None, "789", None]


def test_problem_characters(spark):
    df = frame(spark, A=["123", "456$", "-789_", None, "10.5", "2030"], B=["100%", "dog", "300*", "400+", None, "60,7"])
    found = cleaning.identify_problematic_characters(df, ["A", "B", "absent"]).collect()
    assert {r["token"] for r in found} == {"$", "_", "%", "dog", "*", "+", ","}


def test_problem_report_counts_and_samples(spark):
    df = frame(spark, A=["1", "2_", "3_", "_4", "5__", None])
    row = cleaning.problem_value_report(df, ["A"], ["_", "__"], "i").first()
    assert (row["problem_count"], row["samples"]) == (4, ["2_", "3_", "_4"])


def test_remove_characters(spark):
    df = frame(spark, A=["100_", "20$0_", None, "__400_"], B=["500_", "_ 600", "700_", "800"])
    for tokens in (["_", "$"], "_$", {"_", "$"}):
        out = cleaning.remove_characters(df, ["A", "B", "absent"], tokens)
        assert column(out, "A") == ["100", "200", None, "400"]
        assert column(out, "B") == ["500", " 600", "700", "800"]


def test_strict_conversion_fails_and_lenient_gives_null(spark):
    df = frame(spark, A=["1", " 2.5 ", None, "1d"])
    with pytest.raises(PySparkException, match="not a number"):
        cleaning.convert_to_numeric(df, ["A"]).collect()
    assert column(cleaning.convert_to_numeric(df, ["A"], lenient=True), "A") == [1.0, 2.5, None, None]


@pytest.mark.parametrize("text,number", [
    ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("+7", 7.0), ("2f", None), ("1_000", None), ("", None), ("NaN", None), ("--1", None)])
def test_number_pattern(spark, text, number):
    assert spark.createDataFrame([(text,)], "t string").select(number_or_null(F.col("t"))).first()[0] == number


def test_regex_matches_from_the_start_only(spark):
    df = frame(spark, A=["12x", "x12", None, "3"])
    assert column(cleaning.clean_column_with_regex(df, "A", "[0-9]+"), "A") == ["12x", None, None, "3"]
    report = cleaning.regex_clean_report(df, "A", "[0-9]+", "i").first()
    assert (report["replaced"], report["samples"]) == (1, ["x12"])


def test_space_before_word(spark):
    df = frame(spark, A=["MemoryStreet", "Quality Street", None, "Street", "AStreetBStreet"])
    assert column(cleaning.add_space_before_word(df, "A", "Street"), "A") == [
        "Memory Street", "Quality Street", None, "Street", "AStreetB Street"]


def test_durations(spark):
    df = frame(spark, A=["22 Years and 6 Months", "1 year and 3 month", "NA", None])
    assert column(cleaning.parse_time_period(df, "A"), "A") == [22.5, 1.25, None, None]


def test_list_members_are_counted_once_per_row(spark):
    df = frame(spark, A=["Auto Loan, Home Loan, and Auto Loan", "Auto Loan", None, " , "])
    got = {r["value"]: r["n_rows"] for r in cleaning.get_unique_values_and_counts(df, "A").collect()}
    assert got == {"Auto Loan": 2, "Home Loan": 1}


def test_multi_hot_handles_missing_lists(spark):
    df = frame(spark, A=["Auto Loan, Home Loan, Auto Loan", None, "home loan"])
    out = cleaning.transform_to_binary_features(df, "A", ["Auto Loan", "Home Loan"])
    assert column(out, "Has_Auto_Loan") == [1, 0, 0]
    assert column(out, "Has_Home_Loan") == [1, 0, 0]
    assert column(out, "Loan_Count") == [3, None, 0]


RULES = {"age": {"min": 0, "max": 120, "integer": True}, "score": {"min": 0, "max": 1000, "integer": True}}


def numbers(spark):
    rows = [(0, 25.0, 100.0), (1, 30.0, 1200.0), (2, 135.0, 300.0), (3, None, -4.0), (4, 40.0, 500.0)]
    return spark.createDataFrame(rows, "i int, age double, score double")


def test_constraints(spark):
    out = constraints.set_constraints_for_numeric_features(numbers(spark), ["age", "score"], RULES)
    assert dict(out.dtypes)["age"] == "bigint"
    assert column(out, "age") == [25, 30, None, None, 40]
    assert column(out, "score") == [100, None, 300, None, 500]
    counts = {r["column_name"]: (r["below_min"], r["above_max"])
              for r in constraints.constraint_violations(numbers(spark), ["age", "score"], RULES).collect()}
    assert counts == {"age": (0, 1), "score": (1, 1)}


def test_constraint_errors(spark):
    with pytest.raises(ValueError, match="no constraints"):
        constraints.set_constraints_for_numeric_features(numbers(spark), "age", {})
    with pytest.raises(ValueError, match="max, integer"):
        constraints.set_constraints_for_numeric_features(numbers(spark), "age", {"age": {"min": 0}})
    broken = spark.createDataFrame([(0, 2.5)], "i int, age double")
    with pytest.raises(PySparkException, match="whole number"):
        constraints.set_constraints_for_numeric_features(broken, "age", RULES).collect()
