"""Block patterns: literal cases, short last blocks, defects fixed on purpose."""

import pytest

from tabwright.operators import blocks

N = None


def rows(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").repartition(5)


def got(frame):
    return [r["v"] for r in frame.orderBy("i").collect()]


AT = dict(position_col="i")


def test_unique_pattern(spark):
    good = blocks.analyze_unique_values_pattern(rows(spark, ["a", N, "a", N, N, N, "b", "b"], "string"), "v", 3, 1, **AT).first()
    assert (good["is_pattern"], good["first_bad_block"], good["n_null_blocks"]) == (True, None, 1)
    bad = blocks.analyze_unique_values_pattern(rows(spark, [N, N, "a", "b", N, N], "string"), "v", 2, 1, **AT).first()
    assert (bad["is_pattern"], bad["first_bad_block"], bad["n_unique"], bad["n_null_blocks"]) == (False, 1, 2, 1)


def test_ordered_pattern_with_short_last_block(spark):
    ok = blocks.analyze_ordered_values_pattern(rows(spark, ["a", N, "c", "a", "b"], "string"), "v", 3, ["a", "b", "c"], **AT)
    assert ok.first()["is_pattern"]
    bad = blocks.analyze_ordered_values_pattern(rows(spark, ["a", "b", "c", "a", "c"], "string"), "v", 3, ["a", "b", "c"], **AT)
    assert bad.first()["first_bad_block"] == 1


def test_incremental_pattern_across_gaps(spark):
    def verdict(values):
        r = blocks.analyze_incremental_num_values_pattern(rows(spark, values), "v", 4, 0.5, 0.001, **AT).first()
        return r["is_pattern"], r["first_bad_block"], r["reason"], r["n_null_blocks"]

    assert verdict([1.0, N, 2.0, 2.5, N, N, N, N, 7.0, 7.5]) == (True, None, None, 1)
    assert verdict([1.0, N, 2.0, 2.5, N, 3.0, N, N]) == (False, 1, "too_few_values", 0)
    assert verdict([1.0, N, 2.2, 2.5, 1.0, 1.5, N, N]) == (False, 0, "wrong_step", 0)


@pytest.mark.parametrize("method,expected", [
    ("mean", [1.0, 2.0, 3.0, 2.0, N, N, N, N, 5.0, 5.0]),
    ("median", [1.0, 2.0, 3.0, 2.0, N, N, N, N, 5.0, 5.0]),
    ("mode", [1.0, 2.0, 3.0, 1.0, N, N, N, N, 5.0, 5.0]),
])
def test_fill_by_block(spark, method, expected):
    """One lone value fills its own block, never the next one."""
    df = rows(spark, [1.0, 2.0, 3.0, N, N, N, N, N, 5.0, N])
    filled, report = blocks.impute_missing_with_value_per_pattern(df, "v", 4, method, **AT)
    assert got(filled) == expected
    assert report.first()["n_null_blocks"] == 1 and report.first()["imputed"]


def test_fill_unique_or_leave_everything(spark):
    filled, report = blocks.impute_missing_with_value_per_pattern(rows(spark, ["a", N, N, "b"], "string"), "v", 2, "unique", **AT)
    assert got(filled) == ["a", "a", "b", "b"] and report.first()["imputed"]
    same, report = blocks.impute_missing_with_value_per_pattern(rows(spark, ["a", N, "c", "b"], "string"), "v", 2, "unique", **AT)
    assert got(same) == ["a", N, "c", "b"]
    assert (report.first()["imputed"], report.first()["first_bad_block"]) == (False, 1)
    with pytest.raises(ValueError):
        blocks.impute_missing_with_value_per_pattern(same, "v", 2, "max", **AT)


def test_fill_from_a_list(spark):
    out = blocks.impute_missing_with_ordered_values_per_pattern(rows(spark, ["x", N, N, N, N], "string"), "v", 3, list("abc"), **AT)
    assert got(out) == ["x", "b", "c", "a", "b"]
    with pytest.raises(ValueError):
        blocks.impute_missing_with_ordered_values_per_pattern(out, "v", 3, list("ab"), **AT)


def test_fill_incrementally_from_the_left(spark):
    out = blocks.impute_missing_with_incremental_value_per_pattern(rows(spark, [N, 1.0, N, 5.0, N, N, N, N, N, 3.0]), "v", 5, 0.5, **AT)
    assert got(out) == [0.5, 1.0, 1.5, 5.0, 5.5, 1.0, 1.5, 2.0, 2.5, 3.0]


def test_order_column_need_not_be_dense(spark):
    df = spark.createDataFrame([(10 * i + 3, v) for i, v in enumerate([1.0, N, N, 4.0])], "i int, v double").repartition(3)
    filled, _ = blocks.impute_missing_with_value_per_pattern(df, "v", 2, "mean", order_col="i")
    assert got(filled) == [1.0, 1.0, 4.0, 4.0]
    with pytest.raises(ValueError):
        blocks.blocked(df, 2)
