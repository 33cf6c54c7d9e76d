"""Ranks, quotas and quantiles: the distributed forms equal the plain ones, also on skewed data."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.functions.hashing import order_hash, uniform
from tabwright.operators import ranking
from tabwright.operators.ranking import bucket_digits, cut_key, exact_quantiles, quota_cuts, with_position
from tabwright.operators.relational import sample_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value and one class."""
    draw = np.random.default_rng(3)
    n = 6000
    value = np.where(np.arange(n) % 3 == 0, 7.25, np.round(draw.normal(0, 50, n), 3))
    frame = pd.DataFrame({
        "id": np.arange(n), "g": np.where(np.arange(n) % 3 == 0, "hot", draw.choice(list("abc"), n)),
        "v": value, "w": draw.integers(0, 9, n).astype(float),
    })
    frame.loc[frame["id"] % 50 == 1, "v"] = None
    return frame, spark.createDataFrame(pa.Table.from_pandas(frame, preserve_index=False)).repartition(7)


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_bracketed_quantiles_equal_pandas(skewed):
    table, df = skewed
    rows = exact_quantiles(df, ["v", "w"], PROBS, direct_rows=0, accuracy=200).collect()
    for row in rows:
        assert row["q"] == pytest.approx(list(table[row["feature"]].quantile(PROBS)), abs=1e-9)
    assert len(rows) == 2


def test_bracketed_quantiles_by_group(skewed):
    table, df = skewed
    rows = exact_quantiles(df, ["v"], PROBS, by=["g"], direct_rows=0, accuracy=200).collect()
    assert len(rows) == 4
    for row in rows:
        assert row["q"] == pytest.approx(list(table[table.g == row["g"]]["v"].quantile(PROBS)), abs=1e-9)


def test_direct_and_bracketed_agree(skewed):
    _, df = skewed
    a = {(r["g"], r["feature"]): r["q"] for r in exact_quantiles(df, ["v", "w"], PROBS, by=["g"]).collect()}
    b = {(r["g"], r["feature"]): r["q"] for r in exact_quantiles(df, ["v", "w"], PROBS, by=["g"], direct_rows=0).collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=1e-9)


@pytest.mark.parametrize("direct_rows", [0, 10])
def test_quantiles_of_a_column_without_values(spark, direct_rows):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 4.0)], "id int, v double, w double")
    got = {r["feature"]: r["q"] for r in exact_quantiles(df, ["v", "w"], [0.5], direct_rows=direct_rows).collect()}
    assert got == {"v": None, "w": [3.0]}


def test_only_short_stretches_are_ranked(skewed):
    """Cuts divide a column until no stretch with a wanted rank holds more rows than allowed."""
    table, df = skewed
    groups = pa.table({"_n": [[int(table["v"].notna().sum())]]})
    search = ranking._Cuts(df.select("v"), ["v"], [0.3, 0.31, 0.9], [], groups, 60, 100)
    got = search.found().first()["q"]
    line = search.lines[0, 0]
    assert got == pytest.approx(list(table["v"].quantile([0.3, 0.31, 0.9])))
    assert line.counts.sum() == line.n and all(line.counts[s] <= 60 for s in line.wanted())
    assert line.counts[1::2].max() >= 1  # cuts are values of the column


def test_many_probabilities_of_many_columns(spark):
    draw = np.random.default_rng(8)
    table = pd.DataFrame({f"c{k}": draw.normal(0, 10.0 ** (k - 2), 30_000) for k in range(5)})
    table.loc[::7, "c1"] = 4.0
    table.loc[::5, "c2"] = None
    df = spark.createDataFrame(pa.Table.from_pandas(table, preserve_index=False)).repartition(6)
    probs = [k / 100 for k in range(101)]
    for row in exact_quantiles(df, list(table.columns), probs, direct_rows=500, accuracy=400).collect():
        assert row["q"] == pytest.approx(list(table[row["feature"]].quantile(probs)), rel=1e-12)


def test_quantiles_of_large_and_small_groups(spark):
    """Null is a group like others; NaN is the largest value; infinite ends stay."""
    draw = np.random.default_rng(9)
    rows = [(None if k % 3 == 0 else "x" if k % 50 else "rare", float(draw.integers(0, 200))) for k in range(3000)]
    rows += [("x", float("inf")), ("x", float("-inf")), ("odd", float("nan")), ("odd", 1.0), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r["g"]: r["q"] for r in exact_quantiles(df, ["v"], [0.25, 0.5], by=["g"], direct_rows=100, accuracy=50).collect()}
    assert got["empty"] is None and got["odd"][0] != got["odd"][0]
    for g in (None, "x", "rare"):
        values = sorted(v for name, v in rows if name == g)
        assert got[g] == pytest.approx(list(np.quantile(values, [0.25, 0.5])))
    assert len(got) == 5


@pytest.mark.parametrize("rows_per_bucket", [100, 10**6])
def test_position_equals_global_rank(skewed, rows_per_bucket):
    table, df = skewed
    got = with_position(df, "v", ["id"], "rn", rows_per_bucket).select("id", "rn").toPandas().set_index("id")["rn"]
    order = table.sort_values(["v", "id"], na_position="first")["id"].to_numpy()
    assert list(got.sort_values().index) == list(order)
    assert sorted(got) == list(range(len(table)))


def test_position_by_text_hash(skewed):
    _, df = skewed
    hashed = df.select("id", order_hash("id", 5).alias("h"))
    got = with_position(hashed, "h", ["id"], "rn", 100).toPandas().sort_values("rn")
    assert list(got["h"]) == sorted(got["h"])


def test_quota_cut_is_the_last_covered_row(skewed, spark):
    table, df = skewed
    quotas = spark.createDataFrame([("hot", "q", 10), ("hot", "r", 1999), ("a", "q", 1), ("b", "q", 0)],
                                   "class_value string, name string, quota long")
    cuts = {(r["class_value"], r["name"]): r["cut"] for r in quota_cuts(df, ["id"], 42, quotas, "g").collect()}
    assert ("b", "q") not in cuts
    for (klass, name), quota in {("hot", "q"): 10, ("hot", "r"): 1999, ("a", "q"): 1}.items():
        cut = cuts[(klass, name)]
        inside = df.where(F.col("g") == klass).where(
            cut_key(["id"], 42) <= F.struct(F.lit(cut["h"]).alias("h"), F.lit(cut["id"]).alias("id"))).count()
        assert inside == quota


@pytest.mark.parametrize("n", [0, 1, 777, 6000, 9000])
def test_sample_size_is_exact_and_partitioning_does_not_matter(skewed, n):
    _, df = skewed
    one = {r["id"] for r in sample_rows(df.repartition(1), n, "id").collect()}
    many = {r["id"] for r in sample_rows(df.repartition(17), n, "id").collect()}
    assert one == many and len(one) == min(n, 6000)


def test_bucket_digits_grow_with_the_table():
    assert bucket_digits(0) == 2 and bucket_digits(10**9) == 4 and bucket_digits(10**12) == 5


def test_uniform_is_even(spark):
    u = spark.range(4000).select(uniform(order_hash("id", 1)).alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(u[0] - 0.5) < 0.02 and 0 <= u[1] < 0.01 and 0.99 < u[2] < 1


def test_quantiles_compute_their_input_once(spark):
    """After the count of rows, all scans read stored values: joins under the table are not repeated."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def told(x):
        calls.add(1)
        return float(x * 7919 % 30_011)

    df = spark.range(30_000).select(told.asNondeterministic()("id").alias("a"))
    row = exact_quantiles(df, ["a"], [0.25, 0.5, 0.75], direct_rows=1_000, accuracy=1_000).first()
    values = np.array([x * 7919 % 30_011 for x in range(30_000)], dtype=float)
    assert row["q"] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]))
    assert calls.value <= 2 * 30_000
