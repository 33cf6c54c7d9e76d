"""Encoders, scalers, outliers and splits: fit on one table, apply to another."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import encode, outliers, split
from tabwright.operators.impute import SimpleImputer, impute_missing_values_for_categorical_features


@pytest.fixture(scope="module")
def train(spark):
    rows = [(0, "b", 1.0), (1, "a", 2.0), (2, "b", 3.0), (3, None, 4.0), (4, "b", 100.0)]
    return spark.createDataFrame(rows, "i int, c string, x double").repartition(3)


@pytest.fixture(scope="module")
def fresh(spark):
    return spark.createDataFrame([(9, "a", 5.0), (10, "zzz", None), (11, None, -900.0)], "i int, c string, x double")


def codes(frame, column="c"):
    return [r[column] for r in frame.orderBy("i").collect()]


def test_given_order(train, fresh):
    model = encode.FeatureEncoder({"c": "ordinal"}, {"c": {"order_map": {"a": 5, "b": 7}}}).fit(train)
    assert codes(model.transform(train)) == [7, 5, 7, -1, 7] and codes(model.transform(fresh)) == [5, -1, -1]


def test_order_of_appearance(train, fresh):
    model = encode.FeatureEncoder({"c": "ordinal"}, order_col="i").fit(train)
    assert codes(model.transform(train)) == [0, 1, 0, -1, 0] and codes(model.transform(fresh)) == [1, -1, -1]
    assert codes(encode.FeatureEncoder({"c": "binary"}, order_col="i").fit(train).transform(fresh)) == [1, -1, -1]


def test_frequency(train, fresh):
    model = encode.FeatureEncoder({"c": "frequency"}).fit(train)
    assert codes(model.transform(train)) == [0.75, 0.25, 0.75, 0.0, 0.75] and codes(model.transform(fresh)) == [0.25, 0.0, 0.0]


def test_frequency_of_many_values_is_joined(spark):
    df = spark.range(400).select(F.col("id").alias("i"), F.concat(F.lit("v"), F.col("id") % 100).alias("c"))
    model = encode.FeatureEncoder({"c": "frequency"}).fit(df)
    out = model.transform(df)
    assert out.columns == ["i", "c"] and set(codes(out)) == {0.01}


def test_one_hot_uses_fitted_categories(train, fresh):
    model = encode.FeatureEncoder({"c": "one-hot"}).fit(train)
    out = model.transform(fresh)
    assert out.columns == ["i", "x", "c_a", "c_b"]
    assert [tuple(r)[2:] for r in out.orderBy("i").collect()] == [(1, 0), (0, 0), (0, 0)]


def test_dispatch_and_errors(train):
    encoder = encode.FeatureEncoder({"c": ("one-hot", ["frequency"])})
    assert "c_a" in encoder.fit(train).transform(train).columns
    assert "c_a" not in encoder.set_params(hyperparams__c="frequency").fit(train).transform(train).columns
    with pytest.raises(ValueError, match="unknown encoding"):
        encode.FeatureEncoder({"c": "hashing"}).fit(train)
    with pytest.raises(ValueError, match="2 categories, got 3"):
        three = train.withColumn("c", F.col("i").cast("string")).where("i < 3")
        encode.FeatureEncoder({"c": "binary"}, order_col="i").fit(three)
    with pytest.warns(UserWarning, match="not in the table"):
        assert encode.FeatureEncoder({"nope": "frequency"}).fit(train).transform(train).columns == train.columns
    with pytest.warns(UserWarning):
        chosen, params = encode.encoding_spec({"c": {"strategy": "ordinal", "alternatives": ["frequency"], "params": {"p": 1}},
                                               "gone": {"strategy": "binary"}}, ["c"])
    assert chosen == {"c": ("ordinal", ["frequency"])} and params == {"c": {"p": 1}}


def test_scaling_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = encode.StandardScaler(["a", "b"]).fit(df).transform(df).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_clip_uses_training_moments(train, fresh):
    model = outliers.OutlierHandler("clip", 1.0, exclude=["i"]).fit(train)
    low, high = model.bounds()["x"]
    assert codes(model.transform(fresh), "x") == [5.0, None, low] and max(codes(model.transform(train), "x")) == high
    assert outliers.OutlierHandler().fit(train).transform(fresh).collect() == fresh.collect()
    with pytest.raises(ValueError, match="constant"):
        outliers.OutlierHandler("clip").fit(train.select(F.lit(1.0).alias("k")))
    with pytest.raises(ValueError, match="no numeric"):
        outliers.OutlierHandler("clip").fit(train.select("c"))
    with pytest.raises(ValueError, match="strategy"):
        outliers.OutlierHandler("cap").fit(train)


def test_simple_imputers(train, fresh):
    both = SimpleImputer("most_frequent", ["c"]).fit(train).transform(SimpleImputer("median", ["x"]).fit(train).transform(fresh))
    assert codes(both) == ["a", "zzz", "b"] and codes(both, "x") == [5.0, 3.0, -900.0]


def test_fill_by_method_continues_after_a_complete_column(spark):
    df = spark.createDataFrame([(0, "a", None), (1, "b", "x")], "i int, full string, gappy string")
    out = impute_missing_values_for_categorical_features(df, ["full", "gappy"], {"full": "knn", "gappy": "unknown_category"})
    assert codes(out, "gappy") == ["Unknown", "x"]
    with pytest.raises(ValueError, match="no valid imputation method"):
        impute_missing_values_for_categorical_features(df, ["full"], {})


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(1003).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "rare").otherwise("usual").alias("y"),
        (F.col("id") % 97).alias("who"),
    )


def test_share_out():
    assert split.share_out(201, [335, 14, 654]) == [67, 3, 131]
    assert split.share_out(2, [1, 1, 1]) == [1, 1, 0] and split.share_out(0, []) == []


def test_stratified_split_is_complete_exact_and_stable(labelled):
    a = split.stratified_split(labelled.repartition(1), "y", "id").cache()
    b = split.stratified_split(labelled.repartition(17), "y", "id")
    assert a.exceptAll(b).count() == 0 and a.count() == 1003
    sizes = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert sizes == {"test": 201, "validation": 161, "train": 641}
    shares = a.groupBy("y").agg(F.avg((F.col("split") == "test").cast("double")).alias("s")).collect()
    assert all(abs(r["s"] - 0.2) < 0.05 for r in shares)


def test_group_split_keeps_entities_together(labelled):
    out = split.group_split(labelled, "who", drop_group=False)
    assert out.groupBy("who").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0
    sizes = {r["split"]: r["k"] for r in out.groupBy("split").agg(F.count_distinct("who").alias("k")).collect()}
    assert sizes == {"test": 20, "validation": 16, "train": 61}
    assert "who" not in split.group_split(labelled, "who").columns


def test_folds_are_even_within_classes(labelled):
    out = split.stratified_folds(labelled, "y", "id", 4)
    sizes = out.groupBy("y", "fold").count().groupBy("y").agg(
        F.max("count").alias("hi"), F.min("count").alias("lo"), F.count("fold").alias("k")).collect()
    assert all(r["hi"] - r["lo"] <= 1 and r["k"] == 4 for r in sizes)
