"""No size, key or id may break an operator: ties, missing ids, many categories, odd files."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import blocks, encode, impute
from tabwright.operators.ranking import with_position
from tabwright.sources import files


@pytest.mark.parametrize("key", ["null", "same", "mixed"])
def test_equal_keys_spread_over_buckets(spark, key):
    value = {"null": F.lit(None).cast("long"), "same": F.lit(7), "mixed": F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id"))}[key]
    df = spark.range(100_000).withColumn("v", value)
    ranked = with_position(df, "v", ["id"], "rn", rows_per_bucket=1000)
    assert ranked.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first() == (0, 99_999, 100_000)
    wrong = ranked.join(ranked.select((F.col("rn") - 1).alias("rn"), F.col("v").alias("w"), F.col("id").alias("j")), "rn")
    assert wrong.where("(v IS NOT NULL AND w IS NULL) OR v > w OR (v <=> w AND id > j)").count() == 0
    dealt = df.withColumn("t", F.xxhash64("v", "id")).repartitionByRange(100, F.col("v").asc_nulls_first(), "id")
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 5000


def test_blocks_in_an_order_with_ties(spark):
    df = spark.createDataFrame([(k, k // 16, float(k % 16 % 8) if k % 5 else None) for k in range(160)], "id long, at long, v double")
    one = blocks.blocked(df, 8, order_col="at").select("id", blocks.BLOCK, blocks.PLACE).collect()
    two = blocks.blocked(df.repartition(7, "v"), 8, order_col="at").select("id", blocks.BLOCK, blocks.PLACE).collect()
    assert sorted(one) == sorted(two)


def rows_with_gap(spark, ids):
    return spark.createDataFrame([(i, float(k), None if k in (3, 4) else 2.0 * k) for k, i in enumerate(ids)], "id long, a double, b double")


@pytest.mark.parametrize("ids", [[0, 1, 2, None, 4, 5, 6], [0, 1, 2, 3, 3, 5, 6]])
def test_gaps_need_an_id_of_their_own(spark, ids):
    df = rows_with_gap(spark, ids)
    with pytest.raises(ValueError, match="one id each"):
        impute.impute_knn(df, "b", 2, id_col="id")
    filled, report = impute.apply_and_evaluate_knn_imputation(df, ["b"], k=2, id_col="id")
    assert filled.count() == 7 and report.first()["error"] and filled.where("b IS NULL").count() == 2


def test_ids_of_rows_without_a_gap_do_not_matter(spark):
    df = rows_with_gap(spark, [None, 1, 1, 3, 4, None, 6])
    filled = impute.impute_knn(df, "b", 2, id_col="id")
    assert filled.count() == 7 and filled.where("b IS NULL").count() == 0


def test_any_failure_of_a_column_is_reported(spark):
    df = rows_with_gap(spark, range(7)).withColumn("c", F.lit("text")).withColumn("d", F.when(F.col("a") == 2, None).otherwise(F.col("a")))
    filled, report = impute.apply_and_evaluate_knn_imputation(df, ["b", "c", "nowhere", "d"], k=2, id_col="id")
    errors = {r["column_name"]: r["error"] for r in report.collect()}
    assert errors["b"] is None and errors["d"] is None and errors["c"] and errors["nowhere"]
    assert filled.count() == 7 and filled.where("b IS NULL OR d IS NULL").count() == 0 and filled.columns == df.columns


def test_many_categories_become_a_sparse_vector(spark):
    df = spark.range(20_001).select("id", F.concat(F.lit("c"), F.col("id")).alias("k"))
    model = encode.FeatureEncoder({"k": "one-hot"}, one_hot="vector").fit(df)
    out = model.transform(df.limit(50).union(spark.createDataFrame([(-1, "unknown"), (-2, None)], "id long, k string"))).collect()
    assert out[0]["k_onehot"].size == 20_001
    assert all(len(r["k_onehot"].indices) == (r["id"] >= 0) for r in out)
    assert len({int(r["k_onehot"].indices[0]) for r in out if r["id"] >= 0}) == 50


def test_codes_of_a_feature_without_values_are_whole(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, k string")
    model = encode.FeatureEncoder({"k": "ordinal"}, order_col="id").fit(df)
    assert model.transform(df).schema["k"].dataType.simpleString() == "int"


def test_csv_with_missing_words_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,n,b,s\n1,NULL,true,"two\nlines"\n2,4,n/a,"say ""hi"", you"\n3,2.5,false,None\n')
    out = files.load_data(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "double", "boolean", "string"]
    rows = out.orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, True, "two\nlines"), (2, 4.0, None, 'say "hi", you'), (3, 2.5, False, None)]
    again = files.load_data(spark, files.save_processed_data(out, str(tmp_path / "u.csv")), out.schema)
    assert again.orderBy("id").collect() == rows


def odd_csv(rows):
    lines = ["id,text,n"]
    for k in range(rows):
        text = ["plain", '"two\nlines"', '"say ""hi"",\n\n""\nend"', "", '"\r\nodd\r\n"', '"a,b"', "NULL"][k % 7]
        lines.append(f"{k},{text},{k % 5 if k % 11 else ''}")
    return "\n".join(lines) + "\n"


def test_split_csv_equals_the_whole_read(spark, tmp_path):
    """Splits of a few hundred bytes start inside quotes, inside doubled quotes and inside empty lines."""
    (tmp_path / "t.csv").write_bytes(odd_csv(3000).encode())
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "t.csv"))
    want = sorted((int(r["id"]), None if r["text"] in ("NULL", "") else r["text"], r["n"] and int(r["n"])) for r in whole.collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (400, 5000, 10**8):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            frame = files.load_data(spark, str(tmp_path / "t.csv"), "id int, text string, n int")
            tasks, got = frame.rdd.getNumPartitions(), sorted(tuple(r) for r in frame.collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert got == want and (size > 400 or tasks > 100)


def test_one_quoted_value_over_many_splits(spark, tmp_path):
    long = "x\n" * 4000
    (tmp_path / "t.csv").write_text(f'a,b\n1,"{long}"\n2,y\n3,"{long}{long}"\n4,z\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = {r["a"]: r["b"] for r in files.load_data(spark, str(tmp_path / "t.csv")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {1: long, 2: "y", 3: long + long, 4: "z"}


def test_csv_folders_and_headers(spark, tmp_path):
    """Every file of a folder has a header of its own; another header is an error; a file of a header only has no rows."""
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for k in range(3):
        (folder / f"part-{k}.csv").write_bytes(f'i,s\r\n{k},"a\r\nb"\r\n'.encode())
    (folder / "part-9.csv").write_text("i,s\n")
    assert sorted(tuple(r) for r in files.load_data(spark, str(folder)).collect()) == [(k, "a\r\nb") for k in range(3)]
    (folder / "part-5.csv").write_text("s,i\nx,1\n")
    with pytest.raises(Exception, match="instead of"):
        files.load_data(spark, str(folder), "i int, s string").collect()


def test_distinct_values_of_many_columns_from_one_scan(spark, monkeypatch):
    """All types, gaps, NaN and both zeros; tasks that hold few values; one scan and no row per column and row."""
    from tabwright.operators import profile

    n = 3000
    df = spark.range(n).selectExpr(
        "id", "cast(id % 7 AS double) - 3 AS d", "if(id % 2 = 0, 0.0D, -0.0D) AS z", "if(id % 5 = 0, double('NaN'), id % 4) AS nan",
        "if(id % 3 = 0, NULL, cast(id % 100 AS string)) AS s", "cast(NULL AS int) AS nothing", "id % 2 = 0 AS b", "timestamp_seconds(id % 50) AS t",
        "cast(cast(id % 9 AS string) AS binary) AS y", "cast(id % 13 AS decimal(20,2)) AS m", "array(id % 3, NULL) AS a", *[f"id % {k} AS c_{k}" for k in range(2, 60)])
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = df.repartition(4)
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    seen = df.mapInArrow(counted, df.schema)
    for held in (profile.HELD_VALUES, 500):
        monkeypatch.setattr(profile, "HELD_VALUES", held)
        read.value = 0
        found = profile.cardinality(seen, df.columns)
        got = {r["feature"]: r["n_unique"] for r in found.collect()}
        assert got == want and read.value == n
    assert profile.cardinality(df.select(df.d.alias("d.d")), ["d.d"]).first()["n_unique"] == 7
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_one_hot_shape_does_not_depend_on_the_number_of_categories(spark):
    def shape(n, output):
        df = spark.range(n).selectExpr("id", "concat('v', id) AS k")
        return encode.FeatureEncoder({"k": "one-hot"}, one_hot=output).fit(df).transform(df)

    few, many = shape(3, "vector"), shape(20_001, "vector")
    assert few.schema.simpleString() == many.schema.simpleString() == "struct<id:bigint,k_onehot:vector>"
    assert {r["k_onehot"].size for r in many.limit(5).collect()} == {20_001}
    assert shape(3, "columns").columns == ["id", "k_v0", "k_v1", "k_v2"] and len(shape(1200, "columns").columns) == 1201
    none = spark.createDataFrame([(1, None)], "id int, k string")
    assert encode.FeatureEncoder({"k": "one-hot"}, one_hot="vector").fit(none).transform(none).first()["k_onehot"].size == 0
    with pytest.raises(ValueError, match="one-hot output"):
        encode.FeatureEncoder({"k": "one-hot"}, one_hot="both")
