"""Sources, sinks, sampling, projection and filtering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.registry import query
from tabwright.functions.state import scratch_path
from tabwright.functions.text import LIST_SEPARATOR
from tabwright.functions.types import (
    columns_matching, get_categorical_features, get_numerical_features, split_features_target,
)
from tabwright.operators import relational
from tabwright.operators.cleaning import get_unique_values_and_counts, transform_to_binary_features
from tabwright.sources import files

LIST_MEMBERS = rf"""SELECT DISTINCT unnest(list_filter(list_transform(
    regexp_split_to_array(items, '{LIST_SEPARATOR}'), lambda x: trim(x)), lambda x: x <> '')) AS value FROM v_multi"""


def list_members(t) -> list[str]:
    """All members found in the list column (few: they become columns)."""
    return sorted(r["value"] for r in get_unique_values_and_counts(t.v_multi, "items").select("value").collect())


def long_flags(flagged, flags):
    """One row per flag column, since the columns depend on the data."""
    return flagged.select("row_id", F.inline(F.array(*[F.struct(F.lit(c).alias("flag"), F.col(f"`{c}`").alias("value")) for c in flags])))


@query("s1_load_csv", "SELECT row_id, cat_n, v_n, raw FROM v_ev")
def load_csv(t):
    written = t.v_ev.select("row_id", F.coalesce("cat_n", F.lit("NA")).alias("cat_n"),
                            F.coalesce(F.col("v_n").cast("string"), F.lit("NaN")).alias("v_n"), "raw")
    path = scratch_path(t.spark, "events.csv")
    written.write.option("header", True).csv(path)
    return files.load_data(t.spark, path, "row_id bigint, cat_n string, v_n double, raw string")


@query("s1_load_csv_inferred", "SELECT row_id, cat_n, v_n, CASE WHEN cat_n IS NULL THEN NULL ELSE cat_n || ', \"x\"' || chr(10) || 'y' END AS noted FROM v_ev")
def load_csv_inferred(t):
    noted = F.concat(F.col("cat_n"), F.lit(', "x"\ny'))
    written = t.v_ev.select("row_id", F.coalesce("cat_n", F.lit("NULL")).alias("cat_n"),
                            F.coalesce(F.col("v_n").cast("string"), F.lit("NULL")).alias("v_n"), noted.alias("noted"))
    path = files.save_processed_data(written, scratch_path(t.spark, "inferred.csv"))
    return files.load_data(t.spark, path)


@query("s2_load_processed", "SELECT row_id, grp, x1, x2, x3, x4, cat, label FROM v_feat")
def load_processed(t):
    columns = ["row_id", "grp", "x1", "x2", "x3", "x4", "cat", "label"]
    path = files.save_processed_data(t.v_feat.select(columns), scratch_path(t.spark, "curated"))
    return files.load_processed_data(t.spark, path)


@query("s3_save_processed", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem")
def save_processed(t):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]
    path = files.save_processed_data(t.lineitem.select(columns), scratch_path(t.spark, "lineitem.csv"))
    return files.load_processed_data(
        t.spark, path,
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_returnflag string",
    )


@query("s4_dataset_overview", """
WITH one AS (SELECT count(*) AS n_rows, count(row_id) AS a, count(cat) AS b, count(cat_n) AS c, count(v_n) AS d, count(raw) AS e FROM v_ev)
SELECT CAST(position AS INTEGER) AS position, column_name, dtype, n_rows, CAST(5 AS INTEGER) AS n_columns, non_null FROM (
  SELECT 0 AS position, 'row_id' AS column_name, 'bigint' AS dtype, n_rows, a AS non_null FROM one
  UNION ALL SELECT 1, 'cat', 'string', n_rows, b FROM one
  UNION ALL SELECT 2, 'cat_n', 'string', n_rows, c FROM one
  UNION ALL SELECT 3, 'v_n', 'double', n_rows, d FROM one
  UNION ALL SELECT 4, 'raw', 'string', n_rows, e FROM one) u
""")
def overview(t):
    return files.dataset_overview(t.v_ev.select("row_id", "cat", "cat_n", "v_n", "raw"))


@query("s5_sample_rows", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 2500
""")
def sample(t):
    return relational.sample_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 2500, "o_orderkey")


@query("p1_drop_columns", "SELECT row_id, x1, x2, x3, x4, cat, label, pred FROM v_feat")
def drop(t):
    return relational.drop_columns(t.v_feat, ["grp", "leak"])


@query("p2_rename_columns", "SELECT row_id, grp, x1 AS amount, x2 AS months, x3, x4, cat, label, leak, pred FROM v_feat")
def rename(t):
    return relational.rename_columns(t.v_feat, {"x1": "amount", "x2": "months"})


@query("p3_numeric_columns", "SELECT row_id, grp, x1, x2, x3, x4, label, pred FROM v_feat")
def numeric(t):
    return t.v_feat.select(get_numerical_features(t.v_feat))


@query("p4_categorical_columns", "SELECT cat, leak FROM v_feat")
def categorical(t):
    return t.v_feat.select(get_categorical_features(t.v_feat))


@query("p5_columns_by_pattern", f"""
SELECT row_id, 'Has_' || replace(value, ' ', '_') AS flag, CAST(contains(coalesce(items, ''), value) AS INTEGER) AS value
FROM v_multi CROSS JOIN (SELECT min(value) AS value FROM ({LIST_MEMBERS}) d GROUP BY lower(value)) m WHERE contains(value, 'Loan')
""")
def by_pattern(t):
    # column names do not differ in case: of members that do, the first one is flagged
    first = {v.lower(): v for v in reversed(list_members(t))}
    flagged = transform_to_binary_features(t.v_multi, "items", sorted(first.values()))
    return long_flags(flagged, columns_matching(flagged, contains=["Loan"], prefix="Has_"))


@query("p6_features_and_target", "SELECT x1, x2, x3, x4, cat, label AS target FROM v_feat")
def features_target(t):
    features, target = split_features_target(t.v_feat.drop("row_id", "grp", "leak", "pred"), "label")
    return t.v_feat.select(*features, F.col(target).alias("target"))


@query("p7_null_out", "SELECT row_id, CASE WHEN x1 > 300000 OR x3 < 0 THEN NULL ELSE x1 END AS x1, x3 FROM v_feat")
def null_out(t):
    return relational.null_out(t.v_feat.select("row_id", "x1", "x3"), "x1", (F.col("x1") > 300000) | (F.col("x3") < 0))


@query("p8_keep_top_categories", """
SELECT p_name, p_partkey, p_retailprice FROM part WHERE p_name IN (
  SELECT p_name FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 10)
""")
def top_categories(t):
    return relational.keep_top_categories(t.part.select("p_name", "p_partkey", "p_retailprice"), "p_name", 10)


@query("p9_preview", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 15
""")
def preview(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return relational.preview(t.lineitem.select(*keys, "l_quantity"), keys, 15)
