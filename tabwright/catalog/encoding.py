"""Encoding and scaling queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.catalog.registry import dbl, query, r6
from tabwright.functions.types import rounded
from tabwright.operators import encode

# Month numbers.
MONTH_MAP = {
    "January": 1, "February": 2, "March": 3, "April": 4, "May": 5, "June": 6, "July": 7, "August": 8, "September": 9,
    "October": 10, "November": 11, "December": 12, "Unknown": 0,
}
_MONTH_CASE = "CASE month " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in MONTH_MAP.items()) + " ELSE -1 END"


@query("e1_ordinal_map", f"SELECT row_id, CAST({_MONTH_CASE} AS INTEGER) AS month FROM v_blk")
def ordinal_map(t):
    rows = t.v_blk.select("row_id", "month")
    model = encode.FeatureEncoder({"month": "ordinal"}, {"month": {"order_map": MONTH_MAP}}).fit(rows)
    return model.transform(rows)


def _appearance(view, column):
    return f"""codes AS (SELECT value, row_number() OVER (ORDER BY first_row) - 1 AS code FROM (
  SELECT {column} AS value, min(row_id) AS first_row FROM {view} WHERE {column} IS NOT NULL GROUP BY 1) f)"""


@query("e2_ordinal_by_appearance", f"""
WITH {_appearance('v_blk', 'occ')} SELECT row_id, CAST(coalesce(code, -1) AS INTEGER) AS occ FROM v_blk LEFT JOIN codes ON occ = value""")
def ordinal_by_appearance(t):
    rows = t.v_blk.select("row_id", "occ")
    return encode.FeatureEncoder({"occ": "ordinal"}, order_col="row_id").fit(rows).transform(rows)


_EVENTS = ("click", "error", "purchase", "signup", "view")


@query("e3_one_hot", "SELECT row_id, " + ", ".join(
    f"CAST(CASE WHEN cat_n = '{e}' THEN 1 ELSE 0 END AS INTEGER) AS cat_n_{e}" for e in _EVENTS) + " FROM v_ev")
def one_hot(t):
    rows = t.v_ev.select("row_id", "cat_n")
    return encode.FeatureEncoder({"cat_n": "one-hot"}).fit(rows).transform(rows)


@query("e4_frequency", f"""
WITH f AS (SELECT p_name AS value, {dbl('count(*)')} / (SELECT count(p_name) FROM part) AS code FROM part GROUP BY 1)
SELECT p_partkey, {r6('coalesce(code, 0)')} AS p_name FROM part LEFT JOIN f ON p_name = value""")
def frequency(t):
    rows = t.part.select("p_partkey", "p_name")
    out = encode.FeatureEncoder({"p_name": "frequency"}).fit(rows).transform(rows)
    return out.select("p_partkey", rounded(F.col("p_name")).alias("p_name"))


_SIDE = "CASE WHEN row_id % 10 = 7 THEN NULL WHEN cat = '1-URGENT' THEN 'urgent' ELSE 'other' END"


@query("e5_binary", f"""
WITH s AS (SELECT row_id, {_SIDE} AS side FROM v_feat), {_appearance('s', 'side')}
SELECT row_id, CAST(coalesce(code, -1) AS INTEGER) AS side FROM s LEFT JOIN codes ON side = value""")
def binary(t):
    rows = t.v_feat.select("row_id", F.expr(_SIDE).alias("side"))
    return encode.FeatureEncoder({"side": "binary"}, order_col="row_id").fit(rows).transform(rows)


@query("e6_dispatch", f"""
WITH f AS (SELECT cat AS value, {dbl('count(*)')} / (SELECT count(cat) FROM v_feat WHERE row_id % 5 <> 0) AS code
           FROM v_feat WHERE row_id % 5 <> 0 GROUP BY 1)
SELECT row_id, {r6('coalesce(code, 0)')} AS cat, CAST(CASE leak WHEN 'zero' THEN 0 WHEN 'low' THEN 1 WHEN 'mid' THEN 2 ELSE 3 END AS INTEGER) AS leak
FROM v_feat LEFT JOIN f ON cat = value""")
def dispatch(t):
    spec = {
        "cat": {"strategy": "one-hot", "alternatives": ["frequency", "ordinal"]},
        "leak": {"strategy": "ordinal", "params": {"order_map": {"zero": 0, "low": 1, "mid": 2, "high": 3}}},
    }
    rows = t.v_feat.select("row_id", "cat", "leak")
    chosen, params = encode.encoding_spec(spec, rows.columns)
    encoder = encode.FeatureEncoder(chosen, params).set_params(hyperparams__cat="frequency")
    out = encoder.fit(rows.where(F.col("row_id") % 5 != 0)).transform(rows)
    return out.withColumn("cat", rounded(F.col("cat")))


_XS = ("x1", "x2", "x3", "x4")


@query("e9_standard_scale", "WITH m AS (SELECT " + ", ".join(f"avg({c}) AS {c}m, stddev_pop({c}) AS {c}s" for c in _XS)
       + " FROM v_feat) SELECT row_id, " + ", ".join(r6(f"({c} - {c}m) / {c}s") + f" AS {c}" for c in _XS) + " FROM v_feat, m")
def standard_scale(t):
    rows = t.v_feat.select("row_id", *_XS)
    out = encode.StandardScaler(_XS).fit(rows).transform(rows)
    return out.select("row_id", *[rounded(F.col(c)).alias(c) for c in _XS])


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("e10_one_hot_unseen", "SELECT row_id, " + ", ".join(
    f"CAST(CASE WHEN cat = '{p}' AND cat <> '5-LOW' THEN 1 ELSE 0 END AS INTEGER) AS k{i}" for i, p in enumerate(_PRIORITIES[:4]))
    + " FROM v_feat")
def one_hot_unseen(t):
    """Categories are learned without '5-LOW'; rows that hold it get zeros everywhere."""
    rows = t.v_feat.select("row_id", "cat")
    stages = [
        StringIndexer(inputCol="cat", outputCol="i", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="i", outputCol="v", dropLast=True),
    ]
    known = rows.where(F.col("cat") != "5-LOW")
    out = Pipeline(stages=stages).fit(known).transform(rows).withColumn("a", vector_to_array("v"))
    return out.select("row_id", *[F.col("a")[i].cast("int").alias(f"k{i}") for i in range(4)])


@query("e11_assemble", "WITH m AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x3) AS m3, stddev_pop(x3) AS s3 FROM v_feat) "
       f"SELECT row_id, {r6('(x1 - m1) / s1')} AS f0, {r6('(x3 - m3) / s3')} AS f1, "
       + ", ".join(f"CAST(CASE WHEN cat = '{p}' THEN 1 ELSE 0 END AS DOUBLE) AS f{i + 2}" for i, p in enumerate(_PRIORITIES))
       + " FROM v_feat, m")
def assemble(t):
    rows = t.v_feat.select("row_id", "x1", "x3", "cat")
    names = [encode.one_hot_name("cat", p) for p in _PRIORITIES]
    stages = [
        encode.StandardScaler(["x1", "x3"]), encode.FeatureEncoder({"cat": "one-hot"}),
        VectorAssembler(inputCols=["x1", "x3", *names], outputCol="features", handleInvalid="error"),
    ]
    out = Pipeline(stages=stages).fit(rows).transform(rows).withColumn("a", vector_to_array("features"))
    return out.select("row_id", *[rounded(F.col("a")[i]).alias(f"f{i}") for i in range(2 + len(names))])
