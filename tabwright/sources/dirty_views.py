"""Dirty, gapped, imbalanced views over clean tables.

The tables at hand hold no gaps, dirt or outliers, so these views derive them from the row keys. The
texts run unchanged in Spark SQL and in other engines; ``{name}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    # one dirty event per row; key row_id (dense, 0-based)
    "v_ev": """
SELECT event_id AS row_id, CAST(floor(event_id/8) AS BIGINT) AS blk, event_id % 8 AS pos, user_id,
       event_type AS cat,
       CASE WHEN event_id % 10 = 7 THEN NULL ELSE event_type END AS cat_n,
       value AS v,
       CASE WHEN event_id % 10 IN (3,4) OR CAST(floor(event_id/8) AS BIGINT) % 13 = 5 THEN NULL ELSE value END AS v_n,
       CASE event_id % 11 WHEN 0 THEN CAST(value AS STRING) || '_'
                          WHEN 1 THEN '_______'
                          WHEN 2 THEN NULL
                          WHEN 3 THEN '$' || CAST(value AS STRING)
                          WHEN 4 THEN '-' || CAST(value AS STRING)
                          ELSE CAST(value AS STRING) END AS raw
FROM {events}""",
    # columns with a pattern per block of eight rows; key row_id
    "v_blk": """
SELECT row_id, blk, pos,
       CASE WHEN row_id % 9 = 2 OR blk % 17 = 3 THEN NULL ELSE 'occ_' || CAST(blk % 21 AS STRING) END AS occ,
       CASE WHEN row_id % 7 = 1 THEN NULL
            ELSE CASE pos WHEN 0 THEN 'January' WHEN 1 THEN 'February' WHEN 2 THEN 'March' WHEN 3 THEN 'April'
                          WHEN 4 THEN 'May' WHEN 5 THEN 'June' WHEN 6 THEN 'July' ELSE 'August' END END AS month,
       CASE WHEN row_id % 5 = 1 THEN NULL
            ELSE CAST(blk % 30 AS DOUBLE) + CAST(pos AS DOUBLE) / CAST(12 AS DOUBLE) END AS age
FROM (SELECT event_id AS row_id, CAST(floor(event_id/8) AS BIGINT) AS blk, event_id % 8 AS pos FROM {events}) t""",
    # lists written as text; key row_id
    "v_multi": """
SELECT p_partkey AS row_id,
       CASE WHEN p_partkey % 5 = 0 THEN NULL
            ELSE p_type || ' Loan, ' || replace(p_name, ' ', ' Loan, and ') || ' Loan, ' || p_type || ' Loan' END AS items
FROM {part}""",
    # durations and glued words; key row_id
    "v_text": """
SELECT o_orderkey AS row_id,
       CASE WHEN o_orderkey % 9 = 4 THEN NULL WHEN o_orderkey % 17 = 3 THEN 'NA'
            ELSE CAST(o_orderkey % 30 AS STRING) || ' Years and ' || CAST(o_orderkey % 12 AS STRING) || ' Months' END AS hist,
       CASE o_orderkey % 4 WHEN 0 THEN 'MemoryStreet' WHEN 1 THEN 'Quality Street' WHEN 2 THEN NULL ELSE 'FleetStreet' END AS street
FROM {orders}""",
    # labelled rows with outliers, a category that gives the class away and a rule-based prediction; key row_id
    "v_feat": """
SELECT row_id, grp, x1, x2, x3, x4, cat, label,
       CASE label WHEN 0 THEN 'zero' WHEN 1 THEN 'low' WHEN 2 THEN 'mid' ELSE 'high' END AS leak,
       CASE WHEN row_id % 13 = 0 THEN (label + 1) % 4 ELSE label END AS pred
FROM (SELECT o_orderkey AS row_id, o_custkey AS grp,
             CASE WHEN o_orderkey % 500 = 0 THEN o_totalprice * 50 ELSE o_totalprice END AS x1,
             CAST(o_orderkey % 97 AS DOUBLE) AS x2,
             c_acctbal AS x3,
             CAST(CASE WHEN o_orderkey % 200 = 0 THEN 0 WHEN o_orderkey % 10 < 3 THEN 1 WHEN o_orderkey % 10 < 8 THEN 2 ELSE 3 END AS DOUBLE) * 10
               + CAST(o_orderkey % 17 AS DOUBLE) AS x4,
             o_orderpriority AS cat,
             CASE WHEN o_orderkey % 200 = 0 THEN 0 WHEN o_orderkey % 10 < 3 THEN 1 WHEN o_orderkey % 10 < 8 THEN 2 ELSE 3 END AS label
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey) t""",
    # real imbalanced labels with a sensitive-style group column; key row_id
    "v_doc": """
SELECT d.doc_id AS row_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars, l.quality, l.toxic
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Tables of one scale folder, and the views over them, as attributes or by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            text = VIEWS[name]
            return self.spark.sql(text, **{t: getattr(self, t) for t in TABLES if "{" + t + "}" in text})
        raise AttributeError(name)


def view_sql(name: str) -> str:
    """The view over tables that are known by their own names."""
    return VIEWS[name].format(**{t: t for t in TABLES})
