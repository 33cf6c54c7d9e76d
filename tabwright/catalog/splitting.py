"""Split, fold and oversampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.registry import query, r6
from tabwright.functions.types import rounded
from tabwright.operators import balance, split


def _quota(name, source, size, total):
    """Largest-remainder shares of ``total`` rows over the classes of ``source``."""
    return f"""{name}_base AS (SELECT label, {size} AS n, ({total}) AS t, (SELECT sum({size}) FROM {source}) AS whole FROM {source}),
{name}_floor AS (SELECT label, n, t, CAST(floor(t * n / whole) AS BIGINT) AS f, (t * n) % whole AS rem FROM {name}_base),
{name} AS (SELECT label, n, f + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= t - (SELECT sum(f) FROM {name}_floor)
           THEN 1 ELSE 0 END AS q FROM {name}_floor)"""


_RANKED = """counts AS (SELECT label, CAST(count(*) AS BIGINT) AS c FROM {v} GROUP BY label),
ranked AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) AS rn FROM {v})"""
_TEST_QUOTA = _quota("test", "counts", "c", "SELECT CAST(ceil(0.2 * sum(c)) AS BIGINT) FROM counts")


@query("t1_stratified_three_way", f"""
WITH {_RANKED.format(v='v_feat')}, {_TEST_QUOTA},
rest AS (SELECT label, n - q AS r FROM test),
{_quota('val', 'rest', 'r', 'SELECT CAST(ceil(0.2 * sum(r)) AS BIGINT) FROM rest')}
SELECT row_id, ranked.label, CASE WHEN rn <= test.q THEN 'test' WHEN rn <= test.q + val.q THEN 'validation' ELSE 'train' END AS split
FROM ranked JOIN test ON ranked.label = test.label JOIN val ON ranked.label = val.label""")
def three_way(t):
    return split.stratified_split(t.v_feat.select("row_id", "label"), "label", "row_id")


@query("t2_group_split", """
WITH keys AS (SELECT DISTINCT grp FROM v_feat),
ranked AS (SELECT grp AS g, row_number() OVER (ORDER BY md5('42:' || CAST(grp AS VARCHAR)), grp) AS rn, count(*) OVER () AS n FROM keys),
cuts AS (SELECT g, rn, ceil(0.2 * n) AS a, ceil(0.2 * n) + ceil(0.2 * (n - ceil(0.2 * n))) AS b FROM ranked)
SELECT row_id, label, CASE WHEN rn <= a THEN 'test' WHEN rn <= b THEN 'validation' ELSE 'train' END AS split
FROM v_feat JOIN cuts ON grp = g""")
def by_group(t):
    return split.group_split(t.v_feat.select("row_id", "grp", "label"), "grp")


@query("t3_stratified_two_way", f"""
WITH {_RANKED.format(v='docs')}, {_TEST_QUOTA}
SELECT row_id, ranked.label, CASE WHEN rn <= test.q THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN test ON ranked.label = test.label""".replace("WITH ", "WITH docs AS (SELECT row_id, quality AS label FROM v_doc), "))
def two_way(t):
    rows = t.v_doc.select("row_id", F.col("quality").alias("label"))
    return split.stratified_split(rows, "label", "row_id", 0.2, None)


@query("t4_stratified_folds", f"""
WITH {_RANKED.format(v='v_feat')}
SELECT row_id, ranked.label, CAST(floor((rn - 1) * 5 / c) AS INTEGER) AS fold FROM ranked JOIN counts ON ranked.label = counts.label""")
def folds(t):
    return split.stratified_folds(t.v_feat.select("row_id", "label"), "label", "row_id", 5)


def _smote(source, xs, k, seed):
    """Oversampling to the largest class, spelled out: quotas, neighbours, picks, interpolation."""
    dist = "round(sqrt(" + " + ".join(f"(b.{x} - d.{x}) * (b.{x} - d.{x})" for x in xs) + "), 9)"
    u = "CAST(('0x' || substr({h}, {p}, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"
    pick = f"CAST(floor({u.format(h='h', p=1)} * {k}) AS BIGINT) + 1"
    return f"""sizes AS (SELECT label, count(*) AS n FROM {source} GROUP BY label),
need AS (SELECT label AS l, n, (SELECT max(n) FROM sizes) - n AS q FROM sizes),
ranked AS (SELECT s.*, n, q, row_number() OVER (PARTITION BY label ORDER BY md5('{seed}:' || CAST(row_id AS VARCHAR)), row_id) AS rn
           FROM {source} s JOIN need ON label = l WHERE q > 0),
bases AS (SELECT *, CAST(floor(q / n) AS BIGINT) + CASE WHEN rn <= q % n THEN 1 ELSE 0 END AS copies FROM ranked),
near AS (SELECT b.row_id AS rid, d.row_id AS did, row_number() OVER (PARTITION BY b.row_id ORDER BY {dist}, d.row_id) AS place
         FROM bases b JOIN ranked d ON b.label = d.label AND b.row_id <> d.row_id WHERE b.copies > 0 QUALIFY place <= {k}),
copies AS (SELECT *, unnest(generate_series(1, copies)) AS copy_no FROM bases WHERE copies > 0),
draws AS (SELECT *, md5('{seed}:' || CAST(row_id AS VARCHAR) || ':' || CAST(copy_no AS VARCHAR)) AS h FROM copies),
made AS (SELECT c.row_id AS source_id, c.copy_no, {", ".join(f"c.{x} + {u.format(h='h', p=9)} * (d.{x} - c.{x}) AS {x}" for x in xs)}, c.label
         FROM draws c JOIN near ON rid = c.row_id AND place = {pick} JOIN {source} d ON d.row_id = did)
SELECT source_id, CAST(copy_no AS INTEGER) AS copy_no, {", ".join(r6(x) + f" AS {x}" for x in xs)}, label FROM (
  SELECT row_id AS source_id, 0 AS copy_no, {", ".join(xs)}, label FROM {source} UNION ALL SELECT * FROM made) u"""


_XS = ("x1", "x2", "x3")


@query("t5_smote", "WITH s AS (SELECT row_id, x1, x2, x3, label FROM v_feat), " + _smote("s", _XS, 5, 42))
def smote(t):
    out = balance.SMOTEBalancer("auto", 5, 42).fit_resample(t.v_feat, list(_XS), "label", "row_id")
    return out.select("source_id", "copy_no", *[rounded(F.col(x)).alias(x) for x in _XS], "label")


@query("t5_smote_class_counts", """
WITH sizes AS (SELECT quality AS label, count(*) AS n FROM v_doc GROUP BY 1)
SELECT label, CAST((SELECT max(n) FROM sizes) AS BIGINT) AS rows, (SELECT max(n) FROM sizes) - n AS synthetic FROM sizes""")
def smote_counts(t):
    out = balance.SMOTEBalancer("not majority", 3, 7).fit_resample(t.v_doc, ["n_chars"], "quality", "row_id")
    return out.groupBy(F.col("quality").alias("label")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("copy_no") > 0).alias("synthetic"))


@query("t6_sampling_strategy", """
WITH sizes AS (SELECT label AS class_value, count(*) AS n_rows FROM v_feat GROUP BY label), big AS (SELECT max(n_rows) AS m, min(n_rows) AS s FROM sizes)
SELECT 'auto' AS strategy, class_value, n_rows, m - n_rows AS n_synthetic FROM sizes, big
UNION ALL SELECT 'minority', class_value, n_rows, CASE WHEN n_rows = s THEN m - n_rows ELSE 0 END FROM sizes, big
UNION ALL SELECT 'not minority', class_value, n_rows, CASE WHEN n_rows = s THEN 0 ELSE m - n_rows END FROM sizes, big
UNION ALL SELECT 'all', class_value, n_rows, m - n_rows FROM sizes, big
UNION ALL SELECT 'sizes', class_value, n_rows, CASE WHEN class_value = 0 THEN 1000 - n_rows ELSE 0 END FROM sizes, big""")
def strategies(t):
    wanted = {"auto": "auto", "minority": "minority", "not minority": "not minority", "all": "all", "sizes": {0: 1000}}
    out = None
    for name, strategy in wanted.items():
        rows = balance.resolve_sampling_strategy(t.v_feat, "label", strategy).withColumn("strategy", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out
