"""Neighbour search against brute force, with cells, chunks and blocks forced small."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.operators import impute, knn
from tabwright.operators.balance import SMOTEBalancer, resolve_sampling_strategy, synthetic_counts
from tabwright.operators.knn import k_nearest

FORCED = dict(donors_per_pivot=25, chunk_rows=40, block_rows=30)


def brute(points, ask, give, k, within=None, exclude_self=False):
    out = {}
    for r in ask:
        cand = [(round(float(np.sqrt(((points[r] - points[d]) ** 2).sum())), 9), d) for d in give
                if (within is None or within[r] == within[d]) and not (exclude_self and r == d)]
        out[r] = [d for _, d in sorted(cand)[:k]]
    return out


@pytest.fixture(scope="module")
def cloud(spark):
    """A third of the points are copies of one vector, a third lie in a tight cluster."""
    draw = np.random.default_rng(5)
    n = 600
    points = draw.normal(0, 10, (n, 3))
    points[::3] = [1.0, 2.0, 3.0]
    points[1::3] = np.round(draw.normal(5, 0.05, (len(points[1::3]), 3)), 2)
    group = draw.choice(["a", "b"], n, p=[0.8, 0.2])
    table = pd.DataFrame({"id": np.arange(n), "vec": list(points), "grp": group, "y": draw.normal(0, 1, n)})
    return points, group, spark.createDataFrame(pa.Table.from_pandas(table, preserve_index=False)).repartition(5)


def neighbours(frame):
    return {r["id"]: [n["did"] for n in r["neighbours"]] for r in frame.collect()}


@pytest.mark.parametrize("options", [{}, FORCED, dict(FORCED, max_pivots=3)])
def test_all_neighbours(cloud, options):
    points, _, df = cloud
    ask, give = df.where("id % 4 = 1"), df.where("id % 4 <> 1")
    got = neighbours(k_nearest(ask, give, 4, id_col="id", vector_col="vec", payload="y", **options))
    ids = np.arange(len(points))
    assert got == brute(points, ids[ids % 4 == 1], ids[ids % 4 != 1], 4)


@pytest.mark.parametrize("options", [{}, FORCED])
def test_neighbours_within_group_without_self(cloud, options):
    points, group, df = cloud
    got = neighbours(k_nearest(df, df, 3, id_col="id", vector_col="vec", within="grp", exclude_self=True, **options))
    ids = np.arange(len(points))
    assert got == brute(points, ids, ids, 3, group, True)


def test_more_neighbours_than_donors(cloud):
    points, _, df = cloud
    got = neighbours(k_nearest(df.where("id < 5"), df.where("id >= 594"), 50, id_col="id", vector_col="vec", **FORCED))
    assert all(sorted(v) == list(range(594, 600)) for v in got.values()) and len(got) == 5


def test_receivers_without_donors_keep_their_row(cloud):
    _, _, df = cloud
    ask, give = df.where("id < 60"), df.where("grp = 'a' and id >= 60")
    got = neighbours(k_nearest(ask, give, 2, id_col="id", vector_col="vec", within="grp", payload="y"))
    assert set(got) == set(range(60))
    assert {len(v) for k, v in got.items()} == {0, 2}
    none = k_nearest(ask.where("id < 0"), give, 2, id_col="id", vector_col="vec", payload="y")
    assert none.count() == 0 and "payload" in none.schema["neighbours"].dataType.elementType.names


GAPS = [
    (0, 1.0, 10.0, "a", 100.0), (1, 2.0, None, "b", 200.0), (2, None, 30.0, "c", None), (3, 4.0, 40.0, None, 400.0),
    (4, 5.0, 50.0, "e", None), (5, 6.0, None, "f", 600.0), (6, None, 70.0, "g", 700.0), (7, 8.0, 80.0, None, 800.0),
    (8, None, 90.0, "i", 900.0), (9, 10.0, 100.0, "j", 1000.0),
]
SHAPE = "id int, numeric1 double, numeric2 double, categorical string, numeric3 double"


def test_imputation_fills_gaps_and_nothing_else(spark):
    df = spark.createDataFrame(GAPS, SHAPE)
    out = impute.impute_knn(df, "numeric1", 3, id_col="id")
    rows = {r["id"]: r.asDict() for r in out.collect()}
    assert out.columns == df.columns and len(rows) == 10
    for given in df.collect():
        for c in df.columns:
            if c != "numeric1" or given[c] is not None:
                assert rows[given["id"]][c] == given[c]
    assert all(r["numeric1"] is not None for r in rows.values())


def test_integer_columns_are_rounded(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (2, 2, 1.1), (3, None, 1.05), (4, 9, 50.0)], "id int, n int, x double")
    row = impute.impute_knn(df, "n", 2, id_col="id").where("id = 3").first()
    assert row["n"] == 2 and impute.impute_knn(df, "n", 2, id_col="id").schema["n"].dataType.simpleString() == "int"


def test_imputation_edge_cases(spark):
    full = spark.createDataFrame([(1, 1.0, 4.0), (2, 2.0, 5.0), (3, 3.0, 6.0)], "id int, A double, B double")
    assert impute.impute_knn(full, "A", 2, id_col="id").collect() == full.collect()
    with pytest.raises(ValueError, match="not found"):
        impute.impute_knn(full, "missing", 2, id_col="id")
    with pytest.raises(ValueError, match="all values"):
        impute.impute_knn(full.where("id < 0"), "A", 2, id_col="id")
    alone = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "id int, A double")
    assert impute.impute_knn(alone, "A", 2, id_col="id").where("id = 2").first()["A"] == 2.0


def test_holdout_size(spark):
    df = spark.createDataFrame(GAPS, SHAPE)
    held = impute.create_holdout_mask(df, "numeric1", 0.3, id_col="id").where("is_holdout").collect()
    assert len(held) == int(7 * 0.3) and all(r["holdout_value"] is not None for r in held)


def test_evaluation_reports_errors_per_column(spark):
    df = spark.createDataFrame(GAPS, SHAPE).withColumn("void", F.lit(None).cast("double"))
    filled, report = impute.apply_and_evaluate_knn_imputation(df, ["numeric1", "void", "numeric3"], 0.2, 2, id_col="id")
    rows = {r["column_name"]: r for r in report.collect()}
    assert "missing" in rows["void"]["error"] and rows["numeric1"]["error"] is None
    assert rows["numeric1"]["rmse"] >= 0
    assert filled.where("numeric1 is null or numeric3 is null").count() == 0
    assert filled.columns == df.columns and filled.count() == 10


def test_strategies():
    counts = [(0, 10), (1, 40), (2, 25)]
    assert synthetic_counts(counts) == {0: 30, 1: 0, 2: 15}
    assert synthetic_counts(counts, "minority") == {0: 30, 1: 0, 2: 0}
    assert synthetic_counts(counts, "not minority") == {0: 0, 1: 0, 2: 15}
    assert synthetic_counts(counts, {2: 30}) == {0: 0, 1: 0, 2: 5}
    assert synthetic_counts([("n", 10), ("y", 30)], 0.5) == {"n": 5, "y": 0}
    for bad in (0.5, "some", {0: 3}, {9: 100}):
        with pytest.raises(ValueError):
            synthetic_counts(counts, bad)


def test_smote_points_lie_between_a_base_and_its_neighbour(spark):
    draw = np.random.default_rng(1)
    rows = [(i, float(a), float(b), 0 if i < 20 else 1) for i, (a, b) in enumerate(draw.normal(0, 3, (80, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double, label int")
    smote = SMOTEBalancer("auto", 3, 11)
    out = smote.fit_resample(df.repartition(1), ["a", "b"], "label", "id")
    again = smote.fit_resample(df.repartition(13), ["a", "b"], "label", "id", **FORCED)
    assert sorted(out.collect()) == sorted(again.collect())
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 60, 1: 60}
    points = {i: np.array([a, b]) for i, a, b, _ in rows}
    near = brute(points, range(20), range(20), 3, exclude_self=True)
    made = out.where("copy_no > 0").collect()
    assert len(made) == 40 and {r["copy_no"] for r in made} == {1, 2}
    for r in made:
        p, base = np.array([r["a"], r["b"]]), points[r["source_id"]]

        def on_segment(n):
            step = points[n] - base
            u = ((p - base) @ step) / (step @ step)
            return -1e-9 <= u <= 1 and np.allclose(base + u * step, p)

        assert any(on_segment(n) for n in near[r["source_id"]])


def test_strategy_report_of_a_class_larger_than_wanted(spark):
    """The report tells how far a class is above the wanted size; resampling refuses."""
    df = spark.createDataFrame([(i, float(i), int(i > 11)) for i in range(30)], "id int, a double, label int")
    rows = {r["class_value"]: r["n_synthetic"] for r in resolve_sampling_strategy(df, "label", {0: 10}).collect()}
    assert rows == {0: -2, 1: 0}
    with pytest.raises(ValueError, match="fewer rows wanted"):
        SMOTEBalancer({0: 10}, 3).fit_resample(df, ["a"], "label", "id")


def test_smote_refuses_tiny_classes(spark):
    df = spark.createDataFrame([(i, float(i), int(i > 2)) for i in range(20)], "id int, a double, label int")
    with pytest.raises(ValueError, match="fewer than 6"):
        SMOTEBalancer("auto", 5).fit_resample(df, ["a"], "label", "id")


def frame(spark, ids, points):
    return spark.createDataFrame(pa.table({"id": pa.array(ids), "vec": pa.array(list(points))}))


def test_distances_per_receiver_stay_bounded(spark):
    """Four times the donors cost hardly more distances per receiver: leaves are bounded and most of the tree is pruned."""
    draw = np.random.default_rng(12)
    ask = frame(spark, np.arange(50), draw.uniform(0, 1, (50, 2)))
    cost = {}
    for n in (1_000, 4_000):
        points = draw.uniform(0, 1, (n, 2))
        give = frame(spark, np.arange(n) + 1000, points)
        tally = spark.sparkContext.accumulator(0)
        options = dict(id_col="id", vector_col="vec", max_pivots=20, donors_per_pivot=10, chunk_rows=20)
        rows = k_nearest(ask, give, 3, tally=tally, **options).collect()
        cost[n] = tally.value / 50
        asked = {r["id"]: np.array(r["vec"]) for r in ask.collect()}
        for r in rows[:10]:
            d = np.sqrt(((points - asked[r["id"]]) ** 2).sum(axis=1))
            assert [x["did"] for x in r["neighbours"]] == (np.argsort(d, kind="stable")[:3] + 1000).tolist()
    assert cost[4_000] < 2 * cost[1_000] and cost[4_000] < 1_000


def test_far_apart_clusters_make_a_deep_tree(spark):
    """Clusters inside clusters: nodes are split again where donors are dense, and copies never are."""
    draw = np.random.default_rng(13)
    points = np.concatenate([10.0 ** -k * draw.normal(0, 1, (40, 2)) + k for k in range(3)] + [np.full((40, 2), 2.0)])
    df = frame(spark, np.arange(len(points)), points).repartition(4)
    got = neighbours(k_nearest(df, df, 3, id_col="id", vector_col="vec", exclude_self=True, max_pivots=5, donors_per_pivot=5, chunk_rows=12))
    ids = np.arange(len(points))
    assert got == brute(points, ids, ids, 3, exclude_self=True)


def test_no_row_is_shuffled_by_its_node_alone(spark):
    """A node near the root holds most rows: joined by node in a shuffle, they would meet in one task."""
    df = frame(spark, np.arange(4_000), np.random.default_rng(14).uniform(0, 1, (4_000, 2))).repartition(8)
    rows = df.select(F.lit("").alias("grp"), F.lit("").alias("path"), "id", "vec")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # smaller than the rows, larger than one line for a node
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")
    try:
        met = knn._meet(rows, rows.limit(1), ["grp", "path"], "id", 500, df.schema, lambda a, b: a)
        assert "SortMergeJoin" not in met._jdf.queryExecution().executedPlan().toString()
        assert met.count() == 4_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_leaf_is_searched_in_boxes(spark):
    """A receiver meets the donors of a few boxes, also where most distances are equal; the answer is that of brute force."""
    draw = np.random.default_rng(15)
    points, asked = draw.uniform(0, 1, (20_000, 3)), draw.uniform(-0.2, 1.2, (300, 3))
    points[:6_000] = np.round(points[:6_000], 1)  # a grid
    asked[:100] = np.round(asked[:100], 1)
    tally = spark.sparkContext.accumulator(0)
    got = neighbours(k_nearest(frame(spark, np.arange(300), asked), frame(spark, np.arange(20_000) + 1000, points), 5,
                               id_col="id", vector_col="vec", tally=tally))
    assert tally.value / 300 < 1_500
    for i in range(300):
        d = np.round(np.sqrt(((points - asked[i]) ** 2).sum(axis=1)), 9)
        assert got[i] == (np.argsort(d, kind="stable")[:5] + 1000).tolist()


@pytest.mark.parametrize("n, spread, need", [(300, 1.0, 3), (3_000, 0.0, 40), (2_000, 1e7, 7)])
def test_boxes_find_what_all_distances_tell(n, spread, need):
    draw = np.random.default_rng(16)
    base = np.round(draw.normal(0, 1, (n, 4)), 1) * [1, 1, spread, 1]
    base[n // 2:n // 2 + 20, 1] = np.nan
    points = np.concatenate([base[:50], draw.normal(0, 2, (50, 4)), np.full((1, 4), np.nan)])
    row, dist, pick = knn._nearest(points, base, need, None)
    for i in range(100):
        d = np.round(knn._distances(points[i:i + 1], base)[0], 9)
        wanted = [j for j in np.lexsort((np.arange(n), d)) if not np.isnan(d[j])][:need]
        assert pick[row == i].tolist() == wanted and dist[row == i].tolist() == d[wanted].tolist()
    assert not (row == 100).any()


def test_fills_and_evaluation_share_a_search(spark, monkeypatch):
    """Both together look through every known value once, and give what each gives by itself."""
    draw = np.random.default_rng(17)
    rows = [(i, int(a * 3) if i % 6 else None, float(round(b)), float(round(c, 1)) if i % 7 else None)
            for i, (a, b, c) in enumerate(draw.normal(0, 5, (400, 3)))]
    df = spark.createDataFrame(rows, "id int, n int, x double, y double")
    seen, search = [], impute.k_nearest
    monkeypatch.setattr(impute, "k_nearest", lambda ask, give, *a, **o: seen.append(give.count()) or search(ask, give, *a, **o))
    filled, report = impute.apply_and_evaluate_knn_imputation(df, ["n", "y"], 0.2, 3, id_col="id")
    assert sum(seen) == sum(r[1] is not None for r in rows) + sum(r[3] is not None for r in rows)
    told = {r["column_name"]: r for r in report.collect()}
    got = {r["id"]: r for r in filled.collect()}
    for c in ("n", "y"):
        alone = impute.evaluate_knn_imputation(df, c, 0.2, 3, id_col="id").first()
        assert [told[c][m] for m in alone.asDict()] == list(alone)
        assert {r["id"]: r[c] for r in impute.impute_knn(df, c, 3, id_col="id").collect()} == {i: r[c] for i, r in got.items()}
