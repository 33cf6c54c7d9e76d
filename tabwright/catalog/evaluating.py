"""Metrics, feature selection and bias queries whose inputs are plain columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.correlating import COLUMNS, WIDE, _PAIRS, pairs, wide
from tabwright.catalog.registry import dbl, query, r6
from tabwright.functions.state import cut_lineage, settle
from tabwright.functions.types import rounded
from tabwright.operators import correlate, distribution, evaluate, fairness, importance

_CLASSES = (0, 1, 2, 3)


def _r6(frame, *columns):
    return frame.withColumns({c: rounded(F.col(c)) for c in columns})


def _scores(source="v_feat", by=None, pred="pred"):
    """Per-class counts and measures, as CTEs ``cls`` and ``m``."""
    key, keys = (f"{by}, " if by else ""), (f"GROUP BY {by}, class" if by else "GROUP BY class")
    return f"""sides AS (SELECT {key}CAST(label AS VARCHAR) AS class, 1 AS a, 0 AS p, CASE WHEN label = {pred} THEN 1 ELSE 0 END AS h FROM {source}
  UNION ALL SELECT {key}CAST({pred} AS VARCHAR), 0, 1, 0 FROM {source}),
cls AS (SELECT {key}class, CAST(sum(a) AS BIGINT) AS support, {dbl('sum(p)')} AS p, {dbl('sum(h)')} AS h FROM sides {keys}),
m AS (SELECT {key}class, support, coalesce(h / nullif(p, 0), 0) AS precision, coalesce(h / nullif(support, 0), 0) AS recall FROM cls),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)"""


@query("m6_accuracy", f"SELECT {r6('avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM v_feat")
def accuracy(t):
    return _r6(evaluate.accuracy(t.v_feat, "label", "pred"), "accuracy")


def _report(by=None):
    key, group = (f"{by}, " if by else ""), (f" GROUP BY {by}" if by else "")
    measures = ("precision", "recall", "f1")
    rows = ", ".join(f"{r6(c)} AS {c}" for c in measures)
    macro = ", ".join(f"{r6(f'avg({c})')} AS {c}" for c in measures)
    weighted = ", ".join(f"{r6(f'sum({c} * support) / sum(support)')} AS {c}" for c in measures)
    overall = ", ".join(f"{r6('sum(recall * support) / sum(support)')} AS {c}" for c in measures)
    total = "CAST(sum(support) AS BIGINT) AS support"
    return f"""SELECT {key}class, {rows}, support FROM f
UNION ALL SELECT {key}'macro avg', {macro}, {total} FROM f{group}
UNION ALL SELECT {key}'weighted avg', {weighted}, {total} FROM f{group}
UNION ALL SELECT {key}'accuracy', {overall}, {total} FROM f{group}"""


@query("m7_classification_report", f"WITH {_scores()} {_report()}")
def report(t):
    return _r6(evaluate.classification_report(t.v_feat, "label", "pred"), "precision", "recall", "f1")


@query("m8_confusion_matrix", "SELECT label AS actual, "
       + ", ".join(f"CAST(count_if(pred = {c}) AS BIGINT) AS n_{c}" for c in _CLASSES) + ", "
       + ", ".join(r6(f"count_if(pred = {c}) / {dbl('count(*)')}") + f" AS share_{c}" for c in _CLASSES)
       + " FROM v_feat GROUP BY label")
def confusion(t):
    return _r6(evaluate.confusion_matrix(t.v_feat, "label", "pred"), *[f"share_{c}" for c in _CLASSES])


@query("m8_confusion_counts", """
SELECT CAST(label AS VARCHAR) AS actual, CAST(pred AS VARCHAR) AS predicted, count(*) AS n FROM v_feat GROUP BY ALL""")
def confusion_long(t):
    return evaluate.confusion_counts(t.v_feat, "label", "pred")


@query("m9_macro_f1", f"WITH {_scores()} SELECT {r6('avg(f1)')} AS macro_f1 FROM f")
def macro_f1(t):
    return _r6(evaluate.macro_f1(t.v_feat, "label", "pred"), "macro_f1")


_ROLE = "CASE WHEN row_id % 5 = 0 THEN 'test' ELSE 'validation' END"


@query("m10_evaluate_by_split", f"WITH rows AS (SELECT *, {_ROLE} AS role FROM v_feat), {_scores('rows', 'role')} {_report('role')}")
def by_split(t):
    rows = t.v_feat.withColumn("role", F.expr(_ROLE))
    return _r6(evaluate.classification_report(rows, "label", "pred", ["role"]), "precision", "recall", "f1")


@query("g1_predictions_by_group", "SELECT cat, "
       + ", ".join(f"CAST(count_if(pred = {c}) AS BIGINT) AS n_{c}" for c in _CLASSES) + ", "
       + ", ".join(r6(f"count_if(pred = {c}) / {dbl('count(*)')}") + f" AS share_{c}" for c in _CLASSES)
       + " FROM v_feat GROUP BY cat")
def predictions_by_group(t):
    out = fairness.prediction_distribution(t.v_feat, "cat", "pred", _CLASSES)
    return _r6(out, *[f"share_{c}" for c in _CLASSES])


@query("g2_class_purity", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, count(*) AS n_values, {r6('sum(top) / sum(n)')} AS purity, {r6('min(top / n)')} AS lowest_value_purity, min(top / n) = 1 AS leaks
FROM (SELECT {c}, {dbl('max(k)')} AS top, {dbl('sum(k)')} AS n FROM (SELECT {c}, label, count(*) AS k FROM v_feat GROUP BY ALL) a GROUP BY {c}) b"""
    for c in ("cat", "leak")))
def purity(t):
    return _r6(fairness.class_purity(t.v_feat, ["cat", "leak"], "label"), "purity", "lowest_value_purity")


_MITIGATED = "CASE WHEN row_id % 11 = 0 THEN (label + 2) % 4 ELSE label END"


@query("g4_before_after", f"""
WITH {_scores()}, base AS (SELECT avg(f1) AS f1, (SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FROM v_feat) AS acc FROM f),
other AS (SELECT label, {_MITIGATED} AS pred FROM v_feat),
sides2 AS (SELECT label AS class, 1 AS a, 0 AS p, CASE WHEN label = pred THEN 1 ELSE 0 END AS h FROM other UNION ALL SELECT pred, 0, 1, 0 FROM other),
m2 AS (SELECT class, {dbl('sum(h)')} / sum(p) AS precision, {dbl('sum(h)')} / sum(a) AS recall FROM sides2 GROUP BY class),
fair AS (SELECT avg(2 * precision * recall / (precision + recall)) AS f1, (SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FROM other) AS acc FROM m2)
SELECT 'accuracy' AS metric, {r6('base.acc')} AS baseline, {r6('fair.acc')} AS mitigated, {r6('fair.acc - base.acc')} AS change FROM base, fair
UNION ALL SELECT 'macro_f1', {r6('base.f1')}, {r6('fair.f1')}, {r6('fair.f1 - base.f1')} FROM base, fair""")
def before_after(t):
    changed = t.v_feat.withColumn("pred", F.expr(_MITIGATED))
    return _r6(fairness.compare_models(t.v_feat, changed, "label", "pred"), "baseline", "mitigated", "change")


# --- feature selection on measures that plain SQL can compute as well ---

_FEATURES = [c for c in COLUMNS if c != "label"]
_WITH = f"WITH wide AS ({WIDE}), {_PAIRS}, tc AS (SELECT a AS feature, r FROM pairs WHERE b = 'label')"
_CURVE = f"""{_WITH}, imp AS (SELECT feature, abs(r) AS importance FROM tc),
curve AS (SELECT row_number() OVER o AS rank, feature, importance, (lead(importance) OVER o - importance) / nullif(importance, 0) AS fall
          FROM imp WINDOW o AS (ORDER BY importance DESC, feature))"""


def correlation_as_importance(t):
    return correlate.target_correlation(pairs(t), "label").select("feature", F.abs("r").alias("importance"))


@query("f2_importance_cliff", f"""{_CURVE}
SELECT CAST(rank AS INTEGER) AS rank, feature, {r6('importance')} AS importance, {r6('fall')} AS drop FROM curve
WHERE fall <= (SELECT quantile_cont(fall, 0.1) FROM curve) AND rank - 1 < (SELECT count(*) // 2 FROM curve) ORDER BY rank LIMIT 1""")
def cliff(t):
    return _r6(importance.importance_cliff(correlation_as_importance(t)), "importance", "drop")


@query("f3_importance_elbow", f"""{_CURVE},
ends AS (SELECT min(importance) AS lo, max(importance) AS hi, count(*) AS p FROM curve),
depth AS (SELECT rank, feature, importance, 1 - (rank - 1) / {dbl('p - 1')} - (importance - lo) / (hi - lo) AS depth FROM curve, ends)
SELECT CAST(rank AS INTEGER) AS rank, feature, {r6('importance')} AS importance, {r6('depth')} AS depth FROM depth
WHERE depth > 1e-12 ORDER BY depth DESC, rank LIMIT 1""")
def elbow(t):
    return _r6(importance.importance_elbow(correlation_as_importance(t)), "importance", "depth")


_BINNED = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, label, " + " + ".join(f"CASE WHEN {c} > e[{i}] THEN 1 ELSE 0 END" for i in range(1, 10))
    + f" AS bin FROM wide, (SELECT quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM wide) q" for c in _FEATURES)
_MI = f"""cells AS ({_BINNED}),
joint AS (SELECT feature, bin, label, {dbl('count(*)')} AS n FROM cells GROUP BY ALL),
tot AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS a, sum(n) OVER (PARTITION BY feature, bin) AS b, sum(n) OVER (PARTITION BY feature, label) AS c FROM joint),
mi AS (SELECT feature, sum(n / a * ln(n * a / (b * c))) AS mi FROM tot GROUP BY feature)"""
_EFFECT = f"""by_class AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, label, avg({c}) AS m, stddev_samp({c}) AS s FROM wide GROUP BY label" for c in _FEATURES)}),
apart AS (SELECT x.feature, avg(abs(x.m - y.m) / nullif(sqrt((x.s * x.s + y.s * y.s) / 2), 0)) AS d
          FROM by_class x JOIN by_class y ON x.feature = y.feature AND x.label < y.label GROUP BY x.feature)"""


@query("f8_mutual_information", f"{_WITH}, {_MI} SELECT feature, {r6('mi')} AS mutual_information FROM mi ORDER BY mi DESC, feature LIMIT 4")
def mutual_information(t):
    information = importance.mutual_information(wide(t), _FEATURES, "label")
    return _r6(importance.select_k_best(information, 4), "mutual_information")


def _stored(t):
    """The wide rows, read by several measures."""
    return cut_lineage(wide(t).select(*COLUMNS))


def _compared(rows, information=None):
    """Information in the place of a model's importance, effect size in that of the permuted one."""
    information = importance.mutual_information(rows, _FEATURES, "label") if information is None else information
    effect = distribution.class_separation(rows, _FEATURES, "label").select("feature", F.col("effect_size").alias("importance"))
    found = settle(correlate.correlation_pairs(rows, COLUMNS))
    return importance.importance_vs_correlation(
        information.withColumnRenamed("mutual_information", "importance"), effect, correlate.target_correlation(found, "label"))


_COMPARED = f"""{_WITH}, {_MI}, {_EFFECT},
side AS (SELECT mi.feature, mi.mi AS rf, coalesce(d, 0) AS perm, coalesce(r, 0) AS r, abs(coalesce(r, 0)) AS ra
         FROM mi JOIN apart ON apart.feature = mi.feature JOIN tc ON tc.feature = mi.feature),
norm AS (SELECT *, rf / max(rf) OVER () AS rfn, perm / max(perm) OVER () AS pn, ra / max(ra) OVER () AS rn FROM side)"""


@query("f5_importance_vs_correlation", f"""{_COMPARED}
SELECT feature, {r6('rf')} AS rf_importance, {r6('perm')} AS perm_importance, {r6('r')} AS correlation, {r6('ra')} AS correlation_abs,
  {r6('rfn')} AS rf_importance_norm, {r6('pn')} AS perm_importance_norm, {r6('rn')} AS correlation_norm, {r6('rfn - rn')} AS importance_corr_diff FROM norm""")
def importance_vs_correlation(t):
    out = _compared(_stored(t))
    return _r6(out, *[c for c in out.columns if c != "feature"])


_FLAGGED = f"""{_COMPARED}, flagged AS (SELECT feature, rfn > rn + 0.3 AND rfn > 0.3 AS non_linear, rn > rfn + 0.3 AND rn > 0.3 AS spurious,
  rfn > 0.5 AND rn > 0.5 AS consistent FROM norm)"""


@query("f6_classify_features", f"{_FLAGGED} SELECT feature, non_linear, spurious, consistent FROM flagged")
def classify(t):
    return importance.classify_features(_compared(_stored(t))).select("feature", "non_linear", "spurious", "consistent")


@query("f7_recommended_features", f"""{_FLAGGED}
SELECT feature FROM flagged WHERE consistent OR non_linear
UNION SELECT feature FROM (SELECT feature FROM mi ORDER BY mi DESC, feature LIMIT 2) u""")
def recommended(t):
    rows = _stored(t)
    information = settle(importance.mutual_information(rows, _FEATURES, "label"))
    classified = importance.classify_features(_compared(rows, information))
    return importance.recommended_features(importance.select_k_best(information, 2), classified)


@query("f10_feature_vote", f"""{_WITH}, {_MI}, {_EFFECT},
chosen AS (SELECT feature FROM tc WHERE abs(r) > 0.05 UNION ALL SELECT feature FROM (SELECT feature FROM mi ORDER BY mi DESC, feature LIMIT 3) u
           UNION ALL SELECT feature FROM apart WHERE d > 0.2)
SELECT feature, count(*) AS votes FROM chosen GROUP BY feature HAVING count(*) >= 2""")
def feature_vote(t):
    rows = _stored(t)
    by_correlation = correlate.select_by_correlation(settle(correlate.correlation_pairs(rows, COLUMNS)), "label")
    by_information = importance.select_k_best(importance.mutual_information(rows, _FEATURES, "label"), 3)
    by_effect = distribution.class_separation(rows, _FEATURES, "label").where(F.col("effect_size") > 0.2)
    return importance.vote([by_correlation, by_information, by_effect])


@query("f12_default_preparation", f"""
WITH m AS (SELECT {", ".join(f"avg({c}) - 3 * stddev_samp({c}) AS {c}l, avg({c}) + 3 * stddev_samp({c}) AS {c}h" for c in ("x1", "x3"))} FROM v_feat),
f AS (SELECT cat AS value, {dbl('count(*)')} / (SELECT count(cat) FROM v_feat) AS code FROM v_feat GROUP BY 1)
SELECT row_id, label, {r6('least(greatest(x1, x1l), x1h)')} AS x1, {r6('least(greatest(x3, x3l), x3h)')} AS x3, {r6('code')} AS cat
FROM v_feat JOIN f ON cat = value, m""")
def default_preparation(t):
    rows = t.v_feat.select("row_id", "label", "x1", "x3", "cat")
    out = importance.default_preparation(rows, "label", {"cat": "frequency"}, id_col="row_id")
    return _r6(out, "x1", "x3", "cat")
