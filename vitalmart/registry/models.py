"""M*: machine learning; U2: probability extraction.

Splits use a hash that SQL has, too, so the rows of each part are checked. A fitted
model has no SQL form: trees are fitted to labels planted by a rule and must find it again, logistic
fits must be where the gradient of their loss vanishes. A constant classifier fails both.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from vitalmart.functions.numeric import rnd
from vitalmart.ml import evaluation as E
from vitalmart.ml import training as M
from vitalmart.operators.aggregate import confusion_counts, n, n_if, rate, report
from vitalmart.rules import clinical as R
from vitalmart.sources import writers

from . import sql as S
from .aggregates import _LABELLED, _labelled
from .base import query

C = F.col
FEATURES = ["pregnancies", "glucose", "blood_pressure", "skin_thickness", "insulin", "bmi", "diabetes_pedigree_function", "age", "risk_score"]


def _table(t):
    return M.labelled(t.gold, "diabetes", FEATURES, "id")


def _parts(t):
    return M.split(_table(t), "id", [0.8, 0.2])


_U = f"CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':{M.SEED}'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296e0"
_MARKED = S.WITH_GOLD + f", u AS (SELECT diabetes AS label, {_U} AS u FROM gold), test AS (SELECT * FROM u WHERE u >= 0.8e0) "


@query("m1_assemble_and_scale", " UNION ALL ".join(
    f"SELECT '{c}_mean' AS metric_name, 0e0 AS metric_value UNION ALL SELECT '{c}_sd', 1e0" for c in FEATURES))
def _(t):
    """Mean and deviation of the scaled features: 0 and 1 when centred."""
    from pyspark.ml.functions import vector_to_array
    df = _table(t)
    scaled = M.feature_pipeline(FEATURES, with_mean=True).fit(df).transform(df).select(vector_to_array("features").alias("f"))
    stats = scaled.agg(*[(rnd(F.avg(C("f")[i]), 6) + 0.0).alias(f"{c}_mean") for i, c in enumerate(FEATURES)],
                       *[rnd(F.stddev_samp(C("f")[i]), 6).alias(f"{c}_sd") for i, c in enumerate(FEATURES)])
    return stats.unpivot([], stats.columns, "metric_name", "metric_value")


@query("m2_hash_split", _MARKED + "SELECT CASE WHEN u < 0.8e0 THEN 'train' WHEN u < 0.9e0 THEN 'validation' ELSE 'test' END AS part, COUNT(*) AS n_rows"
       " FROM u GROUP BY 1")
def _(t):
    """Rows per part of an 80/10/10 split by key hash."""
    parts = dict(zip(("train", "validation", "test"), M.split(_table(t), "id", [0.8, 0.1, 0.1])))
    out = [p.agg(n().alias("n_rows")).select(F.lit(k).alias("part"), "n_rows") for k, p in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("m3_stratified_split", _MARKED + ", c AS (SELECT label AS class, quantile_cont(u, 0.8) AS cut FROM u GROUP BY label) SELECT CASE WHEN u <= cut THEN 'train'"
       " ELSE 'test' END AS part, COUNT(*) AS n_rows, " + S.rate("label = 1", 4) + " AS positive_pct FROM u JOIN c ON label IS NOT DISTINCT FROM class GROUP BY 1")
def _(t):
    """Rows and positive share of both parts."""
    parts = dict(zip(("train", "test"), M.stratified_split(_table(t), M.LABEL, "id")))
    out = [p.agg(n().alias("n_rows"), rate(C(M.LABEL) == 1, 4).alias("positive_pct")).select(F.lit(k).alias("part"), "n_rows", "positive_pct")
           for k, p in parts.items()]
    return out[0].unionByName(out[1])


# Labels with a known answer: a rule on three features, turned over for 3 % of the keys.
_FLIPPED = _U.replace(f":{M.SEED}", ":planted") + " < 0.03e0"
_PLANTED = (S.WITH_GOLD + f", u AS (SELECT CASE WHEN ((glucose >= 126 AND bmi >= 30) OR age >= 60) <> ({_FLIPPED}) THEN 1 ELSE 0 END AS label, {_U} AS u"
            " FROM gold), test AS (SELECT * FROM u WHERE u >= 0.8e0), train AS (SELECT * FROM u WHERE u < 0.8e0) ")
_LEARNED = _PLANTED + "SELECT COUNT(*) AS total, CAST(SUM(label) AS BIGINT) AS positives, true AS ranks_right, true AS decides_right, true AS beats_constant FROM test"


def _planted(t):
    """Train and test part of the planted table."""
    sick = ((C("glucose") >= 126) & (C("bmi") >= 30)) | (C("age") >= 60)
    rows = _table(t).withColumn(M.LABEL, F.when(sick != (M.key_share("id", "planted") < 0.03), 1.0).otherwise(0.0))
    return M.split(rows, "id", [0.8, 0.2], written=True)


def _learned(metrics, auc, accuracy):
    """Whether a fit found the planted rule: areas and accuracy that no constant and no random ranking reaches."""
    positives = C("tp") + C("fn")
    return metrics.select("total", positives.alias("positives"), (C("auc_roc") >= auc).alias("ranks_right"), (C("accuracy") >= accuracy).alias("decides_right"),
                          (C("accuracy") * C("total") > 1.02 * F.greatest(positives, C("total") - positives)).alias("beats_constant"))


def _evaluated(t, classifier, auc, accuracy, with_mean=False, fit_rows=None):
    train, test = _planted(t)
    if fit_rows:
        train = M.bounded(train, "id", fit_rows)
    return _learned(E.evaluate(M.score(M.train(classifier, train, FEATURES, with_mean), test)), auc, accuracy)


@query("m4_random_forest", _LEARNED)
def _(t):
    return _evaluated(t, M.random_forest(), 0.93, 0.93)


@query("m5_forest_grid_search", _LEARNED)
def _(t):
    """All 27 settings in three folds over the whole training part: 82 forests."""
    return _evaluated(t, M.cross_validated_forest(), 0.85, 0.85, True)


_OPTIMAL = _PLANTED + "SELECT COUNT(*) AS fitted, CAST(SUM(label) AS BIGINT) AS positives, true AS gradient_vanishes, true AS ranks_right FROM train"


def _optimal(t, with_mean=False, **params):
    """The gradient of the penalised loss at the fitted coefficients, over the rows fitted: zero only at the optimum."""
    train, test = _planted(t)
    model = M.train(M.logistic_regression(**params), train, FEATURES, with_mean)
    worst = E.penalised_gradient(model, M.score(model, train))
    auc = E.evaluate(M.score(model, test)).first()["auc_roc"]
    return worst.select("fitted", "positives", (C("gradient") < 1e-3).alias("gradient_vanishes"), F.lit(auc >= 0.75).alias("ranks_right"))


@query("m6_logistic_regression", _OPTIMAL)
def _(t):
    return _optimal(t)


@query("m6_logistic_elastic_net", _OPTIMAL)
def _(t):
    return _optimal(t, True, **M.LOGISTIC_ELASTIC)


@query("m7_gradient_boosting", _LEARNED)
def _(t):
    return _evaluated(t, M.gradient_boosting(), 0.93, 0.93)


def _logistic(t):
    train, test = _parts(t)
    return M.train(M.logistic_regression(), train, FEATURES), test


@query("m8_score_table", S.WITH_GOLD + f"SELECT id, COUNT(*) AS scored, true AS in_range FROM gold WHERE {_U} >= 0.8e0 GROUP BY id")
def _(t):
    """Model saved, loaded and applied to the held-out rows; each has its score."""
    model, test = _logistic(t)
    path = writers.scratch_path(t.spark, "m8-model")
    M.save_model(model, path)
    scored = M.score(M.load_model(path), test).select("id", "prediction", E.positive_probability().alias("p"))
    return scored.groupBy("id").agg(F.count("p").alias("scored"), F.bool_and(
        C("p").between(0, 1) & (C("prediction") == (C("p") > 0.5).cast("double"))).alias("in_range"))


_BOTH = lambda pos, neg: S.r(f"(COALESCE({pos}, 0) * p + COALESCE({neg}, 0) * n) / (p + n)", 6)


@query("m9_evaluation_metrics", S.WITH_GOLD + ", s AS (SELECT diabetes AS y, glucose AS score, COUNT(*) AS k FROM gold WHERE glucose IS NOT NULL AND diabetes IS"
       " NOT NULL GROUP BY 1, 2), g AS (SELECT score, CAST(SUM(k) FILTER (WHERE y = 1) AS DOUBLE) AS a, CAST(SUM(k) FILTER (WHERE y = 0) AS DOUBLE) AS b"
       " FROM s GROUP BY score), c AS (SELECT score, COALESCE(a, 0) AS a, COALESCE(b, 0) AS b FROM g), d AS (SELECT *, SUM(a) OVER w AS tp, SUM(b) OVER w AS fp,"
       " SUM(a) OVER () AS p, SUM(b) OVER () AS n FROM c WINDOW w AS (ORDER BY score DESC)), e AS (SELECT *, tp / (tp + fp) AS prec,"
       " LAG(tp / (tp + fp), 1, tp / (tp + fp)) OVER (ORDER BY score DESC) AS before FROM d), areas AS (SELECT SUM(b * (tp - a / 2)) / MAX(p * n) AS roc,"
       " SUM(a / p * (prec + before) / 2) AS pr FROM e), m AS (SELECT SUM(a) FILTER (WHERE score >= 126) AS tp, SUM(b) FILTER (WHERE score < 126) AS tn,"
       " SUM(b) FILTER (WHERE score >= 126) AS fp, SUM(a) FILTER (WHERE score < 126) AS fn, SUM(a) AS p, SUM(b) AS n FROM c)"
       " SELECT CAST(p + n AS BIGINT) AS total, " + S.r("(tp + tn) / (p + n)", 6) + " AS accuracy, " + _BOTH("tp / NULLIF(tp + fp, 0)", "tn / NULLIF(tn + fn, 0)")
       + " AS precision, " + _BOTH("tp / p", "tn / n") + " AS recall, " + _BOTH("2 * tp / NULLIF(2 * tp + fp + fn, 0)", "2 * tn / NULLIF(2 * tn + fp + fn, 0)")
       + " AS f1_score, " + S.r("roc", 6) + " AS auc_roc, " + S.r("pr", 6) + " AS auc_pr FROM m, areas")
def _(t):
    """All metrics of one score, the glucose value cut at 126, digit by digit."""
    scored = t.gold.select(C("diabetes").cast("double").alias(M.LABEL), C("glucose").cast("double").alias("rawPrediction"),
                           (C("glucose") >= 126).cast("double").alias("prediction"))
    return E.evaluate(scored).select("total", *[rnd(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1_score", "auc_roc", "auc_pr")])


@query("u2_positive_probability", _MARKED + "SELECT COUNT(*) AS n_rows, true AS split_at_half FROM test")
def _(t):
    """P(class 1) taken from the vector natively decides the predicted class."""
    model, test = _logistic(t)
    p = M.score(model, test).select("prediction", E.positive_probability().alias("p"))
    return p.agg(n().alias("n_rows"), F.bool_and((C("p") > 0.5) == (C("prediction") == 1)).alias("split_at_half"))


@query("m10_probability_extraction", _MARKED + "SELECT COUNT(*) AS n_rows, COUNT(*) AS in_range FROM test")
def _(t):
    model, test = _logistic(t)
    return M.score(model, test).agg(n().alias("n_rows"), n_if(E.positive_probability().between(0, 1)).alias("in_range"))


@query("m11_prediction_distribution", "SELECT CAST(guess AS BIGINT) AS class_label, COUNT(*) AS count, "
       + S.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 4) + f" AS percentage FROM {_LABELLED} GROUP BY guess")
def _(t):
    return E.prediction_distribution(_labelled(t), "guess")


_P = S.WITH_GOLD + "SELECT " + S.avg("prediction_probability", 6) + " AS avg_positive_probability, " + S.sd("prediction_probability", 6) \
    + " AS std_positive_probability FROM gold"


@query("m11_confidence_statistics", _P)
def _(t):
    return E.confidence_statistics(t.gold, C("prediction_probability"))


_CM = "WITH m AS (" + S.select({
    "tp": S.cnt("quality = 1 AND guess = 1"), "tn": S.cnt("quality = 0 AND guess = 0"), "fp": S.cnt("quality = 0 AND guess = 1"),
    "fn": S.cnt("quality = 1 AND guess = 0"), "total": S.cnt()}, _LABELLED) + ") "
_REST = ("COALESCE(" + S.pct("tp", "tp + fn", 4) + ", 0e0) AS early_detection_rate, " + S.pct("tp + fp", "total", 4)
         + " AS high_risk_identification_rate, fp AS unnecessary_interventions, fn AS missed_cases, fn * 1000 AS cost_of_false_negatives, fp * 100"
         " AS cost_of_false_positives FROM m")


@query("m12_business_metrics_by_class", _CM + "SELECT *, COALESCE(" + S.pct("fp", "fp + tn", 4) + ", 0e0) AS false_positive_rate, COALESCE("
       + S.pct("fn", "fn + tp", 4) + ", 0e0) AS false_negative_rate, " + _REST)
def _(t):
    return E.business_metrics(confusion_counts(_labelled(t), "quality", "guess"))


@query("m12_business_metrics_over_all", _CM + "SELECT *, COALESCE(" + S.pct("fp", "total", 4) + ", 0e0) AS false_positive_rate, COALESCE("
       + S.pct("fn", "total", 4) + ", 0e0) AS false_negative_rate, " + _REST)
def _(t):
    return E.business_metrics(confusion_counts(_labelled(t), "quality", "guess"), "all")


_W = ("SELECT *, " + S.r("(tp + tn) / total", 6) + " AS accuracy, " + S.r(
    "(2e0 * tp / NULLIF(2 * tp + fp + fn, 0) * (tp + fn) + 2e0 * tn / NULLIF(2 * tn + fp + fn, 0) * (tn + fp)) / total", 6) + " AS f1_score, "
    + S.r("(tp / NULLIF(tp + fn, 0) + tn / NULLIF(tn + fp, 0)) / 2", 6) + " AS auc_roc, COALESCE(" + S.pct("fn", "fn + tp", 4)
    + ", 0e0) AS false_negative_rate, COALESCE(" + S.pct("fp", "fp + tn", 4) + ", 0e0) AS false_positive_rate FROM m")


def _gate_row(t):
    """Metrics of the length rule; a single cut point makes the ROC area the mean of both recalls."""
    m = E.weighted_metrics(E.business_metrics(confusion_counts(_labelled(t), "quality", "guess")))
    auc = (C("tp") / (C("tp") + C("fn")) + C("tn") / (C("tn") + C("fp"))) / 2
    return m.select("tp", "tn", "fp", "fn", "total", "accuracy", "f1_score", rnd(auc, 6).alias("auc_roc"), "false_negative_rate", "false_positive_rate")


def _advice(rules):
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN {S.q(text)} END" for c, text in rules) + ")"


@query("m13_model_gate", _CM + ", w AS (" + _W + ") SELECT *, CASE " + " ".join(
    f"WHEN accuracy >= {a} AND f1_score >= {f} THEN '{name}'" for name, a, f in R.GATE_LADDER) + f" ELSE '{R.GATE_DEFAULT}' END AS model_quality,"
    " accuracy >= 0.75 AND f1_score >= 0.7 AND auc_roc >= 0.8 AND false_negative_rate <= 15 AS deployment_ready, " + _advice([
        ("accuracy < 0.75", R.GATE_ADVICE["accuracy"]), ("f1_score < 0.7", R.GATE_ADVICE["f1_score"]), ("auc_roc < 0.8", R.GATE_ADVICE["auc_roc"]),
        ("false_negative_rate > 15", R.GATE_ADVICE["false_negative_rate"])]) + " AS improvement_suggestions FROM w")
def _(t):
    return E.model_gate(_gate_row(t))


@query("m13_strict_gate", _CM + ", w AS (" + _W + ") SELECT *, CASE WHEN accuracy >= 0.85 AND f1_score >= 0.8 AND false_negative_rate <= 5 THEN 'EXCELLENT'"
       " WHEN accuracy >= 0.75 AND f1_score >= 0.7 THEN 'GOOD' WHEN accuracy >= 0.65 THEN 'FAIR' ELSE 'POOR' END AS model_quality, (accuracy >= 0.85 AND"
       " f1_score >= 0.8 AND false_negative_rate <= 5) OR (accuracy >= 0.75 AND f1_score >= 0.7) AS deployment_ready, " + _advice([
           ("accuracy < 0.85", R.STRICT_GATE_ADVICE["accuracy"]), ("false_negative_rate > 5", R.STRICT_GATE_ADVICE["false_negative_rate"]),
           ("false_positive_rate > 15", R.STRICT_GATE_ADVICE["false_positive_rate"])]) + " AS improvement_suggestions FROM w")
def _(t):
    return E.strict_gate(_gate_row(t))


@query("m14_feature_importances", "SELECT CAST(9 AS BIGINT) AS features, CAST(5 AS BIGINT) AS listed, true AS sum_to_one, true AS descending")
def _(t):
    """Importances of all features, and the top five by name."""
    train, _test = _parts(t)
    every = E.feature_importances(M.train(M.random_forest(), train, FEATURES), FEATURES, t.spark)
    top = every.orderBy("place").limit(5).agg(F.count("feature").alias("listed"))
    steps = F.array_sort(F.collect_list(F.struct("place", "importance")))  # one per feature
    return every.agg(F.countDistinct("feature").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-4).alias("sum_to_one"),
                     steps.alias("s")).crossJoin(top).select("features", "listed", "sum_to_one", F.aggregate(
                         "s", F.struct(F.lit(True).alias("ok"), F.lit(2.0).alias("last")), lambda a, x: F.struct(
                             (a["ok"] & (x["importance"] <= a["last"])).alias("ok"), x["importance"].alias("last")),
                         lambda a: a["ok"]).alias("descending"))


@query("m15_model_registry", _MARKED + "SELECT 'logistic' AS model_name, 'v1' AS model_version, 'LogisticRegression' AS model_type, COUNT(*) AS test_samples,"
       " DATE '2024-01-15' AS deployment_date, 'Active' AS model_status, true AS in_range FROM test")
def _(t):
    """A trained model's row appended to the registry table and read back."""
    path = writers.scratch_path(t.spark, "m15")
    model, test = _logistic(t)
    row = E.registry_row(E.evaluate(M.score(model, test)), "logistic", "v1", "LogisticRegression", F.lit(dt.date(2024, 1, 15)))
    writers.append(row, path)
    rates = reduce(and_, [C(c).between(0, 1) for c in ("accuracy", "precision_score", "recall", "f1_score", "auc_roc", "auc_pr")])
    return t.spark.read.parquet(path).select("model_name", "model_version", "model_type", "test_samples", "deployment_date", "model_status",
                                             rates.alias("in_range"))


@query("m16_drift_magnitudes", S.WITH_GOLD + "SELECT " + ", ".join(f"{S.r(f'abs(AVG({c}) - {b}e0)', 6)} AS {c}_drift" for c, b in R.DRIFT_BASELINE.items())
       + " FROM gold")
def _(t):
    return E.drift(t.gold, R.DRIFT_BASELINE)
