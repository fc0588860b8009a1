"""Queries: model features, splits, classifiers, scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tankwise.catalog.analysis import CANONICAL_TIME
from tankwise.catalog.preparation import CANONICAL_ORDER, canonical
from tankwise.catalog.registry import CANONICAL, all_rounded, register
from tankwise.functions.phases import label_code, phase_cut
from tankwise.operators import features, models
from tankwise.session import stage
from tankwise.sources.readers import table

LABEL_SQL = (
    "CASE WHEN co2_lpm <= 0 OR co2_lpm IS NULL THEN 0 WHEN co2_lpm <= 500 THEN 0 WHEN co2_lpm <= 1000 THEN 1"
    " WHEN co2_lpm <= 1500 THEN 2 ELSE 3 END"
)
INPUTS = ["co2_lpm", "do_ppm", "temp_c", "pressure_bar", "humidity"]
MODEL_INPUTS = [
    "co2_lpm",
    "do_ppm",
    "temp_c",
    "pressure_bar",
    "valve_state",
    "co2_lpm_lag_1",
    "co2_lpm_lag_3",
    "co2_lpm_rolling_mean_6",
    "co2_lpm_rolling_mean_12",
    "co2_lpm_rolling_std_6",
    "estimated_attenuation",
]


def labelled(spark, folder):
    rows = canonical(spark, folder)
    return rows.withColumn("label", label_code(phase_cut(F.col("co2_lpm"))))


@register(
    "ml_features",
    f"WITH {CANONICAL}, p AS (SELECT event_id, CAST(0 AS DOUBLE) AS humidity, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in INPUTS[:-1])
    + f" FROM c) SELECT event_id, {all_rounded(INPUTS)} FROM p",
)
def ml_features(spark, folder):
    """A stored feature list, one of whose columns is absent from the data."""
    prepared, names = models.prepare_features(canonical(spark, folder), INPUTS)
    return prepared.select("event_id", *names)


@register(
    "ml_split_counts",
    f"WITH {CANONICAL} SELECT {LABEL_SQL} AS label, CAST(floor(count(*) * 0.2) AS BIGINT) AS test,"
    " count(*) - CAST(floor(count(*) * 0.2) AS BIGINT) AS train FROM c GROUP BY 1",
)
def ml_split_counts(spark, folder):
    split = models.stratified_split(labelled(spark, folder).select("event_id", "label"), "label", ["event_id"])
    return split.groupBy("label").agg(
        F.count_if("is_test").alias("test"), F.count_if(~F.col("is_test")).alias("train")
    )


def training(spark, folder):
    """Training rows, written once: counting classes, splitting and fitting all read them."""
    rows = labelled(spark, folder)
    made = features.all_features(rows, CANONICAL_ORDER)
    return stage(made.select("event_id", "timestamp", "batch_id", "label", *MODEL_INPUTS))


def _split(spark, folder):
    split = models.stratified_split(training(spark, folder), "label", ["event_id"])
    return split.filter(~F.col("is_test")), split.filter("is_test")


def boosted(train):
    return models.fit_boosted(train, "label", MODEL_INPUTS, iterations=50, rate=0.1, depth=3)


def forest(train):
    return models.fit_forest(train, "label", MODEL_INPUTS)


@register("ml_gbt")
def ml_gbt(spark, folder):
    """Scores of boosted trees on the test share."""
    train, test = _split(spark, folder)
    return models.class_report(boosted(train).predict(test), "label", "predicted")


@register("ml_rf")
def ml_rf(spark, folder):
    """Scores of a forest on the test share."""
    train, test = _split(spark, folder)
    return models.class_report(forest(train).predict(test), "label", "predicted")


@register("ml_predict")
def ml_predict(spark, folder):
    rows = training(spark, folder)
    scored = forest(rows).predict(rows)
    return scored.select("event_id", "label", "predicted", F.array_max("probabilities").alias("confidence"))


@register("ml_importance")
def ml_importance(spark, folder):
    return forest(training(spark, folder)).importances(spark)


@register("ml_forecast")
def ml_forecast(spark, folder):
    """Forecast from the last row of every batch."""
    rows = training(spark, folder)
    found = forest(rows).forecast(rows, CANONICAL_ORDER)
    return found.select("batch_id", "predicted_phase", "confidence")


@register(
    "future_phase",
    f"WITH {CANONICAL} SELECT event_id, lead({LABEL_SQL}, 72) OVER (PARTITION BY tank_id {CANONICAL_TIME})"
    " AS future_phase FROM c",
)
def future_phase(spark, folder):
    rows = labelled(spark, folder).select(*CANONICAL_ORDER, "tank_id", "label")
    return models.future_phase(rows, CANONICAL_ORDER, "label", ["tank_id"]).select("event_id", "future_phase")


# Scores are checked on a fixed pair of columns: ``quality`` as truth, ``toxic`` as prediction.

CELLS = """x AS (SELECT quality AS l, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
    k AS (SELECT l AS c FROM x UNION SELECT p FROM x),
    s AS (SELECT c, coalesce((SELECT sum(n) FROM x WHERE l = c), 0) AS support,
                 coalesce((SELECT sum(n) FROM x WHERE p = c), 0) AS predicted,
                 coalesce((SELECT sum(n) FROM x WHERE l = c AND p = c), 0) AS hits FROM k),
    r AS (SELECT c AS class, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
                 CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
                 CASE WHEN hits = 0 THEN 0 ELSE 2 * hits / (support + predicted) END AS f1,
                 CAST(support AS BIGINT) AS support FROM s)"""


@register("ml_macro_f1", f"WITH {CELLS} SELECT round(avg(f1), 6) + 0.0 AS macro_f1 FROM r")
def ml_macro_f1(spark, folder):
    return models.macro_f1(table(spark, folder, "labels"), "quality", "toxic")


@register(
    "ml_confusion",
    'SELECT quality, count(*) FILTER (WHERE toxic = 0) AS "0", count(*) FILTER (WHERE toxic = 1) AS "1"'
    " FROM labels GROUP BY quality",
)
def ml_confusion(spark, folder):
    return models.confusion_matrix(table(spark, folder, "labels"), "quality", "toxic", [0, 1])


@register(
    "ml_class_report", f"WITH {CELLS} SELECT class, {all_rounded(['precision', 'recall', 'f1'])}, support FROM r"
)
def ml_class_report(spark, folder):
    return models.class_report(table(spark, folder, "labels"), "quality", "toxic")
