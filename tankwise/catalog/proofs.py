"""Queries that hold streams, models, jobs and settings to what SQL says of their results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise import jobs
from tankwise.catalog.detection import _anomalies, _anomalies_cte, FIRST_PER_TIME, HELPER_COLUMNS, detector, sensors
from tankwise.catalog.learning import INPUTS, LABEL_SQL, MODEL_INPUTS, labelled, training
from tankwise.catalog.preparation import LEVEL_SQL, MEASURES, MEANS, SENSORS, _bounds_sql, _grid_sql
from tankwise.catalog.registry import CANONICAL, TELEMETRY, all_rounded, register, rounded
from tankwise.operators import align, models, outliers, report, validate
from tankwise.session import stage, staged_path
from tankwise.sources.telemetry import ORDER, telemetry, telemetry_stream
from tankwise.streaming.alerts import RATE_TYPES, pressure_alerts, rate_alerts
from tankwise.streaming.stateful import ROCKSDB, alerts, resampled_grid

# --- streams ----------------------------------------------------------------------------------


def emitted(spark, stream: DataFrame) -> DataFrame:
    """What a stream has emitted once it has read all there is."""
    out, point = staged_path(spark, "stream"), staged_path(spark, "points")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", point)
    writer.queryName(f"q{uuid.uuid4().hex}").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def canonical_stream(spark, folder: str) -> DataFrame:
    # Timers need this store; a setting of the session, like the time zone.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = telemetry_stream(spark, folder)
    return rows.select(
        "event_id",
        "tank_id",
        F.col("timestamp_index").alias("timestamp"),
        F.col("co2_ppm").alias("co2_lpm"),
        F.col("o2_pct").alias("do_ppm"),
        (F.col("pressure_kpa") / 100).alias("pressure_bar"),
    )


#: Rows whose minute the watermark (the newest time) has passed.
PASSED = " (epoch_ms(timestamp) // 60000 + 1) * 60000 <= (SELECT max(epoch_ms(timestamp)) FROM c)"


@register(
    "stream_pressure",
    f"WITH {CANONICAL}{_anomalies_cte()} SELECT event_id, anomaly_type, severity FROM u"
    " WHERE anomaly_type IN ('high_pressure', 'low_pressure')",
)
def stream_pressure(spark, folder):
    found = emitted(spark, pressure_alerts(canonical_stream(spark, folder)))
    return found.select("event_id", "anomaly_type", "severity")


@register(
    "stream_rates",
    f"WITH {CANONICAL}{_anomalies_cte('tank_id')} SELECT event_id, tank_id, {all_rounded(['co2_rate_per_min', 'pressure_rate_per_min'])},"
    f" anomaly_type, severity FROM (SELECT * REPLACE (co2_rate / 5 AS co2_rate_per_min, pressure_rate / 5 AS pressure_rate_per_min)"
    f" FROM (SELECT u.* EXCLUDE (co2_rate, pressure_rate), d.co2_rate, d.pressure_rate FROM u JOIN d USING (event_id)))"
    f" WHERE anomaly_type IN {RATE_TYPES} AND{PASSED}",
)
def stream_rates(spark, folder):
    found = emitted(spark, rate_alerts(canonical_stream(spark, folder), "tank_id", "timestamp", "event_id", "0 seconds"))
    return found.select("event_id", "tank_id", "co2_rate_per_min", "pressure_rate_per_min", "anomaly_type", "severity")


@register(
    "stream_anomalies",
    f"WITH {CANONICAL}{_anomalies_cte('tank_id')} SELECT event_id, tank_id, anomaly_type, severity FROM u WHERE{PASSED}",
)
def stream_anomalies(spark, folder):
    """All detectors on the stream, under the limits of a batch run."""
    limits = detector("tank_id").fit(sensors(spark, folder))
    rows = canonical_stream(spark, folder)
    found = emitted(spark, alerts(rows, "tank_id", "timestamp", "event_id", limits, lateness="0 seconds"))
    return found.select("event_id", "tank_id", "anomaly_type", "severity")


@register(
    "stream_grid",
    f"SELECT g.* FROM ({_grid_sql(MEANS, all_rounded(SENSORS), 'tank_id', 60)}) AS g JOIN ("
    "SELECT CAST(user_id AS VARCHAR) AS tank_id, max(epoch_ms(ts) // 3600000 * 3600000) * 1000 AS upto FROM events"
    " WHERE epoch_ms(ts) // 3600000 * 3600000 + 3600000 <= (SELECT max(epoch_ms(ts)) FROM events) GROUP BY 1) AS z"
    " ON z.tank_id = g.tank_id AND g.timestamp_index <= upto",
)
def stream_grid(spark, folder):
    """Means per hour and tank with empty hours."""
    canonical_stream(spark, folder)
    rows = telemetry_stream(spark, folder)
    return emitted(spark, resampled_grid(rows, "timestamp_index", SENSORS, ["tank_id"], 60, "mean", "0 seconds"))


# --- models -----------------------------------------------------------------------------------


def _scores(model, rows: DataFrame, kind: str, part: str, floor: float) -> DataFrame:
    """Facts about a model's predictions for some rows."""
    scored = stage(model.predict(rows).select("label", "predicted", "probabilities"))
    codes = F.array(*(F.lit(c) for c in model.classes))
    largest = codes[F.array_position("probabilities", F.array_max("probabilities")).cast("int") - 1]
    whole = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p)
    facts = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.abs(whole - 1) < 1e-6).alias("sums_to_one"),
        F.bool_and(largest == F.col("predicted")).alias("largest_is_predicted"),
    )
    above = models.macro_f1(scored, "label", "predicted").select((F.col("macro_f1") > floor).alias("above_floor"))
    return facts.join(above).select(F.lit(kind).alias("model"), F.lit(part).alias("part"), "*")  # one row each


@register(
    "ml_quality",
    f"""WITH {CANONICAL}, n AS (SELECT {LABEL_SQL} AS label, count(*) AS n, CAST(floor(count(*) * 0.2) AS BIGINT) AS test FROM c GROUP BY 1),
    p AS (SELECT 'test' AS part, CAST(sum(test) AS BIGINT) AS rows FROM n UNION ALL SELECT 'train', CAST(sum(n - test) AS BIGINT) FROM n)
    SELECT m AS model, part, rows, true AS sums_to_one, true AS largest_is_predicted, true AS above_floor
    FROM p, (SELECT unnest(['boosted', 'forest']) AS m)""",
)
def ml_quality(spark, folder):
    """Boosted trees and a forest on their training and test shares: macro-F1 above 0.9 on both."""
    split = stage(models.stratified_split(training(spark, folder), "label", ["event_id"]))
    parts = {"train": split.filter(~F.col("is_test")), "test": split.filter("is_test")}
    fitted = {
        "boosted": models.fit_boosted(parts["train"], "label", MODEL_INPUTS, iterations=8, rate=0.3, depth=3),
        "forest": models.fit_forest(parts["train"], "label", MODEL_INPUTS, trees=20),
    }
    found = [_scores(model, rows, kind, part, 0.9) for kind, model in fitted.items() for part, rows in parts.items()]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


@register(
    "ml_importance_facts",
    f"WITH {CANONICAL} SELECT unnest({MODEL_INPUTS}) AS feature, true AS within, true AS whole FROM (SELECT 1 FROM c LIMIT 1)",
)
def ml_importance_facts(spark, folder):
    """Every feature has an importance, and all add up to 1."""
    model = models.fit_boosted(training(spark, folder), "label", MODEL_INPUTS, iterations=3, depth=3)
    found = model.importances(spark)
    total = found.agg(F.sum("importance")).scalar()
    return found.select("feature", F.col("importance").between(0, 1).alias("within"), (F.abs(total - 1) < 1e-9).alias("whole"))


LAST_SQL = (
    f"WITH {CANONICAL}, z AS (SELECT batch_id, arg_max({LABEL_SQL}, (timestamp, event_id)) AS label FROM c GROUP BY 1)"
)


@register(
    "ml_forecast_facts",
    f"{LAST_SQL} SELECT batch_id, ['lag', 'exponential', 'stationary', 'decline'][label + 1] AS predicted_phase, true AS sure FROM z",
)
def ml_forecast_facts(spark, folder):
    """The forecast of every batch's last row, by a model that was fitted on these rows."""
    rows = training(spark, folder)
    found = models.fit_boosted(rows, "label", MODEL_INPUTS, iterations=30, rate=0.3, depth=3).forecast(rows, ("timestamp", "event_id"))
    return found.select("batch_id", "predicted_phase", (F.col("confidence") > 0.5).alias("sure"))


@register(
    "score_job",
    f"{LAST_SQL} SELECT batch_id, true AS known, true AS sure, 4 AS classes FROM z",
)
def score_job(spark, folder):
    """The scoring job from raw records to forecasts."""
    model = models.fit_boosted(training(spark, folder), "label", MODEL_INPUTS, iterations=5, rate=0.3, depth=3)
    records = telemetry(spark, folder).select("event_id", "timestamp_index", "tank_id", "batch_id", *SENSORS)
    found = jobs.score(records, model, ORDER)
    return found.select(
        "batch_id",
        F.col("predicted_phase").isin("lag", "exponential", "stationary", "decline").alias("known"),
        F.col("confidence").between(0.25, 1).alias("sure"),
        F.size("phase_probabilities").alias("classes"),
    )


@register(
    "report_with_forecasts",
    f"{LAST_SQL} SELECT batch_id, true AS has_forecast, true AS sums_to_one FROM z",
)
def report_with_forecasts(spark, folder):
    """Batch reports with every section, the phase forecast too."""
    rows = training(spark, folder)
    forecasts = models.fit_boosted(rows, "label", MODEL_INPUTS, iterations=3, depth=3).forecast(rows, ("timestamp", "event_id"))
    made = report.batch_reports(telemetry(spark, folder), _anomalies(spark, folder), ORDER, forecasts=forecasts)
    shares = F.map_values("phase_forecast.phase_probabilities")
    whole = F.aggregate(shares, F.lit(0.0), lambda a, p: a + p)
    return made.select(
        "batch_id",
        F.col("phase_forecast.predicted_phase").isNotNull().alias("has_forecast"),
        (F.abs(whole - 1) < 1e-6).alias("sums_to_one"),
    )


# --- jobs and settings ------------------------------------------------------------------------


@register(
    "anomaly_json_fields",
    f"WITH {CANONICAL}{_anomalies_cte()} SELECT event_id, epoch_us(timestamp) AS timestamp, anomaly_type, severity,"
    f" {all_rounded(HELPER_COLUMNS)} FROM u{FIRST_PER_TIME.format(keys='timestamp')}",
)
def anomaly_json_fields(spark, folder):
    """The detection job's JSON rows, parsed again."""
    t = telemetry(spark, folder).select("event_id", "timestamp_index", "tank_id", "batch_id", *SENSORS)
    rows = jobs.detect(t, ORDER, as_json=True)
    schema = "event_id double, timestamp timestamp, anomaly_type string, severity string, " + ", ".join(f"{h} double" for h in HELPER_COLUMNS)
    parsed = rows.select(F.from_json("anomaly", schema).alias("a")).select("a.*")
    return parsed.withColumn("event_id", F.col("event_id").cast("long"))


@register("outlier_zscore", _bounds_sql("zscore"), digits=4)
def outlier_zscore(spark, folder):
    """The limits that the handler fits and uses with ``zscore``."""
    rows = _lineitem(spark, folder)
    return outliers.bounds_table(rows, outliers.OutlierHandler("zscore", columns=MEASURES).fit(rows).active)


@register("outlier_both", _bounds_sql("iqr"), digits=4)
def outlier_both(spark, folder):
    """With ``both``, values are treated by quartiles."""
    rows = _lineitem(spark, folder)
    model = outliers.OutlierHandler("both", columns=MEASURES).fit(rows)
    return outliers.bounds_table(rows, model.active)


def _lineitem(spark, folder):
    from tankwise.catalog.preparation import lineitem

    return lineitem(spark, folder)


@register(
    "align_default",
    f"""WITH {TELEMETRY}, p AS (SELECT max(co2_ppm) AS peak FROM t),
    j AS (SELECT event_id, co2_ppm, CASE WHEN co2_ppm > 0 THEN coalesce(peak, co2_ppm) ELSE 1 END AS m FROM t, p)
    SELECT event_id, CASE WHEN m <= 0 THEN 'unknown' WHEN co2_ppm / m < 0.1 THEN 'lag'
      WHEN co2_ppm / m < 0.5 THEN 'exponential' WHEN co2_ppm / m < 0.9 THEN 'stationary' ELSE 'decline' END AS phase FROM j""",
)
def align_default(spark, folder):
    """Without strain and style one profile of the whole table is learned; labelled rows are left alone."""
    t = telemetry(spark, folder).drop("strain", "style")
    labelled_once = align.Aligner("co2_ppm").fit(t).transform(t)
    again = align.Aligner("co2_ppm").fit(labelled_once).transform(labelled_once)
    return again.select("event_id", "phase")


@register(
    "validate_types",
    f"""WITH {TELEMETRY}, n AS (SELECT count(*) - count(co2_ppm) AS v FROM t)
    SELECT 'schema_co2_ppm' AS rule, true AS passed, CAST(0 AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS message
    UNION ALL SELECT 'schema_tank_id', false, 1, 'Column tank_id has wrong dtype: expected double, got string'""",
)
def validate_types(spark, folder):
    """Schema rules that name a type."""
    rules = [validate.Schema("co2_ppm", "double", nullable=True), validate.Schema("tank_id", "double")]
    return validate.validate(telemetry(spark, folder), rules)
