"""Queries: validation, anomalies, batch reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tankwise import jobs
from tankwise.catalog.analysis import CANONICAL_TIME, GOLDEN_CTE, METRICS, METRICS_CTE, golden_inputs
from tankwise.catalog.preparation import CANONICAL_ORDER, MEASURES, SENSORS, TELEMETRY_COLUMNS, canonical
from tankwise.catalog.registry import CANONICAL, TELEMETRY, all_rounded, register, rounded
from tankwise.operators import anomaly, batch, report, validate
from tankwise.operators.anomaly import HELPERS, PRIORITY, SEVERITIES, AnomalyDetector
from tankwise.session import staged_path
from tankwise.sources.readers import table
from tankwise.sources.telemetry import ORDER, telemetry

# --- validation -------------------------------------------------------------------------------
# Names of rules and wording of messages, as in the rules.


def _result_sql(rule: str, violations: str, message: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, v = 0 AS passed, v AS violations, CASE WHEN v > 0 THEN {message} END AS message"
        f" FROM (SELECT {violations} AS v, * FROM ({source}))"
    )


def _range_sql(rule: str, column: str, low, high, source: str) -> str:
    inner = (
        f"SELECT count(*) FILTER (WHERE {column} < {low}) AS b, count(*) FILTER (WHERE {column} > {high}) AS a FROM {source}"
    )
    below = f"CASE WHEN b > 0 THEN b || ' values below minimum {low}' END"
    above = f"CASE WHEN a > 0 THEN a || ' values above maximum {high}' END"
    return _result_sql(rule, "a + b", f"concat_ws('; ', {below}, {above})", inner)


def _count_sql(rule: str, condition: str, before: str, after: str, source: str) -> str:
    inner = f"SELECT count(*) FILTER (WHERE {condition}) AS n FROM {source}"
    return _result_sql(rule, "n", f"'{before}' || n || '{after}'", inner)


def _outlier_rule_sql(column: str, source: str) -> str:
    q1, q3 = f"quantile_cont({column}, 0.25)", f"quantile_cont({column}, 0.75)"
    inner = (
        f"SELECT count(*) AS n, count(*) FILTER (WHERE {column} < lo OR {column} > hi) AS o FROM {source},"
        f" (SELECT {q1} - 1.5 * ({q3} - {q1}) AS lo, {q3} + 1.5 * ({q3} - {q1}) AS hi FROM {source})"
    )
    text = f"o || ' outliers detected in {column} (' || printf('%.1f', o * 100.0 / n) || '%)'"
    return _result_sql(f"outlier_{column}", "CASE WHEN o > n * 0.05 THEN o ELSE 0 END", text, inner)


RULES_SQL = " UNION ALL ".join(
    [
        "SELECT 'schema_timestamp_index' AS rule, true AS passed, CAST(0 AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS message",
        _count_sql("schema_co2_ppm", "co2_ppm IS NULL", "Column co2_ppm has ", " null values", "t"),
        "SELECT 'schema_humidity', false, 1, 'Column humidity missing'",
        _range_sql("range_co2_ppm", "co2_ppm", 5, 2000, "t"),
        _range_sql("range_pressure_kpa", "pressure_kpa", 50, 200, "t"),
        _result_sql(
            "duplicate_timestamps",
            "n",
            "n || ' duplicate timestamps found'",
            "SELECT count(*) AS n FROM (SELECT 1 FROM t GROUP BY timestamp_index HAVING count(*) > 1)",
        ),
        _result_sql(
            "missing_detection",
            "CASE WHEN m > n * 0.05 THEN 1 ELSE 0 END",
            "'Columns with >5.0% missing: [''co2_ppm'']'",
            "SELECT count(*) AS n, count(*) - count(co2_ppm) AS m FROM t",
        ),
        _outlier_rule_sql("co2_ppm", "t"),
    ]
)


RULES = [
    validate.Schema("timestamp_index"),
    validate.Schema("co2_ppm"),
    validate.Schema("humidity"),
    validate.Range("co2_ppm", 5, 2000),
    validate.Range("pressure_kpa", 50, 200),
    validate.DuplicateTimes("timestamp_index"),
    validate.MissingShare(0.05),
    validate.OutlierShare("co2_ppm"),
]


def checked(spark, folder):
    """Telemetry in which no row lacks a time."""
    t = telemetry(spark, folder)
    return t.withColumn("timestamp_index", F.coalesce("timestamp_index", F.lit(0).cast("timestamp")))


@register("validate_rules", f"WITH {TELEMETRY} {RULES_SQL}")
def validate_rules(spark, folder):
    return validate.validate(checked(spark, folder), RULES)


@register(
    "validate_observed",
    f"WITH {TELEMETRY}, v AS ({RULES_SQL})"
    " SELECT *, 'run 1' AS run_id, (SELECT bool_and(passed) FROM v) AS overall FROM v",
)
def validate_observed(spark, folder):
    """The rules' verdicts over the rows as they are written, under a run's name."""
    return validate.write_validated(checked(spark, folder), RULES, staged_path(spark, "validated"), "run 1")


@register(
    "validate_sensors",
    f"WITH {CANONICAL} "
    + " UNION ALL ".join(
        [
            _count_sql(
                "valve_state_validation", "valve_state NOT IN (0, 1)", "", " invalid valve_state values (must be 0 or 1)", "c"
            ),
            _count_sql(
                "agitator_rpm_validation",
                "agitator_rpm < 0 OR agitator_rpm > 3000",
                "",
                " agitator_rpm values out of range [0, 3000]",
                "c",
            ),
            _range_sql("range_co2_lpm", "co2_lpm", 0, 5000, "c"),
            _range_sql("range_do_ppm", "do_ppm", 0, 21, "c"),
            _range_sql("range_pressure_bar", "pressure_bar", 0.5, 3.0, "c"),
            _range_sql("range_temp_c", "temp_c", 10, 40, "c"),
        ]
    ),
)
def validate_sensors(spark, folder):
    return validate.validate(canonical(spark, folder), validate.sensor_rules())


@register(
    "dup_timestamps",
    "SELECT count(*) AS duplicates FROM (SELECT 1 FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL"
    " GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)",
)
def dup_timestamps(spark, folder):
    return validate.duplicate_times(table(spark, folder, "orders"), "o_orderdate", "o_custkey")


@register(
    "missing_over",
    f"WITH {TELEMETRY} SELECT 'co2_ppm' AS \"column\", round((count(*) - count(co2_ppm)) * 1.0 / count(*), 6) + 0.0"
    " AS missing_share FROM t HAVING (count(*) - count(co2_ppm)) * 1.0 / count(*) > 0.05",
)
def missing_over(spark, folder):
    return validate.missing_over(telemetry(spark, folder), 0.05, TELEMETRY_COLUMNS)


def _share_sql(columns: list[str], source: str, low: str, high: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers,"
        f" round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) / count(*), 6) + 0.0 AS share,"
        f" count(*) FILTER (WHERE {c} < lo OR {c} > hi) <= count(*) * 0.05 AS passed FROM {source},"
        f" (SELECT {low.format(c=c)} AS lo, {high.format(c=c)} AS hi FROM {source})"
        for c in columns
    )


@register(
    "outlier_share",
    f"WITH {TELEMETRY} "
    + _share_sql(
        SENSORS,
        "t",
        "quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))",
        "quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))",
    ),
)
def outlier_share(spark, folder):
    return validate.outlier_share(telemetry(spark, folder), SENSORS, "iqr")


@register(
    "outlier_share_z",
    _share_sql(MEASURES, "lineitem", "avg({c}) - 3 * stddev_samp({c})", "avg({c}) + 3 * stddev_samp({c})"),
)
def outlier_share_z(spark, folder):
    return validate.outlier_share(table(spark, folder, "lineitem"), MEASURES, "zscore")


@register(
    "sensor_summary",
    f"WITH {CANONICAL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS sensor, {rounded(f'avg({c})', 'mean', 5)}, {rounded(f'stddev_samp({c})', 'std', 5)},"
        f" round(CAST(min({c}) AS DOUBLE), 5) + 0.0 AS min, round(CAST(max({c}) AS DOUBLE), 5) + 0.0 AS max,"
        f" count(*) - count({c}) AS missing_count FROM c"
        for c in validate.SENSORS
    ),
    digits=5,
)
def sensor_summary(spark, folder):
    return validate.sensor_summary(canonical(spark, folder))


# --- anomalies --------------------------------------------------------------------------------

CONDITIONS = {
    "stuck_fermentation": "co2_rolling_mean < 0.01 AND co2_lpm < q70",
    "oxidation_risk": "do_change > do_limit",
    "high_pressure": "pressure_bar > 2.0",
    "low_pressure": "pressure_bar < 0.8",
    "abnormal_co2_activity": "abs(co2_rate) > co2_limit",
    "over_vigorous_co2": "co2_rate / 5 > 500",
    "rapid_pressure_rise": "pressure_rate / 5 > 0.1",
}
HELPER_SQL = {
    "co2_rate": "co2_rate",
    "co2_rolling_mean": "co2_rolling_mean",
    "do_change": "do_change",
    "do_change_abs": "abs(do_change)",
    "co2_rate_per_min": "co2_rate / 5",
    "pressure_rate": "pressure_rate",
    "pressure_rate_per_min": "pressure_rate / 5",
}


def _anomalies_cte(keys: str = "") -> str:
    """CTE ``u``: one row per anomaly with its helper columns."""
    by = f"PARTITION BY {keys} " if keys else ""
    branches = []
    for name, condition in CONDITIONS.items():
        helpers = ", ".join(
            f"{sql if name in HELPERS[h] else 'NULL::DOUBLE'} AS {h}" for h, sql in HELPER_SQL.items()
        )
        branches.append(
            f"SELECT event_id, tank_id, batch_id, timestamp, co2_lpm, do_ppm, pressure_bar, {helpers},"
            f" '{name}' AS anomaly_type, '{SEVERITIES[name]}' AS severity, {PRIORITY[name]} AS priority"
            f" FROM rr, lim WHERE {condition}"
        )
    return f""", d AS (
      SELECT *, co2_lpm - lag(co2_lpm) OVER w AS co2_rate, do_ppm - lag(do_ppm) OVER w AS do_change,
             pressure_bar - lag(pressure_bar) OVER w AS pressure_rate
      FROM c WINDOW w AS ({by}{CANONICAL_TIME})),
    rr AS (SELECT *, avg(co2_rate) OVER ({by}{CANONICAL_TIME} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
             AS co2_rolling_mean FROM d),
    lim AS (SELECT quantile_cont(co2_lpm, 0.7) AS q70,
             avg(abs(do_change)) + 0.5 * stddev_samp(abs(do_change)) AS do_limit,
             avg(co2_rate) + 3 * stddev_samp(co2_rate) AS co2_limit FROM d),
    u AS ({' UNION ALL '.join(branches)})"""


HELPER_COLUMNS = list(HELPER_SQL)
UNION_SELECT = f"SELECT event_id, tank_id, {all_rounded(HELPER_COLUMNS)}, anomaly_type, severity"
FIRST_PER_TIME = " QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY priority, timestamp, event_id) = 1"


def _one_sql(name: str) -> str:
    helpers = [h for h in HELPER_COLUMNS if name in HELPERS[h]]
    picked = f"{all_rounded(helpers)}, " if helpers else ""
    return (
        f"WITH {CANONICAL}{_anomalies_cte()} SELECT event_id, {picked}anomaly_type, severity FROM u"
        f" WHERE anomaly_type = '{name}'"
    )


def detector(*keys: str) -> AnomalyDetector:
    return AnomalyDetector(CANONICAL_ORDER, keys)


def sensors(spark, folder):
    return canonical(spark, folder).select(
        "event_id", "tank_id", "batch_id", "timestamp", "co2_lpm", "do_ppm", "pressure_bar"
    )


def _one(spark, folder, name: str):
    found = detector().union(sensors(spark, folder), [name])
    return found.select("event_id", *(h for h in HELPER_COLUMNS if name in HELPERS[h]), "anomaly_type", "severity")


@register("anom_stuck", _one_sql("stuck_fermentation"))
def anom_stuck(spark, folder):
    return _one(spark, folder, "stuck_fermentation")


@register("anom_oxidation", _one_sql("oxidation_risk"))
def anom_oxidation(spark, folder):
    return _one(spark, folder, "oxidation_risk")


@register(
    "anom_pressure",
    f"WITH {CANONICAL}{_anomalies_cte()} SELECT event_id, anomaly_type, severity FROM u"
    " WHERE anomaly_type IN ('high_pressure', 'low_pressure')",
)
def anom_pressure(spark, folder):
    return anomaly.pressure_anomalies(sensors(spark, folder)).select("event_id", "anomaly_type", "severity")


@register("anom_co2_stat", _one_sql("abnormal_co2_activity"))
def anom_co2_stat(spark, folder):
    return _one(spark, folder, "abnormal_co2_activity")


@register("anom_vigorous", _one_sql("over_vigorous_co2"))
def anom_vigorous(spark, folder):
    return _one(spark, folder, "over_vigorous_co2")


@register("anom_rapid_pressure", _one_sql("rapid_pressure_rise"))
def anom_rapid_pressure(spark, folder):
    return _one(spark, folder, "rapid_pressure_rise")


@register(
    "anom_co2_golden",
    f"WITH {CANONICAL}{GOLDEN_CTE.format(value='co2_lpm', source='c', time='timestamp')}"
    f" SELECT event_id, {rounded('similarity', 'similarity_score')}, 'abnormal_co2_pattern' AS anomaly_type,"
    " 'medium' AS severity FROM c JOIN sim USING (batch_id) WHERE similarity < 1 - 0.3",
)
def anom_co2_golden(spark, folder):
    whole, golden = golden_inputs(canonical(spark, folder), "timestamp", "co2_lpm")
    found = detector().abnormal_pattern(whole, golden)
    return found.select("event_id", "similarity_score", "anomaly_type", "severity")


@register("anom_union", f"WITH {CANONICAL}{_anomalies_cte()} {UNION_SELECT} FROM u")
def anom_union(spark, folder):
    found = detector().union(sensors(spark, folder))
    return found.select("event_id", "tank_id", *HELPER_COLUMNS, "anomaly_type", "severity")


@register("anom_union_by_tank", f"WITH {CANONICAL}{_anomalies_cte('tank_id')} {UNION_SELECT} FROM u")
def anom_union_by_tank(spark, folder):
    found = detector("tank_id").union(sensors(spark, folder))
    return found.select("event_id", "tank_id", *HELPER_COLUMNS, "anomaly_type", "severity")


@register(
    "anom_all", f"WITH {CANONICAL}{_anomalies_cte()} {UNION_SELECT} FROM u{FIRST_PER_TIME.format(keys='timestamp')}"
)
def anom_all(spark, folder):
    found = detector().all(sensors(spark, folder))
    return found.select("event_id", "tank_id", *HELPER_COLUMNS, "anomaly_type", "severity")


@register(
    "anom_all_by_tank",
    f"WITH {CANONICAL}{_anomalies_cte('tank_id')} {UNION_SELECT} FROM u"
    + FIRST_PER_TIME.format(keys="tank_id, timestamp"),
)
def anom_all_by_tank(spark, folder):
    found = detector("tank_id").all(sensors(spark, folder), dedup=["tank_id", "timestamp"])
    return found.select("event_id", "tank_id", *HELPER_COLUMNS, "anomaly_type", "severity")


@register(
    "anom_timeline",
    f"WITH {CANONICAL}{_anomalies_cte()}, f AS (SELECT * FROM u{FIRST_PER_TIME.format(keys='timestamp')})"
    " SELECT epoch_us(timestamp) AS timestamp, event_id, anomaly_type, severity FROM f ORDER BY 1, 2",
)
def anom_timeline(spark, folder):
    return detector().timeline(sensors(spark, folder)).select("timestamp", "event_id", "anomaly_type", "severity")


@register(
    "anom_counts", f"WITH {CANONICAL}{_anomalies_cte()} SELECT anomaly_type, count(*) AS anomalies FROM u GROUP BY 1"
)
def anom_counts(spark, folder):
    return detector().counts(sensors(spark, folder))


@register("anomaly_json")
def anomaly_json(spark, folder):
    """The detection job with JSON output."""
    t = telemetry(spark, folder).select("event_id", "timestamp_index", "tank_id", "batch_id", *SENSORS)
    return jobs.detect(t, ORDER, as_json=True)


# --- reports ----------------------------------------------------------------------------------

REPORT_CTE = f"{CANONICAL}{METRICS_CTE}{_anomalies_cte()}, f AS (SELECT * FROM u{FIRST_PER_TIME.format(keys='timestamp')})"


def _anomalies(spark, folder):
    return detector().all(sensors(spark, folder)).select("batch_id", "event_id", "anomaly_type", "severity")


@register(
    "anomaly_breakdown",
    f"WITH {REPORT_CTE} SELECT batch_id, anomaly_type, severity, count(*) AS anomalies FROM f GROUP BY 1, 2, 3",
)
def anomaly_breakdown(spark, folder):
    return report.anomaly_breakdown(_anomalies(spark, folder))


RECOMMENDATIONS = f"""concat_ws(' | ',
    CASE WHEN stuck > 0 THEN '{report.STUCK_TEXT}' END, CASE WHEN pressure > 0 THEN '{report.PRESSURE_TEXT}' END,
    CASE WHEN oxidation > 0 THEN '{report.OXIDATION_TEXT}' END,
    CASE WHEN peak_co2_ppm <> 0 AND peak_co2_ppm < 1000 THEN '{report.LOW_PEAK_TEXT}' END,
    CASE WHEN duration_hours > 200 THEN '{report.LONG_TEXT}' END)"""
SEEN_CTE = """, seen AS (SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE anomaly_type = 'stuck_fermentation') AS stuck,
      count(*) FILTER (WHERE anomaly_type LIKE '%pressure%') AS pressure,
      count(*) FILTER (WHERE anomaly_type = 'oxidation_risk') AS oxidation FROM f GROUP BY batch_id)"""


@register(
    "recommendations",
    f"WITH {REPORT_CTE}{SEEN_CTE} SELECT batch_id, coalesce(nullif({RECOMMENDATIONS}, ''), '{report.NORMAL_TEXT}')"
    " AS recommendations FROM m LEFT JOIN seen USING (batch_id)",
)
def recommendations(spark, folder):
    metrics = batch.batch_metrics(telemetry(spark, folder), ORDER)
    texts = report.recommendations(metrics, _anomalies(spark, folder))
    return texts.select("batch_id", F.concat_ws(" | ", "recommendations").alias("recommendations"))


def _map_text(column: str) -> str:
    return (
        f"(SELECT string_agg(k || '=' || n, ';' ORDER BY k) FROM (SELECT {column} AS k, count(*) AS n FROM f"
        f" WHERE f.batch_id = m.batch_id GROUP BY {column}))"
    )


@register(
    "batch_report",
    f"""WITH {REPORT_CTE}{SEEN_CTE}, su AS (SELECT batch_id, count(*) AS total_samples,
      min(timestamp_index) AS start_time, max(timestamp_index) AS end_time FROM t GROUP BY batch_id)
    SELECT m.batch_id, total_samples, epoch_us(start_time) AS start_time, epoch_us(end_time) AS end_time,
      {all_rounded(METRICS)}, num_samples, coalesce(n, 0) AS anomaly_count,
      coalesce({_map_text('anomaly_type')}, '') AS types, coalesce({_map_text('severity')}, '') AS severities,
      coalesce(nullif({RECOMMENDATIONS}, ''), '{report.NORMAL_TEXT}') AS recommendations
    FROM m JOIN su ON su.batch_id = m.batch_id LEFT JOIN seen ON seen.batch_id = m.batch_id""",
)
def batch_report(spark, folder):
    """The nested report, flattened for comparison."""
    reports = report.batch_reports(telemetry(spark, folder), _anomalies(spark, folder), ORDER)

    def as_text(column: str):
        pairs = F.transform(
            F.array_sort(F.map_entries(column)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
        )
        return F.array_join(pairs, ";")

    return reports.select(
        "batch_id",
        "summary.total_samples",
        "summary.start_time",
        "summary.end_time",
        *(F.col(f"metrics.{m}") for m in METRICS),
        "metrics.num_samples",
        F.col("anomalies.count").alias("anomaly_count"),
        as_text("anomalies.types").alias("types"),
        as_text("anomalies.severity_breakdown").alias("severities"),
        F.array_join("recommendations", " | ").alias("recommendations"),
    )
