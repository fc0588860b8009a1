"""Queries: sources, schema mapping, missing values, outliers, scaling, resampling, phases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tankwise import jobs
from tankwise.catalog.registry import CANONICAL, TELEMETRY, all_rounded, register, rounded
from tankwise.functions.phases import phase_by_level, phase_cut, label_code
from tankwise.operators import align, missing, outliers, resample, schema_map, states
from tankwise.operators.scaling import Scaler
from tankwise.session import staged_path
from tankwise.sources import readers
from tankwise.sources.readers import parse_payloads, table
from tankwise.sources.telemetry import ORDER, telemetry

SENSORS = ["co2_ppm", "o2_pct", "pressure_kpa", "process_temp_c"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CANONICAL_ORDER = ("timestamp", "event_id")


def canonical(spark: SparkSession, folder: str) -> DataFrame:
    return schema_map.to_canonical(telemetry(spark, folder), ORDER, rpm_from_temperature=True)


@register(
    "scan_telemetry",
    f"WITH {TELEMETRY} SELECT event_id, epoch_us(timestamp_index) AS timestamp_index, tank_id, batch_id,"
    f" {all_rounded(SENSORS)}, strain, style FROM t",
)
def scan_telemetry(spark, folder):
    return telemetry(spark, folder)


@register(
    "ingest_records",
    f"WITH {TELEMETRY} SELECT event_id, epoch_us(timestamp_index) AS timestamp_index, tank_id,"
    f" {all_rounded(SENSORS)}, CAST(NULL AS DOUBLE) AS ambient_temp_c FROM t",
)
def ingest_records(spark, folder):
    """Telemetry written as request payloads and parsed again; absent fields come back as NULL."""
    t = telemetry(spark, folder)
    iso = F.date_format("timestamp_index", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    record = F.struct(iso.alias("timestamp_index"), "tank_id", *SENSORS, F.lit("x").alias("extra_field"))
    payloads = t.select("event_id", F.to_json(F.struct(F.array(record).alias("sensor_data"))).alias("payload"))
    parsed = parse_payloads(payloads, "payload")
    return parsed.select("event_id", "timestamp_index", "tank_id", *SENSORS, "ambient_temp_c")


@register(
    "map_schema",
    f"WITH {CANONICAL} SELECT event_id, epoch_us(timestamp) AS timestamp, tank_id, batch_id,"
    f" {all_rounded(['co2_lpm', 'do_ppm', 'temp_c', 'pressure_bar'])}, strain, style, valve_state,"
    f" CAST(1000 AS DOUBLE) AS agitator_rpm, target_attenuation, {rounded('\"OG\"', '\"OG\"')},"
    " epoch_us(pitch_time) AS pitch_time FROM c",
)
def map_schema(spark, folder):
    return schema_map.to_canonical(telemetry(spark, folder), ORDER)


@register(
    "map_schema_per_batch",
    f"WITH {CANONICAL} SELECT event_id, agitator_rpm,"
    " epoch_us(min(timestamp) OVER (PARTITION BY batch_id)) AS pitch_time FROM c",
)
def map_schema_per_batch(spark, folder):
    """Agitation from temperature, and one pitch time per batch."""
    mapped = schema_map.to_canonical(telemetry(spark, folder), ORDER, rpm_from_temperature=True, pitch_per_batch=True)
    return mapped.select("event_id", "agitator_rpm", "pitch_time")


@register(
    "unmap_schema",
    f"WITH {TELEMETRY} SELECT event_id, epoch_us(timestamp_index) AS timestamp_index, tank_id, batch_id,"
    f" {all_rounded(SENSORS)} FROM t",
)
def unmap_schema(spark, folder):
    back = schema_map.to_legacy(schema_map.to_canonical(telemetry(spark, folder), ORDER))
    return back.select("event_id", "timestamp_index", "tank_id", "batch_id", *SENSORS)


@register(
    "derive_batch",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS batch_id, strftime(ts, '%Y-%m-%d') AS tank_id,"
    " 'default_strain' AS strain, 'default_style' AS style FROM events",
)
def derive_batch(spark, folder):
    rows = telemetry(spark, folder).select("event_id", F.col("timestamp_index").alias("timestamp"))
    return schema_map.with_identity(rows).select("event_id", "batch_id", "tank_id", "strain", "style")


@register(
    "coalesce_aliases",
    f"WITH {TELEMETRY} SELECT event_id, epoch_us(timestamp_index) AS timestamp,"
    " round(CASE WHEN event_id % 3 = 0 THEN 1.5 ELSE co2_ppm END, 6) + 0.0 AS co2_lpm,"
    " round(pressure_kpa / 100, 6) + 0.0 AS pressure_bar, round(process_temp_c, 6) + 0.0 AS temp_c FROM t",
)
def coalesce_aliases(spark, folder):
    """Every third row already carries the canonical CO2 value, the others only the legacy one."""
    mixed = telemetry(spark, folder).select(
        "event_id",
        "timestamp_index",
        F.when(F.col("event_id") % 3 == 0, 1.5).alias("co2_lpm"),
        "co2_ppm",
        "pressure_kpa",
        "process_temp_c",
    )
    return schema_map.coalesce_aliases(mixed).select("event_id", "timestamp", "co2_lpm", "pressure_bar", "temp_c")


def _profile_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing,"
        f" round((count(*) - count({c})) * 100.0 / count(*), 6) + 0.0 AS missing_pct FROM t"
        for c in columns
    )


TELEMETRY_COLUMNS = ["event_id", "timestamp_index", "tank_id", "batch_id", *SENSORS, "strain", "style"]


@register("missing_profile", f"WITH {TELEMETRY} {_profile_sql(TELEMETRY_COLUMNS)}")
def missing_profile(spark, folder):
    return missing.missing_profile(telemetry(spark, folder), TELEMETRY_COLUMNS)


def _gap_sql(filled: str, keys: str = "") -> str:
    """Nearest valid values around each row, from counts of valid values and their positions."""
    by = f"PARTITION BY {keys}" if keys else ""
    return f"""WITH {TELEMETRY}, n AS (
      SELECT *, row_number() OVER ({by} ORDER BY timestamp_index, event_id) - 1 AS i FROM t),
    g AS (
      SELECT *, last_value(co2_ppm IGNORE NULLS) OVER before AS pv,
             last_value(CASE WHEN co2_ppm IS NOT NULL THEN i END IGNORE NULLS) OVER before AS pi,
             first_value(co2_ppm IGNORE NULLS) OVER behind AS nv,
             first_value(CASE WHEN co2_ppm IS NOT NULL THEN i END IGNORE NULLS) OVER behind AS ni
      FROM n
      WINDOW before AS ({by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             behind AS ({by} ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_id, round({filled}, 6) + 0.0 AS co2_ppm FROM g"""


def _line(distance: str) -> str:
    return f"CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) / (ni - pi) * {distance} END"


INTERPOLATED = f"CASE WHEN co2_ppm IS NOT NULL THEN co2_ppm WHEN i - pi <= 3 THEN {_line('(i - pi)')} END"
BOTH_FILLED = f"coalesce({INTERPOLATED}, CASE WHEN i - pi <= 6 THEN {_line('3')} END, nv)"


@register("interpolate_limit", _gap_sql(INTERPOLATED))
def interpolate_limit(spark, folder):
    return missing.interpolate(telemetry(spark, folder), ORDER, ["co2_ppm"]).select("event_id", "co2_ppm")


@register("ffill_limit", _gap_sql("coalesce(co2_ppm, CASE WHEN i - pi <= 3 THEN pv END)"))
def ffill_limit(spark, folder):
    return missing.forward_fill(telemetry(spark, folder), ORDER, ["co2_ppm"]).select("event_id", "co2_ppm")


@register("bfill", _gap_sql("nv"))
def bfill(spark, folder):
    return missing.backward_fill(telemetry(spark, folder), ORDER, ["co2_ppm"]).select("event_id", "co2_ppm")


@register("missing_both", _gap_sql(BOTH_FILLED))
def missing_both(spark, folder):
    handler = missing.MissingHandler(ORDER, "both", 3, columns=["co2_ppm"])
    t = telemetry(spark, folder).select(*ORDER, "co2_ppm")
    return handler.fit(t).transform(t).select("event_id", "co2_ppm")


@register("missing_by_tank", _gap_sql(BOTH_FILLED, "tank_id"))
def missing_by_tank(spark, folder):
    t = telemetry(spark, folder).select(*ORDER, "tank_id", "co2_ppm")
    return missing.fill_gaps(t, ORDER, ["tank_id"], method="both").select("event_id", "co2_ppm")


def _quantile_bounds(c: str) -> tuple[str, str]:
    q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    return f"{q1} - 1.5 * ({q3} - {q1})", f"{q3} + 1.5 * ({q3} - {q1})"


def _bounds_sql(kind: str) -> str:
    parts = []
    for c in MEASURES:
        if kind == "iqr":
            low, high = _quantile_bounds(c)
        else:
            low, high = f"avg({c}) - 3 * stddev_samp({c})", f"avg({c}) + 3 * stddev_samp({c})"
        parts.append(
            f"SELECT '{c}' AS \"column\", {rounded(low, 'lower', 4)}, {rounded(high, 'upper', 4)} FROM lineitem"
        )
    return " UNION ALL ".join(parts)


def lineitem(spark, folder):
    return table(spark, folder, "lineitem")


@register("iqr_bounds", _bounds_sql("iqr"), digits=4)
def iqr_bounds(spark, folder):
    rows = lineitem(spark, folder)
    return outliers.bounds_table(rows, outliers.iqr_bounds(rows, MEASURES))


@register("zscore_bounds", _bounds_sql("zscore"), digits=4)
def zscore_bounds(spark, folder):
    rows = lineitem(spark, folder)
    return outliers.bounds_table(rows, outliers.zscore_bounds(rows, MEASURES))


# Telemetry has real outliers in co2_ppm; the line items have none by quartiles.
BOUNDS_CTE = ", b AS (SELECT " + ", ".join(
    f"{low} AS {c}_low, {high} AS {c}_high" for c in SENSORS for low, high in [_quantile_bounds(c)]
) + " FROM t)"


def _outside(c: str) -> str:
    return f"coalesce({c} < {c}_low OR {c} > {c}_high, false)"


def _handled(spark, folder, action: str):
    rows = telemetry(spark, folder)
    return rows, outliers.OutlierHandler("iqr", action=action, columns=SENSORS).fit(rows)


@register(
    "outlier_clip",
    f"WITH {TELEMETRY}{BOUNDS_CTE} SELECT event_id, "
    + ", ".join(
        rounded(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {c}_low), {c}_high) END", c)
        for c in SENSORS
    )
    + " FROM t, b",
)
def outlier_clip(spark, folder):
    rows, model = _handled(spark, folder, "clip")
    return model.transform(rows).select("event_id", *SENSORS)


@register(
    "outlier_remove",
    f"WITH {TELEMETRY}{BOUNDS_CTE} SELECT event_id, {all_rounded(SENSORS)} FROM t, b"
    f" WHERE NOT ({' OR '.join(map(_outside, SENSORS))})",
)
def outlier_remove(spark, folder):
    rows, model = _handled(spark, folder, "remove")
    return model.transform(rows).select("event_id", *SENSORS)


@register(
    "outlier_mark",
    f"WITH {TELEMETRY}{BOUNDS_CTE} SELECT event_id, "
    + ", ".join(f"CAST({_outside(c)} AS INTEGER) AS {c}_outlier" for c in SENSORS)
    + " FROM t, b",
)
def outlier_mark(spark, folder):
    rows, model = _handled(spark, folder, "mark")
    return model.transform(rows).select("event_id", *(f"{c}_outlier" for c in SENSORS))


def _sequential_counts() -> str:
    parts, before = [], []
    for c in SENSORS:
        kept = " AND ".join([f"NOT {_outside(p)}" for p in before] + [_outside(c)])
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {kept}) AS outliers FROM t, b")
        before.append(c)
    return " UNION ALL ".join(parts)


@register("outlier_counts", f"WITH {TELEMETRY}{BOUNDS_CTE} {_sequential_counts()}")
def outlier_counts(spark, folder):
    rows, model = _handled(spark, folder, "remove")
    return model.counts(rows)


ROW_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _scale_sql(center: str, spread: str) -> str:
    fitted = ", ".join(f"{center.format(c=c)} AS m_{c}, {spread.format(c=c)} AS s_{c}" for c in MEASURES)
    scaled = ", ".join(rounded(f"({c} - m_{c}) / (s_{c} + 1e-10)", c) for c in MEASURES)
    return f"WITH p AS (SELECT {fitted} FROM lineitem) SELECT {ROW_ID}, {scaled} FROM lineitem, p"


def _scale(spark, folder, method: str):
    rows = lineitem(spark, folder).select(*ROW_ID.split(", "), *MEASURES)
    return Scaler(method, columns=MEASURES).fit(rows).transform(rows)


@register("scale_standard", _scale_sql("avg({c})", "stddev_samp({c})"))
def scale_standard(spark, folder):
    return _scale(spark, folder, "standard")


@register("scale_minmax", _scale_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(spark, folder):
    return _scale(spark, folder, "minmax")


@register(
    "scale_robust", _scale_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")
)
def scale_robust(spark, folder):
    return _scale(spark, folder, "robust")


def _by_tank_sql(center: str, spread: str) -> str:
    fitted = ", ".join(f"{center.format(c=c)} AS m_{c}, {spread.format(c=c)} AS s_{c}" for c in SENSORS)
    scaled = ", ".join(rounded(f"({c} - m_{c}) / (s_{c} + 1e-10)", c) for c in SENSORS)
    return (
        f"WITH {TELEMETRY}, p AS (SELECT tank_id, {fitted} FROM t GROUP BY tank_id)"
        f" SELECT event_id, {scaled} FROM t JOIN p USING (tank_id)"
    )


def _scale_by_tank(spark, folder, method: str):
    rows = telemetry(spark, folder).select("event_id", "tank_id", *SENSORS)
    return Scaler(method, "tank_id", SENSORS).fit(rows).transform(rows).select("event_id", *SENSORS)


@register("scale_by_tank", _by_tank_sql("avg({c})", "stddev_samp({c})"))
def scale_by_tank(spark, folder):
    return _scale_by_tank(spark, folder, "standard")


@register(
    "scale_robust_by_tank",
    _by_tank_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
)
def scale_robust_by_tank(spark, folder):
    return _scale_by_tank(spark, folder, "robust")


@register(
    "scale_unseen",
    f"WITH {TELEMETRY}, p AS (SELECT tank_id, avg(co2_ppm) AS m, stddev_samp(co2_ppm) AS s FROM t"
    " WHERE style = 'ipa' GROUP BY tank_id) SELECT event_id,"
    " round(CASE WHEN p.tank_id IS NULL THEN co2_ppm ELSE (co2_ppm - m) / (s + 1e-10) END, 6) + 0.0 AS co2_ppm"
    " FROM t LEFT JOIN p ON t.tank_id = p.tank_id",
)
def scale_unseen(spark, folder):
    """Fitted on the tanks of one style, applied to all tanks."""
    rows = telemetry(spark, folder).select("event_id", "tank_id", "style", "co2_ppm")
    model = Scaler("standard", "tank_id", ["co2_ppm"]).fit(rows.filter(F.col("style") == "ipa"))
    return model.transform(rows).select("event_id", "co2_ppm")


@register(
    "modal_interval",
    "WITH d AS (SELECT date_diff('microsecond', lag(o_orderdate) OVER (ORDER BY o_orderdate, o_orderkey),"
    " o_orderdate) AS step FROM orders) SELECT round(step / 1e6, 6) + 0.0 AS interval_seconds,"
    " count(*) AS occurrences FROM d WHERE step IS NOT NULL GROUP BY step ORDER BY 2 DESC, 1 LIMIT 1",
)
def modal_interval(spark, folder):
    return resample.modal_interval(table(spark, folder, "orders"), ["o_orderdate", "o_orderkey"])


def _grid_sql(aggregates: str, selected: str, by: str = "", minutes: int = 5) -> str:
    keys, using = (f"{by}, ", f"{by}, ") if by else ("", "")
    on = "(" + using + "bucket)"
    return f"""WITH {TELEMETRY}, b AS (
      SELECT *, time_bucket(INTERVAL {minutes} MINUTE, timestamp_index, TIMESTAMP '2000-01-01') AS bucket FROM t),
    a AS (SELECT {keys}bucket, {aggregates} FROM b GROUP BY {keys}bucket),
    e AS (SELECT {keys}min(bucket) AS lo, max(bucket) AS hi FROM a {'GROUP BY ' + by if by else ''}),
    g AS (SELECT {keys}unnest(generate_series(lo, hi, INTERVAL {minutes} MINUTE)) AS bucket FROM e)
    SELECT {keys}epoch_us(bucket) AS timestamp_index, {selected} FROM g LEFT JOIN a USING {on}"""


MEANS = ", ".join(f"avg({c}) AS {c}" for c in SENSORS)


@register("resample_mean", _grid_sql(MEANS, all_rounded(SENSORS)))
def resample_mean(spark, folder):
    return resample.resample(telemetry(spark, folder), "timestamp_index", 5, "mean", columns=SENSORS)


@register(
    "resample_median",
    _grid_sql(", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in SENSORS), all_rounded(SENSORS), minutes=60),
)
def resample_median(spark, folder):
    return resample.resample(telemetry(spark, folder), "timestamp_index", 60, "median", columns=SENSORS)


@register(
    "resample_interp",
    f"""WITH r AS ({_grid_sql('avg(o2_pct) AS v', 'v')}),
    n AS (SELECT *, row_number() OVER (ORDER BY timestamp_index) AS i FROM r),
    g AS (SELECT *, last_value(v IGNORE NULLS) OVER before AS pv,
            last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER before AS pi,
            first_value(v IGNORE NULLS) OVER behind AS nv,
            first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER behind AS ni FROM n
          WINDOW before AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 behind AS (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT timestamp_index, round(CASE WHEN v IS NOT NULL THEN v ELSE {_line('(i - pi)')} END, 9) + 0.0 AS o2_pct
    FROM g""",
    digits=9,
)
def resample_interp(spark, folder):
    return resample.resample(telemetry(spark, folder), "timestamp_index", 5, "interpolate", columns=["o2_pct"])


@register(
    "resample_first",
    _grid_sql(
        "avg(co2_ppm) AS co2_ppm, arg_min(strain, (timestamp_index, event_id)) AS strain,"
        " arg_min(style, (timestamp_index, event_id)) AS style",
        f"{all_rounded(['co2_ppm'])}, strain, style",
    ),
)
def resample_first(spark, folder):
    return resample.resample(
        telemetry(spark, folder), "timestamp_index", 5, "mean", (), ["co2_ppm"], ["strain", "style"], ORDER
    )


@register("resample_by_tank", _grid_sql(MEANS, all_rounded(SENSORS), "tank_id", 60))
def resample_by_tank(spark, folder):
    return resample.resample(telemetry(spark, folder), "timestamp_index", 60, "mean", ["tank_id"], SENSORS)


@register(
    "learn_profiles",
    f"WITH {TELEMETRY} SELECT strain, style, {rounded('avg(co2_ppm)', 'mean_co2')},"
    f" {rounded('max(co2_ppm)', 'max_co2')} FROM t GROUP BY strain, style",
)
def learn_profiles(spark, folder):
    return align.learn_profiles(telemetry(spark, folder), "co2_ppm")


LEVEL_SQL = (
    "CASE WHEN co2_ppm < 500 THEN 'lag' WHEN co2_ppm < 1000 THEN 'exponential'"
    " WHEN co2_ppm < 1500 THEN 'stationary' ELSE 'decline' END"
)


@register(
    "align_phase",
    f"""WITH {TELEMETRY}, p AS (SELECT strain, style, max(co2_ppm) AS peak FROM t WHERE strain <> 'signup' GROUP BY 1, 2),
    j AS (SELECT t.*, p.strain IS NOT NULL AS known,
                 CASE WHEN co2_ppm > 0 THEN coalesce(peak, co2_ppm) ELSE 1 END AS m
          FROM t LEFT JOIN p ON t.strain = p.strain AND t.style = p.style)
    SELECT event_id, CASE WHEN NOT known THEN {LEVEL_SQL} WHEN m <= 0 THEN 'unknown'
      WHEN co2_ppm / m < 0.1 THEN 'lag' WHEN co2_ppm / m < 0.5 THEN 'exponential'
      WHEN co2_ppm / m < 0.9 THEN 'stationary' ELSE 'decline' END AS phase FROM j""",
)
def align_phase(spark, folder):
    """Profiles of four strains; rows of the fifth fall back to absolute levels."""
    t = telemetry(spark, folder)
    profiles = align.learn_profiles(t.filter(F.col("strain") != "signup"), "co2_ppm")
    return align.Aligner("co2_ppm", profiles).fit(t).transform(t).select("event_id", "phase")


@register("phase_absolute", f"WITH {TELEMETRY} SELECT event_id, {LEVEL_SQL} AS phase FROM t")
def phase_absolute(spark, folder):
    return telemetry(spark, folder).select("event_id", phase_by_level(F.col("co2_ppm")).alias("phase"))


@register(
    "phase_cut",
    f"""WITH {TELEMETRY}, p AS (SELECT event_id, CASE WHEN co2_ppm <= 0 THEN NULL WHEN co2_ppm <= 500 THEN 'lag'
      WHEN co2_ppm <= 1000 THEN 'exponential' WHEN co2_ppm <= 1500 THEN 'stationary'
      WHEN co2_ppm > 1500 THEN 'decline' END AS phase FROM t)
    SELECT event_id, phase, CASE phase WHEN 'exponential' THEN 1 WHEN 'stationary' THEN 2
      WHEN 'decline' THEN 3 ELSE 0 END AS label FROM p""",
)
def phase_cut_query(spark, folder):
    phase = phase_cut(F.col("co2_ppm"))
    return telemetry(spark, folder).select("event_id", phase.alias("phase"), label_code(phase).alias("label"))


def _curve_sql(where: str = "") -> str:
    return f"""WITH {TELEMETRY}, s AS (SELECT batch_id, min(timestamp_index) AS start FROM t GROUP BY batch_id),
    x AS (SELECT t.*, CAST(floor(date_diff('microsecond', start, timestamp_index) / 6e7 / 5) AS BIGINT) AS step
          FROM t JOIN s USING (batch_id)),
    c AS (SELECT strain, style, step, avg(co2_ppm) AS co2_ppm, avg(o2_pct) AS o2_pct FROM x GROUP BY 1, 2, 3),
    n AS (SELECT *, max(step) OVER (PARTITION BY strain, style) + 1 AS n FROM c)
    SELECT strain, style, step, {all_rounded(['co2_ppm', 'o2_pct'])},
      CASE WHEN step < floor(n * 0.1) THEN 'lag' WHEN step < floor(n * 0.4) THEN 'exponential'
           WHEN step < floor(n * 0.7) THEN 'stationary' ELSE 'decline' END AS phase, step * 5 AS time_minutes
    FROM n {where}"""


@register("golden_learn", _curve_sql())
def golden_learn(spark, folder):
    return align.learn_curves(telemetry(spark, folder), "timestamp_index", ["co2_ppm", "o2_pct"])


@register("golden_lookup", _curve_sql("WHERE strain = 'click' AND style = 'ipa'"))
def golden_lookup(spark, folder):
    curves = align.learn_curves(telemetry(spark, folder), "timestamp_index", ["co2_ppm", "o2_pct"])
    return align.lookup_curve(curves, "click", "ipa")


def _preprocess_sql(keys: str = "") -> str:
    by = f"PARTITION BY {keys}" if keys else ""
    return f"""WITH {TELEMETRY}, n AS (
      SELECT *, row_number() OVER ({by} ORDER BY timestamp_index, event_id) - 1 AS i FROM t),
    g AS (
      SELECT *, last_value(co2_ppm IGNORE NULLS) OVER before AS pv,
             last_value(CASE WHEN co2_ppm IS NOT NULL THEN i END IGNORE NULLS) OVER before AS pi,
             first_value(co2_ppm IGNORE NULLS) OVER behind AS nv,
             first_value(CASE WHEN co2_ppm IS NOT NULL THEN i END IGNORE NULLS) OVER behind AS ni
      FROM n
      WINDOW before AS ({by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             behind AS ({by} ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    f AS (SELECT tank_id, timestamp_index, event_id, strain, style, {BOTH_FILLED} AS co2, o2_pct AS o2 FROM g),
    q AS (SELECT quantile_cont(co2, 0.25) AS a, quantile_cont(co2, 0.75) AS b,
                 quantile_cont(o2, 0.25) AS a2, quantile_cont(o2, 0.75) AS b2 FROM f),
    k AS (SELECT tank_id, timestamp_index, event_id, strain, style,
                 least(greatest(co2, a - 1.5 * (b - a)), b + 1.5 * (b - a)) AS co2,
                 least(greatest(o2, a2 - 1.5 * (b2 - a2)), b2 + 1.5 * (b2 - a2)) AS o2,
                 time_bucket(INTERVAL 60 MINUTE, timestamp_index, TIMESTAMP '2000-01-01') AS bucket FROM f, q),
    a AS (SELECT tank_id, bucket, avg(co2) AS co2, avg(o2) AS o2,
                 arg_min(strain, (timestamp_index, event_id)) AS strain,
                 arg_min(style, (timestamp_index, event_id)) AS style FROM k GROUP BY 1, 2),
    e AS (SELECT tank_id, min(bucket) AS lo, max(bucket) AS hi FROM a GROUP BY 1),
    r AS (SELECT tank_id, bucket, co2, o2, strain, style FROM
            (SELECT tank_id, unnest(generate_series(lo, hi, INTERVAL 60 MINUTE)) AS bucket FROM e)
            LEFT JOIN a USING (tank_id, bucket)),
    p AS (SELECT strain, style, max(co2) AS peak FROM r WHERE strain IS NOT NULL GROUP BY 1, 2),
    h AS (SELECT r.*, CASE WHEN p.strain IS NULL THEN
                   CASE WHEN co2 < 500 THEN 'lag' WHEN co2 < 1000 THEN 'exponential'
                        WHEN co2 < 1500 THEN 'stationary' ELSE 'decline' END
                 WHEN co2 > 0 AND peak <= 0 THEN 'unknown'
                 WHEN co2 / CASE WHEN co2 > 0 THEN peak ELSE 1 END < 0.1 THEN 'lag'
                 WHEN co2 / CASE WHEN co2 > 0 THEN peak ELSE 1 END < 0.5 THEN 'exponential'
                 WHEN co2 / CASE WHEN co2 > 0 THEN peak ELSE 1 END < 0.9 THEN 'stationary'
                 ELSE 'decline' END AS phase
          FROM r LEFT JOIN p ON r.strain = p.strain AND r.style = p.style),
    z AS (SELECT tank_id, avg(co2) AS m, stddev_samp(co2) AS s, avg(o2) AS m2, stddev_samp(o2) AS s2
          FROM r GROUP BY tank_id)
    SELECT tank_id, epoch_us(bucket) AS timestamp_index, strain, style, phase,
           round((co2 - m) / (s + 1e-10), 6) + 0.0 AS co2_ppm, round((o2 - m2) / (s2 + 1e-10), 6) + 0.0 AS o2_pct
    FROM h JOIN z USING (tank_id)"""


def _preprocessed(spark, folder, **settings):
    t = telemetry(spark, folder).select(*ORDER, "tank_id", "strain", "style", "co2_ppm", "o2_pct")
    chain = jobs.preprocessing(ORDER, ["co2_ppm", "o2_pct"], minutes=60, **settings)
    _, prepared = jobs.fit_transform(chain, t)
    return prepared.select("tank_id", "timestamp_index", "strain", "style", "phase", "co2_ppm", "o2_pct")


@register("preprocess_by_tank", _preprocess_sql("tank_id"))
def preprocess_by_tank(spark, folder):
    """Gap filling per tank, clipping, hourly grid per tank, phase labels and scaling as one
    ``pyspark.ml`` chain."""
    return _preprocessed(spark, folder)


@register("preprocess_e2e", _preprocess_sql())
def preprocess_e2e(spark, folder):
    """The same with gaps filled in the row order of the whole table."""
    return _preprocessed(spark, folder, gaps_by=())


@register(
    "incremental_fit",
    f"""WITH {CANONICAL}, x AS (
      SELECT tank_id, 'co2_lpm' AS "column", co2_lpm AS v FROM c
      UNION ALL SELECT tank_id, 'pressure_bar', pressure_bar FROM c),
    m AS (SELECT tank_id, "column", count(v) AS n, avg(v) AS mu FROM x GROUP BY ALL),
    d AS (SELECT x.*, n, mu, v - mu AS e FROM x JOIN m USING (tank_id, "column"))
    SELECT tank_id, "column", n, {rounded('any_value(mu)', 'mean', 4)}, {rounded('stddev_samp(v)', 'std', 4)},
      round(CASE WHEN sum(e * e) > 0 THEN sqrt(n) * sum(e * e * e) / (sum(e * e) * sqrt(sum(e * e))) ELSE 0 END, 4) + 0.0 AS skew,
      round(CASE WHEN sum(e * e) > 0 THEN n * sum(e * e * e * e) / (sum(e * e) * sum(e * e)) - 3 ELSE 0 END, 4) + 0.0 AS kurt,
      {rounded('min(v)', 'low', 4)}, {rounded('max(v)', 'high', 4)}
    FROM d GROUP BY tank_id, "column", n""",
    digits=4,
)
def incremental_fit(spark, folder):
    """Statistics per tank from the stored states of all days but the last, to which the last is added."""
    rows, columns, path = canonical(spark, folder), ["co2_lpm", "pressure_bar"], staged_path(spark, "states")
    newest = rows.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return states.summary(states.merged(states.states(rows, ["tank_id"], columns), ["tank_id"]))
    states.append(rows.filter(F.col("batch_id") < newest), path, ["tank_id"], columns, "before")
    states.append(rows.filter(F.col("batch_id") == newest), path, ["tank_id"], columns, newest)
    found = states.summary(states.read(spark, path, ["tank_id"]))
    return found.select("tank_id", "column", "n", "mean", "std", "skew", "kurt", "low", "high")


@register(
    "record_extras",
    f"SELECT event_id, {rounded('value', 'co2_lpm')}, CAST(json_extract(props, '$.k') AS BIGINT) AS k,"
    " 'T' || user_id AS tank FROM events",
)
def record_extras(spark, folder):
    """Records with a nested field beyond the typed ones, and back."""
    events = table(spark, folder, "events")
    made = F.concat(F.lit('{"co2_lpm":'), F.col("value").cast("string"), F.lit(',"props":'), F.col("props"), F.lit(',"tank":"T'), F.col("user_id").cast("string"), F.lit('"}'))
    parsed = readers.with_extras(events.select("event_id", made.alias("body")), "body")
    told = parsed.select("event_id", "co2_lpm", readers.extra("props", "$.k", "long").alias("k"), readers.extra("tank", "$", "string").alias("tank"))
    return told
