"""Queries: batch analytics, similarity, features, changepoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tankwise.catalog.preparation import CANONICAL_ORDER, SENSORS, canonical
from tankwise.catalog.registry import CANONICAL, TELEMETRY, all_rounded, register, rounded
from tankwise.operators import align, batch, changepoints, features, neighbours, pelt, similarity
from tankwise.sources.readers import table
from tankwise.sources.telemetry import ORDER, telemetry

TIME_ORDER = "ORDER BY timestamp_index, event_id"

METRICS_CTE = """, o AS (
      SELECT batch_id, max(co2_ppm) AS peak, min(timestamp_index) AS start, max(timestamp_index) AS finish,
             arg_min(o2_pct, (timestamp_index, event_id)) AS do0,
             arg_min(pressure_kpa, (timestamp_index, event_id)) AS p0,
             arg_max(pressure_kpa, (timestamp_index, event_id)) AS p1, count(*) AS num_samples
      FROM t GROUP BY batch_id),
    m AS (
      SELECT t.batch_id, any_value(peak) AS peak_co2_ppm,
             date_diff('microsecond', any_value(start),
                       min(timestamp_index) FILTER (WHERE co2_ppm = peak)) / 6e7 AS time_to_peak_minutes,
             date_diff('microsecond', any_value(start),
                       min(timestamp_index) FILTER (WHERE do0 > 0 AND o2_pct <= do0 / 2)) / 6e7 AS do_half_life_minutes,
             any_value(p1) - any_value(p0) AS pressure_growth_kpa,
             date_diff('microsecond', any_value(start), any_value(finish)) / 3.6e9 AS duration_hours,
             any_value(num_samples) AS num_samples
      FROM t JOIN o ON t.batch_id = o.batch_id GROUP BY t.batch_id)"""
METRICS = ["peak_co2_ppm", "time_to_peak_minutes", "do_half_life_minutes", "pressure_growth_kpa", "duration_hours"]


@register(
    "batch_metrics", f"WITH {TELEMETRY}{METRICS_CTE} SELECT batch_id, {all_rounded(METRICS)}, num_samples FROM m"
)
def batch_metrics(spark, folder):
    return batch.batch_metrics(telemetry(spark, folder), ORDER)


def _moments(c: str, size: int, values: str) -> dict[str, str]:
    """SQL of frame statistics from the list of valid values in the frame and its number of rows."""
    n, m = f"len({values})", f"list_avg({values})"
    rows = f"rows_{size}"

    def power(k: int) -> str:
        return f"list_sum(list_transform({values}, lambda x: pow(x - {m}, {k})))"

    constant = f"list_max({values}) = list_min({values})"
    g1 = f"({power(3)} / {n}) / pow({power(2)} / {n}, 1.5)"
    g2 = f"({power(4)} / {n}) / pow({power(2)} / {n}, 2) - 3"
    return {
        "mean": m,
        "std": f"CASE WHEN {n} > 1 THEN sqrt({power(2)} / ({n} - 1)) END",
        "skew": f"CASE WHEN {n} < 3 THEN NULL WHEN {constant} THEN 0"
        f" ELSE sqrt({n} * ({n} - 1.0)) / ({n} - 2) * {g1} END",
        "kurt": f"CASE WHEN {n} = 0 THEN NULL WHEN {rows} <= 3 THEN 0 WHEN {n} < 4 THEN NULL WHEN {constant} THEN 0"
        f" ELSE ({n} - 1.0) / (({n} - 2) * ({n} - 3)) * (({n} + 1) * ({g2}) + 6) END",
    }


def _frames_cte(columns: list[str], sizes: list[int], source: str, order: str, keys: str = "") -> str:
    by = f"PARTITION BY {keys}" if keys else ""
    picks, windows = [], []
    for size in sizes:
        windows.append(f"w{size} AS ({by} {order} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)")
        picks.append(f"count(*) OVER w{size} AS rows_{size}")
        picks += [
            f"coalesce(list({c}::DOUBLE) FILTER (WHERE {c} IS NOT NULL) OVER w{size}, []) AS {c}_{size}" for c in columns
        ]
    return f", l AS (SELECT *, {', '.join(picks)} FROM {source} WINDOW {', '.join(windows)})"


def _rolling_sql(columns: list[str], keys: str = "") -> str:
    picks = []
    for c in columns:
        s = _moments(c, 12, f"{c}_12")
        picks += [
            rounded(s["mean"], f"{c}_rolling_mean"),
            rounded(s["std"], f"{c}_rolling_std"),
            rounded(s["kurt"], f"{c}_rolling_kurtosis"),
            rounded(f"({s['std']}) / ({s['mean']} + 1e-10)", f"{c}_rolling_cv"),
        ]
    return f"WITH {TELEMETRY}{_frames_cte(columns, [12], 't', TIME_ORDER, keys)} SELECT event_id, {', '.join(picks)} FROM l"


def _rolling(spark, folder, keys):
    rolled = batch.rolling_statistics(telemetry(spark, folder).select(*ORDER, "tank_id", *SENSORS), ORDER, keys, SENSORS)
    return rolled.drop("timestamp_index", "tank_id", *SENSORS)


@register("rolling_stats", _rolling_sql(SENSORS))
def rolling_stats(spark, folder):
    return _rolling(spark, folder, [])


@register("rolling_by_tank", _rolling_sql(SENSORS, "tank_id"))
def rolling_by_tank(spark, folder):
    return _rolling(spark, folder, ["tank_id"])


@register(
    "batch_compare",
    "SELECT o_orderstatus, round(avg(o_totalprice), 4) + 0.0 AS o_totalprice FROM orders GROUP BY o_orderstatus",
    digits=4,
)
def batch_compare(spark, folder):
    return batch.compare(table(spark, folder, "orders"), "o_orderstatus", "o_totalprice")


@register(
    "batch_pivot",
    "SELECT l_returnflag, "
    + ", ".join(f"round(avg(l_quantity) FILTER (WHERE l_linestatus = '{s}'), 6) + 0.0 AS \"{s}\"" for s in "FO")
    + " FROM lineitem GROUP BY l_returnflag",
)
def batch_pivot(spark, folder):
    return batch.compare(
        table(spark, folder, "lineitem"), "l_returnflag", "l_quantity", columns="l_linestatus", column_values=["F", "O"]
    )


@register(
    "attenuation_slope",
    f"""WITH {TELEMETRY}, n AS (SELECT batch_id, process_temp_c AS v,
        row_number() OVER (PARTITION BY batch_id {TIME_ORDER}) - 1 AS i FROM t)
    SELECT batch_id, {rounded('regr_slope(v, i)', 'attenuation_slope')},
           {rounded('arg_min(v, i)', 'initial_co2')}, {rounded('arg_max(v, i)', 'final_co2')}
    FROM n GROUP BY batch_id HAVING count(*) >= 2 AND count(*) = count(v) AND max(v) > min(v)""",
)
def attenuation_slope(spark, folder):
    """On the temperature column, which has no gaps: a batch with a missing value has no slope."""
    return batch.attenuation_slope(telemetry(spark, folder), ORDER, co2="process_temp_c")


CENTROIDS = """m AS (SELECT label, i, avg(embedding[i]) AS v FROM embeddings, range(1, 65) r(i) GROUP BY label, i)"""


@register(
    "cosine_to_centroid",
    f"""WITH {CENTROIDS}, x AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i))
    SELECT vec_id, label, round(sum(x.v * m.v) / ((sqrt(sum(x.v * x.v)) + 1e-10) * (sqrt(sum(m.v * m.v)) + 1e-10)), 6)
      + 0.0 AS similarity FROM x JOIN m USING (label, i) GROUP BY vec_id, label""",
)
def cosine_to_centroid(spark, folder):
    scored = similarity.cosine_to_centroid(table(spark, folder, "embeddings"), "label", "embedding")
    return scored.select("vec_id", "label", "similarity")


@register(
    "pairwise_euclid",
    f"""WITH {CENTROIDS} SELECT x.label AS a, y.label AS b,
    round(sqrt(sum((x.v - y.v) * (x.v - y.v))), 6) + 0.0 AS distance
    FROM m x JOIN m y ON x.i = y.i GROUP BY x.label, y.label""",
)
def pairwise_euclid(spark, folder):
    """Distances between the mean vectors of all labels."""
    means = similarity.centroids(table(spark, folder, "embeddings"), "label", "embedding")
    return similarity.distances(means, "label", "centroid")


@register(
    "nearest_rows",
    """WITH d AS (SELECT a.vec_id, b.vec_id AS neighbour,
        list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance
      FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS place FROM d)
    SELECT vec_id, neighbour, CAST(place AS INTEGER) AS place, round(distance, 6) + 0.0 AS distance FROM r WHERE place <= 5""",
)
def nearest_rows(spark, folder):
    """The five nearest vectors of the same label, for every row."""
    return neighbours.nearest_rows(table(spark, folder, "embeddings"), "vec_id", "embedding", 5, "label")


@register(
    "tank_distances",
    f"""WITH {TELEMETRY}, m AS (SELECT batch_id, {', '.join(f'avg({c}) AS {c}' for c in SENSORS)} FROM t GROUP BY batch_id)
    SELECT x.batch_id AS a, y.batch_id AS b,
      round(sqrt({' + '.join(f'(x.{c} - y.{c}) * (x.{c} - y.{c})' for c in SENSORS)}), 6) + 0.0 AS distance
    FROM m x, m y""",
)
def tank_distances(spark, folder):
    return similarity.tank_distances(telemetry(spark, folder), "batch_id", SENSORS)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    "pearson_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})), 6) + 0.0"
        " AS correlation FROM lineitem"
        for a in MEASURES
        for b in MEASURES
    ),
)
def pearson_matrix(spark, folder):
    return similarity.pearson_matrix(table(spark, folder, "lineitem"), MEASURES)


GOLDEN_CTE = """, u AS (SELECT *, coalesce({value}, 0) AS x FROM {source}),
    s AS (SELECT batch_id, min({time}) AS start FROM u GROUP BY batch_id),
    cv AS (SELECT CAST(floor(date_diff('microsecond', start, {time}) / 6e7 / 5) AS BIGINT) AS step, avg(x) AS g
          FROM u JOIN s USING (batch_id) WHERE style = 'ipa' GROUP BY 1),
    gl AS (SELECT row_number() OVER (ORDER BY step) - 1 AS at, g FROM cv),
    n AS (SELECT batch_id, x, row_number() OVER (PARTITION BY batch_id ORDER BY {time}, event_id) - 1 AS i,
                 count(*) OVER (PARTITION BY batch_id) AS len, (SELECT count(*) FROM gl) AS points FROM u),
    sp AS (SELECT batch_id, x, CASE WHEN len > 1 THEN i * (points - 1) / (len - 1) ELSE 0 END AS spot FROM n),
    st AS (SELECT batch_id, x, lo.g + (hi.g - lo.g) * (spot - floor(spot)) AS g
           FROM sp JOIN gl lo ON lo.at = CAST(floor(spot) AS BIGINT) JOIN gl hi ON hi.at = CAST(ceil(spot) AS BIGINT)),
    sim AS (SELECT batch_id, sum(x * g) / ((sqrt(sum(x * x)) + 1e-10) * (sqrt(sum(g * g)) + 1e-10)) AS similarity
            FROM st GROUP BY batch_id)"""


def golden_inputs(rows, time: str, value: str):
    """Rows with the missing values of ``value`` as 0, and the average course of the even tanks."""
    whole = rows.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))
    curves = align.learn_curves(whole, time, [value], keys=["style"])
    return whole, curves.filter(F.col("style") == "ipa").select("step", value)


@register(
    "golden_similarity",
    f"WITH {TELEMETRY}{GOLDEN_CTE.format(value='co2_ppm', source='t', time='timestamp_index')}"
    f" SELECT batch_id, {rounded('similarity', 'similarity')} FROM sim",
)
def golden_similarity(spark, folder):
    whole, golden = golden_inputs(telemetry(spark, folder), "timestamp_index", "co2_ppm")
    return similarity.golden_similarity(whole, golden, ORDER, "co2_ppm")


@register(
    "feat_poly",
    f"WITH {TELEMETRY} SELECT event_id, "
    + ", ".join(rounded(f"pow({c}, {d})", f"{c}_poly_{d}", 4) for c in ("co2_ppm", "process_temp_c") for d in (2, 3))
    + " FROM t",
    digits=4,
)
def feat_poly(spark, folder):
    t = telemetry(spark, folder).select("event_id", "co2_ppm", "process_temp_c")
    return features.polynomial(t, ["co2_ppm", "process_temp_c"], 3).drop("co2_ppm", "process_temp_c")


@register(
    "feat_interact",
    f"WITH {TELEMETRY} SELECT event_id, {rounded('co2_ppm * process_temp_c', 'co2_ppm_x_process_temp_c')},"
    f" {rounded('co2_ppm * pressure_kpa', 'co2_ppm_x_pressure_kpa')} FROM t",
)
def feat_interact(spark, folder):
    t = telemetry(spark, folder).select("event_id", *SENSORS)
    return features.interactions(t, [("co2_ppm", "process_temp_c"), ("co2_ppm", "pressure_kpa")]).drop(*SENSORS)


def _lag_sql(keys: str = "") -> str:
    by = f"PARTITION BY {keys}" if keys else ""
    picks = [
        rounded(f"lag({c}, {k}) OVER ({by} {TIME_ORDER})", f"{c}_lag_{k}") for c in ("co2_ppm", "o2_pct") for k in (1, 3, 12)
    ]
    return f"WITH {TELEMETRY} SELECT event_id, {', '.join(picks)} FROM t"


def _lagged(spark, folder, keys):
    t = telemetry(spark, folder).select(*ORDER, "tank_id", "co2_ppm", "o2_pct")
    return features.lags(t, ORDER, ["co2_ppm", "o2_pct"], keys).drop("timestamp_index", "tank_id", "co2_ppm", "o2_pct")


@register("feat_lag", _lag_sql())
def feat_lag(spark, folder):
    return _lagged(spark, folder, [])


@register("feat_lag_by_tank", _lag_sql("tank_id"))
def feat_lag_by_tank(spark, folder):
    return _lagged(spark, folder, ["tank_id"])


def _rolling_features(columns: list[str]) -> list[str]:
    picks = []
    for c in columns:
        for size in (6, 12, 24):
            s = _moments(c, size, f"{c}_{size}")
            picks += [rounded(s[k], f"{c}_rolling_{k}_{size}") for k in ("mean", "std", "skew", "kurt")]
    return picks


@register(
    "feat_rolling",
    f"WITH {TELEMETRY}{_frames_cte(['co2_ppm', 'o2_pct'], [6, 12, 24], 't', TIME_ORDER)}"
    f" SELECT event_id, {', '.join(_rolling_features(['co2_ppm', 'o2_pct']))} FROM l",
)
def feat_rolling(spark, folder):
    t = telemetry(spark, folder).select(*ORDER, "co2_ppm", "o2_pct")
    return features.rolling(t, ORDER, ["co2_ppm", "o2_pct"]).drop("timestamp_index", "co2_ppm", "o2_pct")


LEVELS = (
    "CASE WHEN co2_ppm IS NULL THEN NULL WHEN co2_ppm < 500 THEN {0} WHEN co2_ppm < 1000 THEN {1}"
    " WHEN co2_ppm < 1500 THEN {2} ELSE {3} END"
)


@register(
    "feat_phase",
    f"WITH {TELEMETRY} SELECT event_id, coalesce({LEVELS.format(0, 1, 2, 3)}, -1) AS phase_encoded FROM t",
)
def feat_phase(spark, folder):
    from tankwise.functions.phases import phase_by_level

    phase = F.when(F.col("co2_ppm").isNotNull(), phase_by_level(F.col("co2_ppm")))
    t = telemetry(spark, folder).select("event_id", phase.alias("phase"))
    return features.encoded_phase(t).select("event_id", "phase_encoded")


def _temporal(time: str, digits: int = 6) -> str:
    hour, day = f"extract(hour FROM {time})", f"(isodow({time}) - 1)"
    return (
        f"{hour} AS hour, {day} AS day_of_week, extract(day FROM {time}) AS day_of_month,"
        f" extract(month FROM {time}) AS month, "
        + ", ".join(
            rounded(f"{f}(2 * pi() * {v} / {n})", f"{name}_{f}", digits)
            for name, v, n in (("hour", hour, 24), ("day", day, 7))
            for f in ("sin", "cos")
        )
    )


@register("feat_temporal", f"WITH {TELEMETRY} SELECT event_id, {_temporal('timestamp_index')} FROM t")
def feat_temporal(spark, folder):
    return features.temporal(telemetry(spark, folder).select(*ORDER)).drop("timestamp_index")


CANONICAL_TIME = "ORDER BY timestamp, event_id"
EQUIPMENT = (
    "CASE WHEN valve_state > 0 THEN 1 ELSE 0 END AS valve_state_binary,"
    f" valve_state - lag(valve_state) OVER ({CANONICAL_TIME}) AS valve_state_change,"
    " round(agitator_rpm / ((SELECT max(agitator_rpm) FROM c) + 1e-10), 6) + 0.0 AS agitator_rpm_normalized,"
    f" round(agitator_rpm - lag(agitator_rpm) OVER ({CANONICAL_TIME}), 6) + 0.0 AS agitator_rpm_change"
)


@register("feat_equipment", f"WITH {CANONICAL} SELECT event_id, {EQUIPMENT} FROM c")
def feat_equipment(spark, folder):
    c = canonical(spark, folder).select(*CANONICAL_ORDER, "valve_state", "agitator_rpm")
    return features.equipment(c, CANONICAL_ORDER).drop("timestamp", "valve_state", "agitator_rpm")


def _attenuation(column: str) -> str:
    first = f"(SELECT {column} FROM c {CANONICAL_TIME} LIMIT 1)"
    estimate = f"({column} - {first}) / ({first} + 1e-10) * 100"
    return (
        f"round({estimate}, 6) + 0.0 AS estimated_attenuation,"
        f" round({estimate} - target_attenuation, 6) + 0.0 AS attenuation_deviation"
    )


@register("feat_attenuation", f"WITH {CANONICAL} SELECT event_id, {_attenuation('do_ppm')} FROM c")
def feat_attenuation(spark, folder):
    """On the oxygen column: the first CO2 value is missing, which leaves every estimate missing."""
    c = features.attenuation(canonical(spark, folder), CANONICAL_ORDER, "do_ppm")
    return c.select("event_id", "estimated_attenuation", "attenuation_deviation")


ALL_LAGGED = ["co2_lpm", "do_ppm", "temp_c", "valve_state", "agitator_rpm"]
ALL_ROLLED = ["co2_lpm", "do_ppm", "valve_state", "agitator_rpm"]


def _all_features_sql() -> str:
    phase = LEVELS.format("'lag'", "'exponential'", "'stationary'", "'decline'").replace("co2_ppm", "co2_lpm")
    code = LEVELS.format(0, 1, 2, 3).replace("co2_ppm", "co2_lpm")
    picks = [EQUIPMENT, _attenuation("co2_lpm"), _temporal("timestamp")]
    picks += [rounded(f"pow({c}, 2)", f"{c}_poly_2") for c in ("co2_lpm", "temp_c")]
    pairs = [("co2_lpm", "temp_c"), ("co2_lpm", "pressure_bar"), ("valve_state", "co2_lpm"), ("agitator_rpm", "co2_lpm")]
    picks += [rounded(f"{a} * {b}", f"{a}_x_{b}") for a, b in pairs]
    for c in ALL_LAGGED:
        for k in (1, 3, 12):
            lagged = f"lag({c}, {k}) OVER ({CANONICAL_TIME})"
            picks.append(f"{lagged} AS {c}_lag_{k}" if c == "valve_state" else rounded(lagged, f"{c}_lag_{k}"))
    picks += _rolling_features(ALL_ROLLED)
    frames = _frames_cte(ALL_ROLLED, [6, 12, 24], "c", CANONICAL_TIME)
    return (
        f"WITH {CANONICAL}{frames} SELECT event_id, {phase} AS phase,"
        f" coalesce({code}, -1) AS phase_encoded, {', '.join(picks)} FROM l"
    )


@register("feat_all", _all_features_sql())
def feat_all(spark, folder):
    from tankwise.functions.phases import phase_by_level

    c = canonical(spark, folder)
    c = c.withColumn("phase", F.when(F.col("co2_lpm").isNotNull(), phase_by_level(F.col("co2_lpm"))))
    made = features.all_features(c, CANONICAL_ORDER, time="timestamp")
    return made.select("event_id", "phase", *(name for name in made.columns if name not in c.columns))


SERIES_CTE = f""", x AS (SELECT row_number() OVER ({TIME_ORDER}) - 1 AS idx, event_id, timestamp_index,
      pressure_kpa AS v FROM t),
    z AS (SELECT avg(v) AS mean, stddev_pop(v) AS std, count(*) AS n, least(50, count(*) // 10) AS w FROM x)"""


def _found(source: str, condition: str) -> str:
    return (
        f"SELECT idx, epoch_us(timestamp_index) AS timestamp_index, event_id, {rounded('v', 'value')}"
        f" FROM {source} WHERE {condition}"
    )


CUSUM_SQL = (
    f"WITH {TELEMETRY}{SERIES_CTE}, y AS (SELECT x.*, std, sum(v - mean) OVER (ORDER BY idx) AS drift FROM x, z) "
    + _found("y", "idx >= 1 AND abs(drift) > 3 * std")
)


@register("cp_cusum", CUSUM_SQL)
def cp_cusum(spark, folder):
    return changepoints.detect(telemetry(spark, folder), ORDER, "pressure_kpa", "cusum")


@register(
    "cp_window",
    f"""WITH {TELEMETRY}{SERIES_CTE}, p AS (
      SELECT idx, timestamp_index, event_id, v, sum(v) OVER (ORDER BY idx) AS total FROM x
      UNION ALL SELECT -1, NULL, NULL, NULL, 0),
    y AS (SELECT p.*, std, n, w, (b.total - c.total) / w - (c.total - a.total) / w AS shift
          FROM z, p JOIN p b ON b.idx = p.idx + (SELECT w FROM z) - 1 JOIN p c ON c.idx = p.idx - 1
          JOIN p a ON a.idx = p.idx - (SELECT w FROM z) - 1) """
    + _found("y", "idx >= w AND idx < n - w AND abs(shift) > 0.3 * std"),
)
def cp_window(spark, folder):
    """A low threshold: the series has no shift of three deviations."""
    return changepoints.detect(telemetry(spark, folder), ORDER, "pressure_kpa", "window", threshold=0.3)


@register(
    "cp_diff",
    f"WITH {TELEMETRY}{SERIES_CTE}, y AS (SELECT x.*, v - lag(v) OVER (ORDER BY idx) AS d FROM x),"
    " q AS (SELECT stddev_pop(d) AS sd FROM y) " + _found("y, q", "abs(d) > 2 * sd"),
)
def cp_diff(spark, folder):
    """At two deviations: a step of three is beyond the range of the series."""
    return changepoints.detect(telemetry(spark, folder), ORDER, "pressure_kpa", "derivative", threshold=2.0)


@register("cp_boundaries", f"SELECT *, count(*) OVER () AS num_changepoints FROM ({CUSUM_SQL})")
def cp_boundaries(spark, folder):
    return changepoints.boundaries(telemetry(spark, folder), ORDER, "pressure_kpa", "cusum")


PELT_PENALTY = 5_000


@register(
    "cp_pelt",
    f"""WITH RECURSIVE {TELEMETRY}, x AS (
      SELECT batch_id, event_id, timestamp_index, pressure_kpa AS v,
             row_number() OVER (PARTITION BY batch_id {TIME_ORDER}) AS i FROM t WHERE pressure_kpa IS NOT NULL),
    p AS (SELECT *, sum(v) OVER w AS a, sum(v * v) OVER w AS b FROM x WINDOW w AS (PARTITION BY batch_id ORDER BY i)),
    l AS (SELECT batch_id, count(*) AS n, list_prepend(0.0::DOUBLE, list(a ORDER BY i)) AS s, list_prepend(0.0::DOUBLE, list(b ORDER BY i)) AS q
          FROM p GROUP BY batch_id),
    r AS (
      SELECT batch_id, 0::BIGINT AS i, [-{PELT_PENALTY}::DOUBLE] AS f, [0::BIGINT] AS back FROM l
      UNION ALL
      SELECT batch_id, i, list_append(f, list_min(c) + {PELT_PENALTY}), list_append(back, list_position(c, list_min(c)) - 1)
      FROM (
        SELECT r.batch_id, r.i + 1 AS i, f, back,
               list_transform(range(r.i + 1), lambda k: f[k + 1] + (q[r.i + 2] - q[k + 1])
                 - (s[r.i + 2] - s[k + 1]) * (s[r.i + 2] - s[k + 1]) / (r.i + 1 - k)) AS c
        FROM r JOIN l USING (batch_id) WHERE r.i < l.n)),
    e AS (SELECT r.batch_id, r.i AS n, f[r.i + 1] AS cost, back FROM r JOIN l ON l.batch_id = r.batch_id AND l.n = r.i),
    z AS (
      SELECT batch_id, cost, back, n AS upto, back[n + 1] AS idx FROM e
      UNION ALL SELECT batch_id, cost, back, idx, back[idx + 1] FROM z WHERE idx > 0)
    SELECT z.batch_id, z.idx, x.event_id, z.upto - z.idx AS rows,
           {rounded('(l.s[z.upto + 1] - l.s[z.idx + 1]) / (z.upto - z.idx)', 'mean')}, {rounded('z.cost', 'cost')}
    FROM z JOIN l ON l.batch_id = z.batch_id JOIN x ON x.batch_id = z.batch_id AND x.i = z.idx + 1""",
)
def cp_pelt(spark, folder):
    """Pieces of constant mean pressure of every batch, by optimal partitioning."""
    found = pelt.segments(telemetry(spark, folder), ORDER, "pressure_kpa", ["batch_id"], PELT_PENALTY)
    return found.select("batch_id", "idx", "event_id", "rows", "mean", "cost")
