"""Process anomalies: stuck fermentation, oxidation, pressure, and CO2 activity."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankwise.operators.similarity import golden_similarity
from tankwise.plans.ordered import Ordered, arrange
from tankwise.plans.params import attach, settle
from tankwise.plans.quantiles import table_quantiles

# Anomaly types in the order in which the first one at a time wins, with severities.
SEVERITIES = {
    "stuck_fermentation": "high",
    "oxidation_risk": "medium",
    "high_pressure": "high",
    "low_pressure": "medium",
    "abnormal_co2_activity": "medium",
    "abnormal_co2_pattern": "medium",
    "over_vigorous_co2": "high",
    "rapid_pressure_rise": "high",
}
PRIORITY = {name: i for i, name in enumerate(SEVERITIES)}

# Detector settings.
STUCK_WINDOW = 12
STUCK_RATE = 0.01
STUCK_QUANTILE = 0.7
OXIDATION_DEVIATIONS = 0.5
ACTIVITY_DEVIATIONS = 3.0
MAX_BAR, MIN_BAR = 2.0, 0.8
SAMPLE_MINUTES = 5.0
VIGOROUS_PER_MINUTE = 500.0
PRESSURE_RISE_PER_MINUTE = 0.1
PATTERN_TOLERANCE = 0.3

# Columns that a detector adds to its rows.
HELPERS = {
    "co2_rate": ("stuck_fermentation", "abnormal_co2_activity", "over_vigorous_co2"),
    "co2_rolling_mean": ("stuck_fermentation",),
    "do_change": ("oxidation_risk",),
    "do_change_abs": ("oxidation_risk",),
    "co2_rate_per_min": ("over_vigorous_co2",),
    "pressure_rate": ("rapid_pressure_rise",),
    "pressure_rate_per_min": ("rapid_pressure_rise",),
}


@dataclass(frozen=True)
class Thresholds:
    """Limits that depend on the whole table. A missing limit means its detector finds nothing."""

    stuck_below: float | None = None
    oxidation_above: float | None = None
    co2_jump_above: float | None = None


@dataclass(frozen=True)
class AnomalyDetector:
    """Detectors over rows ordered by ``order`` within ``keys`` (no keys: over the whole table)."""

    order: tuple[str, ...] = ("timestamp",)
    keys: tuple[str, ...] = ()
    co2: str = "co2_lpm"
    do: str = "do_ppm"
    pressure: str = "pressure_bar"

    def fit(self, df: DataFrame | Ordered) -> Thresholds:
        """Thresholds from a batch run; a stream uses them as they are."""
        arranged = self._arranged(df)
        have = arranged.rows.columns
        limits: dict[str, float | None] = {}
        if self.co2 in have:
            limits["stuck_below"] = table_quantiles(arranged.rows, [self.co2], [STUCK_QUANTILE])[self.co2][0]
        changes = arranged.framed(self._changes(have), back=1).rows
        wanted = {}
        if self.do in have:
            wanted["oxidation_above"] = (F.abs("do_change"), OXIDATION_DEVIATIONS)
        if self.co2 in have:
            wanted["co2_jump_above"] = (F.col("co2_rate"), ACTIVITY_DEVIATIONS)
        if wanted:
            limits |= changes.agg(
                *((F.avg(v) + k * F.stddev_samp(v)).alias(name) for name, (v, k) in wanted.items())
            ).first().asDict()
        return Thresholds(**limits)

    def flag(self, df: DataFrame | Ordered, thresholds: Thresholds | None = None) -> DataFrame:
        """Rows with helper columns and ``anomalies``: the types found, in order of priority.

        All detectors share one window stage."""
        arranged = self._arranged(df)
        have = arranged.rows.columns
        limits = thresholds or self.fit(arranged)

        def windows(w):
            stages = [self._changes(have)(w)]
            if self.co2 in have:
                stages.append({"co2_rolling_mean": F.avg("co2_rate").over(w.rowsBetween(1 - STUCK_WINDOW, 0))})
            return stages

        rows = arranged.framed(windows, back=STUCK_WINDOW).result()
        found = self._conditions(have, limits)
        types = [F.when(condition, F.lit(name)) for name, condition in found.items()]
        own = {}
        if self.do in have:
            own["do_change_abs"] = F.abs("do_change")
        if self.co2 in have:
            own["co2_rate_per_min"] = F.col("co2_rate") / SAMPLE_MINUTES
        if self.pressure in have:
            own["pressure_rate_per_min"] = F.col("pressure_rate") / SAMPLE_MINUTES
        rows = rows.withColumns(own)
        listed = F.array_compact(F.array(*types)) if types else F.array().cast("array<string>")
        return rows.withColumn("anomalies", listed)

    def union(
        self,
        df: DataFrame | Ordered,
        types: Iterable[str] | None = None,
        thresholds: Thresholds | None = None,
        golden: DataFrame | None = None,
        batch: str = "batch_id",
    ) -> DataFrame:
        """One row per anomaly: the input row, its detector's helper columns, type and severity.

        With a ``golden`` curve (``step`` and the CO2 column), CO2 activity is judged by the
        similarity of the whole batch instead of by single jumps."""
        arranged = self._arranged(df)
        flagged = self.flag(arranged, thresholds)
        wanted = set(types or SEVERITIES)
        if golden is not None:
            wanted.discard("abnormal_co2_activity")
        helpers = [h for h in HELPERS if h in flagged.columns]
        plain = arranged.result().columns
        kept = flagged.filter(F.arrays_overlap("anomalies", F.array(*map(F.lit, sorted(wanted)))))
        found = kept.select(*plain, *helpers, F.explode("anomalies").alias("anomaly_type")).filter(
            F.col("anomaly_type").isin(*sorted(wanted))
        )
        found = found.withColumns(
            {h: F.when(F.col("anomaly_type").isin(*HELPERS[h]), F.col(h)) for h in helpers}
        ).withColumn("severity", _by_type(SEVERITIES))
        if golden is not None and (types is None or "abnormal_co2_pattern" in wanted):
            rows = arranged.result()
            found = found.unionByName(self.abnormal_pattern(rows, golden, batch), allowMissingColumns=True)
        return found

    def abnormal_pattern(self, df: DataFrame, golden: DataFrame, batch: str = "batch_id") -> DataFrame:
        """All rows of batches whose CO2 curve is unlike the golden one."""
        scores = golden_similarity(df, golden, self.order, self.co2, batch)
        low = scores.filter(F.col("similarity") < 1 - PATTERN_TOLERANCE)
        low, small = settle(low.withColumnRenamed("similarity", "similarity_score"))
        return attach(df, low, [batch], small, how="inner").select(
            *df.columns,
            "similarity_score",
            F.lit("abnormal_co2_pattern").alias("anomaly_type"),
            F.lit(SEVERITIES["abnormal_co2_pattern"]).alias("severity"),
        )

    def all(
        self,
        df: DataFrame | Ordered,
        dedup: Iterable[str] | None = None,
        thresholds: Thresholds | None = None,
        golden: DataFrame | None = None,
        batch: str = "batch_id",
    ) -> DataFrame:
        """The union, reduced to one anomaly per time (or per ``dedup`` columns): the first type in
        order of priority. Rows are combined before they are shuffled."""
        found = self.union(df, thresholds=thresholds, golden=golden, batch=batch)
        return first_per_key(found, list(dedup or [self.order[0]]), self.order)

    def timeline(self, df: DataFrame | Ordered, **settings) -> DataFrame:
        """The reduced union in time order."""
        return self.all(df, **settings).orderBy(*self.order)

    def counts(self, df: DataFrame | Ordered, **settings) -> DataFrame:
        """Anomalies per type, before the reduction."""
        return self.union(df, **settings).groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("anomalies"))

    def _arranged(self, df: DataFrame | Ordered) -> Ordered:
        return df if isinstance(df, Ordered) else arrange(df, self.order, self.keys)

    def _changes(self, have: list[str]):
        names = {"co2_rate": self.co2, "do_change": self.do, "pressure_rate": self.pressure}
        return lambda w: {
            name: F.col(source) - F.lag(source).over(w) for name, source in names.items() if source in have
        }

    def _conditions(self, have: list[str], limits: Thresholds) -> dict[str, Column]:
        found: dict[str, Column] = {}
        if self.co2 in have and limits.stuck_below is not None:
            found["stuck_fermentation"] = (F.col("co2_rolling_mean") < STUCK_RATE) & (
                F.col(self.co2) < limits.stuck_below
            )
        if self.do in have and limits.oxidation_above is not None:
            found["oxidation_risk"] = F.col("do_change") > limits.oxidation_above
        if self.pressure in have:
            found["high_pressure"] = F.col(self.pressure) > MAX_BAR
            found["low_pressure"] = F.col(self.pressure) < MIN_BAR
        if self.co2 in have:
            if limits.co2_jump_above is not None:
                found["abnormal_co2_activity"] = F.abs("co2_rate") > limits.co2_jump_above
            found["over_vigorous_co2"] = F.col("co2_rate") / SAMPLE_MINUTES > VIGOROUS_PER_MINUTE
        if self.pressure in have:
            found["rapid_pressure_rise"] = F.col("pressure_rate") / SAMPLE_MINUTES > PRESSURE_RISE_PER_MINUTE
        return found


def pressure_anomalies(df: DataFrame, pressure: str = "pressure_bar") -> DataFrame:
    """High and low pressure rows. Needs one row at a time, so it also runs on a stream."""
    kind = F.when(F.col(pressure) > MAX_BAR, "high_pressure").when(F.col(pressure) < MIN_BAR, "low_pressure")
    return (
        df.filter((F.col(pressure) > MAX_BAR) | (F.col(pressure) < MIN_BAR))
        .withColumn("anomaly_type", kind)
        .withColumn("severity", _by_type(SEVERITIES))
    )


def first_per_key(found: DataFrame, keys: list[str], order: Iterable[str]) -> DataFrame:
    """The row with the smallest (priority, order) per key."""
    rest = [c for c in found.columns if c not in keys]
    ranking = F.struct(_by_type(PRIORITY).alias("_priority"), *(F.col(c).alias(f"_{c}") for c in order))
    best = found.groupBy(*keys).agg(F.min_by(F.struct(*rest), ranking).alias("_best"))
    return best.select(*keys, "_best.*").select(*found.columns)


def _by_type(values: dict) -> Column:
    chosen = None
    for name, value in values.items():
        condition = F.col("anomaly_type") == name
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen
