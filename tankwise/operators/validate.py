"""Data validation: rules compiled into one aggregate, and sensor summaries."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tankwise.operators.outliers import iqr_bounds, outside, zscore_bounds

RESULT = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("violations", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)
MAX_OUTLIER_SHARE = 0.05  # fixed value
# The names of rules and the wording of their messages below, which users' tools read.
SENSORS = ("co2_lpm", "do_ppm", "temp_c", "pressure_bar", "valve_state", "agitator_rpm")


@dataclass(frozen=True)
class Measured:
    """Aggregates of a rule, and its verdict in terms of their results (``m[i]``)."""

    aggregates: tuple[Column, ...]
    verdict: object  # callable(list[Column], Column) -> (violations, message or NULL)


@dataclass(frozen=True)
class Fixed:
    """A verdict known from the schema alone."""

    passed: bool
    message: str | None = None


@dataclass(frozen=True)
class Schema:
    """The column exists, has the given type and, unless ``nullable``, no missing value."""

    column: str
    dtype: str | None = None
    nullable: bool = False

    @property
    def name(self) -> str:
        return f"schema_{self.column}"

    def compile(self, df: DataFrame) -> Measured | Fixed:
        if self.column not in df.columns:
            return Fixed(False, f"Column {self.column} missing")
        actual = df.schema[self.column].dataType.simpleString()
        if self.dtype and self.dtype != actual:
            return Fixed(False, f"Column {self.column} has wrong dtype: expected {self.dtype}, got {actual}")
        if self.nullable:
            return Fixed(True)
        return _counted(
            F.count_if(F.col(self.column).isNull()), f"Column {self.column} has ", " null values"
        )


@dataclass(frozen=True)
class Range:
    """Values lie within the closed range; missing values do not count, a missing column fails."""

    column: str
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"range_{self.column}"

    def compile(self, df: DataFrame) -> Measured | Fixed:
        if self.column not in df.columns:
            return Fixed(False, f"Column {self.column} missing")
        value = F.col(self.column)
        aggregates = (
            F.lit(0).cast("long") if self.low is None else F.count_if(value < self.low),
            F.lit(0).cast("long") if self.high is None else F.count_if(value > self.high),
        )

        def verdict(m: list[Column], rows: Column) -> tuple[Column, Column]:
            below = F.concat(m[0].cast("string"), F.lit(f" values below minimum {self.low}"))
            above = F.concat(m[1].cast("string"), F.lit(f" values above maximum {self.high}"))
            text = F.concat_ws("; ", F.when(m[0] > 0, below), F.when(m[1] > 0, above))
            return m[0] + m[1], text

        return Measured(aggregates, verdict)


@dataclass(frozen=True)
class MissingShare:
    """No column misses more than ``threshold`` of its values."""

    threshold: float = 0.1
    name: str = "missing_detection"

    def compile(self, df: DataFrame) -> Measured:
        columns = df.columns

        def verdict(m: list[Column], rows: Column) -> tuple[Column, Column]:
            over = [F.try_divide(n, rows) > self.threshold for n in m]
            listed = F.concat_ws(", ", *(F.when(o, F.lit(f"'{c}'")) for o, c in zip(over, columns)))
            number = sum((F.coalesce(o, F.lit(False)).cast("long") for o in over), F.lit(0).cast("long"))
            return number, F.concat(F.lit(f"Columns with >{self.threshold * 100}% missing: ["), listed, F.lit("]"))

        return Measured(tuple(F.count_if(F.col(c).isNull()) for c in columns), verdict)


@dataclass(frozen=True)
class OutlierShare:
    """At most five percent of the rows are outliers; an absent column passes."""

    column: str
    method: str = "iqr"

    @property
    def name(self) -> str:
        return f"outlier_{self.column}"

    def compile(self, df: DataFrame) -> Measured | Fixed:
        if self.column not in df.columns:
            return Fixed(True)
        fit = iqr_bounds if self.method == "iqr" else zscore_bounds
        bounds = fit(df, [self.column])
        if self.column not in bounds:
            return Fixed(True)

        def verdict(m: list[Column], rows: Column) -> tuple[Column, Column]:
            share = F.format_string("%.1f", F.try_divide(m[0] * 100.0, rows))
            text = F.concat(m[0].cast("string"), F.lit(f" outliers detected in {self.column} ("), share, F.lit("%)"))
            return F.when(m[0] > rows * MAX_OUTLIER_SHARE, m[0]).otherwise(F.lit(0).cast("long")), text

        return Measured((F.count_if(outside(self.column, bounds[self.column])),), verdict)


@dataclass(frozen=True)
class ValveState:
    """The valve is 0 or 1; missing is invalid; an absent column passes."""

    name: str = "valve_state_validation"

    def compile(self, df: DataFrame) -> Measured | Fixed:
        if "valve_state" not in df.columns:
            return Fixed(True)
        invalid = F.coalesce(~F.col("valve_state").isin(0, 1), F.lit(True))
        return _counted(F.count_if(invalid), "", " invalid valve_state values (must be 0 or 1)")


@dataclass(frozen=True)
class AgitatorRange:
    """The agitator speed lies in the closed range; an absent column passes."""

    low: float = 0
    high: float = 3000
    name: str = "agitator_rpm_validation"

    def compile(self, df: DataFrame) -> Measured | Fixed:
        if "agitator_rpm" not in df.columns:
            return Fixed(True)
        value = F.col("agitator_rpm")
        return _counted(
            F.count_if((value < self.low) | (value > self.high)),
            "",
            f" agitator_rpm values out of range [{self.low}, {self.high}]",
        )


@dataclass(frozen=True)
class DuplicateTimes:
    """No time (within a group) occurs on more than one row; an absent time column passes."""

    time: str = "timestamp_index"
    group_by: str | None = None
    name: str = "duplicate_timestamps"

    def compile(self, df: DataFrame) -> Fixed | DataFrame:
        if self.time not in df.columns:
            return Fixed(True)
        found = duplicate_times(df, self.time, self.group_by)
        text = F.concat(F.col("duplicates").cast("string"), F.lit(" duplicate timestamps found"))
        return found.select(_result(self.name, F.col("duplicates"), text)).select("result.*")


def duplicate_times(df: DataFrame, time: str, group_by: str | None = None) -> DataFrame:
    """Number of times that occur more than once. Counting is map-side first, so a time shared by
    very many rows costs one row per task in the shuffle."""
    keys = [k for k in (group_by, time) if k and k in df.columns]
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicates"))
    )


def sensor_rules() -> list:
    """Rules for all canonical sensor fields. The physical ranges."""
    return [
        ValveState(),
        AgitatorRange(),
        Range("co2_lpm", 0, 5000),
        Range("do_ppm", 0, 21),
        Range("pressure_bar", 0.5, 3.0),
        Range("temp_c", 10, 40),
    ]


def _compiled(df: DataFrame, rules: Iterable) -> tuple[list[Column], list[Column], list[DataFrame]]:
    """Aggregates of all rules, their verdicts in terms of these, and rules that need a job of their own."""
    aggregates, verdicts, separate = [F.count(F.lit(1)).alias("_rows")], [], []
    for rule in rules:
        try:
            compiled = rule.compile(df)
            if isinstance(compiled, Measured):
                df.agg(*compiled.aggregates)
        except AnalysisException as error:
            compiled = Fixed(False, f"Error executing rule: {error}")
        if isinstance(compiled, DataFrame):
            separate.append(compiled)
        elif isinstance(compiled, Fixed):
            violations = F.lit(0 if compiled.passed else 1).cast("long")
            verdicts.append(_result(rule.name, violations, F.lit(compiled.message)))
        else:
            names = [f"_{len(aggregates) + i}" for i in range(len(compiled.aggregates))]
            aggregates += [a.alias(n) for a, n in zip(compiled.aggregates, names)]
            violations, text = compiled.verdict([F.col(n) for n in names], F.col("_rows"))
            verdicts.append(_result(rule.name, violations, text))
    return aggregates, verdicts, separate


def validate(df: DataFrame, rules: Iterable, run_id: str | None = None) -> DataFrame:
    """One row per rule: ``(rule, passed, violations, message)``.

    All rules share one aggregate over the rows; only duplicate checks, which group, add a job of
    their own. A rule that cannot be analysed becomes a failed rule."""
    aggregates, verdicts, separate = _compiled(df, rules)
    results = [df.agg(*aggregates).select(F.inline(F.array(*verdicts)))] if verdicts else []
    return _together(df.sparkSession, results + separate, run_id)


def _together(spark: SparkSession, results: list[DataFrame], run_id: str | None) -> DataFrame:
    if not results:
        return spark.createDataFrame([], RESULT)
    combined = results[0]
    for more in results[1:]:
        combined = combined.unionByName(more)
    return combined if run_id is None else combined.withColumn("run_id", F.lit(run_id))


def write_validated(df: DataFrame, rules: Iterable, path: str, run_id: str, verdicts: str | None = None, mode: str = "error") -> DataFrame:
    """Write ``df`` as parquet and return the verdicts over what was written, in one pass over the rows.

    The rules' aggregates are observed while the rows are written. Duplicate checks group, which an
    observation can't; they read their keys from the files. With ``verdicts``, the rows are also appended to
    the table there. Columns: those of :func:`validate`, ``run_id`` and ``overall`` (all rules passed)."""
    rules = list(rules)
    aggregates, cells, separate = _compiled(df, rules)
    spark = df.sparkSession
    seen = Observation()
    df.observe(seen, *aggregates).write.mode(mode).parquet(path)
    results = []
    if cells:
        schema = df.agg(*aggregates).schema
        row = spark.createDataFrame([tuple(seen.get[f.name] for f in schema.fields)], schema)
        results.append(row.select(F.inline(F.array(*cells))))
    if separate:
        written = spark.read.schema(df.schema).parquet(path)
        results += _compiled(written, rules)[2]
    found = _together(spark, results, run_id)
    found = found.crossJoin(F.broadcast(overall(found).select(F.col("passed").alias("overall"))))  # one row
    if verdicts is None:
        return found
    found.write.mode("append").parquet(verdicts)
    return spark.read.schema(found.schema).parquet(verdicts).filter(F.col("run_id") == run_id)


def overall(results: DataFrame) -> DataFrame:
    """Whether every rule passed, and the number that did not."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
        F.count_if(~F.col("passed")).alias("errors"),
    )


def _counted(count: Column, before: str, after: str) -> Measured:
    def verdict(m: list[Column], rows: Column) -> tuple[Column, Column]:
        return m[0], F.concat(F.lit(before), m[0].cast("string"), F.lit(after))

    return Measured((count,), verdict)


def _result(rule: str, violations: Column, text: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        (violations == 0).alias("passed"),
        violations.cast("long").alias("violations"),
        F.when(violations > 0, text.cast("string")).alias("message"),
    ).alias("result")


def missing_over(df: DataFrame, threshold: float = 0.1, columns: Iterable[str] | None = None) -> DataFrame:
    """Columns that miss more than ``threshold`` of their values, with that share."""
    from tankwise.operators.missing import missing_profile

    share = (F.col("missing_pct") / 100).alias("missing_share")
    return missing_profile(df, columns).filter(F.col("missing_pct") / 100 > threshold).select("column", share)


def outlier_share(df: DataFrame, columns: Iterable[str], method: str = "iqr") -> DataFrame:
    """Outliers per column, their share of the rows, and whether that share passes."""
    columns = list(columns)
    bounds = (iqr_bounds if method == "iqr" else zscore_bounds)(df, columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(outside(c, bounds.get(c, (None, None)))).alias(f"_{i}") for i, c in enumerate(columns)),
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("outliers")) for i, c in enumerate(columns)]
    return counts.select("_rows", F.inline(F.array(*cells))).select(
        "column",
        "outliers",
        F.try_divide(F.col("outliers").cast("double"), F.col("_rows")).alias("share"),
        (F.col("outliers") <= F.col("_rows") * MAX_OUTLIER_SHARE).alias("passed"),
    )


def sensor_summary(df: DataFrame, columns: Iterable[str] = SENSORS) -> DataFrame:
    """Mean, deviation, range and missing values of the sensors that are present."""
    present = [c for c in columns if c in df.columns]
    numeric = {c for c in present if isinstance(df.schema[c].dataType, T.NumericType)}
    statistics = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    aggregates, cells = [], []
    for i, c in enumerate(present):
        fields = [F.lit(c).alias("sensor")]
        for name, function in statistics.items():
            if c in numeric:
                aggregates.append(function(F.col(c).cast("double")).alias(f"{name}{i}"))
                fields.append(F.col(f"{name}{i}").alias(name))
            else:
                fields.append(F.lit(None).cast("double").alias(name))
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"missing{i}"))
        cells.append(F.struct(*fields, F.col(f"missing{i}").alias("missing_count")))
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))
