"""Reading telemetry from files and request records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tankwise.session import prepare
from tankwise.sources.schemas import LEGACY_TELEMETRY, RECORD


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL everywhere; NaN would compare as larger than any number."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floating:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. The default schema is the legacy telemetry layout; no inference pass."""
    reader = prepare(spark).read.option("header", True).option("mode", "PERMISSIVE")
    return nan_to_null(reader.schema(schema or LEGACY_TELEMETRY).csv(path))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types: costs one more pass over the files."""
    return nan_to_null(prepare(spark).read.csv(path, header=True, inferSchema=True))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with zone-less timestamps taken as UTC and NaN as NULL."""
    df = nan_to_null(prepare(spark).read.parquet(path))
    casts = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder.rstrip('/')}/{name}.parquet")


def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Files of JSON records, one per line; absent fields become NULL, unknown fields are ignored."""
    return nan_to_null(prepare(spark).read.schema(schema).option("mode", "PERMISSIVE").json(path))


def with_extras(df: DataFrame, column: str, schema: T.StructType = RECORD, extras: str = "extras") -> DataFrame:
    """JSON records in a text column as typed fields, beside a map of all other fields as VARIANT values.

    ``column`` is replaced. Nested fields stay as they are; a field whose name differs from a known one, if
    only by case, is an extra. A text that is no JSON object gives NULL fields and an empty map."""
    known = F.array(*(F.lit(f.name) for f in schema.fields))
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    parsed = df.select(
        *others,
        F.from_json(F.col(column), schema).alias("_known"),
        F.coalesce(F.from_json(F.col(column), "map<string, variant>"), F.expr("map()").cast("map<string, variant>")).alias("_all"),
    )
    rest = F.map_filter("_all", lambda name, _: ~F.array_contains(known, name))
    return parsed.select(*others, "_known.*", rest.alias(extras))


def extra(name: str, path: str, kind: str, extras: str = "extras") -> Column:
    """A value inside an extra field, NULL where it is absent or of another kind (``path`` as ``$.a.b[0]``)."""
    return F.try_variant_get(F.try_element_at(F.col(extras), F.lit(name)), path, kind)


def with_extras_json(df: DataFrame, columns: list[str], extras: str = "extras", name: str = "record") -> DataFrame:
    """The given columns and all extras as one JSON object per row, as it was read."""
    plain = F.struct(*(F.col(f"`{c}`") for c in columns))
    known = F.from_json(F.to_json(plain), "map<string, variant>")
    return df.withColumn(name, F.to_json(F.map_concat(known, F.col(extras))))


def parse_payloads(df: DataFrame, column: str, schema: T.StructType = RECORD) -> DataFrame:
    """Rows of ``{"sensor_data": [record, ...]}`` payloads become one row per record."""
    payload = T.StructType([T.StructField("sensor_data", T.ArrayType(schema))])
    others = [c for c in df.columns if c != column]
    parsed = df.withColumn("_payload", F.from_json(column, payload))
    return parsed.select(*others, F.inline("_payload.sensor_data"))
