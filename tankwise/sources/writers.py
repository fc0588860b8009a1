"""Sinks: reports and anomaly records as JSON, golden curves as partitioned parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_json(df: DataFrame, path: str, mode: str = "error", partition_by: tuple[str, ...] = ()) -> None:
    """JSON lines; missing values are written as null, times in ISO form."""
    writer = df.write.mode(mode).option("ignoreNullFields", False).option("timestampFormat", ISO_FORMAT)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def record_json(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one JSON string: numbers as doubles, times in ISO form, missing values as null."""

    def plain(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.NumericType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    options = {"ignoreNullFields": "false", "timestampFormat": ISO_FORMAT}
    return df.select(F.to_json(F.struct(*map(plain, df.schema.fields)), options).alias(name))


def save_curves(curves: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Golden curves, one folder per strain and style, so that a lookup reads one folder."""
    curves.write.mode(mode).partitionBy("strain", "style").parquet(path)


def load_curves(spark: SparkSession, path: str) -> DataFrame:
    """Curves with strain and style as text, whatever their values look like."""
    infer = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(infer)
    spark.conf.set(infer, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(infer, before)
