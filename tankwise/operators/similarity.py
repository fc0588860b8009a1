"""Curve similarity, correlation and distances between entities."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations_with_replacement

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.functions.vectors import EPSILON, cosine, euclidean
from tankwise.plans.ordered import POSITION, arrange
from tankwise.plans.params import attach, settle


def centroids(df: DataFrame, by: str, vector: str, name: str = "centroid") -> DataFrame:
    """Mean vector per group, by partial aggregation."""
    mean = Summarizer.mean(array_to_vector(vector))
    return df.groupBy(by).agg(vector_to_array(mean).alias(name))


def cosine_to_centroid(df: DataFrame, by: str, vector: str) -> DataFrame:
    """Rows with the cosine between their vector and the mean vector of their group."""
    means, small = settle(centroids(df, by, vector, "_mean"))
    joined = attach(df, means, [by], small)
    return joined.withColumn("similarity", cosine(F.col(vector), F.col("_mean"))).drop("_mean")


def distances(entities: DataFrame, entity: str, vector: str, blocks: int = 16) -> DataFrame:
    """Euclidean distance of every pair of entities, in long form ``(a, b, distance)``.

    The matrix is the result, so its size is quadratic; the entities are a small table of means. Work
    is cut into ``blocks`` x ``blocks`` tiles by an equi-join on the tile, so no task builds more than
    one tile."""
    hashed = F.pmod(F.xxhash64(entity), F.lit(blocks)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = entities.select(
        F.col(entity).alias("a"), F.col(vector).alias("_va"), hashed.alias("_row"), others.alias("_column")
    )
    right = entities.select(
        F.col(entity).alias("b"), F.col(vector).alias("_vb"), hashed.alias("_column"), others.alias("_row")
    )
    return left.join(right, ["_row", "_column"]).select(
        "a", "b", euclidean(F.col("_va"), F.col("_vb")).alias("distance")
    )


def tank_distances(
    df: DataFrame, entity: str = "batch_id", columns: Iterable[str] | None = None, blocks: int = 16
) -> DataFrame:
    """Distances between the mean sensor readings of tanks or batches."""
    from tankwise.operators.batch import DEFAULT_SENSORS

    columns = [c for c in (columns or DEFAULT_SENSORS) if c in df.columns]
    means = df.where(F.col(entity).isNotNull()).groupBy(entity).agg(*(F.avg(c).alias(c) for c in columns))
    vectors = means.select(entity, F.array(*columns).alias("_means"))
    return distances(vectors, entity, "_means", blocks)


def pearson_matrix(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Correlation of every pair of columns in long form ``(a, b, correlation)``, from one aggregate.

    NULL when either column has a missing value or no variation."""
    columns = list(columns)
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    value = [F.col(c).cast("double") for c in columns]
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(v).alias(f"n{i}") for i, v in enumerate(value)),
        *((F.max(v) > F.min(v)).alias(f"varies{i}") for i, v in enumerate(value)),
        *(F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(value)),
        *(F.covar_pop(value[i], value[j]).alias(f"c{i}_{j}") for i, j in pairs),
    )
    cells = []
    for i, j in pairs:
        usable = (
            (F.col(f"n{i}") == F.col("_rows"))
            & (F.col(f"n{j}") == F.col("_rows"))
            & F.col(f"varies{i}")
            & F.col(f"varies{j}")
        )
        r = F.when(usable, F.try_divide(F.col(f"c{i}_{j}"), F.col(f"s{i}") * F.col(f"s{j}")))
        for a, b in {(i, j), (j, i)}:
            cells.append(
                F.struct(F.lit(columns[a]).alias("a"), F.lit(columns[b]).alias("b"), r.alias("correlation"))
            )
    return stats.select(F.inline(F.array(*cells)))


def golden_similarity(
    df: DataFrame,
    golden: DataFrame,
    order: Iterable[str],
    value: str,
    batch: str = "batch_id",
    step: str = "step",
    golden_value: str | None = None,
) -> DataFrame:
    """Cosine between each batch's curve and the golden curve stretched to the batch's length.

    ``golden`` has one row per ``step``. A missing value on either curve gives NULL; an absent column
    gives 0. All batches are compared in one job."""
    order, golden_value = list(order), golden_value or value
    if value not in df.columns or golden_value not in golden.columns:
        return df.select(batch).distinct().withColumn("similarity", F.lit(0.0))
    slim = df.select(*dict.fromkeys([batch, *order, value]))
    sizes, few = settle(slim.groupBy(batch).agg(F.count(F.lit(1)).alias("_length")))
    curve = arrange(golden.select(step, F.col(golden_value).alias("_g")), [step]).scan().result()
    curve, small = settle(curve.select(F.col(POSITION).alias("_at"), "_g"))
    points = curve.count()

    live = attach(arrange(slim, order, [batch]).scan().result(), sizes, [batch], few, how="inner")
    spot = F.when(F.col("_length") > 1, F.col(POSITION) * (points - 1) / (F.col("_length") - 1)).otherwise(F.lit(0.0))
    live = live.withColumn("_spot", spot).withColumns(
        {"_low": F.floor("_spot").cast("long"), "_high": F.ceil("_spot").cast("long")}
    )
    live = attach(live, curve.toDF("_low", "_g_low"), ["_low"], small)
    live = attach(live, curve.toDF("_high", "_g_high"), ["_high"], small)
    stretched = F.col("_g_low") + (F.col("_g_high") - F.col("_g_low")) * (F.col("_spot") - F.col("_low"))
    x, g = F.col(value).cast("double"), F.col("_stretched")
    sums = live.withColumn("_stretched", stretched).groupBy(batch).agg(
        F.sum(x * g).alias("_xg"),
        F.sqrt(F.sum(x * x)).alias("_x"),
        F.sqrt(F.sum(g * g)).alias("_gg"),
        F.bool_and(x.isNotNull() & g.isNotNull()).alias("_whole"),
    )
    similarity = F.col("_xg") / ((F.col("_x") + EPSILON) * (F.col("_gg") + EPSILON))
    return sums.select(batch, F.when(F.col("_whole"), similarity).alias("similarity"))
