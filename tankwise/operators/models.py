"""Phase classifiers: features, stratified split, boosted trees or forest, scores, forecasts."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tankwise.functions.phases import PHASES
from tankwise.operators.boosting import Boosting, fit_softmax
from tankwise.plans.ordered import arrange
from tankwise.plans.params import settle
from tankwise.sources.schemas import numeric_columns

#: Classes that one model tells apart at most; more are refused.
MAX_CLASSES = 10_000

# Columns that never serve as features.
NOT_FEATURES = ("timestamp", "timestamp_index", "batch_id", "tank_id", "phase", "phase_encoded", "strain", "style")


def prepare_features(df: DataFrame, columns: Iterable[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Feature columns as doubles without gaps: an absent column and a missing value become 0."""
    columns = list(columns) if columns is not None else numeric_columns(df, exclude=NOT_FEATURES)
    if not any(c in df.columns for c in columns):
        raise ValueError("none of the feature columns is in the input")
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in columns
    }
    return df.withColumns(filled), columns


def stratified_split(
    df: DataFrame, label: str, tiebreak: Iterable[str], share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly ``floor(share * n)`` rows of every class, those of least seeded hash.

    ``tiebreak`` identifies a row; rows of one hash are test rows together. When a class has a single row, the split ignores classes; fewer
    than two classes are an error."""
    tiebreak = list(tiebreak)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("smallest")).first()
    if sizes["classes"] < 2:
        raise ValueError("the label needs at least two classes")
    keys = [label] if sizes["smallest"] >= 2 else []
    drawn = df.withColumn("_draw", F.xxhash64(F.lit(seed), *tiebreak))
    wanted = (counts if keys else df.agg(F.count(F.lit(1)).alias("n"))).withColumn("_left", F.floor(F.lit(share) * F.col("n")))
    wanted, small = settle(wanted.drop("n").withColumnRenamed(label, "_class") if keys else wanted.drop("n"))
    limits = lowest(drawn, "_draw", keys, wanted, small)
    few, small = settle(limits)
    few = F.broadcast(few) if small else few
    # Classes of which no row is wanted have no limit; without classes there is one at most.
    joined = drawn.join(few, F.col(label).eqNullSafe(F.col("_class")) if keys else F.lit(True), "left")
    return joined.withColumn("is_test", F.coalesce(F.col("_draw") <= F.col("_limit"), F.lit(False))).drop("_draw", "_class", "_limit")


def lowest(rows: DataFrame, value: str, keys: list[str], wanted: DataFrame, small: bool, bits: int = 16) -> DataFrame:
    """Per key (``_class``) the value (``_limit``) that exactly ``_left`` of its different 64-bit values do not
    exceed; NULL if none is wanted.

    Selection by digits: counts per key and leading digit, of which the one with the wanted rank is looked
    into next. A round is one combining aggregate of at most ``2 ** bits`` cells a key, without a sort of the
    rows; four rounds settle 64 bits."""
    by = ["_class"] if keys else []
    place = F.col(value).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order of the bits
    named = rows.select(*([F.col(keys[0]).alias("_class")] if keys else []), place.alias("_bits"))
    open_ = wanted.withColumn("_prefix", F.lit(0).cast("long"))
    for done in range(bits, 65, bits):
        held = F.broadcast(open_) if small else open_
        same = F.lit(True) if done == bits else F.shiftrightunsigned("_bits", 64 - done + bits) == F.col("_prefix")
        if keys:
            joined = named.alias("r").join(held.alias("o"), F.col("r._class").eqNullSafe(F.col("o._class")) & same)
            joined = joined.select("r._class", "_bits", "_left", "_prefix")
        else:
            joined = named.join(held, same) if done > bits else named.join(held)  # one row
        digit = F.shiftrightunsigned("_bits", 64 - done)
        cells = joined.groupBy(*by, "_left", digit.alias("_digit")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0))
        # At most 2 ** bits cells of a key are summed up.
        found = cells.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left")))
        left = (F.col("_left") - (F.col("_upto") - F.col("_n"))).alias("_left")
        open_, small = settle(found.select(*by, left, F.col("_digit").alias("_prefix")))
    return open_.select(*by, F.col("_prefix").bitwiseXOR(F.lit(-(1 << 63))).alias("_limit"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts per label and prediction, long form."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Iterable) -> DataFrame:
    """Counts with one column per predicted class."""
    return df.groupBy(label).pivot(prediction, list(classes)).agg(F.count(F.lit(1))).na.fill(0)


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as label or prediction."""
    cells = confusion(df, label, prediction).select(
        "n",
        F.explode(
            F.array(
                F.struct(F.col(label).alias("class"), F.lit(True).alias("actual")),
                F.struct(F.col(prediction).alias("class"), F.lit(False).alias("actual")),
            )
        ).alias("_side"),
        (F.col(label) == F.col(prediction)).alias("_hit"),
    ).select("n", "_hit", "_side.*")
    totals = cells.groupBy("class").agg(
        F.sum(F.when(F.col("actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("actual"), F.col("n")).otherwise(0)).alias("_predicted"),
        F.sum(F.when(F.col("actual") & F.col("_hit"), F.col("n")).otherwise(0)).alias("_hits"),
    )
    precision = _ratio(F.col("_hits"), F.col("_predicted"))
    recall = _ratio(F.col("_hits"), F.col("support"))
    f1 = _ratio(2 * precision * recall, precision + recall)
    return totals.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def macro_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Unweighted mean of the F1 of all classes."""
    return class_report(df, label, prediction).agg(F.avg("f1").alias("macro_f1"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


@dataclass
class PhaseModel:
    """A fitted classifier with its feature names and classes (phase codes)."""

    pipeline: PipelineModel | Boosting
    features: list[str]
    classes: list[int]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``predicted`` (phase code) and ``probabilities`` (in the order of ``classes``)."""
        prepared, _ = prepare_features(df.select("*"), self.features)
        codes = F.array(*(F.lit(c) for c in self.classes))
        if isinstance(self.pipeline, Boosting):
            shares = self.pipeline.probabilities(F.array(*(F.col(f"`{c}`") for c in self.features)))
            scored = prepared.withColumn("probabilities", shares)
            best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
            return scored.withColumn("predicted", codes[best - 1])
        scored = self.pipeline.transform(prepared)
        predicted = codes[F.col("prediction").cast("int")]
        kept = scored.withColumns({"predicted": predicted, "probabilities": vector_to_array("probability")})
        return kept.drop("_features", "rawPrediction", "probability", "prediction")

    def forecast(self, df: DataFrame, order: Iterable[str], batch: str | None = "batch_id") -> DataFrame:
        """Class, probabilities and confidence of the last row (of every batch)."""
        order = list(order)
        needed = [c for c in dict.fromkeys([*([batch] if batch else []), *order, *self.features]) if c in df.columns]
        latest = latest_rows(df.select(*needed), order, [batch] if batch else [])
        scored = self.predict(latest)
        name = F.lit(None).cast("string")
        for code, phase in enumerate(PHASES):
            name = F.when(F.col("predicted") == code, phase).otherwise(name)
        names = F.array(*(F.lit(str(c)) for c in self.classes))
        return scored.select(
            *([batch] if batch else []),
            F.coalesce(name, F.col("predicted").cast("string")).alias("predicted_phase"),
            F.map_from_arrays(names, F.col("probabilities")).alias("phase_probabilities"),
            F.array_max("probabilities").alias("confidence"),
        )

    def importances(self, spark: SparkSession) -> DataFrame:
        """Importance per feature; for boosted trees, the share of all gains."""
        if isinstance(self.pipeline, Boosting):
            values = self.pipeline.gains / max(self.pipeline.gains.sum(), 1e-300)
        else:
            values = self.pipeline.stages[-1].featureImportances.toArray()
        rows = [(f, float(v)) for f, v in zip(self.features, values)]
        return spark.createDataFrame(rows, "feature string, importance double")

    def evaluate(self, df: DataFrame, label: str) -> dict[str, DataFrame]:
        scored = self.predict(df)
        return {
            "macro_f1": macro_f1(scored, label, "predicted"),
            "report": class_report(scored, label, "predicted"),
            "confusion": confusion_matrix(scored, label, "predicted", self.classes),
        }

    def save(self, path: str) -> None:
        """Classifier below ``path/classifier`` (a forest) or as one JSON record below ``path/trees``, names
        as one JSON record below ``path/names``."""
        spark = SparkSession.active()
        boosted = isinstance(self.pipeline, Boosting)
        if boosted:
            _write_text(spark, self.pipeline.to_json(), f"{path}/trees")
        else:
            self.pipeline.write().overwrite().save(f"{path}/classifier")
        names = {"features": self.features, "classes": self.classes, "boosted": boosted}
        _write_text(spark, json.dumps(names), f"{path}/names")

    @staticmethod
    def load(path: str) -> "PhaseModel":
        spark = SparkSession.active()
        names = json.loads(spark.read.text(f"{path}/names").first()[0])
        if names["boosted"]:
            pipeline = Boosting.from_json(spark.read.text(f"{path}/trees").first()[0])
        else:
            pipeline = PipelineModel.load(f"{path}/classifier")
        return PhaseModel(pipeline, names["features"], names["classes"])


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def latest_rows(df: DataFrame, order: Iterable[str], keys: list[str]) -> DataFrame:
    """The last row in ``order`` of every key.

    A hash aggregate finds the last instant of each key; only the rows of these instants are put in order,
    of which a task passes on one per key."""
    order = list(order)
    time = order[0]
    if keys:
        ends = df.groupBy(*keys).agg(F.max(time).alias("_last"))
        ends, small = settle(ends.withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)}))
        same = F.col(time).eqNullSafe(F.col("_last"))
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
        held = df.join(F.broadcast(ends) if small else ends, same).select(*df.columns)
    else:
        held = df.filter(F.col(time).eqNullSafe(df.agg(F.max(time)).scalar()))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.desc(o) for o in order)))
    return held.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def _indexed(train: DataFrame, label: str) -> tuple[DataFrame, list[int]]:
    """Number the classes in ``_label``. Rows without a label have none."""
    found = train.select(F.col(label).cast("long").alias("_class")).distinct().filter("_class IS NOT NULL")
    classes = sorted(int(r[0]) for r in found.limit(MAX_CLASSES + 1).collect())
    if len(classes) < 2:
        raise ValueError("the label needs at least two classes")
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"the label has more than {MAX_CLASSES} classes")
    numbers = train.sparkSession.createDataFrame([(c, float(i)) for i, c in enumerate(classes)], "_class long, _label double")
    joined = train.join(F.broadcast(numbers), F.col(label).cast("long") == F.col("_class"), "left")
    return joined.drop("_class"), classes


def _fit(train: DataFrame, label: str, columns: Iterable[str] | None, classifier) -> PhaseModel:
    indexed, classes = _indexed(train, label)
    prepared, columns = prepare_features(indexed, columns)
    assembler = VectorAssembler(inputCols=columns, outputCol="_features")
    vectors = assembler.transform(prepared).select("_features", "_label")
    # Training reads the vectors many times: spread them evenly, whatever partitions they came in.
    partitions = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vectors = vectors.repartition(partitions).persist()
    try:
        model = classifier.fit(vectors)
    finally:
        vectors.unpersist()
    return PhaseModel(PipelineModel([assembler, model]), columns, classes)


def fit_boosted(
    train: DataFrame,
    label: str,
    columns: Iterable[str] | None = None,
    iterations: int = 100,
    rate: float = 0.1,
    depth: int = 5,
) -> PhaseModel:
    """Gradient-boosted trees with one softmax loss over all classes. Rows without a label are left out; the
    fit takes no random choices."""
    indexed, classes = _indexed(train, label)
    prepared, columns = prepare_features(indexed, columns)
    fitted = fit_softmax(prepared, columns, "_label", len(classes), iterations, rate, depth)
    return PhaseModel(fitted, columns, classes)


def fit_forest(
    train: DataFrame,
    label: str,
    columns: Iterable[str] | None = None,
    trees: int = 100,
    depth: int = 10,
    min_split: int = 5,
    seed: int = 42,
) -> PhaseModel:
    """Random forest. ``min_split`` bounds the rows of a node that is split; Spark bounds those of the
    children, for which half of it is the nearest setting."""
    forest = RandomForestClassifier(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=max(1, min_split // 2),
        seed=seed,
        featuresCol="_features",
        labelCol="_label",
    )
    return _fit(train, label, columns, forest)


def future_phase(
    df: DataFrame, order: Iterable[str], phase: str = "phase", keys: Iterable[str] = (), steps: int = 72
) -> DataFrame:
    """Label for a real horizon: the phase ``steps`` rows later (72 rows of 5 minutes = 6 hours)."""
    arranged = arrange(df, order, keys)
    return arranged.framed(lambda w: {"future_phase": F.lead(phase, steps).over(w)}, back=0, ahead=steps).result()
