import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tankwise import jobs
from tankwise.functions.phases import label_code, phase_cut
from tankwise.operators import models
from tankwise.operators.features import all_features


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(
        {"id": np.arange(400), "co2_lpm": rng.uniform(10, 2000, 400), "do_ppm": rng.uniform(0, 20, 400), "temp_c": 20.0}
    )
    made = spark.createDataFrame([tuple(r) for r in frame.astype(object).itertuples(index=False)], "id long, co2_lpm double, do_ppm double, temp_c double")
    return made.withColumns(
        {"phase": phase_cut(F.col("co2_lpm")), "label": label_code(phase_cut(F.col("co2_lpm"))),
         "timestamp": F.timestamp_seconds(F.col("id") * 300), "batch_id": F.concat(F.lit("b"), (F.col("id") % 3).cast("string"))}
    ).cache()


def test_bins_are_closed_on_the_right(spark):
    values = spark.createDataFrame([(v,) for v in (None, 0.0, 500.0, 500.1, 1000.0, 1500.0, 1500.1)], "v double")
    phases = [r[0] for r in values.select(phase_cut(F.col("v"))).collect()]
    assert phases == [None, None, "lag", "exponential", "exponential", "stationary", "decline"]


def test_features_fill_gaps_and_absent_columns(spark):
    made, names = models.prepare_features(spark.createDataFrame([(1.0, None)], "a double, b double"), ["a", "b", "c"])
    assert tuple(made.first()) == (1.0, 0.0, 0.0) and names == ["a", "b", "c"]
    _, chosen = models.prepare_features(spark.createDataFrame([("x", 1, 2.0)], "batch_id string, phase_encoded int, v double"))
    assert chosen == ["v"]
    with pytest.raises(ValueError, match="none of the feature columns"):
        models.prepare_features(spark.range(1), ["z"])


@pytest.mark.parametrize("sliced", [False, True])
def test_split_is_exact_and_repeatable(rows, sliced, request):
    if sliced:
        request.getfixturevalue("small_slices")
    split = models.stratified_split(rows, "label", ["id"])
    sizes = split.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("test")).collect()
    assert all(r["test"] == int(0.2 * r["n"]) for r in sizes) and len(sizes) == 4
    again = models.stratified_split(rows.repartition(7), "label", ["id"])
    assert split.filter("is_test").select("id").exceptAll(again.filter("is_test").select("id")).count() == 0


def test_split_special_cases(spark):
    with pytest.raises(ValueError, match="at least two classes"):
        models.stratified_split(spark.range(5).withColumn("label", F.lit(1)), "label", ["id"])
    lonely = spark.range(11).withColumn("label", (F.col("id") == 3).cast("int"))
    assert models.stratified_split(lonely, "label", ["id"]).filter("is_test").count() == 2


def test_scores_worked(spark):
    rows = spark.createDataFrame([(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 0)], "y int, p int")
    found = {r["class"]: r for r in models.class_report(rows, "y", "p").collect()}
    assert (found[0]["precision"], found[0]["recall"]) == (0.75, 0.75)
    assert found[1]["f1"] == pytest.approx(0.8) and found[2]["f1"] == 0.0
    assert [found[c]["support"] for c in range(3)] == [4, 2, 1]
    assert models.macro_f1(rows, "y", "p").first()[0] == pytest.approx((0.75 + 0.8) / 3)
    matrix = {r["y"]: tuple(r)[1:] for r in models.confusion_matrix(rows, "y", "p", [0, 1, 2]).collect()}
    assert matrix == {0: (3, 1, 0), 1: (0, 2, 0), 2: (1, 0, 0)}


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_fit_predict_save_load(spark, rows, kind, tmp_path):
    split = models.stratified_split(rows, "label", ["id"])
    train, test = split.filter("not is_test"), split.filter("is_test")
    columns = ["co2_lpm", "do_ppm", "temp_c"]
    if kind == "boosted":
        model = models.fit_boosted(train, "label", columns, iterations=4, depth=3)
    else:
        model = models.fit_forest(train, "label", columns, trees=10, depth=5)
    assert model.classes == [0, 1, 2, 3]
    assert model.evaluate(test, "label")["macro_f1"].first()[0] > 0.9
    scored = model.predict(test).select("id", "predicted", "probabilities").orderBy("id").collect()
    assert all(sum(r["probabilities"]) == pytest.approx(1) for r in scored)
    assert all(np.argmax(r["probabilities"]) == r["predicted"] for r in scored)
    model.save(str(tmp_path / "model"))
    loaded = models.PhaseModel.load(str(tmp_path / "model"))
    assert loaded.predict(test).select("id", "predicted", "probabilities").orderBy("id").collect() == scored
    importances = {r["feature"]: r["importance"] for r in model.importances(spark).collect()}
    assert max(importances, key=importances.get) == "co2_lpm" and importances["temp_c"] == 0
    forecasts = model.forecast(rows, ["timestamp"]).collect()
    last = {r["batch_id"]: r["phase"] for r in rows.filter("id >= 397").collect()}
    assert {r["batch_id"]: r["predicted_phase"] for r in forecasts} == last
    assert all(r["confidence"] == max(r["phase_probabilities"].values()) for r in forecasts)
    assert set(forecasts[0]["phase_probabilities"]) == {"0", "1", "2", "3"}


def test_one_class_cannot_be_fitted(spark):
    with pytest.raises(ValueError, match="at least two classes"):
        models.fit_forest(spark.range(4).withColumn("label", F.lit(0)), "label", ["id"])


def test_scoring_job(spark, rows):
    columns = ["co2_lpm", "do_ppm", "co2_lpm_lag_1"]
    records = rows.select("id", "timestamp", "batch_id", "co2_lpm", "do_ppm", "temp_c")
    made = all_features(records, ["timestamp", "id"]).withColumn("label", label_code(phase_cut(F.col("co2_lpm"))))
    model = models.fit_forest(made, "label", columns, trees=5, depth=5)
    assert jobs.score(records, model, ["timestamp", "id"]).count() == 3


@pytest.mark.parametrize("sliced", [False, True])
def test_future_phase(rows, sliced, request):
    if sliced:
        request.getfixturevalue("small_slices")
    found = models.future_phase(rows, ["timestamp"], steps=30).select("id", "phase", "future_phase").toPandas().sort_values("id")
    expected = found["phase"].shift(-30)
    assert found["future_phase"].iloc[:-30].tolist() == expected.iloc[:-30].tolist()
    assert found["future_phase"].iloc[-30:].isna().all()


def test_many_classes(spark):
    """None is dropped, and the plan doesn't grow with them; too many are refused."""
    rows = spark.range(3_600).selectExpr("int(id % 1200) * 3 AS label", "double(id) AS v")
    indexed, classes = models._indexed(rows.unionByName(spark.createDataFrame([(None, 0.0)], "label int, v double")), "label")
    assert classes == [3 * k for k in range(1200)]
    assert indexed.filter("_label IS NULL").count() == 1
    assert indexed.filter("label = 3 * _label").count() == 3_600
    with pytest.raises(ValueError, match="more than"):
        models._indexed(spark.range(models.MAX_CLASSES + 1).selectExpr("int(id) AS label"), "label")
    with pytest.raises(ValueError, match="at least two"):
        models._indexed(rows.filter("label = 3"), "label")
