"""Fits that grow by days, verdicts observed while writing, records with further fields."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tankwise.operators import outliers, scaling, states, validate
from tankwise.sources.readers import extra, with_extras, with_extras_json


@pytest.fixture(scope="module")
def days(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(900):
        x = float(np.round(rng.gamma(2, 3), 3)) if k % 13 else None
        rows.append((f"2024-01-{1 + k % 30:02}", ["a", "b", None][k % 3], x, float("nan") if k % 50 == 0 else float(k % 7), 4.0))
    return spark.createDataFrame(rows, "day string, tank string, x double, y double, same double").repartition(4)


def by_key(df, *columns):
    return {(r["tank"], r["column"]): [r[c] for c in columns] for r in df.collect()}


def test_days_added_one_by_one(spark, days, tmp_path):
    path, columns = str(tmp_path / "states"), ["x", "y", "same"]
    for day in ("2024-01-07", "2024-01-30"):
        states.append(days.filter(F.col("day") == day), path, ["tank"], columns, day)
    states.append(days.filter("day NOT IN ('2024-01-07', '2024-01-30')"), path, ["tank"], columns, "rest")
    states.append(days.filter("day = '2024-01-30'"), path, ["tank"], columns, "2024-01-30")  # given again
    names = ("n", "mean", "m2", "m3", "m4", "low", "high")
    grown = by_key(states.read(spark, path, ["tank"]), *names)
    whole = by_key(states.states(days, ["tank"], columns), *names)
    assert set(grown) == set(whole) and len(grown) == 9
    for key, values in whole.items():
        assert grown[key] == pytest.approx(values, rel=1e-9, abs=1e-9)
    one_day = spark.read.parquet(path).filter("day = '2024-01-30'")
    assert one_day.count() == 3


def test_states_against_numpy(spark, days):
    found = by_key(states.summary(states.merged(states.states(days, ["tank"], ["x"]), ["tank"])), "n", "mean", "std", "skew", "kurt")
    for tank in ("a", "b", None):
        x = np.array([r["x"] for r in days.collect() if r["tank"] == tank and r["x"] is not None])
        d, m = x - x.mean(), x.std()
        want = [len(x), x.mean(), x.std(ddof=1), (d**3).mean() / m**3, (d**4).mean() / m**4 - 3]
        assert found[tank, "x"] == pytest.approx(want)


@pytest.mark.parametrize("method", ["standard", "minmax"])
def test_scaling_from_states_equals_the_fit(days, method):
    known = days.filter("tank IS NOT NULL").withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    found = states.scaling_from_states(states.merged(states.states(known, ["tank"], ["x", "y"]), ["tank"]), ["tank"], ["x", "y"], method)
    want = {r["tank"]: r.asDict() for r in scaling.scaling_params(known, ["x", "y"], method, "tank").collect()}
    got = {r["tank"]: r.asDict() for r in found.collect()}
    assert set(got) == set(want)
    for tank, row in want.items():
        for name, value in row.items():
            assert got[tank][name] == (value if isinstance(value, str) else pytest.approx(value))


def test_zscore_bounds_from_states(days):
    found = states.zscore_bounds_from_states(states.merged(states.states(days, [], ["x"]), [])).first()
    low, high = outliers.zscore_bounds(days, ["x"])["x"]
    assert (found["lower"], found["upper"]) == (pytest.approx(low), pytest.approx(high))


def test_states_of_nothing(days):
    assert states.merged(states.states(days.limit(0), ["tank"], ["x"]), ["tank"]).collect() == []


RULES = [validate.Schema("x"), validate.Schema("none"), validate.Range("x", 0, 5), validate.MissingShare(0.05), validate.DuplicateTimes("day")]


def test_observed_verdicts(spark, days, tmp_path):
    """Equal to a validation of their own; written files and verdicts of several runs."""
    log = str(tmp_path / "verdicts")
    for run in ("one", "two"):
        found = validate.write_validated(days, RULES, str(tmp_path / run), run, log)
        want = {tuple(r) for r in validate.validate(days, RULES, run).collect()}
        assert {tuple(r)[:-1] for r in found.collect()} == want and {r["overall"] for r in found.collect()} == {False}
        assert spark.read.parquet(str(tmp_path / run)).count() == 900
    assert spark.read.parquet(log).groupBy("run_id").count().count() == 2
    good = validate.write_validated(days, [validate.Range("same", 0, 5)], str(tmp_path / "good"), "three")
    assert good.first()["overall"] is True


def test_observed_in_one_pass(spark, days, tmp_path, monkeypatch):
    """Rules that need no grouping read no row again."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    passed = days.mapInArrow(counted, days.schema)
    validate.write_validated(passed, RULES[:4], str(tmp_path / "once"), "run").collect()
    assert reads.value == 900


def test_extras_come_back(spark):
    bodies = [
        {"co2_lpm": 5.0, "tank_id": "a", "Tank_ID": "clash", "nested": {"a": [1, {"b": None}]}, "flag": True},
        {"co2_lpm": None, "extras": {"x": 1}},
        {},
    ]
    frame = spark.createDataFrame([(k, json.dumps(b)) for k, b in enumerate(bodies)] + [(3, "no json"), (4, None)], "id int, body string")
    parsed = with_extras(frame, "body")
    got = parsed.select("id", "co2_lpm", "tank_id", F.map_keys("extras").alias("names"), extra("nested", "$.a[0]", "int").alias("first"), extra("nested", "$.a", "int").alias("wrong")).collect()
    rows = {r["id"]: r for r in got}
    assert (rows[0]["co2_lpm"], rows[0]["tank_id"], rows[0]["first"], rows[0]["wrong"]) == (5.0, "a", 1, None)
    assert sorted(rows[0]["names"]) == ["Tank_ID", "flag", "nested"] and rows[1]["names"] == ["extras"]
    assert all(rows[k]["names"] == [] for k in (2, 3, 4))
    back = {r["id"]: json.loads(r["record"]) for r in with_extras_json(parsed, ["co2_lpm", "tank_id"]).select("id", "record").collect()}
    assert back[0] == bodies[0] and back[1] == {"extras": {"x": 1}} and back[3] == {}
