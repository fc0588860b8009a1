"""Sliced execution gives exactly the results of one plain window."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tankwise.operators.missing import fill_gaps
from tankwise.plans.ordered import SLICE, arrange
from tests.frames import by_id, telemetry, to_spark

ORDER = ("ts", "id")


@pytest.fixture(scope="module", params=[True, False], ids=["hot instant", "even"])
def rows(spark, request):
    return to_spark(spark, telemetry(hot_instant=request.param)).cache()


@pytest.mark.parametrize("keys", [(), ("tank",)], ids=["global", "keyed"])
@pytest.mark.parametrize("limit", [5, 40, 10_000])
def test_framed(rows, keys, limit):
    def columns(w):
        frame = w.rowsBetween(-11, 0)
        both = w.rowsBetween(-4, 3)
        return {
            "lag": F.lag("x", 12).over(w),
            "mean": F.avg("x").over(frame),
            "n": F.count(F.lit(1)).over(frame),
            "around": F.sum("y").over(both),
            "lead": F.lead("y", 3).over(w),
        }

    arranged = arrange(rows, ORDER, keys, limit)
    assert arranged.split == (limit < 10_000)
    mine = by_id(arranged.framed(columns, back=12, ahead=3).result(), "lag", "mean", "n", "around", "lead")
    plain = by_id(
        rows.withColumns(columns(Window.partitionBy(*keys).orderBy(*ORDER))), "lag", "mean", "n", "around", "lead"
    )
    assert mine.equals(plain)


@pytest.mark.parametrize("keys", [(), ("tank",)], ids=["global", "keyed"])
@pytest.mark.parametrize("limit", [5, 40])
def test_scan(rows, keys, limit):
    def scanned(limit):
        found = arrange(rows, ORDER, keys, limit).scan(
            sums={"total": F.col("id")}, totals=["total"], earlier=["x"], later=["x"]
        )
        columns = ("_position", "total", "total_total", "_prev_x.value", "_prev_x.at", "_next_x.value", "_next_x.at")
        names = ("position", "total", "whole", "before", "before_at", "after", "after_at")
        return by_id(found.result().select("id", *(F.col(c).alias(n) for c, n in zip(columns, names))), *names)

    plain = scanned(10_000)
    assert scanned(limit).equals(plain)
    frame = telemetry(hot_instant=rows.groupBy("ts").count().filter("count > 100").count() > 0)
    frame = frame.sort_values(["ts", "id"])
    grouped = frame.groupby("tank") if keys else frame.groupby(lambda _: 0)
    frame["position"], frame["total"] = grouped.cumcount(), grouped["id"].cumsum()
    frame["before"], frame["after"] = grouped["x"].ffill(), grouped["x"].bfill()
    expected = frame.sort_values("id").reset_index(drop=True)
    for c in ("position", "total", "before", "after"):
        np.testing.assert_array_equal(plain[c].to_numpy(float), expected[c].to_numpy(float))


def test_slices_are_bounded_and_ordered(spark):
    """A third of the rows at one instant: still no slice with more than a few times the limit."""
    rows = to_spark(spark, telemetry(3000, hot_instant=True))
    cut = arrange(rows, ORDER, (), 100).rows
    sizes = cut.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*ORDER)).alias("lo"), F.max(F.struct(*ORDER)).alias("hi"))
    found = sizes.orderBy(SLICE).collect()
    assert max(r["n"] for r in found) <= 300
    assert all(a["hi"] < b["lo"] for a, b in zip(found, found[1:]))


def test_null_keys_and_times(spark):
    frame = telemetry(200, hot_instant=False)
    rows = to_spark(spark, frame).withColumn("tank", F.when(F.col("id") % 3 != 0, F.col("tank")))
    rows = rows.withColumn("ts", F.when(F.col("id") % 50 != 0, F.col("ts")))
    split = by_id(arrange(rows, ORDER, ["tank"], 10).scan(earlier=["x"]).result(), "_position", "_prev_x.value")
    plain = by_id(arrange(rows, ORDER, ["tank"], 10_000).scan(earlier=["x"]).result(), "_position", "_prev_x.value")
    assert split.equals(plain)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="nowhere"):
        arrange(spark.range(3), ["nowhere"])


def check_slices(rows, order, keys, limit, reach=(11, 4)):
    """Equal to the plain window, with slices of bounded size and few copies."""
    back, ahead = reach

    def columns(w):
        return {"total": F.sum("x").over(w.rowsBetween(-back, ahead)), "n": F.count(F.lit(1)).over(w.rowsBetween(-back, ahead))}

    arranged = arrange(rows, order, keys, limit)
    assert arranged.split
    sizes = [r["count"] for r in arranged.rows.groupBy(SLICE).count().collect()]
    assert len(sizes) <= -(-rows.count() // limit) and max(sizes) <= max(3 * limit, 20)
    assert arranged._copies(back, ahead).count() <= (len(sizes) - 1) * (back + ahead)
    mine = by_id(arranged.framed(columns, back, ahead).result(), "total", "n")
    plain = by_id(rows.withColumns(columns(Window.partitionBy(*keys).orderBy(*order))), "total", "n")
    assert mine.equals(plain)
    scanned = arranged.scan(sums={"_sum": F.col("x")}, totals=["_sum"], earlier=["gap"], later=["gap"]).result()
    usual = arrange(rows, order, keys, 10**9).scan(sums={"_sum": F.col("x")}, totals=["_sum"], earlier=["gap"], later=["gap"]).result()
    names = ("_position", "_sum", "_sum_total", "_prev_gap.value", "_next_gap.at")
    assert by_id(scanned, *names).equals(by_id(usual, *names))


def test_many_heavy_instants(spark):
    """Coarse times that many tanks share: every instant is cut, and slices don't multiply."""
    rows = spark.range(6_000).selectExpr(
        "id", "timestamp_seconds(id % 20 * 300) AS ts", "concat('tank', id % 300) AS tank",
        "id * 7 % 13 AS x", "if(id % 31 = 0, id, NULL) AS gap",
    )
    check_slices(rows, ("ts", "tank", "id"), (), 200)
    check_slices(rows, ("tank", "ts", "id"), (), 200)  # a string first


def test_one_hot_tank_among_many_small_ones(spark):
    rows = spark.range(6_000).selectExpr(
        "id", "timestamp_seconds(id) AS ts", "if(id < 3000, 'hot', concat('tank', id % 100)) AS tank",
        "id * 7 % 13 AS x", "if(id % 31 = 0, id, NULL) AS gap",
    )
    check_slices(rows, ("ts", "id"), ("tank",), 250)


def test_slices_shorter_than_the_frame(spark):
    rows = spark.range(300).selectExpr("id", "id AS ts", "id % 5 AS x", "if(id % 9 = 0, id, NULL) AS gap")
    check_slices(rows, ("ts",), (), 3, reach=(25, 10))


def test_many_slices_share_ranges(spark):
    """Slices of a few rows do not take a task and a file each, and hold as many rows as asked for."""
    rows = spark.range(4_000).selectExpr(
        "id", "timestamp_seconds(id * 37 % 4000) AS ts", "concat('tank', id % 9) AS tank",
        "id * 7 % 13 AS x", "if(id % 31 = 0, id, NULL) AS gap",
    )
    cut = arrange(rows, ("ts", "id"), ("tank",), 20).rows
    assert len(cut.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
    assert {r["count"] for r in cut.groupBy(SLICE).count().collect()} == {20}
    check_slices(rows, ("ts", "id"), ("tank",), 20)
    check_slices(rows, ("ts", "id"), (), 20)


def test_gaps_across_many_slices_of_a_range(spark):
    """Gaps longer than a slice, with fewer tasks than slices."""
    rows = spark.range(3_000).selectExpr(
        "id", "id AS ts", "concat('tank', id % 2) AS tank", "if(id % 400 < 150, NULL, CAST(id * id AS DOUBLE)) AS x",
    )
    cut = arrange(rows, ("ts", "id"), ("tank",), 20)
    assert cut.rows.select(F.spark_partition_id()).distinct().count() <= 2 * spark.sparkContext.defaultParallelism
    filled = [by_id(fill_gaps(arrange(rows, ("ts", "id"), ("tank",), n), ("ts", "id"), ("tank",), ["x"], "both"), "x") for n in (20, 10**9)]
    assert filled[0].equals(filled[1]) and filled[0]["x"].notna().all()


def test_equal_rows_in_two_slices(spark):
    """Rows that come twice, across the borders of slices: each twin has the lag that the plain window gives."""
    rows = spark.range(2_000).selectExpr("id div 2 AS id", "id div 2 AS ts", "concat('tank', id div 2 % 3) AS tank", "CAST(id div 2 AS DOUBLE) AS x")
    for keys, limit in (((), 15), (("tank",), 15), (("tank",), 1)):
        def lagged(limit):
            found = arrange(rows, ("ts", "id"), keys, limit).framed(lambda w: {f"lag{n}": F.lag("x", n).over(w) for n in (1, 3)}, back=3)
            return sorted(map(tuple, found.result().select("id", F.coalesce("lag1", F.lit(-1.0)), F.coalesce("lag3", F.lit(-1.0))).collect()))

        assert lagged(limit) == lagged(10**9)
