"""Stateful stream operators that give what the batch gives, for rows in any order of arrival.

Rows, or sums per bucket, wait in state until the watermark has passed them; a timer then takes all that it has
passed, in time order. Spark drops rows older than the watermark. What a key keeps is bounded by the lateness
allowed, and is given up when the key has been silent for long enough.

Every call of the state is a message to the executor's JVM. A key therefore reads and writes its state once per
batch and once per watermark, whatever its number of rows, and has one timer per batch, at the first time that
any of the batch's rows waits for."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import asdict, fields

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tankwise.operators.anomaly import (
    MAX_BAR,
    MIN_BAR,
    PRESSURE_RISE_PER_MINUTE,
    SAMPLE_MINUTES,
    SEVERITIES,
    STUCK_RATE,
    STUCK_WINDOW,
    VIGOROUS_PER_MINUTE,
    Thresholds,
)

STREAMED = (
    "stuck_fermentation",
    "oxidation_risk",
    "high_pressure",
    "low_pressure",
    "abnormal_co2_activity",
    "over_vigorous_co2",
    "rapid_pressure_rise",
)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FOUND = (
    "co2_rate",
    "co2_rolling_mean",
    "do_change",
    "co2_rate_per_min",
    "pressure_rate_per_min",
    "anomaly_type",
    "severity",
)
#: Rows wait until the watermark has passed the end of their span of this many milliseconds.
_TICK = 60_000
#: Rows of one entry of the waiting list.
_CHUNK = 1_000
_DAY = 86_400_000


def _ready(stream: DataFrame) -> None:
    if not stream.sparkSession.conf.get(_PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        raise ValueError(f"set {_PROVIDER} to {ROCKSDB}; sessions of build_session() have it")


def write_thresholds(spark: SparkSession, limits: Thresholds, path: str) -> None:
    """The limits of a batch run as a table of one row."""
    schema = ", ".join(f"{f.name} double" for f in fields(Thresholds))
    spark.createDataFrame([tuple(asdict(limits).values())], schema).coalesce(1).write.mode("overwrite").parquet(path)


def read_thresholds(spark: SparkSession, path: str) -> Thresholds:
    return Thresholds(**spark.read.parquet(path).first().asDict())


def _number(value) -> float | None:
    """A reading; NaN counts as missing."""
    return None if value is None or value != value else float(value)


def _change(now: float | None, before: float | None) -> float | None:
    return None if now is None or before is None else now - before


class _Detection(StatefulProcessor):
    """One key's rows in order of (time, tiebreak), each compared with the one before and with the CO2
    changes of the last ``STUCK_WINDOW`` rows."""

    def __init__(self, key: str, tiebreak: str, limits: Thresholds, types: tuple[str, ...], forget: int, kind: str):
        self.tiebreak, self.limits, self.types, self.forget, self.kind = tiebreak, limits, types, forget, kind
        self.row = Row(key, "_micros", tiebreak, *_FOUND)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        readings = ("co2", "oxygen", "pressure")
        lists = ", ".join(f"{name} array<double>" for name in readings)
        self.waiting = handle.getListState("waiting", f"micros array<long>, tiebreak array<{self.kind}>, {lists}")
        row = f"micros long, tiebreak {self.kind}, " + ", ".join(f"{name} double" for name in readings)
        self.last = handle.getValueState("last", f"{row}, silent_at long, rates array<double>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, some = None, []
        for row in rows:
            micros = row["_micros"]
            first = micros if first is None else min(first, micros)
            some.append(
                (micros, row[self.tiebreak], _number(row["_co2"]), _number(row["_oxygen"]), _number(row["_pressure"]))
            )
            if len(some) == _CHUNK:
                self.waiting.appendValue(_chunk(some))
                some = []
        if some:
            self.waiting.appendValue(_chunk(some))
        if first is not None:
            self.handle.registerTimer(_due(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        due, later = [], []
        for chunk in self.waiting.get():
            for row in zip(*chunk):
                (due if _due(row[0]) <= passed else later).append(row)
        if not due:
            self._silent(expiredTimerInfo.getExpiryTimeInMs())
            return
        due.sort(key=lambda row: row[:2])
        *before, silent_at, rates = self.last.get() or (None, None)
        if silent_at is not None and silent_at < _due(due[0][0]):
            before, rates = None, None  # a key that was silent begins anew
        rates = list(rates or ())
        for row in due:
            yield from self._judged(key, row, before, rates)
            before = row
        self.waiting.clear()
        for start in range(0, len(later), _CHUNK):
            self.waiting.appendValue(_chunk(later[start : start + _CHUNK]))
        if later:
            self.handle.registerTimer(_due(min(row[0] for row in later)))
        silent_at = _due(before[0]) + self.forget
        self.last.update((*before, silent_at, rates))
        self.handle.registerTimer(silent_at)

    def _silent(self, now: int) -> None:
        """Give up what is known of a key if its last row is as old as that; rows that wait begin anew."""
        known = self.last.get()
        if known is not None and known[5] <= now:
            self.last.clear()

    def _judged(self, key, row: tuple, before: Sequence | None, rates: list) -> Iterator[Row]:
        micros, tiebreak, co2, oxygen, pressure = row
        co2_rate = _change(co2, before[2]) if before else None
        do_change = _change(oxygen, before[3]) if before else None
        pressure_rate = _change(pressure, before[4]) if before else None
        rates.append(co2_rate)
        del rates[:-STUCK_WINDOW]
        known = [rate for rate in rates if rate is not None]
        mean = sum(known) / len(known) if known else None
        found = {
            "stuck_fermentation": _below(mean, STUCK_RATE) and _below(co2, self.limits.stuck_below),
            "oxidation_risk": _above(do_change, self.limits.oxidation_above),
            "high_pressure": _above(pressure, MAX_BAR),
            "low_pressure": _below(pressure, MIN_BAR),
            "abnormal_co2_activity": _above(None if co2_rate is None else abs(co2_rate), self.limits.co2_jump_above),
            "over_vigorous_co2": _above(_per_minute(co2_rate), VIGOROUS_PER_MINUTE),
            "rapid_pressure_rise": _above(_per_minute(pressure_rate), PRESSURE_RISE_PER_MINUTE),
        }
        for kind in self.types:
            if found[kind]:
                rates_per_minute = _per_minute(co2_rate), _per_minute(pressure_rate)
                yield self.row(*key, micros, tiebreak, co2_rate, mean, do_change, *rates_per_minute, kind, SEVERITIES[kind])

    def close(self) -> None:
        pass


def _due(micros: int) -> int:
    """The watermark in milliseconds that a row of that time waits for."""
    return (micros // 1_000 // _TICK + 1) * _TICK


def _chunk(rows: list[tuple]) -> tuple[list, ...]:
    """Rows as one entry of lists, one per field."""
    return tuple(map(list, zip(*rows)))


def _above(value: float | None, limit: float | None) -> bool:
    return value is not None and limit is not None and value > limit


def _below(value: float | None, limit: float | None) -> bool:
    return value is not None and limit is not None and value < limit


def _per_minute(change: float | None) -> float | None:
    return None if change is None else change / SAMPLE_MINUTES


def alerts(
    stream: DataFrame,
    key: str,
    time: str,
    tiebreak: str,
    thresholds: Thresholds | None = None,
    types: Iterable[str] = STREAMED,
    lateness: str = "10 minutes",
    forget_days: float = 7,
    co2: str = "co2_lpm",
    do: str = "do_ppm",
    pressure: str = "pressure_bar",
) -> DataFrame:
    """One row per anomaly of a stream: ``key, time, tiebreak``, the readings' changes, type and severity.

    Equals the batch detector within ``key`` under the same thresholds, for rows that arrive in any order but
    at most ``lateness`` behind the newest; rows are judged once the watermark has passed their minute. Limits
    that depend on a whole table come from a batch run (``thresholds``); without them their detectors find
    nothing. Absent columns and NaN count as missing. A key's first row after ``forget_days`` without one is
    taken as the first of all. ``tiebreak`` orders rows of one time."""
    _ready(stream)
    types = tuple(name for name in STREAMED if name in set(types))
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    readings = {"_co2": co2, "_oxygen": do, "_pressure": pressure}
    rows = stream.withWatermark(time, lateness).select(
        key,
        time,
        tiebreak,
        F.unix_micros(time).alias("_micros"),
        *(
            (F.col(name).cast("double") if name in kinds else F.lit(None).cast("double")).alias(alias)
            for alias, name in readings.items()
        ),
    )
    output = f"`{key}` {kinds[key]}, _micros long, `{tiebreak}` {kinds[tiebreak]}, " + ", ".join(
        f"{name} {'string' if name in _FOUND[-2:] else 'double'}" for name in _FOUND
    )
    found = rows.filter(F.col(time).isNotNull()).groupBy(key).transformWithState(
        _Detection(key, tiebreak, thresholds or Thresholds(), types, round(forget_days * _DAY), kinds[tiebreak]),
        output,
        "Append",
        "EventTime",
    )
    rest = [c for c in found.columns if c not in (key, "_micros")]
    return found.select(key, F.timestamp_micros("_micros").alias(time), *rest)


class _Grid(StatefulProcessor):
    """One key's bucket sums. A bucket is closed when the watermark has passed its end; buckets between two
    closed ones are empty, and come out as the number of the first of them with the row of the bucket behind
    them. With ``patience``, gaps are filled on the line to the next reading, and a bucket waits for that, for
    at most so many buckets."""

    def __init__(self, step: int, by: list[str], columns: list[str], patience: int | None):
        self.step, self.columns, self.patience = step, len(columns), patience
        self.row = Row(*by, "_from", "_bucket", *columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Sums and counts of one bucket's columns lie side by side.
        self.sums = handle.getValueState("sums", "buckets array<long>, totals array<double>, counts array<long>")
        self.closed = handle.getValueState("closed", "bucket long, emitted long")
        if self.patience is not None:
            # Per column: the last known mean and its bucket; and closed buckets whose gaps are still open.
            self.known = handle.getValueState("known", "buckets array<long>, means array<double>")
            self.open = handle.getListState("open", "bucket long, means array<double>")

    def _held(self) -> dict[int, tuple[list[float], list[int]]]:
        """Sums and counts per column of every open bucket."""
        buckets, totals, counts = self.sums.get() or ((), (), ())
        width = self.columns
        return {b: (list(totals[i * width : (i + 1) * width]), list(counts[i * width : (i + 1) * width])) for i, b in enumerate(buckets)}

    def _hold(self, held: dict[int, tuple[list[float], list[int]]]) -> None:
        if held:
            self.sums.update((list(held), [t for ts, _ in held.values() for t in ts], [n for _, ns in held.values() for n in ns]))
        else:
            self.sums.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        closed = self.closed.get()
        last = None if closed is None else closed[0]
        held = self._held()
        opened, names = None, [f"_v{i}" for i in range(self.columns)]
        for row in rows:
            bucket = row["_bucket"]
            if last is not None and bucket <= last:
                continue  # as late as rows that Spark drops
            if bucket not in held:
                held[bucket] = [0.0] * self.columns, [0] * self.columns
                opened = bucket if opened is None else min(opened, bucket)
            totals, counts = held[bucket]
            for i, name in enumerate(names):
                value = _number(row[name])
                if value is not None:
                    totals[i] += value
                    counts[i] += 1
        self._hold(held)
        if opened is not None:
            self.handle.registerTimer(opened + self.step)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = self._held()
        done = sorted(bucket for bucket in held if bucket + self.step <= passed)
        if not done:
            return
        last, emitted = self.closed.get() or (None, done[0] - self.step)
        means = [[t / n if n else None for t, n in zip(*held.pop(bucket))] for bucket in done]
        if self.patience is None:
            for bucket, values in zip(done, means):
                yield self.row(*key, bucket if last is None else last + self.step, bucket, *values)
                last = emitted = bucket
        else:
            known = {i: p for i, p in enumerate(zip(*(self.known.get() or ((), ())))) if p[0] is not None}
            rows = [(r[0], list(r[1])) for r in self.open.get()]
            for bucket, values in zip(done, means):
                rows.append((bucket, values))
                emitted = yield from self._filled(key, bucket, rows, known, emitted)
            places = [known.get(i, (None, None)) for i in range(self.columns)]
            self.known.update(([b for b, _ in places], [m for _, m in places]))
            self.open.put(rows) if rows else self.open.clear()
        self._hold(held)
        if held:
            self.handle.registerTimer(min(held) + self.step)
        self.closed.update((done[-1], emitted))

    def _filled(self, key, bucket: int, rows: list, known: dict, emitted: int):
        """Emit every bucket that is decided, in order; returns the last one emitted. ``rows`` keeps the others,
        ``known`` the last reading of every column before them."""
        # A column is decided up to its last reading, or wholly if it never had one. Older gaps are given up.
        given_up = bucket - self.patience * self.step
        readings = {i: ([known[i]] if i in known else []) + [(b, m[i]) for b, m in rows if m[i] is not None] for i in range(self.columns)}
        decided = min((points[-1][0] for points in readings.values() if points), default=bucket)
        until = min(bucket, max(given_up, decided))
        at = [0] * self.columns
        for place in range(emitted + self.step, until + 1, self.step):
            values = []
            for i in range(self.columns):
                points = readings[i]
                while at[i] + 1 < len(points) and points[at[i] + 1][0] <= place:
                    at[i] += 1
                values.append(_on_line(points, at[i], place))
            yield self.row(*key, place, place, *values)
        for i, points in readings.items():
            # The last reading behind ``until`` starts the next line; later ones are still in the open rows.
            past = [point for point in points if point[0] <= until]
            if past:
                known[i] = past[-1]
        rows[:] = [row for row in rows if row[0] > until]
        return max(emitted, until)

    def close(self) -> None:
        pass


def _on_line(points: list[tuple[int, float]], at: int, place: int) -> float | None:
    """The value at ``place`` on the line from reading ``at`` to the next; none before the first reading or
    behind the last."""
    if not points or points[at][0] > place:
        return None
    start, low = points[at]
    if start == place:
        return low
    if at + 1 == len(points):
        return None
    end, high = points[at + 1]
    return low + (high - low) * ((place - start) / (end - start))


def resampled_grid(
    stream: DataFrame,
    time: str,
    columns: Iterable[str],
    by: Iterable[str],
    minutes: float = 5,
    method: str = "mean",
    lateness: str = "10 minutes",
    patience: int = 288,
) -> DataFrame:
    """Means per bucket and group with empty buckets between the first and the last closed one, NULL with
    ``mean``, on the line to the next reading with ``interpolate``.

    Equals the batch resampling up to the watermark, for rows at most ``lateness`` behind the newest; state
    holds the open buckets' sums only. Interpolated buckets wait for the next reading of every column, at most
    ``patience`` buckets: a longer gap is NULL here. Buckets divide a day. NaN counts as missing."""
    _ready(stream)
    step = round(minutes * 60_000)
    if method not in ("mean", "interpolate") or _DAY % step:
        raise ValueError("mean or interpolate, over buckets that divide a day")
    by, columns = list(by), list(columns)
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    bucket = F.floor(F.unix_millis(time) / F.lit(step)).cast("long") * F.lit(step)
    rows = stream.withWatermark(time, lateness).filter(F.col(time).isNotNull())
    values = (F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns))
    rows = rows.select(*by, time, bucket.alias("_bucket"), *values)
    output = ", ".join(
        [*(f"`{name}` {kinds[name]}" for name in by), "_from long, _bucket long", *(f"`{c}` double" for c in columns)]
    )
    processor = _Grid(step, by, columns, patience if method == "interpolate" else None)
    found = rows.groupBy(*by).transformWithState(processor, output, "Append", "EventTime")
    places = F.explode(F.sequence("_from", "_bucket", F.lit(step).cast("long"))).alias("_place")
    own = F.col("_place") == F.col("_bucket")
    values = (F.when(own, F.col(c)).alias(c) for c in columns)
    return found.select("*", places).select(*by, F.timestamp_millis("_place").alias(time), *values)
