"""Counters of all levels and under-performing members of a stream, from keyed state with timers.

Events are counted by minute first, by a native aggregate that combines before it shuffles;
only those sums reach the keyed state, so a hot counter or member costs one row a minute.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from collections import Counter
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from crashlake.operators.status import counter_names

# processors travel with their code: the Python processes beside a query need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE_MS = 60_000
EPOCH = dt.datetime(1970, 1, 1)
#: How the periods of the five levels are written.
SHOWN = ("%Y-%m-%dT%H:%M", "%Y-%m-%dT%H", "%Y-%m-%d", "%Y-%m", "%Y")


def stream_settings(spark: SparkSession) -> SparkSession:
    """State on disk instead of in the executors' heap; timers need it.

    The caches of all stores of an executor share one bound, a batch writes its changes only, and a
    join keeps its state in one store a partition instead of four.
    """
    store = "spark.sql.streaming.stateStore"
    spark.conf.set(f"{store}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set(f"{store}.rocksdb.boundedMemoryUsage", "true")
    spark.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    return spark


def _number(time: dt.datetime) -> int:
    return int((time - EPOCH).total_seconds() // 60)


def _counted(windows: DataFrame) -> DataFrame:
    """Window counts with the number of their minute since 1970; the state sees no time zones."""
    end = F.window_time("w")
    return windows.withColumns({"at": end, "minute": F.floor(F.unix_seconds(end) / 60).cast("bigint")}).drop("w")


def _minutes_until(timers) -> int:
    """The minute that the watermark has reached: all before it are complete."""
    return max(int(timers.getCurrentWatermarkInMs()) // MINUTE_MS, 0)


class _Stored(StatefulProcessor):
    """One JSON document of state a key, and one timer a key, at the next minute to look at."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.document = handle.getValueState("document", "json string")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        state = json.loads(self.document.get()[0]) if self.document.exists() else self.fresh()
        for row in rows:
            self.add(state, row)
        yield from self._turn(key, state, timers)

    def handleExpiredTimer(self, key, timers, expired) -> Iterator[Row]:
        yield from self._turn(key, json.loads(self.document.get()[0]), timers)

    def _turn(self, key, state: dict, timers) -> Iterator[Row]:
        until = _minutes_until(timers)
        yield from self.finish(key, state, until)
        self.document.update((json.dumps(state),))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        due = self.due(state, until)
        if due is not None:
            self.handle.registerTimer(due * MINUTE_MS)


class _Periods(_Stored):
    """Sums of a counter in the minutes, hours, days, months and years that are not over."""

    def fresh(self) -> dict:
        return {}

    @staticmethod
    def _open(minute: int) -> list[tuple[str, int]]:
        """Text and end of every period that a minute is in."""
        time = EPOCH + dt.timedelta(minutes=minute)
        ends = (time + dt.timedelta(minutes=1), time.replace(minute=0) + dt.timedelta(hours=1),
                dt.datetime(time.year, time.month, time.day) + dt.timedelta(days=1),
                dt.datetime(time.year + time.month // 12, time.month % 12 + 1, 1), dt.datetime(time.year + 1, 1, 1))
        return [(time.strftime(f), _number(end)) for f, end in zip(SHOWN, ends)]

    def add(self, state: dict, row: Row) -> None:
        for period, end in self._open(row["minute"]):
            n, _ = state.get(period, (0, end))
            state[period] = (n + row["n"], end)

    def finish(self, key, state: dict, until: int) -> Iterator[Row]:
        for period in [p for p, (_, end) in state.items() if end <= until]:
            yield Row(period=period, counter=key[0], count=state.pop(period)[0])

    def due(self, state: dict, until: int) -> int | None:
        return min((end for _, end in state.values()), default=None)


def rolled_counters(crashes: DataFrame, ts: str = "submitted_timestamp", late: str = "2 hours", **columns) -> DataFrame:
    """Submission counters per minute, hour, day, month and year: each once, when it is over.

    Minutes are windows; a counter's state holds the sums of its five open periods, and its
    timers fire at their ends, with or without further crashes.
    """
    stream_settings(crashes.sparkSession)
    minutes = (crashes.withWatermark(ts, late)
               .select(ts, F.explode(counter_names(**columns)).alias("counter"))
               .groupBy(F.window(ts, "1 minute").alias("w"), "counter").agg(F.count(F.lit(1)).alias("n")))
    return _counted(minutes).groupBy("counter").transformWithState(_Periods(), "period string, counter string, count long", "append", "eventTime")


class _Pool(_Stored):
    """Members ever seen, and what each did in the last minutes."""

    def __init__(self, minutes: int):
        self.minutes = minutes

    def fresh(self) -> dict:
        return {"next": None, "members": {}, "counts": {}}

    def add(self, state: dict, row: Row) -> None:
        minute = row["minute"]
        first = state["members"].get(row["member"], minute)
        state["members"][row["member"]] = min(first, minute)
        state["counts"].setdefault(str(minute), {})[row["member"]] = row["n"]
        state["next"] = minute + 1 if state["next"] is None else min(state["next"], minute + 1)

    def due(self, state: dict, until: int) -> int | None:
        return state["next"] if state["counts"] else None

    def finish(self, key, state: dict, until: int) -> Iterator[Row]:
        """Members below the mean less one deviation at the end of every minute up to ``until``.

        Compared in whole numbers: with n members, sum s and sum of squares q, c lies below
        where s - n c > 0 and its square is above n q - s s.
        """
        counts = {int(m): c for m, c in state["counts"].items()}
        if not counts:
            return
        end, last = state["next"], max(counts)
        names = sorted(state["members"], key=lambda m: (state["members"][m], m))
        joined, totals = 0, Counter()
        for minute in range(end - self.minutes, end - 1):  # what the tick before has left
            totals.update(counts.get(minute, {}))
        while end <= min(until, last + self.minutes):
            totals.update(counts.get(end - 1, {}))
            while joined < len(names) and state["members"][names[joined]] < end:
                joined += 1
            s, q = sum(totals.values()), sum(n * n for n in totals.values())
            for member in names[:joined]:
                gap = s - joined * totals[member]
                if gap > 0 and gap * gap > joined * q - s * s:
                    yield Row(pool=key[0], end=end, member=member, count=totals[member])
            totals.subtract(counts.get(end - self.minutes, {}))
            end += 1
        state["next"] = end
        state["counts"] = {str(m): c for m, c in counts.items() if m >= end - self.minutes}


def lagging_members(events: DataFrame, minutes: int, member: str, ts: str = "ts", pool: str | None = None,
                    late: str = "10 minutes") -> DataFrame:
    """For every minute, the members that did less in the last ``minutes`` than the mean of
    their pool less one standard deviation; silent members count as 0.

    A member belongs to its pool from its first event on and stays. The state of a pool holds
    its members and their counts of the minutes in the window; timers look at every minute that
    the watermark has passed, with or without events.
    """
    stream_settings(events.sparkSession)
    counts = (events.withWatermark(ts, late)
              .groupBy(F.window(ts, "1 minute").alias("w"), (F.col(pool) if pool else F.lit("")).alias("pool"),
                       F.coalesce(F.col(member).cast("string"), F.lit("")).alias("member"))
              .agg(F.count(F.lit(1)).alias("n")))
    found = _counted(counts).groupBy("pool").transformWithState(
        _Pool(int(minutes)), "pool string, end long, member string, count long", "append", "eventTime")
    return found.select("pool", F.timestamp_seconds(F.col("end") * 60).alias("window_end"), "member", "count")
