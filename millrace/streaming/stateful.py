"""Stateful processors of the live monitors: typed state and event-time timers, one key at a time.

A processor sees a key's rows in event-time order whatever order they arrive in: rows wait in list
state until the watermark has passed them, so a key holds the rows of one watermark delay and what
its monitor carries on.  Rows later than the watermark are dropped by Spark before they come here.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that are handed on in one data frame.
ROWS_OUT = 10_000


class InOrder(StatefulProcessor):
    """Releases a key's rows by (time, order) once the watermark reaches their time.

    Input columns: those set ``apart`` (key and time stamp), ``at_ms`` (epoch milliseconds) and the
    columns of ``waiting``, by the first of which rows of one time are ordered.  Subclasses turn released rows into result rows
    in ``advance`` and hold their own typed state.
    """

    waiting: str
    columns: list[str]

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", f"at bigint, {self.waiting}")
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            # Without the key and the time stamp, as Python values; NaN stands for a null loss too.
            values = [frame[n].tolist() for n in frame.columns if n not in self.apart]
            self.rows.appendList(list(zip(*values)))
            first = int(frame["at_ms"].min()) if first is None else min(first, int(frame["at_ms"].min()))
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        due, rest = [], []
        for row in self.rows.get():
            (due if row[0] <= watermark else rest).append(tuple(row))
        if rest:
            self.rows.put(rest)
            self._wake(min(r[0] for r in rest))
        else:
            self.rows.clear()
        out = []
        for row in self.advance(sorted(due, key=lambda r: r[:2])):
            out.append((*key, *row))
            if len(out) == ROWS_OUT:
                yield pd.DataFrame(out, columns=self.columns)
                out = []
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def _wake(self, at: int) -> None:
        """One timer a key, at its earliest waiting row."""
        known = self.timer.get()[0] if self.timer.exists() else None
        if known is None or at < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def advance(self, rows: list[tuple]) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class Spacing(InOrder):
    """Keeps an alert at least ``gap`` microseconds after the last kept one of its key."""

    def __init__(self, key: str, alert: str, alert_type: str, ts: str, at_us: str, gap: int):
        self.apart, self.gap = [key, ts], gap
        self.waiting = f"at_us bigint, alert {alert_type}"
        self.columns = [key, alert, at_us]

    def init(self, handle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "at bigint")

    def advance(self, rows: list[tuple]) -> Iterator[tuple]:
        last = self.last.get()[0] if self.last.exists() else None
        for _, at, alert in sorted(rows, key=lambda r: r[1:]):
            if last is None or at - last >= self.gap:
                last = at
                yield alert, at
        if last is not None:
            self.last.update((last,))


class Losses(InOrder):
    """Rolling mean of a window of losses, spike, plateau, patience and stop of a run."""

    def __init__(self, run: str, step: str, loss: str, ts: str, window: int, factor: float, plateau_steps: int, patience: int, min_delta: float):
        self.apart = [run, ts]
        self.window, self.factor, self.plateau_steps, self.patience, self.min_delta = window, factor, plateau_steps, patience, min_delta
        self.waiting = "step bigint, loss double"
        self.columns = [run, step, loss, "rolling_mean", "is_spike", "is_plateau", "counter", "should_stop"]

    def init(self, handle) -> None:
        super().init(handle)
        self.recent = handle.getListState("recent", "loss double")
        self.seen = handle.getValueState("seen", "best double, best_step bigint, low double, counter bigint, stopped boolean")

    def advance(self, rows: list[tuple]) -> Iterator[tuple]:
        best, best_step, low, counter, stopped = self.seen.get() if self.seen.exists() else (math.inf, 0, math.inf, 0, False)
        recent = [r[0] for r in self.recent.get()]
        for _, step, loss in rows:
            if stopped:
                break
            if loss is None or not math.isfinite(loss):
                stopped = True
                yield step, loss, None, False, False, counter, True
                break
            mean = math.fsum(recent) / len(recent) if recent else None
            spike = mean is not None and mean > 0 and loss > self.factor * mean
            recent = [*recent, loss][-self.window :]
            plateau = loss >= best and step - best_step >= self.plateau_steps
            if loss < best:
                best, best_step = loss, step
            low, counter = (loss, 0) if loss < low - self.min_delta else (low, counter + 1)
            yield step, loss, mean, spike, plateau, counter, counter >= self.patience
        if recent:
            self.recent.put([(v,) for v in recent])
        self.seen.update((best, best_step, low, counter, stopped))


class Streaks(StatefulProcessor):
    """Alarm state of a key from one row for each closed period that had data; timers close the others."""

    def __init__(self, key: str, comparison: str, threshold: float, consecutive: int, missing: str, period: int):
        self.comparison, self.threshold, self.consecutive, self.missing, self.period = comparison, threshold, consecutive, missing, period
        self.columns = [key, "period", "value", "breaching", "in_alarm"]

    def init(self, handle) -> None:
        self.handle = handle
        # The first period that is not closed yet, and how many before it breach in a row.
        self.open = handle.getValueState("open", "period bigint, streak bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = sorted((int(p), float(v)) for frame in rows for p, v in zip(frame["period"], frame["value"]))
        if found:
            yield self._close(key, dict(found), max(found[-1][0] + 1, self._upto(timerValues)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._close(key, {}, self._upto(timerValues))

    def _upto(self, timerValues) -> int:
        return timerValues.getCurrentWatermarkInMs() // 1000 // self.period

    def _close(self, key, values: dict[int, float], upto: int) -> pd.DataFrame:
        from operator import ge, gt, le, lt

        test = {"<=": le, "<": lt, ">": gt, ">=": ge}[self.comparison]
        at, streak = self.open.get() if self.open.exists() else (min(values), 0)
        rows = []
        while at < upto:
            value = values.get(at)
            breach = self.missing == "breaching" if value is None else bool(test(value, self.threshold))
            streak = streak + 1 if breach else 0
            rows.append((*key, at, value, breach, streak >= self.consecutive))
            at += 1
        self.open.update((at, streak))
        self.handle.registerTimer((at + 1) * self.period * 1000)
        return pd.DataFrame(rows, columns=self.columns)

    def close(self) -> None:
        pass


def by_key(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str | StructType) -> DataFrame:
    """Rows of a processor whose timers follow the watermark.  Its state needs the RocksDB state store."""
    return stream.groupBy(key).transformWithStateInPandas(processor, schema, "Append", "EventTime")
