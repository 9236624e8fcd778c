"""Detection rules on a stream, exact, with state that ends.

Per key the state is when each value was last seen (or how many events a time had) within the look-back, and when the key last alerted.
Events of a batch are taken in order of time; a match counts what the look-back, both ends included, holds at that time, as the batch rules do.
Entries that the look-back has left are removed as time goes on, and a timer on the watermark clears a key that falls silent.
Events must arrive in order from batch to batch, up to the watermark's delay (``settled`` sees to that); within a batch any order will do.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.rules import US, Rule

ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class LookBack:
    """What one key showed during the last ``span`` microseconds: distinct values by last sighting, or events by time."""

    def __init__(self, span: int, distinct: bool, entries: list[tuple[str, int, int]]):
        self.span, self.distinct = span, distinct
        self.held: OrderedDict[str, tuple[int, int]] = OrderedDict((v, (us, n)) for v, us, n in sorted(entries, key=lambda e: e[1]))
        self.total = sum(n for _, n in self.held.values())

    def add(self, value: str, us: int) -> None:
        _, n = self.held.pop(value, (us, 0))
        self.held[value] = (us, 1 if self.distinct else n + 1)  # the latest stands last
        self.total += 1 if not self.distinct or n == 0 else 0

    def count(self, us: int) -> int:
        while self.held:
            value, (last, n) = next(iter(self.held.items()))
            if last >= us - self.span:
                break
            del self.held[value]
            self.total -= n
        return self.total


class RuleState(StatefulProcessor):
    def __init__(self, rule: Rule):
        self.rule, self.span, self.wait = rule, rule.span_seconds * US, rule.realert_seconds * US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "value string", "us bigint, n bigint")
        self.alert = handle.getValueState("alert", "us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat([frame[["us", "value"]] for frame in rows]).sort_values("us", kind="stable")
        before = {k[0]: (int(v[0]), int(v[1])) for k, v in self.seen.iterator()}
        look = LookBack(self.span, self.rule.value is not None, [(v, us, n) for v, (us, n) in before.items()])
        known = self.alert.get()
        last = None if known is None else int(known[0])
        alerts = []
        for us, values in events.groupby("us", sort=False)["value"]:
            for value in values:
                if value is not None:
                    look.add(value, int(us))
            hits = look.count(int(us))
            met = hits > self.rule.threshold if self.rule.value else hits >= self.rule.threshold
            if met and (last is None or us - last >= self.wait):
                last = int(us)
                alerts.append((*key, last, hits))
        for value in before.keys() - look.held.keys():
            self.seen.removeKey((value,))
        for value, entry in look.held.items():
            if before.get(value) != entry:
                self.seen.updateValue((value,), entry)
        if last is not None:
            self.alert.update((last,))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        newest = int(events["us"].iloc[-1])
        self.handle.registerTimer(max(newest + self.span, 0 if last is None else last + self.wait) // 1000 + 1)
        yield pd.DataFrame(alerts, columns=[*self.rule.key, "us", "hits"]).astype({"us": "int64", "hits": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Nothing of the key can matter to any later event."""
        self.seen.clear()
        self.alert.clear()
        yield pd.DataFrame({**{n: pd.Series(dtype=object) for n in self.rule.key}, "us": pd.Series(dtype="int64"), "hits": pd.Series(dtype="int64")})


def rule_alerts(events: DataFrame, rule: Rule, delay_seconds: int | None = None) -> DataFrame:
    """The rule's alerts of a stream of events: its key, ``us`` and ``hits``, realert suppression included."""
    events.sparkSession.conf.set(*ROCKS)
    value = F.col(rule.value).cast("string") if rule.value else F.unix_micros("ts").cast("string")  # without a value, events count by their time
    rows = events.select(*rule.key, "ts", F.unix_micros("ts").alias("us"), value.alias("value"))
    rows = rows.withWatermark("ts", f"{rule.query_delay_seconds if delay_seconds is None else delay_seconds} seconds")
    keys = ", ".join(f"{n} {dict(rows.dtypes)[n]}" for n in rule.key)
    return rows.groupBy(*rule.key).transformWithStateInPandas(RuleState(rule), f"{keys}, us bigint, hits bigint", "append", "EventTime")
