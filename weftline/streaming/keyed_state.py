"""Keyed state with timers: decisions that depend on earlier ones, taken in event-time order whatever order rows come in.

Rows wait in their key's state until the watermark has passed them; a timer then takes them in order, so shuffled
micro-batches decide as one sorted pass would. Rows behind the watermark come back as late and decide nothing. What a key
remembers is small: limits are three counters, caches lose their entries as they end.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Requests a day and a clock hour, least gap, and the lifetimes of results and of a cooldown, in milliseconds.
PER_DAY, PER_HOUR, GAP, LIFETIME, COOLDOWN = 50, 20, 3_000, 300_000, 60_000
_DAY, _HOUR = 86_400_000, 3_600_000
_OUT = "key string, at long, id long, what string, outcome string"
#: The store that state with timers needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Step = Callable[[dict, int, str, bool], str]


def limited(per_day: int = PER_DAY, per_hour: int = PER_HOUR, gap: int = GAP) -> Step:
    """admitted or refused: at most so many a calendar day and clock hour (UTC), and gap after the last admitted one."""

    def step(state: dict, at: int, what: str, failed: bool) -> str:
        if state.get("day") != at // _DAY:
            state.update(day=at // _DAY, today=0, hour=at // _HOUR, this_hour=0, last=None)
        if state["hour"] != at // _HOUR:
            state.update(hour=at // _HOUR, this_hour=0)
        if state["today"] >= per_day or state["this_hour"] >= per_hour or state["last"] is not None and at - state["last"] < gap:
            return "refused"
        state.update(today=state["today"] + 1, this_hour=state["this_hour"] + 1, last=at)
        return "admitted"

    return step


def cached(lifetime: int = LIFETIME, cooldown: int = COOLDOWN) -> Step:
    """cooling, hit, computed or failed: a result serves for a lifetime after it was computed, on its own day only; a
    failure refuses everything of its key for a cooldown."""

    def step(state: dict, at: int, what: str, failed: bool) -> str:
        if state.get("until", 0) > at:
            return "cooling"
        entries = {k: v for k, v in state.get("entries", {}).items() if at - v < lifetime and v // _DAY == at // _DAY}
        state["entries"] = entries
        if what in entries:
            return "hit"
        if failed:
            state["until"] = at + cooldown
            return "failed"
        entries[what] = at
        return "computed"

    return step


class InOrder(StatefulProcessor):
    """Takes a key's rows in the order of (at, id) once the watermark has passed them."""

    def __init__(self, step: Step) -> None:
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "body string")
        self.waiting = handle.getListState("waiting", "at long, id long, what string, failed boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = [(int(at), int(i), w, bool(f)) for frame in rows for at, i, w, f in zip(frame["at"], frame["id"], frame["what"], frame["failed"], strict=True)]
        passed = timerValues.getCurrentWatermarkInMs()
        late, came = [r for r in came if r[0] <= passed], [r for r in came if r[0] > passed]
        if came:
            self.waiting.appendList(came)
            self.handle.registerTimer(min(r[0] for r in came))
        yield pd.DataFrame([(key[0], at, i, what, "late") for at, i, what, _ in late], columns=["key", "at", "id", "what", "outcome"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        rows = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready, rest = sorted(r for r in rows if r[0] <= passed), [r for r in rows if r[0] > passed]
        state = json.loads(self.memory.get()[0]) if self.memory.exists() else {}
        out = [(key[0], at, i, what, self.step(state, at, what, failed)) for at, i, what, failed in ready]
        self.memory.update((json.dumps(state),))
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(r[0] for r in rest))
        else:
            self.waiting.clear()
        yield pd.DataFrame(out, columns=["key", "at", "id", "what", "outcome"])

    def close(self) -> None:
        pass


def decisions(requests: DataFrame, step: Step, late: str) -> DataFrame:
    """A stream of (key, at, id, what, outcome) from one of requests (key string, ts timestamp, id, what, failed).

    The outcome is the step's, or late for a row that the watermark had passed when it came. late: how far behind the newest row a row may come. The session's state store has to be PROVIDER.
    """
    rows = requests.withWatermark("ts", late).withColumn("at", F.unix_millis("ts"))
    return rows.groupBy("key").transformWithStateInPandas(InOrder(step), _OUT, "Append", "eventTime")


def replayed(rows: list[tuple], step: Step) -> list[tuple]:
    """The same decisions on rows (key, at, id, what, failed) in one sorted pass; for batches of one key's bounded rows."""
    states: dict[str, dict] = {}
    return [(k, at, i, w, step(states.setdefault(k, {}), at, w, f)) for k, at, i, w, f in sorted(rows, key=lambda r: (r[1], r[2]))]


def decided(requests: DataFrame, step: Step) -> DataFrame:
    """(key, at, id, what, outcome) of a table of requests (key, at, id, what, failed): sorted by Spark, streamed by partition."""
    rows = requests.select("key", "at", "id", "what", "failed").repartition("key").sortWithinPartitions("key", "at", "id")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, {}
        for batch in batches:
            out = []
            for k, at, i, w, f in zip(batch["key"], batch["at"], batch["id"], batch["what"], batch["failed"], strict=True):
                if k != last:
                    last, state = k, {}
                out.append((k, at, i, w, step(state, int(at), w, bool(f))))
            yield pd.DataFrame(out, columns=["key", "at", "id", "what", "outcome"])

    return rows.mapInPandas(fold, _OUT)


def closed_windows(events: DataFrame, at: str, kind: str, value: str, width: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts and sums by event-time window and kind, for append mode: a window comes once, when the watermark has passed
    its end, and its state ends with it; rows behind the watermark are dropped."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    sums = timed.groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return sums.select(F.col("w.start").alias("start"), kind, "n", "total")
