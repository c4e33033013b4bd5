"""Look-back sums of a stream, with state by user: each conversion gets the counts of the
user's signals on its day and on the days before, as fixtures.conversions gives a batch.

A day counts whole, so its conversions wait in the state until the watermark passes its
end; then a timer puts them out, and days that no later conversion reaches are dropped.
A user has one timer to go by, that of the earliest day with conversions or else of the last day's
expiry: it settles all that the watermark has passed, and sets the next. A user's state is at most one row for each of LAGS days and the conversions of open days;
a user who goes silent leaves none. Rows older than the watermark are late and dropped, null
users are a user of their own, rows with a null time are left out, and days are those of UTC.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from cairn.sources.fixtures import CONVERSIONS, LAGS, SIGNALS

DAY_MS = 86_400_000
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LookBack(StatefulProcessor):
    def __init__(self, columns: StructType) -> None:
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day int", ", ".join(f"{p} int" for p in SIGNALS))
        self.waiting = handle.getListState("waiting", self.columns)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        added: dict[int, list[int]] = {}
        kept, last = [], None
        for some in rows:
            day, kind = some["day"].to_numpy(), some["event_type"]
            last = max(int(day.max()), last if last is not None else int(day.max()))
            for p, e in enumerate(SIGNALS.values()):
                for d, n in zip(*np.unique(day[(kind == e).to_numpy()], return_counts=True), strict=True):
                    added.setdefault(int(d), [0] * len(SIGNALS))[p] += int(n)
            own = some.loc[kind.isin(CONVERSIONS), self.columns.names]
            kept += [tuple(None if pd.isna(v) else v for v in r) for r in own.astype(object).itertuples(index=False)]
        old = {k[0]: v for k, v in self.days.iterator()} if added else {}
        for d, n in added.items():
            self.days.updateValue((d,), tuple(a + b for a, b in zip(old.get(d, (0,) * len(n)), n, strict=True)))
        if kept:
            self.waiting.appendList(kept)
            self.handle.registerTimer((min(r[self.columns.names.index("day")] for r in kept) + 1) * DAY_MS)
        elif last is not None:
            self.handle.registerTimer((last + LAGS) * DAY_MS)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        open_day = timerValues.getCurrentWatermarkInMs() // DAY_MS  # days before it are whole
        counts = {k[0]: v for k, v in self.days.iterator()}
        day, rows = self.columns.names.index("day"), list(self.waiting.get()) if self.waiting.exists() else []
        due = [r for r in rows if r[day] < open_day]
        if due:
            left = [tuple(r) for r in rows if r[day] >= open_day]
            self.waiting.clear()
            if left:
                self.waiting.put(left)
        gone = [d for d in counts if d <= open_day - LAGS]
        if len(gone) == len(counts):
            self.days.clear()
        else:
            for d in gone:
                self.days.removeKey((d,))
        still = [r[day] for r in rows if r[day] >= open_day]
        if still:
            self.handle.registerTimer((min(still) + 1) * DAY_MS)
        elif len(gone) < len(counts):
            self.handle.registerTimer((max(counts) + LAGS) * DAY_MS)
        none = (0,) * len(SIGNALS)
        lags = [[counts.get(r[day] - i, none)[p] for p in range(len(SIGNALS)) for i in range(LAGS)] for r in due]
        out = pd.DataFrame([tuple(r) + tuple(x) for r, x in zip(due, lags, strict=True)], columns=[*self.columns.names, *lag_names()])
        yield out if len(out) else pd.DataFrame()

    def close(self) -> None:
        pass


def lag_names() -> list[str]:
    return [f"{p}D{i}" for p in SIGNALS for i in range(LAGS)]


def look_back(events: DataFrame, delay: str = "1 hour", user: str = "user_id", time: str = "ts") -> DataFrame:
    """A stream of events to a stream of its purchases and signups, with their columns, day (days
    since 1970) and a count for each signal and lag. Needs the RocksDB state store."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = events.withColumn(time, F.col(time).cast("timestamp")).filter(F.col(time).isNotNull()).withColumn("day", F.floor(F.unix_millis(time) / DAY_MS).cast("int")).withWatermark(time, delay)
    columns = StructType([StructField(f.name, f.dataType) for f in rows.schema])
    schema = StructType([*columns, *[StructField(n, IntegerType()) for n in lag_names()]])
    return rows.groupBy(user).transformWithStateInPandas(LookBack(columns), outputStructType=schema, outputMode="Append", timeMode="EventTime")
