"""Streams against batches: late rows, restarts, expiry of state."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairn.sources.fixtures import LAGS, SIGNALS
from cairn.streaming import lookback, windows

DDL = "event_id long, ts timestamp, user_id long, event_type string, value double"


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour, minutes=minute)


def add_file(spark, folder, name, rows, age):
    """One Parquet file of rows; files are taken in the order of their times."""
    spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(f"{folder}-parts/{name}")
    part = next(p for p in os.listdir(f"{folder}-parts/{name}") if p.endswith(".parquet"))
    os.makedirs(folder, exist_ok=True)
    os.rename(f"{folder}-parts/{name}/{part}", f"{folder}/{name}.parquet")
    os.utime(f"{folder}/{name}.parquet", (1_700_000_000 + age, 1_700_000_000 + age))


def stream(spark, folder):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(folder)


def finished(query):
    query.awaitTermination()
    assert query.exception() is None


def test_late_rows_are_dropped_when_the_watermark_says_so(spark, tmp_path):
    folder = str(tmp_path / "in")
    add_file(spark, folder, "a", [(1, at(0, 1), 1, "click", 1.0), (2, at(0, 5), 1, "click", 2.0)], 0)  # the watermark becomes 4:00
    add_file(spark, folder, "aa", [(10, at(0, 5, 1), 3, "error", 1.0)], 1)  # in this batch windows are closed by it, from the next on rows are late by it
    add_file(spark, folder, "b", [(3, at(0, 3, 59), 1, "click", 4.0), (4, at(0, 4, 30), 1, "click", 8.0), (5, at(0, 0, 10), 2, "view", 16.0)], 2)  # 3 and 5 fall into windows that have ended
    add_file(spark, folder, "c", [(6, at(0, 4, 1), 1, "click", 32.0), (7, at(0, 9), 1, "click", 64.0)], 3)  # 6 is older than the latest time, but its window is open
    out = windows.windowed(stream(spark, folder), "2 hours", ["event_type"], [F.count("*").alias("n"), F.sum("value").alias("total")])
    finished(windows.append(out, f"{tmp_path}/out", f"{tmp_path}/check", available_now=True))
    got = Counter((r.window_start, r.window_end, r.event_type, r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    # 8:00 to 10:00 stays open
    assert got == Counter([(at(0, 0), at(0, 2), "click", 1, 1.0), (at(0, 4), at(0, 6), "click", 3, 42.0), (at(0, 4), at(0, 6), "error", 1, 1.0)])


def test_sessions_and_a_restart(spark, tmp_path):
    folder = str(tmp_path / "in")
    add_file(spark, folder, "a", [(1, at(0, 1), 1, "click", 1.0), (2, at(0, 2), 1, "click", 1.0), (3, at(0, 1), 2, "click", 1.0)], 0)

    def run():
        out = windows.sessions(stream(spark, folder), "90 minutes", ["user_id"], [F.count("*").alias("n")])
        finished(windows.append(out, f"{tmp_path}/out", f"{tmp_path}/check", available_now=True))
        return Counter((r.user_id, r.window_start, r.window_end, r.n) for r in spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect())

    assert run() == Counter()  # the watermark, 1:00, has passed no session's end
    add_file(spark, folder, "b", [(4, at(0, 3), 1, "view", 1.0), (5, at(0, 12), 3, "view", 1.0)], 1)
    closed = Counter([(1, at(0, 1), at(0, 4, 30), 3), (2, at(0, 1), at(0, 2, 30), 1)])
    assert run() == closed
    assert run() == closed  # nothing twice


def plain_look_back(rows, until):
    out = Counter()
    for i, t, u, e, v in rows:
        if e in ("purchase", "signup") and t is not None and t.date() < until:
            lags = [sum(1 for _, s, w, k, _ in rows if w == u and s is not None and k == kind and (t.date() - s.date()).days == lag) for kind in SIGNALS.values() for lag in range(LAGS)]
            out[(i, u, v, *lags)] += 1
    return out


@pytest.fixture(scope="module")
def history():
    days = [(0, "click"), (0, "purchase"), (0, "click"), (1, "view"), (3, "signup"), (6, "error"), (6, "purchase"), (7, "purchase"), (12, "click"), (13, "click"), (13, "signup"), (25, "purchase")]
    rows = [(100 * u + i, at(d, 1 + i, u), u, e, float(i)) for u in (1, 2) for i, (d, e) in enumerate(days) if u == 1 or i % 2]
    return sorted([*rows, (900, at(2, 5), None, "purchase", None), (901, at(2, 6), None, "click", 1.0), (902, None, 1, "purchase", 1.0), (903, at(29), 3, "view", 1.0)], key=lambda r: r[1] or at(0))


def test_look_back_with_a_restart(spark, tmp_path, history):
    folder = str(tmp_path / "in")
    cut = len(history) // 2
    names = ["event_id", "user_id", "value", *lookback.lag_names()]

    def run():
        out = lookback.look_back(stream(spark, folder))
        finished(windows.append(out, f"{tmp_path}/out", f"{tmp_path}/check", available_now=True))
        return Counter(tuple(r[n] for n in names) for r in spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect())

    add_file(spark, folder, "a", history[:cut], 0)
    first = run()
    assert first == plain_look_back(history[:cut], (max(r[1] for r in history[:cut] if r[1]) - dt.timedelta(hours=1)).date())
    for i, r in enumerate(history[cut:]):
        add_file(spark, folder, f"b{i:03}", [r], i + 1)
    assert run() == plain_look_back(history, at(28).date())
    assert run() == plain_look_back(history, at(28).date())


def test_state_expires(spark, tmp_path, history):
    """After the last day has been closed for LAGS days, no user but the one who moved the watermark has state."""
    folder = str(tmp_path / "in")
    add_file(spark, folder, "a", history, 0)
    add_file(spark, folder, "b", [(999, at(60), 3, "view", 1.0)], 1)
    out = lookback.look_back(stream(spark, folder))
    finished(windows.append(out, f"{tmp_path}/out", f"{tmp_path}/check", available_now=True))
    left = spark.read.format("statestore").option("path", f"{tmp_path}/check").option("stateVarName", "days").load()
    assert left.count() <= 1
    waiting = spark.read.format("statestore").option("path", f"{tmp_path}/check").option("stateVarName", "waiting").load()
    assert waiting.count() == 0


def test_a_user_keeps_one_timer(spark):
    """However many days a batch brings of a user, one timer is set, for the first day to settle."""
    import pandas as pd
    from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

    class State:
        def __init__(self):
            self.kept = {}

        def iterator(self):
            return iter(self.kept.items())

        def updateValue(self, k, v):
            self.kept[k] = v

        def appendList(self, rows):
            self.rows = rows

    class Handle:
        timers = []

        def getMapState(self, *a):
            return State()

        getListState = getMapState

        def registerTimer(self, ms):
            self.timers.append(ms)

    own = lookback.LookBack(StructType([StructField("event_id", LongType()), StructField("event_type", StringType()), StructField("day", IntegerType())]))
    own.init(Handle())
    rows = pd.DataFrame([(i, k, 19000 + i // 3) for i, k in enumerate(["click", "purchase", "view"] * 30)], columns=["event_id", "event_type", "day"])
    list(own.handleInputRows((1,), iter([rows[:40], rows[40:]]), None))
    assert Handle.timers == [19001 * lookback.DAY_MS]
    assert own.days.kept[(19013,)] == (1, 1, 0) and len(own.days.kept) == len(own.waiting.rows) == 30
    list(own.handleInputRows((1,), iter([rows[rows.event_type == "click"]]), None))
    assert Handle.timers[1:] == [(19029 + LAGS) * lookback.DAY_MS] and own.days.kept[(19013,)] == (2, 1, 0)
