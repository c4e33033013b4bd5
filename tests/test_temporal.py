"""As-of and interval joins, sessions, neighbours and trailing sums against plain loops, with one hot user, ties, nulls and clashing names."""

import datetime as dt
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from cairn.operators import temporal

DAY0 = dt.datetime(2024, 1, 1)
DDL = "id long, user string, ts timestamp, v double, _t int, _row string, _s int"


def rows_of(seed, n=600):
    """Half of all rows are one user's; times on a grid of 20 minutes over 9 days, so that many are equal, some at midnight."""
    rng = np.random.default_rng(seed)
    users = np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b", "c", "d"], n))
    out = [(i, str(u), DAY0 + dt.timedelta(minutes=20 * int(m)), round(float(x), 2), 1, "r", 2) for i, (u, m, x) in enumerate(zip(users, rng.integers(0, 9 * 72, n), rng.normal(0, 5, n), strict=True))]
    extra = [(n, None, DAY0, 1.0, 1, "r", 2), (n + 1, "a", None, 1.0, 1, "r", 2), (n + 2, "b", DAY0 + dt.timedelta(microseconds=1), None, 1, "r", 2), (n + 3, "late", DAY0 + dt.timedelta(days=400), 3.0, 1, "r", 2)]
    return out + extra


@pytest.fixture(scope="module")
def tables(spark):
    a, b = rows_of(1), rows_of(2, 300)
    return a, b, spark.createDataFrame(a, DDL), spark.createDataFrame(b, DDL)


def whole(rows):
    return [r for r in rows if r[1] is not None and r[2] is not None]


def by_user(rows):
    out = defaultdict(list)
    for r in whole(rows):
        out[r[1]].append(r)
    return {u: sorted(rs, key=lambda r: (r[2], r[0])) for u, rs in out.items()}


@pytest.mark.parametrize("strict,within,width", [(True, None, temporal.DAY), (False, None, 3600), (True, 7200, temporal.DAY), (False, 0, 10 * temporal.DAY)])
def test_asof(tables, strict, within, width):
    a, b, left, right = tables
    right_of, want = by_user(b), {}
    for i, u, t, *_ in a:
        found = [r for r in right_of.get(u, []) if t is not None and (r[2] < t or not strict and r[2] == t)]
        best = found[-1] if found else None
        if best and within is not None and (t - best[2]).total_seconds() > within:
            best = None
        want[i] = (best[0], best[3], (t - best[2]).total_seconds()) if best else (None, None, None)
    out = temporal.asof_join(left, right, ["user"], "ts", "ts", ["id", "v"], strict=strict, tie=["id"], within=within, slice_seconds=width)
    assert out.columns == [*left.columns, "last_id", "last_v", "last_time", "last_age"]
    got = out.collect()
    assert len(got) == len(a)
    for r in got:
        assert (r.last_id, r.last_v) == want[r.id][:2] and (r.last_age is None) == (want[r.id][2] is None)
        assert r.last_age is None or r.last_age == pytest.approx(want[r.id][2]) and r.last_time == r.ts - dt.timedelta(seconds=r.last_age)


@pytest.mark.parametrize("hours,fineness", [(1, 1), (5, 3), (30, 1), (0, 1)])
def test_interval(tables, hours, fineness):
    a, b, left, right = tables
    want = Counter((x[0], y[0]) for x in whole(a) for y in whole(b) if x[1] == y[1] and dt.timedelta() <= x[2] - y[2] <= dt.timedelta(hours=hours))
    out = temporal.interval_join(left, right, ["user"], "ts", "ts", hours * 3600, fineness)
    assert Counter((r.id, r.right_id) for r in out.collect()) == want and out.columns == [*left.columns, *(f"right_{c}" for c in right.columns)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("gap,width", [(20 * 60, temporal.DAY), (4 * 3600, temporal.DAY), (40 * 3600, 3600)])
def test_sessions(tables, gap, width):
    a, _, left, _ = tables
    want = {r[0]: None for r in a}
    for rows in by_user(a).values():
        start = last = None
        for r in rows:
            if last is None or (r[2] - last).total_seconds() > gap:
                start = r[2]
            want[r[0]], last = start, r[2]
    got = temporal.sessionize(left, ["user"], "ts", gap, slice_seconds=width).collect()
    assert {r.id: r.session_start for r in got} == want and len(got) == len(a)


@pytest.mark.parametrize("width", [temporal.DAY, 1800])
def test_neighbours(tables, width):
    a, _, left, _ = tables
    want = {r[0]: (None, None) for r in a}
    for rows in by_user(a).values():
        for i, r in enumerate(rows):
            want[r[0]] = (rows[i - 1][0] if i else None, rows[i + 1][0] if i + 1 < len(rows) else None)
    got = temporal.neighbours(left, ["user"], "ts", ["id"], ["id"], slice_seconds=width).collect()
    assert {r.id: (r.previous_id, r.next_id) for r in got} == want


@pytest.mark.parametrize("hours,width", [(1, temporal.DAY), (36, temporal.DAY), (36, 3600), (0, 3600)])
def test_trailing(tables, hours, width):
    a, _, left, _ = tables
    got = {r.id: r for r in temporal.trailing(left, ["user"], "ts", "v", hours * 3600, slice_seconds=width).collect()}
    assert len(got) == len(a)
    for i, u, t, *_ in a:
        if u is None or t is None:
            assert got[i].trailing_n is None and got[i].trailing_sum is None
            continue
        held = [r[3] for r in whole(a) if r[1] == u and r[3] is not None and dt.timedelta() <= t - r[2] <= dt.timedelta(hours=hours)]
        assert got[i].trailing_n == len(held)
        if held:
            assert got[i].trailing_sum == pytest.approx(math.fsum(held), abs=1e-9) and got[i].trailing_mean == pytest.approx(math.fsum(held) / len(held), abs=1e-9)
        else:
            assert got[i].trailing_sum is None and got[i].trailing_mean is None


def test_empty(tables):
    *_, left, right = tables
    none = left.limit(0)
    assert temporal.asof_join(none, right, ["user"], "ts", "ts", ["v"]).count() == 0 == temporal.interval_join(none, right, ["user"], "ts", "ts", 60).count()
    assert temporal.sessionize(none, ["user"], "ts", 60).count() == 0 == temporal.trailing(none, ["user"], "ts", "v", 60).count() == temporal.neighbours(none, ["user"], "ts", ["v"], ["id"]).count()
    assert {r.last_v for r in temporal.asof_join(left, right.limit(0), ["user"], "ts", "ts", ["v"]).collect()} == {None}


def test_a_hot_user_is_spread_over_slices(tables):
    """No window has a user's whole history as its partition but the one over slices."""
    *_, left, right = tables
    plan = temporal.asof_join(left, right, ["user"], "ts", "ts", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in plan.splitlines() if "Window [" in line and "_right" in line]
    assert all("_s#" in line.split("], [")[1] for line in over)
