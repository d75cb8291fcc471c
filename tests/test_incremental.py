import datetime as dt
import random
from pathlib import Path

import pytest

from contrail.config import Settings
from contrail.plans import incremental
from contrail.sources import tables

FIRST = dt.date(2025, 11, 20)
SCHEMA = "date_id date, country_code string, military_flight_count long"
SETTINGS = Settings(baseline_window_rows=12)


def counts(seed, days=220):
    rng = random.Random(seed)
    return {(FIRST + dt.timedelta(d), c): rng.randrange(3, 40) for d in range(days) for c in ("DE", "US") if rng.random() < 0.8}


def frame(spark, held):
    return spark.createDataFrame([(d, c, n) for (d, c), n in held.items()], SCHEMA)


def stored(spark, name):
    files = {}
    for path in spark.table(name).inputFiles():
        month = path.split("month_id=")[1].split("/")[0]
        files.setdefault(month, set()).add(Path(path).name)
    return sorted(map(str, spark.table(name).collect())), files


def test_refreshed_months_equal_a_full_refresh_and_others_stay(spark):
    tables.create_schema(spark, "incremental")
    names = [f"incremental.{n}" for n in ("daily", "rolling", "daily_full", "rolling_full")]
    before = counts(1)
    changed = [dt.date(2026, 2, 3), dt.date(2026, 2, 25), dt.date(2026, 4, 2)]
    after = {k: n for k, n in before.items() if not (k[0] == changed[1])}
    after |= {(changed[0], "DE"): 99, (changed[2], "NO"): 7}
    # a whole month goes
    gone = [d for d, _ in before if (d.year, d.month) == (2026, 6)]
    after = {k: n for k, n in after.items() if k[0] not in gone}
    days = sorted({*changed, *gone})
    incremental.build_marts(frame(spark, before), *names[:2], SETTINGS)
    files = [stored(spark, n)[1] for n in names[:2]]
    fresh = frame(spark, {k: n for k, n in after.items() if k[0].replace(day=1) in {d.replace(day=1) for d in days}})
    months = incremental.refresh_marts(spark, fresh, days, *names[:2], SETTINGS)
    incremental.build_marts(frame(spark, after), *names[2:], SETTINGS)
    for name, full, old in zip(names[:2], names[2:], files):
        rows, now = stored(spark, name)
        assert rows == stored(spark, full)[0]
        assert "2026-06-01" not in now
        untouched = set(now) - {str(m) for m in months}
        assert untouched and all(now[m] == old[m] for m in untouched)
    assert dt.date(2026, 1, 1) not in months and dt.date(2026, 3, 1) in months


def test_days_and_bounds_of_a_delivery(spark):
    seconds = [int(dt.datetime(2026, 1, 31, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp()) + s for s in (0, 1, -86400 * 31)]
    raw = spark.createDataFrame([(s,) for s in (*seconds, None)], "firstSeen long")
    days = incremental.touched_days(raw.where(f"firstSeen >= {seconds[0]}"))
    assert days == [dt.date(2026, 1, 31), dt.date(2026, 2, 1)]
    assert {r[0] for r in incremental.raw_of_months(raw, days[:1]).collect()} == {seconds[0]}
    assert incremental.raw_of_months(raw, []).isEmpty()


@pytest.mark.parametrize("days", [[], [FIRST + dt.timedelta(5)]])
def test_frames_that_reach_back(spark, days):
    held = {(FIRST + dt.timedelta(d), "DE"): 5 for d in range(0, 60, 2)}
    got = incremental.rolling_days(frame(spark, held), days, SETTINGS)
    expected = {d for i, (d, _) in enumerate(sorted(held)) for x in days
                if x <= d and (i < 11 or sorted(held)[i - 11][0] <= x)}
    assert got == sorted({*days, *expected})
