import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyweave.operators import health
from skyweave.operators.sequence import failure_streaks, number_rows, steps

NOW = "2025-01-28 12:00:00"


def check(spark, rows, sources=("dwd", "shmu")):
    df = spark.createDataFrame(rows, "source string, timestamp string")
    found = health.outages(df, F.to_timestamp(F.lit(NOW)), list(sources)).collect()
    return {r.source: (r.available, r.reason) for r in found}


def test_outage_states(spark):
    got = check(
        spark,
        [("dwd", "20250128115500"), ("dwd", "20250128090000"), ("shmu", "202501281115"), ("chmi", "broken"), ("imgw", "20250128_1130"), ("omsz", "20250128112959")],
        ("dwd", "shmu", "chmi", "imgw", "omsz", "arso"),
    )
    assert got["dwd"] == (True, None)  # the newest counts
    assert got["shmu"] == (False, "stale data (age: 45 min, max: 30 min)")
    assert got["chmi"] == (False, "no valid timestamps")
    assert got["imgw"] == (True, None)  # exactly 30 minutes is not stale
    assert got["omsz"] == (False, "stale data (age: 31 min, max: 30 min)")
    assert got["arso"] == (False, "no data available")


@pytest.mark.parametrize(
    "availability, want",
    [
        ({"dwd": True, "shmu": True, "chmi": True, "omsz": True, "imgw": True, "arso": False}, (5, 5, True)),
        ({"dwd": True, "shmu": False, "chmi": True, "omsz": False, "imgw": True}, (3, 5, True)),
        ({"arso": True}, (0, 0, False)),
        ({"dwd": True, "shmu": True, "chmi": True}, (3, 3, True)),
    ],
)
def test_core_counts(spark, availability, want):
    df = spark.createDataFrame(list(availability.items()), "source string, available boolean")
    assert tuple(health.core_counts(df).first()) == want


def test_steps_cross_chunk_borders(spark):
    rnd = random.Random(1)
    base = datetime(2025, 1, 1)
    rows = [(k, base + timedelta(minutes=rnd.randrange(60 * 24 * 9))) for k in ("a", "b") for _ in range(150)]
    rows += [("a", base + timedelta(days=30))]  # empty chunks in between
    df = spark.createDataFrame(rows + rows[:20], "source string, ts timestamp")
    got = {(r.source, r.start, r.end) for r in steps(df, "source").collect()}
    want = set()
    for k in ("a", "b"):
        at = sorted({t for s, t in rows if s == k})
        want |= {(k, x, y) for x, y in zip(at, at[1:])}
    assert got == want


@pytest.mark.parametrize("chunk", [1, 600, 86_400])
def test_streaks_against_a_loop(spark, chunk):
    rnd = random.Random(chunk)
    base = datetime(2025, 1, 1)
    rows = [(rnd.choice([1, 1, 1, 2]), base + timedelta(seconds=rnd.randrange(7200)), i, rnd.random() < 0.35) for i in range(400)]
    df = spark.createDataFrame(rows, "key bigint, ts timestamp, event_id bigint, ok boolean")
    got = {r.event_id: r.streak for r in failure_streaks(df, "key", "ts", "event_id", "ok", chunk).collect()}
    run, want = {}, {}
    for key, t, i, ok in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        run[key] = 0 if ok else run.get(key, 0) + 1
        want[i] = run[key]
    assert got == want
    left = {r.key: r.failures for r in health.current_failures(df, "key", "ts", "event_id").collect()}
    assert left == run


def test_alerts_from_the_third_failure_on(spark):
    base = datetime(2025, 1, 1)
    log = [("dwd", False)] * 4 + [("dwd", True)] + [("dwd", False)] * 2 + [("shmu", False)] * 3
    rows = [(s, base + timedelta(seconds=i), i, ok) for i, (s, ok) in enumerate(log)]
    df = spark.createDataFrame(rows, "source string, ts timestamp, seq bigint, ok boolean")
    got = sorted((r.seq, r.streak, r.message) for r in health.streak_alerts(df, "source", "ts", "seq").collect())
    assert [g[:2] for g in got] == [(2, 3), (3, 4), (9, 3)]
    assert got[0][2] == "Source dwd has failed 3 consecutive times"


def test_numbering_runs_on_over_chunks(spark):
    base = datetime(2025, 1, 1)
    rows = [("k", base + timedelta(minutes=37 * (i // 2)), f"n{i:03d}") for i in range(100)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, name string")
    got = [r.name for r in number_rows(df, ["k"], "ts", ["name"]).orderBy("n").collect()]
    assert got == [r[2] for r in rows]


def test_profile_of_regular_and_single_scans(ts):
    rows = [("dwd", f"12:{m:02d}") for m in range(0, 60, 5)] + [("shmu", "12:00")]
    got = {r.source: r for r in health.availability_profile(ts(rows)).collect()}
    assert (got["dwd"]["count"], got["dwd"].expected, got["dwd"].avg_minutes) == (12, 11, 5.0)
    assert (got["shmu"].expected, got["shmu"].uptime_percent, got["shmu"].max_minutes) == (0, 0.0, 0.0)


def test_potential_without_all_sources(ts):
    row = health.composite_potential(ts([("dwd", "12:00"), ("shmu", "12:00")]), ["dwd", "shmu", "chmi"]).first()
    assert (row.common, row.possible, row.sources_with_data, row.potential_percent) == (0, 1, 2, 0.0)


def test_health_classes(spark):
    df = spark.createDataFrame([(100.0,), (95.5,), (92.0,), (85.0,), (79.9,)], "p double")
    p = F.col("p")
    assert [r[0] for r in df.select(health.uptime_status(p)).collect()] == ["perfect", "good", "good", "warning", "critical"]
    assert [r[0] for r in df.select(health.potential_status(p)).collect()] == ["excellent", "excellent", "good", "fair", "poor"]


def test_a_crowded_hour_is_cut_by_rows(spark):
    """Nine tenths of the rows in one key and one second: no chunk holds much more than it may, and nothing changes."""
    from skyweave.operators import sequence

    rows = spark.range(20_000).selectExpr(
        "IF(id % 10 <> 0, 0, id % 7) AS key", "timestamp_seconds(IF(id % 10 <> 0, 1704067200, 1704067200 + id)) AS ts", "id AS event_id", "id * 7919 % 13 < 2 AS ok"
    )
    chunked = sequence.range_chunks(rows, ["key", "ts", "event_id"], 2000)
    assert chunked.groupBy("key", "_chunk").count().agg({"count": "max"}).first()[0] <= 2000
    for work, name in ((lambda d: sequence.failure_streaks(d, "key", "ts", "event_id", "ok"), "streak"), (lambda d: sequence.number_rows(d, ["key"], "ts", ["event_id"]), "n")):
        got = {r.event_id: r[name] for r in work(chunked).select("event_id", name).collect()}
        assert got == {r.event_id: r[name] for r in work(rows).select("event_id", name).collect()} and len(got) == 20_000
    assert sequence.number_rows(sequence.range_chunks(rows.where("false"), ["key", "ts"]), ["key"], "ts", []).count() == 0
