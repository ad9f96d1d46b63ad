import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyweave.operators import align


def candidates(df):
    return [r.candidate.strftime("%H:%M") for r in df.collect()]


def test_three_exact_slots_newest_first(ts):
    rows = [(s, t) for t in ("12:00", "11:55", "11:50") for s in ("dwd", "shmu")]
    assert candidates(align.common_slots(ts(rows), 2)) == ["12:00", "11:55", "11:50"]


def test_limit(ts):
    rows = [("dwd", f"12:{m:02d}") for m in range(10)]
    assert len(candidates(align.common_slots(ts(rows), 1, max_count=3))) == 3


def test_quorum(ts):
    rows = [("dwd", "12:00"), ("shmu", "12:00"), ("dwd", "11:50")]
    assert candidates(align.common_slots(ts(rows), 3, min_sources=2)) == ["12:00"]


def test_tolerance_holds_both(ts):
    found = align.common_slots(ts([("dwd", "12:00"), ("shmu", "12:01")]), 2, 2).collect()
    assert found and set(found[0].scans) == {"dwd", "shmu"}


def test_too_far_apart(ts):
    assert candidates(align.common_slots(ts([("dwd", "12:00"), ("shmu", "10:00")]), 2, 2)) == []


def test_earlier_scan_wins_a_tie(ts):
    near = align.nearest_per_candidate(ts([("dwd", "12:02"), ("shmu", "12:01"), ("shmu", "12:03")]))
    row = near.where("source = 'shmu' and candidate = timestamp'2025-01-28 12:02:00'").first()
    assert row.ts.minute == 1 and row.gap_minutes == 1


@pytest.mark.parametrize("seed", range(3))
def test_nearest_against_brute_force(spark, ts, seed):
    rnd = random.Random(seed)
    rows = list({(rnd.choice(["a", "b", "c"]), f"{rnd.randrange(3):02d}:{rnd.randrange(60):02d}") for _ in range(120)})
    got = {
        (r.candidate.strftime("%H:%M"), r.source): r.ts.strftime("%H:%M")
        for r in align.nearest_per_candidate(ts(rows), 2).collect()
    }
    minutes = lambda t: int(t[:2]) * 60 + int(t[3:])
    for cand in {t for _, t in rows}:
        for source in "abc":
            near = [(abs(minutes(t) - minutes(cand)), t) for s, t in rows if s == source and abs(minutes(t) - minutes(cand)) <= 2]
            assert got.get((cand, source)) == (min(near)[1] if near else None)


def test_band_matches_against_brute_force(spark):
    rnd = random.Random(5)
    base = datetime(2025, 1, 1)
    scans = [(s, base + timedelta(seconds=rnd.randrange(4000))) for s in "ab" for _ in range(60)]
    df = spark.createDataFrame(scans, "source string, ts timestamp").distinct()
    cand = df.select(F.col("ts").alias("candidate")).distinct()
    got = {(r.candidate, r.source, r.ts) for r in align.band_matches(cand, df, 90).collect()}
    want = {(c, s, t) for _, c in scans for s, t in scans if abs((c - t).total_seconds()) <= 90}
    assert got == want


def test_latest_common_needs_every_source(ts):
    df = ts([("dwd", "12:00"), ("shmu", "12:00"), ("dwd", "12:10")])
    assert candidates(align.latest_common(df, ["dwd", "shmu"])) == ["12:00"]
    assert candidates(align.latest_common(df, ["dwd", "chmi"])) == []


@pytest.mark.parametrize(
    "rows, rung",
    [
        ([(s, "12:00") for s in ("dwd", "shmu", "chmi", "arso")], 1),
        ([(s, "12:00") for s in ("dwd", "shmu", "chmi", "omsz")] + [("arso", "12:30")], 2),
        ([(s, "12:00") for s in ("dwd", "shmu", "chmi")] + [("omsz", "11:00"), ("imgw", "10:00")], 3),
    ],
)
def test_ladder(ts, rows, rung):
    df = ts(rows)
    found = align.ladder_slots(df, df.select("source").distinct()).collect()
    assert {r.rung for r in found} == {rung}
    assert max(r.candidate for r in found).strftime("%H:%M") == "12:00"


def test_known_under_every_spelling(spark):
    cand = spark.createDataFrame([("dwd", "20250128_1205"), ("shmu", "20250128120500"), ("imgw", "202501281205"), ("chmi", "20250128121000")], "source string, ts_raw string")
    held = spark.createDataFrame([("dwd", "202501281205"), ("shmu", "202501281205"), ("imgw", "20250128120500"), ("chmi", "202501281205")], "source string, ts_raw string")
    assert [r.source for r in align.known(cand, held).collect()] == ["chmi"]


def test_fresh_before_stored_and_work_list(spark, ts):
    fresh, stored = ts([("dwd", "12:00")]), ts([("dwd", "12:00"), ("shmu", "12:00")])
    got = {r.source: r.origin for r in align.prefer_fresh(fresh, stored).collect()}
    assert got == {"dwd": "fresh", "shmu": "stored"}
    assert align.work_list(stored.select("ts").distinct(), ["a", "b"]).count() == 2


def test_a_hot_minute_stays_small(spark):
    """A third of all rows in one minute of one source: the aggregate gives one row for it."""
    hot = spark.range(30_000).select(F.lit("dwd").alias("source"), F.lit("2025-01-28 12:00:00").cast("timestamp").alias("ts"))
    rest = spark.range(60_000).select(
        F.concat(F.lit("s"), F.col("id") % 5).alias("source"), (F.lit("2025-01-20 00:00:00").cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 9000).cast("int"))).alias("ts")
    )
    near = align.nearest_per_candidate(hot.unionByName(rest))
    assert near.where("source = 'dwd'").count() == 5  # two minutes to either side
    first = near._jdf.queryExecution().executedPlan().toString()
    assert first.count("Exchange hashpartitioning") == 1 and "partial_min" in first


def test_asof_nearest_against_all_pairs(spark):
    import random
    from datetime import datetime, timedelta

    r = random.Random(3)
    at = lambda: datetime(2024, 1, 1) + timedelta(seconds=r.choice([r.randint(0, 20000), 3600 * r.randint(0, 5), 3600 * r.randint(0, 5) - 1]))
    scans = {(s, at()) for s in "abc" for _ in range(120)} | {("a", at()) for _ in range(900)}
    asked = {(s, at()) for s in "abcd" for _ in range(150)} | set(list(scans)[:40])
    want = {}
    for tolerance in (0, 7, 600, 9000):
        want = {(s, c): min((abs((t - c).total_seconds()), t) for u, t in scans if u == s) for s, c in asked if s != "d"}
        want = {k: v for k, v in want.items() if v[0] <= tolerance}
        got = align.asof_nearest(spark.createDataFrame(sorted(asked), "source string, candidate timestamp"), spark.createDataFrame(sorted(scans), "source string, ts timestamp"), tolerance)
        assert {(r.source, r.candidate): (r.gap_seconds, r.ts) for r in got.collect()} == want


def test_latest_common_makes_no_pairs(spark):
    """A crowded minute: rows in the plan stay a few times the scans."""
    scans = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 'dwd' ELSE 'shmu' END AS source", "timestamp_micros(1704067200000000 + id * 20000) AS ts")
    made = align.latest_common(scans, ["dwd", "shmu"], 2)
    assert made.first().candidate.second == 19
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    counts = spark.createDataFrame(made.collect(), made.schema)
    assert counts.count() == 1
    near = align.asof_nearest(scans.selectExpr("source", "ts AS candidate").distinct(), scans.distinct(), 120)
    assert near.count() == 4000
