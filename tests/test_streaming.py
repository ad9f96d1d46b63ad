"""Streams in several micro-batches give what the batch forms give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyweave.operators.sequence import failure_streaks
from skyweave.streaming import slots as S
from skyweave.streaming import streaks

BASE = datetime(2025, 1, 1)


def write_parts(spark, folder, rows, schema, parts):
    """Rows as files that arrive one after the other."""
    import time

    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


SCANS = "source string, ts timestamp, event_id bigint"


@pytest.fixture
def scans(spark, tmp_path):
    rnd = random.Random(3)
    rows = sorted(((rnd.choice("abc"), BASE + timedelta(seconds=rnd.randrange(7200)), i) for i in range(240)), key=lambda r: r[1])
    folder = str(tmp_path / "in")
    write_parts(spark, folder, rows, SCANS, 4)
    return folder


def batch_slots(spark, folder):
    df = spark.read.schema(SCANS).parquet(folder)
    return df.groupBy(F.window("ts", "5 minutes")["start"].alias("slot")).agg(F.count(F.lit(1)).alias("scans"), F.count_distinct("source").cast("int").alias("n_sources"))


def test_updated_slots_equal_batch(spark, scans):
    folder = S.run_batches(S.slots(stream(spark, scans, SCANS)), "tt2", lambda f: S.version_writer(f"{f}/out"))
    versions = spark.read.parquet(f"{folder}/out")
    assert versions.select("batch").distinct().count() >= 4
    latest = S.latest_version(versions, ["slot"]).select("slot", "scans", "n_sources")
    want = batch_slots(spark, scans)
    assert latest.exceptAll(want).count() == 0 and want.exceptAll(latest).count() == 0


def test_late_scans_drop(spark, tmp_path):
    rows = [("a", BASE + timedelta(hours=5), 1), ("a", BASE + timedelta(hours=5, minutes=1), 2), ("b", BASE, 3), ("b", BASE + timedelta(hours=4, minutes=50), 4)]
    folder = str(tmp_path / "in")
    write_parts(spark, folder, rows, SCANS, 4)
    out = S.run_batches(S.slots(stream(spark, folder, SCANS)), "tt3", lambda f: S.version_writer(f"{f}/out"))
    got = {r.slot for r in S.latest_version(spark.read.parquet(f"{out}/out"), ["slot"]).collect()}
    assert BASE + timedelta(hours=4, minutes=50) in got  # inside the watermark
    assert BASE not in got  # five hours late


def test_each_slot_once_and_manifest(spark, scans):
    want = batch_slots(spark, scans).select("slot")
    once = S.run_to_table(S.once_per_slot(stream(spark, scans, SCANS)).select("slot"), "tt7")
    assert once.exceptAll(want).count() == 0 and want.exceptAll(once).count() == 0

    # without the stream's own memory the manifest does the same
    raw = stream(spark, scans, SCANS).withColumn("slot", F.window("ts", "5 minutes")["start"]).select("slot", "event_id")
    folder = S.run_batches(raw, "tt7m", lambda f: S.new_slots_writer(f"{f}/out", f"{f}/manifest"), "append")
    per_slot = spark.read.parquet(f"{folder}/out").groupBy("slot").agg(F.count_distinct("batch").alias("batches"))
    assert per_slot.count() == want.count() and per_slot.where("batches > 1").count() == 0


ATTEMPTS = "key bigint, ts timestamp, event_id bigint, ok boolean"


@pytest.mark.parametrize("parts", [1, 5])
def test_streaks_run_on_across_batches(spark, tmp_path, parts):
    rnd = random.Random(9)
    rows = [(rnd.randrange(4), BASE + timedelta(seconds=20 * i), i, rnd.random() < 0.3) for i in range(200)]
    rows += [(7, BASE + timedelta(seconds=20 * i + 1), 1000 + i, False) for i in range(150)]  # never succeeds
    rows.sort(key=lambda r: r[1])
    folder = str(tmp_path / "in")
    write_parts(spark, folder, rows, ATTEMPTS, parts)
    sent = []
    out = S.run_batches(
        stream(spark, folder, ATTEMPTS), "tt6", lambda f: streaks.alert_writer(f, handler=lambda df, n: sent.append(df.count())), "append"
    )
    got = streaks.alerts(spark, out).select("event_id", "streak")
    batch = failure_streaks(spark.createDataFrame(rows, ATTEMPTS), "key", "ts", "event_id", "ok").where("streak >= 3").select("event_id", "streak")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert sum(sent) == batch.count()


def test_held_scans_over_batches(spark, tmp_path):
    rnd = random.Random(4)
    rows = sorted(((rnd.choice(["arso", "dwd"]), BASE + timedelta(seconds=rnd.randrange(3600)), i) for i in range(160)), key=lambda r: r[1])
    folder = str(tmp_path / "in")
    write_parts(spark, folder, rows, SCANS, 3)
    side = lambda s, role: stream(spark, folder, SCANS).where(F.col("source") == s).select(F.col("ts").alias(f"{role}_ts"))
    got = S.run_to_table(S.held_matches(side("arso", "fast"), side("dwd", "slow")), "tt4").collect()
    minute = lambda t: t.replace(second=0)
    want = {
        (minute(a[1]), minute(b[1]))
        for a in rows
        for b in rows
        if a[0] == "arso" and b[0] == "dwd" and abs((minute(a[1]) - minute(b[1])).total_seconds()) <= 120
    }
    assert {(r.fast_ts, r.slow_ts) for r in got} == want and len(got) == len(want)


def test_ladder_on_a_stream(spark, tmp_path):
    at = lambda m: BASE + timedelta(minutes=m)
    rows = [(s, at(m), i) for m in (0, 5, 10) for i, s in enumerate(("dwd", "shmu", "chmi"))]
    folder = str(tmp_path / "in")
    write_parts(spark, folder, rows, SCANS, 3)
    out = S.run_batches(stream(spark, folder, SCANS), "tt5", lambda f: S.ladder_writer(f"{f}/out", f"{f}/catalog"), "append")
    last = spark.read.parquet(f"{out}/out").where("batch = 2")
    assert sorted(r.candidate for r in last.collect()) == [at(0), at(5), at(10)]
    assert {r.rung for r in last.collect()} == {1}


def test_ordered_streaks_with_late_and_overlapping_batches(spark, tmp_path):
    from skyweave.streaming import ordered

    rnd = random.Random(9)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), BASE + timedelta(seconds=20 * i, microseconds=rnd.randrange(3)), i, rnd.random() < 0.3) for i in range(300)]
    rows += [(7, BASE + timedelta(hours=1), 1000 + i, False) for i in range(5)]  # ties
    rows += [rows[10], rows[11]]  # come twice
    mixed = sorted(rows, key=lambda r: r[1] + timedelta(minutes=rnd.uniform(0, 15)))  # up to a quarter of an hour late
    mixed.append((1, BASE + timedelta(hours=9), 5000, True))
    mixed.append((1, BASE + timedelta(minutes=1), 5001, False))  # hours late: dropped
    schema = "key bigint, ts timestamp, event_id bigint, ok boolean"
    folder = str(tmp_path / "in")
    write_parts(spark, folder, mixed, schema, 6)
    got = ordered.run(stream(spark, folder, schema), "tt6o", 20)
    want = failure_streaks(spark.createDataFrame(sorted(set(rows)), schema), "key", "ts", "event_id", "ok")
    rows_of = lambda df: sorted((r.key, r.ts, r.event_id, r.ok, r.streak) for r in df.collect())
    assert rows_of(got) == rows_of(want)


def test_a_retried_batch_writes_the_same_and_reads_touched_hours_only(spark, tmp_path):
    out, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")
    write = S.new_slots_writer(out, manifest)
    slot = lambda h, m: (BASE + timedelta(hours=h, minutes=m), 10 * h + m)
    frame = lambda rows: spark.createDataFrame(rows, "slot timestamp, event_id bigint")
    write(frame([slot(h, 0) for h in range(6)]), 0)
    second = frame([slot(2, 0), slot(2, 5), slot(9, 0)])
    for _ in range(2):
        write(second, 1)
        got = spark.read.parquet(out)
        assert sorted((r.batch, r.event_id) for r in got.collect()) == [(0, 10 * h) for h in range(6)] + [(1, 25), (1, 90)]
    write(frame([slot(2, 5), slot(9, 5)]), 2)
    assert [r.event_id for r in spark.read.parquet(f"{out}/batch=2").collect()] == [95]
    hour = spark.sql(f"SELECT unix_timestamp(TIMESTAMP '{BASE}') div 3600").first()[0]
    done = S.slots_written(spark, manifest, [hour + 2], 2)
    assert done.count() == 2
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "hour" in plan.split("PartitionFilters:")[1].split("]")[0]
    write(frame([]), 3)
    assert spark.read.parquet(f"{out}/batch=3").count() == 0


def test_ordered_streaks_call_the_store_by_chunks_not_by_attempts():
    from types import SimpleNamespace as Object

    from skyweave.streaming.ordered import CHUNK, Streaks

    calls, timers = [], set()

    class Kept(dict):
        def updateValue(self, key, value):
            calls.append(key)
            self[key] = value

        def removeKey(self, key):
            calls.append(key)
            self.pop(key)

        def update(self, value):
            calls.append("value")
            self["value"] = value

        def get(self):
            return dict.get(self, "value")

        def iterator(self):
            return iter(list(self.items()))

    handle = Object(
        getMapState=lambda *_: Kept(), getValueState=lambda *_: Kept(), registerTimer=timers.add, deleteTimer=timers.discard
    )
    n = 3 * CHUNK
    rows = [Object(micros=1_000_000 * (i + 1), event_id=i, ok=i % 50 == 0) for i in range(n)]
    random.Random(5).shuffle(rows)
    streaks_ = Streaks()
    streaks_.init(handle)
    got = list(streaks_.handleInputRows((1,), iter(rows + rows[:7]), None))
    assert got == [] and timers == {1001} and len(calls) < 10
    final = 1000 * (n - CHUNK) + 1  # the newest CHUNK attempts stay open
    got = list(streaks_.handleExpiredTimer((1,), Object(getCurrentWatermarkInMs=lambda: final), None))
    assert [(r.event_id, r.streak) for r in got] == [(i, i % 50) for i in range(n - CHUNK)] and len(calls) < 20
    got = list(streaks_.handleExpiredTimer((1,), Object(getCurrentWatermarkInMs=lambda: 10**9), None))
    assert [(r.event_id, r.streak) for r in got] == [(i, i % 50) for i in range(n - CHUNK, n)] and len(calls) < 30
