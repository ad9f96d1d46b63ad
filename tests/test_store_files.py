"""The store on disk: what a put rewrites, what a lookup opens, and that both agree with the store in memory."""

import os
import time
from datetime import datetime, timedelta

import pytest

from skyweave.sources import store, store_files
from pyspark.sql import functions as F

NOW = datetime(2025, 1, 28, 12, 0)
SHAPE = "source string, product string, timestamp string, data array<float>, cached_at timestamp, bytes bigint"


def frame(spark, rows):
    """rows: (source, product, timestamp, minutes old, bytes)"""
    at = lambda old: None if old is None else NOW - timedelta(minutes=old)
    text = [(s, p, t, [1.0] * 4, at(old) and at(old).strftime("%Y-%m-%d %H:%M:%S"), n) for s, p, t, old, n in rows]
    return spark.createDataFrame(text, SHAPE.replace("cached_at timestamp", "cached_at string")).withColumn("cached_at", F.to_timestamp("cached_at"))


FIRST = [("dwd", "dmax", f"202501{d:02d}1005", old, d) for d, old in ((26, 5), (27, 90), (28, 5), (28, 5))][:3] + [("shmu", "zmax", "20250128100500", 60, 7), ("shmu", "zmax", "202501281010", 61, 8)]


def folders(path):
    return {os.path.relpath(r, path): max(os.path.getmtime(os.path.join(r, f)) for f in fs) for r, _, fs in os.walk(path / "data") if fs and "version=" in r}


def keys(df):
    return sorted((r.source, r.timestamp[:12], r.bytes) for r in df.collect())


def test_puts_and_lookups_are_those_of_the_table(spark, tmp_path):
    path = str(tmp_path)
    assert len(store_files.put(frame(spark, FIRST), path, NOW)) == 4
    incoming = [("dwd", "dmax", "20250126100500", 0, 100), ("dwd", "dmax", "202501271005", 0, 101), ("shmu", "zmax", "202501281010", 0, 102), ("imgw", "cmax", "202501281000", 0, 103), ("imgw", "cmax", "202501281005", None, 104)]
    for force in (False, True):
        want = store.upsert(store_files.read(spark, path), frame(spark, incoming), F.to_timestamp(F.lit("2025-01-28 12:00:00")), 60, force)
        want = keys(want)
        store_files.put(frame(spark, incoming), path, NOW, 60, force)
        assert keys(store_files.read(spark, path)) == want
    wanted = [("dwd", "dmax", "202501261005"), ("shmu", "zmax", "20250128100500"), ("shmu", "dmax", "202501281010"), ("imgw", "cmax", "202501281005"), ("omsz", "x", "202401010000")]
    now = F.to_timestamp(F.lit("2025-01-28 12:00:00"))
    table = spark.createDataFrame(wanted, "source string, product string, timestamp string")
    want = keys(store.lookup(store_files.read(spark, path), table, now))
    assert want == [("dwd", "202501261005", 100), ("shmu", "202501281005", 7)]
    assert keys(store_files.lookup(spark, path, wanted, NOW)) == want and keys(store_files.lookup(spark, path, table, NOW)) == want
    assert store_files.lookup(spark, path, [], NOW).count() == 0


def test_a_put_rewrites_touched_days_only(spark, tmp_path):
    path = str(tmp_path)
    store_files.put(frame(spark, FIRST), path, NOW)
    before = folders(tmp_path)
    first = store_files.put(frame(spark, [("dwd", "dmax", "202501281010", 0, 50)]), path, NOW)
    second = store_files.put(frame(spark, [("shmu", "zmax", "202501281015", 0, 51), ("dwd", "dmax", "202501261005", 0, 52)]), path, NOW)
    assert first == [("dwd", "2025-01-28")] and second == [("shmu", "2025-01-28")]  # the key of the 26th is still live
    after = folders(tmp_path)
    assert {k: after[k] for k in before} == before
    assert sorted(set(after) - set(before)) == ["data/source=dwd/date=2025-01-28/version=2", "data/source=shmu/date=2025-01-28/version=3"]
    assert store_files.put(frame(spark, [("dwd", "dmax", "202501261005", 0, 52)]), path, NOW) == []
    assert store_files.vacuum(path) == 2 and store_files.vacuum(path) == 0
    assert keys(store_files.read(spark, path)) == sorted([(s, t[:12], n) for s, _, t, _, n in FIRST] + [("dwd", "202501281010", 50), ("shmu", "202501281015", 51)])


def test_a_lookup_opens_the_wanted_days(spark, tmp_path):
    path = str(tmp_path)
    store_files.put(frame(spark, FIRST), path, NOW)
    found = store_files.lookup(spark, path, [("dwd", "dmax", "202501281005")], NOW)
    assert len(found.inputFiles()) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters:")[1].split("]")[0] and "ts12" in plan.split("PushedFilters:")[1].split("]")[0] and "cached_at" in plan.split("PushedFilters:")[1].split("]")[0]
    found.collect()
    begin = time.perf_counter()
    assert found.collect()[0].bytes == 28
    assert time.perf_counter() - begin < 2  # the bench holds it against the published figure


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    store_files.put(frame(spark, FIRST), path, NOW)
    behind = store_files._commit(path)
    store_files.put(frame(spark, [("dwd", "dmax", "202501281010", 0, 50)]), path, NOW)
    monkeypatch.setattr(store_files, "_commit", lambda _: behind)
    with pytest.raises(RuntimeError):
        store_files.put(frame(spark, [("dwd", "dmax", "202501281015", 0, 51)]), path, NOW)


def test_no_store(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store_files.read(spark, str(tmp_path / "none"))
    assert store_files.put(frame(spark, FIRST).where("false"), str(tmp_path / "none"), NOW) == []
