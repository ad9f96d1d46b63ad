from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyweave import views
from skyweave.sources import catalog, extents, scans, sinks, srd, store

NOW = datetime(2025, 1, 28, 12, 0)
STORE = "source string, product string, timestamp string, cached_at timestamp, bytes bigint"


def entry(source="arso", stamp="20250128100500", age=5, size=1, product="zm"):
    return (source, product, stamp, NOW - timedelta(minutes=age), size)


def now():
    return F.to_timestamp(F.lit(NOW.isoformat(" ")))


def put(spark, old, new, **kw):
    frame = lambda rows: spark.createDataFrame(rows, STORE)
    return sorted(r.bytes for r in store.upsert(frame(old), frame(new), now(), **kw).collect())


def test_put_skips_a_live_entry_unless_forced(spark):
    old, new = [entry(size=1)], [entry(size=2, age=0, stamp="202501281005")]
    assert put(spark, old, new) == [1]
    assert put(spark, old, new, force=True) == [2]
    assert put(spark, [entry(size=1, age=61)], new) == [2]  # expired
    assert put(spark, [entry(size=1, age=60)], new) == [1]  # exactly at the limit
    assert put(spark, old, [entry(size=3, product="rrg")]) == [1, 3]


def test_lookup_available_clear_and_statistics(spark):
    rows = [entry(), entry(stamp="20250128101000", size=2 * 1048576), entry(stamp="20250128101500", age=90), entry("shmu", size=1048576, product="zmax")]
    df = spark.createDataFrame(rows, STORE)
    wanted = spark.createDataFrame([("arso", "zm", "202501281010"), ("arso", "zm", "202501281015")], "source string, product string, timestamp string")
    assert [r.timestamp for r in store.lookup(df, wanted, now()).collect()] == ["20250128101000"]
    assert [r.timestamp for r in store.available(df, now(), "zm").collect()] == ["20250128101000", "20250128100500"]
    kept, removed = store.cleared(df, "arso")
    assert kept.count() == 1 and removed.first().removed == 3
    assert store.cleared(df)[0].count() == 0
    stats = {r.source: (r.entries, r.size_mb) for r in store.statistics(df, now()).collect()}
    assert stats == {"arso": (2, 2.0), "shmu": (1, 1.0), None: (3, 3.0)}
    assert store.expired(df, now()).count() == 1


def test_store_on_disk_rewrites_one_source_only(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([entry(), entry("shmu")], STORE)
    store.write(df, path)
    store.write(spark.createDataFrame([entry(size=9)], STORE), path)
    assert sorted((r.source, r.bytes) for r in spark.read.parquet(path).collect()) == [("arso", 9), ("shmu", 1)]


def test_srd_file(spark, tmp_path):
    text = "SRD-3\r\nncell 3 2 # grid\r\ntime 2025 1 28 12 5\r\noffset 64\r\nslope 2\r\nunit DBZ\r\nkey\r\n\r\nDATA\r\n@A\xff\r\nB@"
    (tmp_path / "si0-zm.srd").write_bytes(text.encode("latin-1"))
    files = srd.read_files(spark, str(tmp_path))
    scan = srd.scans(files).first()
    assert (scan.ts14, scan.product, scan.quantity, scan.units, scan.width, scan.height, scan.slope, scan.start) == ("20250128120500", "ZM", "DBZH", "dBZ", 3, 2, 2.0, 12.0)
    got = {(r.row, r.col): r.dbz for r in srd.cells(srd.scans(files)).collect()}
    assert got == {(0, 1): 14.0, (0, 2): 12.0 + 2 * (255 - 64), (1, 0): 16.0}  # the missing sixth character is no data
    kinds = {(r.key, r.kind) for r in srd.header_table(files).where("text is not null").collect()}
    assert {("ncell", "int"), ("unit", "string")} <= kinds


def test_landed_scans_prune_partitions_and_pixels(spark, data, tmp_path):
    path = str(tmp_path / "landed")
    landed = views.landed(spark, data).drop("scan_id", "slot", "true_ts")
    scans.write_landed(landed, path)
    day = F.to_timestamp(F.lit("2024-01-01 00:00:00")), F.to_timestamp(F.lit("2024-01-01 23:59:59"))
    read = scans.read_scans(spark, path, "shmu", *day)
    assert read.count() == views.landed(spark, data).where("source = 'shmu'").count()
    plan = scans.metadata(read)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "raw" not in schema and "what_dataset" in schema
    assert "PartitionFilters" in plan and "source" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_extent_documents_round_trip_and_save(spark):
    doc = extents.document(F.lit("DWD"), F.struct(F.lit(1.0).alias("west"), F.lit(2.0).alias("east"), F.lit(3.0).alias("south"), F.lit(4.0).alias("north")), F.lit("now"))
    row = spark.range(1).select(doc.alias("d")).select("d", extents.extent_of_document(F.col("d")).alias("e")).first()
    assert row.e[:] == (1.0, 2.0, 3.0, 4.0) and '"source":"dwd"' in row.d
    one = lambda text: spark.createDataFrame([("dwd", text)], "source string, document string")
    assert extents.save(one("old"), one("new")).first().document == "old"
    assert extents.save(one("old"), one("new"), force=True).first().document == "new"


def test_report_of_all_services(spark):
    import json

    row = extents.combined_report(extents.source_extents(spark)).first()
    doc = json.loads(row.document)
    assert row.n_sources == 6 and set(doc["sources"]) == {"dwd", "shmu", "chmi", "omsz", "arso", "imgw"}
    assert (row.combined.west, row.combined.east, row.combined.north) == (1.461077, 26.376516, 56.398335)
    arso = doc["sources"]["arso"]
    assert 12.0 < arso["west"] < 12.3 and 17.2 < arso["east"] < 17.5 and 44.6 < arso["south"] < 44.8 and 47.3 < arso["north"] < 47.5


def test_output_names_and_manifest(spark, ts, tmp_path):
    slots = ts([("dwd", "12:00"), ("other", "12:05")])
    got = {r.folder: r.name for r in sinks.located(slots).collect()}
    assert got == {"germany": "1738065600.png", "other": "1738065900.png"}
    manifest = spark.createDataFrame([("germany", "1738065600.png")], "folder string, name string")
    assert [r.source for r in sinks.not_yet_written(slots, manifest).collect()] == ["other"]
    sinks.write_mosaic(slots.withColumn("dbz", F.lit(1.0)), str(tmp_path / "out"))
    sinks.write_mosaic(slots.where("source = 'dwd'").withColumn("dbz", F.lit(2.0)), str(tmp_path / "out"))  # once more
    out = spark.read.parquet(str(tmp_path / "out"))
    assert [r.dbz for r in out.where("source = 'dwd' and date = '2025-01-28'").collect()] == [2.0] and out.count() == 2


def test_results_of_failed_fetches(spark):
    df = spark.createDataFrame([("dwd", "dmax", "1", True), ("dwd", "dmax", "2", False)], "source string, product string, timestamp string, ok boolean")
    rows = catalog.result_rows(df, F.col("ok"), F.lit("/p"), F.lit("u"), F.lit(False), F.lit("boom"))
    assert [(r.path, r.success, r.error) for r in rows.orderBy("timestamp").collect()] == [("/p", True, None), ("", False, "boom")]
    assert catalog.successes(rows).count() == 1


@pytest.mark.parametrize("hours, want", [(None, 30), (3, 180)])
def test_period(spark, hours, want):
    a, b = catalog.period(now(), hours=hours)
    assert spark.range(1).select((F.unix_timestamp(b) - F.unix_timestamp(a)) / 60).first()[0] == want


def test_a_new_source_is_one_reader(spark, data):
    """Extension point: a reader added to the table is used like the built-in ones."""
    scans.READERS["test"] = scans.read_shmu
    try:
        scan = views.landed(spark, data).where("source = 'shmu'").limit(3)
        assert scans.cells(scans.READERS["test"](scan), ["scan_id"]).count() > 0
    finally:
        del scans.READERS["test"]


def test_a_period_inside_a_day_and_a_product(spark, data, tmp_path):
    from pyspark.sql import functions as F

    from skyweave import views
    from skyweave.sources import scans as S

    landed = views.landed(spark, data).where("source = 'shmu'")
    S.write_landed(landed.select(spark.createDataFrame([], S.RAW_SCAN).columns), str(tmp_path / "landed"))
    every = S.read_shmu(landed).select("ts", "product").collect()
    lo, hi = sorted(r.ts for r in every)[len(every) // 4], sorted(r.ts for r in every)[len(every) // 2]
    got = S.read_scans(spark, str(tmp_path / "landed"), "shmu", F.lit(lo), F.lit(hi))
    assert got.count() == sum(lo <= r.ts <= hi for r in every) > 0
    product = every[0].product
    one = S.read_scans(spark, str(tmp_path / "landed"), "shmu", F.lit(lo), F.lit(hi), [product])
    assert one.count() == sum(lo <= r.ts <= hi and r.product == product for r in every)
