import numpy as np
from pyspark.sql import functions as F

from skyweave.functions.proj import Grid
from skyweave.operators.regrid import SourceGrid
from skyweave.plans import composite

DST = Grid.of_shape((10.0, 14.0, 45.0, 49.0), 9, 9)
GRIDS = {n: SourceGrid(10, 49, 0.5, 0.5, 8, 8) for n in ("dwd", "shmu", "chmi", "omsz", "imgw", "arso")}


def scaling():
    return F.struct(F.lit(0.5).alias("gain"), F.lit(-32.0).alias("offset"), F.lit(255).alias("nodata"), F.lit(0).alias("undetect"), F.lit(True).alias("byte_rule"))


def landed(spark, rows):
    """rows: (source, 'HH:MM', level) -> catalog and uniform scans."""
    df = spark.createDataFrame([(s, f"2025-01-28 {t}", v) for s, t, v in rows], "source string, t string, v int")
    full = df.select("source", F.to_timestamp("t", "yyyy-MM-dd HH:mm").alias("ts"), F.array_repeat("v", 64).alias("raw"), F.lit(8).alias("height"), F.lit(8).alias("width"), scaling().alias("scaling"), F.lit(True).alias("is_u8"))
    catalog = full.select("source", "ts", F.date_format("ts", "yyyyMMddHHmmss").alias("timestamp"))
    return catalog, full


def latest(spark, rows, now="12:10", **kw):
    catalog, scans = landed(spark, rows)
    at = F.to_timestamp(F.lit(f"2025-01-28 {now}:00"))
    return composite.latest(catalog, scans, GRIDS, DST, at, **kw)


def slots(made):
    return {(r.slot.strftime("%H:%M"), r.source) for r in made.slots.collect()}


def test_all_sources_and_the_largest_value(spark):
    made = latest(spark, [(s, t, v) for t in ("12:00", "12:05") for s, v in (("dwd", 80), ("shmu", 90), ("chmi", 100))])
    assert len(slots(made)) == 6
    cells = made.cells.collect()
    assert {r.dbz for r in cells} == {18.0} and len(cells) == 2 * made.statistics.first().valid_cells


def test_source_in_outage_takes_no_part(spark):
    rows = [(s, "12:00", 80) for s in ("dwd", "shmu", "chmi")] + [("imgw", "11:00", 200)]
    made = latest(spark, rows)
    assert slots(made) == {("12:00", s) for s in ("dwd", "shmu", "chmi")}
    assert {r.source: r.available for r in made.availability.collect()}["imgw"] is False


def test_too_few_core_sources_give_nothing(spark):
    made = latest(spark, [("dwd", "12:00", 80), ("shmu", "12:00", 80), ("arso", "12:00", 80)])
    assert made.slots.count() == 0 and made.cells.count() == 0


def test_archive_less_source_is_dropped_on_the_second_rung(spark):
    rows = [(s, "12:00", 80) for s in ("dwd", "shmu", "chmi", "omsz")] + [("arso", "12:07", 200)]
    made = latest(spark, rows)
    assert ("12:00", "arso") not in slots(made) and ("12:00", "dwd") in slots(made)


def test_published_slots_are_skipped(spark):
    rows = [(s, t, 80) for t in ("12:00", "12:05") for s in ("dwd", "shmu", "chmi")]
    manifest = spark.createDataFrame([("composite", "1738065600.png")], "folder string, name string")
    assert {t for t, _ in slots(latest(spark, rows, manifest=manifest))} == {"12:05"}


def test_strategies_agree_on_equal_scans(spark):
    rows = [(s, "12:00", 100) for s in ("dwd", "shmu", "chmi")]
    for name in ("max", "average", "priority", "weighted"):
        got = {round(r.dbz, 9) for r in latest(spark, rows, strategy=name).cells.collect()}
        assert got == {18.0}, name


def test_strips_at_rest_and_mixed_projections(spark, tmp_path):
    """Stored strips give the same mosaic as scans, also when one service needs the cell way."""
    from skyweave.functions.proj import Projection
    from skyweave.operators import strips

    rows = [(s, "12:00", v) for s, v in (("dwd", 80), ("shmu", 90), ("chmi", 100))]
    catalog, scans = landed(spark, rows)
    lines = strips.strips(scans, ["source", "ts"]).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    strips.write(lines, str(tmp_path / "strips"))
    stored = spark.read.parquet(str(tmp_path / "strips"))
    at = F.to_timestamp(F.lit("2025-01-28 12:10:00"))
    merc = SourceGrid(1_100_000.0, 6_300_000.0, 60_000.0, 60_000.0, 8, 8, Projection("merc", a=6378137.0))
    for grids in (GRIDS, {**GRIDS, "chmi": merc}):
        a = composite.latest(catalog, scans, grids, DST, at).cells
        b = composite.latest(catalog, stored, grids, DST, at).cells
        assert a.count() > 40 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        assert 18.0 in {r.dbz for r in a.collect()}


def test_backload_needs_every_archived_source(spark):
    five = ("dwd", "shmu", "chmi", "omsz", "imgw")
    rows = [(s, "12:00", 80) for s in five] + [(s, "12:05", 80) for s in five[:4]] + [("arso", "12:05", 80)]
    catalog, scans = landed(spark, rows)
    at = lambda t: F.to_timestamp(F.lit(f"2025-01-28 {t}:00"))
    made = composite.backload(catalog, scans, GRIDS, DST, at("11:00"), at("13:00"))
    assert {t for t, _ in slots(made)} == {"12:00"} and np.isclose(made.statistics.first().coverage_percent, 100.0)


def test_slots_whose_scans_cannot_be_read_are_skipped_with_a_reason(spark):
    catalog, scans = landed(spark, [(s, t, 80) for t in ("12:00", "12:05") for s in ("dwd", "shmu", "chmi")])
    at = F.to_timestamp(F.lit("2025-01-28 12:10:00"))
    gone = scans.where("not (source = 'chmi' and minute(ts) = 5)")
    made = composite.latest(catalog, gone, GRIDS, DST, at)
    assert {t for t, _ in slots(made)} == {"12:00"}
    assert {r.slot.strftime("%H:%M") for r in made.cells.select("slot").distinct().collect()} == {"12:00"}
    assert [(r.slot.strftime("%H:%M"), r.reason) for r in made.skipped.collect()] == [("12:05", "insufficient: 2 of 3 sources readable")]


def test_backload_skips_a_slot_with_one_readable_scan(spark):
    five = ("dwd", "shmu", "chmi", "omsz", "imgw")
    catalog, scans = landed(spark, [(s, "12:00", 80) for s in five])
    at = lambda t: F.to_timestamp(F.lit(f"2025-01-28 {t}:00"))
    made = composite.backload(catalog, scans.where("source = 'dwd'"), GRIDS, DST, at("11:00"), at("13:00"))
    assert made.slots.count() == 0 and made.cells.count() == 0 and made.skipped.count() == 1


def test_pixels_of_other_days_are_not_opened(spark, tmp_path):
    catalog, scans = landed(spark, [(s, "12:00", 80) for s in ("dwd", "shmu", "chmi")])
    dated = scans.withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    old = scans.withColumn("date", F.lit("2024-06-01")).withColumn("ts", F.col("ts") - F.expr("interval 240 days"))
    dated.unionByName(old).write.partitionBy("source", "date").parquet(str(tmp_path / "scans"))
    stored = spark.read.parquet(str(tmp_path / "scans"))
    at = F.to_timestamp(F.lit("2025-01-28 12:10:00"))
    made = composite.latest(catalog, stored, GRIDS, DST, at)
    assert made.cells.count() > 0
    plan = made.cells._jdf.queryExecution().executedPlan().toString()
    scans_of = [line for line in plan.splitlines() if "FileScan parquet" in line and "raw" in line]
    assert scans_of and all("date" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in scans_of)
