"""The data source of text-grid files: filters reach the listing, and files become scans like all others."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThanOrEqual

from skyweave.sources import scans, srd, text_grids

BODY = "@ABC\nDEF@"
FILES = {
    "date=2024-01-01/si0-zm-a.srd": ("2024 1 1 23 55", BODY),
    "date=2024-01-02/si0-zm-b.srd": ("2024 1 2 0 0", BODY),
    "date=2024-01-02/deep/si0-rrg-c.srd": ("2024 1 2 0 5", BODY),
    "si0-zm-d.srd": ("2024 1 2 0 10", "@"),
    "si0-zm-e.srd": ("", BODY),
    "_temporary/si0-zm-f.srd": ("2024 1 2 0 0", BODY),
    "date=2024-01-03/.hidden": ("2024 1 3 0 0", BODY),
    "date=2024-01-03/si0-zm-empty.srd": None,
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("grids")
    for name, what in FILES.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        text = "" if what is None else f"SRD-3\nncell 4 2\ntime {what[0]}\noffset 64\nstart 10\nslope 2.5\nunit DBZ # \xb0\n\nDATA\n{what[1]}"
        (root / name).write_bytes(text.encode("latin-1"))
    return str(root)


def names(df):
    return sorted(os.path.basename(r.path) for r in df.select("path").collect())


def test_rows(spark, folder):
    rows = {os.path.basename(r.path): r for r in text_grids.read(spark, folder).collect()}
    assert sorted(rows) == [f"si0-{n}.srd" for n in ("rrg-c", "zm-a", "zm-b", "zm-d", "zm-e", "zm-empty")]
    assert {n: r.date for n, r in rows.items()} == {
        "si0-rrg-c.srd": "2024-01-02", "si0-zm-a.srd": "2024-01-01", "si0-zm-b.srd": "2024-01-02",
        "si0-zm-d.srd": "2024-01-02", "si0-zm-e.srd": None, "si0-zm-empty.srd": "2024-01-03",
    }
    assert "\xb0" in rows["si0-zm-a.srd"].content and rows["si0-zm-empty.srd"].content == ""


def test_filters_give_what_spark_alone_gives(spark, folder):
    every = text_grids.read(spark, folder)
    for where in ("date = '2024-01-02'", "date >= '2024-01-02'", "date BETWEEN '2024-01-01' AND '2024-01-02'", "product = 'RRG'", "product IN ('ZM', 'X') AND date < '2024-01-02'", "source = 'dwd'", "source = 'arso' AND date IN ('2024-01-01', '2024-01-03')", "date IS NULL"):
        assert names(text_grids.read(spark, folder).where(where)) == names(spark.createDataFrame(every.collect(), every.schema).where(where)), where


def reader(folder, *filters, size=1 << 20):
    made = text_grids.TextGridReader(folder, size)
    return made, list(made.pushFilters(list(filters)))


def test_listing_takes_the_filters(folder):
    listed = lambda *f: sorted(os.path.basename(p) for part in reader(folder, *f)[0].partitions() for p in part.paths)
    # files outside a date folder are listed whatever the day: their headers tell
    assert listed(EqualTo(("date",), "2024-01-01")) == ["si0-zm-a.srd", "si0-zm-d.srd", "si0-zm-e.srd"]
    assert listed(GreaterThanOrEqual(("date",), "2024-01-02"), LessThanOrEqual(("date",), "2024-01-02"), In(("product",), ("RRG",))) == ["si0-rrg-c.srd"]
    assert listed(EqualTo(("source",), "dwd")) == []
    other = GreaterThan(("date",), "2024-01-01")
    assert reader(folder, other)[1] == [other]


def test_days_that_are_not_wanted_are_not_entered(folder, monkeypatch):
    entered = []
    from pyarrow import fs

    selector = fs.FileSelector
    monkeypatch.setattr(fs, "FileSelector", lambda path: entered.append(path.removeprefix(folder)) or selector(path))
    reader(folder, EqualTo(("date",), "2024-01-03"))[0].partitions()
    assert sorted(entered) == ["", "/date=2024-01-03"]


def test_partitions_by_size(folder):
    made, _ = reader(folder, size=100)
    assert len(made.partitions()) == 6 or len(made.partitions()) == 5
    assert len(reader(folder)[0].partitions()) == 1


def test_scans_of_the_service(spark, folder):
    start, end = (F.to_timestamp(F.lit(t)) for t in ("2024-01-01 23:55:00", "2024-01-02 00:10:00"))
    read = scans.read_scans(spark, folder, "arso", start, end, ["ZM"])
    got = {os.path.basename(r.path): r for r in read.collect()}
    assert sorted(got) == ["si0-zm-a.srd", "si0-zm-b.srd", "si0-zm-d.srd"]
    a = got["si0-zm-a.srd"]
    assert (a.ts14, a.product, a.quantity, a.units, a.height, a.width) == ("20240101235500", "ZM", "DBZH", "dBZ", 2, 4)
    assert a.raw == [0, 1, 2, 3, 4, 5, 6, 0] and got["si0-zm-d.srd"].raw == [0] * 8
    cells = {(r.row, r.col): r.dbz for r in scans.cells(read.where(F.col("path").contains("zm-a")), ["source"]).collect()}
    assert cells == {(0, 1): 12.5, (0, 2): 15.0, (0, 3): 17.5, (1, 0): 20.0, (1, 1): 22.5, (1, 2): 25.0}
    assert {os.path.basename(r.path): r.ok for r in scans.decodable(read).collect()} == {"si0-zm-a.srd": True, "si0-zm-b.srd": True, "si0-zm-d.srd": False}


def test_extent_is_that_of_all_cells(spark):
    want = srd.grid_extent(spark).first()
    got = spark.range(1).select(srd.extent(F.lit(401), F.lit(301)).alias("e")).select("e.*").first()
    assert [round(v, 9) for v in (got.west, got.east, got.south, got.north)] == [round(want[n], 9) for n in ("west", "east", "south", "north")]


def test_write_and_read(spark, tmp_path):
    files = spark.createDataFrame([("2024-02-01", f"x/si0-zm-{i}.srd", f"time 2024 2 1 0 {i}\nDATA\n\xe9") for i in range(5)], "date string, path string, content string")
    assert text_grids.write(files, f"file://{tmp_path}/g") == 5 and text_grids.write(files, f"file://{tmp_path}/g") == 5
    back = text_grids.read(spark, f"{tmp_path}/g").collect()
    assert sorted((r.date, os.path.basename(r.path), r.content) for r in back) == sorted((r.date, os.path.basename(r.path), r.content) for r in files.collect())
