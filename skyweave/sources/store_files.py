"""The store of decoded scans on disk: copy-on-write of the days a put touches.

``data/source=.../date=.../version=...`` holds the scans of one service and day, sorted by product and minute, so that the
files' own statistics are the index of the keys. ``commits/<n>.json`` names the version of each (source, date) that counts, and
the schema. A put reads the keys of the days its scans belong to, writes those days anew under the next version and commits by
renaming one small file; other days are not read, listed or written, and readers see all of a put or nothing. A lookup opens the
folders of the wanted keys alone. The commit has one entry for each service and day kept, so the driver holds it.

One writer at a time: a put that finds its commit taken raises. ``vacuum`` deletes versions that no longer count.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from ..dimensions import STORE_TTL_MINUTES
from . import store as S
from .text_grids import file_system

PART = ["source", "date"]


def _dated(rows: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    day = F.concat_ws("-", F.substring(ts, 1, 4), F.substring(ts, 5, 2), F.substring(ts, 7, 2))
    return S.keyed(rows).withColumn("date", day)


def _instant(at: datetime) -> Column:
    """A moment as a literal; one without a zone is UTC, like the session."""
    return F.to_timestamp(F.lit((at.astimezone(timezone.utc) if at.tzinfo else at).strftime("%Y-%m-%d %H:%M:%S")))


def _commit(path: str) -> tuple[int, dict[tuple[str, str], int], StructType | None]:
    """Number of the newest commit, the versions it names, and the schema of the rows."""
    from pyarrow import fs

    files, root = file_system(f"{path}/commits")
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    numbers = [int(i.base_name.removesuffix(".json")) for i in found if i.base_name.endswith(".json") and not i.base_name.startswith(".")]
    if not numbers:
        return 0, {}, None
    with files.open_input_file(f"{root}/{max(numbers)}.json") as f:
        said = json.loads(f.read())
    return max(numbers), {(s, d): v for s, d, v in said["versions"]}, StructType.fromJson(said["schema"])


def _write_commit(path: str, number: int, versions: dict[tuple[str, str], int], schema: StructType) -> None:
    from pyarrow import fs

    files, root = file_system(f"{path}/commits")
    files.create_dir(root, recursive=True)
    if files.get_file_info(f"{root}/{number}.json").type != fs.FileType.NotFound:
        raise RuntimeError(f"commit {number} of {path} was made by another writer")
    with files.open_output_stream(f"{root}/.{number}.json") as f:
        f.write(json.dumps({"versions": sorted([s, d, v] for (s, d), v in versions.items()), "schema": schema.jsonValue()}).encode())
    files.move(f"{root}/.{number}.json", f"{root}/{number}.json")


def _rows(spark: SparkSession, path: str, versions: dict[tuple[str, str], int], parts: set[tuple[str, str]], schema: StructType) -> DataFrame:
    """Rows of some (source, date) with ``ts12`` and ``date``; their folders alone are listed, and their days filter."""
    here = sorted(p for p in parts if p in versions)
    folders = [f"{path}/data/source={s}/date={d}/version={versions[s, d]}" for s, d in here]
    typed = StructType([f for f in schema if f.name != "source"])
    for name, kind in (("ts12", StringType()), ("source", StringType()), ("date", StringType()), ("version", IntegerType())):
        typed = typed.add(name, kind)
    if not folders:
        return spark.createDataFrame([], typed).drop("version")
    read = spark.read.schema(typed).option("basePath", f"{path}/data").parquet(*folders)
    return read.where(F.col("date").isin(sorted({d for _, d in here})) & F.col("source").isin(sorted({s for s, _ in here}))).drop("version")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The whole store."""
    _, versions, schema = _commit(path)
    if schema is None:
        raise FileNotFoundError(f"no store at {path}")
    return _rows(spark, path, versions, set(versions), schema).select(schema.names)


def put(incoming: DataFrame, path: str, now: datetime, ttl_minutes: int = STORE_TTL_MINUTES, force: bool = False) -> list[tuple[str, str]]:
    """Take the incoming scans whose keys no live row has (``force``: all); returns the (source, date) written anew.

    ``incoming`` has one row per key. Only keys and ages of the touched days are read to decide; pixels are read of the days
    that do change.
    """
    spark = incoming.sparkSession
    number, versions, schema = _commit(path)
    schema = schema or incoming.schema
    at = _instant(now)
    fresh = _dated(incoming.select(schema.names))
    touched = {(r.source, r.date) for r in fresh.select(PART).distinct().collect()}  # services and days
    old = _rows(spark, path, versions, touched, schema)
    taken = fresh if force else fresh.join(S.live(old, at, ttl_minutes).select(S.KEY), S.KEY, "left_anti")
    changed = {(r.source, r.date) for r in taken.select(PART).distinct().collect()}
    if not changed:
        return []
    before = _rows(spark, path, versions, changed, schema)
    kept = before.join(taken.select(S.KEY), S.KEY, "left_anti")
    after = kept.unionByName(taken).withColumn("version", F.lit(number + 1))
    # ranges of keys, not days: a busy day spreads over tasks, and each file holds a stretch of minutes
    order = ["source", "date", "product", "ts12"]
    spread = after.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.write.mode("append").partitionBy("source", "date", "version").parquet(f"{path}/data")
    _write_commit(path, number + 1, versions | dict.fromkeys(changed, number + 1), schema)
    return sorted(changed)


def lookup(spark: SparkSession, path: str, wanted: DataFrame | list[tuple[str, str, str]], now: datetime, ttl_minutes: int = STORE_TTL_MINUTES) -> DataFrame:
    """Live rows of the wanted (source, product, timestamp).

    Keys given as a list become filters that reach the files' statistics; no job runs before the result's own. For keys in a
    table their services and days are collected first, which are at most those of the store.
    """
    _, versions, schema = _commit(path)
    if schema is None:
        raise FileNotFoundError(f"no store at {path}")
    oldest = _instant(now.replace(microsecond=0) - timedelta(minutes=ttl_minutes))  # ages count whole seconds
    if isinstance(wanted, list):
        keys = sorted({(s, p, t[:12]) for s, p, t in wanted})
        parts = {(s, f"{t[:4]}-{t[4:6]}-{t[6:8]}") for s, _, t in keys}
        rows = _rows(spark, path, versions, parts, schema).where(F.col("cached_at") >= oldest)
        minutes = sorted({t for *_, t in keys})
        same = F.struct("source", "product", "ts12").isin([F.struct(*(F.lit(v) for v in k)) for k in keys])
        return rows.where(F.col("ts12").isin(minutes)).where(same).select(schema.names)
    named = spark.createDataFrame(sorted(versions), "source string, date string") if versions else spark.createDataFrame([], "source string, date string")
    keys = _dated(wanted).select(*S.KEY, "date").distinct()
    parts = {(r.source, r.date) for r in keys.select(PART).distinct().join(F.broadcast(named), PART, "left_semi").collect()}
    rows = _rows(spark, path, versions, parts, schema).where(F.col("cached_at") >= oldest)
    return rows.join(keys.drop("date"), S.KEY, "left_semi").select(schema.names)


def vacuum(path: str) -> int:
    """Delete versions that the newest commit does not name, and older commits; returns the number of folders."""
    from pyarrow import fs

    number, versions, _ = _commit(path)
    files, root = file_system(f"{path}/data")
    gone = 0
    for source in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        for day in files.get_file_info(fs.FileSelector(source.path)) if source.type == fs.FileType.Directory else []:
            for version in files.get_file_info(fs.FileSelector(day.path)) if day.type == fs.FileType.Directory else []:
                key = (source.base_name.removeprefix("source="), day.base_name.removeprefix("date="))
                if versions.get(key) != int(version.base_name.removeprefix("version=")):
                    files.delete_dir(version.path)
                    gone += 1
    files, root = file_system(f"{path}/commits")
    for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if info.base_name != f"{number}.json":
            files.delete_file(info.path)
    return gone
