"""Retention of day-partitioned tables by their partitions (FLT-5).

A table written by ``sinks.write_table`` has a folder for each UTC day of ``local_timestamp``.
Days that are over by the cut (``now - days``) are removed by the file system alone; of the
one day that the cut falls in, the rows that stay are written anew; younger days are not
opened. Nothing but folder names reaches the driver.

The boundary day is swapped by renames, and each state that a killed run can leave is
finished by the next one: a staged day without its mark is thrown away, one with its mark is
moved into place. Readers see the old or the new folder, and for the moment between the two
renames none; a reader that must not miss rows reads before or after. Staging folders begin
with an underscore, which file readers skip. Rows without a timestamp stand in the null
partition, which never expires.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.operators.quality import DAY_MS, apply_retention

_STAGE, _MARK = "_retention-", "_READY"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), lambda *x: spark._jvm.org.apache.hadoop.fs.Path("/".join((path.rstrip("/"), *x)))


def _folders(fs, at) -> list[str]:
    return sorted(f.getPath().getName() for f in fs.listStatus(at()) if f.isDirectory())


def _must(done: bool, what: str) -> None:
    if not done:
        raise OSError(what)


def _settle(fs, at) -> None:
    """Finish, or undo, what a killed run has left."""
    for stage in (x for x in _folders(fs, at) if x.startswith(_STAGE)):
        if fs.exists(at(stage, _MARK)):
            _swap(fs, at, stage)
        else:
            _must(fs.delete(at(stage), True), f"{stage} can't be removed")


def _swap(fs, at, stage: str) -> None:
    for day in (x.getPath().getName() for x in fs.listStatus(at(stage)) if x.isDirectory()):
        if fs.exists(at(day)):
            _must(fs.delete(at(day), True), f"{day} can't be removed")
        _must(fs.rename(at(stage, day), at(day)), f"{day} can't be moved into place")
    _must(fs.delete(at(stage), True), f"{stage} can't be removed")


def expire_partitions(spark: SparkSession, path: str, now_ms: int, days: int = 7, col: str = "local_timestamp") -> dict[str, list[str]]:
    """Remove rows of the table at ``path`` that ``apply_retention`` would leave out. Returns the
    days ``dropped`` and ``rewritten``; a second run at the same time has none."""
    fs, at = _fs(spark, path)
    if not fs.exists(at()):
        return {"dropped": [], "rewritten": []}
    _settle(fs, at)
    cut = now_ms - days * DAY_MS
    done: dict[str, list[str]] = {"dropped": [], "rewritten": []}
    for folder in _folders(fs, at):
        name, _, value = folder.partition("=")
        try:
            first = int(dt.datetime.fromisoformat(value).replace(tzinfo=dt.UTC).timestamp() * 1000)
        except ValueError:
            continue
        if name != "date" or first > cut:
            continue
        if first + DAY_MS - 1 <= cut:
            _must(fs.delete(at(folder), True), f"{folder} can't be removed")
            done["dropped"].append(value)
        elif _keep_rest(spark, fs, at, path, folder, cut, now_ms, days, col):
            done["rewritten"].append(value)
    return done


def _keep_rest(spark, fs, at, path: str, folder: str, cut: int, now_ms: int, days: int, col: str) -> bool:
    day = spark.read.parquet(f"{path.rstrip('/')}/{folder}")
    if day.where(F.col(col) <= cut).isEmpty():
        return False
    stage = f"{_STAGE}{uuid.uuid4().hex}"
    apply_retention(day, now_ms, days, col).write.parquet(f"{path.rstrip('/')}/{stage}/{folder}")
    if not any(f.getPath().getName().startswith("part-") for f in fs.listStatus(at(stage, folder))):
        _must(fs.delete(at(stage, folder), True), f"{folder} can't be removed")
        fs.mkdirs(at(stage))
    fs.create(at(stage, _MARK)).close()
    _swap(fs, at, stage)
    return True


def read_retained(spark: SparkSession, path: str, now_ms: int, days: int = 7, col: str = "local_timestamp") -> DataFrame:
    """The rows that are young enough, whether or not expired ones are still there: the day
    predicate keeps the scan off expired folders, the row predicate settles the boundary."""
    first = dt.datetime.fromtimestamp((now_ms - days * DAY_MS) / 1000, dt.UTC).date()
    table = spark.read.parquet(path)
    return apply_retention(table.where(F.col("date").isNull() | (F.col("date") >= F.lit(first))), now_ms, days, col)
