"""A versioned table with incremental compaction (AGG-1, SNK-1/2).

Rows arrive in batches and may be newer versions of rows that are there. ``append`` writes a
batch by the UTC day of a *key* column, so that all versions of a key share a day, and
``compact`` merges the loose batches of a day with what the day was compacted to before, into
files sorted by the key that hold the newest version of each key alone. ``read_latest`` takes
compacted days as they are, without an aggregate or an exchange, and resolves versions only
on days with loose batches; its rows are those of ``latest_by_key`` over everything appended.

What belongs to the table is said by the newest manifest, a small JSON file a commit (days
and folder names; no rows and no file lists). Data folders are written first, under names
never used before, and become visible with the manifest that names them: a killed run leaves
folders that nobody reads, and ``vacuum`` removes them. Commits are optimistic: a manifest
number is taken once, whoever loses reads the new manifest and applies its change to that. An
append that lands during a compaction stays loose. The number is taken by a rename that must
not replace, which HDFS does in one step; on a store without such a rename let one process
commit at a time. Readers hold the manifest they began with; folders it names are removed by
``vacuum`` alone, so leave it as much time as the longest read.

A batch has a writer's name and a number that grows (``foreachBatch`` gives both), and a
number not above the writer's last is left out: a batch delivered again changes nothing.

Edge cases: rows whose day column is null stand in a day of their own; rows of one key and
one version settle by their other columns, the greatest first, map columns left out; an empty
batch is noted and adds no folder; a table without batches is read as no rows.
"""

from __future__ import annotations

import dataclasses
import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions import trade as ft
from tickweave.operators.quality import TRADE_KEY, latest_by_key

_LOG, _DATA = "_manifest", "data"
#: Bytes and rows of one compacted file's input, about. Rows too, as a task holds them
#: uncompressed and files of the same bytes can hold many times as many.
FILE_BYTES, FILE_ROWS = 128 << 20, 500_000
#: Commits that are tried against others before giving up.
ATTEMPTS = 20


@dataclasses.dataclass
class Manifest:
    """``days``: compacted folder of a day; ``loose``: folders of its batches since then;
    ``writers``: last batch number of each writer; ``schema``: of the rows, as JSON."""

    number: int = 0
    schema: str = ""
    days: dict[str, str] = dataclasses.field(default_factory=dict)
    loose: dict[str, list[str]] = dataclasses.field(default_factory=dict)
    writers: dict[str, int] = dataclasses.field(default_factory=dict)

    def folders(self, days: Sequence[str] | None = None) -> list[str]:
        return [f for d in (self.days.keys() | self.loose.keys() if days is None else days)
                for f in ([self.days[d]] if d in self.days else []) + self.loose.get(d, [])]


class VersionedTable:
    """The table at ``path`` with ``key``; ``day_of``, a key column in epoch milliseconds, deals
    keys to days; of a key's rows the one with the greatest ``version`` counts."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = TRADE_KEY, version: str = "local_timestamp",
                 day_of: str = "timestamp"):
        if day_of not in key:
            raise ValueError(f"versions of a key must share a day, but {day_of} is not part of the key")
        self.spark, self.path, self.key, self.version, self.day_of = spark, path.rstrip("/"), list(key), version, day_of
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *x: str):
        return self._Path("/".join((self.path, *x)))

    def _names(self, *x: str) -> list[str]:
        at = self._at(*x)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    # ------------------------------------------------------------ manifests

    def manifest(self) -> Manifest:
        numbers = [n for n in self._names(_LOG) if n.isdigit()]
        if not numbers:
            return Manifest()
        s = self._fs.open(self._at(_LOG, numbers[-1]))
        try:
            return Manifest(**json.loads(bytes(s.readAllBytes())))
        finally:
            s.close()

    def _take(self, m: Manifest) -> bool:
        """Make ``m`` the manifest of its number, unless another has it."""
        final, draft = self._at(_LOG, f"{m.number:012d}"), self._at(_LOG, f".{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(json.dumps(dataclasses.asdict(m)).encode())
        out.close()
        if not self._fs.exists(final) and self._fs.rename(draft, final):
            return True
        self._fs.delete(draft, False)
        return False

    def _commit(self, change: Callable[[Manifest], bool]) -> bool:
        """Apply ``change`` to the newest manifest; False if it finds nothing left to change."""
        for _ in range(ATTEMPTS):
            m = self.manifest()
            m.number += 1
            if not change(m):
                return False
            if self._take(m):
                return True
        raise OSError(f"{self.path}: other commits came first {ATTEMPTS} times")

    # ------------------------------------------------------------ writing

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Write rows (with ``_day``) into a new folder; folders by day. Readers are given these
        folders one by one, so the day in their name doesn't become a column."""
        folder = f"{_DATA}/{uuid.uuid4().hex}"
        # named before the sort, which is then the one that the writer asks for too
        d = df.withColumn("_day", F.coalesce(F.col("_day").cast("string"), F.lit("none"))).sortWithinPartitions("_day", *self.key)
        d.write.partitionBy("_day").parquet(f"{self.path}/{folder}")
        return {x.partition("=")[2]: f"{folder}/{x}" for x in self._names(folder) if x.startswith("_day=")}

    def append(self, df: DataFrame, writer: str, number: int) -> bool:
        """Add a batch; False if the writer's batch was there already."""
        if self.manifest().writers.get(writer, -1) >= number:
            return False
        folders = self._write(df.withColumn("_day", ft.utc_date(self.day_of)))

        def change(m: Manifest) -> bool:
            if m.writers.get(writer, -1) >= number:
                return False
            if m.schema and T.StructType.fromJson(json.loads(m.schema)).simpleString() != df.schema.simpleString():
                raise ValueError(f"{self.path}: the batch has other columns than the table")
            m.schema = m.schema or df.schema.json()
            m.writers[writer] = number
            for day, f in folders.items():
                m.loose.setdefault(day, []).append(f)
            return True

        return self._commit(change)

    def compact(self, days: Sequence[str] | None = None, min_loose: int = 1) -> list[str]:
        """Merge days that have at least ``min_loose`` loose batches (of ``days``, if given), and
        return those merged. One shuffle: ranges of (day, key), which also bring versions of a
        key together, so that a hot day or instrument is many tasks."""
        seen = self.manifest()
        todo = sorted(d for d, f in seen.loose.items() if len(f) >= min_loose and (days is None or d in days))
        if not todo:
            return []
        taken = seen.folders(todo)
        loose = self._read(seen, taken)
        n_bytes = sum(self._fs.getContentSummary(self._at(f)).getLength() for f in taken)
        n = max(1, -(-n_bytes // FILE_BYTES), -(-loose.count() // FILE_ROWS))
        rows = loose.withColumn("_day", F.coalesce(ft.utc_date(self.day_of).cast("string"), F.lit("none"))).repartitionByRange(int(n), "_day", *self.key)
        folders = self._write(self._newest(rows, ["_day", *self.key]))
        done: list[str] = []

        def change(m: Manifest) -> bool:
            done.clear()
            for d in todo:
                if m.days.get(d) != seen.days.get(d) or m.loose.get(d, [])[:len(seen.loose[d])] != seen.loose[d]:
                    continue  # another compaction has been here
                m.days[d] = folders[d]
                m.loose[d] = m.loose[d][len(seen.loose[d]):]
                if not m.loose[d]:
                    del m.loose[d]
                done.append(d)
            return bool(done)

        self._commit(change)
        return done

    def vacuum(self, older_than_s: float = 86_400.0) -> int:
        """Remove data folders of that age which the newest manifest doesn't name, and manifests
        before it. Returns the number of folders removed."""
        named, limit, gone = set(self.manifest().folders()), (time.time() - older_than_s) * 1000, 0
        for x in self._names(_DATA):
            for y in self._names(_DATA, x):
                f = f"{_DATA}/{x}/{y}"
                if y.startswith("_day=") and f not in named and self._fs.getFileStatus(self._at(f)).getModificationTime() <= limit:
                    gone += bool(self._fs.delete(self._at(f), True))
            if not any(y.startswith("_day=") for y in self._names(_DATA, x)) and \
                    self._fs.getFileStatus(self._at(_DATA, x)).getModificationTime() <= limit:
                self._fs.delete(self._at(_DATA, x), True)
        for x in [n for n in self._names(_LOG) if n.isdigit()][:-1]:
            if self._fs.getFileStatus(self._at(_LOG, x)).getModificationTime() <= limit:
                self._fs.delete(self._at(_LOG, x), False)
        return gone

    # ------------------------------------------------------------ reading

    def _read(self, m: Manifest, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(m.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _newest(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        tie = [f.name for f in df.schema if f.name not in (*key, self.version) and "map<" not in f.dataType.simpleString()]
        return latest_by_key(df, key, self.version, tie)

    def read_latest(self, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
        """The newest version of each key, of the days from ``first_day`` to ``last_day`` ('none'
        is the day of rows without one, read only if neither is given)."""
        m = self.manifest()
        if not m.schema:
            raise ValueError(f"{self.path}: nothing was appended yet")
        days = sorted(d for d in m.days.keys() | m.loose.keys()
                      if (d != "none" or (first_day is None and last_day is None)) and (first_day or "") <= d
                      and (last_day is None or d <= last_day))
        clean = self._read(m, m.folders([d for d in days if d not in m.loose]))
        dirty = [d for d in days if d in m.loose]
        return clean.unionAll(self._newest(self._read(m, m.folders(dirty)), self.key)) if dirty else clean
