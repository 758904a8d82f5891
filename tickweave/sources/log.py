"""Message log: an append-only table read as a stream in micro-batches bounded by rows.

Layout: ``<root>/<append, 10 digits>/_stream=<key>/part-*.parquet``. ``append_log`` adds one
numbered folder; it counts as soon as it holds ``_SUCCESS``, and its files never change.
Inside a stream rows are in order of (append, part, file).

``read_log`` is a Python data source. Its offset holds, for each stream, the file it stands in
and the rows read of it, so files before that are never opened again, and a micro-batch has
at most ``rows_per_trigger`` rows however large the files are. Waiting streams share the rows
evenly, and what one doesn't need goes to the others. With ``max_wait_s`` a micro-batch is held
back until it is full or its oldest row has waited so long: the flush at n rows or t seconds.
With ``catch_up_rows`` a micro-batch takes a quarter of the rows that wait, but never more than
that nor less than a flush: behind a backlog of any length the flushes run many at once, by many
tasks, and the last ones are of ``rows_per_trigger`` rows again.

Spark keeps the offsets in the query's checkpoint and hands the last one to ``partitions`` on
a restart, so a run that was killed goes on where it stood, with the same bound.

Files are read by tasks through ``pyarrow.fs`` (local and mounted folders, HDFS, S3, GCS).
``availableNow`` ends such a source after one micro-batch; use ``drain_query``.

Edge cases: a null or empty key is one stream of its own; an empty append adds nothing; a
stream that appears later is read from its first row; one writer appends at a time (the
second to take a number fails).
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

#: The reference's flush.
FLUSH_ROWS, FLUSH_SECONDS = 10_000, 10.0
#: Rows of one task at most, and seconds between two listings.
ROWS_PER_TASK, LIST_EVERY_S = 100_000, 0.2
#: Rows of a micro-batch at most while it catches up, and the part of the waiting rows it takes.
CATCH_UP_ROWS, CATCH_UP_PART = 2_000_000, 4
STREAM = "_stream"


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(root)
    return fs, path.rstrip("/")


def _appends(fs: pafs.FileSystem, path: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.Directory and re.fullmatch(r"\d{10}", f.base_name))


def append_log(df: DataFrame, root: str, stream: str, order: Sequence[str | Column] = ()) -> str:
    """Append ``df`` to the log, streams told apart by the column ``stream`` and in ``order``
    within it; returns the new folder. A large stream is spread over many files."""
    fs, path = _open(root)
    number = int((_appends(fs, path) or ["-1"])[-1]) + 1
    by, out = [F.col(stream), *[F.col(c) if isinstance(c, str) else c for c in order]], f"{root.rstrip('/')}/{number:010d}"
    df.withColumn(STREAM, F.col(stream).cast("string")).repartitionByRange(*by).sortWithinPartitions(*by) \
        .write.mode("errorifexists").partitionBy(STREAM).parquet(out)
    return out


class Slices(InputPartition):
    """Row ranges (file, from, to) that one task reads in this order."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        super().__init__(None)
        self.ranges = ranges


class LogReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.root = schema, options["path"]
        self.limit, self.wait = int(options["rowspertrigger"]), float(options["maxwaits"])
        self.most = max(self.limit, int(options.get("catchuprows", 0)))
        self.at: dict = {}
        self.turn = 0
        self.held_since: float | None = None
        self.listed_at = float("-inf")
        self.known = ""                        # the last append taken up
        self.files: dict[str, list[str]] = {}  # stream -> its files in order, relative to the root
        self.counts: dict[str, int] = {}

    # -- what the log holds -------------------------------------------------------------

    def _list(self) -> None:
        """Take up appends that are complete, from the earliest that a position stands in. An
        open one hides those after it, else its rows would come in behind later ones."""
        if time.monotonic() - self.listed_at < LIST_EVERY_S:
            return
        fs, path = _open(self.root)
        earliest = min((p["file"][:10] for p in self.at.values()), default="")
        for name in _appends(fs, path):
            if name <= self.known or name < earliest:
                continue
            found = fs.get_file_info(pafs.FileSelector(f"{path}/{name}", recursive=True))
            if not any(f.base_name == "_SUCCESS" for f in found):
                break
            self.known = name
            for file in sorted((f.path[len(path) + 1:] for f in found if f.base_name.endswith(".parquet")), key=_place):
                self.files.setdefault(file.split("/")[1].removeprefix(STREAM + "="), []).append(file)
        self.listed_at = time.monotonic()

    def _rows(self, file: str) -> int:
        if file not in self.counts:
            fs, path = _open(self.root)
            with fs.open_input_file(f"{path}/{file}") as f:
                self.counts[file] = pq.ParquetFile(f).metadata.num_rows
        return self.counts[file]

    def _waiting(self, stream: str, start: dict | None, end: dict | None, most: int | None) -> Iterator[tuple[str, int, int]]:
        """Row ranges of a stream between two positions, ``most`` rows of them at most."""
        for file in self.files.get(stream, []):
            if start and _place(file) < _place(start["file"]):
                continue
            if most == 0 or (end and _place(file) > _place(end["file"])):
                return
            lo = start["row"] if start and file == start["file"] else 0
            hi = end["row"] if end and file == end["file"] else self._rows(file)
            if most is not None:
                hi = min(hi, lo + most)
                most -= hi - lo
            if hi > lo:
                yield file, lo, hi

    # -- the stream's interface ---------------------------------------------------------

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self._list()
        reach = self.limit if self.most == self.limit else self.most * CATCH_UP_PART
        waiting = {s: r for s in sorted(self.files) if (r := list(self._waiting(s, self.at.get(s), None, reach)))}
        total = sum(hi - lo for r in waiting.values() for _, lo, hi in r)
        if total == 0:
            self.held_since = None
            return self.at
        if self.wait and total < self.limit:
            self.held_since = time.monotonic() if self.held_since is None else self.held_since
            if time.monotonic() - self.held_since < self.wait:
                return self.at
        self.held_since = None
        limit = max(self.limit, min(self.most, total // CATCH_UP_PART))
        share = even_shares({s: sum(hi - lo for _, lo, hi in r) for s, r in waiting.items()}, limit, self.turn)
        # streams without waiting rows stand behind the last append, so that none before it is listed again
        end = {s: self.at[s] if s in waiting else {"file": self.known + "/", "row": 0} for s in self.at}
        for stream, rows in share.items():
            end.setdefault(stream, {"file": waiting[stream][0][0], "row": 0})
            for file, lo, hi in waiting[stream]:
                step = min(rows, hi - lo)
                if step:
                    end[stream] = {"file": file, "row": lo + step}
                rows -= step
        return dict(sorted(end.items()))

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = end  # on a restart Spark calls this with the last offset of the checkpoint
        if start == end:
            return []
        self.turn += self.limit
        self.listed_at = float("-inf")
        self._list()
        tasks, room = [], 0
        for stream in sorted(end):
            if start.get(stream) == end[stream]:
                continue
            for file, lo, hi in self._waiting(stream, start.get(stream), end[stream], None):
                while lo < hi:
                    if room == 0:
                        tasks.append([])
                        room = ROWS_PER_TASK
                    step = min(room, hi - lo)
                    tasks[-1].append((file, lo, lo + step))
                    lo, room = lo + step, room - step
        return [Slices(t) for t in tasks]

    def commit(self, end: dict) -> None:
        """Forget files that all is read of."""
        for stream, p in end.items():
            files = self.files.get(stream, [])
            keep = [f for f in files if _place(f) >= _place(p["file"])]
            for f in files[:len(files) - len(keep)]:
                self.counts.pop(f, None)
            self.files[stream] = keep

    def read(self, partition: Slices) -> Iterator[pa.RecordBatch]:
        fs, path = _open(self.root)
        want = to_arrow_schema(self.schema)
        for file, lo, hi in partition.ranges:
            with fs.open_input_file(f"{path}/{file}") as f:
                source, before = pq.ParquetFile(f), 0
                for group in range(source.metadata.num_row_groups):
                    n = source.metadata.row_group(group).num_rows
                    if before < hi and before + n > lo:
                        at = before
                        for batch in source.iter_batches(batch_size=10_000, row_groups=[group], columns=want.names):
                            part = batch.slice(max(0, lo - at), max(0, min(hi - at, batch.num_rows) - max(0, lo - at)))
                            at += batch.num_rows
                            if part.num_rows:
                                yield from pa.Table.from_batches([part]).select(want.names).cast(want, safe=False).to_batches()
                            if at >= hi:
                                break
                    before += n


def _place(file: str) -> tuple[str, float, float]:
    """Where a file stands in its stream; ``<append>/`` is behind all files of the append."""
    append, name = file[:10], file.rsplit("/", 1)[1]
    if not name:
        return append, float("inf"), 0
    part, c = re.match(r"part-(\d+)-.*?(?:[.-]c(\d+))?\.", name).groups()
    return append, int(part), int(c or 0)


def even_shares(waiting: dict[str, int], limit: int, turn: int = 0) -> dict[str, int]:
    """Rows for each stream: the same for all, but none more than it has. What is left of the
    division goes, a row each, to streams from the ``turn``-th on, so that with more streams
    than rows none waits for good."""
    level, left, sizes = 0, limit, sorted(waiting.values())
    for i, n in enumerate(sizes):
        step = min(n - level, left // (len(sizes) - i))
        full, level, left = level + step == n, level + step, left - step * (len(sizes) - i)
        if not full:
            break
    out = {s: min(n, level) for s, n in waiting.items()}
    more = [s for s in sorted(waiting) if waiting[s] > level]
    for i in range(min(left, len(more))):
        out[more[(turn + i) % len(more)]] += 1
    return out


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_log"

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(schema, {k.lower(): v for k, v in self.options.items()})


def read_log(spark: SparkSession, root: str, schema: StructType | str, rows_per_trigger: int = FLUSH_ROWS, max_wait_s: float = 0.0,
             catch_up_rows: int = 0) -> DataFrame:
    """Streaming frame of the log's rows, ``rows_per_trigger`` of them in a micro-batch at most;
    with ``max_wait_s`` (such as FLUSH_SECONDS) a smaller one only after so many seconds, with
    ``catch_up_rows`` (such as CATCH_UP_ROWS) up to so many behind a backlog."""
    spark.dataSource.register(MessageLog)
    return spark.readStream.format("message_log").schema(schema).option("rowsPerTrigger", int(rows_per_trigger)) \
        .option("maxWaitS", float(max_wait_s)).option("catchUpRows", int(catch_up_rows)).load(root)


def drain_query(query: StreamingQuery) -> StreamingQuery:
    """Let a running query go through all that the log holds now, in as many micro-batches as
    that takes, and stop it. Start it with a ``processingTime`` trigger of 0 seconds."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
