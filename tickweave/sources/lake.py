"""Raw and processed Parquet lakes (SRC-1..5, SRC-8).

Raw layout: ``<root>/<exchange>/<mkt>/<pair>/<type>/YYYY/MM/DD/<type>_YYYYMMDD_HH.parquet``.
The exchange, market and pair come from the path, read through ``_metadata.file_path``.

``write_raw`` writes this layout and the raw readers take bounds on instrument and time, which
become a path pattern: files outside it are neither listed nor opened.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions import keys as fk
from tickweave.functions import trade as ft
from tickweave.schemas import RAW_BOOK, RAW_TRADE


def lake_path(data_type: str, root: str = "data/raw") -> Column:
    """Raw-lake file path of a row from its instrument and ``timestamp`` (UTC hour file)."""
    t = ft.ms_to_utc("timestamp")
    return F.concat_ws("/", F.lit(root), F.col("exchange_id"), F.col("mkt_type"), fk.path_symbol("symbol"),
                       F.lit(data_type), F.date_format(t, "yyyy/MM/dd"),
                       F.concat(F.lit(data_type + "_"), F.date_format(t, "yyyyMMdd_HH"), F.lit(".parquet")))


def _path_parts(df: DataFrame, path_col: str) -> tuple[DataFrame, Column]:
    parts = F.split(F.col(path_col), "/")
    df = (df.withColumn("exchange", F.element_at(parts, -8))
          .withColumn("mkt_type", F.element_at(parts, -7))
          .withColumn("pair", F.element_at(parts, -6)))
    return df, F.element_at(parts, -1)


def with_trade_path_cols(df: DataFrame, path_col: str = "file_path") -> DataFrame:
    """SRC-4: exchange [-8], mkt_type [-7], pair [-6] of the path; ``trade_date`` = 8 chars
    from position 8 of the file name, ``hour`` = 2 chars from position 17."""
    df, name = _path_parts(df, path_col)
    return (df.withColumn("trade_date", F.to_date(F.substring(name, 8, 8), "yyyyMMdd"))
            .withColumn("hour", F.substring(name, 17, 2)))


def with_book_path_cols(df: DataFrame, path_col: str = "file_path") -> DataFrame:
    """SRC-5: same path parts; ``orderbook_date`` = 8 chars from position -19 of the file
    name, ``hour`` = 2 chars from -10 (``..._YYYYMMDD_HH.parquet``)."""
    df, name = _path_parts(df, path_col)
    return (df.withColumn("orderbook_date", F.to_date(F.substring(name, -19, 8), "yyyyMMdd"))
            .withColumn("hour", F.substring(name, -10, 2)))


HOUR_MS, DAY_HOURS = 3_600_000, 24
#: Renames under way at a time.
MOVERS = 16


def hour_pattern(data_type: str, start_ms: int | None, end_ms: int | None) -> str:
    """Glob of the files, below ``<type>/``, that can hold times in [start_ms, end_ms): whole
    days by their folder, the hours of days that are cut one by one."""
    if start_ms is None and end_ms is None:
        return "*/*/*/*.parquet"
    if start_ms is None or end_ms is None:
        raise ValueError("give both ends of the time range")
    hour, last, found = start_ms // HOUR_MS, (end_ms - 1) // HOUR_MS, []
    while hour <= last:
        t = dt.datetime.fromtimestamp(hour * 3600, dt.UTC)
        if t.hour == 0 and hour + DAY_HOURS - 1 <= last:
            found.append(f"{t:%Y/%m/%d}/*.parquet")
            hour += DAY_HOURS
        else:
            found.append(f"{t:%Y/%m/%d}/{data_type}_{t:%Y%m%d_%H}.parquet")
            hour += 1
    return "{" + ",".join(found) + "}"


def _read_raw(spark: SparkSession, root: str, data_type: str, schema, exchange: str = "*", mkt_type: str = "*", symbol: str = "*",
              start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    bounded = start_ms is not None or end_ms is not None
    empty = spark.createDataFrame([], schema).withColumn("file_path", F.lit(None).cast("string"))
    glob = f"{root.rstrip('/')}/{exchange}/{mkt_type}/{symbol.replace('/', '-')}/{data_type}/{hour_pattern(data_type, start_ms, end_ms)}"
    if bounded and end_ms <= start_ms:
        return empty
    try:
        df = spark.read.schema(schema).parquet(glob)
    except AnalysisException as e:
        if not bounded or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    df = df.withColumn("file_path", F.col("_metadata.file_path"))
    return df.where((F.col("timestamp") >= start_ms) & (F.col("timestamp") < end_ms)) if bounded else df


def write_raw(df: DataFrame, root: str, data_type: str) -> DataFrame:
    """Write trades (``data_type`` ``trades``) or books (``orderbook``) into the raw lake, a file
    an instrument and hour, sorted by time; returns the rows that have no place there, because
    exchange, market, symbol or timestamp is null.

    ``df`` needs ``mkt_type`` besides the columns of the raw schema. An hour is written by one
    task, as its one file asks for, and replaces a file of that name; so a run that was killed
    is made good by running it again. Files are written aside and moved by the driver, which
    sees their names only."""
    spark = df.sparkSession
    schema = RAW_TRADE if data_type == "trades" else RAW_BOOK
    placed = F.col("exchange_id").isNotNull() & F.col("mkt_type").isNotNull() & F.col("symbol").isNotNull() & F.col("timestamp").isNotNull()
    rows = [F.col(f.name).cast(f.dataType) for f in schema.fields]
    stage = f"{root.rstrip('/')}/_raw-{uuid.uuid4().hex}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a number keeps AQE from joining them: the cost is files, not bytes
    df.where(placed).select(*rows, lake_path(data_type, "-").alias("_file")) \
        .repartition(tasks, "_file").sortWithinPartitions("_file", "timestamp").write.partitionBy("_file").parquet(stage)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(stage).getFileSystem(spark._jsc.hadoopConfiguration())

    def move(folder) -> None:
        target = path(root.rstrip("/") + "/" + unquote(folder.getName()).split("=-/", 1)[1])
        parts = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise OSError(f"{folder} has {len(parts)} files instead of one")
        if not fs.mkdirs(target.getParent()) or (fs.exists(target) and not fs.delete(target, False)) or not fs.rename(parts[0], target):
            raise OSError(f"{target} can't be moved into place")

    with ThreadPoolExecutor(MOVERS) as movers:
        list(movers.map(move, [f.getPath() for f in fs.listStatus(path(stage)) if f.isDirectory()]))
    if not fs.delete(path(stage), True):
        raise OSError(f"{stage} can't be removed")
    return df.where(~placed)


def read_raw_trades(spark: SparkSession, root: str, exchange: str = "*", mkt_type: str = "*", symbol: str = "*",
                    start_ms: int | None = None, end_ms: int | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-1 + SRC-4: raw trade lake -> (trades with path columns, rows with a bad id).

    ``trade_id`` is text in the lake: parsed with ``try_cast``; unparsable rows are
    quarantined instead of failing the job. ``mkt_type`` comes from the path. Bounds on the
    instrument and on time, [start_ms, end_ms), choose the files; none of them gives no rows.
    """
    df = with_trade_path_cols(_read_raw(spark, root, "trades", RAW_TRADE, exchange, mkt_type, symbol, start_ms, end_ms))
    df = (df.withColumn("trade_id_raw", F.col("trade_id"))
          .withColumn("trade_id", F.col("trade_id").try_cast("long")))
    return df.where(F.col("trade_id").isNotNull()), df.where(F.col("trade_id").isNull())


def read_raw_books(spark: SparkSession, root: str, exchange: str = "*", mkt_type: str = "*", symbol: str = "*",
                   start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """SRC-2 + SRC-5 + FEA-1..3: raw book lake with path columns and top-of-book features;
    bounds as in ``read_raw_trades``."""
    from tickweave.functions import book as fb
    df = with_book_path_cols(_read_raw(spark, root, "orderbook", RAW_BOOK, exchange, mkt_type, symbol, start_ms, end_ms))
    return (df.withColumn("micro_price", fb.micro_price()).withColumn("imbalance", fb.imbalance())
            .withColumn("spread", fb.spread()))


def read_processed(spark: SparkSession, root: str, data_type: str) -> DataFrame:
    """SRC-3: processed feature lake written by ``export_daily`` (hive partitions
    exchange_id / mkt_type / pair / data_type / date), with ``orderbook_date`` and ``hour``
    derived for readers of the declared layout."""
    df = spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/exchange_id=*/mkt_type=*/pair=*/"
                                                    f"data_type={data_type}")
    return (df.withColumn("orderbook_date", F.col("date"))
            .withColumn("hour", F.hour(F.col("dt")).cast("int")))


def load_history(spark: SparkSession, root: str, exchange_id: str, mkt_type: str, symbol: str,
                 days: int) -> DataFrame:
    """SRC-8: the ``days`` newest daily partitions of one instrument's processed books,
    pruned to six columns plus ``mid_price``.

    The newest dates come from a distinct over the partition column (``days`` rows), then
    a broadcast semi join on ``date`` lets dynamic partition pruning skip older files.
    """
    from tickweave.functions import book as fb
    df = read_processed(spark, root, "orderbook").where(
        (F.col("exchange_id") == exchange_id) & (F.col("mkt_type") == mkt_type)
        & (F.col("pair") == symbol.replace("/", "-")))
    newest = df.select("date").distinct().orderBy(F.col("date").desc()).limit(days)
    df = df.join(F.broadcast(newest), "date", "left_semi")
    return df.select("timestamp", "symbol", "bid_prices", "bid_volumes", "ask_prices", "ask_volumes",
                     fb.mid_price().alias("mid_price"), "nonce")
