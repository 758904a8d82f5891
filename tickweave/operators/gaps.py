"""Trade-id sequence gaps: detect, dispatch, page, fill, merge (GAP-1..4, JON-6, SET-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.keys import gap_job_id
from tickweave.operators import windows
from tickweave.operators.quality import TRADE_KEY, latest_by_key
from tickweave.schemas import VENUE_SYMBOL

PAGE_SIZE = 1000
FILL_BUCKET = 1000


def detect_gaps(df: DataFrame, by: Sequence[str] = VENUE_SYMBOL, id_col: str = "trade_id",
                layout: str | None = None, block_rows: int | None = None) -> DataFrame:
    """GAP-1: interior holes of each id sequence as ``[start_id, end_id]``.

    Ordered by id per group; where ``id - previous id > 1`` the hole is
    ``[previous + 1, id - 1]``. Duplicate ids emit nothing. The lag runs on the blocked
    layout (one row of halo), so a hot instrument is spread over many tasks.
    """
    by = list(by)
    x = windows.with_prev(df.select(*by, id_col), id_col, by, [id_col], out="_prev",
                          layout=layout, block_rows=block_rows)
    return (x.where(F.col(id_col) - F.col("_prev") > F.lit(1))
            .select(*by, (F.col("_prev") + F.lit(1)).alias("start_id"),
                    (F.col(id_col) - F.lit(1)).alias("end_id")))


def gap_jobs(gaps: DataFrame, active: DataFrame | None = None, now_ms: int | None = None,
             ttl_s: int = 3600) -> DataFrame:
    """GAP-2: gaps as jobs with ``job_id`` (md5 of exchange:symbol:start:end), minus jobs
    already dispatched less than ``ttl_s`` seconds before ``now_ms``.

    ``active`` has ``job_id`` and ``dispatched_ms``.
    """
    jobs = gaps.withColumn("job_id", gap_job_id())
    if active is not None:
        live = active
        if now_ms is not None:
            live = active.where(F.col("dispatched_ms") > F.lit(now_ms - ttl_s * 1000))
        jobs = jobs.join(live.select("job_id"), "job_id", "left_anti")
    return jobs.select(*[c for c in gaps.columns], "job_id")


def gap_pages(gaps: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """GAP-3: cut every gap into pages of ``size`` ids: ``[page_start, page_end]``."""
    start = F.explode(F.sequence(F.col("start_id"), F.col("end_id"), F.lit(size).cast("long")))
    x = gaps.select("*", start.alias("page_start"))
    return x.withColumn("page_end", F.least(F.col("page_start") + F.lit(size - 1), F.col("end_id")))


def close_jobs(active: DataFrame, done: DataFrame) -> DataFrame:
    """GAP-4: active jobs that are not finished."""
    return active.join(done.select("job_id"), "job_id", "left_anti")


def _matches(gaps: DataFrame, backfill: DataFrame, by: list[str], id_col: str, bucket: int,
             coarse: int, how: str) -> DataFrame:
    """Backfill rows joined to the gaps containing them, one scan of each side.

    Each gap becomes one row per id bucket it touches, so the range join is an equi-join on
    (instrument, bucket size, bucket) plus a BETWEEN: a hash join, not a nested loop. Gaps up
    to ``coarse`` ids wide use ``bucket``-sized buckets, wider ones ``coarse``-sized ones, so
    a gap never becomes more than about ``coarse / bucket`` rows and a bucket never holds more
    than ``coarse`` ids; a backfill row has one bucket of either size."""
    size = F.when(F.col("end_id") - F.col("start_id") < F.lit(coarse), F.lit(int(bucket))).otherwise(F.lit(int(coarse))).cast("long")
    gb = gaps.select(*by, "start_id", "end_id", size.alias("_size")).withColumn(
        "_bkt", F.explode(F.sequence(F.expr("start_id DIV _size"), F.expr("end_id DIV _size"))))
    sizes = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in (bucket, coarse)]))
    bf = backfill if how == "left_semi" else backfill.select(*by, id_col)
    bf = bf.withColumn("_size", sizes).withColumn("_bkt", F.expr(f"`{id_col}` DIV _size"))
    on = [bf[c] == gb[c] for c in [*by, "_size", "_bkt"]] + [bf[id_col].between(gb["start_id"], gb["end_id"])]
    if how == "left_semi":
        return bf.join(gb, on, "left_semi").drop("_size", "_bkt")
    return bf.join(gb, on, "inner").select(*[bf[c] for c in by], gb["start_id"], gb["end_id"], bf[id_col])


def fill_gaps(gaps: DataFrame, backfill: DataFrame, by: Sequence[str] = VENUE_SYMBOL,
              id_col: str = "trade_id", bucket: int = FILL_BUCKET,
              coarse: int = FILL_BUCKET * 1000) -> tuple[DataFrame, DataFrame]:
    """JON-6: (backfill rows whose id lies inside a gap of the same instrument, per-gap report).

    The report has ``n_expected``, ``n_recovered`` and ``n_missing`` ids per gap.
    Every backfill row is returned at most once (left semi join; gaps do not overlap).
    """
    by = list(by)
    recovered = _matches(gaps, backfill, by, id_col, bucket, coarse, "left_semi")
    hits = (_matches(gaps, backfill, by, id_col, bucket, coarse, "inner")
            .groupBy(*by, "start_id", "end_id").agg(F.count_distinct(id_col).alias("n_recovered")))
    report = (gaps.select(*by, "start_id", "end_id").join(hits, by + ["start_id", "end_id"], "left")
              .withColumn("n_expected", F.col("end_id") - F.col("start_id") + F.lit(1))
              .withColumn("n_recovered", F.coalesce("n_recovered", F.lit(0)).cast("long"))
              .withColumn("n_missing", F.col("n_expected") - F.col("n_recovered")))
    return recovered, report


def merge_recovered(table: DataFrame, recovered: DataFrame, key: Sequence[str] = TRADE_KEY,
                    version: str = "local_timestamp") -> DataFrame:
    """SET-2: recovered rows merged into the table, versions resolved by AGG-1."""
    return latest_by_key(table.unionByName(recovered.select(*table.columns)), key, version)
