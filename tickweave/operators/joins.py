"""As-of join, incremental replication and the expected-work matrix (JON-4, JON-5, JON-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.operators import series
from tickweave.schemas import INSTRUMENT, VENUE_SYMBOL


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str] = VENUE_SYMBOL,
              left_ts: str = "timestamp", right_ts: str = "timestamp",
              right_cols: Sequence[str] | None = None, prefix: str = "ob_",
              left_tie: Sequence[str] = (), right_tie: Sequence[str] = ("nonce",),
              lag_col: str = "data_lag_ms", layout: str | None = None,
              bin_ms: int = series.DEFAULT_BIN_MS) -> DataFrame:
    """JON-4: as-of LEFT join: each left row gets the latest right row of the same ``by``
    with ``right_ts <= left_ts`` (ties on time: right rows count as earlier; among equal
    right times the greatest ``right_tie`` wins, then a hash of the row), plus
    ``lag_col = left_ts - right_ts``. Every left row comes out exactly once.

    Both sides are unioned into one time line and the last right row is carried forward.
    Blocked layout: the time line is cut into bins of ``bin_ms``. The last right row of each
    (by, bin) is one partial aggregate; carried forward over the bins it enters each bin that
    has left rows as one more right row, so a window over (by, bin) finds every match: one
    shuffle of each side and no join. ``layout='key'`` uses one window per instrument.
    Right columns come back prefixed with ``prefix``.
    """
    by = list(by)
    right = right.where(F.col(right_ts).isNotNull())  # a quote without a time is before no trade
    rcols = list(right_cols) if right_cols is not None else [c for c in right.columns if c not in by]
    lt, rt = list(left_tie), list(right_tie)
    ties = [f"_t{i}" for i in range(max(len(lt), len(rt)))]

    def tie_vals(cols: list[str]) -> list:
        return [F.col(cols[i]).cast("long").alias(t) if i < len(cols) else F.lit(None).cast("long").alias(t)
                for i, t in enumerate(ties)]

    # one time line: left rows carry their columns in _l, right rows theirs in _r
    l_struct = F.struct(*left.columns)
    r_struct = F.struct(*[F.col(c).alias(prefix + c) for c in rcols], F.col(right_ts).alias("_rts"))
    l_none, r_none = (F.lit(None).cast(_struct_type(df, x)) for df, x in ((left, l_struct), (right, r_struct)))
    L = left.select(*by, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), *tie_vals(lt), series.tie_break(left).alias("_tie"),
                    l_struct.alias("_l"), r_none.alias("_r"))
    R = right.select(*by, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), *tie_vals(rt), series.tie_break(right).alias("_tie"),
                     l_none.alias("_l"), r_struct.alias("_r"))
    order = ["_ts", "_side", *ties, "_tie"]
    if series.layout(L.unionByName(R), layout) == "key":
        u, group = L.unionByName(R), by
    else:
        group = [*by, "_bin"]
        cut = series.bin_of(L, "_ts", bin_ms)
        L, R = L.withColumn("_bin", cut), R.withColumn("_bin", cut)
        last = R.groupBy(*group).agg(F.max_by(F.struct("_ts", "_side", *ties, "_tie", "_r"), F.struct(*order)).alias("_last"))
        bins = last.unionByName(L.select(*group).distinct(), allowMissingColumns=True).groupBy(*group).agg(
            F.first("_last", ignorenulls=True).alias("_last"), F.max(F.col("_last").isNull()).alias("_asked"))
        earlier = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        carried = bins.withColumn("_last", F.last("_last", ignorenulls=True).over(earlier)).where("_asked and _last is not null") \
            .select(*group, "_last.*", l_none.alias("_l"))
        u = L.unionByName(R).unionByName(carried)
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    m = u.withColumn("_q", F.last("_r", ignorenulls=True).over(w)).where(F.col("_side") == 1)
    return m.select("_l.*", *[F.col("_q." + prefix + c).alias(prefix + c) for c in rcols],
                    (F.col("_ts") - F.col("_q._rts")).alias(lag_col))


def _struct_type(df: DataFrame, struct_col):
    return df.select(struct_col.alias("s")).schema["s"].dataType


def incremental_rows(remote: DataFrame, local: DataFrame, by: Sequence[str] = INSTRUMENT,
                     id_col: str = "trade_id") -> DataFrame:
    """JON-5: remote rows with an id above the local high-water mark of their instrument.

    Instruments absent locally are not copied. The mark table has one row per instrument;
    the join takes whatever form its measured size allows.
    """
    by = list(by)
    hwm = local.groupBy(*by).agg(F.max(id_col).alias("_hwm"))
    return remote.join(hwm, by, "inner").where(F.col(id_col) > F.col("_hwm")).drop("_hwm")


def instrument_matrix(spark: SparkSession, exchanges: Sequence[str], mkt_types: Sequence[str],
                      symbols: Sequence[str], data_types: Sequence[str] = ("orderbook", "trades")) -> DataFrame:
    """JON-7: every exchange x market x symbol x type from configured lists (one row, exploded)."""
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    return (spark.range(1)
            .select(F.explode(arr(exchanges)).alias("exchange_id"))
            .withColumn("mkt_type", F.explode(arr(mkt_types)))
            .withColumn("symbol", F.explode(arr(symbols)))
            .withColumn("data_type", F.explode(arr(data_types))))


def expected_work(instruments: DataFrame, data_types: Sequence[str] = ("orderbook", "trades")) -> DataFrame:
    """JON-7 over data: each distinct instrument once per data type."""
    return (instruments.select(*INSTRUMENT).distinct()
            .withColumn("data_type", F.explode(F.array(*[F.lit(t) for t in data_types]))))
