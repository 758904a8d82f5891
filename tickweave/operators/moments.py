"""Daily moments of the factor regression, kept and merged (AGG-5..7, PIP-6).

A refit over weeks of books need not read weeks of books: for each (instrument, day,
horizon) ``daily_moments`` keeps the count, means and central (co)variances of two factors
and the forward return, some ten numbers, and any set of days is merged by the parallel
covariance rule

    n = sum n_d,   m = sum n_d m_d / n,   C = sum n_d (c_d + (mx_d - mx)(my_d - my)) / n

around the merged means, so nothing cancels as it would between sums of squares. Weights, IC
and best horizon of the merged moments are those of the rows to rounding (1e-9 in the tests).

A forward return looks ahead by up to the horizon. Rows of a day whose return ends on the
next day have it only if the caller's frame reached there; either compute factors by day, or
give the day's rows labels from the next day's first books.

Edge cases: rows with a null among the three columns don't count; a NaN does and makes the
moments NaN; days without a counted row have no record and days whose rows have a null
timestamp stand in a null day of their own; no days give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions import trade as ft
from tickweave.operators import research as rs
from tickweave.operators.windows import DEFAULT_LAGS
from tickweave.schemas import INSTRUMENT

_MEANS = ("m1", "m2", "my")
_SQUARES = {"v1": ("m1", "m1"), "v2": ("m2", "m2"), "vy": ("my", "my"),
            "c12": ("m1", "m2"), "c1y": ("m1", "my"), "c2y": ("m2", "my")}
MOMENTS = ["n", *_MEANS, *_SQUARES]


def daily_moments(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, by: Sequence[str] = INSTRUMENT,
                  xs: Sequence[str] = (rs.X_VAMP, rs.X_OFI), ts: str = "timestamp") -> DataFrame:
    """One row per (``by``, day, lag) from factor rows with ``target_{lag}_tick``: a single
    aggregate with map-side partials, whatever the number of lags."""
    tags = {L: f"l{L}" for L in lags}
    aggs = [a for L in lags for a in rs._moments(rs._nn(*xs, f"target_{L}_tick"), f"target_{L}_tick", xs, tags[L])]
    g = df.withColumn("date", ft.utc_date(ts)).groupBy(*by, "date").agg(*aggs)
    per_lag = F.array(*[F.struct(F.lit(L).alias("lag"), *[F.col(f"{m}_{t}").alias(m) for m in MOMENTS]) for L, t in tags.items()])
    return g.select(*by, "date", F.explode(per_lag).alias("r")).select(*by, "date", "r.*").where("n > 0")


def merge_moments(moments: DataFrame, by: Sequence[str] = (*INSTRUMENT, "lag")) -> DataFrame:
    """The moments of all rows behind ``moments``, one row per ``by``. Two aggregates over the
    records; of data-sized input there is none."""
    by = list(by)
    n = F.col("n")
    means = moments.groupBy(*by).agg(F.sum("n").alias("_n"), *[(F.sum(n * F.col(m)) / F.sum("n")).alias(f"_{m}") for m in _MEANS])
    same = [F.col(f"a.{b}").eqNullSafe(F.col(f"b.{b}")) for b in by]
    j = moments.alias("a").join(means.alias("b"), same, "inner").select("a.*", "_n", *[f"_{m}" for m in _MEANS])
    around = [F.sum(n * (F.col(c) + (F.col(x) - F.col(f"_{x}")) * (F.col(y) - F.col(f"_{y}")))).alias(c) for c, (x, y) in _SQUARES.items()]
    g = j.groupBy(*by).agg(F.first("_n").alias("n"), *[F.first(f"_{m}").alias(m) for m in _MEANS], *around)
    return g.select(*by, "n", *_MEANS, *[(F.col(c) / n).alias(c) for c in _SQUARES])


def fit_moments(merged: DataFrame, by: Sequence[str] = (*INSTRUMENT, "lag"),
                xs: Sequence[str] = (rs.X_VAMP, rs.X_OFI)) -> DataFrame:
    """Weights, intercept and n as ``fit_ols`` gives them, with the IC of the first factor and of
    the fitted signal, from merged moments."""
    m = merged.select(*by, *[F.col(c).alias(f"{c}_all") for c in MOMENTS])
    o, names = rs._ols_cols("all"), rs._weight_names(xs)
    return m.select(*by, o["b1"].alias(names[0]), o["b2"].alias(names[1]), o["a"].alias("intercept"),
                    rs._corr_from(F.col("c1y_all"), F.col("v1_all"), F.col("vy_all")).alias("ic"),
                    rs._pred_ic(o["b1"], o["b2"], "all").alias("fit_ic"), F.col("n_all").alias("n"))


def best_horizon(fitted: DataFrame, by: Sequence[str] = INSTRUMENT) -> DataFrame:
    """The row of the lag with the largest |ic| per instrument, the smaller lag on ties."""
    rest = [c for c in fitted.columns if c not in by]
    g = fitted.where(F.col("ic").isNotNull()).groupBy(*by).agg(
        F.max_by(F.struct(*rest), F.struct(F.abs("ic"), -F.col("lag"))).alias("r"))
    return g.select(*by, *[F.col(f"r.{c}").alias(c) for c in rest])


def store_moments(moments: DataFrame, path: str) -> None:
    """Write records by day; only the days in ``moments`` are replaced, so that a day can be
    computed again. A day's records are one small file."""
    (moments.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def load_moments(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Records of the days from ``first_day`` to ``last_day``: a bound on the partition column."""
    m = spark.read.parquet(path)
    for day, keep in ((first_day, F.col("date") >= F.lit(first_day).cast("date")), (last_day, F.col("date") <= F.lit(last_day).cast("date"))):
        if day is not None:
            m = m.where(keep)
    return m
