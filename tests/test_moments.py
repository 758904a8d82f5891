"""Merged daily moments against fits over the rows."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickweave.operators import moments as mo
from tickweave.operators import research as rs
from tickweave.operators.quality import DAY_MS
from tickweave.plans.workflows import refit_day
from tickweave.schemas import INSTRUMENT

DAY0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp() * 1000)
LAGS = (5, 20)


@pytest.fixture(scope="module")
def factors(spark):
    """Days of unequal size, far from zero and with drifting means; nulls; a flat instrument."""
    f = spark.range(3000).select(
        F.lit("x").alias("exchange_id"), F.lit("swap").alias("mkt_type"),
        F.when(F.col("id") % 10 == 0, "FLAT").when(F.col("id") % 3 == 0, "A").otherwise("B").alias("symbol"),
        (F.lit(DAY0) + F.floor(F.sqrt("id") / 8) * DAY_MS).cast("long").alias("timestamp"),
        (F.lit(1e5) + F.sqrt("id") + F.rand(1)).alias(rs.X_VAMP), (F.rand(2) - F.col("id") / 500).alias(rs.X_OFI))
    f = f.withColumn(rs.X_VAMP, F.when(F.col("symbol") == "FLAT", 1.0).otherwise(F.col(rs.X_VAMP)))
    for L in LAGS:
        f = f.withColumn(f"target_{L}_tick", F.col(rs.X_VAMP) * 0.3 - F.col(rs.X_OFI) * L + F.rand(L))
    return f.withColumn("target_5_tick", F.when(F.rand(9) < 0.9, F.col("target_5_tick"))).cache()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_merged_days_fit_as_the_rows_do(spark, factors, tmp_path):
    path = str(tmp_path / "m")
    days = factors.withColumn("d", F.floor((F.col("timestamp") - DAY0) / DAY_MS))
    for lo, hi in ((0, 4), (4, 6), (6, 99)):
        mo.store_moments(mo.daily_moments(days.where((F.col("d") >= lo) & (F.col("d") < hi)), LAGS), path)
    fit = mo.fit_moments(mo.merge_moments(mo.load_moments(spark, path))).cache()
    for L in LAGS:
        y = f"target_{L}_tick"
        got = {r["symbol"]: r for r in fit.where(F.col("lag") == L).collect()}
        want = {r["symbol"]: r for r in rs.fit_ols(factors, y, by=INSTRUMENT).collect()}
        ok = factors.where(rs._nn(rs.X_VAMP, rs.X_OFI, y))
        ic = {r["symbol"]: r["ic"] for r in rs.ic(ok, rs.X_VAMP, y, by=INSTRUMENT).collect()}
        assert got.keys() == want.keys() == {"A", "B", "FLAT"}
        for s in got:
            assert got[s]["n"] == want[s]["n"] and close(got[s]["ic"], ic[s])
            for c in ("w_vamp", "w_ofi", "intercept"):
                # the intercept is 1e5 times as large as the errors of the weights
                assert close(got[s][c], want[s][c]) or (c == "intercept" and abs(got[s][c] - want[s][c]) < 1e-4), (s, c)
    assert got["FLAT"]["w_vamp"] is None and got["FLAT"]["ic"] is None
    best = {r["symbol"]: r["lag"] for r in mo.best_horizon(fit).collect()}
    by_ic = {s: max(LAGS, key=lambda L: (abs(next(r["ic"] for r in fit.collect() if r["symbol"] == s and r["lag"] == L)), -L)) for s in ("A", "B")}
    assert best == by_ic


def test_a_refit_reads_the_new_day_alone(spark, factors, tmp_path):
    path, books = str(tmp_path / "m"), str(tmp_path / "f")
    factors.withColumn("date", F.to_date(F.timestamp_millis("timestamp"))).write.partitionBy("date").parquet(books)
    dates = sorted(str(r[0]) for r in spark.read.parquet(books).select("date").distinct().collect())
    for d in [*dates, dates[2]]:  # a day computed again replaces itself
        today = spark.read.parquet(books).where(F.col("date") == F.lit(d).cast("date")).drop("date")
        m = mo.daily_moments(today, LAGS)
        assert re.search(rf"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ = {d}\)\]", plan(m))
        mo.store_moments(m, path)
    assert rows(mo.load_moments(spark, path).groupBy("lag").agg(F.sum("n"))) == \
        rows(mo.merge_moments(mo.daily_moments(factors, LAGS), ["lag"]).select("lag", "n"))
    part = mo.load_moments(spark, path, dates[1], dates[2])
    assert re.search(rf"PartitionFilters: \[isnotnull.*>= {dates[1]}.*<= {dates[2]}", plan(part))
    assert {str(r[0]) for r in part.select("date").distinct().collect()} == {dates[1], dates[2]}


def test_no_days_and_null_groups(spark, factors):
    assert mo.merge_moments(mo.daily_moments(factors.limit(0), LAGS)).count() == 0
    odd = factors.withColumn("mkt_type", F.lit(None).cast("string")).withColumn("timestamp", F.lit(None).cast("long"))
    got = mo.merge_moments(mo.daily_moments(odd, LAGS))
    assert got.where("lag = 20").agg(F.sum("n")).first()[0] == factors.count()


def test_refit_day_takes_the_best_horizon_of_the_kept_days(spark, factors, tmp_path):
    days = factors.withColumn("d", F.floor((F.col("timestamp") - DAY0) / DAY_MS))
    for keep in ("d < 5", "d >= 5", "d >= 5"):
        w = refit_day(days.where(keep), str(tmp_path / "m"), LAGS)
    got = {r["symbol"]: r for r in w.collect()}
    want = rs.fit_ols(factors, f"target_{got['A']['lag']}_tick", by=INSTRUMENT).where("symbol = 'A'").first()
    assert got["A"]["n"] == want["n"] and close(got["A"]["w_ofi"], want["w_ofi"]) and "FLAT" not in got
    total = sum(r["n"] for r in got.values())
    recent = refit_day(days.where("d >= 5"), str(tmp_path / "m"), LAGS, first_day="2024-01-06")
    assert 0 < recent.agg(F.sum("n")).first()[0] < total
