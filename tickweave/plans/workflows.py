"""User-level compositions (PIP-1..7): one DataFrame job for all instruments at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions import book as fb
from tickweave.functions import trade as ft
from tickweave.operators import gaps as gp
from tickweave.operators import moments as mo
from tickweave.operators import quality as q
from tickweave.operators import research as rs
from tickweave.operators import windows as win
from tickweave.operators.joins import incremental_rows
from tickweave.schemas import INSTRUMENT, VENUE_SYMBOL

TRADE_EXPORT_COLS = ["trade_id", "trade_id_raw", "symbol", "mkt_type", "exchange_id", "dt", "price", "amount",
                     "turnover", "side", "is_taker_buyer", "sub_ms_seq", "ma_price_100", "is_high_impact",
                     "timestamp"]
BOOK_EXPORT_COLS = ["nonce", "symbol", "mkt_type", "exchange_id", "dt", "micro_price", "imbalance", "spread",
                    "bid_prices", "bid_volumes", "ask_prices", "ask_volumes", "timestamp"]


def _days(df: DataFrame, date: str | None, now_ms: int | None = None) -> DataFrame:
    if date:
        return q.on_day(df, date)
    if now_ms is not None:
        return q.on_automated_day(df, now_ms)
    return df


def consolidate_trades(trades: DataFrame, date: str | None = None, layout: str | None = None,
                       block_rows: int | None = None, now_ms: int | None = None) -> DataFrame:
    """PIP-2, trades: day filter -> latest version per key -> turnover, UTC time, per-day
    sequence number and 101-row moving price, high-impact flag; plus the ``date`` column.

    With ``date=None`` and ``now_ms`` the scheduled run's days are used (yesterday, two days
    back for okx); with neither, every day is done in the same job (windows per instrument
    and day).
    """
    from tickweave.operators import series
    t = _days(trades, date, now_ms).withColumn("date", ft.utc_date("timestamp"))
    by = INSTRUMENT + ["date"]
    lay = series.layout(t, layout)
    if lay == "key":
        # one exchange on (exchange, symbol, day) serves the version dedup (its keys include
        # them; date is a function of timestamp) and both windows
        t = t.repartition("exchange_id", "symbol", "date")
        t = q.latest_by_key(t, q.TRADE_KEY + ["date"])
    else:
        t = q.latest_by_key(t, q.TRADE_KEY + ["date"], pre_partition=["exchange_id", "symbol", "trade_id"])
    # one ordered pass gives both the moving price and the row position (sub_ms_seq)
    t = win.with_ma_price(t, n=100, by=by, layout=lay, block_rows=block_rows, keep_index=("_i", "_cnt"))
    t = t.withColumn("sub_ms_seq", F.col("_i") + F.lit(1)).drop("_i", "_cnt")
    t = (t.withColumn("dt", ft.ms_to_utc("timestamp"))
         .withColumn("turnover", ft.turnover())
         .withColumn("is_high_impact", ft.is_high_impact()))
    return t.select(*TRADE_EXPORT_COLS, "date")


def consolidate_books(books: DataFrame, date: str | None = None, depth: int = 20,
                      now_ms: int | None = None) -> DataFrame:
    """PIP-2, books: day filter -> latest version -> micro price, imbalance, spread, top
    ``depth`` levels, UTC time; plus ``date``."""
    b = q.latest_by_key(_days(books, date, now_ms), q.BOOK_KEY, pre_partition=["exchange_id", "symbol", "timestamp", "nonce"])
    return b.select(
        "nonce", "symbol", "mkt_type", "exchange_id", ft.ms_to_utc("timestamp").alias("dt"),
        fb.micro_price().alias("micro_price"), fb.imbalance().alias("imbalance"), fb.spread().alias("spread"),
        *[fb.top_levels(c, depth).alias(c) for c in ("bid_prices", "bid_volumes", "ask_prices", "ask_volumes")],
        "timestamp", ft.utc_date("timestamp").alias("date"))


def consolidate_day(trades: DataFrame, books: DataFrame, root: str, date: str | None = None,
                    now_ms: int | None = None) -> None:
    """PIP-2 with the export (SNK-3): both feature tables written, re-run safe."""
    from tickweave.sources.sinks import export_daily
    export_daily(consolidate_trades(trades, date, now_ms=now_ms), root, "trades")
    export_daily(consolidate_books(books, date, now_ms=now_ms), root, "orderbook")


def patch_day(official: DataFrame, local: DataFrame, expected: DataFrame, date: str, now_ms: int,
              by: Sequence[str] = VENUE_SYMBOL) -> dict[str, DataFrame]:
    """PIP-1: validate the archive, coverage per instrument, rows to insert, the patched
    table, audits and health.

    The local side is the whole table, restricted by the archive's ids and not by the day,
    so an id held under another day is not inserted again. Rows with a bad price are never
    inserted; ``bad_rows`` has them, and the audit counts them as missing."""
    off = q.on_day(official, date)
    bad, report = q.validate_trades(off, by=list(by))
    coverage = q.day_coverage(q.on_day(local, date), expected, date, by)
    good = off.where(F.coalesce(F.col("price") > F.lit(0.0), F.lit(True)))
    to_insert = q.missing_trades(good, local, by)
    patched = gp.merge_recovered(local, to_insert)
    audit = q.audit(off, patched, by)
    attrs = q.audit_attributes(off, patched, by)
    health = q.feed_health(patched, audit, now_ms, by)
    return {"bad_rows": bad, "report": report, "coverage": coverage, "to_insert": to_insert,
            "patched": patched, "audit": audit, "attributes": attrs, "health": health}


def daily_pipeline(official: DataFrame, local: DataFrame, books: DataFrame, expected: DataFrame,
                   date: str, now_ms: int, root: str) -> dict[str, DataFrame]:
    """PIP-3: PIP-1 then PIP-2 on the patched table; stops (raises) on an invalid archive."""
    out = patch_day(official, local, expected, date, now_ms)
    if not out["bad_rows"].isEmpty():
        raise ValueError("archive has prices <= 0; patch stopped")
    consolidate_day(out["patched"], books, root, date)
    return out


def heal(local: DataFrame, backfill: DataFrame, active: DataFrame | None, now_ms: int,
         by: Sequence[str] = VENUE_SYMBOL) -> dict[str, DataFrame]:
    """PIP-4: detect gaps -> new jobs -> pages -> fill from backfill -> merge -> close jobs."""
    gaps = gp.detect_gaps(local, by)
    jobs = gp.gap_jobs(gaps, active, now_ms)
    pages = gp.gap_pages(jobs)
    recovered, report = gp.fill_gaps(jobs, backfill, by)
    merged = gp.merge_recovered(local, recovered)
    done = report.where(F.col("n_missing") == 0).withColumn("job_id", F.md5(
        F.concat_ws(":", "exchange_id", "symbol", F.col("start_id").cast("string"), F.col("end_id").cast("string"))))
    still_active = gp.close_jobs(active, done) if active is not None else None
    return {"gaps": gaps, "jobs": jobs, "pages": pages, "recovered": recovered, "report": report,
            "merged": merged, "active": still_active}


def replicate(remote_trades: DataFrame, local_trades: DataFrame, remote_books: DataFrame | None = None,
              local_books: DataFrame | None = None) -> dict[str, DataFrame]:
    """PIP-5: rows to copy per table (above the local high-water mark of each instrument)."""
    out = {"trades": incremental_rows(remote_trades, local_trades, INSTRUMENT, "trade_id")}
    if remote_books is not None and local_books is not None:
        out["orderbook"] = incremental_rows(remote_books, local_books, INSTRUMENT, "nonce")
    return out


def train_alpha(books: DataFrame, old_weights: DataFrame | None = None, lags=win.DEFAULT_LAGS,
                split: float = 0.7, alpha: float = 0.2, on_gate_fail: str = "reference",
                layout: str | None = None) -> dict[str, DataFrame]:
    """PIP-6: factors and labels -> best lag -> honest evaluation -> weights -> blend, all by
    instrument, so the venues of one symbol keep their own weights.

    ``on_gate_fail='reference'`` blends the zero weights of a failed gate like the
    reference does; ``'keep'`` keeps the old record for those instruments.
    """
    from tickweave.operators.series import materialize
    f = win.with_book_factors(books, lags=lags, layout=layout, keep_index=("_i", "_cnt"))
    f = materialize(f.drop("bid_prices", "bid_volumes", "ask_prices", "ask_volumes"))  # no later step reads the depth
    best = rs.best_lag(f, lags, split)
    ev = rs.evaluate(f, best=best, lags=lags, split=split)
    new = ev.select(*INSTRUMENT, "w_vamp", "w_ofi", "intercept", "best_lag", "passed")
    if on_gate_fail == "keep" and old_weights is not None:
        new = new.where("passed")
    blended = rs.blend_weights(old_weights, new.drop("passed"), alpha)
    if on_gate_fail == "keep" and old_weights is not None:
        blended = blended.unionByName(old_weights.select(*blended.columns)
                                      .join(new.select(*INSTRUMENT), INSTRUMENT, "left_anti"))
    return {"factors": f, "best_lag": best, "evaluation": ev, "weights": blended}


def refit_day(factors_today: DataFrame, path: str, lags=win.DEFAULT_LAGS, first_day: str | None = None) -> DataFrame:
    """PIP-6 day by day: the moments of ``factors_today`` join those kept at ``path``, and weights
    at the best horizon come from all kept days since ``first_day``. Only today's rows are
    read; a day run again replaces its records, so use the returned rows before that."""
    mo.store_moments(mo.daily_moments(factors_today, lags), path)
    return mo.best_horizon(mo.fit_moments(mo.merge_moments(mo.load_moments(factors_today.sparkSession, path, first_day))))


def tca(trades: DataFrame, books: DataFrame, max_lag_ms: int = 100, layout: str | None = None):
    """PIP-7: as-of join -> fresh quotes -> slippage and size category -> AGG-4."""
    return rs.tca(trades, books, max_lag_ms, layout=layout)
