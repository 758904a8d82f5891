"""tickweave: market-microstructure operators on Spark DataFrames and Structured Streaming.

Every batch operator takes and returns a ``DataFrame``; see README.md for the catalogue.
"""

from tickweave.operators.gaps import close_jobs, detect_gaps, fill_gaps, gap_jobs, gap_pages, merge_recovered
from tickweave.operators.joins import asof_join, expected_work, incremental_rows, instrument_matrix
from tickweave.operators.normalize import (normalize_backfill, normalize_books, normalize_trades,
                                           parse_stream_key, stream_registry, symbol_forms, with_stream_key,
                                           with_trade_derived)
from tickweave.operators.quality import (apply_retention, audit, audit_attributes, batch_metrics, day_coverage,
                                         drop_nulls, error_counts, feed_health, for_instrument, fresh_quotes,
                                         id_between, last_ids, latest_by_key, missing_trades, on_day,
                                         stream_backlog, validate_trades)
from tickweave.operators.research import (best_lag, blend_weights, concat_history, evaluate, fit_ols, ic,
                                          impact_by_category, tca)
from tickweave.operators.series import dense_index, materialize
from tickweave.operators.windows import (cap_stream, first_n, latest_n, latest_row, positional_split,
                                         with_book_factors, with_ma_price, with_ofi, with_ofi_step, with_prev,
                                         with_targets, with_trade_seq)
from tickweave.session import get_spark, tune_partitions

__all__ = [
    "apply_retention", "asof_join", "audit", "audit_attributes", "batch_metrics", "best_lag", "blend_weights",
    "cap_stream", "close_jobs", "concat_history", "day_coverage", "dense_index", "detect_gaps", "drop_nulls",
    "error_counts", "evaluate", "expected_work", "feed_health", "fill_gaps", "first_n", "fit_ols",
    "for_instrument", "fresh_quotes", "gap_jobs", "gap_pages", "get_spark", "ic", "id_between",
    "impact_by_category", "incremental_rows", "instrument_matrix", "last_ids", "latest_by_key", "latest_n",
    "latest_row", "materialize", "merge_recovered", "missing_trades", "normalize_backfill", "normalize_books",
    "normalize_trades", "on_day", "parse_stream_key", "positional_split", "stream_backlog", "stream_registry",
    "symbol_forms", "tca", "tune_partitions", "validate_trades", "with_book_factors", "with_ma_price",
    "with_ofi", "with_ofi_step", "with_prev", "with_stream_key", "with_targets", "with_trade_derived",
    "with_trade_seq",
]
