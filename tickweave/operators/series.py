"""Ordered per-instrument series at scale: dense row index and blocked (halo) windows.

A window ``partitionBy(instrument)`` puts a whole instrument into one task; with a hot
instrument holding a third of all rows that task is the job. Instead:

1. Rows are binned by their first order column (``bin_width`` ids or milliseconds). The
   histogram of (key, bin) is one small aggregate over two columns; its prefix sums give the
   number of rows before each bin.
2. ``dense_index``: every row gets its exact 0-based position inside its key: rows before
   its bin plus its rank inside the bin. A window holds one bin of one key.
3. ``blocked_window``: rows are cut into blocks of ``B`` consecutive positions; the last
   ``lookback`` rows of a block are copied into the next block and the first ``lookahead``
   rows into the previous one. An ordinary window over (key, block) then sees exactly the
   frame it would see over the whole key; copies are dropped afterwards. Every window task
   holds at most ``B + lookback + lookahead`` rows per group.

Rows travel whole and once through each of the two shuffles (by key and bin, by key and
block); nothing is joined back, sampled or checkpointed, so rows with equal keys and order
come out as often as they went in. Ties in ``order`` are settled by a hash of the whole row,
so the order is the same on every layout and every task retry; rows equal in all columns are
interchangeable.

``layout='key'`` runs the plain ``partitionBy(key)`` window instead. Its rows and values are
the same; it is cheaper for small data. The default ``'auto'`` uses it only when the
optimizer's size estimate of the whole input is under
``tickweave.window.keyLayoutMaxBytes``. That estimate counts compressed files and takes an
array for one element, some 30 times too little for order books, so the default of 8 MB
stands for about 256 MB in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickweave.session import ensure_checkpoint_dir

LAYOUT_CONF = "tickweave.window.layout"          # 'auto' (default), 'blocked' or 'key'
BLOCK_ROWS_CONF = "tickweave.window.blockRows"   # rows per block, default 65536
KEY_MAX_BYTES_CONF = "tickweave.window.keyLayoutMaxBytes"
DEFAULT_BLOCK_ROWS = 65536
DEFAULT_KEY_MAX_BYTES = 8 * 1024 * 1024

def _cols(xs: Sequence) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (from file sizes and column widths; no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def layout(df: DataFrame, requested: str | None = None) -> str:
    """'key' or 'blocked'. 'auto' picks 'key' only when the whole input is estimated below
    ``keyLayoutMaxBytes``, and the blocked layout otherwise; the answer is the same."""
    mode = requested or df.sparkSession.conf.get(LAYOUT_CONF, "auto")
    if mode != "auto":
        return mode
    limit = int(df.sparkSession.conf.get(KEY_MAX_BYTES_CONF, str(DEFAULT_KEY_MAX_BYTES)))
    return "key" if estimated_bytes(df) <= limit else "blocked"


def _block_rows(df: DataFrame, b: int | None, reach: int) -> int:
    if b is None:
        b = int(df.sparkSession.conf.get(BLOCK_ROWS_CONF, str(DEFAULT_BLOCK_ROWS)))
    if b < max(reach, 1):
        raise ValueError(f"block of {b} rows is shorter than the frame reach {reach}")
    return b


DEFAULT_BIN_IDS = 4096
DEFAULT_BIN_MS = 60_000
FIRST_BIN = -(1 << 62)


def tie_break(df: DataFrame) -> Column:
    """Orders rows that tie in every order column."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def bin_of(df: DataFrame, column: str, width: int | None = None) -> Column:
    """The bin of a numeric column: ``width`` ids, or milliseconds where its name says time;
    NULLs, which sort first, are in the first bin. Other types share one bin."""
    kind = dict(df.dtypes)[column]
    if not kind.startswith(("bigint", "int", "smallint", "tinyint", "double", "float", "decimal")):
        return F.lit(FIRST_BIN)
    width = width or (DEFAULT_BIN_MS if "timestamp" in column else DEFAULT_BIN_IDS)
    return F.coalesce(F.floor(F.col(column) / F.lit(width)).cast("long"), F.lit(FIRST_BIN))


def histogram(df: DataFrame, keys: Sequence[str], descending: bool = False) -> DataFrame:
    """Of rows tagged with ``_bin``: keys, ``_bin``, ``_before`` (rows of the key in earlier
    bins), ``_of_key`` (rows of the key)."""
    keys = list(keys)
    counts = df.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(F.col("_bin").desc() if descending else F.col("_bin"))
    return counts.select(*keys, "_bin", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("_of_key"))


def join_bins(df: DataFrame, bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach ``_before`` and ``_of_key``; NULL keys are keys too."""
    renamed = bins.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bin").alias("_k_bin"), "_before", "_of_key")
    cond = F.col("_bin") == F.col("_k_bin")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(renamed, cond).drop("_k_bin", *[f"_k_{k}" for k in keys])


def upto_rows(df: DataFrame, keys: Sequence[str], column: str, n: int, descending: bool = False) -> DataFrame:
    """The rows of each key up to the bin of ``column`` that holds its ``n``-th row; NULL keys
    are keys too. The last bins, one row a key, are broadcast, so ``df`` is not shuffled."""
    x = df.withColumn("_bin", bin_of(df, column))
    reach = histogram(x.select(*keys, "_bin"), keys, descending).where(F.col("_before") < n) \
        .groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg((F.min if descending else F.max)("_bin").alias("_last"))
    cond = F.col("_bin") >= F.col("_last") if descending else F.col("_bin") <= F.col("_last")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return x.join(F.broadcast(reach), cond, "left_semi").drop("_bin")


def dense_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], idx_col: str = "_idx",
                count_col: str | None = None, bin_width: int | None = None) -> DataFrame:
    """Add the exact 0-based position of each row inside its key under ``order``.

    ``count_col`` also adds the number of rows of the key. A task holds one bin of a key, so
    a key of any length is indexed in parallel; the (key, bin) table is joined by whatever
    its measured size allows."""
    keys, order = list(keys), list(order)
    x = df.withColumn("_tie", tie_break(df)).withColumn("_bin", bin_of(df, order[0], bin_width))
    y = join_bins(x, histogram(x, keys), keys)
    in_bin = Window.partitionBy(*keys, "_bin").orderBy(*order, "_tie")
    y = y.withColumn(idx_col, (F.col("_before") + F.row_number().over(in_bin) - F.lit(1)).cast("long"))
    if count_col:
        y = y.withColumn(count_col, F.col("_of_key").cast("long"))
    return y.select(*df.columns, idx_col, *([count_col] if count_col else []))


def blocked_window(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   build: Callable[[DataFrame, WindowSpec], DataFrame],
                   lookback: int = 0, lookahead: int = 0, block_rows: int | None = None,
                   layout_: str | None = None, keep_index: tuple[str, str] | None = None,
                   bin_width: int | None = None) -> DataFrame:
    """Apply ``build(df, w)`` where ``w`` is an ordered per-key window.

    ``build`` may use frames reaching at most ``lookback`` rows back and ``lookahead``
    rows ahead (chained lags count: a 20-row mean of a lag-1 step reaches 20 back).
    It must only add columns. ``keep_index=(idx, count)`` also returns each row's 0-based
    position in its key and the key's row count, for later positional steps.
    """
    keys, order = list(keys), list(order)
    if layout(df, layout_) == "key":
        x = df.withColumn("_tie", tie_break(df))
        w = Window.partitionBy(*keys).orderBy(*order, "_tie")
        y = build(x, w)
        if keep_index:
            y = (y.withColumn(keep_index[0], (F.row_number().over(w) - F.lit(1)).cast("long"))
                 .withColumn(keep_index[1], F.count(F.lit(1)).over(Window.partitionBy(*keys)).cast("long")))
        return y.drop("_tie")
    b = _block_rows(df, block_rows, max(lookback, lookahead))
    x = dense_index(df, keys, order, idx_col="_idx", count_col="_n", bin_width=bin_width)
    blk = F.expr(f"_idx DIV {int(b)}")
    off = F.col("_idx") % F.lit(b)
    copies = [F.struct(blk.alias("b"), F.lit(0).alias("h"))]
    if lookback:
        nxt_exists = (blk + F.lit(1)) * F.lit(b) < F.col("_n")
        copies.append(F.when((off >= F.lit(b - lookback)) & nxt_exists,
                             F.struct((blk + F.lit(1)).alias("b"), F.lit(1).alias("h"))))
    if lookahead:
        copies.append(F.when((off < F.lit(lookahead)) & (blk > F.lit(0)),
                             F.struct((blk - F.lit(1)).alias("b"), F.lit(1).alias("h"))))
    if len(copies) > 1:
        x = (x.withColumn("_cp", F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull())))
             .withColumn("_blk", F.col("_cp.b")).withColumn("_halo", F.col("_cp.h")).drop("_cp"))
    else:
        x = x.withColumn("_blk", blk).withColumn("_halo", F.lit(0))
    w = Window.partitionBy(*keys, "_blk").orderBy("_idx")
    y = build(x, w)
    helpers = {"_idx", "_n", "_blk", "_halo"}
    added = [c for c in y.columns if c not in helpers and c not in df.columns]
    kept = [F.col("_idx").alias(keep_index[0]), F.col("_n").alias(keep_index[1])] if keep_index else []
    return y.where(F.col("_halo") == 0).select(*df.columns, *added, *kept)


def subset_cutoff(df: DataFrame, keys: Sequence[str], idx_col: str, cond, ratio: float,
                  block_rows: int | None = None) -> DataFrame:
    """Per key, the ``idx_col`` value of the first row past the first ``floor(m * ratio)``
    rows satisfying ``cond`` (``m`` = their count): columns keys, ``_cut``. Keys whose
    qualifying rows all fall inside the fraction have no row (left-join and treat NULL as
    "all inside").

    Qualifying rows are counted per block of ``B`` consecutive indices (a small table);
    its prefix sums name the single block per key that holds the cut, and only that
    block's rows are ranked. Nothing but one block per key is sorted.
    """
    keys = list(keys)
    b = _block_rows(df, block_rows, 1)
    x = df.where(cond).select(*keys, idx_col).withColumn("_sb", F.expr(f"{idx_col} DIV {int(b)}"))
    counts = x.groupBy(*keys, "_sb").agg(F.count(F.lit(1)).alias("_sn"))
    w_before = Window.partitionBy(*keys).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.withColumn("_soff", F.coalesce(F.sum("_sn").over(w_before), F.lit(0)).cast("long"))
              .withColumn("_m", F.sum("_sn").over(Window.partitionBy(*keys)).cast("long"))
              .withColumn("_k", F.floor(F.col("_m") * F.lit(float(ratio))).cast("long")))
    target = counts.where((F.col("_soff") <= F.col("_k")) & (F.col("_k") < F.col("_soff") + F.col("_sn")))
    w = Window.partitionBy(*keys, "_sb").orderBy(idx_col)
    hit = (x.join(target.select(*keys, "_sb", "_soff", "_k"), [*keys, "_sb"], "inner")
           .withColumn("_r", F.col("_soff") + F.row_number().over(w) - F.lit(1))
           .where(F.col("_r") == F.col("_k"))
           .select(*keys, F.col(idx_col).alias("_cut")))
    return hit


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and read it from there.

    For frames with several consumers (e.g. factors feeding both the horizon search and
    the evaluation): computed once, lineage cut, and a lost executor costs a re-read of
    the written files instead of a recomputation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
