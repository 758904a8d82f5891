"""RNK-1/2 on the blocked layout: rows, and what of the table is shuffled for them."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickweave.operators import windows as win


def _books(spark, n=4000):
    null_if = lambda c, m: F.when(F.col("id") % m != 0, c)
    return spark.range(n).select(null_if(F.concat(F.lit("s"), F.col("id") % 3), 11).alias("symbol"),
                                 null_if(F.col("id") * 7919 % 600_000 * 10, 97).alias("timestamp"), (F.col("id") % 50).alias("nonce"),
                                 F.array(F.col("id"), F.col("id") + 1).alias("levels"))


@pytest.mark.parametrize("by", [[], ["symbol"]])
@pytest.mark.parametrize("n", [1, 60, 3000, 9000])
def test_blocked_rows_are_those_of_the_key_layout(spark, by, n):
    d = _books(spark)
    d = d.unionByName(d.where("nonce < 20"))
    for fn in (lambda lay: win.first_n(d, ["timestamp", "nonce"], n, by, layout=lay),
               lambda lay: win.latest_n(d, by, ["timestamp", "nonce"], n, layout=lay)):
        assert rows(fn("blocked")) == rows(fn("key"))


@pytest.mark.parametrize("by", [[], ["symbol"]])
def test_rows_behind_the_last_bin_are_not_shuffled(spark, tmp_path, by):
    _books(spark).write.parquet(str(tmp_path / "b"))
    d = spark.read.parquet(str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for q in (win.first_n(d, ["timestamp", "nonce"], 9, by, layout="blocked"), win.latest_n(d, by, ["timestamp", "nonce"], 9, layout="blocked")):
            plan = q._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "Broadcast" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    empty = win.first_n(d.where("nonce < 0"), ["timestamp", "nonce"], 9, by, layout="blocked")
    assert empty.count() == 0
