"""The versioned table against latest_by_key over all that was appended."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickweave.operators.quality import DAY_MS, latest_by_key
from tickweave.sources.versions import Manifest, VersionedTable

KEY = ["exchange_id", "timestamp", "trade_id"]
DAY0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp() * 1000)
SCHEMA = ("exchange_id string, timestamp long, trade_id long, price double, local_timestamp long, info map<string,string>")


def batch(spark, n, lo=0, hi=300, days=3):
    """Trades lo..hi over some days; version n of each, two rows of it, one null time."""
    t = spark.range(lo, hi).select(
        F.lit("x").alias("exchange_id"), (F.lit(DAY0) + F.col("id") % days * DAY_MS + F.col("id")).cast("long").alias("timestamp"),
        F.col("id").alias("trade_id"), (F.col("id") * 10 + n).cast("double").alias("price"),
        (F.col("id") + F.when(F.col("id") % 2 == 0, n).otherwise(-n) * 1000).cast("long").alias("local_timestamp"),
        F.create_map(F.lit("a"), F.lit("b")).alias("info"))
    odd = spark.createDataFrame([("x", None, 7, float(n), n, None), ("x", None, 7, None, n, None), (None, DAY0, None, 1.0, None, None)], SCHEMA)
    return t.unionByName(t.where("trade_id < 20")).unionByName(odd)


def told(df):
    return rows(df.withColumn("info", F.to_json("info")))


def want(spark, *batches):
    d = batches[0]
    for b in batches[1:]:
        d = d.unionByName(b)
    return told(latest_by_key(d, KEY, "local_timestamp", ["price"]))


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), KEY)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_same_rows_before_during_and_after(spark, table):
    a, b, c = batch(spark, 1), batch(spark, 2, 100, 400), batch(spark, 3, 0, 50, days=1)
    assert table.append(a, "w", 0) and table.append(b, "w", 1)
    assert told(table.read_latest()) == want(spark, a, b)
    assert table.compact() == ["2024-01-01", "2024-01-02", "2024-01-03", "none"]
    assert told(table.read_latest()) == want(spark, a, b)
    assert "Exchange" not in plan(table.read_latest()) and "Aggregate" not in plan(table.read_latest())
    assert table.append(c, "w", 2)
    assert set(table.manifest().loose) == {"2024-01-01", "none"}
    assert told(table.read_latest()) == want(spark, a, b, c)
    assert "Exchange" not in plan(table.read_latest("2024-01-02", "2024-01-03"))
    assert table.compact(min_loose=2) == [] and table.compact(days=["2024-01-01"]) == ["2024-01-01"]
    assert told(table.read_latest()) == want(spark, a, b, c)
    day = table.read_latest("2024-01-02", "2024-01-02")
    assert day.count() == day.where(F.col("timestamp").between(DAY0 + DAY_MS, DAY0 + 2 * DAY_MS - 1)).count() == len(range(1, 400, 3))
    assert all("_day=2024-01-02" in f for f in day.inputFiles())


def test_merging_takes_one_shuffle_of_ranges(spark, table):
    d = batch(spark, 1).withColumn("_day", F.to_date(F.lit("2024-01-01"))).repartitionByRange(4, "_day", *KEY)
    assert plan(table._newest(d, ["_day", *KEY])).count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning" not in plan(table._newest(d, ["_day", *KEY]))


def test_batches_delivered_again_and_other_columns(spark, table):
    a = batch(spark, 1)
    assert table.append(a, "w", 4) and not table.append(batch(spark, 9), "w", 4) and not table.append(batch(spark, 9), "w", 3)
    assert table.append(a.limit(0), "v", 0)
    assert told(table.read_latest()) == want(spark, a)
    with pytest.raises(ValueError):
        table.append(a.drop("price"), "w", 5)
    assert told(table.read_latest()) == want(spark, a)


def test_empty_tables(spark, table):
    with pytest.raises(ValueError):
        table.read_latest()
    assert table.compact() == [] and table.vacuum() == 0
    table.append(batch(spark, 1).limit(0), "w", 0)
    assert table.read_latest().count() == 0 and table.compact() == []


def test_killed_compaction_leaves_the_table_as_it_was(spark, table, monkeypatch):
    a, b = batch(spark, 1), batch(spark, 2)
    table.append(a, "w", 0), table.append(b, "w", 1)
    before = table.manifest()
    with monkeypatch.context() as m:
        m.setattr(table, "_take", lambda _: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            table.compact()
    assert table.manifest() == before and told(table.read_latest()) == want(spark, a, b)
    assert table.vacuum(3600) == 0 and table.vacuum(-60) == 4  # what the killed run left
    assert told(table.read_latest()) == want(spark, a, b)
    assert len(table.compact()) == 4
    table.vacuum(-60)
    assert told(table.read_latest()) == want(spark, a, b) and len(table._names("_manifest")) == 1


def test_commits_of_others_meanwhile(spark, table, monkeypatch):
    a, b, c = batch(spark, 1), batch(spark, 2), batch(spark, 3, 0, 30, days=1)
    table.append(a, "w", 0), table.append(b, "w", 1)
    other, take = VersionedTable(spark, table.path, KEY), table._take

    def late(m: Manifest):
        monkeypatch.setattr(table, "_take", take)
        assert other.append(c, "v", 0)
        return take(m)

    monkeypatch.setattr(table, "_take", late)
    assert len(table.compact()) == 4
    assert set(table.manifest().loose) == {"2024-01-01", "none"}
    assert told(table.read_latest()) == want(spark, a, b, c)

    def beaten(m: Manifest):
        monkeypatch.setattr(table, "_take", take)
        assert other.compact() == ["2024-01-01", "none"]
        return take(m)

    monkeypatch.setattr(table, "_take", beaten)
    assert table.compact() == []
    assert told(table.read_latest()) == want(spark, a, b, c)


def test_key_must_hold_the_day(spark, tmp_path):
    with pytest.raises(ValueError):
        VersionedTable(spark, str(tmp_path), ["trade_id"])


def test_compaction_is_dealt_by_rows_too(spark, table, monkeypatch):
    from tickweave.sources import versions
    a, b = batch(spark, 1), batch(spark, 2, 100, 400)
    table.append(a, "w", 0), table.append(b, "w", 1)
    monkeypatch.setattr(versions, "FILE_ROWS", 50)
    assert len(table.compact()) == 4
    day = [f for f in table.read_latest("2024-01-02", "2024-01-02").inputFiles()]
    assert len(day) > 2  # 134 rows of the day, in files of some 50
    assert told(table.read_latest()) == want(spark, a, b)
