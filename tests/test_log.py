"""Message log: micro-batches bounded in rows, positions per stream, restarts, held flushes."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tickweave.sources import log
from tickweave.sources.log import append_log, drain_query, even_shares, read_log

SCHEMA = "stream_key string, data string"


def _messages(spark, sizes, start=0):
    return spark.createDataFrame([(k, f"{i:06d}") for k, n in sizes.items() for i in range(start, start + n)], SCHEMA)


def _start(spark, root, ck, limit, seen, fail_at=None, wait=0.0):
    def take(df, batch_id):
        got = [tuple(r) for r in df.select("stream_key", "data").collect()]
        if fail_at is not None and len(seen) == fail_at:
            raise RuntimeError("killed")
        if got:
            seen.append((batch_id, got))
    return read_log(spark, root, SCHEMA, limit, wait).writeStream.foreachBatch(take).option("checkpointLocation", ck) \
        .trigger(processingTime="0 seconds").start()


def _check(seen, limit, want):
    assert max(len(b) for _, b in seen) <= limit
    flat = [r for _, b in seen for r in b]
    assert sorted(flat, key=repr) == sorted(want, key=repr)  # each row once
    for key in {k for k, _ in flat}:
        per_batch = [[d for k, d in b if k == key] for _, b in seen]
        per_batch = [b for b in per_batch if b]
        assert all(max(a) < min(b) for a, b in zip(per_batch, per_batch[1:]))  # in order of the stream


def test_batches_are_bounded_and_streams_in_order(spark, tmp_path):
    root, ck = str(tmp_path / "log"), str(tmp_path / "ck")
    first = _messages(spark, {"a/b": 500, "c": 7, None: 30, "": 2})
    append_log(first, root, "stream_key", ["data"])
    seen = []
    drain_query(_start(spark, root, ck, 60, seen))
    want = [tuple(r) for r in first.collect()]
    _check(seen, 60, want)
    assert [len(b) for _, b in seen] == [60] * 8 + [59]
    # a small stream isn't kept waiting by a large one
    assert sum(k == "c" for k, _ in seen[0][1]) == 7
    # later appends, an empty one and a new stream, by the same query
    append_log(first.where("false"), root, "stream_key", ["data"])
    more = _messages(spark, {"a/b": 90, "new": 5}, start=1000)
    append_log(more, root, "stream_key", ["data"])
    drain_query(_start(spark, root, ck, 60, seen))
    _check(seen, 60, want + [tuple(r) for r in more.collect()])


def test_a_killed_run_goes_on_where_it_stood(spark, tmp_path):
    root, ck, seen = str(tmp_path / "log"), str(tmp_path / "ck"), []
    m = _messages(spark, {"a": 300, "b": 100})
    append_log(m, root, "stream_key", ["data"])
    for fail_at in (0, 2, 3):
        with pytest.raises(Exception, match="killed"):
            drain_query(_start(spark, root, ck, 50, seen, fail_at))
        assert len(seen) == fail_at
    drain_query(_start(spark, root, ck, 50, seen))
    assert [len(b) for _, b in seen] == [50] * 8 and [i for i, _ in seen] == list(range(8))
    _check(seen, 50, [tuple(r) for r in m.collect()])


def test_passed_appends_are_neither_listed_nor_opened(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "log")
    for i in range(3):
        append_log(_messages(spark, {"a": 20, **({"dead": 5} if i == 0 else {})}, start=100 * i), root, "stream_key", ["data"])
    monkeypatch.setattr(log, "LIST_EVERY_S", 0)

    def reader():
        return log.LogReader(spark.createDataFrame([], SCHEMA).schema, {"path": root, "rowspertrigger": "30", "maxwaits": "0"})
    r, at, sizes = reader(), {}, []
    while (end := r.latestOffset()) != at:
        sizes.append(sum(hi - lo for t in r.partitions(at, end) for _, lo, hi in t.ranges))
        r.commit(at)
        at = end
    assert sizes == [30, 30, 5] and not any(r.files["dead"])
    again = reader()
    assert again.partitions(at, at) == [] and again.latestOffset() == at
    assert again.known == "0000000002" and set(again.files) == {"a"} and len(again.counts) <= len(again.files["a"])
    append_log(_messages(spark, {"dead": 5}, start=500), root, "stream_key", ["data"])
    end = again.latestOffset()
    assert sum(hi - lo for t in again.partitions(at, end) for _, lo, hi in t.ranges) == 5


def test_an_unfinished_append_is_not_read(spark, tmp_path):
    root = tmp_path / "log"
    append_log(_messages(spark, {"a": 5}), str(root), "stream_key", ["data"])
    out = append_log(_messages(spark, {"a": 5}, start=10), str(root), "stream_key", ["data"])
    r = log.LogReader(None, {"path": str(root), "rowspertrigger": "100", "maxwaits": "0"})
    (root / out[-10:] / "_SUCCESS").rename(tmp_path / "_SUCCESS")
    assert r.latestOffset()["a"]["file"].startswith("0000000000")
    (tmp_path / "_SUCCESS").rename(root / out[-10:] / "_SUCCESS")
    time.sleep(log.LIST_EVERY_S)
    assert r.latestOffset()["a"]["file"].startswith("0000000001")


def test_a_flush_waits_for_rows_or_time(spark, tmp_path):
    root = str(tmp_path / "log")
    append_log(_messages(spark, {"a": 25}), root, "stream_key", ["data"])
    r = log.LogReader(None, {"path": root, "rowspertrigger": "10", "maxwaits": "0.5"})
    for _ in range(2):  # full ones go at once
        end = r.latestOffset()
        r.partitions(r.at, end)
    assert end["a"]["row"] == 20 and r.latestOffset() == end
    time.sleep(0.6)
    assert r.latestOffset()["a"]["row"] == 25


def test_even_shares():
    assert even_shares({"a": 100, "b": 3, "c": 50}, 30) == {"a": 14, "b": 3, "c": 13}
    assert even_shares({"a": 100, "b": 3, "c": 50}, 30, 1) == {"a": 13, "b": 3, "c": 14}
    assert even_shares({"a": 1, "b": 2}, 30) == {"a": 1, "b": 2}
    assert even_shares({k: 5 for k in "abcd"}, 2) == {"a": 1, "b": 1, "c": 0, "d": 0}
    assert even_shares({k: 5 for k in "abcd"}, 2, 3) == {"a": 1, "b": 0, "c": 0, "d": 1}
    for n in range(60):
        got = even_shares({"a": 9, "b": 20, "c": 0, "d": 4}, n)
        assert sum(got.values()) == min(n, 33) and max(got["b"] - got["a"], 0) <= (1 if got["a"] < 9 else 20)
    assert even_shares({}, 5) == {}


def test_rows_keep_their_types(spark, tmp_path):
    root = str(tmp_path / "log")
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    append_log(df, root, df.columns[0], [])
    out = str(tmp_path / "out")
    drain_query(read_log(spark, root, df.schema, 1000).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
                .trigger(processingTime="0 seconds").start(out))
    back = spark.read.parquet(out)
    assert back.schema == df.schema and rows(back.select(F.struct("*"))) == rows(df.select(F.struct("*")))


def test_a_backlog_is_caught_up_in_few_batches_and_ends_in_flushes(spark, tmp_path):
    root = str(tmp_path / "log")
    m = _messages(spark, {"a": 3000, "b": 400, None: 20})
    append_log(m, root, "stream_key", ["data"])
    r, at, sizes, got = log.LogReader(m.schema, {"path": root, "rowspertrigger": "20", "maxwaits": "0", "catchuprows": "500"}), {}, [], []
    while (end := r.latestOffset()) != at:
        parts = r.partitions(at, end)
        got += [tuple(x.values()) for p in parts for b in r.read(p) for x in b.to_pylist()]
        sizes.append(sum(hi - lo for p in parts for _, lo, hi in p.ranges))
        r.commit(at)
        at = end
    assert max(sizes) == 500 and sizes[-1] <= 20 and len(sizes) < 30 and sizes == sorted(sizes, reverse=True)
    assert sorted(got, key=repr) == sorted(map(tuple, m.collect()), key=repr)
    assert all(d == sorted(d) for d in ([d for k, d in got if k == s] for s in ("a", "b")))
    seen = []
    query = read_log(spark, root, SCHEMA, 50, catch_up_rows=1000).writeStream.foreachBatch(lambda df, _: seen.append(df.count())) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="0 seconds").start()
    drain_query(query)
    assert sum(seen) == 3420 and max(seen) == 3420 // 4 and len(seen) < 25
