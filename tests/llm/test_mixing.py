import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickweave.llm import mixing, queries
from helpers import edge_rows

SCHEMA = "doc_id long, text string, source string, size string, src string, target string, h string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z", "w") for i, t, s in rows], SCHEMA).repartition(3)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), repeats=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in full]
        if not left:
            return {s: float(repeats * sizes[s]) for s in names}
        share = (total - sum(repeats * sizes[s] for s in full)) / sum(weight[s] for s in left)
        more = {s for s in left if weight[s] * share > repeats * sizes[s]}
        if not more:
            return {s: float(repeats * sizes[s]) if s in full else weight[s] * share for s in names}
        full |= more


def rows(n=300, seed=1):
    r = random.Random(seed)
    return [(i, " ".join("w" for _ in range(r.choice([0, 1, 5, 40, 300, 2500]))), r.choice(["a", "a", "a", "b", "Z", "é", "\U0001F600", "tiny" if i == 7 else "c", None]))
            for i in range(n)]


def test_targets_and_taken(spark):
    docs = rows() + [(1000, "one two", "few"), (1001, "x " * 30_000, "long"), (1001, "x " * 30_000, "long")]
    got = mixing.taken(table(spark, docs)).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((i, size(t)) for i, t, _ in docs)
    of = Counter()
    for _, t, s in docs:
        of[s] += size(t)
    want, mixed = plain_targets(of), Counter()
    for r in got:
        assert r["source_size"] == of[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"]
        mixed[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(mixed[s] - t) <= max(0.03 * t, 4 * mixing.BLOCK), (s, t, mixed[s])
    assert abs(sum(mixed.values()) - sum(of.values())) <= 10 * mixing.BLOCK


def test_spans_follow_blocks_and_permutations(spark):
    docs = rows(120, 2)
    spans = mixing.mix(table(spark, docs), block=16, shard_slots=64, seed=3).collect()
    sizes = {i: size(t) for i, t, _ in docs}
    slots, cover = defaultdict(int), defaultdict(Counter)
    for r in spans:
        assert 0 <= r["start"] and r["start"] + r["length"] <= sizes[r["doc_id"]]
        slots[r["shard"], r["src"], r["nth"]] += r["length"]
        for w in range(r["start"], r["start"] + r["length"]):
            cover[r["doc_id"]][w] += 1
    assert max(slots.values()) == 16 and max(s for s, _, _ in slots) > 3
    per_shard = Counter(s for s, _, _ in slots)
    assert all(n == 64 for s, n in per_shard.items() if s < max(per_shard) and s < 3)
    # whole rounds of a source take each of its words equally often, to within one
    source = {i: s for i, _, s in docs}
    levels = defaultdict(set)
    for i, words in cover.items():
        levels[source[i]] |= {words[w] for w in range(sizes[i])}
    assert all(max(x) - min(x) <= 1 for x in levels.values())


def test_permutation_is_one_and_moves(spark):
    for n in (1, 2, 7, 64, 1000):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5)).alias("p")).collect()]
        again = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(6)).alias("p")).collect()]
        assert sorted(got) == list(range(n)) == sorted(again)
        if n >= 64:
            assert got != again and sum(abs(a - b) for a, b in enumerate(got)) > n * n / 6


def test_prefix_sums_over_spans(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SPAN", 7)
    r = random.Random(4)
    data = [(k, p, r.randrange(9)) for k in range(3) for p in r.sample(range(100), 60)]
    got = mixing.running_before(spark.createDataFrame(data, "k long, p long, v long"), "k", "p", "v", "before").collect()
    assert {(x["k"], x["p"]): x["before"] for x in got} == {(k, p): sum(v for k2, p2, v in data if k2 == k and p2 < p) for k, p, _ in data}


def test_copies_in_chunks_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 4)
    monkeypatch.setattr(mixing, "CELL_ROWS", 5)
    docs = [(1, "a b c d e", "s")] * 41 + [(2, None, "s")] * 9 + [(None, "q r", None)] * 3
    a, b = (sorted(map(tuple, mixing.taken(table(spark, docs).repartition(n), block=8).collect()), key=str) for n in (2, 5))
    assert a == b and len(a) == 53
    assert sum(r[5] for r in a) == pytest.approx(211, abs=24)


def test_edges(spark):
    got = mixing.taken(table(spark, [(i, t, None if i == 4 else "s") for i, t in edge_rows()])).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(i), size(t)) for i, t in edge_rows())
    assert mixing.taken(table(spark, [])).count() == 0
    assert [(r["target"], r["taken"]) for r in mixing.taken(table(spark, [(1, None, "a"), (2, " ", "b")])).collect()] == [(0.0, 0)] * 2


def test_no_python_on_the_path(spark):
    plan = queries.op11_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("what", [mixing.taken, mixing.mix])
def test_slots_and_blocks_are_never_broadcast(spark, what):
    """Spark's size of exploded rows is that of the rows before: a broadcast of them grows with the words."""
    seen = what(table(spark, [(i, "w " * 900, "ab"[i % 2]) for i in range(60)]))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in re.findall(r"\w+Join \[.*", plan) if re.search(r"Join \[src#\d+L?, index#", x)]
    assert joins and all(x.startswith("SortMergeJoin") for x in joins), joins


def test_draws_are_never_broadcast(spark, monkeypatch):
    """Their number is that of sources times shards, of which Spark's size holds the shards alone."""
    sources = spark.createDataFrame([(f"s{i}", i, 5, 333 + i, 333.0 + i) for i in range(40)], "source string, src long, docs long, source_size long, target double")
    got = []
    for few in (mixing.FEW_BINS, 3):
        monkeypatch.setattr(mixing, "FEW_BINS", few)
        counts = mixing.shard_counts(sources, 8, 64, 7)
        sides = re.findall(r"(\w+Join) \[bin#[^\n]*?(BuildLeft|BuildRight|$)", counts._jdf.queryExecution().executedPlan().toString(), re.M)
        assert sides and all(x == (("BroadcastHashJoin", "BuildRight") if few > 3 else ("SortMergeJoin", "")) for x in sides), sides
        got.append(sorted(map(tuple, counts.collect())))
    assert got[0] == got[1]
