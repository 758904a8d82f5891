"""Nearest neighbours: recall against brute force, exact scores, ties and unusable vectors."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from tickweave.llm import nearest, queries  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, list int, chunk int, group_id string"


def brute(rows, k=5):
    ok = [(i, np.array(e, float)) for i, e in rows if i is not None and e is not None and None not in e and np.isfinite(np.array(e, float)).all() and np.any(e)]
    ids, x = np.array([i for i, _ in ok]), np.array([e for _, e in ok])
    out = {}
    for i, e in ok:
        if i % 50 == 0:
            s = nearest.cosine(np.broadcast_to(e, x.shape), x)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        got.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got)
    return out


def recall(got, want):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([a in got[q] for q in want for a in want[q]])


def test_small_table_is_exact(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert found(queries.op6_nearest(spark, sf)) == brute(rows)


def test_recall_of_the_lists(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 32))
    x = (centres[rng.integers(0, 40, 6000)] + 0.6 * rng.normal(size=(6000, 32))).astype(np.float32)
    x[3000:5000] = x[17]  # a third is one vector
    rows = [(i, e) for i, e in enumerate(x.tolist())]
    df = spark.createDataFrame([(i, e, 1, 1, "x") for i, e in rows], SCHEMA)
    got, want = found(nearest.search(df, F.col("vec_id") % 50 == 0)), brute(rows)
    assert recall(got, want) >= 0.95
    assert got[3050] == want[3050] == [(i, want[3050][0][1]) for i in (17, 3000, 3001, 3002, 3003)]


def test_unusable_vectors_and_few(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.0, 0.0]), (100, None), (1, [float("nan"), 1.0]), (2, [float("inf"), 1.0]), (3, [None, 1.0]), (4, [2.0, 4.0]),
            (150, [1.0, -1.0]), (5, [1.0, 2.0, 3.0]), (6, [1.0, 2.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, e, 1, 1, "x") for i, e in rows], SCHEMA)
    got = found(nearest.search(df, F.col("vec_id") % 50 == 0))
    assert got == brute([r for r in rows if r[0] != 5])
    assert [i for i, _ in got[0]] == [4, 6, 150]
    assert nearest.search(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert nearest.search(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_repeated_ids_count_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, e) for i, e in enumerate(rng.normal(size=(300, 8)).astype(np.float32).tolist())]
    again = [(0, rows[0][1])] * 3 + [(1, rows[1][1])] * 40 + [(50, [9.0] * 8), (2, [-9.0] + [1.0] * 7), (3, None), (4, [0.0] * 8)]
    df = spark.createDataFrame([(i, e, 1, 1, "x") for i, e in rows + again], SCHEMA)
    once = {i: e for i, e in rows}
    once[50], once[2] = min(once[50], [9.0] * 8), min(once[2], [-9.0] + [1.0] * 7)
    got = found(nearest.search(df, F.col("vec_id") % 50 == 0))
    assert got == brute(list(once.items())) and all(len({v for v, _ in g}) == 5 for g in got.values())


def test_scan_abandons_but_finds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 64))
    u = nearest.unit(x) @ nearest.rotation(64)
    q, v, s = nearest.Scan(6)(np.arange(3000), x, u, x[:40], u[:40])
    exact = np.argsort(-(nearest.unit(x[:40]) @ nearest.unit(x).T), axis=1)[:, :6]
    hit = np.mean([len(set(v[q == i]) & set(exact[i])) / 6 for i in range(40)])
    assert hit >= 0.97
