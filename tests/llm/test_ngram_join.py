"""The n-gram join against brute force; components against union-find; the SQL oracles."""

from __future__ import annotations

import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs, edge_rows, rows_of  # noqa: E402

from tickweave.llm import graph, ngram_join, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def root(up, x):
    while up.setdefault(x, x) != x:
        x = up[x]
    return x


def brute(rows, words=4, percent=85):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    up = {}
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][0], rows[b][0]
            if x is None or y is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((root(up, x), root(up, y)))
                up[q] = p
    return sorted(((i, len(s), None if i is None else root(up, i)) for (i, _), s in zip(rows, sets)), key=str)


def near_copies(seed, groups=25, sizes=(1, 3, 5, 6, 7, 9, 14, 20, 30, 60, 150)):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=40)
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice(sizes))
        if rng.random() < 0.3:
            base += passage
        for _ in range(rng.choice((1, 2, 6))):
            text = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                k = rng.randrange(len(text) or 1)
                text[k:k + 1] = rng.choice(([], rng.choices(vocabulary, k=1), text[k:k + 1] + rng.choices(vocabulary, k=1)))
            rows.append((len(rows) + 10, rng.choice((" ", "\n", " \t")).join(text).upper()))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,words,percent", [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_components_are_the_brute_force_s(spark, seed, words, percent):
    rows = near_copies(seed)
    assert rows_of(ngram_join.link(docs(spark, rows), words, percent), "doc_id", "n_shingles", "component_id") == brute(rows, words, percent)


@pytest.mark.parametrize("boundary", [0, 12, 10_000])
def test_any_boundary_gives_the_same(spark, boundary, monkeypatch):
    """All sets by inverted lists, all by subsets, and both."""
    monkeypatch.setattr(ngram_join, "choose_boundary", lambda *_: boundary)
    rows = near_copies(7, groups=12, sizes=(5, 7, 12, 14, 30))
    assert rows_of(ngram_join.link(docs(spark, rows)), "doc_id", "n_shingles", "component_id") == brute(rows)


def test_table_and_edges(spark):
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op9_ngram_join(spark, SF), "doc_id", "n_shingles", "component_id") == brute(table)
    assert rows_of(ngram_join.link(docs(spark, edge_rows())), "doc_id", "n_shingles", "component_id") == brute(edge_rows())
    none = docs(spark, []).where("false")
    assert ngram_join.link(none).count() == 0 and ngram_join.keep_one_of_each(none).count() == 0
    df = docs(spark, near_copies(4))
    kept = ngram_join.keep_one_of_each(df)
    want = {c for _, _, c in brute(near_copies(4), 5, 80)}
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == want


def test_boundary_has_least_cost():
    assert ngram_join.choose_boundary({5000: 10}, 85) == 0
    small = ngram_join.choose_boundary({n: 100 for n in range(1, 200)}, 85)
    assert 6 <= small <= 60


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(1)
    for n in (3, 40, 130, 600, 5000):
        for cut in (0.0, 0.05, 0.12, 0.5):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.concatenate([a[int(cut * n):], rng.integers(0, 1 << 63, int(rng.random() * cut * n)).astype(np.uint64)])
            p, q = ngram_join._lacking(ngram_join._bitmap(a), ngram_join._bitmap(b))
            assert p <= len(np.setdiff1d(a, b)) and q <= len(np.setdiff1d(b, a))
            assert cut < 0.5 or p > 0.2 * n or n < 40


def test_word_hashes_see_words_alone():
    a, n = ngram_join.word_hashes(["The  cat\tsat", "", "the\ncat sat", "é É"])
    assert n.tolist() == [3, 0, 3, 2] and (a[:3] == a[3:6]).all() and a[6] != a[7] and len(np.unique(a)) == 5


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(200)] + [(7, 7)]
    up = {}
    for a, b in edges:
        p, q = sorted((root(up, a), root(up, b)))
        up[q] = p
    want = sorted((x, root(up, x)) for e in edges if e[0] != e[1] for x in e)
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted(set(want))


def test_oracles(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.ORACLE.items():
        cur = con.execute(sql)
        names = [c[0] for c in cur.description]
        assert sorted(cur.fetchall(), key=str) == rows_of(queries.QUERIES[name](spark, SF), *names), name


def brute_links(rows, words=4, percent=85):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        s = frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1)) or (frozenset({tuple(w)}) if w else None)
        if s:
            first.setdefault(s, i)
    named = sorted((i, s) for s, i in first.items())
    return sorted((i, j) for k, (i, s) in enumerate(named) for j, t in named[k + 1:] if 100 * len(s & t) >= percent * len(s | t))


@pytest.mark.parametrize("percent,cell", [(85, 512), (60, 3)])
def test_links_are_all_of_the_brute_force_s(spark, percent, cell):
    """Also those within a component that the pivots have joined already."""
    base = [f"x{i}" for i in range(80)]
    rows = near_copies(11, groups=15) + [(1000 + k, " ".join(base[:k] + base[k + 1:])) for k in range(12)] + [(2000, " ".join(base)), (2001, " ".join(base)), (None, " ".join(base))]
    want = brute_links(rows, percent=percent)
    assert len([p for p in want if p[0] >= 1000]) > 12 * 11 // 3
    assert rows_of(ngram_join.links(docs(spark, rows), percent=percent, cell=cell), "a", "b") == sorted(want, key=str)


def test_slots_reach_the_driver_as_bytes(spark):
    """200,000 hashes: every slot holds the largest number of its hashes, and the driver needs
    little more than the table's 2 MB. A Python row for each word took some 60 MB."""
    import tracemalloc

    from pyspark.sql import functions as F

    rows = spark.range(200_000).select(F.xxhash64("id").alias("h"), (F.col("id") % 13 + 1).cast("int").alias("v"))
    tracemalloc.start()
    slots = ngram_join.Slots.of(rows, F.col("v"), 4, 20, 22)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert slots.bits == 22 and peak < 12 << 20
    h, v = (np.array(x) for x in zip(*((r["h"], r["v"]) for r in rows.collect())))
    h = h.astype(np.int64).view(np.uint64)
    want = np.zeros(1 << 22, np.int64)
    np.maximum.at(want, (h >> np.uint64(64 - 22)).astype(np.int64), v)
    every = np.arange(1 << 22, dtype=np.uint64) << np.uint64(64 - 22)
    assert (slots.at(every) == want).all() and (slots.at(h) >= v).all()
    few = ngram_join.Slots.of(rows.where("false"), F.lit(1), 1, 8, 27)
    assert few.bits == 8 and not few.data.any()
    one = ngram_join.Slots.of(rows.limit(3), F.lit(1), 1, 8, 27)
    assert one.bits == 8 and len(one.data) == 4 and np.bitwise_count(one.data.view(np.uint64)).sum() <= 3 and one.data.any()
