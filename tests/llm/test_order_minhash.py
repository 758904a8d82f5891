"""Order MinHash against a plain version; neighbours over many ranges."""

from __future__ import annotations

import hashlib
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs, edge_rows  # noqa: E402

from tickweave.llm import order_minhash, queries  # noqa: E402
from tickweave.llm.ngram_join import mix  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain(text, h):
    """Elements picked one by one."""
    grams = [text[i:i + h.k] for i in range(max(1, len(text) - h.k + 1))] if text else []
    seen, numbered = Counter(), []
    for g in grams:
        numbered.append((g, seen[g]))
        seen[g] += 1

    def kmer(g):
        return mix(np.array([sum((ord(c) + 1) * int(f) for c, f in zip(g, h._factor)) % (1 << 64)], np.uint64))

    with np.errstate(over="ignore"):
        k = [kmer(g)[0] for g in grams]
        e = [int(mix(np.array([x + np.uint64(n) * np.uint64(0x9E3779B97F4A7C15)]))[0] >> np.uint64(32)) for x, (_, n) in zip(k, numbered)]
        out = []
        for a in h._odd:
            picked = sorted(sorted(range(len(e)), key=lambda i: (int(a) * e[i] % (1 << 32), i))[:h.l])
            v = np.array([len(picked)], np.uint64)
            for i in picked:
                v = mix(v * np.uint64(0x9FB21C651E98DF25) + k[i])
            out.append(int(v[0] >> np.uint64(32)) if e else 0)
    return out


def test_sketch_is_the_plain_one():
    h = order_minhash.OrderMinHash(m=8, l=3, k=4)
    for t in ("", "a", "abc", "abcd", "aaaaaaaaaaaa", "the cat sat on the mat, the cat sat", "中文字é" * 9):
        assert h.sketch(t).tolist() == plain(t, h), t


def test_order_and_edits_count():
    h = order_minhash.OrderMinHash()
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    text, moved = " ".join(words), " ".join(words[150:] + words[:150])
    few = " ".join(w if i % 40 else "zz" + w for i, w in enumerate(words))
    a = h.sketch(text)
    assert order_minhash.likeness(a, h.sketch(few)) > order_minhash.likeness(a, h.sketch(moved)) + 0.1


def expected(rows):
    h = order_minhash.OrderMinHash()
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        c = len(t) // 4
        e = t[:len(t) - c] + n[:c]
        s = h.sketch(t)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), order_minhash.fingerprint(s), order_minhash.fingerprint(h.sketch(e)),
                    order_minhash.likeness(s, h.sketch(e)), order_minhash.likeness(s, h.sketch(n))))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 20_000])
def test_neighbours(spark, bucket_bytes):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = sorted(map(tuple, order_minhash.edit_digests(df, bucket_bytes=bucket_bytes).collect()), key=str)
    assert got == expected(rows)
    if bucket_bytes == 1 << 30:
        assert sorted(map(tuple, queries.op10_order_minhash(spark, SF).collect()), key=str) == got
        prints = {r["doc_id"]: r["fingerprint"] for r in order_minhash.fingerprints(df).collect()}
        assert prints == {r[0]: r[3] for r in got}
        assert np.mean([r[5] > r[6] for r in got if r[1] >= 40]) > 0.9


def test_edges(spark):
    rows = [r for r in edge_rows() if r[0] not in (5, 4)] + [(4, "long " * 3000)]
    for b in (1 << 30, 3000):
        assert sorted(map(tuple, order_minhash.edit_digests(docs(spark, rows), bucket_bytes=b).collect()), key=str) == expected(rows)
    twice = [(5, "one text"), (5, "one text"), (6, "another")]
    assert order_minhash.edit_digests(docs(spark, twice)).count() == 3
    assert len(order_minhash.edit_digests(docs(spark, twice[:1])).collect()) == 1
    assert order_minhash.edit_digests(docs(spark, []).where("false")).count() == 0
