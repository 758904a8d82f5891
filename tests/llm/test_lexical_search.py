import math
import random
import re
from collections import Counter

import pytest

from tickweave.llm import lexical_search as ls
from helpers import edge_rows

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, score string, terms string"
DOCS = "doc_id long, text string, n string, salt string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(items, docs, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_all = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for i, b in bags:
            m = 25 + (75 * sum(b.values()) * n_docs) // n_all
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in terms(text) if t in b)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def found(spark, items, docs, **how):
    a = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS).repartition(2)
    b = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS).repartition(3)
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in ls.search(a, b, **how).collect()), key=str)


def text(r, n):
    return " ".join(r.choice(["the", "The", "of", "and", *"abcdefgh", "é1", "word%d" % r.randrange(60), "x-y"]) for _ in range(n))


@pytest.mark.parametrize("entries", [1 << 16, 60])
def test_against_plain_scores(spark, entries):
    r = random.Random(entries)
    docs = [(i, text(r, r.choice([0, 1, 3, 30, 200]))) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)] + [docs[5], docs[5]]  # equal scores
    items = [(i, text(r, r.choice([1, 4, 40]))) for i in range(25)] + [(30, "the " * 50), (31, "nowhere"), (32, ""), (33, None)]
    assert found(spark, items, docs, block_entries=entries) == plain(items, docs)


def test_edges(spark):
    docs = edge_rows() + [(20, "ÀÉ àé"), (21, "a" * 300_000 + " tail"), (22, "w5é " * 400_000)]
    items = [(1, "w5é w6é tail"), (1, "w5é w6é tail"), (1, "日本語のテキスト"), (None, "line lead x"), (2, "àé"), (3, "a" * 300_000)]
    assert found(spark, items, docs) == plain(items, docs)
    assert found(spark, [], docs) == [] and found(spark, items, []) == [] and found(spark, items, [(1, None)]) == []


def test_shared_sets_keep_sums_and_save_additions():
    r = random.Random(3)
    common = [r.sample(range(200), 20) for _ in range(4)]
    rows = [sorted(set(r.sample(range(200), 15) + r.choice(common) + r.choice(common))) for _ in range(60)] + [list(range(200)), [], [5]]
    parts, out = ls.shared_sets(rows, 200)
    leaves = {i: {i: 1} for i in range(200)}
    for k, (a, b) in enumerate(parts, 200):
        assert a < k and b < k
        leaves[k] = Counter(leaves[a]) + Counter(leaves[b])
    for row, got in zip(rows, out, strict=True):
        total = Counter()
        for s in got:
            total.update(leaves[s])
        assert total == Counter(row)
    assert sum(map(len, out)) + len(parts) < 0.75 * sum(map(len, rows))


def test_words_of_long_texts_are_cut_at_blanks():
    data = ("ab " * 7 + "x" * 50 + " é").encode()
    for step in (1, 5, 1000):
        assert [w for part in ls.words_of(data, ls.TERM_BYTES, step) for w in part] == data.split()
