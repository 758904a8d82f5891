import random
import re
import zlib
from collections import Counter

import pytest

from tickweave.llm import spelling
from helpers import docs, edge_rows

COLS = ("word", "form", "root", "n", "n_near", "form_n")


def plain_counts(rows, min_chars=7, min_count=2, misspell=31):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspell and h % misspell == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(n, ratio=10):
    near = {w: sorted((x for x in n if one_edit(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: near[w][0] if near[w] and n[near[w][0]] >= ratio * n[w] else None for w in n}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=lambda x: x[0])


def variants(r, n):
    words = set()
    while len(words) < n:
        w = list(r.choice(["thousand", "aaaaaaa", "aaabaaab", "éàüéàüé", "zwischenzeitlich"]))
        for _ in range(r.randrange(4)):
            at = r.randrange(len(w))
            w[at:at + r.randrange(2)] = r.choice(["", "a", "b", "é", "×"])
        if len(w) >= 7:
            words.add("".join(w))
    return sorted(words)


@pytest.mark.parametrize("max_block", [1024, 3])
def test_against_all_pairs(spark, max_block):
    r = random.Random(max_block)
    n = {w: 2 * 10 ** r.randrange(6) + r.randrange(3) for w in variants(r, 250)}
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    assert got(spelling.group_variants(words, max_block=max_block)) == plain(n)


def test_one_hot_block(spark):
    # words alike but for their first three letters, of one length and the next
    n = {a + b + c + "tttttt": 2 for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"} | {a + b + "xxtttttt": 30 for a in "abcdefgh" for b in "abcdefgh"}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got(spelling.group_variants(words, max_block=40)) == plain(n)


def test_chains_end_at_their_roots(spark):
    n = {"w" * 7 + "a" * k: 2 * 10 ** k for k in range(18)}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert {r["root"] for r in spelling.group_variants(words).collect()} == {"w" * 7 + "a" * 17}


def test_long_words(spark):
    long = "abcdefghij" * 300
    n = {long: 500, long[:1500] + long[1501:]: 3, long + "k": 2, long[::-1]: 7, "short" * 2: 4}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got(spelling.group_variants(words)) == plain(n)


def test_documents(spark):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(["Thousand", "thousands", "ÉCLAIRES", "éclaires", "zwischen9zeitlich", "short"]) for _ in range(r.randrange(40)))) for i in range(200)]
    rows += edge_rows() * 2 + [(500, "lengthyword " * 200_000), (None, "thousand thousandd thousandd")]
    want = plain_counts(rows)
    assert got(spelling.spelling_variants(docs(spark, rows))) == plain(want)
    assert any(w == "lengthyword" for w in want)


def test_empty(spark):
    assert got(spelling.spelling_variants(docs(spark, []))) == []
    assert got(spelling.spelling_variants(docs(spark, {1: None, 2: "", 3: "ab cd 123"}))) == []
