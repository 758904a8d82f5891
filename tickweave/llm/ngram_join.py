"""N-gram Jaccard self-join: exact, size-aware, heavy-light.

A document's set holds the 64-bit hashes of its distinct word n-grams. Equal sets are one
node. Under one global order of n-grams (rare first, then by hash) two sets that link share
tokens early: of a set of n tokens whose
partners must share t(n) = ceil(similarity * n), the first n - t(n) + c tokens hold c
common ones. Small sets enumerate all pairs (c = 2) of their prefix and meet in the buckets
of these fixed-size subsets; large sets, and the sets up to their size ratio below them,
post their prefix (c = 1) and scan the inverted lists. The size boundary is the one of least
estimated cost over the histogram of set sizes.

The order comes from the buckets themselves: a pass over all documents counts the sets that
each prefix token would bring together in hash order, another one all tokens of the sets with
many such tokens of large buckets; these go to the end, by size. A third pass counts the keys
under that order, and only keys of two sets or more are written. Both go to the tasks as tables of hashed slots of a bounded size;
when tokens share slots, some stand later than they should or are written for nothing, which
costs time and changes no result.

A bucket is never expanded into all its pairs at once: first every member is checked against
one pivot of its bucket and size band; then only members that are still in different
components and pass the size and position filters are paired. Every candidate is verified
exactly on the whole sets.

Edge cases: null, empty or blank text has an empty set and no links; fewer words than the
n-gram length are one n-gram; rows of equal sets are linked; rows with a null doc_id link
with nothing and have a null component; rows that share a doc_id are one document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import blocks, released, store, sub_rows
from tickweave.llm.graph import components

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C55)  # odd, so it has an inverse modulo 2^64
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
#: Slots, as powers of two, of the tables of large buckets and of keys that sets share.
_LEVEL_BITS = (22, 24)
_SHARED_BITS = (24, 27)
#: Sets of a bucket whose token goes to the end of the order.
_LARGE = 8
#: Bits of the filters that find the documents to verify; bounds what is broadcast.
_FILTER_BITS = 24
#: Bytes of text that a task holds in vectors of 64-bit numbers at a time.
_BLOCK = 1 << 19
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> _U(33)) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ h >> _U(29)) * _U(0xC4CEB9FE1A85EC53)
    return h ^ h >> _U(32)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = max(n, 1 << 20)
        for name, b in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x)
    return _powers["up"], _powers["down"]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased), and words of each text."""
    return words_of(texts)[:2]


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """``word_hashes``, and where each word begins and ends in the lower-cased bytes."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    joined = b" " + b" ".join(raw) + b" "
    data = np.frombuffer(joined, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    up, down = _power(len(data) + 1)
    total = np.cumsum((data.astype(np.uint64) + _U(1)) * up[:len(data)])
    h = (total[end - 1] - total[begin - 1]) * down[begin]
    start = np.cumsum([1] + [len(b) + 1 for b in raw])
    return mix(h ^ (end - begin).astype(np.uint64) * _U(0xD6E8FEB86659FD93)), np.diff(np.searchsorted(begin, start)), begin, end, joined


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    h, counts = word_hashes(texts)
    factor = mix(np.arange(1, words + 1, dtype=np.uint64)) | _U(1)
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for i in range(words):
        rolled += h[i:len(h) - words + 1 + i] * factor[i]
    rolled = mix(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            s = np.sort(rolled[at:at + n - words + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif n:
            out.append(mix(np.array([(h[at:at + n] * factor[:n]).sum() + _U(n)], np.uint64)))
        else:
            out.append(h[:0])
        at += n
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    return tuple(int(mix(s ^ _U(k)).sum(dtype=np.uint64).astype(np.int64)) for k in (0x1B873593CC9E2D51, 0x5851F42D4C957F2D))


def _required(n, percent: int):
    return -(-percent * n // 100)


def choose_boundary(sizes: dict[int, int], percent: int, scan_cost: float = 1.5, top: int = 512) -> int:
    """The largest set size that enumerates subsets: of least cost over the histogram. A
    subset costs 1, a posting 1 + ``scan_cost`` (scanning and checking its list)."""
    best, cost = 0, None
    for x in range(0, top + 1):
        light = sum(c * (k + 2) * (k + 1) / 2 for n, c in sizes.items() if n <= x for k in [n - _required(n, percent)])
        heavy = sum(c * (k + 1) * (1 + scan_cost) for n, c in sizes.items() if n >= percent * (x + 1) / 100
                    for k in [n - _required(n, percent)])
        if cost is None or light + heavy < cost:
            best, cost = x, light + heavy
    return best


def _scan(docs: DataFrame, words: int) -> DataFrame:
    """Each document's set size and fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch, limit=_BLOCK):
                sets = shingle_sets(texts, words)
                prints = [fingerprint(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [sub_rows(batch, "doc_id", first, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64())],
                    names=["doc_id", "n", "s1", "s2"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {kind}, n long, s1 long, s2 long")


class Slots:
    """Small numbers by hash: of all hashes that share a slot, the largest number."""

    #: Words of the table that tasks lay out in one piece of bytes.
    PIECE = 1 << 13

    def __init__(self, width: int, bits: int, data: np.ndarray):
        self.width, self.bits, self.data = width, bits, data

    @staticmethod
    def of(hashes: DataFrame, value: F.Column, width: int, least: int, most: int) -> "Slots":
        """Of the column ``h``, with ``value`` below 2^width: 64 slots for each hash, within
        2^least and 2^most, packed into words and those into pieces of bytes by Spark. The driver
        gets a row for each piece, not for each word, which as Python rows are 20 times as large."""
        n = hashes.count()
        bits = min(most, max(least, math.ceil(math.log2(64 * n + 1))))
        per = 64 // width
        slot = F.shiftrightunsigned("h", 64 - bits)
        place = (F.col("slot") % per * width).cast("int")
        words = hashes.groupBy(slot.alias("slot")).agg(F.max(value).alias("v")) \
            .groupBy(F.floor(F.col("slot") / per).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.col("v").cast("long"), place)).alias("bits"))
        piece = Slots.PIECE

        def laid(rows: pa.Table) -> pa.Table:
            word, data = rows["word"].to_numpy(), np.zeros(piece, np.int64)
            data[word % piece] = rows["bits"].to_numpy()
            return pa.table({"piece": word[:1] // piece, "data": pa.array([data.tobytes()], pa.binary())})

        pieces = words.groupBy(F.floor(F.col("word") / piece).alias("piece")).applyInArrow(laid, "piece long, data binary")
        data = np.zeros((1 << bits) // per, np.int64)
        for r in pieces.collect():
            at = r["piece"] * piece
            data[at:at + piece] = np.frombuffer(r["data"], np.int64)[:len(data) - at]
        return Slots(width, bits, data)

    def at(self, h: np.ndarray) -> np.ndarray:
        slot, per = (h >> _U(64 - self.bits)).astype(np.int64), 64 // self.width
        return self.data[slot // per] >> (slot % per * self.width) & ((1 << self.width) - 1)


def _keys(s: np.ndarray, percent: int, boundary: int, levels: Slots) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a set (sorted hashes), and the place in its prefix from 1 that each
    stands for (0 for a subset)."""
    n = len(s)
    k = n - _required(n, percent)
    level = levels.at(s)
    if level.any():
        s = s[np.argsort(level, kind="stable")]
    keys, places = [], []
    if n <= boundary:
        a, b = np.array(list(combinations(range(min(n, k + 2)), 2))).T
        pair = np.sort(np.stack([s[a], s[b]]), 0)
        keys.append(mix(pair[0] * _U(0x9FB21C651E98DF25) + mix(pair[1])))
        places.append(np.zeros(len(a), np.int64))
    if n * 100 >= percent * (boundary + 1):
        keys.append(s[:k + 1])
        places.append(np.arange(1, k + 2))
    return np.concatenate(keys), np.concatenate(places)


def _distinct_sets(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[list[np.ndarray]]:
    """A task's sets that sets of another size can link with, without most repeats."""
    seen: set[int] = set()
    for batch in batches:
        for _, texts in blocks(batch, limit=_BLOCK):
            out = []
            for s in shingle_sets(texts, words):
                n = len(s)
                # sizes no other set can link with: only equal sets do, and they are one node
                if n < 2 or _required(n, percent) == n and n * 100 // percent == n:
                    continue
                me = fingerprint(s)[0]
                if me not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(me)
                    out.append((me, s))
            if out:
                yield out


def _counted(docs: DataFrame, words: int, percent: int, least: int, keys: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """h, n of the hashes that ``keys`` gives for ``least`` sets or more; equal sets count once
    a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _distinct_sets(batches, words, percent):
            h = np.concatenate([keys(s) for _, s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return docs.select("text").mapInArrow(released(run), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _token_levels(docs: DataFrame, words: int, percent: int) -> Slots:
    """The doublings of the sets that hold a token, as far as buckets show it to be in many:
    first of prefix tokens in hash order, then of all tokens of the sets whose prefix has
    such tokens for a quarter, as those of passages and groups of near copies."""
    doublings = F.least(F.lit(15), F.floor(F.log2(F.col("n").cast("double"))).cast("int") - int(math.log2(_LARGE)) + 1)
    prefix = lambda s: s[:len(s) - _required(len(s), percent) + 1]
    first = store(_counted(docs, words, percent, _LARGE, prefix), "large-buckets")
    shared = docs.sparkSession.sparkContext.broadcast(Slots.of(first, doublings, 4, *_LEVEL_BITS))

    def whole(s: np.ndarray) -> np.ndarray:
        large = shared.value.at(prefix(s)) > 0
        return s if 4 * large.sum() >= len(large) else s[:0]

    more = store(_counted(docs, words, percent, _LARGE, whole), "large-tokens")
    return Slots.of(first.unionByName(more), doublings, 4, *_LEVEL_BITS)


def _postings(docs: DataFrame, words: int, percent: int, boundary: int, levels: Slots, shared_keys: Slots) -> DataFrame:
    """key, s1, size_at (size << 32 | place in the prefix from 1, 0 for a subset): subset keys
    of small sets, prefix tokens of the others, as far as two sets have them. One row each
    within a task for equal sets."""
    shared = docs.sparkSession.sparkContext.broadcast((levels, shared_keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, wanted = shared.value
        for sets in _distinct_sets(batches, words, percent):
            keys, ids, sizes, places = [], [], [], []
            for me, s in sets:
                key, place = _keys(s, percent, boundary, levels)
                there = wanted.at(key) > 0
                keys.append(key[there])
                places.append(place[there])
                ids.append(np.full(len(keys[-1]), me, np.int64))
                sizes.append(np.full(len(keys[-1]), len(s), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids)),
                 pa.array(np.concatenate(sizes) << 32 | np.concatenate(places))], names=["key", "s1", "size_at"])

    return docs.select("text").mapInArrow(released(run), "key long, s1 long, size_at long")


def _may_link(a: str, b: str, percent: int) -> F.Column:
    """Size and position filter of two bucket members; both hold for every pair that links at
    the first token it shares. Subset buckets have no position (-1)."""
    return F.expr(f"""
        least({a}_n, {b}_n) * 100 >= {percent} * greatest({a}_n, {b}_n) and
        100 * least({a}_n - greatest({a}_at, 0), {b}_n - greatest({b}_at, 0)) >=
        {percent} * ({a}_n + {b}_n - least({a}_n - greatest({a}_at, 0), {b}_n - greatest({b}_at, 0)))""")


def _passing(df: DataFrame, column: str, hashes: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` (long) may be in the column ``h`` of ``hashes``.

    The filter is a broadcast table of 2^FILTER_BITS bits (262,144 rows at most), whatever the
    number of hashes: it passes every member, and the more members the more others as well."""
    at = lambda c: F.pmod(c, F.lit(1 << _FILTER_BITS))
    words = hashes.select(at(F.col("h")).alias("h")).groupBy(F.shiftright("h", 6).alias("_word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("_bits"))
    return df.withColumn("_at", at(F.col(column))).withColumn("_word", F.shiftright("_at", 6)).join(F.broadcast(words), "_word") \
        .where(F.expr("shiftrightunsigned(_bits, cast(_at & 63 as int)) & 1 = 1")).drop("_word", "_at", "_bits")


def _bitmap(s: np.ndarray) -> bytes:
    """One bit set for each token's bucket, four buckets or more a token; the buckets are low
    bits of the tokens, so a longer bitmap folds to a shorter one by OR of its halves."""
    n = 1 << max(9, int(4 * len(s) - 1).bit_length())
    bits = np.zeros(n, np.uint8)
    bits[(s & _U(n - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _lacking(x: bytes, y: bytes) -> tuple[int, int]:
    """Bits of each bitmap that the other lacks, at the shorter's length."""
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(p) > len(q):
        p = p[:len(p) // 2] | p[len(p) // 2:]
    while len(q) > len(p):
        q = q[:len(q) // 2] | q[len(q) // 2:]
    return int(np.bitwise_count(p & ~q).sum()), int(np.bitwise_count(q & ~p).sum())


def _of_nodes(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, tokens: bool) -> DataFrame:
    """s1 and the tokens, or else the bitmap, of the sets in ``wanted`` (s1) and a few others."""
    ids = wanted.join(nodes, "s1").select(F.xxhash64("doc_id").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in blocks(batch, limit=_BLOCK):
                sets = [s for s in shingle_sets(texts, words) if len(s)]
                data = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())) if tokens else pa.array(map(_bitmap, sets), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s)[0] for s in sets], pa.int64()), data], names=["s1", "data"])

    return _passing(docs.where("doc_id is not null").withColumn("_h", F.xxhash64("doc_id")), "_h", ids).select("text") \
        .mapInArrow(released(run), "s1 long, data " + ("array<long>" if tokens else "binary")).join(wanted, "s1", "left_semi").dropDuplicates(["s1"])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b: s1 of two sets) whose whole sets link.

    Bitmaps go first: every bit of one set that the other lacks is a token that the other
    lacks, so two sets of sizes x and y that link differ by at most x - t or y - t bits, with
    t the intersection that their sizes ask for. What is left is intersected token by token."""
    sizes = nodes.select("s1", "n")
    maps = store(_of_nodes(_ends(pairs), nodes, docs, words, False).join(sizes, "s1"), "bitmaps")
    side = lambda df, k, x, *more: df.select(F.col("s1").alias(k), F.col("data").alias(x), *more)

    @F.pandas_udf("boolean")
    def close(x, y, a_n, b_n, least):
        import pandas as pd

        ok = [p <= n - t and q <= m - t for (p, q), n, m, t in zip(map(_lacking, x, y), a_n, b_n, least)]
        return pd.Series(ok, dtype=bool)

    # 100 * i >= percent * (x + y - i)  <=>  i >= percent * (x + y) / (100 + percent)
    near = pairs.join(side(maps, "a", "x", F.col("n").alias("a_n")), "a").join(side(maps, "b", "y", F.col("n").alias("b_n")), "b") \
        .withColumn("least", F.ceil(F.expr(f"{percent} * (a_n + b_n) / (100 + {percent}) - 1e-9"))) \
        .where(close("x", "y", "a_n", "b_n", "least")).select("a", "b")
    near = store(near, "near-pairs")
    sets = store(_of_nodes(_ends(near), nodes, docs, words, True), "sets")
    return near.join(side(sets, "a", "x"), "a").join(side(sets, "b", "y"), "b").withColumn("both", F.size(F.array_intersect("x", "y"))) \
        .where(F.expr(f"100 * both >= {percent} * (size(x) + size(y) - both)")).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("s1")).union(pairs.select("b")).distinct()


def _started(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, ...]:
    """Set sizes, distinct sets, bucket members, pairs of members with pivots, and those of the
    pairs that link."""
    docs = docs.select("doc_id", "text")
    rows = store(_scan(docs, words), "set-sizes")
    nodes = store(rows.where("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "nodes")
    sizes = {r["n"]: r["count"] for r in nodes.where("n <= 1024").groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, percent)
    # one document of each set does for the rest, and a few others that share its filter's bits
    chosen = _passing(docs.where("doc_id is not null").withColumn("_h", F.xxhash64("doc_id")), "_h", nodes.select(F.xxhash64("doc_id").alias("h")))
    levels = _token_levels(chosen, words, percent)
    order = docs.sparkSession.sparkContext.broadcast(levels)
    several = store(_counted(chosen, words, percent, 2, lambda s: _keys(s, percent, boundary, order.value)[0]).select("h"), "shared-keys")
    postings = _postings(chosen, words, percent, boundary, levels, Slots.of(several, F.lit(1), 1, *_SHARED_BITS))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    members = store(postings.select(
        "key", "s1", F.shiftright("size_at", 32).alias("n"), F.expr("cast(size_at & 4294967295 as int) - 1").alias("at")).distinct().withColumn("band", band), "members")
    # every member against one pivot of its bucket and size band: the one with the fewest rarer
    # n-grams before the bucket's, which of a group of near copies is one with few edits of its
    # own; of several such each bucket draws another
    pivots = members.groupBy("key", "band").agg(F.min(F.struct("at", F.xxhash64("key", "s1").alias("draw"), "s1", "n")).alias("p")) \
        .select("key", "band", F.col("p.s1").alias("a"), F.col("p.n").alias("a_n"), F.col("p.at").alias("a_at"))
    stars = members.select("key", "band", F.col("s1").alias("b"), F.col("n").alias("b_n"), F.col("at").alias("b_at")) \
        .join(pivots, ["key", "band"]).where("a != b").where(_may_link("a", "b", percent)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    stars = store(stars, "star-pairs")
    first = store(_verified(stars, nodes, docs, words, percent), "star-links")
    return rows, nodes, members, stars, first


def link(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text): sets of
    ``words``-word n-grams, linked where 100 * intersection >= ``percent`` * union."""
    docs = docs.select("doc_id", "text")
    rows, nodes, members, stars, first = _started(docs, words, percent)
    grouped = components(first)
    # members of one bucket that are still apart
    placed = members.join(grouped.select(F.col("node").alias("s1"), "component"), "s1", "left") \
        .withColumn("component", F.coalesce("component", "s1"))
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
    apart = store(placed.join(split, "key"), "apart")
    side = lambda x: apart.select("key", F.col("s1").alias(x), F.col("n").alias(f"{x}_n"), F.col("at").alias(f"{x}_at"),
                                  F.col("component").alias(f"{x}_c"))
    rest = side("a").join(side("b"), "key").where("a < b and a_c != b_c").where(_may_link("a", "b", percent)).select("a", "b").distinct()
    rest = store(rest.join(stars, ["a", "b"], "left_anti"), "rest-pairs")
    links = first.union(_verified(rest, nodes, docs, words, percent))
    named = nodes.select("s1", "doc_id")
    edges = links.join(named.select(F.col("s1").alias("a"), F.col("doc_id").alias("u")), "a") \
        .join(named.select(F.col("s1").alias("b"), F.col("doc_id").alias("v")), "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
    found = components(edges)
    of_set = nodes.select("s1", "s2", F.col("doc_id").alias("node")).join(found, "node", "left") \
        .select("s1", "s2", F.coalesce("component", "node").alias("component"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("s1")).alias("s1"), "s2") \
        .join(of_set, ["s1", "s2"], "left") \
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def links(docs: DataFrame, words: int = 4, percent: int = 85, cell: int = 512) -> DataFrame:
    """a, b (a < b) of all pairs of different sets that link; a set is named by the smallest
    doc_id that has it.

    ``link`` leaves out pairs of members that it has joined through others; here all members of
    a bucket meet, in cells of about ``cell`` members against another. The pairs of a group of
    near copies with different texts grow with its square, as the result does."""
    docs = docs.select("doc_id", "text")
    _, nodes, members, stars, first = _started(docs, words, percent)
    cells = members.groupBy("key").agg(F.expr(f"count(*) div {cell} + 1").alias("cells"))
    mine = F.pmod(F.xxhash64("s1", F.lit(5)), F.col("cells"))
    dealt = members.join(cells, "key").withColumn("mine", mine).withColumn("other", F.explode(F.expr("sequence(0L, cells - 1)"))) \
        .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
    side = lambda x, at: dealt.where(f"mine = {at}").select("key", "lo", "hi", F.col("s1").alias(x), F.col("n").alias(f"{x}_n"), F.col("at").alias(f"{x}_at"))
    met = side("a", "lo").join(side("b", "hi"), ["key", "lo", "hi"]).where("lo < hi or a < b").where(_may_link("a", "b", percent)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()
    rest = store(met.join(stars, ["a", "b"], "left_anti"), "rest-pairs")
    named = nodes.select("s1", "doc_id")
    return first.union(_verified(rest, nodes, docs, words, percent)) \
        .join(named.select(F.col("s1").alias("a"), F.col("doc_id").alias("u")), "a").join(named.select(F.col("s1").alias("b"), F.col("doc_id").alias("v")), "b") \
        .select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that link to one with a smaller doc_id (directly or
    through others); all columns as they are."""
    gone = link(docs, words, percent).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
