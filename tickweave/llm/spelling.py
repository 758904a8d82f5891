"""Spelling variants: words one inserted, deleted or replaced letter apart, by Gram matrices.

1. Words are counted over all whole texts (partial counts in the tasks, then by word).
2. Blocks. Two words one edit apart, the shorter of length L, agree outside some segment of
   L's letters, so each word stands in one block for each segment of a cut of L and of L - 1
   into ``SEGMENTS``: the block of (L, segment, letters before it, letters after it) holds
   words of the adjacent lengths L and L + 1. Blocks beyond ``max_block`` words are cut
   anew, their segment in two halves, until all are small or the segment is a single letter
   (then a block has at most 90 words of length L). Block sizes are counted before any word
   moves, so a hot block never meets in one task.
3. Inside the tasks blocks of like size are stacked; a NumPy product of their letter counts
   gives the squared distances between all words of a block at once. Words one edit apart
   have counts at a squared distance of at most two; such pairs are verified letter by
   letter. A pair counts only in the block whose segment holds the first place where its
   words differ, so it comes out once.
4. A word's form is its most frequent near word, if that is ``ratio`` times as frequent.
   Frequencies grow ``ratio`` fold along a chain of forms, so pointer doubling ends after
   a number of rounds that the largest possible count bounds.

Edge cases: null or empty texts have no words; texts of any length are read whole; a null
doc_id stands as the empty text in the checksum; repeated rows count their words again; of
equally frequent near words the smallest in code-point order is the form; empty tables give
no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import blocks, store, words_of

#: Letters in Latin-1, A-Z lower-cased; all else is a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Segments of the first cut of a length.
SEGMENTS = 3
#: Words of a block that is compared as a whole.
MAX_BLOCK = 1024
#: Distinct words that a task counts before it gives its partial counts.
COUNTED = 200_000
#: Numbers of one stacked product, and letters held for it.
CELLS = 1 << 22

_N_CLASSES = 26 + 0x40
_CLASS = np.full(256, _N_CLASSES, np.int64)
_CLASS[97:123] = range(26)
_CLASS[0xC0:0x100] = range(26, _N_CLASSES)


def count_words(docs: DataFrame, min_chars: int = 7, min_count: int = 2, misspell: int | None = None) -> DataFrame:
    """word, n: runs of letters of at least ``min_chars`` that occur ``min_count`` times.
    With ``misspell`` the run loses the letter at its checksum modulo its length wherever
    that divides the checksum of its doc_id and itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for first, texts in blocks(batch):
                ids = batch.column(0).slice(first, len(texts)).to_pylist()
                for i, t in zip(ids, texts, strict=True):
                    start = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for words in words_of(t.encode("latin-1", "replace"), LETTERS):
                        held = Counter(w for w in words if len(w) >= min_chars)
                        if misspell:
                            for w in list(held):
                                h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                                if h % misspell == 0:
                                    n, at = held.pop(w), h % len(w)
                                    if len(w) > min_chars:
                                        total[w[:at] + w[at + 1:]] += n
                        total.update(held)
                        if len(total) > COUNTED:
                            yield out()
                            total.clear()
        yield out()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _key() -> F.Column:
    """Of a word, ``size`` and the free segment [a, b): what a block's words have in common."""
    tail = F.col("size") - F.col("b")
    return F.xxhash64("size", "a", "b", F.substring(F.col("word"), F.lit(1), F.col("a")),
                      F.when(tail > 0, F.substring(F.col("word"), -tail, tail)).otherwise(""))


def _first_blocks(words: DataFrame, min_chars: int) -> DataFrame:
    chars = F.char_length("word")
    sized = words.withColumn("size", F.explode(F.when(chars > min_chars, F.array(chars, chars - 1)).otherwise(F.array(chars))))
    cut = sized.withColumn("s", F.explode(F.array(*[F.lit(i) for i in range(SEGMENTS)])))
    edge = lambda i: F.floor(i * F.col("size") / SEGMENTS).cast("int")
    return cut.withColumn("a", edge(F.col("s"))).withColumn("b", edge(F.col("s") + 1)).drop("s").withColumn("key", _key())


def _halves(entries: DataFrame) -> DataFrame:
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    part = F.explode(F.array(F.struct(F.col("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b"))))
    return entries.withColumn("part", part).select("word", "n", "size", "part.a", "part.b").withColumn("key", _key())


def compare(codes: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of rows one edit apart. ``codes`` holds ``n_blocks`` blocks of equally many rows
    of zero-padded Latin-1 letters; rows of length 0 are padding."""
    rows, width = codes.shape
    kind = np.float32 if width <= 2048 else np.float64  # sums of squares stay exact
    at = np.arange(rows)[:, None] * (_N_CLASSES + 1) + _CLASS[codes]
    counts = np.bincount(at.ravel(), minlength=rows * (_N_CLASSES + 1)).reshape(rows, -1)[:, :_N_CLASSES].astype(kind)
    counts = counts.reshape(n_blocks, -1, _N_CLASSES)
    square = np.einsum("bij,bij->bi", counts, counts)
    gram = counts @ counts.transpose(0, 2, 1)
    near = square[:, :, None] + square[:, None, :] - 2 * gram <= 2
    length = lengths.reshape(n_blocks, -1)
    short, longer = length == sizes.reshape(n_blocks, -1), length > 0
    near &= short[:, :, None] & longer[:, None, :]
    block, i, j = np.nonzero(near)
    i, j = i + block * length.shape[1], j + block * length.shape[1]
    keep = (lengths[i] < lengths[j]) | (i < j)
    i, j = i[keep], j[keep]
    found_i, found_j = [], []
    for lo in range(0, len(i), max(1, CELLS // width)):
        x, y = i[lo:lo + max(1, CELLS // width)], j[lo:lo + max(1, CELLS // width)]
        s, t = codes[x], codes[y]
        other = s != t
        first = other.argmax(axis=1)
        replaced = (lengths[x] == lengths[y]) & (other.sum(axis=1) == 1)
        moved = (s[:, :-1] != t[:, 1:]) & (np.arange(width - 1) >= first[:, None])
        inserted = (lengths[x] < lengths[y]) & ~moved.any(axis=1)
        here = (first >= a[x]) & ((first < b[x]) | (first == sizes[x]) & (b[x] == sizes[x]))
        ok = (replaced | inserted) & here
        found_i.append(x[ok])
        found_j.append(y[ok])
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _pairs_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; gives (word, other, other_n) both ways for each near pair."""

    def stacked(rows: pa.RecordBatch, starts: np.ndarray, runs: np.ndarray) -> Iterator[pa.RecordBatch]:
        words = rows.column(1)
        n, size, a, b = (rows.column(c).to_numpy() for c in (2, 3, 4, 5))
        deep = 1 << np.ceil(np.log2(np.maximum(runs, 2))).astype(np.int64)
        wide = 1 << np.ceil(np.log2(size[starts] + 2)).astype(np.int64)
        for d, w in {(int(x), int(y)) for x, y in zip(deep, wide, strict=True)}:
            own = np.flatnonzero((deep == d) & (wide == w))
            step = max(1, min(CELLS // (d * d), CELLS // (d * w), CELLS // (d * _N_CLASSES)))
            for lo in range(0, len(own), step):
                of = own[lo:lo + step]
                row = np.repeat(np.arange(len(of)) * d, runs[of]) + (np.arange(runs[of].sum()) - np.repeat(np.cumsum(runs[of]) - runs[of], runs[of]))
                src = np.repeat(starts[of], runs[of]) + (row % d)
                text = [x.encode("latin-1") for x in words.take(pa.array(src)).to_pylist()]
                codes = np.zeros((len(of) * d, w), np.uint8)
                codes[row] = np.frombuffer(b"".join(x.ljust(w, b"\0") for x in text), np.uint8).reshape(-1, w)
                place = np.zeros(len(codes), np.int64)
                place[row] = src
                lengths = np.zeros(len(codes), np.int64)
                lengths[row] = [len(x) for x in text]
                i, j = compare(codes, lengths, size[place], a[place], b[place], len(of))
                if len(i):
                    i, j = place[np.concatenate([i, j])], place[np.concatenate([j, i])]
                    yield pa.RecordBatch.from_arrays([words.take(pa.array(i)), words.take(pa.array(j)), pa.array(n[j])], names=["word", "other", "other_n"])

    def whole(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key = rows.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        runs = np.diff(np.append(starts, len(key)))
        many = runs > 1
        if many.any():
            yield from stacked(rows, starts[many], runs[many])

    left = None
    for batch in batches:
        rows = batch if left is None else pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        key = rows.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))  # the last run may go on
        left = rows.slice(cut)
        if cut:
            yield from whole(rows.slice(0, cut))
    if left is not None:
        yield from whole(left)


def near_pairs(words: DataFrame, min_chars: int = 7, max_block: int = MAX_BLOCK) -> DataFrame:
    """word, other, other_n: each pair of ``words`` (word, n) one edit apart, both ways."""
    entries, out = _first_blocks(words, min_chars), None
    longest = words.agg(F.max(F.char_length("word"))).first()[0] or 0
    for level in range(1 + math.ceil(math.log2(max(2, longest)))):
        counts = entries.groupBy("key", (F.col("b") - F.col("a") > 1).alias("wide")).agg(F.count(F.lit(1)).alias("rows"))
        hot = store(counts.where(F.col("wide") & (F.col("rows") > max_block)).select("key"), f"spelling-hot-{level}")
        last = hot.isEmpty()
        now = entries if last else entries.join(hot, "key", "left_anti")
        sorted_ = now.select("key", "word", "n", "size", "a", "b").repartition("key").sortWithinPartitions("key")
        found = sorted_.mapInArrow(_pairs_of_runs, "word string, other string, other_n long")
        out = found if out is None else out.unionByName(found)
        if last:
            break
        entries = store(_halves(entries.join(hot, "key", "left_semi").drop("key")), f"spelling-entries-{level}")
    return out


def group_variants(words: DataFrame, min_chars: int = 7, ratio: int = 10, max_block: int = MAX_BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of ``words`` (word, n: distinct words)."""
    words = store(words, "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_pairs(words, min_chars, max_block).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= ratio * F.col("n")
    known = store(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")), "spelling-forms")
    links = known.where("form is not null").select("word", F.col("form").alias("root"))
    for r in range(math.ceil(math.log2(1 + math.log(2 ** 63, max(2, ratio))))):
        links = store(links, f"spelling-roots-{r}")
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        links = links.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"))
    return known.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``group_variants`` of all words of ``docs`` (doc_id, text), one in 31 of the (document,
    word) pairs misspelt."""
    return group_variants(count_words(docs, misspell=31))
