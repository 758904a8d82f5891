"""Document fingerprints by Order MinHash, which is sensitive to edit distance.

A text's elements are its character k-mers, each numbered by its occurrence, so a repeated
k-mer is not one element. For each of m hash functions the l elements of least hash are
selected, put back into text order, and the tuple of their k-mers is hashed: two texts agree
on a tuple if they select the same k-mers in the same order. The fingerprint is the m tuple
hashes in hex; the likeness of two fingerprints is their share of equal places.

Edge cases: a text shorter than k is one k-mer; the empty text has the fingerprint of no
k-mers, and is like itself alone; a text of fewer than l elements selects all of them; equal
texts have equal fingerprints; null counts as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.ngram_join import mix

_U = np.uint64


class OrderMinHash:
    def __init__(self, m: int = 64, l: int = 2, k: int = 6):
        self.m, self.l, self.k = m, l, k
        self._odd = (mix(np.arange(1, m + 1, dtype=np.uint64)) >> _U(32) | _U(1)).astype(np.uint32)
        self._factor = mix(np.arange(100, 100 + k, dtype=np.uint64)) | _U(1)

    def elements(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-mers in text order, and of the occurrence-numbered k-mers."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(code):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        n = max(1, len(code) - self.k + 1)
        kmer = np.zeros(n, np.uint64)
        for i in range(min(self.k, len(code))):
            kmer += (code[i:i + n].astype(np.uint64) + _U(1)) * self._factor[i]
        kmer = mix(kmer)
        order = np.argsort(kmer, kind="stable")
        s = kmer[order]
        first = np.r_[True, s[1:] != s[:-1]]
        at = np.arange(n)
        number = np.empty(n, np.uint64)
        number[order] = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
        return kmer, (mix(kmer + number * _U(0x9E3779B97F4A7C15)) >> _U(32)).astype(np.uint32)

    def sketch(self, text: str) -> np.ndarray:
        """m tuple hashes (32 bits)."""
        kmer, element = self.elements(text)
        if not len(kmer):
            return np.zeros(self.m, np.uint32)
        l = min(self.l, len(kmer))
        picks = np.empty((self.m, l), np.int64)
        step = max(1, (1 << 21) // len(element))  # long texts a few functions at a time
        for j in range(0, self.m, step):
            h = self._odd[j:j + step, None] * element[None, :]
            row = np.arange(len(h))
            for i in range(l):
                picks[j:j + step, i] = at = h.argmin(axis=1)
                h[row, at] = np.uint32(0xFFFFFFFF)
        picks.sort(axis=1)
        out = np.full(self.m, _U(l))
        for i in range(l):
            out = mix(out * _U(0x9FB21C651E98DF25) + kmer[picks[:, i]])
        return (out >> _U(32)).astype(np.uint32)


def fingerprint(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame, m: int = 64, l: int = 2, k: int = 6) -> DataFrame:
    """doc_id and fingerprint of every row of ``docs`` (doc_id, text). No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = OrderMinHash(m, l, k)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(hasher.sketch(t.as_py() or "")) for t in batch.column(1)], pa.string())],
                names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fingerprint string")


def edited(text: str, other: str) -> str:
    """The last floor(n/4) characters replaced by the first as many of ``other``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + other[:cut]


def edit_digests(docs: DataFrame, m: int = 64, l: int = 2, k: int = 6, bucket_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    of every row of ``docs``, each with the next by ascending doc_id (after the last: the
    first; null ids first, rows of one doc_id by a hash of their text). ``doc_id`` is a number."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = max(1, min(50_000, -(-size // bucket_bytes)))
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("q")).first()["q"] or [])) if n > 1 else []
    if bounds:
        cuts = docs.sparkSession.sparkContext.broadcast(pa.array(bounds).to_numpy(zero_copy_only=False))

        @F.pandas_udf("int")
        def of_range(ids):
            return pd.Series(np.searchsorted(cuts.value, ids.to_numpy(), "right").astype(np.int32))

        bucket = of_range(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))))  # null ids stand first
    else:
        bucket = F.lit(0)
    # one row a range (50,000 at most) reaches the driver: the id and text hash of its first
    key = F.xxhash64("text")
    placed = rows.select("doc_id", key.alias("key")).withColumn("bucket", bucket)
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "key")).alias("f")).orderBy("bucket").collect()
    before = [(r["f"]["doc_id"], r["f"]["key"], firsts[i - 1]["bucket"]) for i, r in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(before, f"head_id {kind}, head_key long, bucket int")
    copies = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (key == F.col("head_key"))) \
        .dropDuplicates(["bucket"]).select("bucket", F.lit(1).alias("place"), "doc_id", "text")
    dealt = rows.select(bucket.cast("int").alias("bucket"), F.lit(0).alias("place"), "doc_id", "text").union(copies) \
        .repartition(max(1, len(firsts)), "bucket").withColumn("text_order", F.xxhash64("text")) \
        .sortWithinPartitions("bucket", "place", F.col("doc_id").asc_nulls_first(), "text_order").drop("text_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = OrderMinHash(m, l, k)
        held = None  # (bucket, id scalar, text, sketch) waiting for its successor

        def result(now, nxt_text, nxt_sketch):
            _, doc, text, sketch = now
            e = edited(text, nxt_text)
            es = hasher.sketch(e)
            return (doc, len(text), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(sketch), fingerprint(es),
                    likeness(sketch, es), likeness(sketch, nxt_sketch))

        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                out = []
                for b, place, doc, text in zip(*(c.to_pylist() for c in part.columns)):
                    sketch = hasher.sketch(text)
                    if held is not None:  # the row before it, of the same range
                        out.append(result(held, text, sketch))
                    held = (b, doc, text, sketch) if not place else None
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], batch.schema.field("doc_id").type), pa.array(cols[1], pa.int64()), *map(pa.array, cols[2:])],
                        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return dealt.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double")
