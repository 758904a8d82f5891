"""Exact line deduplication across documents, by range-partitioned line hashes.

Every eligible line of every document becomes (128-bit hash of its key, doc_id, positions).
These are range-partitioned by (hash, doc_id) - so a line that a third of all documents
share spans many partitions - and sorted by hash, then document from the largest, then
position. Each partition streams its runs of equal hashes: the first document of a run keeps
its lines; once a third document shows up the others lose theirs. Only the runs at a
partition's two ends can go on in the next partition; their summaries (two a partition)
settle what is left. The result is one compressed keep bitmap for each document that loses
lines, not text.

Edge cases: null or empty text is one empty line; a row with a null doc_id holds no line
against others and keeps all of its own; repeated rows of one doc_id count as one document
and lose the same lines; keys shorter than ``min_chars`` are never dropped; a text whose
every line goes becomes the empty text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import fresh, store, text_key

_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: str) -> str:
    """White space stripped at both ends, A-Z lower-cased."""
    line = line.strip(_SPACE)
    return line.lower() if line.isascii() else line.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, doc_id, text_key, n_lines, positions: a row for each eligible key of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            ids, keys, texts = (batch.column(i) for i in range(3))
            for lo in range(0, len(texts), 500):
                row, halves, count, positions = [], [], [], []
                for i, t in enumerate(texts.slice(lo, 500).to_pylist()):
                    lines = (t or "").split("\n")
                    found: dict[bytes, list[int]] = {}
                    for p, line in enumerate(lines):
                        if len(line) >= min_chars and len(k := line_key(line)) >= min_chars:
                            found.setdefault(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass")), []).append(p)
                    row += [lo + i] * len(found)
                    count += [len(lines)] * len(found)
                    halves += found
                    positions += found.values()
                h = np.frombuffer(b"".join(halves), ">i8").astype(np.int64).reshape(-1, 2)
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), ids.take(at), keys.take(at), pa.array(count, pa.int32()),
                     pa.array(positions, pa.list_(pa.int32()))],
                    names=["h1", "h2", "doc_id", "text_key", "n_lines", "positions"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.where("doc_id is not null").select("doc_id", text_key().alias("text_key"), "text") \
        .mapInArrow(run, f"h1 long, h2 long, doc_id {kind}, text_key long, n_lines int, positions array<int>")


class _Runs:
    """Streams rows sorted by (hash, doc_id descending); ``out`` gets what is decided."""

    def __init__(self, min_docs: int):
        self.min_docs, self.first, self.hash, self.out = min_docs, True, None, []

    def row(self, h: tuple, doc, rest: tuple) -> None:
        if h != self.hash:
            self.close(last=False)
            self.hash, self.top, self.last_doc, self.n, self.waiting = h, doc, doc, 1, []
        elif doc != self.last_doc:
            self.last_doc = doc
            self.n += 1
            if self.n == self.min_docs and not self.first:
                self.out += [("drop", h, *w) for w in self.waiting]
                self.waiting = []
        if self.first:  # larger documents may stand in the partition before
            self.out.append(("open", h, doc, *rest))
        elif doc != self.top:
            if self.n >= self.min_docs:
                self.out.append(("drop", h, doc, *rest))
            else:
                self.waiting.append((doc, *rest))

    def close(self, last: bool) -> None:
        if self.hash is not None:
            if self.first or last:
                self.out.append(("run", self.hash, self.top, None, self.n, None))
            if last and not self.first:
                self.out += [("open", self.hash, *w) for w in self.waiting]
            self.first = False


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, text_key, n_lines, n_dropped, keep_bitmap of the rows of ``docs`` (doc_id,
    text) that lose lines; all other rows keep every line.

    ``keep_bitmap`` is zlib over the bits of the lines (1: stays), first line first.
    ``text_key`` is xxhash64 of the text, for rows that share a doc_id."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["kind", "h1", "h2", "doc_id", "text_key", "n_lines", "positions"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(min_docs)
        types = None

        def flush() -> pa.RecordBatch:
            rows, runs.out = runs.out, []
            cols = [[r[0] for r in rows], [r[1][0] for r in rows], [r[1][1] for r in rows],
                    *([r[i] for r in rows] for i in (2, 3, 4, 5))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for batch in batches:
            types = [pa.string(), *batch.schema.types]
            for lo in range(0, batch.num_rows, 20_000):
                h1, h2, *rest = (c.to_pylist() for c in batch.slice(lo, 20_000).columns)
                for a, b, doc, key, n, pos in zip(h1, h2, *rest):
                    runs.row((a, b), doc, (key, n, pos))
                if runs.out:
                    yield flush()
        runs.close(last=True)
        if runs.out:
            yield flush()

    rows = store(_occurrences(docs, min_chars), "line-occurrences")
    streamed = store(
        rows.repartitionByRange("h1", "h2", F.col("doc_id").desc())
        .sortWithinPartitions("h1", "h2", F.col("doc_id").desc(), "text_key")
        .mapInArrow(stream, f"kind string, h1 long, h2 long, doc_id {kind}, text_key long, n_lines int, positions array<int>"),
        "line-runs")
    # two summaries a partition at most, so this side of the join may be sent to all
    ends = streamed.where("kind = 'run'").groupBy("h1", "h2").agg(F.sum("n_lines").alias("docs"), F.max("doc_id").alias("top"))
    settled = streamed.where("kind = 'open'").join(F.broadcast(ends), ["h1", "h2"]) \
        .where((F.col("docs") >= min_docs) & (F.col("doc_id") != F.col("top")))
    drops = streamed.where("kind = 'drop'").select("doc_id", "text_key", "n_lines", "positions") \
        .unionByName(settled.select("doc_id", "text_key", "n_lines", "positions"))

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column(2).to_pylist()
            dropped, maps = [], []
            for n, gone in zip(lines, batch.column(3).to_pylist()):
                bits = np.ones(n, np.uint8)
                bits[gone] = 0
                dropped.append(int(n - bits.sum()))
                maps.append(zlib.compress(np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(dropped, pa.int32()), pa.array(maps, pa.binary())],
                names=["doc_id", "text_key", "n_lines", "n_dropped", "keep_bitmap"])

    return drops.groupBy("doc_id", "text_key").agg(F.first("n_lines").alias("n_lines"), F.flatten(F.collect_list("positions")).alias("gone")) \
        .mapInArrow(bitmaps, f"doc_id {kind}, text_key long, n_lines int, n_dropped int, keep_bitmap binary")


def kept_text(text: str, keep_bitmap: bytes | None) -> str:
    """The text without its dropped lines."""
    if keep_bitmap is None:
        return text
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(keep_bitmap), np.uint8))[:len(lines)]
    return "\n".join([x for x, k in zip(lines, keep) if k])


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, name: str) -> DataFrame:
    """All rows and columns of ``docs`` and the bitmap as ``name`` (null: all lines stay)."""
    doc, key = fresh(docs, "doc_of_bitmap"), fresh(docs, "key_of_bitmap")
    found = bitmaps.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.col("keep_bitmap").alias(name))
    return docs.join(found, (F.col("doc_id") == F.col(doc)) & (text_key() == F.col(key)), "left").drop(doc, key)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``; every row and column stays. A
    column ``n_chars`` follows the text."""

    @F.pandas_udf("string")
    def cut(text, bitmap):
        return text.combine(bitmap, lambda t, b: t if t is None else kept_text(t, b))

    name = fresh(docs, "keep_bitmap")
    out = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs), name)
    out = out.withColumn("text", F.when(F.col(name).isNull(), F.col("text")).otherwise(cut("text", name)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(name).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(docs.columns)


def line_digests(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, left, sha = [], [], []
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                for t, b in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    kept = kept_text(t or "", b)
                    n.append((t or "").count("\n") + 1)
                    gone = 0 if b is None else n[-1] - int(np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8))[:n[-1]].sum())
                    left.append(gone)
                    sha.append(hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(left, pa.int64()), pa.array(sha)],
                                             names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    rows = docs.select("doc_id", "text")
    return with_bitmaps(rows, keep_bitmaps(rows, min_chars, min_docs), "keep_bitmap") \
        .mapInArrow(run, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string")
