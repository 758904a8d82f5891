"""Shared helpers of the training-data operators.

Defined results that hold for every operator here: a null text counts as the empty text;
a null ``doc_id`` is an ordinary (single) id value; repeated rows each get their own result
row; extra columns of the input are ignored because only the named columns are selected; an
empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.session import scratch_dir

#: Characters of text that one vectorised step holds at a time.
BLOCK_CHARS = 1 << 21


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage is cut and a
    lost executor costs no recomputation of what stands above."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key() -> F.Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def crc_mod(column: str, n: int) -> F.Column:
    """crc32 of the id's decimal text, mod n; null ids count as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0))


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows holding about ``limit`` bytes; a longer text
    stands alone. Null texts come as the empty text; only one block is held as Python text."""
    texts = batch.column(batch.schema.get_field_index(column))
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = total[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(total, before + limit, "right")))
        yield first, [t or "" for t in texts.slice(first, end - first).to_pylist()]
        first = end


def sub_rows(batch: pa.RecordBatch, column: str, first: int, n: int) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column)).slice(first, n)


def words_of(data: bytes, table: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """Maximal runs of the bytes that ``table`` (as of bytes.translate) does not turn into a
    blank, in lists of about ``step`` bytes, so a long text's words are never all held."""
    data = data.translate(table)
    first = 0
    while first < len(data):
        end = len(data) if len(data) - first <= step else data.find(b" ", first + step)
        end = len(data) if end < 0 else end
        yield data[first:end].split()
        first = end


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task function that gives its freed memory back to the system when it ends; the
    workers live on, two or more to an executor."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return task


class Remembered(dict):
    """What a worker remembers by text from block to block: about ``limit`` bytes. After
    a block ``end`` forgets long texts, and everything once the limit is passed."""

    LONGEST = 64

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held, self._long = limit, 0, []

    def __setitem__(self, text: str, value) -> None:
        super().__setitem__(text, value)
        if len(text) > self.LONGEST:
            self._long.append(text)
        else:
            self.held += 160 + 2 * len(text) + (len(value) if isinstance(value, bytes) else 32)

    def keep(self, texts: list[str], values: list[bytes]) -> None:
        """Remember many new texts at once."""
        self.update(zip(texts, values, strict=True))
        long = [i for i, t in enumerate(texts) if len(t) > self.LONGEST]
        self._long += [texts[i] for i in long]
        self.held += 160 * (len(texts) - len(long)) + 2 * (sum(map(len, texts)) - sum(len(texts[i]) for i in long)) \
            + sum(map(len, values)) - sum(len(values[i]) for i in long)

    def end(self) -> None:
        for text in self._long:
            self.pop(text, None)
        self._long.clear()
        if self.held > self.limit:
            self.clear()
            self.held = 0
