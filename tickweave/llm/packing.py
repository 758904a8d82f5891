"""Packing of tokenised documents into fixed windows by non-negative least squares.

One pass tokenises every whole text; each document gives its full windows, which are
sequences as they are, and one tail shorter than a window. The histogram of tail lengths
(bounded by the window) goes to the driver: shallow combinations of lengths that fill a
window exactly are enumerated, non-negative least squares finds how often each should be
used, the counts are rounded, largest first, as far as tails are there, and the histogram of
those left over is solved again until no combination fits into it. What then remains is
packed greedily, longest first, end to end, cut where a window is full. So only the very
last sequence is padded. The plan is a list of rank intervals for each length; a tail
finds its place from its rank among the tails of its length, which is counted in salted
cells so that a hot length is no hot task.

Edge cases: null or empty text is the end id alone; equal documents get places of their own;
a window that no tail is left for isn't made; an empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.byte_bpe import _ODD, STEP, cut, read_ranks
from tickweave.llm.common import Remembered, blocks, released, store

#: Bytes that a worker remembers, about, of parts that are not plain; an eighth as many of text beginnings.
REMEMBERED = 64 << 20
#: Characters that every Unicode version classes alike.
_PLAIN, _OTHER = re.compile("[\t\n\r -~¡-ɏ]*"), "[^\t\n\r -~¡-ɏ]"
#: Bytes of text that are tokenised together: the more, the fewer parts come again.
BLOCK_BYTES = 1 << 22
#: Rows that one cell of the rank count holds at most, about.
CELL_ROWS = 50_000


if sys.byteorder != "little":
    raise ImportError("ids are held as little-endian 16-bit numbers")


class Ids:
    """Token ids of whole texts as the tokenizers file gives them; each distinct part of a
    block is tokenised once. ``ranks``, the same vocabulary as a rank file, serves plain
    parts, many joined in one call, which is several times as fast; all others go through the
    file's own tokenizer and are remembered."""

    def __init__(self, path: str, ranks: str | None):
        import tiktoken
        import public_tokenizers
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        if self._tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids are held in 16 bits")
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks:
            held = read_ranks(ranks)
            coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=held, special_tokens={})
            self._fast = lambda text: coder.encode_to_numpy(text, disallowed_special=())
            self._size = np.zeros(max(held.values()) + 1, np.int64)
            self._size[list(held.values())] = [len(b) for b in held]
        self._part, self._head = Remembered(REMEMBERED), Remembered(REMEMBERED >> 3)

    def _encode(self, text: str, special: list[str]) -> bytes:
        if self._fast and _PLAIN.fullmatch(text) and not (special and any(x in text for x in special)):
            return self._fast(text).astype("<u2").tobytes()
        return array("H", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _joined(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain parts, each after a space, and how many each has. They are tokenised as
        one text, as each begins a match with the space before it; its bytes tell its ids."""
        ids, counts = [np.zeros(0, "<u2")], [np.zeros(0, np.int64)]
        for k in range(0, len(parts), STEP):
            some = parts.slice(k, STEP)
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), " ")[0].as_py()
            found = self._fast(" " + text)
            end = np.cumsum(pc.binary_length(some).to_numpy().astype(np.int64) + 1)
            ids.append(found.astype("<u2"))
            counts.append(np.diff(np.searchsorted(np.cumsum(self._size[found]), end) + 1, prepend=0))
        return np.concatenate(ids), np.concatenate(counts)

    def _rare(self, parts: pa.Array, special: list[str]) -> np.ndarray:
        """Which parts the rank file can't serve."""
        if not self._fast:
            return np.ones(len(parts), bool)
        rare = pc.match_substring_regex(parts, _OTHER).to_numpy(zero_copy_only=False)
        for x in special:
            rare |= pc.match_substring(parts, x).to_numpy(zero_copy_only=False)
        return rare

    def __call__(self, texts: list[str]) -> list[bytes]:
        special = [x for x in self._special if any(x in t for t in texts)]
        order, parts, counts = split(texts)
        begin = np.cumsum(counts) - counts
        is_head = np.zeros(len(parts), bool)
        is_head[begin] = True
        heads, coded = parts.filter(pa.array(is_head)).to_pylist(), parts.filter(pa.array(~is_head)).dictionary_encode()
        rare = self._rare(coded.dictionary, special)
        plain, plain_n = self._joined(coded.dictionary.filter(pa.array(~rare)))
        others = coded.dictionary.filter(pa.array(rare)).to_pylist()
        for x in set(others) - self._part.keys():
            self._part[x] = self._encode(" " + x, special)
        for x in set(heads) - self._head.keys():
            self._head[x] = self._encode(x, special)
        held = [*map(self._part.__getitem__, others), *map(self._head.__getitem__, heads)]
        self._part.end(), self._head.end()
        # the ids of plain parts, others and heads stand one after another in this table
        table = np.r_[plain, np.frombuffer(b"".join(held), "<u2")]
        size = np.r_[plain_n, np.fromiter(map(len, held), np.int64, len(held)) // 2]
        start = np.cumsum(size) - size
        place = np.empty(len(rare), np.int64)
        place[~rare], place[rare] = np.arange(len(plain_n)), len(plain_n) + np.arange(len(others))
        row = np.empty(len(parts), np.int64)
        row[is_head] = len(rare) + np.arange(len(heads))
        row[~is_head] = place[coded.indices.to_numpy()]
        size = size[row]
        stop = np.cumsum(size)
        whole = table[np.arange(stop[-1]) + np.repeat(start[row] - (stop - size), size)].tobytes()
        out: list = [b""] * len(texts)
        for i, a, b in zip(order, (2 * (stop - size)[begin]).tolist(), (2 * stop[begin + counts - 1]).tolist()):
            out[i] = whole[a:b]
        return out


def split(texts: list[str]) -> tuple[list[int], pa.Array, np.ndarray]:
    """An order of the texts, their parts (as of ``cut``) one after another, and how many each has."""
    odd = [bool(_ODD.search(t)) for t in texts]
    order = sorted(range(len(texts)), key=odd.__getitem__)
    k = len(texts) - sum(odd)
    even = pc.split_pattern(pa.array([texts[i] for i in order[:k]], pa.string()), " ")
    rest = [cut(texts[i]) for i in order[k:]]
    parts = pa.concat_arrays([even.flatten(), pa.array([x for ps in rest for x in ps], pa.string())])
    return order, parts, np.r_[pc.list_value_length(even).to_numpy().astype(np.int64), np.array([len(ps) for ps in rest], np.int64)]


@lru_cache(maxsize=2)
def _ids(path: str, ranks: str | None) -> Ids:
    return Ids(path, ranks)


def _pieces(docs: DataFrame, path: str | None, end_id: int, window: int) -> DataFrame:
    """rid, doc_id, start, length, doc_tokens, ids (16 bit): full windows and tails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        ids = _ids(path, None) if path else _ids(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
        rid = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for first, texts in blocks(batch, limit=BLOCK_BYTES):
                row, start, length, total, held = [], [], [], [], []
                for i, b in enumerate(ids(texts)):
                    b += end
                    n = len(b) // 2
                    for s in range(0, n, window):
                        row.append(first + i)
                        start.append(s)
                        length.append(min(window, n - s))
                        total.append(n)
                        held.append(b[2 * s:2 * (s + window)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(rid, rid + len(row)), pa.int64()), batch.column(0).take(pa.array(row, pa.int64())),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(total, pa.int64()), pa.array(held, pa.binary())],
                    names=["rid", "doc_id", "start", "length", "doc_tokens", "ids"])
                rid += len(row)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(released(run), f"rid long, doc_id {kind}, start long, length long, doc_tokens long, ids binary")


def combinations(present: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and multiplicities (n x 3, padded by 0) of the shallow combinations that fill
    ``window`` exactly: a x l, a x l + b x m, and l + m + k, over the lengths present."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    rows: list[np.ndarray] = []
    for a in range(1, window + 1):
        l = present[present * a <= window]
        if not len(l):
            break
        rest = window - a * l
        full = l[rest == 0]
        rows.append(np.stack([full, full * 0, full * 0, full * 0 + a, full * 0, full * 0], 1))
        # one other length, b times; for a = b = 1 each pair once
        for b in range(1, 9):
            m = rest // b
            ok = (rest > 0) & (rest % b == 0)
            ok[ok] &= has[m[ok]]
            ok &= (m > l) if a == b else (m != l)
            rows.append(np.stack([l[ok], m[ok], l[ok] * 0, l[ok] * 0 + a, l[ok] * 0 + b, l[ok] * 0], 1))
    for l in present[present * 3 < window]:
        m = present[(present > l) & (present * 2 + l < window)]
        k = window - l - m
        ok = has[k] & (k > m)
        m, k = m[ok], k[ok]
        one = np.ones_like(m)
        rows.append(np.stack([one * l, m, k, one, one, one], 1))
    found = np.concatenate(rows) if rows else np.zeros((0, 6), np.int64)
    return found[:, :3], found[:, 3:]


def solve(lengths: np.ndarray, times: np.ndarray, histogram: np.ndarray, tolerance: float = 1e-3) -> np.ndarray:
    """Non-negative least squares for repeat counts by an active set: combinations of steepest
    descent that share no length join it together, least squares over the set are solved, and
    what comes out negative leaves. A step that doesn't lower the error is taken again with
    the one steepest combination and stops at the first count that reaches 0, which always
    lowers it. The set never holds more combinations than there are lengths. It ends when no
    combination outside would lower the error (steepness below ``tolerance`` of the first) or
    a step lowers it by less than ``tolerance`` squared of the whole."""
    x = np.zeros(len(lengths))
    present, h = np.flatnonzero(histogram), histogram.astype(float)
    place = np.zeros(len(histogram), np.int64)
    place[present] = np.arange(len(present))
    norm = np.sqrt((times.astype(float) ** 2).sum(1))
    active, left, least, first = np.zeros(0, np.int64), h, h @ h, 0.0

    def columns(chosen: np.ndarray) -> np.ndarray:
        a = np.zeros((len(present), len(chosen)))
        np.add.at(a, (place[lengths[chosen]].ravel(), np.repeat(np.arange(len(chosen)), 3)), times[chosen].ravel())
        return a

    while len(x):
        steep = (times * left[lengths]).sum(1) / norm
        steep[active] = 0
        first = first or steep.max()
        if steep.max() <= tolerance * first:
            break
        joins, taken = [], set()
        for c in np.argsort(-steep)[:16 * len(present)].tolist():
            own = {l for l, t in zip(lengths[c].tolist(), times[c].tolist()) if t}
            if steep[c] <= tolerance * first or len(joins) >= max(1, len(present) - len(active)):
                break
            if not own & taken:
                taken |= own
                joins.append(c)
        for new in (joins, joins[:1]):
            chosen = np.r_[active, np.array(new, np.int64)]
            at, a = x[chosen], columns(chosen)
            gram, up = a.T @ a, a.T @ h[present]
            gram[np.diag_indices_from(gram)] += 1e-9
            while True:
                to = np.linalg.solve(gram, up)
                out = to <= 0
                if not out.any():
                    break
                if new is joins:
                    at, keep = to, ~out
                else:
                    part = np.min(at[out] / np.maximum(at[out] - to[out], 1e-300))
                    at = at + part * (to - at)
                    keep = ~(out & (at <= 1e-12 * h.sum()))
                    if keep.all():
                        keep[np.flatnonzero(out)[np.argmin(at[out])]] = False
                chosen, at, a, up, gram = chosen[keep], at[keep], a[:, keep], up[keep], gram[np.ix_(keep, keep)]
            rest = h.copy()
            rest[present] -= a @ to
            if rest @ rest < least:
                break
        gain, least = least - rest @ rest, min(least, rest @ rest)
        if gain <= tolerance ** 2 * (h @ h):
            break
        x[active] = 0
        x[chosen] = to
        active, left = chosen, rest
    return x


class Plan:
    """Where the tail of a length with a rank goes."""

    def __init__(self, histogram: np.ndarray, window: int):
        self.window = window
        left = histogram.astype(np.int64).copy()
        seq, segments = 0, []
        used = np.zeros_like(left)
        while True:
            # what rounding left over is solved again, until no combination fits into it
            lengths, times = combinations(np.flatnonzero(left), window)
            fits = (times <= left[lengths]).all(1) if len(lengths) else np.zeros(0, bool)
            lengths, times = lengths[fits], times[fits]
            if not len(lengths):
                break
            x = solve(lengths, times, left)
            counts = np.maximum(1, np.floor(x + 0.5)).astype(np.int64)
            for c in np.argsort(-x, kind="stable")[:max(1, np.count_nonzero(x))]:
                ls, ts = lengths[c].tolist(), times[c].tolist()
                n = min([int(counts[c]), *(int(left[l]) // t for l, t in zip(ls, ts) if t)])
                if n <= 0:
                    continue
                at = 0
                for l, t in zip(ls, ts):
                    for _ in range(t):
                        segments.append((l, int(used[l]), seq, at))
                        used[l] += n
                        left[l] -= n
                        at += l
                seq += n
        self.planned, self.left = seq, left
        # greedy rest, longest first, end to end
        base = 0
        self.rest_from, self.rest_base = used.copy(), np.zeros_like(left)
        for l in np.flatnonzero(left)[::-1]:
            self.rest_base[l] = base
            base += int(left[l]) * int(l)
        self.sequences = seq + -(-base // window)
        segments.sort()
        s = np.array(segments, np.int64).reshape(-1, 4)
        self._key = s[:, 0] << 44 | s[:, 1]
        self._rank, self._seq, self._at = s[:, 1], s[:, 2], s[:, 3]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """row, cut_start, cut_length, sequence_id, offset: one or two places for each tail."""
        seq, at = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        rest = rank >= self.rest_from[length]
        k = np.searchsorted(self._key, length << 44 | rank, "right") - 1
        p = ~rest
        seq[p], at[p] = self._seq[k[p]] + rank[p] - self._rank[k[p]], self._at[k[p]]
        token = self.rest_base[length] + (rank - self.rest_from[length]) * length
        seq[rest], at[rest] = self.planned + token[rest] // self.window, token[rest] % self.window
        head = np.minimum(length, self.window - at)
        over = np.flatnonzero(head < length)
        row = np.arange(len(length))
        return (np.r_[row, over], np.r_[row * 0, head[over]], np.r_[head, (length - head)[over]], np.r_[seq, seq[over] + 1],
                np.r_[at, over * 0])


def pack(docs: DataFrame, tokenizer_file: str | None = None, end_id: int = 1, window: int = 2048) -> DataFrame:
    """doc_id, start, length, ids (binary, 16 bit little-endian), doc_tokens, sequence_id,
    offset: one row for each piece of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    pieces = store(_pieces(docs, tokenizer_file, end_id, window), "pieces")
    tails = pieces.where(F.col("length") < window).select("rid", "length")
    counts = tails.groupBy("length").count().collect()  # a row for each length below the window
    histogram = np.zeros(window + 1, np.int64)
    for r in counts:
        histogram[r["length"]] = r["count"]
    plan = Plan(histogram, window)
    cells = max(1, -(-int(histogram.max()) // CELL_ROWS))
    celled = tails.withColumn("cell", F.pmod(F.xxhash64("rid"), F.lit(cells)).cast("int"))
    before = celled.groupBy("length", "cell").count().select(
        "length", "cell", (F.sum("count").over(Window.partitionBy("length").orderBy("cell")) - F.col("count")).alias("before"))
    ranked = celled.withColumn("rank", F.row_number().over(Window.partitionBy("length", "cell").orderBy("rid")) - 1) \
        .join(before, ["length", "cell"]).select("rid", "length", (F.col("rank") + F.col("before")).cast("long").alias("rank"))
    shared = spark.sparkContext.broadcast(plan)  # bounded by the combinations of one window

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, *cols = shared.value.place(batch.column(1).to_numpy(), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *map(pa.array, cols)],
                                             names=["rid", "cut_start", "cut_length", "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, "rid long, cut_start long, cut_length long, sequence_id long, offset long")
    cols = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    full = pieces.where(F.col("length") == window).withColumns(
        {"sequence_id": F.col("rid") + F.lit(plan.sequences), "offset": F.lit(0).cast("long")}).select(cols)
    cut_up = pieces.where(F.col("length") < window).join(placed, "rid").select(
        "doc_id", (F.col("start") + F.col("cut_start")).alias("start"), F.col("cut_length").alias("length"),
        F.expr("substring(ids, cast(2 * cut_start + 1 as int), cast(2 * cut_length as int))").alias("ids"),
        "doc_tokens", "sequence_id", "offset")
    return full.unionByName(cut_up)


def with_crc32(packed: DataFrame) -> DataFrame:
    """``packed`` with ids_crc32 over the ids as unsigned 32-bit integers instead of ids."""

    @F.pandas_udf("long")
    def crc(ids):
        return ids.map(lambda b: zlib.crc32(np.frombuffer(b, "<u2").astype("<u4").tobytes()))

    return packed.select("doc_id", "start", "length", crc("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
