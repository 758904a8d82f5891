"""Byte-level BPE encoding and decoding with length-bucketed padded numpy matrices.

Every match of the public split pattern merges on its own. A block's new matches are laid
out as rows of padded matrices, one matrix per length bucket; each round every row merges
its leftmost minimum-rank pair, found by hashed pair lookup; finished rows are compacted
away, and columns too once half of a matrix is dead. A match that is itself in the rank
file is its own token, as the public encoder has it.

Edge cases: null or empty text has no tokens and decodes to nothing; invalid or unusual
characters are only bytes; special-token strings are ordinary text; repeated rows each get
a row; nothing is truncated.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickweave.llm.common import Remembered, blocks, released, sub_rows
from tickweave.llm.pairs import NONE, PairTable, merge_one

#: A space before one of these always begins a match, so a text may be cut there.
_CUT = re.compile(" (?=[!-~¡-ɏ])")
_ODD = re.compile(" (?![!-~¡-ɏ])")
#: Bytes of the longest rows that share a matrix; longer matches merge alone, by a heap.
LONG = 512
#: Bytes that a worker remembers, about, of parts; of matches and of beginnings, half and an eighth as many.
REMEMBERED = 96 << 20
#: Cells of a padded matrix, and parts that are split together.
CELLS, STEP = 1 << 18, 1 << 16


def cut(text: str) -> list[str]:
    """Parts of the text; all but the first have lost the space before them."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self._find = regex.compile(pattern).findall
        self._ranks = ranks
        left, right, merged = [], [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(r)
        m = np.array(merged, np.int32)
        self._table = PairTable(np.array(left, np.int64), np.array(right, np.int64), m, m)
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            self.vocabulary[r] = token
        self._match, self._part, self._head = (Remembered(REMEMBERED >> k) for k in (1, 0, 3))

    def merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece of bytes."""
        return [np.frombuffer(x, "<i4") for x in self.merge_bytes(pieces)]

    def merge_bytes(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece of bytes, as little-endian 32-bit integers."""
        out: list = [None] * len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(lens > LONG):
            out[i] = merge_one(self._byte[np.frombuffer(pieces[i], np.uint8)], self._table).astype("<i4").tobytes()
        top = 4
        while top <= LONG:
            rows = np.flatnonzero((lens <= top) & (lens > (top // 2 if top > 4 else 0)))
            step = max(1, CELLS // top)
            for k in range(0, len(rows), step):
                self._bucket(pieces, rows[k:k + step], lens, out)
            top *= 2
        return out

    def _bucket(self, pieces: list[bytes], rows: np.ndarray, lens: np.ndarray, out: list) -> None:
        width = int(lens[rows].max())
        raw = b"".join([pieces[i].ljust(width, b"\0") for i in rows.tolist()])
        ids = self._byte[np.frombuffer(raw, np.uint8)].reshape(len(rows), width)
        size = lens[rows].copy()
        rank, merged = self._ranked(ids, size)
        while len(rows):
            at = rank.argmin(axis=1)
            line = np.arange(len(rows))
            done = rank[line, at] == NONE
            if done.any():
                ended, w = ids[done].astype("<i4").tobytes(), 4 * ids.shape[1]
                for k, (i, n) in enumerate(zip(rows[done].tolist(), size[done].tolist())):
                    out[i] = ended[k * w:k * w + 4 * n]
                stay = ~done
                rows, ids, size, rank, merged, at = rows[stay], ids[stay], size[stay], rank[stay], merged[stay], at[stay]
                if not len(rows):
                    return
                top = int(size.max())  # columns that no row needs any more
                ids, rank, merged = ids[:, :top], rank[:, :top], merged[:, :top]
                line = np.arange(len(rows))
            ids[line, at] = merged[line, at]
            # close the gap: what stands right of the merged pair moves one place left
            w = ids.shape[1]
            if w > 1:
                right = np.arange(w - 1)[None, :] > at[:, None]
                for m, end in ((ids, 0), (rank, NONE), (merged, 0)):
                    np.copyto(m[:, :-1], m[:, 1:].copy(), where=right)
                    m[:, -1] = end
            size -= 1
            for col in (at, at - 1):
                ok = (col >= 0) & (col + 1 < size)
                rank[line[~ok & (col >= 0)], col[~ok & (col >= 0)]] = NONE
                r, c = line[ok], col[ok]
                rank[r, c], merged[r, c] = self._table.find(ids[r, c], ids[r, c + 1])

    def _ranked(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, w = ids.shape
        rank, merged = np.full((n, w), NONE, np.int32), np.zeros((n, w), np.int32)
        if w > 1:
            r, m = self._table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel())
            rank[:, :-1], merged[:, :-1] = r.reshape(n, w - 1), m.reshape(n, w - 1)
            rank[np.arange(w)[None, :] >= size[:, None] - 1] = NONE
        return rank, merged

    def _learn(self, parts: list[str], heads: list[str]) -> None:
        """Fill the tables of parts (after a space) and of text beginnings. The parts are
        split as one text, as each begins a match with the space before it."""
        for k in range(0, len(parts), STEP):
            some = parts[k:k + STEP]
            found = self._find(" " + " ".join(some))
            end = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            last = np.searchsorted(end, np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1))
            self._part.keep(some, self._joined(found, last + 1))
        if heads:
            found = [self._find(p) for p in heads]
            self._head.keep(heads, self._joined([m for ms in found for m in ms], np.cumsum([len(ms) for ms in found])))

    def _joined(self, matches: list[str], stop: np.ndarray) -> list[bytes]:
        """The ids of consecutive matches, those of each result up to its place in ``stop``."""
        ids = self._ids(matches)
        end = np.cumsum([0, *map(len, ids)])[stop].tolist()
        whole = b"".join(ids)
        return [whole[a:b] for a, b in zip([0, *end], end)]

    def _ids(self, matches: list[str]) -> list[bytes]:
        """The ids of each match, which is remembered."""
        held = self._match
        new = [m for m in set(matches) if m not in held]
        if new:
            raw = [w.encode("utf-8", "replace") for w in new]
            ids = [None if r is None else r.to_bytes(4, "little") for r in map(self._ranks.get, raw)]
            rest = [i for i, x in enumerate(ids) if x is None]
            for i, x in zip(rest, self.merge_bytes([raw[i] for i in rest])):
                ids[i] = x
            held.keep(new, ids)
        return list(map(held.__getitem__, matches))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [cut(t) for t in texts]
        parts = set()
        for s in split:
            parts.update(s[1:])
        self._learn([p for p in parts if p not in self._part], [p for p in {s[0] for s in split} if p not in self._head])
        get = self._part.__getitem__
        out = [self._head[s[0]] + b"".join(map(get, s[1:])) for s in split]
        for held in (self._match, self._part, self._head):
            held.end()
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _coder(path: str) -> ByteBpe:
    import public_tokenizers

    return ByteBpe(read_ranks(path), public_tokenizers.PATTERN)


def encode_documents(docs: DataFrame, rank_file: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit), ids_sha256 and
    decoded_sha256 of every row of ``docs`` (doc_id, text); ``with_ids=False`` leaves the ids
    out. ``rank_file`` is a public rank file on every executor. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        coder = _coder(rank_file or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
        for batch in batches:
            for first, texts in blocks(batch):
                ids = coder.encode(texts)
                cols = {"doc_id": sub_rows(batch, "doc_id", first, len(texts)),
                        "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                        "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        "decoded_sha256": pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids])}
                if with_ids:
                    cols["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(released(run), schema)
