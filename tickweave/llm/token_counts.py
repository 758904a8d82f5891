"""Token counts of a sentencepiece BPE model, by rank-synchronous array merging.

A text is ``▁`` + the text with spaces as ``▁``. No piece of the model has ``▁`` after
another character, so every ``▁+[^▁]*`` stretch (pre-token) merges on its own. A block's
new pre-tokens are held as ragged numpy arrays; each round every sequence applies its
leftmost lowest-rank pair, all sequences at once; finished sequences leave the arrays. A
surviving symbol that is no piece counts as its UTF-8 bytes (byte fallback).

Edge cases: null or empty text has 0 tokens; unpaired or unknown characters count by byte;
repeated rows each get a row; nothing is truncated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import Remembered, blocks, released, sub_rows
from tickweave.llm.pairs import NONE, PairTable, merge_one

_ODD = re.compile("  |^ | $|▁")
_STRETCH = re.compile("▁+[^▁]*")
#: Longer pre-tokens merge alone, by a heap; the rule is the same.
LONG = 256
#: Bytes of pre-token counts that a worker remembers, about.
REMEMBERED = 64 << 20


class PieceCounter:
    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        rows = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.vocab_size())
                if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        score = dict(rows)
        if any(re.search("[^▁]▁", p) for p in score):
            raise ValueError("the model has pieces that span a word start")
        levels = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        symbols = {p: i for i, p in enumerate(score)}
        for p in score:
            for c in p:
                symbols.setdefault(c, len(symbols))
        left, right, rank, merged = [], [], [], []
        for p, s in score.items():
            for i in range(1, len(p)):
                a, b = symbols.get(p[:i]), symbols.get(p[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(levels[s])
                    merged.append(symbols[p])
        self._table = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int32),
                                np.array(merged, np.int32))
        self._n = len(symbols)
        # by code point: its symbol; characters outside the model have one symbol that never merges
        self._char = np.full(0x110000, self._n, np.int32)
        for p, i in symbols.items():
            if len(p) == 1:
                self._char[ord(p)] = i
        self._is_piece = np.zeros(self._n + 1, bool)
        self._is_piece[: len(score)] = True
        self._seen = Remembered(REMEMBERED)

    def counts(self, pre_tokens: list[str]) -> np.ndarray:
        """Symbols left of each pre-token (given with its ▁)."""
        out = np.zeros(len(pre_tokens), np.int64)
        lens = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        for i in np.flatnonzero(lens > LONG):
            out[i] = self._surviving(*self._long(pre_tokens[i]))
        short = np.flatnonzero((lens <= LONG) & (lens > 0))
        if len(short):
            out[short] = self._ragged("".join([pre_tokens[i] for i in short]), lens[short])
        return out

    def _symbols(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Symbols, and how many tokens each stands for if it stays unmerged."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self._char[code]
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        return sym, np.where(self._is_piece[sym], 1, width)

    def _long(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        sym, weight = self._symbols(text)
        lone = sym == self._n
        rest = merge_one(sym, self._table)
        return rest, weight[lone]

    def _surviving(self, rest: np.ndarray, lone_weight: np.ndarray) -> int:
        known = rest[rest != self._n]
        # an unmerged symbol outside the vocabulary can only be a single character of it
        return int(self._is_piece[known].sum() + (~self._is_piece[known]).sum() + lone_weight.sum())

    def _ragged(self, text: str, lens: np.ndarray) -> np.ndarray:
        sym, weight = self._symbols(text)
        sym, total = sym.copy(), np.zeros(len(lens), np.int64)
        seq = np.repeat(np.arange(len(lens)), lens)
        rank, merged = self._pair(sym, seq, np.arange(len(sym)))
        while len(sym):
            start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            least = np.minimum.reduceat(rank, start)
            done = least == NONE
            size = np.diff(np.r_[start, len(sym)])
            if done.any():  # these leave; what survives is counted
                gone = np.repeat(done, size)
                np.add.at(total, seq[gone], weight[gone])
                stay = ~gone
                sym, weight, seq, rank, merged = sym[stay], weight[stay], seq[stay], rank[stay], merged[stay]
                if not len(sym):
                    break
                size, least = size[~done], least[~done]
                start = np.cumsum(size) - size
            hits = np.flatnonzero(rank == np.repeat(least, size))
            hits = hits[np.r_[True, seq[hits[1:]] != seq[hits[:-1]]]]  # the leftmost of each sequence
            sym[hits] = merged[hits]
            weight[hits] = 1
            keep = np.ones(len(sym), bool)
            keep[hits + 1] = False
            at = hits - np.arange(len(hits))  # one place is gone for each hit before
            sym, weight, seq, rank, merged = sym[keep], weight[keep], seq[keep], rank[keep], merged[keep]
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near], merged[near] = self._pair(sym, seq, near)
        return total

    def _pair(self, sym: np.ndarray, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nxt = np.minimum(at + 1, len(sym) - 1)
        rank, merged = self._table.find(sym[at], sym[nxt])
        rank[(nxt == at) | (seq[nxt] != seq[at])] = NONE
        return rank, merged

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; ``▁`` + word is looked up by word."""
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif _ODD.search(t):
                split.append([x[1:] for x in _STRETCH.findall("▁" + t.replace(" ", "▁"))])
            else:
                split.append(t.split(" "))
        new = set().union(*split) - self._seen.keys()
        if new:
            words = list(new)
            for w, n in zip(words, self.counts(["▁" + w for w in words]).tolist(), strict=True):
                self._seen[w] = n
        get = self._seen.__getitem__
        out = [sum(map(get, words)) for words in split]
        self._seen.end()
        return out


@lru_cache(maxsize=2)
def _counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def count_tokens(docs: DataFrame, model_file: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text).

    ``model_file`` names a sentencepiece BPE model on every executor; by default the public
    32k model. No shuffle; a worker holds one block of text and its pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        counter = _counter(model_file or public_tokenizers.path("piece_bpe_32k.model"))
        for batch in batches:
            for first, texts in blocks(batch):
                n = counter.count_texts(texts)
                yield pa.RecordBatch.from_arrays(
                    [sub_rows(batch, "doc_id", first, len(texts)), sub_rows(batch, "n_bytes", first, len(texts)),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")) \
        .mapInArrow(released(run), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
