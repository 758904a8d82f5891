"""Texts without blanks: matches of any length, and what a worker keeps of them."""

import random

import numpy as np
import public_tokenizers
import pytest

from tickweave.llm import byte_bpe, packing, token_counts
from tickweave.llm.common import Remembered


@pytest.fixture(scope="module")
def coder():
    return byte_bpe._coder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def texts(n, size, seed=1):
    r = random.Random(seed)
    return ["".join(chr(r.choice([0x4E00, 0x5000, 0x6000]) + int(abs(r.gauss(0, 300)))) for _ in range(size)) for _ in range(n)]


def long_ones():
    r = random.Random(2)
    return [texts(1, 30_000)[0], "".join(r.choice("abcde") for _ in range(200_000)), "a" * 100_000, "ab" * 700, "日" * 5000]


def test_byte_bpe_as_the_library(coder):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder._ranks, special_tokens={})
    for t in [*long_ones(), *texts(20, 700)]:
        assert np.frombuffer(coder.encode([t])[0], "<u4").tolist() == library.encode_ordinary(t)


def test_piece_counts_as_the_library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for t in [*long_ones(), *texts(20, 700)]:
        assert token_counts._counter(path).count_texts([t]) == [len(library.encode(t))]


def test_workers_forget_long_texts(coder):
    counter = token_counts._counter(public_tokenizers.path("piece_bpe_32k.model"))
    ids = packing._ids(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for k in range(3):
        block = texts(50, 2000, seed=k)
        coder.encode(block), counter.count_texts(block), ids(block)
    for held in (coder._match, coder._part, coder._head, counter._seen, ids._part, ids._head):
        assert not held._long and all(len(x) <= Remembered.LONGEST for x in held)


def test_remembered_stays_within_its_bytes():
    held = Remembered(10_000)
    for k in range(1000):
        held[f"word{k}"] = b"1234"
        held["x" * 100 + str(k)] = b"long"
        if k % 10 == 9:
            held.end()
            assert held.held <= 10_000 and len(held) <= 70


def test_new_parts_are_split_together(coder, monkeypatch):
    """One call of the pattern for a block's new parts and one for each beginning, not one for
    each part; with the library's ids where parts end in blanks, signs and other scripts."""
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder._ranks, special_tokens={})
    r = random.Random(7)
    ends = ["", ",", ".\n", ".\n\n", "'s", " \n ", "  ", " 中", " ", "\t", "9!"]
    block = ["".join(f"qz{r.randrange(10**6)}{r.choice(['é', 'x', ''])}{r.choice(ends)} " for _ in range(300)) for _ in range(4)] + ["", " ", " a"]
    calls, find = [], coder._find
    monkeypatch.setattr(coder, "_find", lambda text: calls.append(text) or find(text))
    got = coder.encode(block)
    assert len(calls) <= len(block) + 1
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode_ordinary(t) for t in block]


def test_keep_counts_like_single_entries():
    one, many = Remembered(10_000), Remembered(10_000)
    texts = ["a", "bcd", "x" * 100, "é" * 64]
    for t in texts:
        one[t] = t.encode()
    many.keep(texts, [t.encode() for t in texts])
    assert one == many and one.held == many.held and one._long == many._long


@pytest.mark.parametrize("step", [1 << 16, 7])
def test_packing_tokenises_a_blocks_parts_together(monkeypatch, step):
    """One call of the library for a block's new plain parts and one for each beginning, not one
    for each part; with the tokenizers file's ids where parts end in blanks, signs, other
    scripts and special strings."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, library = packing.Ids(path, public_tokenizers.path("byte_bpe_50k.tiktoken")), Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "STEP", step)
    r = random.Random(3)
    ends = ["", ",", ".\n", ".\n\n", "'s", " \n ", "  ", " 中", " ", "\t", "9!", "é", "\x00", *ids._special]
    block = ["".join(f"qz{r.randrange(10**6)}{r.choice(['é', 'x', ''])}{r.choice(ends)} " for _ in range(200)) for _ in range(4)]
    block += ["", " ", " a", "b", "  c  d", "the cat", "the cat sat ÿ", "中 文 字", block[0]]
    calls, fast = [], ids._fast
    monkeypatch.setattr(ids, "_fast", lambda text: calls.append(text) or fast(text))
    got = ids(block)
    assert step == 7 or len(calls) <= len(block) + 1
    want = [library.encode(t, add_special_tokens=False).ids for t in block]
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == want
    assert [np.frombuffer(x, "<u2").tolist() for x in packing.Ids(path, None)(block)] == want
    assert ids([""]) == [b""]
