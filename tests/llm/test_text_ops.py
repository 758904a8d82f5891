"""Token counts, byte-level BPE, line deduplication and packing against plain rules."""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import public_tokenizers as P  # noqa: E402
from helpers import docs, drop_lines, edge_rows, rows_of  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from tickweave.llm import byte_bpe, line_dedup, packing, queries, token_counts  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_token_counts_are_the_library_s(spark, table):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for rows, df in ((table, queries.op4_token_counts(spark, SF)), (edge_rows(), token_counts.count_tokens(docs(spark, edge_rows())))):
        want = [(i, len((t or "").encode()), n, n > 4096) for i, t in rows for n in [len(sp.encode(t or ""))]]
        assert rows_of(df, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=str)


def test_byte_bpe_ids_are_the_library_s(spark, table):
    import tiktoken

    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for rows, df in ((table, queries.op8_byte_bpe(spark, SF)), (edge_rows(), byte_bpe.encode_documents(docs(spark, edge_rows())))):
        want = [(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                for i, t in rows for ids in [e.encode_ordinary(t or "")]]
        assert rows_of(df, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tab'sé▁<>|0中"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_both_encoders_on_any_text(text):
    import sentencepiece
    import tiktoken

    sp = test_both_encoders_on_any_text.__dict__.setdefault("sp", None) or sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    test_both_encoders_on_any_text.sp = sp
    assert token_counts._counter(P.path("piece_bpe_32k.model")).count_texts([text]) == [len(sp.encode(text))]
    coder = byte_bpe._coder(P.path("byte_bpe_multi_50k.tiktoken"))
    e = test_both_encoders_on_any_text.__dict__.get("e") or tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder._ranks, special_tokens={})
    test_both_encoders_on_any_text.e = e
    ids = coder.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == e.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_long_matches_merge_by_the_same_rule():
    coder = byte_bpe._coder(P.path("byte_bpe_multi_50k.tiktoken"))
    raw = [(b"thequickbrown" * 60)[:n] for n in (513, 700)]
    both = coder.merge_rows(raw)
    for ids, b in zip(both, raw):
        out = coder._byte[np.frombuffer(b, np.uint8)].tolist()
        while True:
            pairs = [(coder._ranks.get(coder.vocabulary[x] + coder.vocabulary[y], 1 << 40), i) for i, (x, y) in enumerate(zip(out, out[1:]))]
            if not pairs or min(pairs)[0] == 1 << 40:
                break
            r, i = min(pairs)
            out[i:i + 2] = [r]
        assert ids.tolist() == out


def test_line_dedup(spark, table):
    assert rows_of(queries.op5_line_dedup(spark, SF), "doc_id", "n_lines", "n_dropped", "kept_sha256") == drop_lines(table)
    rows = edge_rows()
    for parts in (1, 5):
        assert rows_of(line_dedup.line_digests(docs(spark, rows, parts)), "doc_id", "n_lines", "n_dropped", "kept_sha256") == drop_lines(rows)
    cut = line_dedup.dedup_lines(docs(spark, rows))
    assert cut.columns == docs(spark, rows).columns
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in cut.collect()) and cut.count() == len(rows)


def test_line_runs_that_cross_partitions(spark):
    """One line in nearly every document, over many range partitions."""
    rows = [(i, f"own line number {i} of this text\n" + ("a very common line of text" if i % 7 else "seldom")) for i in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(line_dedup.line_digests(docs(spark, rows)), "doc_id", "n_lines", "n_dropped", "kept_sha256") == drop_lines(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def held_to_contract(rows, packed, window=2048):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter((i, np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, x in rows)
    total = {i: len(b) // 4 for i, b in want}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in packed:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
        assert 0 < r["length"] and r["doc_tokens"] == total[r["doc_id"]]
    ids = {i: np.frombuffer(b, "<u4") for i, b in want}
    copies = Counter(i for i, b in want.elements())
    for i, ps in by_doc.items():
        seen = np.zeros(total[i], int)
        for p in ps:
            piece = ids[i][p["start"]:p["start"] + p["length"]]
            seen[p["start"]:p["start"] + p["length"]] += 1
            assert p["ids_crc32"] == zlib.crc32(piece.tobytes())
        assert (seen == copies[i]).all()
    assert set(by_doc) == set(ids)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return by_seq


def test_packing(spark, table):
    for rows, df in ((table, queries.op3_packing(spark, SF)), (edge_rows(), packing.with_crc32(packing.pack(docs(spark, edge_rows()))))):
        by_seq = held_to_contract(rows, df.collect())
        assert sum(sum(p["length"] for p in ps) < 2048 for ps in by_seq.values()) <= 1
    same = [(i, "one and the same text of a few words") for i in range(300)]
    assert len(held_to_contract(same, packing.with_crc32(packing.pack(docs(spark, same))).collect())) <= 3


def test_plan_uses_combinations():
    rng = np.random.default_rng(3)
    h = np.bincount(rng.integers(1, 256, 40_000), minlength=257)
    plan = packing.Plan(h, 256)
    assert plan.left.sum() < 0.25 * h.sum()  # most tails are placed whole by the solved counts
    assert plan.sequences == -(-int((h * np.arange(257)).sum()) // 256) or plan.sequences - (h * np.arange(257)).sum() / 256 < 1


def test_empty_tables(spark):
    none = docs(spark, []).where("false")
    assert token_counts.count_tokens(none).count() == 0
    assert byte_bpe.encode_documents(none).count() == 0
    assert line_dedup.line_digests(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert packing.pack(none).count() == 0
