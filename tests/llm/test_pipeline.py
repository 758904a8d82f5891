"""The corpus pipeline, stage by stage, against plain rules."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline  # noqa: E402
import public_tokenizers as P  # noqa: E402
from helpers import docs, drop_lines, edge_rows, rows_of  # noqa: E402
from test_ngram_join import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def held_to_rules(spark, df):
    """Each stage over what its predecessor kept; the packed rows of the last."""
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        if name == "language_id":
            lettered = {i for i, t in rows if any(map(str.isalpha, t or ""))}
            assert set(got) <= set(rows) and len({i for i, _ in got}) >= 0.95 * len(lettered)
        elif name == "line_dedup":
            import hashlib

            want = [(i, sha) for i, _, _, sha in drop_lines(rows)]
            assert sorted(((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in got), key=str) == sorted(want, key=str)
        else:
            first = {i for i, _, c in brute(rows, 5, 80) if i == c}
            assert sorted(got, key=str) == sorted(((i, t) for i, t in rows if i in first), key=str)
        rows, df = got, spark.createDataFrame(out.collect(), out.schema)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    packed = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    whole = {}
    for r in sorted(packed, key=lambda r: r["start"]):
        whole.setdefault(r["doc_id"], []).append(bytes(r["ids"]))
    want = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u2").tobytes() for i, x in rows}
    assert {i: b"".join(b) for i, b in whole.items()} == want
    return packed


def test_stages(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    packed = held_to_rules(spark, df)
    ran = corpus_pipeline.run(spark, SF)
    key = ("doc_id", "start", "length", "doc_tokens")
    assert rows_of(ran, *key) == sorted((tuple(r[c] for c in key) for r in packed), key=str)


def test_stages_on_edge_cases(spark):
    rows = [(i, t) for i, t in edge_rows() if i is not None and i != 5] + [(30, "some words of a line that is alone here")]
    held_to_rules(spark, docs(spark, rows))
    df = docs(spark, []).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, SF).count() == 0
