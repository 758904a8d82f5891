"""Language identification: held-out accuracy, calibration, edge cases."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs, edge_rows, held_out, rows_of  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tickweave.llm import language_id, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op1_language_id(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    assert all(r["held_out"] == held_out(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 for r in got)
    test = [r for r in got if r["held_out"] and truth[r["doc_id"]][0]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in test]) > 0.97


def test_prediction_looks_at_the_text_alone(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(df, 200)
    plain = rows_of(language_id.predict(df, model, ["doc_id"]), "doc_id", "lang_pred", "score")
    blind = df.select("doc_id", "text", F.lit("x").alias("lang"), F.lit("y").alias("source"))
    assert rows_of(language_id.predict(blind, model, ["doc_id"]), "doc_id", "lang_pred", "score") == plain


def test_edges(spark):
    rows = edge_rows()
    df = docs(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") > 2, "bb"))
    got = language_id.identify(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] in (1, 2, 3, 15):
            assert r["lang_pred"] == "und"
        else:
            assert r["lang_pred"] in ("aa", "bb")
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns and not {1, 2, 3, 15} & {r["doc_id"] for r in kept.collect()}
    assert {r["lang_pred"] for r in language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(df.where("false")).count() == 0


def test_frequencies_and_scores_are_the_plain_sums(spark):
    df = docs(spark, {1: "Ab  c", 2: "abc", 3: None, 4: "zz top " * 400})
    got = language_id.document_frequencies(df)
    texts = ["Ab  c", "abc", "", "zz top " * 400]
    want = np.zeros(len(got), int)
    for t in texts:
        for f, _ in language_id._vectors([t]):
            want[f] += 1
    want[-1] = 4
    assert (got == want).all()
    rng = np.random.default_rng(0)
    model = language_id.Model(["a", "b"], rng.normal(size=(1 << language_id.BITS, 2)).astype(np.float32), np.array([0.1, -0.1]), 0.7)
    for t in texts:
        (f, v), = language_id._vectors([t])
        p = language_id.softmax((v @ model.table[f].astype(float) + model.bias) / 0.7)
        if t:
            assert np.isclose(model.predict(texts)[1][texts.index(t)], p.max(), atol=1e-5)
