"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained by follow-the-regularised-leader with elastic-net penalties, then
temperature calibration.

Features are hashed character 1- to 3-grams of the whole lower-cased text (digits and white
space folded). A feature's value is its share of the text's n-grams times its inverse
document frequency, so a logit is a mean over the text and long texts need no vector: the
score of a text is one gather over a (features x languages) table. Document frequencies
cover every training document; each task counts its own and the sums are shuffled by
feature. The classifier is fitted on a bounded sample (``sample_docs`` labelled documents,
spread evenly over the languages, chosen by a hash) in one task, four fifths for the
weights, one fifth for the temperature.

Edge cases: a null text or one without a letter is ``und`` with score 1; an empty table
gives no rows; with one learned language every lettered text is that language; without any
learned language every text is ``und``; ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import blocks, crc_mod, fresh, released, store, sub_rows, text_key

#: Hashed features; also the bound of what reaches the driver, times the languages.
BITS = 16
ORDERS = 3
_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
#: A feature's mean value is about 1/BITS-th of a text; this brings logits to a usual scale.
SCALE = np.float32(4.0)
#: Numbers that a task gathers at a time.
GATHERED = 1 << 22


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by three blanks, so that no n-gram reaches the
    next text; starts and lengths (with one of the blanks)."""
    low = [t.lower() for t in texts]
    code = np.frombuffer("".join([t + "   " for t in low]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    size = np.fromiter(map(len, low), np.int64, len(low))
    code[(code >= 9) & (code <= 13)] = 32
    code[(code >= 48) & (code <= 57)] = 48
    start = np.cumsum(size + 3) - (size + 3)
    return code, start, size + 1


def grams(code: np.ndarray) -> list[np.ndarray]:
    """For each order, the hashed feature of the n-gram that begins at each place."""
    out, h = [], np.zeros(len(code), np.uint32)
    for n in range(ORDERS):
        moved = code if n == 0 else np.concatenate([code[n:], np.full(min(n, len(code)), 32, np.uint32)])
        h = (h ^ moved) * _MUL[n]
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x27D4EB2F) >> np.uint32(32 - BITS)).astype(np.uint16))
    return out


def _vectors(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct features and their shares, text by text."""
    code, start, size = folded(texts)
    all_grams = grams(code)
    for s, n in zip(start, size):
        f, c = np.unique(np.concatenate([g[s:s + n] for g in all_grams]), return_counts=True)
        yield f, (c / n).astype(np.float32)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents of each feature over all of ``docs`` (text), and in the last place all
    documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for _, texts in blocks(batch):
                code, start, size = folded(texts)
                all_grams = grams(code)
                n += len(texts)
                for s, m in zip(start.tolist(), size.tolist()):
                    has = np.zeros(1 << BITS, bool)
                    for g in all_grams:
                        has[g[s:s + m]] = True
                    df += has
        f = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[f, 1 << BITS]), pa.array(np.r_[df[f], n])], names=["feature", "docs"])

    rows = docs.select("text").mapInArrow(count, "feature long, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).toPandas()
    out = np.zeros((1 << BITS) + 1, np.int64)
    out[rows["feature"].to_numpy()] = rows["docs"].to_numpy()
    return out


class Ftrl:
    """Multinomial logistic regression by per-coordinate follow-the-regularised-leader."""

    def __init__(self, classes: int, alpha: float = 0.6, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(((1 << BITS) + 1, classes))  # the last row is the bias
        self.n = np.zeros_like(self.z)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        at, value = np.r_[at, 1 << BITS], np.r_[value, 1.0]
        w = self.weights(at)
        p = softmax(value @ w)
        p[label] -= 1.0
        g = value[:, None] * p[None, :]
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm. One
    more row counts as wrong, so a sample without errors doesn't make every score 1."""
    if not len(labels):
        return 1.0
    slip = 1 / (len(labels) + 1)

    def loss(t: float) -> float:
        p = np.log(np.maximum(softmax(logits / np.exp(t)), 1e-12))
        return -((1 - slip) * p[np.arange(len(labels)), labels] + slip * p.mean(1)).mean()

    lo, hi, g = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


class Model:
    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, t: float):
        self.languages, self.table, self.bias, self.t = languages, table, bias, t

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.ones(len(texts))
        code, start, size = folded(texts)
        logits = np.zeros((len(texts), len(self.languages)))
        end, step = start + size, max(1 << 10, GATHERED // max(1, len(self.languages)))
        for g in grams(code):
            for lo in range(0, len(code), step):
                # sums over each text's own places; the other blanks after a text belong to none
                a, b = np.searchsorted(end, lo, "right"), np.searchsorted(start, lo + step)
                if a < b:
                    edges = np.stack([np.maximum(start[a:b] - lo, 0), np.minimum(end[a:b] - lo, step)], 1).ravel()
                    rows = np.concatenate([self.table[g[lo:lo + step]], np.zeros((1, len(self.languages)), np.float32)])
                    logits[a:b] += np.add.reduceat(rows, edges, axis=0, dtype=np.float64)[::2]
        p = softmax((logits / size[:, None] + self.bias) / self.t)
        best = p.argmax(1)
        lettered = [has_letter(t) for t in texts]
        return ([self.languages[b] if ok else "und" for b, ok in zip(best, lettered)],
                np.where(lettered, p[np.arange(len(texts)), best], 1.0))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(docs: DataFrame, sample_docs: int = 4000, epochs: int = 4) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) with a language.

    ``sample_docs`` bounds the labelled documents the weights and the temperature are fitted
    on, shared evenly by the languages; document frequencies cover all rows."""
    docs = docs.where("lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros(0), 1.0)
    df = document_frequencies(docs)
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)
    share = -(-sample_docs // len(languages))
    draw = F.pmod(F.xxhash64("doc_id", text_key(), F.lit(17)), F.lit(1 << 20))
    of_lang = F.coalesce(*[F.when(F.col("lang") == l, F.lit(int(min(1.0, share / sizes[l]) * (1 << 20)))) for l in languages])
    sample = docs.where(draw < of_lang)
    index = {l: i for i, l in enumerate(languages)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch):
                labels = sub_rows(batch, "lang", first, len(texts)).to_pylist()
                vs = list(_vectors(texts))
                yield pa.RecordBatch.from_arrays(
                    [sub_rows(batch, "draw", first, len(texts)), pa.array([index[x] for x in labels], pa.int32()),
                     pa.array([f.astype("<u2").tobytes() for f, _ in vs], pa.binary()), pa.array([v.tobytes() for _, v in vs], pa.binary())],
                    names=["draw", "label", "features", "shares"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(d, y, np.frombuffer(f, "<u2").astype(np.int64), np.frombuffer(v, np.float32))
                for b in batches for d, y, f, v in zip(*(c.to_pylist() for c in b.columns))]
        rows = [(y, f, SCALE * v * idf[f]) for _, y, f, v in sorted(rows, key=lambda r: (r[0], r[1], r[2].tobytes()))]
        held = rows[::5] if len(rows) >= 10 else rows
        learn = [r for i, r in enumerate(rows) if i % 5 or len(rows) < 10]
        model, order = Ftrl(len(languages)), np.random.default_rng(0)
        for _ in range(epochs):
            for i in order.permutation(len(learn)):
                y, f, v = learn[i]
                model.learn(f, v, y)
        w = model.weights(slice(None))
        logits = np.array([np.r_[v, 1.0] @ w[np.r_[f, 1 << BITS]] for _, f, v in held]).reshape(len(held), -1)
        t = temperature(logits, np.array([y for y, _, _ in held], int))
        table = (w[:-1] * idf[:, None] * SCALE).astype("<f4")
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([w[-1].astype("<f8").tobytes()], pa.binary()),
                                          pa.array([t])], names=["weights", "bias", "temperature"])

    fitted = store(
        store(sample.withColumn("draw", draw).mapInArrow(vectors, "draw long, label int, features binary, shares binary"), "language-sample")
        .repartition(1).mapInArrow(fit, "weights binary, bias binary, temperature double"), "language-model").first()
    table = np.frombuffer(bytes(fitted["weights"]), "<f4").reshape(1 << BITS, len(languages))
    return Model(languages, table, np.frombuffer(bytes(fitted["bias"]), "<f8"), fitted["temperature"])


def predict(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of every row, with lang_pred and score. Only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^16 x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch, text):
                names, score = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, len(texts)) for c in batch.columns[:len(columns)]), pa.array(names, pa.string()), pa.array(score)],
                    names=[*columns, "lang_pred", "score"])

    text = fresh(docs, "text_read")
    kinds = dict(docs.dtypes)
    return docs.select(*columns, F.col("text").alias(text)).mapInArrow(
        released(run), ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", lang_pred string, score double")


def identify(docs: DataFrame, sample_docs: int = 4000) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang); the
    rows whose crc32(doc_id) mod 3 is 1 are held out of all learning."""
    flagged = docs.select("doc_id", "text", "lang", (crc_mod("doc_id", 3) == 1).alias("held_out"))
    return predict(flagged, train(flagged.where("not held_out"), sample_docs), ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, min_score: float = 0.5, sample_docs: int = 4000) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and likelier than not. Where no
    language could be learned, the rows with a letter stay. All columns stay as they are."""
    model = train(docs, sample_docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def known(text: pa.Array) -> pa.Array:
        out = []
        for _, texts in blocks(pa.RecordBatch.from_arrays([text], names=["text"])):
            if shared.value.languages:
                names, score = shared.value.predict(texts)
                out += [n != "und" and bool(s >= min_score) for n, s in zip(names, score, strict=True)]
            else:
                out += map(has_letter, texts)
        pa.default_memory_pool().release_unused()
        return pa.array(out, pa.bool_())

    return docs.where(known("text"))
