"""Approximate nearest neighbours by cosine: inverted lists scanned by adaptive dimension
sampling.

Vectors are put to unit length and rotated by a fixed random orthogonal matrix, so any block
of columns is a random sample of directions. k-means on a bounded sample gives the lists; all
rows are dealt to them, and a query visits its nearest lists. In a list the columns are read
block by block: after d of D columns a candidate is abandoned if its partial distance fails
the test ``partial <= bound * (1 + eps / sqrt(d))^2 * d / D`` against the query's current
(k+1)-th distance. Survivors of all blocks get their exact cosine on the original vectors.

Rows of one and the same vector beyond the k + 1 smallest ids can be in no answer, so they
are left out of the lists (a partial limit before the shuffle, whatever the group's size);
equal query vectors are searched once. Lists are cut into chunks of bounded size.

Up to 2000 rows make one list, which is scanned whole; beyond, there are the square root of
the rows, bounded by ``max_lists`` and by a sixteenth of the sample, lists. How many of them a
query visits is measured: the least that gives ``recall`` for sample
queries over the sample, and never fewer than hold k + 1 rows.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part,
neither do those of another length than most; of usable rows that share a ``vec_id`` the
smallest vector (component by component) counts, as candidate and as query; a query with fewer candidates gets all of
them; equal scores go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import store

#: Rows of a list that one task group holds at most, about.
CHUNK = 4096
BLOCK = 16
EPS = 2.1


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, as (vec_id, embedding array<double>), one a ``vec_id``."""
    ok = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0))
    top = ok.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return ok.where(F.size("embedding") == (top["d"] if top else 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / big  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision on the vectors as they are."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        c = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
    odd = ~np.isfinite(c) | (c == 0)
    if odd.any():  # squares left the range of doubles
        c[odd] = (unit(a[odd]) * unit(b[odd])).sum(1)
    return c


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def k_means(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(11)
    c = x[rng.choice(len(x), n, replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.sqrt((total * total).sum(1))
        c = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], c)
    return c


def probes_for(x: np.ndarray, c: np.ndarray, k: int, recall: float) -> int:
    """Lists to visit so that sample queries find ``recall`` of their k nearest in the sample."""
    ask = x[:: max(1, len(x) // 256)][:256]
    near = np.argsort(-(ask @ x.T), axis=1)[:, 1:k + 1]
    own = (x @ c.T).argmax(1)
    place = np.argsort(np.argsort(-(ask @ c.T), axis=1), axis=1)
    need = np.sort(np.take_along_axis(place, own[near], 1).ravel()) + 1
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)]) if len(need) else 1


class Scan:
    """Adaptive scan of one chunk for many queries."""

    def __init__(self, k: int):
        self.k = k

    def __call__(self, ids: np.ndarray, raw: np.ndarray, rotated: np.ndarray, asked: np.ndarray, asked_rotated: np.ndarray):
        """(query row, candidate row, cosine) of the k best of each query."""
        dim, k = rotated.shape[1], self.k
        nq = len(asked_rotated)
        best = np.full((nq, k), np.inf)  # squared distances, the largest last
        kept: list[tuple] = []
        for lo in range(0, len(ids), 512):
            part = rotated[lo:lo + 512]
            first = min(BLOCK, dim)
            d = ((asked_rotated[:, None, :first] - part[None, :, :first]) ** 2).sum(2) if nq * len(part) < 4096 else \
                (asked_rotated[:, :first] ** 2).sum(1)[:, None] + (part[:, :first] ** 2).sum(1)[None] - 2 * asked_rotated[:, :first] @ part[:, :first].T
            q, v = np.nonzero(d <= self._bound(best[:, -1], first, dim)[:, None])
            d = d[q, v]
            for a in range(first, dim, BLOCK):
                b = min(dim, a + BLOCK)
                d = d + ((asked_rotated[q, a:b] - part[v, a:b]) ** 2).sum(1)
                ok = d <= self._bound(best[q, -1], b, dim)
                q, v, d = q[ok], v[ok], d[ok]
            if not len(q):
                continue
            kept.append((q, v + lo, d))
            # the k least distances of each query so far
            order = np.lexsort((d, q))
            qs, ds = q[order], d[order]
            start = np.r_[True, qs[1:] != qs[:-1]]
            nth = np.arange(len(qs)) - np.maximum.accumulate(np.where(start, np.arange(len(qs)), 0))
            top = nth < k
            more = np.full((nq, k), np.inf)
            more[qs[top], nth[top]] = ds[top]
            best = np.sort(np.concatenate([best, more], 1), 1)[:, :k]
        if not kept:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        q, v, d = (np.concatenate(x) for x in zip(*kept))
        ok = d <= best[q, -1] + 1e-9
        q, v = q[ok], v[ok]
        score = cosine(asked[q], raw[v])
        order = np.lexsort((ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        start = np.r_[True, q[1:] != q[:-1]]
        nth = np.arange(len(q)) - np.maximum.accumulate(np.where(start, np.arange(len(q)), 0))
        return q[nth < k], v[nth < k], score[nth < k]

    @staticmethod
    def _bound(worst: np.ndarray, d: int, dim: int) -> np.ndarray:
        return worst + 1e-9 if d == dim else worst * (1 + EPS / np.sqrt(d)) ** 2 * d / dim + 1e-9


def search(vectors: DataFrame, is_query: F.Column, k: int = 5, recall: float = 0.98, sample_rows: int = 20_000,
           max_lists: int = 16_384, probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of ``vectors`` (vec_id, embedding)
    nearest to each row for which ``is_query`` holds, itself left out.

    ``sample_rows`` bounds the rows that centroids and ``probes`` are fitted on, ``max_lists``
    the centroids; every row is indexed."""
    spark = vectors.sparkSession
    rows = store(usable(vectors), "vectors")
    n = rows.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], empty)
    share = min(1.0, sample_rows / n)
    drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(F.xxhash64("vec_id", F.lit(1))).limit(sample_rows)
    sample = unit(np.array(drawn.select("embedding").toPandas()["embedding"].tolist()))
    turn = rotation(sample.shape[1])
    _, once = np.unique(sample, axis=0, return_index=True)
    sample = sample[np.sort(once)] @ turn
    lists = int(max(1, min(max_lists, len(sample) // 16, n ** 0.5))) if n > 2000 else 1
    centroids = k_means(sample, lists)
    visit = probes or (probes_for(sample, centroids, k, recall) if lists > 1 else 1)
    shared = spark.sparkContext.broadcast((turn, centroids))  # max_lists x dimensions numbers at most

    @F.pandas_udf("int")
    def own_list(e: pd.Series) -> pd.Series:
        turn, c = shared.value
        return pd.Series((unit(np.array(e.tolist())) @ turn @ c.T).argmax(1).astype(np.int32)) if len(e) else pd.Series([], dtype="int32")

    copies = Window.partitionBy("embedding").orderBy("vec_id")
    listed = store(rows.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1)
                   .select("vec_id", "embedding", own_list("embedding").alias("list")), "lists")
    sizes = np.zeros(lists, np.int64)
    for r in listed.groupBy("list").count().collect():  # a row a list
        sizes[r["list"]] = r["count"]
    chunks = np.maximum(1, -(-sizes // CHUNK))
    plan = spark.sparkContext.broadcast((sizes, chunks))

    @F.pandas_udf("array<struct<list: int, chunk: int>>")
    def visits(e: pd.Series) -> pd.Series:
        turn, c = shared.value
        sizes, chunks = plan.value
        order = np.argsort(-(unit(np.array(e.tolist())) @ turn @ c.T), axis=1, kind="stable")
        out = []
        for o in order:
            enough = int(np.searchsorted(np.cumsum(sizes[o]), k + 1)) + 1
            out.append([{"list": int(x), "chunk": j} for x in o[:max(visit, enough)] if sizes[x] for j in range(int(chunks[x]))])
        return pd.Series(out)

    asked = rows.where(is_query)
    groups = asked.groupBy("embedding").agg(F.min("vec_id").alias("group_id"))
    asking = groups.select("group_id", "embedding", F.explode(visits("embedding")).alias("to")).select("group_id", "embedding", "to.list", "to.chunk")
    per_list = spark.createDataFrame([(i, int(x)) for i, x in enumerate(chunks)], "list int, n_chunks int")  # max_lists rows at most
    dealt = listed.join(F.broadcast(per_list), "list")
    dealt = dealt.select("list", F.pmod(F.xxhash64("vec_id"), F.col("n_chunks")).cast("int").alias("chunk"), "vec_id", "embedding")

    def scan(key: tuple, asks: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(own):
            return pd.DataFrame({"group_id": [], "vec_id": [], "score": []})
        turn, _ = shared.value
        raw, ids = np.array(own["embedding"].tolist()), own["vec_id"].to_numpy()
        rotated, out = unit(raw) @ turn, []
        for lo in range(0, len(asks), 512):
            part = asks.iloc[lo:lo + 512]
            q_raw = np.array(part["embedding"].tolist())
            q, v, score = Scan(k + 1)(ids, raw, rotated, q_raw, unit(q_raw) @ turn)
            out.append(pd.DataFrame({"group_id": part["group_id"].to_numpy()[q], "vec_id": ids[v], "score": score}))
        return pd.concat(out)

    found = asking.groupBy("list", "chunk").cogroup(dealt.groupBy("list", "chunk")).applyInPandas(scan, "group_id long, vec_id long, score double")
    best = Window.partitionBy("group_id").orderBy(F.desc("score"), "vec_id")
    near = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    members = asked.join(groups, "embedding").select(F.col("vec_id").alias("query_id"), "group_id")
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return members.join(near, "group_id").where("query_id != vec_id").withColumn("rank", F.row_number().over(of_query).cast("int")) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
