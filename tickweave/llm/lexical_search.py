"""Ranked lexical search of many items at once over whole texts.

Items share terms, and sets of terms, so their scores are evaluated together. Per block of
items (at most about ``block_entries`` distinct (item, term) entries, whatever the number of
items):

1. One task mines the shared term sets: the pair of symbols that stands in most items
   becomes a symbol of its own, until no pair stands in two items. What comes out is a DAG
   whose leaves are (term, repeats) and whose inner nodes are shared sets; an item is a sum
   of a few nodes.
2. One pass over the documents writes the postings of the block's terms and each document's
   term count; a second one, over the postings, sums document frequencies.
3. Tasks take postings in blocks of documents, fill the leaves with integer contributions,
   materialise each node's accumulators (a row of one number a document) once from its two
   parts, add an item's nodes and keep the item's best ``k`` of the task. Ranks are settled
   over salts first, then over the item.

Blocks of items are worked off one after another; only a block's terms, weights and DAG are
broadcast. The work is (documents x blocks of items), as a stated query set takes.

Edge cases: null or empty texts have no terms and don't count; a term of any length is a
term; rows repeated whole are one item, and rows of one item_id with different texts are
items of their own; repeated documents are ranked each; a null doc_id stands after all
others of its score; items without terms, or whose terms no document holds, give no rows;
empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import fresh, store, words_of

#: (item, term) entries of one block of items: bounds the broadcast terms, weights and DAG.
BLOCK_ENTRIES = 1 << 16
#: Symbols of an item among which pairs are counted; longer items are mined in such pieces.
SPAN = 64
#: Numbers that a task's accumulators hold at a time.
CELLS = 1 << 22
#: Salts of the first of the two rankings.
SALTS = 64

_letters = "".join(chr(c) if chr(c).isascii() and chr(c).isalnum() else " " for c in range(128)).lower().encode()
#: Bytes of a term, A-Z lower-cased; every byte beyond ASCII belongs to a term.
TERM_BYTES = _letters + bytes(range(128, 256))


def shared_sets(rows: list[list[int]], n_symbols: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """(pairs, rows): node ``n_symbols + k`` is the sum of the two symbols of ``pairs[k]``;
    each row, given as distinct symbols, comes back as symbols and nodes with the same sum."""
    held = Counter(s for r in rows for s in r)
    pieces: list[set[int]] = []
    owner: list[int] = []
    for i, r in enumerate(rows):
        common = sorted((s for s in r if held[s] > 1), key=lambda s: (-held[s], s))
        for lo in range(0, len(common), SPAN):
            pieces.append(set(common[lo:lo + SPAN]))
            owner.append(i)
    holders: dict[int, set[int]] = {}
    count: Counter = Counter()
    for p, piece in enumerate(pieces):
        order = sorted(piece)
        for at, a in enumerate(order):
            holders.setdefault(a, set()).add(p)
            for b in order[at + 1:]:
                count[a, b] += 1
    heap = [(-n, pair) for pair, n in count.items() if n > 1]
    heapq.heapify(heap)
    made: list[tuple[int, int]] = []
    while heap:
        n, (a, b) = heapq.heappop(heap)
        now = count.get((a, b), 0)
        if now < 2:
            continue
        if now != -n:
            heapq.heappush(heap, (-now, (a, b)))
            continue
        node = n_symbols + len(made)
        made.append((a, b))
        both = holders[a] & holders[b]
        touched = Counter()
        for p in both:
            piece = pieces[p]
            piece.difference_update((a, b))
            for x in piece:
                for y in (a, b):
                    count[(x, y) if x < y else (y, x)] -= 1
                touched[x] += 1
            piece.add(node)
        holders[a] -= both
        holders[b] -= both
        holders[node] = both
        del count[a, b]
        for x, n in touched.items():
            if n > 1:
                count[x, node] = n
                heapq.heappush(heap, (-n, (x, node)))
    out = [[s for s in r if held[s] == 1] for r in rows]
    for p, i in enumerate(owner):
        out[i] += sorted(pieces[p])
    return made, out


def items_of(items: DataFrame) -> DataFrame:
    """item_id, text_key, terms, times: a row for each distinct item that has terms."""
    kind = dict(items.dtypes)["item_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(Counter(w for part in words_of(t or b"", TERM_BYTES) for w in part).items())
                     for t in batch.column(2).cast(pa.binary()).to_pylist()]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([[w for w, _ in f] for f in found], pa.list_(pa.binary())),
                 pa.array([[n for _, n in f] for f in found], pa.list_(pa.int64()))], names=["item_id", "text_key", "terms", "times"])
            yield out.filter(pa.array([bool(f) for f in found]))

    text = F.coalesce(F.col("text"), F.lit(""))
    return items.select("item_id", text.alias("text")).distinct().select("item_id", F.xxhash64("text").alias("text_key"), "text") \
        .mapInArrow(run, f"item_id {kind}, text_key long, terms array<binary>, times array<long>")


def query_plans(items: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row a block of items: its terms, its leaves (term, times), the two parts of each
    inner node, and each item's nodes (``ends`` cuts ``nodes`` into items)."""
    kind = dict(items.dtypes)["item_id"]
    found = store(items_of(items), "search-items")
    entries = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, math.ceil(entries / block_entries))
    schema = (f"item_ids array<{kind}>, text_keys array<long>, terms array<binary>, leaf_term array<int>, leaf_times array<long>, "
              "part_a array<int>, part_b array<int>, nodes array<int>, ends array<int>")

    def mine(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["item_id", "text_key"])
        terms = sorted({t for ts in rows["terms"] for t in ts})
        at = {t: i for i, t in enumerate(terms)}
        leaves: dict[tuple[int, int], int] = {}
        symbols = [[leaves.setdefault((at[t], int(c)), len(leaves)) for t, c in zip(ts, cs, strict=True)]
                   for ts, cs in zip(rows["terms"], rows["times"], strict=True)]
        parts, symbols = shared_sets(symbols, len(leaves))
        ids = rows["item_id"].astype(object).where(rows["item_id"].notna(), None)
        return pd.DataFrame({"item_ids": [list(ids)], "text_keys": [list(rows["text_key"])], "terms": [terms],
                             "leaf_term": [[t for t, _ in leaves]], "leaf_times": [[c for _, c in leaves]],
                             "part_a": [[a for a, _ in parts]], "part_b": [[b for _, b in parts]],
                             "nodes": [[s for r in symbols for s in r]], "ends": [list(np.cumsum([len(r) for r in symbols]))]})

    block = F.pmod(F.xxhash64("item_id", "text_key"), F.lit(n))
    return store(found.groupBy(block.alias("block")).applyInPandas(mine, schema), "search-plans")


def postings_of(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, n, terms, tf of every document with a term: its number of terms with repeats,
    and those of ``terms`` (by place) that it holds with their occurrences."""
    kind = dict(docs.dtypes)["doc_id"]
    places = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places.value.get
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            n, place, times, ends = np.zeros(len(texts), np.int64), [], [], [0]
            for i in range(len(texts)):
                held: Counter = Counter()
                for words in words_of(texts[i].as_py() or b"", TERM_BYTES):
                    n[i] += len(words)
                    held.update(map(at, words))
                held.pop(None, None)
                place += held.keys()
                times += held.values()
                ends.append(len(place))
            cut = pa.array(ends, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(cut, pa.array(place, pa.int32())),
                 pa.ListArray.from_arrays(cut, pa.array(times, pa.int64()))], names=["doc_id", "n", "terms", "tf"])
            yield out.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tf array<long>")


def document_frequencies(postings: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at])], names=["term", "df"])

    df = np.zeros(n_terms, np.int64)
    for r in postings.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


class Best:
    """The ``k`` best (score, doc_id) of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.held: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * n_items
        self.least = np.zeros(n_items, np.int64)

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        at = np.flatnonzero(scores >= max(1, self.least[item]))
        if len(at):
            s, i, z = (np.concatenate(x) for x in zip(self.held[item], (scores[at], ids[at], nulls[at]), strict=True))
            first = np.lexsort((i, z, -s))[:self.k]
            self.held[item] = s[first], i[first], z[first]
            if len(first) == self.k:
                self.least[item] = s[first[-1]]


def best_of_block(postings: DataFrame, plan: dict, weights: np.ndarray, n_docs: int, n_terms_all: int, k: int) -> DataFrame:
    """item, doc_id, score, salt: the best ``k`` of each item in each task."""
    shared = postings.sparkSession.sparkContext.broadcast((
        weights, *(np.array(plan[c], np.int64) for c in ("leaf_term", "leaf_times", "part_a", "part_b", "nodes", "ends"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, leaf_term, leaf_times, part_a, part_b, nodes, ends = shared.value
        leaves, kept = len(leaf_term), Best(len(ends), k)
        parts, items = list(zip(part_a.tolist(), part_b.tolist(), strict=True)), np.split(nodes, ends[:-1])
        n_rows = leaves + len(parts)
        step = max(16, CELLS // max(1, n_rows + len(w)))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                ids, n, terms, tf = batch.slice(lo, step).columns
                size = len(ids)
                held = np.diff(terms.offsets.to_numpy())
                doc, term, tf = np.repeat(np.arange(size), held), terms.flatten().to_numpy(), tf.flatten().to_numpy()
                m = 100 - 75 + (75 * n.to_numpy() * n_docs) // n_terms_all
                of_term = np.zeros((len(w), size), np.int64)
                of_term[term, doc] = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                live = np.zeros(n_rows, bool)
                live[:leaves] = np.bincount(term, minlength=len(w))[leaf_term] > 0
                sums = np.empty((n_rows, size), np.int64)
                np.multiply(of_term[leaf_term], leaf_times[:, None], out=sums[:leaves])
                for at, (a, b) in enumerate(parts, leaves):
                    if live[a] or live[b]:
                        live[at] = True
                        np.add(sums[a], sums[b], out=sums[at])
                    else:
                        sums[at] = 0
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                keys = ids.cast(pa.int64()).fill_null(0).to_numpy()
                for i, own in enumerate(items):
                    own = own[live[own]]
                    if len(own):
                        kept.add(i, sums[own].sum(axis=0) if len(own) > 1 else sums[own[0]], keys, nulls)
        for i, (s, d, z) in enumerate(kept.held):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i, np.int32)), pa.array(d, mask=z), pa.array(s)], names=["item", "doc_id", "score"])

    return postings.mapInArrow(run, "item int, doc_id long, score long").withColumn("salt", F.spark_partition_id() % SALTS)


def search(items: DataFrame, docs: DataFrame, k: int = 10, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """item_id, rank, doc_id, score (and text_key, which tells items of one id apart): the
    ``k`` highest-scoring documents of each item, ties by ascending doc_id."""
    spark = items.sparkSession
    id_kinds = dict(items.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]
    plans, n_blocks = query_plans(items, block_entries), 0
    parts = []
    plans = plans.withColumn(at := fresh(plans, "at"), F.xxhash64("text_keys", "item_ids"))
    for (block,) in plans.select(at).orderBy(at).toLocalIterator():
        plan = plans.where(F.col(at) == block).first().asDict()  # bounded by block_entries
        terms = [bytes(t) for t in plan["terms"]]
        postings = store(postings_of(docs, terms), "search-postings")
        total = postings.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            break
        n_docs, n_all = total["docs"], total["terms"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in document_frequencies(postings, len(terms)).tolist()], np.int64)
        best = best_of_block(postings, plan, weights, n_docs, n_all, k)
        order = (F.desc("score"), F.asc_nulls_last("doc_id"))
        for keys in (["item", "salt"], ["item"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, *x) for i, x in enumerate(zip(plan["item_ids"], plan["text_keys"], strict=True))], f"item int, item_id {id_kinds[0]}, text_key long")
        parts.append(store(best.join(names, "item").select("item_id", "rank", F.col("doc_id").cast(id_kinds[1]).alias("doc_id"), "score", "text_key"), f"search-{n_blocks}"))
        n_blocks += 1
    out = spark.createDataFrame([], f"item_id {id_kinds[0]}, rank int, doc_id {id_kinds[1]}, score long, text_key long")
    for p in parts:
        out = out.unionByName(p) if out is not None and p is not parts[0] else p
    return out
