"""Mixing sources to target weights, with DataFrame functions alone.

1. Targets. Sources in code-point order (null last) weigh ``weights`` in turn and share the
   size of all documents; a target stops at ``repeats`` times its source's size and the
   excess goes to the others by weight, until none is above.
2. Blocks. A source's documents stand in an order of hashes; its words, laid end to end, are
   cut into blocks of ``block`` words (the last may be shorter). Places come from two levels
   of prefix sums over hashed cells, so no source is ever ordered in one task.
3. Draws. Each output shard has ``shard_slots`` slots (the last one fewer). A source gets the
   whole part of its expected number of slots in each, and the slots that this leaves are
   multinomial draws by the fractions, from hashes of (seed, shard, slot). A slot beyond
   ``repeats`` rounds of its source's blocks is left empty.
4. The j-th slot of a source takes block (permutation of round j div n at j mod n), n its
   number of blocks, by a keyed swap-or-not permutation: no sorting, no table of places.
5. Slots and blocks meet in a join on (source, block index), which spreads a hot source. It
   names a sort-merge join: Spark's size of exploded rows is that of the rows before, so it
   would send all slots through the driver as a broadcast.

Every choice is a hash of the seed and the rows, so reruns agree.

Edge cases: null or empty texts have size 0 and take 0; a null source is one source, the
last; null doc_ids are ordinary ids; rows repeated whole each stand in the mix for
themselves; without any words all targets are 0; an empty table gives no rows; extra columns
of any name are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import store

#: Words of a block, slots of a shard, and times that a block may stand in the mix.
BLOCK = 32
SHARD_SLOTS = 4096
REPEATS = 3
#: Weights of the sources in code-point order, repeating (fixed values).
WEIGHTS = (5, 2, 1)
#: Parts of a slot in which expected numbers of slots are counted.
UNITS = 1 << 20
#: Slots that one task lays out.
TASK_SLOTS = 1 << 18
#: Rounds of the permutation.
ROUNDS = 16
#: Bins of a shard's draws that are broadcast; more are joined by sorting.
FEW_BINS = 4096
#: Rows that one cell orders, equal rows that stand as one until they are laid out, and cells
#: or shards that one span of a prefix sum holds.
CELL_ROWS = 512
CHUNK = 512
SPAN = 4096


def running_before(df: DataFrame, key: str, place: str, value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over rows of ``key`` with a smaller ``place`` (a number from
    0, one row each). Sums of spans come first, so a window holds a span or the spans."""
    span = F.floor(F.col(place) / SPAN)
    rows = df.withColumn("_span", span)
    spans = rows.groupBy(key, "_span").agg(F.sum(value).alias("_of_span"))
    earlier = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(F.col(key).alias("_key"), F.col("_span").alias("_at"), F.coalesce(F.sum("_of_span").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_span").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(spans, (F.col(key) == F.col("_key")) & (F.col("_span") == F.col("_at"))) \
        .select(*df.columns, (F.col("_before") + F.col("_inside")).cast("long").alias(out))


def words(text: Column) -> Column:
    """Number of words, runs of anything but blank, tab, LF, VT, FF and CR."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).otherwise(0).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, h, copies: one row for rows that are equal in text, doc_id and
    source."""
    rows = docs.select("doc_id", "source", words(F.coalesce("text", F.lit(""))).alias("size"),
                       F.xxhash64("doc_id", "source", "text").alias("h"))
    rows = rows.groupBy("doc_id", "source", "size", "h").agg(F.count(F.lit(1)).alias("copies"))
    return store(rows, "mixing-sizes")


def chunked(sizes: DataFrame) -> DataFrame:
    """``sized`` with equal rows in chunks, ``first_copy`` to ``last_copy``, so that one row
    repeated any number of times is laid out by many tasks."""
    return sizes.withColumn("first_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(CHUNK).cast("long")))) \
        .withColumn("last_copy", F.least(F.col("first_copy") + CHUNK, "copies") - 1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, src (its place, from 0), docs, source_size, target of each source of ``sized``."""
    found = sizes.groupBy("source").agg(F.sum(F.ceil(F.col("copies") / CHUNK)).alias("docs"), F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    # a rank over any number of sources: ranges of them, counts of the ranges, ranks inside
    ordered = F.col("source").asc_nulls_last()
    ranges = store(found.repartitionByRange(ordered).withColumn("part", F.spark_partition_id().cast("long")).withColumn("all", F.lit(0)), "mixing-sources")
    before = running_before(ranges.groupBy("all", "part").agg(F.count(F.lit(1)).alias("n")), "all", "part", "n", "before").select("part", "before")
    ranked = ranges.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(ordered))).join(before, "part")
    src = (F.col("before") + F.col("rank") - 1).cast("long")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights)).cast("int") + 1)
    sources = store(ranked.withColumn("src", src).withColumn("weight", weight).withColumn("most", F.col("source_size") * float(repeats)), "mixing-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, -1
    while True:  # one number a round: sources at their limit, until no more of them come
        held = F.col("weight") * F.lit(share) >= F.col("most") if full >= 0 else F.lit(False)
        now = sources.agg(F.count(F.when(held, 1)).alias("full"), F.sum(F.when(held, F.col("most"))).alias("taken"),
                          F.sum(F.when(~held, F.col("weight"))).alias("open")).first()
        if now["full"] == full or not now["open"]:
            break
        full, share = now["full"], (total - (now["taken"] or 0.0)) / now["open"]
    return store(sources.select("source", "src", "docs", "source_size", F.least("most", F.col("weight") * F.lit(share)).alias("target")), "mixing-targets")


def pieces(sizes: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """src, index, doc_id, source, h, copy, start, length: what each block holds of each
    document (``start`` words of the document before it)."""
    most = sources.agg(F.max("docs")).first()[0] or 0
    cells = max(1, math.ceil(most / CELL_ROWS))
    total = (F.col("last_copy") - F.col("first_copy") + 1) * F.col("size")
    rows = chunked(sizes.where("size > 0")).join(sources.select("src", F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source"))) \
        .select("src", "doc_id", "source", "size", "h", "first_copy", "last_copy", total.alias("words"), F.pmod(F.xxhash64("h", "first_copy"), F.lit(cells)).alias("cell"))
    of_cell = running_before(rows.groupBy("src", "cell").agg(F.sum("words").alias("words")), "src", "cell", "words", "before").select("src", "cell", "before")
    own = Window.partitionBy("src", "cell").orderBy("h", "first_copy", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("words").over(own), F.lit(0))).join(of_cell, ["src", "cell"])
    one = rows.withColumn("copy", F.explode(F.sequence("first_copy", "last_copy"))) \
        .withColumn("first", F.col("before") + F.col("inside") + (F.col("copy") - F.col("first_copy")) * F.col("size"))
    cut = one.withColumn("index", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))))
    begin = F.greatest(F.col("index") * block, F.col("first"))
    end = F.least((F.col("index") + 1) * block, F.col("first") + F.col("size"))
    return cut.select("src", "index", "doc_id", "source", "h", "copy", (begin - F.col("first")).alias("start"), (end - begin).alias("length"))


def _uniform(*of: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return (F.xxhash64(*of).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)).cast("double")


def shard_counts(sources: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """shard, src, n: slots of each source in each output shard."""
    blocks = F.ceil(F.col("source_size") / block)
    slots = F.col("target") * blocks / F.col("source_size")
    # in whole units, so that sums don't depend on the order in which tasks add them
    wanted = store(sources.where("target > 0").select("src", F.greatest(F.lit(1), F.round(slots * UNITS)).cast("long").alias("slots")), "mixing-slots")
    total = wanted.agg(F.sum("slots")).first()[0] or 0
    n_slots = max(1, round(total / UNITS)) if total else 0
    out = wanted.select(F.lit(0).cast("long").alias("shard"), "src", F.lit(0).cast("long").alias("n")).limit(0)
    whole, rest = divmod(n_slots, shard_slots)
    for first, shards, slots in ((0, whole, shard_slots), (whole, 1 if rest else 0, rest)):
        if not shards:
            continue
        expected = wanted.withColumn("mean", F.col("slots") * (slots / total))
        fixed = expected.withColumn("n", F.floor("mean")).where("n > 0")
        out = out.unionByName(fixed.select(F.explode(F.sequence(F.lit(first).cast("long"), F.lit(first + shards - 1).cast("long"))).alias("shard"), "src", "n"))
        left = slots - (fixed.agg(F.sum("n")).first()[0] or 0)
        if left <= 0:
            continue
        part = F.round((F.col("mean") - F.floor("mean")) * UNITS).cast("long")
        parts = store(expected.select("src", part.alias("part"), F.lit(0).alias("all")).where("part > 0"), "mixing-parts")
        size, bins = parts.agg(F.sum("part"), F.count(F.lit(1))).first()
        if not bins:
            continue
        # draws find their source by bins of [0, 1): a source stands in each bin that its
        # stretch meets, so the join is one of equal bins
        ends = running_before(parts, "all", "src", "part", "lo").select("src", (F.col("lo") / size).alias("lo"), ((F.col("lo") + F.col("part")) / size).alias("hi"))
        ends = ends.withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") * bins), F.least(F.floor(F.col("hi") * bins), F.lit(bins - 1)))))
        draws = parts.sparkSession.range(first, first + shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(1), F.lit(int(left)))).alias("draw"))
        draws = draws.withColumn("u", _uniform(F.lit(seed), F.col("shard"), F.col("draw"))).withColumn("bin", F.floor(F.col("u") * bins))
        drawn = draws.join(ends.hint("broadcast" if bins <= FEW_BINS else "merge"), "bin").where("u >= lo and u < hi")
        out = out.unionByName(drawn.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("n")))
    return out.groupBy("shard", "src").agg(F.sum("n").alias("n"))


def permuted(at: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """Place of ``at`` under a keyed permutation of 0 .. n - 1 (swap-or-not): each round
    mirrors the place at a keyed point, or not, by a hash that a place shares with its
    mirror image."""

    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(r, *key), n) - x, n)
        swap = F.xxhash64(F.greatest(x, mirror), r, *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), at, step)


def slots(sources: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, repeats: int = REPEATS, seed: int = 7) -> DataFrame:
    """shard, src, nth, index: the block that each slot of the mix takes (``nth`` counts a
    source's slots over all shards)."""
    counts = store(shard_counts(sources, block, shard_slots, seed), "mixing-counts")
    placed = running_before(counts, "src", "shard", "n", "first")
    n = F.ceil(F.col("source_size") / block).cast("long")
    placed = placed.join(sources.select("src", n.alias("blocks")), "src").where("n > 0")
    tasks = math.ceil((counts.agg(F.sum("n")).first()[0] or 0) / TASK_SLOTS)
    every = placed.repartition(max(1, tasks), "shard", "src").withColumn("nth", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))) \
        .where(F.col("nth") < F.col("blocks") * repeats)
    turn, at = F.floor(F.col("nth") / F.col("blocks")).cast("long"), F.col("nth") % F.col("blocks")
    return every.select("shard", "src", "nth", permuted(at, F.col("blocks"), F.lit(seed), F.col("src"), turn).alias("index"))


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = 7) -> DataFrame:
    """shard, src, nth, source, doc_id, h, copy, start, length: the mix as spans of words.
    Spans of a slot (shard, src, nth) follow each other by the block's documents; ``h`` and
    ``copy`` tell rows of one doc_id apart."""
    sizes = sized(docs)
    sources = source_targets(sizes, weights, repeats)
    return slots(sources, block, shard_slots, repeats, seed).join(pieces(sizes, sources, block).hint("merge"), ["src", "index"]) \
        .select("shard", "src", "nth", "source", "doc_id", "h", "copy", "start", "length")


def taken(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how many words the mix takes of each
    row of ``docs``, repeats counted."""
    sizes = sized(docs)
    sources = source_targets(sizes, weights, repeats)
    times = slots(sources, block, shard_slots, repeats, seed).groupBy("src", "index").agg(F.count(F.lit(1)).alias("times"))
    rows = pieces(sizes, sources, block).join(times.hint("merge"), ["src", "index"], "left") \
        .groupBy("doc_id", "source", "h", "copy").agg(F.sum("length").alias("size"), F.sum(F.col("length") * F.coalesce("times", F.lit(0))).alias("taken"))
    empty = chunked(sizes.where("size = 0")).repartition("h", "first_copy").withColumn("copy", F.explode(F.sequence("first_copy", "last_copy")))
    rows = rows.select("doc_id", "source", "size", "taken").unionByName(empty.select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken")))
    known = sources.select(F.col("source").alias("_source"), "source_size", "target")
    return rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "size", "source_size", "target", "taken")
