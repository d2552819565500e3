"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, ``epochs`` times
over. A document's virtual finish time is the running size of its queue divided
by the source's weight. A queue that runs out leaves its share to the others by
weight, which yields the water-filling targets: no source above ``epochs`` times
its size.

The cut is not found by a running total over all rows sorted by finish time.
``targets`` computes its virtual time in closed form from one row per source, and
each queue is cut at its own target. So one document may be taken in part in
every source, not one in all, in return for no global sort and targets met to the word.
``fair_queue`` orders its rows by finish time; ``mix_totals`` only sums them, and
Spark leaves that sort out.

The running sum never needs a source in one task: shuffled order is a 64-bit
hash, its leading bits cut a source into buckets, bucket totals are summed up in
order, and only a bucket's own rows are ordered in a window.

Only DataFrame functions; texts are read once for their sizes. Null text has
size 0 and takes nothing; a null source is a source, the last. Each row is a
document of its own, and rows with equal ids and texts are interchangeable, so
reruns agree. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratescape.llm.common import WORD, stored

#: Rows of a bucket of shuffled order, about; any value gives the same mix.
BUCKET_ROWS = 20_000
EPOCHS, BUDGET = 2, 1.5
CYCLE = (3.0, 1.0, 2.0)


def sized(docs: DataFrame, seed: int = 17) -> DataFrame:
    """_id, _source, _size (words) and _order (shuffled place) of each document, stored."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), size.alias("_size"), F.crc32("text").alias("_text"))
    order = F.xxhash64(F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit("null")), "_text")
    return stored(rows.select("_id", "_source", "_size", order.alias("_order")), "mix-sizes")


def cycled_weights(rows: DataFrame, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """(_source, _weight): sources by code point, null last, take the weights in turn. One row per source."""
    names = rows.select("_source").distinct()
    rank = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    return names.select("_source", F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")).alias("_weight"))


def targets(rows: DataFrame, weights: DataFrame, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """(_source, _weight, _source_size, _target, _cut): words to take of each source, virtual time of the cut.

    A source is exhausted at virtual time epochs * size / weight. In the order
    of these times, the cut lies where the exhausted sources' words and the
    others' weight times the time add up to the budget. One row per source.
    """
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    known = sizes.join(weights, sizes["_source"].eqNullSafe(weights["_source"])).select(sizes["_source"], "_weight", "_source_size")
    full = F.col("_source_size") * F.lit(float(epochs))
    by_end = Window.orderBy(full / F.col("_weight"), F.col("_source").asc_nulls_last())
    whole = Window.partitionBy()
    stated = known.select(
        "*",
        F.coalesce(F.sum(full).over(by_end.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"),
        F.sum("_weight").over(by_end.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("_open"),
        (F.sum("_source_size").over(whole) * F.lit(budget)).alias("_budget"),
    )
    # the first source, by its end, at whose end the budget is reached has the cut
    at = (F.col("_budget") - F.col("_before")) / F.col("_open")
    reached = F.min(F.when(at <= full / F.col("_weight"), F.struct(full / F.col("_weight"), at.alias("at")))).over(whole)["at"]
    cut = F.coalesce(reached, F.max(full / F.col("_weight")).over(whole))
    return stated.withColumn("_cut", cut).select("_source", "_weight", "_source_size", F.least(full, F.col("_weight") * F.col("_cut")).alias("_target"), "_cut")


def _queue_starts(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Rows with _start: the words of the own source before the row, in shuffled order."""
    n = max(1, rows.count() // bucket_rows + 1)
    share = F.shiftrightunsigned("_order", 32) / F.lit(float(1 << 32))
    dealt = rows.withColumn("_bucket", F.floor(share * n).cast("int"))
    unsigned = F.shiftrightunsigned("_order", 1)
    totals = dealt.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_total"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_source", "_bucket").orderBy(unsigned, "_order", "_size", F.col("_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    joined = local.join(offsets, local["_source"].eqNullSafe(offsets["_s"]) & (local["_bucket"] == offsets["_b"]))
    return joined.select("_id", "_source", "_size", "_order", (F.col("_offset") + F.col("_local")).alias("_start"))


def fair_queue(rows: DataFrame, weights: DataFrame, budget: float = BUDGET, epochs: int = EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The mix as rows of (document, epoch), each source cut at its target, ordered by virtual finish time.

    ``rows`` is from ``sized``; ``weights`` has one row per source. Adds _epoch,
    _finish (virtual) and _take, the words of this copy that the mix takes.
    """
    plan = targets(rows, weights, budget, epochs).select(F.col("_source").alias("_t"), "_weight", "_source_size", "_target", "_cut")
    queued = _queue_starts(rows, bucket_rows)
    copies = queued.join(plan, queued["_source"].eqNullSafe(plan["_t"])).drop("_t").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    start = F.col("_start") + F.col("_epoch") * F.col("_source_size")
    take = F.least(F.col("_size"), F.greatest(F.lit(0), F.floor(F.col("_target") + F.lit(1e-6)) - start)).cast("long")
    timed = copies.select("*", ((start + F.col("_size")) / F.col("_weight")).alias("_finish"), take.alias("_take"))
    return timed.where("_take > 0").orderBy("_finish", "_order", "_id")


def mix_totals(rows: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """Per document: _id, _size, _source, _source_size, _target and _taken, over all epochs; documents not taken too."""
    plan = targets(rows, weights, **{k: v for k, v in options.items() if k != "bucket_rows"})
    key = ["_id", "_source", "_size", "_order"]
    # equal rows are interchangeable: they share their words evenly, the first ones a word more
    taken = fair_queue(rows, weights, **options).groupBy(*key).agg(F.sum("_take").alias("_words"))
    numbered = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    same = F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in key))
    joined = numbered.alias("a").join(taken.alias("b"), same, "left").select("a.*", F.coalesce("b._words", F.lit(0)).alias("_words"))
    each = joined.withColumn("_k", F.explode(F.expr("sequence(0L, _n - 1)")))
    share = F.expr("_words div _n + IF(_k < _words % _n, 1, 0)").cast("long")
    rows_out = each.select("_id", "_source", "_size", share.alias("_taken"))
    plan = plan.select(F.col("_source").alias("_t"), "_source_size", "_target")
    return rows_out.join(plan, rows_out["_source"].eqNullSafe(plan["_t"])).drop("_t")
