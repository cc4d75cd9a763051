"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source passes through its shuffled documents ``epochs`` times.  A pass of a document has a virtual finish time: the
words its source has issued up to its end, divided by the source's target.  All passes are ordered by finish time, range
by range, and the order is cut where the budget is spent.  So all sources stop at nearly the same virtual time, each
within one document of its target.

Only sums meet in one task.  A source is shuffled by a hash of the id, whose top bits cut it into ``SLICES`` slices: a
document's place is the sum of the earlier slices plus a running sum within its own.  The place of the cut is found in
the same way, from sums per range of finish time and a running sum in the one range where the budget runs out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import WORD, Scratch, table

SLICE_BITS = 12
RANGES = 4096  # per unit of virtual time


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(source, source_size) -> source, source_size, target.

    Sources in code-point order, null last, take the weights in turn and share ``share`` times all sizes; a target stops
    at ``most`` times its source's size and the excess is shared anew by weight until none is above.  Sources reach
    their limits in the order of limit per weight.  With the lowest ones at theirs, the others get an equal level per
    weight; the first source that this leaves within its limit settles the level.  One row per source is ordered here.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn).cast("double")) \
        .withColumn("limit", most * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("rest", share * F.sum("source_size").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - F.sum("limit").over(upto) + F.col("limit"))
    rows = rows.withColumn("level", F.col("rest") / F.sum("weight").over(after))
    within = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    level = F.first(within, ignorenulls=True).over(upto)
    return rows.select("source", "source_size", F.coalesce(level * F.col("weight"), F.col("limit")).alias("target"))


def mix(docs: DataFrame, *, weights: list[int], share: float = 1.5, epochs: int = 2, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken (words taken: whole passes of the document).

    Null and empty texts have size 0 and nothing is taken of them.  A null source is a source of its own.  Repeated rows
    are documents of their own.  No rows give no rows.  Reruns agree: ties are ordered by id, pass and size.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "mixing")
    doc_id = F.col(id_col).cast("long")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    draw = F.xxhash64(F.lit(seed), doc_id)
    rows = scratch.store(docs.select(doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                     size.alias("size"), draw.alias("draw"),
                                     F.shiftrightunsigned(draw, 64 - SLICE_BITS).cast("int").alias("slice")), "sizes")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, float(epochs))
    goals = scratch.store(goals, "targets")

    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    starts = sums.join(goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "of", F.col("slice").alias("cut"), "before", "source_size", "target")
    within = Window.partitionBy("source", "slice").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    issued = rows.withColumn("running", F.sum("size").over(within)).join(
        starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("cut")))
    finish = F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda n: F.try_divide(
        n * F.col("source_size") + F.col("before") + F.col("running"), F.col("target")))
    issued = scratch.store(
        issued.select("doc_id", "source", "size", "draw", "source_size", "target", finish.alias("finish")), "finish")

    at = F.struct("finish", "draw", "doc_id", "epoch", "size")
    passes = issued.filter("size > 0").select("size", "draw", "doc_id", F.posexplode("finish").alias("epoch", "finish")) \
        .withColumn("range", F.floor(F.col("finish") * RANGES))
    budget = goals.agg(share * F.sum("source_size")).first()[0] or 0.0
    ranges = passes.groupBy("range").agg(F.sum("size").alias("words"))
    ranges = ranges.withColumn("upto", F.sum("words").over(Window.orderBy("range")))
    crossing = ranges.filter(F.col("upto") > budget).orderBy("range").first()
    taken = F.lit(epochs)  # every pass, unless the budget runs out
    if crossing is not None:
        inside = passes.filter(F.col("range") == crossing["range"]).withColumn(
            "upto", F.sum("size").over(Window.partitionBy("range").orderBy(at)) + (crossing["upto"] - crossing["words"]))
        # The first pass that no longer fits, a single row.
        cut = inside.filter(F.col("upto") > budget).agg(F.min(at).alias("at")).first()["at"]
        end = F.struct(*(F.lit(cut[c]).cast(kind) for c, kind in zip(
            ("finish", "draw", "doc_id", "epoch", "size"), ("double", "long", "long", "int", "long"), strict=True)))
        taken = sum(F.when(F.struct(F.get("finish", F.lit(n)), F.col("draw"), F.col("doc_id"), F.lit(n), F.col("size")) < end,
                           1).otherwise(0) for n in range(epochs))
    return issued.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * taken).alias("taken"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), weights=[3, 1, 2]).drop("source")
