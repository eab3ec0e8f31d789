"""A consistent-hash ring with virtual nodes and bounded loads.

Shards own many points (virtual nodes) on a ring. A key belongs to the first point
clockwise of its own position. Every shard has a fixed capacity, n // shards rows or one
more, and what a full shard cannot take continues clockwise, first come first served, to
the next points with room. Capacities add up to the number of rows, so counts are at most
one apart, while most rows stay where the plain ring puts them, and another shard count moves few rows.

Only DataFrame functions are used. Rows are counted per arc (the stretch before a point);
the clockwise walk then folds over the arcs, of which there are ``shards * replicas``
whatever the number of rows, going round twice. The fold holds one entry per shard and step
in one row, so its work grows with the square of the number of shards: seconds for dozens,
too slow for thousands. Each arc's rows, in ring order, fall into
a few segments, and a row's rank in its arc picks its segment, hence shard and slot. Ranks
come from counts per key and per stretch of rows, so neither a key that holds a third of
all rows nor a shard is ever ordered in one task.

The rows are written once with a number that makes them distinct. Null keys share one
position; repeated keys and rows are placed one after the other. An empty table gives an
empty result. Added columns are renamed if their names are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_name, stored

RING_BITS, SLICE_BITS = 60, 12
CHUNK_BITS = 18  # rows of one key that are numbered in one task: 2 ** 18
STRETCH_ROWS = 50_000


def position(key: Column) -> Column:
    """The place of a key on the ring, 0 to 2 ** 60 - 1."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, RING_BITS // 4), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int, replicas: int) -> DataFrame:
    """The points in order: arc, shard, lo, hi. An arc holds positions in (lo, hi].

    A point's place follows from its shard and replica alone, so one more shard adds points
    and moves none. ``shards * replicas`` rows; the first point also takes what lies beyond
    the last one.
    """
    shard, replica = F.expr(f"id div {replicas}").cast("int"), F.col("id") % replicas
    points = spark.range(shards * replicas, numPartitions=1).select(
        shard.alias("shard"), position(F.concat_ws("-", F.lit("shard"), shard, replica)).alias("hi")
    )
    order = Window.orderBy("hi", "shard")
    return points.select(
        (F.row_number().over(order) - 1).alias("arc"), "shard", F.lag("hi", 1, -1).over(order).alias("lo"), "hi"
    )


def arcs_by_slice(points: DataFrame) -> DataFrame:
    """The arcs, once for each of the 4096 slices of the ring that they touch."""
    shift = RING_BITS - SLICE_BITS
    top = (1 << RING_BITS) - 1
    beyond = points.agg(F.max("hi").alias("lo")).select(F.lit(0).alias("arc"), "lo", F.lit(top).alias("hi"))
    spans = points.select("arc", "lo", "hi").unionByName(beyond).where("hi > lo")
    first, last = F.shiftright(F.greatest("lo", F.lit(0)), shift), F.shiftright("hi", shift)
    return spans.select("arc", "lo", "hi", F.explode(F.sequence(first, last)).alias("slice"))


def walk(points: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """The clockwise walk: per step arc, shard, own rows taken, and queue numbers.

    Overflow joins the end of a queue and leaves at its front; ``push_from`` and ``pop_from``
    are the numbers of the first row that joins and leaves, ``pushed`` and ``popped`` those
    after the last.
    """
    arcs = points.join(F.broadcast(counts), "arc", "left").agg(
        F.sort_array(F.collect_list(F.struct("arc", "shard", F.coalesce("n", F.lit(0)).alias("n")))).alias("arcs"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    twice = F.concat("arcs", F.transform("arcs", lambda a: a.withField("n", F.lit(0).cast("long"))))
    room = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.expr(f"total div {shards}") + F.when(i < F.col("total") % shards, 1).otherwise(0),
    )
    step = "struct<arc:int,shard:int,own:bigint,push_from:bigint,pushed:bigint,pop_from:bigint,popped:bigint>"
    start = F.struct(
        room.alias("room"), F.lit(0).cast("long").alias("pushed"), F.lit(0).cast("long").alias("popped"),
        F.array().cast(f"array<{step}>").alias("steps"),
    )

    def move(state: Column, arc: Column) -> Column:
        free = F.element_at(state.room, arc.shard + 1)
        own = F.least(arc.n, free)
        pushed = state.pushed + arc.n - own
        popped = state.popped + F.least(pushed - state.popped, free - own)
        left = free - own - (popped - state.popped)
        return F.struct(
            F.transform(state.room, lambda r, i: F.when(i == arc.shard, left).otherwise(r)).alias("room"),
            pushed.alias("pushed"), popped.alias("popped"),
            F.concat(
                state.steps,
                F.array(
                    F.struct(
                        arc.arc.alias("arc"), arc.shard.alias("shard"), own.alias("own"),
                        state.pushed.alias("push_from"), pushed.alias("pushed"),
                        state.popped.alias("pop_from"), popped.alias("popped"),
                    ).cast(step)
                ),
            ).alias("steps"),
        )

    done = arcs.select(F.aggregate(twice, start, move, lambda s: s.steps).alias("steps"))
    return done.select(F.posexplode("steps").alias("step", "s")).select("step", "s.*")


def segments(steps: DataFrame) -> DataFrame:
    """Stretches of ranks per arc that share a shard: arc, shard, rank_from, rank_to, slot_from.

    At most six for each point, so the windows here are over a fixed number of rows.
    """
    own = steps.where("own > 0").select("arc", "shard", F.lit(0).cast("long").alias("rank_from"), F.col("own").alias("rank_to"))
    joins = steps.where("pushed > push_from").select(
        F.col("push_from").alias("at"), F.struct("arc", "own", "push_from").alias("into"), F.lit(None).cast("int").alias("shard")
    )
    leaves = steps.where("popped > pop_from").select(F.col("pop_from").alias("at"), F.lit(None).alias("into"), "shard")
    marks = joins.unionByName(leaves).groupBy("at").agg(F.max("into").alias("into"), F.max("shard").alias("shard"))
    so_far, whole = Window.orderBy("at"), steps.agg(F.max("pushed").alias("whole"))
    carried = (
        marks.select(
            "at", F.last("into", True).over(so_far).alias("into"), F.last("shard", True).over(so_far).alias("shard"),
            F.lead("at").over(so_far).alias("until"),
        )
        .join(F.broadcast(whole), F.coalesce("until", "at") <= F.col("whole"))
        .withColumn("until", F.coalesce("until", "whole"))
        .select(
            F.col("into.arc").alias("arc"), "shard",
            (F.col("into.own") + F.col("at") - F.col("into.push_from")).alias("rank_from"),
            (F.col("into.own") + F.col("until") - F.col("into.push_from")).alias("rank_to"),
        )
    )
    before = Window.partitionBy("shard").orderBy("arc", "rank_from").rowsBetween(Window.unboundedPreceding, -1)
    return own.unionByName(carried).select(
        "*", F.coalesce(F.sum(F.col("rank_to") - F.col("rank_from")).over(before), F.lit(0)).alias("slot_from")
    )


def ranked(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (arc, pos, uid) with their rank in the arc, by position, then uid."""
    bits = max(0, (total // STRETCH_ROWS).bit_length())
    rows = rows.withColumn("chunk", F.shiftright("uid", CHUNK_BITS)).withColumn("stretch", F.shiftright("pos", RING_BITS - bits))
    counts = rows.groupBy("arc", "stretch", "pos", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    in_stretch = before(Window.partitionBy("arc", "stretch").orderBy("pos", "chunk"))
    bases = counts.groupBy("arc", "stretch").agg(F.sum("n").alias("n")).select(
        "arc", "stretch",
        F.coalesce(F.sum("n").over(before(Window.partitionBy("arc").orderBy("stretch"))), F.lit(0)).alias("base"),
    )
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(in_stretch), F.lit(0))).join(bases, ["arc", "stretch"])
    numbered = rows.withColumn("number", F.row_number().over(Window.partitionBy("pos", "chunk").orderBy("uid")) - 1)
    found = offsets.select("pos", "chunk", (F.col("base") + F.col("offset")).alias("offset"))
    return numbered.join(found, ["pos", "chunk"]).withColumn("rank", F.col("offset") + F.col("number"))


def assign(
    rows: DataFrame, key: Column, shards: int, replicas: int = 64, shard_col: str = "shard", slot_col: str = "slot"
) -> DataFrame:
    """``rows`` with their shard and their gapless place in it.

    ``rows`` is written once, so select narrow columns first.
    """
    spark = rows.sparkSession
    packed = stored(
        rows.select(F.struct(*rows.columns).alias("row"), position(key).alias("pos"), F.monotonically_increasing_id().alias("uid")),
        "ring-rows",
    )
    total = packed.count()
    points = ring(spark, shards, replicas)
    slices = arcs_by_slice(points)
    placed = packed.withColumn("slice", F.shiftright("pos", RING_BITS - SLICE_BITS)).join(F.broadcast(slices), "slice")
    placed = placed.where("pos > lo AND pos <= hi").select("arc", "pos", "uid", "row")
    # A fixed number of rows, read several times below.
    steps = stored(walk(points, placed.groupBy("arc").agg(F.count(F.lit(1)).alias("n")), shards), "ring-steps")
    found = segments(steps)
    shard, slot = fresh_name(rows, shard_col), fresh_name(rows, slot_col)
    return (
        ranked(placed, total).join(F.broadcast(found), "arc").where("rank >= rank_from AND rank < rank_to")
        .select("row.*", F.col("shard").alias(shard), (F.col("slot_from") + F.col("rank") - F.col("rank_from")).alias(slot))
    )
