"""Sharding by a k-d tree over metadata.

A cell is split at the weighted median of its widest dimension until every leaf holds its
share of the bytes. Cells live in a table with a row each, never on the driver. Medians of
large cells are found by refining a histogram of a 60-bit order key, twelve bits a pass;
once every cell is small, the rest of the tree is split by sorting inside cells, which cuts
at the same places. The key puts the dimension first and two tie-breakers after it, so a
value that a third of all rows share is still cut where the bytes say.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from widevec.llm.common import table, utf8, written

PART_BITS = 20
ROUND_BITS = 12
BINS = 1 << ROUND_BITS
KEY_BITS = 3 * PART_BITS
# Rows that one task numbers at a time.
SLOT_BLOCK = 4096
# Rows of a cell that one task sorts.
CELL_ROWS = 4096
# Cells, of some 60 bytes, that are broadcast; more of them are joined by a shuffle, and then
# none holds much of the table.
SENT_CELLS = 1 << 18
# Levels of small cells planned as one job.
LEVELS = 6
EXACT = "decimal(38,0)"


def text_rank(column):
    """The first six bytes of a string as a number: keeps the order of strings."""
    head = F.rpad(F.hex(F.substring(utf8(column), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def kd_shards(points, dims, size, ties, target_bytes=None, shards=None):
    """``points`` with a ``shard`` column (int, from 0): the leaf of the k-d tree it falls in.

    points: a narrow table, since every level of large cells writes it once, with its order
    key. dims: names of numeric columns, null counting as the least value. size: name of the
    bytes column. ties: two long columns of at least 20 well spread bits that order rows of
    one dimension value. The number of leaves is ``shards``, or as many as ``target_bytes``
    asks for. An empty table has no leaves and gives no rows. Rows equal in all of dims and
    ties stay together, so leaves differ in bytes by the largest such group at most.
    """
    names = points.columns
    if shards is None:
        total = points.agg(F.sum(size)).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    tops = points.agg(*_ranges(dims)).first()
    spread = [max(tops[f"hi_{d}"] - tops[f"lo_{d}"], 1e-300) if tops[f"lo_{d}"] is not None else 1 for d in dims]
    points = points.withColumns({"shard": F.lit(0), "kd_leaves": F.lit(shards)})
    # The most leaves that a cell still has to be split into, and the most cells there are.
    most, cells = shards, 1
    while most > 1:
        stats = points.filter("kd_leaves > 1").groupBy("shard").agg(
            F.min("kd_leaves").alias("leaves"), F.count("*").alias("n"), F.sum(size).alias("whole"), *_ranges(dims)
        )
        plan = written(stats.select("shard", "leaves", "n", "whole", *_split(F.col("leaves"), dims, spread)), "cells")
        if (plan.agg(F.max("n")).first()[0] or 0) <= CELL_ROWS:
            return _split_small(points, dims, size, ties, spread, most).select(*names, "shard")
        sent = F.broadcast if cells <= SENT_CELLS else (lambda small: small)
        keyed = points.join(sent(plan.select("shard", "widest", "low", "width")), "shard", "left")
        keyed = keyed.withColumn("kd_key", _order_key(dims, ties)).select(*points.columns, "kd_key")
        keyed = written(keyed, "level")
        cuts = _weighted_cuts(keyed, plan, size, sent)
        above = F.col("kd_key") > F.col("cut")
        points = keyed.join(sent(cuts), "shard", "left").select(*names, *_moved(above))
        most, cells = most - most // 2, 2 * cells
    return points.select(*names, "shard")


def _moved(above):
    """Shard and leaves of a row after its cell is split into ``part`` leaves and the rest."""
    shard, leaves, part = F.col("shard"), F.col("kd_leaves"), F.col("part")
    return (
        F.when(above, shard + part).otherwise(shard).cast("int").alias("shard"),
        F.when(part.isNull(), leaves).when(above, leaves - part).otherwise(part).cast("int").alias("kd_leaves"),
    )


def _split(leaves, dims, spread):
    """From the ranges of a cell: its widest dimension, where that starts, how wide it is and
    how many leaves go left."""
    widths = F.array(*[(F.col(f"hi_{d}") - F.col(f"lo_{d}")) / F.lit(float(s)) for d, s in zip(dims, spread)])
    widest = F.array_position(widths, F.array_max(widths)).cast("int") - 1
    low, high = (F.get(F.array(*[F.col(f"{end}_{d}") for d in dims]), widest) for end in ("lo", "hi"))
    return widest.alias("widest"), low.alias("low"), (high - low).alias("width"), F.floor(leaves / 2).cast("int").alias("part")


def _ranges(dims):
    return [f(_value(d)).alias(f"{name}_{d}") for d in dims for name, f in (("lo", F.min), ("hi", F.max))]


def _value(dim):
    return F.coalesce(F.nanvl(F.col(dim).cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def _order_key(dims, ties):
    value = F.coalesce(*[F.when(F.col("widest") == i, _value(d)) for i, d in enumerate(dims)])
    place = F.when(F.col("width") > 0, (value - F.col("low")) / F.col("width")).otherwise(0.0)
    top = F.floor(place * ((1 << PART_BITS) - 1)).cast("long")
    low = (1 << PART_BITS) - 1
    first, second = (F.col(t).bitwiseAND(F.lit(low)) for t in ties)
    key = F.shiftleft(top, 2 * PART_BITS).bitwiseOR(F.shiftleft(first, PART_BITS)).bitwiseOR(second)
    return F.when(F.col("widest").isNotNull(), key)


def _weighted_cuts(keyed, plan, size, sent):
    """(shard, part, cut) of every cell to split: the key up to which rows go left, the one
    whose weight comes nearest. A pass makes at most 4,096 sums per cell, added up by a
    window over the cell."""
    wanted = F.col("part").cast(EXACT) * F.col("whole")
    zero = F.lit(0).cast("long")
    state = plan.select("shard", "part", "leaves", wanted.alias("wanted"), zero.alias("prefix"), zero.alias("below"), F.lit(None).cast("long").alias("cut"))
    run = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for shift in range(KEY_BITS - ROUND_BITS, -1, -ROUND_BITS):
        still = state.filter("cut IS NULL")
        inside = keyed.select("shard", "kd_key", size).join(sent(still.select("shard", "prefix")), "shard")
        bins = (
            inside.filter(F.shiftright("kd_key", shift + ROUND_BITS) == F.col("prefix"))
            .groupBy("shard", F.shiftright("kd_key", shift).bitwiseAND(F.lit(BINS - 1)).alias("bin"))
            .agg(F.sum(size).alias("bytes"), F.min("kd_key").alias("least"), F.max("kd_key").alias("most"))
        )
        sums = bins.withColumn("upto", F.sum("bytes").over(run)).join(sent(still.select("shard", "leaves", "wanted", "below")), "shard")
        over = (F.col("below") + F.col("upto")).cast(EXACT) * F.col("leaves") - F.col("wanted")
        under = F.col("wanted") - (F.col("below") + F.col("upto") - F.col("bytes")).cast(EXACT) * F.col("leaves")
        reached = sums.filter(over >= 0).groupBy("shard").agg(
            F.min(F.struct("bin", "least", "most", (F.col("upto") - F.col("bytes")).alias("before"), (over <= under).alias("near"))).alias("hit")
        )
        alone = F.col("hit.least") == F.col("hit.most")
        cut = F.when(alone, F.col("hit.least") - F.when(F.col("hit.near"), 0).otherwise(1))
        state = written(
            state.join(reached, "shard", "left").select(
                "shard", "part", "leaves", "wanted",
                F.coalesce(F.shiftleft("prefix", ROUND_BITS).bitwiseOR(F.col("hit.bin")), "prefix").alias("prefix"),
                (F.col("below") + F.coalesce("hit.before", zero)).alias("below"),
                F.coalesce("cut", cut).alias("cut"),
            ),
            "cuts",
        )
        if state.filter("cut IS NULL").isEmpty():
            break
    return state.select("shard", "part", "cut")


def _split_small(points, dims, size, ties, spread, most):
    """The rest of the tree where each cell fits a task: rows are dealt by cell once, and
    every level is two windows over rows that lie together already."""
    names, done = points.columns, points.filter("kd_leaves <= 1")
    points = points.filter("kd_leaves > 1").withColumn("kd_root", F.col("shard")).repartition("kd_root")
    level = 0
    while most > 1:
        cell = Window.partitionBy("kd_root", "shard")
        ranges = {f"{end}_{d}": f(_value(d)).over(cell) for d in dims for end, f in (("lo", F.min), ("hi", F.max))}
        plan = points.withColumns({"whole": F.sum(size).over(cell), **ranges})
        widest, low, width, part = _split(F.col("kd_leaves"), dims, spread)
        splits = F.col("kd_leaves") > 1
        plan = plan.select("*", widest, low, width, F.when(splits, part).alias("part")).withColumn("kd_key", _order_key(dims, ties))
        along = cell.orderBy("kd_key")
        upto = F.sum(size).over(along.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        before = F.coalesce(F.sum(size).over(along.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
        least = F.min("kd_key").over(cell)
        plan = plan.withColumns({"upto": upto, "before": before, "least": least})
        wanted = F.col("part").cast(EXACT) * F.col("whole")
        over = F.col("upto").cast(EXACT) * F.col("kd_leaves") - wanted
        under = wanted - F.col("before").cast(EXACT) * F.col("kd_leaves")
        # Left of the key that reaches the wanted bytes, or that key itself if it is nearer.
        left = (over < 0) | ((under > 0) | (F.col("kd_key") == F.col("least"))) & (over <= under)
        points = plan.select(*[n for n in names if n not in ("shard", "kd_leaves")], *_moved(~left), "kd_root")
        most, level = most - most // 2, level + 1
        if level % LEVELS == 0 and most > 1:
            points = written(points, "levels").repartition("kd_root")
    return points.drop("kd_root").unionByName(done)


def with_slots(df, group, order):
    """``df`` with ``slot`` (long): its place in its group, gapless from 0.

    Rows are numbered in blocks spread by hash, so that no task holds a whole group, and
    blocks start where prefix sums of their counts say.
    """
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, math.ceil(largest / SLOT_BLOCK))
    dealt = df.withColumn("slot_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    counts = dealt.groupBy(group, "slot_block").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("slot_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "slot_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("slot_start"))
    inside = F.row_number().over(Window.partitionBy(group, "slot_block").orderBy(*order))
    numbered = dealt.withColumn("slot_row", inside).join(starts, [group, "slot_block"])
    slot = (F.col("slot_start") + F.col("slot_row") - 1).alias("slot")
    return numbered.select(*df.columns, slot)


def shard_documents(docs, shards=8, target_bytes=None):
    """Every document's shard and slot. The dimensions are language, source and length.

    Null text has no bytes and size 1; null metadata counts as the least value; repeated
    rows and repeated ids each get a slot of their own. Other columns are not looked at.
    """
    number = F.crc32(utf8(F.col("doc_id")))
    points = docs.select(
        "doc_id",
        (F.octet_length(utf8(F.col("text"))) + 1).cast("long").alias("size"),
        F.crc32(utf8(F.col("text"))).alias("text_crc32"),
        text_rank(F.col("lang")).alias("d_lang"),
        text_rank(F.col("source")).alias("d_source"),
        number.alias("id_crc32"),
    ).withColumn("d_length", F.log1p(F.col("size").cast("double")))
    points = written(points, "points")
    dims = ["d_lang", "d_source", "d_length"]
    placed = kd_shards(points, dims, "size", ["text_crc32", "id_crc32"], target_bytes, shards)
    return with_slots(placed, "shard", ["doc_id", "text_crc32", "id_crc32"])


def op1_kd_shards(spark, sf_dir):
    """All documents in eight shards of near equal bytes."""
    found = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
