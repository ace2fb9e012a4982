"""Chat logs: collapsing cumulative snapshots, then rendering.

A log that is saved after every answer holds each conversation many times, each a prefix of
the next. Every turn gets a hash of all turns up to it; a conversation whose last hash is
also the hash of a proper prefix of another one is a snapshot, and an anti-join drops it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from widevec.llm.common import table, written

# Turns that one task orders, hashes or renders at a time.
BLOCK = 256


def _blocks_before(partition, order, column, how):
    frame = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return how(column).over(frame)


def numbered_turns(turns):
    """(conv_id, pos, role, text): turns in order of turn number, counted from 0.

    Null roles and texts become empty; rows without a turn number come first; equal turn
    numbers are ordered by role and text. Rows are numbered within blocks of turn numbers
    and blocks start where the counts before them end, so one endless conversation is dealt
    over many tasks. Rows without a conv_id belong to one conversation of their own.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.floor(F.col("turn") / BLOCK).cast("long"))
    counts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    starts = counts.select(
        F.col("conv_id").alias("s_conv"),
        F.col("block").alias("s_block"),
        F.coalesce(_blocks_before(["conv_id"], "block", "n", F.sum), F.lit(0)).alias("start"),
    )
    inside = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text"))
    joined = rows.withColumn("row", inside).join(
        starts, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("block") == F.col("s_block"))
    )
    return joined.select("conv_id", (F.col("start") + F.col("row") - 1).alias("pos"), "role", "text")


def prefix_hashes(turns):
    """(conv_id, pos, h1, h2): 128 bits that stand for the turns 0 to pos.

    The rolling hash is the XOR of hashes that bind a turn to its place, so blocks of turns
    can be hashed apart and joined.
    """
    own = turns.select(
        "conv_id",
        "pos",
        F.floor(F.col("pos") / BLOCK).cast("long").alias("block"),
        F.xxhash64("pos", "role", "text").alias("t1"),
        F.xxhash64(F.lit(7), "text", "role", "pos").alias("t2"),
    )
    rolling = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    whole = own.groupBy("conv_id", "block").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    before = whole.select(
        F.col("conv_id").alias("s_conv"),
        F.col("block").alias("s_block"),
        *[
            F.coalesce(_blocks_before(["conv_id"], "block", f"b{k}", F.bit_xor), F.lit(0)).alias(f"c{k}")
            for k in (1, 2)
        ],
    )
    hashed = own.select(
        "conv_id", "pos", "block", *[F.bit_xor(f"t{k}").over(rolling).alias(f"r{k}") for k in (1, 2)]
    )
    joined = hashed.join(
        before, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("block") == F.col("s_block"))
    )
    return joined.select(
        "conv_id", "pos", *[F.col(f"r{k}").bitwiseXOR(F.col(f"c{k}")).alias(f"h{k}") for k in (1, 2)]
    )


def maximal_conversations(turns):
    """(conv_id, n_turns, n_copies): a row per conversation that no other one continues.

    Of conversations with equal turns the least conv_id stays and n_copies counts them.
    """
    hashes = prefix_hashes(turns)
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("last"))
    last = lengths.select(F.col("conv_id").alias("l_conv"), "last")
    marked = hashes.join(last, F.col("conv_id").eqNullSafe(F.col("l_conv")))
    whole = (
        marked.filter(F.col("pos") == F.col("last"))
        .groupBy("h1", "h2", "pos")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    inner = marked.filter(F.col("pos") < F.col("last")).select("h1", "h2", "pos").distinct()
    kept = whole.join(inner, ["h1", "h2", "pos"], "left_anti")
    return kept.select("conv_id", (F.col("pos") + 1).alias("n_turns"), "n_copies")


def rendered(turns, kept):
    """(conv_id, segment, n_turns, n_copies, text): the kept conversations as marked up text.

    A conversation is one row; one of over 256 turns goes on in further segments, so that no
    task gathers an unbounded text.
    """
    turn = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    names = kept.select(F.col("conv_id").alias("k_conv"), "n_copies")
    chosen = turns.join(names, F.col("conv_id").eqNullSafe(F.col("k_conv")))
    pieces = chosen.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).cast("long").alias("segment")).agg(
        F.count("*").alias("n_turns"),
        F.first("n_copies").alias("n_copies"),
        F.sort_array(F.collect_list(F.struct("pos", turn.alias("piece")))).alias("pieces"),
    )
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return pieces.select("conv_id", "segment", "n_turns", "n_copies", text.alias("text"))


def collapse_and_render(conversations):
    """Maximal conversations of a table (conv_id, turn, role, text), rendered."""
    turns = written(numbered_turns(conversations), "turns")
    return rendered(turns, maximal_conversations(turns))


def op7_chat_snapshots(spark, sf_dir):
    return collapse_and_render(table(spark, sf_dir, "conversations"))


OP7_SQL = """
WITH rows AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations),
prefixes AS (
    SELECT conv_id, pos,
           string_agg(pos || chr(1) || role || chr(2) || text || chr(3), '') OVER (PARTITION BY conv_id ORDER BY pos) AS seen,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM rows),
whole AS (
    SELECT seen, min(conv_id) AS conv_id, count(*) AS n_copies FROM prefixes WHERE pos = n - 1 GROUP BY seen),
kept AS (
    SELECT conv_id, n_copies FROM whole WHERE seen NOT IN (SELECT seen FROM prefixes WHERE pos < n - 1))
SELECT conv_id, CAST(floor(pos / 256) AS BIGINT) AS segment, count(*) AS n_turns,
       CAST(max(n_copies) AS BIGINT) AS n_copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM rows JOIN kept USING (conv_id) GROUP BY conv_id, floor(pos / 256)"""
