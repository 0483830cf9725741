"""Preference formatting: the turns that chosen and rejected share are rendered once, the rest as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
# Neighbouring identifiers that are ordered in one task when branches of one opening are paired.
BLOCK = 1024


def _clean(turns: DataFrame) -> DataFrame:
    """Turns with place `pos` from 0 inside their conversation."""
    own = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    return own.withColumn("pos", F.row_number().over(order) - 1).drop("turn")


def branch_pairs(turns: DataFrame) -> DataFrame:
    """chosen_id, rejected_id, alone: conversations that open alike are branches of one prompt.

    Each branch is paired with the next larger conv_id of the same opening, so n branches give n - 1 pairs. A
    conversation whose opening no other has is `alone` and has no rejected_id.
    """
    heads = turns.where("pos = 0").select("conv_id", F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("opening"))
    heads = heads.withColumn("block", F.floor(F.col("conv_id") / BLOCK))
    inside = W.partitionBy("opening", "block").orderBy("conv_id")
    heads = heads.withColumns({"next": F.lead("conv_id").over(inside), "earlier": F.lag("conv_id").over(inside)})
    blocks = heads.groupBy("opening", "block").agg(F.min("conv_id").alias("head"))
    across = W.partitionBy("opening").orderBy("block")
    blocks = blocks.withColumns({"next_head": F.lead("head").over(across), "has_earlier": F.lag("head").over(across).isNotNull()})
    heads = heads.join(blocks, ["opening", "block"])
    rejected = F.coalesce("next", "next_head")
    alone = rejected.isNull() & F.col("earlier").isNull() & ~F.col("has_earlier")
    return heads.select(F.col("conv_id").alias("chosen_id"), rejected.alias("rejected_id"), alone.alias("alone")).where(
        "rejected_id is not null or alone"
    )


def preference_sides(conversations: DataFrame) -> DataFrame:
    """Turns of both sides of each pair: pair_id, rejected_id, chosen (boolean), pos, role, text.

    A conversation alone ends with its last reply; its rejected side has that reply cut to the first half of its
    characters. Without any reply it makes no pair.
    """
    turns = _clean(conversations)
    pairs = branch_pairs(turns)
    branched = pairs.where("not alone")
    side = lambda key, chosen: turns.join(
        branched.withColumnRenamed(key, "conv_id").select(
            "conv_id", *([F.col("conv_id").alias("pair_id"), "rejected_id"] if chosen else [F.col("chosen_id").alias("pair_id"), F.col("conv_id").alias("rejected_id")])
        ),
        "conv_id",
    ).select("pair_id", "rejected_id", F.lit(chosen).alias("chosen"), "pos", "role", "text")
    whole = W.partitionBy("conv_id")
    last = F.max(F.when(F.col("role") == TRAINED_ROLE, F.col("pos"))).over(whole)
    alone = turns.join(pairs.where("alone").select(F.col("chosen_id").alias("conv_id")), "conv_id")
    alone = alone.withColumn("last", last).where("pos <= last")
    cut = F.when((F.col("pos") == F.col("last")) & ~F.col("chosen"), F.expr("substring(text, 1, int(length(text) / 2))"))
    alone = alone.withColumn("chosen", F.explode(F.array(F.lit(True), F.lit(False)))).select(
        F.col("conv_id").alias("pair_id"), F.lit(None).cast("bigint").alias("rejected_id"), "chosen", "pos", "role",
        F.coalesce(cut, F.col("text")).alias("text"),
    )
    return side("chosen_id", True).unionByName(side("rejected_id", False)).unionByName(alone)


def preference_format(sides: DataFrame) -> DataFrame:
    """One row per pair: pair_id, rejected_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.

    `sides` has pair_id, rejected_id, chosen, pos (0, 1, 2 ... on each side), role, text. The longest run of turns
    from the start that both sides have alike (role and text) is the prompt. What follows on each side is that
    side's completion; a side that ends there has an empty one. A mask is a list of half-open ranges of characters
    `start-end`, separated by commas, of the completion's parts to train on: the replies with their end mark. Null
    role or text counts as empty; sides without turns make no row.
    """
    turn = F.struct("role", "text")
    both = sides.groupBy("pair_id", "pos").agg(
        F.max("rejected_id").alias("rejected_id"),
        F.max(F.when(F.col("chosen"), turn)).alias("c"),
        F.max(F.when(~F.col("chosen"), turn)).alias("r"),
    )
    pair = W.partitionBy("pair_id")
    so_far = pair.orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    both = both.withColumn("differ", F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("pos"))).over(pair))
    both = both.withColumn("shared", F.col("differ").isNull() | (F.col("pos") < F.col("differ")))

    def rendered(side: str) -> Column:
        t = F.col(side)
        return F.when(t.isNotNull(), F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE + "\n")))

    both = both.withColumns({"ct": rendered("c"), "rt": rendered("r")})
    grown = {f"{s}_end": F.sum(F.when(~F.col("shared"), F.length(f"{s}t"))).over(so_far) for s in "cr"}
    both = both.withColumns(grown)

    def joined(when: Column, what: str, by: str = "") -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(when, F.struct("pos", F.col(what).alias("x"))))), lambda e: e["x"]), by)

    def trained(side: str) -> Column:
        head = len(OPEN) + 1 + F.length(f"{side}.role")
        start = F.col(f"{side}_end") - F.length(f"{side}t") + head
        return F.when(F.col(f"{side}.role") == TRAINED_ROLE, F.concat_ws("-", start, F.col(f"{side}_end") - 1))

    both = both.withColumns({"cm": trained("c"), "rm": trained("r")})
    apart = ~F.col("shared")
    return both.groupBy("pair_id").agg(
        F.max("rejected_id").alias("rejected_id"),
        F.count(F.when(F.col("shared"), 1)).alias("prompt_turns"),
        joined(F.col("shared"), "ct").alias("prompt"),
        joined(apart & F.col("ct").isNotNull(), "ct").alias("chosen"),
        joined(apart & F.col("rt").isNotNull(), "rt").alias("rejected"),
        joined(apart & F.col("cm").isNotNull(), "cm", ",").alias("chosen_mask"),
        joined(apart & F.col("rm").isNotNull(), "rm", ",").alias("rejected_mask"),
    )
