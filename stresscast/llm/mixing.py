"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources get integer numbers of equal blocks by highest quotients of their targets; a source's blocks
go to its shards (hash buckets of documents) the same way; inside a shard the documents, in seeded
order, form one row of words that is cut into blocks, and seeded block ranks say which are taken.

A block grows with the corpus, so a source of less than ``LEAST_BLOCKS`` blocks is given its target in words, and the
shards of a source share words where a block is not small beside them. What shards cannot take (``cap`` times their words)
goes to the source's other shards. Error of a source, in words: at most 1/2 if it is given words; otherwise at most
``block * (1/2 + (n/2 + 1) * part)``, where ``part`` is its part of what the n sources given blocks get. That is less
than about ``1 / LEAST_BLOCKS`` of its target.

Scale: texts are read once for their word counts; everything after works on (id, source, size) rows. A
source is cut into shards of about ``shard_rows`` documents, so a hot source is many windows. The number
of blocks is a parameter and not the size of the corpus. Only per-source rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, staged, words_of

WEIGHTS = (5, 2, 1)
#: Resolution of the apportionment: blocks that the whole mix is made of.
N_BLOCKS = 1 << 18
SHARD_ROWS = 4096
#: Sources (and, on average, shards) of fewer blocks than this are apportioned in words.
LEAST_BLOCKS = 256


def _seeded(seed: int, *cols: Column | str) -> Column:
    """32 hex digits that depend on the seed and the columns (nulls: empty)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """``(source, n_docs, source_size, target)``: ``share`` of all words, by weight, at most ``cap`` times a source.

    Weights repeat over the sources in code point order, null last. The excess of capped sources is
    shared again by weight: the common level is found in closed form over the sources ordered by the
    level at which they are full.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    every = Window.orderBy("full_at", "rank")
    so_far = every.rowsBetween(Window.unboundedPreceding, -1)
    rest = every.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
            .withColumn("weight", weight)
            .withColumn("full_at", F.col("source_size") * F.lit(float(cap)) / F.col("weight"))
            .withColumn("level", (F.sum("source_size").over(whole) * F.lit(share)
                                  - F.coalesce(F.sum("source_size").over(so_far), F.lit(0)) * F.lit(float(cap)))
                        / F.sum("weight").over(rest))
            .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level")))
                        .over(whole)["level"])
            .select("source", "rank", "n_docs", "source_size",
                    F.least(F.col("source_size") * F.lit(float(cap)), F.col("weight") * F.col("level")).alias("target")))


def sainte_lague(rows: DataFrame, group: list[str], order: str, votes: str, seats: str, out: str) -> DataFrame:
    """Adds ``out``: seats of each row by the highest quotients votes / (1, 3, 5, ...) within its group.

    ``seats`` holds the group's number of seats; ties go to the smaller ``order``. Seats that every
    apportionment must give are counted in closed form (the quotients above votes / (2 seats - rows)),
    so only a few quotients a row are ranked. Group and order columns hold no nulls.
    """
    g = Window.partitionBy(*group)
    v, q = F.col(votes).cast("double"), F.col(seats)
    base = (rows.withColumn("_v", F.sum(v).over(g)).withColumn("_n", F.sum(F.when(v > 0, 1).otherwise(0)).over(g))
            .withColumn("_sure", F.when((F.col("_v") > 0) & (2 * q > F.col("_n")), F.greatest(F.lit(0), F.floor(
                v * (2 * q - F.col("_n")) / (2 * F.col("_v")) + F.lit(0.5 - 1e-9)))).otherwise(F.lit(0)).cast("long"))
            .withColumn("_open", q - F.sum("_sure").over(g))
            .withColumn("_offer", F.when(v > 0, F.least(F.col("_open"), F.ceil(v / F.col("_v") * F.col("_n")) + 2))
                        .otherwise(F.lit(0)).cast("long")))
    offers = (base.where("_offer > 0").select(*group, order, v.alias("_votes"), "_sure", "_open",
                                              F.explode(F.sequence(F.lit(1), F.col("_offer").cast("int"))).alias("_k"))
              .withColumn("_quotient", F.col("_votes") / (2 * (F.col("_sure") + F.col("_k")) - 1))
              .withColumn("_rank", F.row_number().over(g.orderBy(F.desc("_quotient"), order)))
              .where("_rank <= _open").groupBy(*group, order).agg(F.count("*").alias("_more")))
    return (base.join(offers, [*group, order], "left")
            .select(*rows.columns, (F.col("_sure") + F.coalesce("_more", F.lit(0))).alias(out)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42,
        weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: int = 2, n_blocks: int = N_BLOCKS,
        shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per document row; ``taken`` counts repeated words too.

    Null and blank texts have size 0 and nothing taken; a null source is a source of its own; rows
    repeated with the same id and size share what their place in the shard gives them. Empty table: no rows.
    """
    rows = docs_with(docs, id_col, text_col, source_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.size(words_of(F.col(text_col))).cast("long").alias("size"))
    sizes = staged(rows, "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    block = max(1, -(-int(total * share) // n_blocks))
    targets = source_targets(sizes, weights, share, cap).withColumn(
        "small", F.lit(block > 1) & (F.col("target") < LEAST_BLOCKS * block)).withColumns(
        {"exact": F.when(F.col("small"), F.round("target").cast("long")).otherwise(F.lit(0)),
         "shards": F.ceil(F.col("n_docs") / shard_rows), "one": F.lit(1)})
    in_blocks = targets.withColumns({
        "blocks": F.expr(f"({int(total * share)} - sum(exact) over (partition by one)) div {block}"),
        "votes": F.when(F.col("small"), F.lit(0.0)).otherwise(F.col("target"))})
    quotas = sainte_lague(in_blocks, ["one"], "rank", "votes", "blocks", "won")
    # Words of the source, and its seats: words if a block is not small beside its shards.
    quotas = (quotas.withColumn("goal", F.when(F.col("small"), F.col("exact")).otherwise(
                    F.least(F.col("won") * block, F.col("source_size") * cap)))
              .withColumn("in_words", F.col("small") | (F.lit(block > 1) & (F.col("source_size") < LEAST_BLOCKS * block * F.col("shards"))))
              .withColumn("unit", F.when(F.col("in_words"), F.lit(1)).otherwise(F.lit(block)).cast("long"))
              .withColumn("quota", F.when(F.col("in_words"), F.col("goal")).otherwise(F.col("won"))))
    quotas = staged(quotas, "quotas")

    s = sizes.alias("s")
    q = quotas.select(F.col("source").alias("src"), "rank", "source_size", "target", "goal", "unit", "quota", "shards").alias("q")
    mark = _seeded(seed, "doc_id", "size")
    placed = (s.join(q, F.col("source").eqNullSafe(F.col("src")))
              .withColumn("mark", mark)
              .withColumn("shard", F.pmod(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long"), F.col("shards"))))
    # A shard's documents in seeded order are one row of words: each document has a place in it.
    w = Window.partitionBy("rank", "shard").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = staged(placed.withColumn("upto", F.sum("size").over(w)).select(
        "doc_id", "size", "rank", "shard", "source_size", "target", "goal", "unit", "quota", (F.col("upto") - F.col("size")).alias("at"), "upto"), "placed")

    shards = placed.groupBy("rank", "shard", "goal", "unit", "quota").agg(F.sum("size").alias("words"))
    shards = sainte_lague(shards, ["rank"], "shard", "words", "quota", "got").withColumn(
        "take", F.least(F.col("got") * F.col("unit"), F.col("words") * cap))
    # What shards could not take goes to the room that others have, by whole words of running shares.
    every = Window.partitionBy("rank")
    upto = every.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    shards = (shards.withColumn("left", F.greatest(F.lit(0), F.col("goal") - F.sum("take").over(every)))
              .withColumn("room", F.col("words") * cap - F.col("take"))
              .withColumns({"rooms": F.sum("room").over(every), "room_upto": F.sum("room").over(upto)})
              .withColumn("take", F.col("take") + F.when(F.col("left") > 0, F.expr(
                  "cast(cast(left as decimal(19)) * room_upto div rooms as bigint)"
                  " - cast(cast(left as decimal(19)) * (room_upto - room) div rooms as bigint)")).otherwise(F.lit(0))))
    shards = (shards.withColumn("whole", F.when(F.col("words") > 0, F.expr("take div words")).otherwise(F.lit(0)))
              .withColumn("part", F.col("take") - F.col("whole") * F.col("words")))
    shards = staged(shards.select("rank", "shard", "words", "whole", "part"), "shards")

    ranked = Window.partitionBy("rank", "shard").orderBy("mark", "block").rowsBetween(Window.unboundedPreceding, -1)
    in_place = Window.partitionBy("rank", "shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (shards.where("words > 0")
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"words div {block}"))))
              .withColumn("long", F.least(F.lit(block).cast("long"), F.col("words") - F.col("block") * block))
              .withColumn("mark", _seeded(seed, "rank", "shard", "block"))
              .withColumn("ahead", F.coalesce(F.sum("long").over(ranked), F.lit(0)))
              .withColumn("taken", F.greatest(F.lit(0), F.least(F.col("long"), F.col("part") - F.col("ahead"))))
              .withColumn("before", F.coalesce(F.sum("taken").over(in_place), F.lit(0)))
              .select("rank", "shard", "block", F.col("taken").alias("in_block"), "before", "whole"))

    def below(df: DataFrame, place: str, name: str) -> DataFrame:
        """Words taken below a place: those of earlier blocks and its part of its own block."""
        b = blocks.select("rank", "shard", F.col("block").alias("_b"), "in_block", "before", F.col("whole").alias(f"whole_{name}"))
        return (df.withColumn("_b", F.expr(f"{place} div {block}")).join(b, ["rank", "shard", "_b"], "left")
                .withColumn(name, F.coalesce(F.col("before") + F.least("in_block", F.col(place) - F.col("_b") * block), F.lit(0)))
                .drop("_b", "in_block", "before"))

    out = below(below(placed, "at", "low"), "upto", "high")
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.coalesce("whole_low", F.lit(0)) + F.col("high") - F.col("low")).alias("taken"))
