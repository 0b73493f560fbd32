"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source lie on one line for each shard, document after document in a seeded order, cut into blocks of
equally many words. Blocks are seats: sources get them by the highest quotients target / (2k + 1), and so do the
shards of a source. A shard takes all its blocks as often as its quota covers them, and for the rest those with the
smallest seeded hashes, so a block is taken at most one time more than another.

The highest quotients are found without listing all of them. For n parties and B seats, rounding every weight to
divisors that would give n/2 seats fewer or more leaves at most 2n seats open, and only those are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.frames import stored

#: Words of a block, and words of a shard; a shard's blocks are ranked inside one row.
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 20
EPOCHS = 2
SHARE = 1.5
WEIGHTS = (3, 1, 2)
SEED = 17


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(*parts: Column | int | str) -> Column:
    """A seeded number of 60 bits."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """(source, size) to (source, size, target).

    Sources in order of code point, null last, get the weights in turn. A target is its weight times a common level,
    but no more than ``epochs`` times the size; the level makes them add up to ``share`` of all sizes.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    rows = rows.withColumn("cap", (epochs * F.col("size")).cast("double"))
    # From the source that is full first: all before it are full, and the level is set by what is left.
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, here = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = share * F.sum("size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(here)
    rows = rows.withColumn("level", level).withColumn("open", F.col("weight") * F.col("level") <= F.col("cap"))
    final = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    target = F.when(F.col("open"), F.col("weight") * F.coalesce(final, F.lit(0.0))).otherwise(F.col("cap"))
    return rows.select("source", "size", target.alias("target"))


def apportion(parties: DataFrame, by: list[str], name: str, weight: str, seats: Column) -> DataFrame:
    """``parties`` with a column ``quota``: ``seats`` of each group ``by`` dealt to its rows by highest quotients.

    Equal quotients go to the smaller ``name``. A group without weight gets no seats.
    """
    group = Window.partitionBy(*by)
    rows = parties.withColumn("seats", seats).withColumn("parties", F.count("*").over(group))
    rows = rows.withColumn("weights", F.sum(weight).over(group).cast("double"))
    for end, sign in (("sure", -1), ("most", 1)):
        divided = F.col(weight) * (F.col("seats") + sign * F.col("parties") / 2) / F.col("weights")
        rounded = F.greatest(F.floor(divided + F.lit(0.5)) + (sign if sign > 0 else -1), F.lit(0)).cast("long")
        rows = rows.withColumn(end, F.when(F.col("weights") > 0, rounded).otherwise(0))
    rows = rows.withColumn("left", F.col("seats") - F.sum("sure").over(group))
    seat = F.explode(F.when(F.col("most") > F.col("sure"), F.sequence(F.col("sure"), F.col("most") - 1)))
    open_seats = rows.select(*by, name, "left", F.col(weight).alias("w"), seat.alias("k"))
    best = Window.partitionBy(*by).orderBy((F.col("w") / (2 * F.col("k") + 1)).desc(), F.col(name).asc_nulls_last(), "k")
    won = open_seats.withColumn("place", F.row_number().over(best)).where(F.col("place") <= F.col("left"))
    won = won.groupBy(*[F.col(c).alias(f"won_{c}") for c in (*by, name)]).agg(F.count("*").alias("more"))
    rows = rows.join(won, [F.col(c).eqNullSafe(F.col(f"won_{c}")) for c in (*by, name)], "left")
    rows = rows.withColumn("quota", F.col("sure") + F.coalesce("more", F.lit(0)))
    return rows.select(*parties.columns, "quota")


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Documents (doc_id, text, source) to (doc_id, source, size, source_size, target, taken), a row for each row.

    ``size`` is the number of words, 0 for a null text; ``taken`` counts the words the mix takes, repeats included,
    at most ``epochs`` times the size. A null source is a source of its own, the last one. Documents without words
    take none. Rows with equal doc_id and size lie next to each other and count each. Other columns are not read.
    """
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    by_source = sized.groupBy("source").agg(F.sum("size").alias("size"))
    goals = stored(targets(by_source, weights, share, epochs).withColumn("all", F.lit(0)))
    blocks = F.ceil(share * F.sum("size").over(Window.partitionBy("all")) / block_words)
    goals = apportion(goals, ["all"], "source", "target", blocks.cast("long")).drop("all")
    goals = stored(goals.withColumn("shards", F.greatest(F.ceil(F.col("size") / shard_words), F.lit(1))))
    goals = goals.withColumnsRenamed({"size": "source_size", "quota": "source_quota"})
    shard = F.pmod(draw(seed, F.col("doc_id")), "shards")
    goals = goals.withColumnRenamed("source", "goal")
    rows = sized.join(goals, F.col("source").eqNullSafe(F.col("goal")))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "source_quota", shard.alias("shard"))
    placed = _placed(rows, seed)
    filled = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.max("source_quota").alias("source_quota"))
    shards = apportion(filled, ["source"], "shard", "words", F.col("source_quota"))
    shards = stored(_selected(shards, block_words, epochs, seed))
    at = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("shard") == F.col("s_shard"))
    taken = _taken(F.col("begin"), F.col("size"), block_words, seed)
    return placed.join(shards, at).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def _placed(rows: DataFrame, seed: int) -> DataFrame:
    """Where each document begins on its shard's line."""
    line = Window.partitionBy("source", "shard").orderBy(draw(seed + 1, F.col("doc_id")), "doc_id", "size")
    begin = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1))
    return stored(rows.withColumn("begin", F.coalesce(begin, F.lit(0)).cast("long")))


def _selected(shards: DataFrame, block_words: int, epochs: int, seed: int) -> DataFrame:
    """How often a shard takes every block, and the largest hash of those it takes once more."""
    blocks = F.ceil(F.col("words") / block_words).cast("long")
    rows = shards.withColumn("blocks", blocks).withColumn("quota", F.least("quota", epochs * F.col("blocks")))
    rows = rows.withColumn("rounds", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0))
    rest = (F.col("quota") - F.col("rounds") * F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    lots = F.transform(every, lambda j: draw(seed + 2, F.col("source"), F.col("shard"), j))
    limit = F.when(rest > 0, F.element_at(F.array_sort(lots), rest)).otherwise(-1)
    named = [F.col("source").alias("s_source"), F.col("shard").alias("s_shard")]
    return rows.select(*named, "rounds", limit.alias("limit"))


def _taken(begin: Column, size: Column, block_words: int, seed: int) -> Column:
    """Words taken of a document: its part of every block, as often as the block is taken."""
    first, last = F.floor(begin / block_words), F.floor((begin + size - 1) / block_words)

    def add(so_far: Column, block: Column) -> Column:
        part = F.least((block + 1) * block_words, begin + size) - F.greatest(block * block_words, begin)
        chosen = draw(seed + 2, F.col("source"), F.col("shard"), block) <= F.col("limit")
        return so_far + F.when(chosen, part).otherwise(0)

    once = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), add)
    return F.when(size > 0, F.col("rounds") * size + F.when(F.col("limit") >= 0, once).otherwise(0)).otherwise(0).cast("long")
