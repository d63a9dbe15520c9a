"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the output over its present size. Every document is
repeated a Poisson number of times with that mean, drawn by inverting the distribution at a uniform
number from a seeded hash of the document: a retried task draws the same. Copies are exploded and dealt
out by a hash, then sorted by it, which is a global shuffle without a pass for range bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import sheltered, spread
from siltstone.session import stored

LARGEST_RATE = 256.0  # above, a count is the sum of several draws, so that exp(-rate) stays a normal number
HEX = 13


def uniform(seed: int, key: Column, draw: Column) -> Column:
    """A number in [0, 1) with 52 random bits."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), draw.cast("string"), key))
    return F.conv(F.substring(digest, 1, HEX), 16, 10).cast("double") / float(16**HEX)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None, epochs: float) -> DataFrame:
    """For each source its size, rate, draws and the distribution function of one draw.

    Sizes are code points of all texts. ``weights`` None gives every source with text the same share.
    """
    sizes = stored(docs.groupBy("source").agg(F.sum(F.char_length(F.coalesce("text", F.lit("")))).alias("size")), "sizes")
    if weights is None:
        shares = sizes.withColumn("weight", (F.col("size") > 0).cast("double"))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights are not negative")
        pairs = docs.sparkSession.createDataFrame(list(weights.items()), "source string, weight double")
        on = sizes["source"].cast("string").eqNullSafe(pairs["source"])
        shares = sizes.join(pairs, on, "left").select(
            sizes["source"], "size", F.when(F.col("size") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0).alias("weight")
        )
    size, weight = shares.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(float(weight or 1)) * F.lit(epochs * float(size or 0)) / F.col("size")
    rates = shares.select("source", "size", F.when(F.col("weight") > 0, rate).otherwise(0.0).alias("rate"))
    rates = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_RATE)).cast("int"))
    mean = F.col("rate") / F.col("draws")
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    first = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("upto"), F.array(F.exp(-mean)).alias("below"))
    step = lambda acc, k: F.struct(
        (acc["p"] * mean / k).alias("p"), (acc["upto"] + acc["p"] * mean / k).alias("upto"),
        F.concat(acc["below"], F.array(acc["upto"] + acc["p"] * mean / k)).alias("below"),
    )
    return rates.withColumn("below", F.aggregate(F.sequence(F.lit(1), last), first, step, lambda acc: acc["below"]))


def mix_sources(
    docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, seed: int = 17
) -> DataFrame:
    """The rows of ``docs`` repeated so that sources have their target shares of all text, in random order.

    Adds ``copy`` (0, 1, ...; an existing column of that name is replaced). The output has about ``epochs`` times the
    text of the input. Sources missing in ``weights`` and sources without text are left out; a null source is a
    source like others, and its key in ``weights`` is None. Draws depend on ``doc_id`` alone, or on the text where that is
    null, so repeated rows have equal counts. A null text counts as empty. An empty table gives no rows. Other columns
    come back as they are, whatever their names.
    """
    docs, moved = sheltered(docs.drop("copy"), {"source_", "draws_", "below_", "order_"})
    rates = source_rates(docs.select("source", "text"), weights, epochs).select(
        F.col("source").alias("source_"), F.col("draws").alias("draws_"), F.col("below").alias("below_")
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    one = lambda j: F.size(F.filter("below_", lambda c: c <= uniform(seed, key, j)))
    count = F.aggregate(F.sequence(F.lit(0), F.col("draws_") - 1), F.lit(0), lambda acc, j: acc + one(j))
    wide = docs.join(rates, docs["source"].eqNullSafe(rates["source_"]))
    counted = wide.withColumn("draws_", count).where("draws_ > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("draws_") - 1)))
    mixed = copies.withColumn("order_", F.xxhash64(F.lit(seed), key, "copy"))
    mixed = mixed.repartition(spread(docs.sparkSession), "order_").sortWithinPartitions("order_")
    return mixed.select(*[f"`{c}`" for c in docs.columns], "copy").withColumnsRenamed({free: name for name, free in moved.items()})
