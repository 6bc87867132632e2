"""Mixing sources to target weights: every document is repeated by a Poisson draw seeded by its hash.

A source's rate is its target share of the mixture over its share of the corpus. A document's count is the inverse of the
Poisson distribution with that mean at a number that is hashed from the seed and its id, so any rerun, in any order and
on any cluster, draws the same. All copies are then shuffled by a hash of their own.

Defined results: a null text is empty and is drawn like others; a null source is a source of its own; rows that share an
id share the draw; sources without characters keep the mean rate; an empty table gives an empty mixture; other columns
pass through, those named like a result are replaced. A source of few characters beside a large corpus has a high rate; its
documents are drawn in a bounded number of steps and their copies are dealt over the tasks in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import lookup_join, stored

#: A mean above this is drawn as the sum of several draws, since exp(-mean) would get too small.
MEAN_OF_A_DRAW = 500.0

#: A mean that would take more draws is drawn from the normal distribution with the same mean, variance and skewness.
MOST_DRAWS = 4_096

#: Steps that halve the distribution of a draw, which has fewer than 1,024 entries.
HALVES = [2**i for i in range(9, -1, -1)]

#: Copies of a document that one row of a task turns into.
BLOCK_COPIES = 10_000

#: Characters of one output partition.
PARTITION_CHARS = 64_000_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, hashed from the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(2**52)


def _cdf(mean: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... far into the tail."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.exp(-mean)
    state = F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("all"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(
            p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all")
        )

    return F.aggregate(F.sequence(F.lit(1), last), state, step, lambda s: s["all"])


def target_rates(
    docs: DataFrame, weights: Mapping[str, float], default_weight: float = 1.0, epochs: float = 1.0
) -> DataFrame:
    """One stored row per source: ``chars``, ``rate`` and the distribution of a draw.

    ``epochs`` is the size of the mixture in corpora.
    """
    chars = F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    sizes = docs.groupBy(F.col("source").alias("_rated_source")).agg(F.sum(chars).alias("chars"))
    named = [F.when(F.col("_rated_source") == s, F.lit(float(w))) for s, w in weights.items()]
    weight = F.coalesce(*named, F.lit(float(default_weight)))
    sizes = stored(
        sizes.withColumn("weight", F.when(F.col("chars") > 0, weight).otherwise(0.0)), "mix-sizes"
    )
    total, sum_weights = sizes.agg(F.sum("chars"), F.sum("weight")).first()
    share = F.col("weight") * float(epochs) * float(total or 0)
    rate = F.when(
        F.col("chars") > 0, share / (F.lit(float(sum_weights or 1)) * F.col("chars"))
    ).otherwise(float(epochs))
    rates = sizes.withColumn("rate", rate)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN_OF_A_DRAW))
    rates = rates.withColumn("parts", F.when(draws <= MOST_DRAWS, draws).otherwise(0).cast("int"))
    cdf = F.when(F.col("parts") > 0, _cdf(F.col("rate") / F.greatest("parts", F.lit(1))))
    return stored(rates.withColumn("cdf", cdf.otherwise(F.array().cast("array<double>"))), "mix-rates")


def _entries_up_to(cdf: Column, number: Column) -> Column:
    """How many entries of the rising ``cdf`` are at most ``number``: the entry is found by halving."""
    halves = F.array(*[F.lit(h) for h in HALVES])

    def step(at: Column, half: Column) -> Column:
        inside = (at + half <= F.size(cdf)) & (F.get(cdf, at + half - 1) <= number)
        return F.when(inside, at + half).otherwise(at)

    return F.aggregate(halves, F.lit(0), step)


def _large(mean: Column, *seed: Column) -> Column:
    """A draw with a large mean: a normal number, corrected for the skewness."""
    radius = F.sqrt(-2 * F.log(1 - uniform(*seed, F.lit("radius"))))
    normal = radius * F.cos(uniform(*seed, F.lit("angle")) * 2 * math.pi)
    skewed = F.transform(F.array(normal), lambda z: mean + z * F.sqrt(mean) + (z * z - 1) / 6)[0]
    return F.greatest(F.lit(0).cast("long"), F.round(skewed).cast("long"))


def draw(docs: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """``docs`` with ``rate`` and ``n_copies``."""
    rows = lookup_join(
        docs.drop("rate", "n_copies"),
        rates.select("_rated_source", "rate", "parts", "cdf"),
        F.col("source").eqNullSafe(F.col("_rated_source")),
    )
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    # The one-element array has the number worked out once, not once per step.
    below = lambda j: F.transform(
        F.array(uniform(F.lit(seed), doc, j)), lambda u: _entries_up_to(F.col("cdf"), u)
    )[0].cast("long")
    summed = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0).cast("long"), lambda n, j: n + below(j))
    count = F.when(F.col("parts") > 0, summed).otherwise(_large(F.col("rate"), F.lit(seed), doc))
    return rows.withColumn("n_copies", count).drop("_rated_source", "parts", "cdf")


def most_copies(rates: DataFrame) -> int:
    """More copies than any document can get: the ends of the distributions, summed over the draws."""
    ends = F.when(F.col("parts") > 0, F.col("parts").cast("long") * F.size("cdf"))
    return rates.agg(F.max(ends.otherwise(2**62))).first()[0] or 0


def replicate(drawn: DataFrame, seed: int, most: int | None = None) -> DataFrame:
    """One row per copy with its number ``copy``, from 1, and ``shuffle_key``.

    Documents with more copies than a block go to as many tasks as they have blocks. With ``most``, more copies than any
    document has, they are only looked for where there can be some.
    """
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    one = F.lit(1).cast("long")
    numbers = lambda lo, hi: F.when(
        hi >= lo, F.sequence(lo, hi)
    ).otherwise(F.array().cast("array<bigint>"))
    drawn = drawn.drop("copy")
    few = drawn if most is not None and most <= BLOCK_COPIES else drawn.filter(F.col("n_copies") <= BLOCK_COPIES)
    rows = few.withColumn("copy", F.explode(numbers(one, F.col("n_copies"))))
    if few is not drawn:
        last = F.floor((F.col("n_copies") - 1) / BLOCK_COPIES).cast("long")
        blocks = drawn.filter(F.col("n_copies") > BLOCK_COPIES).withColumn("_copy_block", F.explode(F.sequence(one - 1, last)))
        parts = int(drawn.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = blocks.repartition(parts, F.xxhash64(doc, "_copy_block"))
        first = F.col("_copy_block") * BLOCK_COPIES
        upto = F.least(first + BLOCK_COPIES, F.col("n_copies"))
        rows = rows.unionByName(blocks.withColumn("copy", F.explode(numbers(first + 1, upto))).drop("_copy_block"))
    return rows.withColumn("shuffle_key", uniform(F.lit(seed), F.lit("order"), doc, F.col("copy")))


def shuffled(copies: DataFrame, chars: int) -> DataFrame:
    """Copies in the order of ``shuffle_key`` over all partitions: the key is uniform, so equal ranges of it are even."""
    default = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(default, math.ceil(chars / PARTITION_CHARS))
    part = F.floor(F.col("shuffle_key") * n).cast("int")
    return copies.repartitionById(n, part).sortWithinPartitions("shuffle_key", "copy")


def mix(
    docs: DataFrame,
    weights: Mapping[str, float],
    default_weight: float = 1.0,
    epochs: float = 1.0,
    seed: int = 17,
) -> DataFrame:
    rates = target_rates(docs, weights, default_weight, epochs)
    chars = rates.agg(F.sum(F.col("chars") * F.col("rate"))).first()[0] or 0
    return shuffled(replicate(draw(docs, rates, seed), seed, most_copies(rates)), math.ceil(chars))
