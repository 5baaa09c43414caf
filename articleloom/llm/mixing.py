"""Mixing sources to target weights by Poisson replication.

A document of a source is repeated as often as a Poisson variable says whose mean is the source's
target repetition rate: the bytes the mix should have of the source over the bytes there are. The variable is the
inverse of the distribution at a number in [0, 1) that a hash of seed and id gives, so a rerun or a recomputed task
draws the same. The copies are range-partitioned by a hash of their own, a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = "mix-1"

# Weights go with a power of the size: below one, small sources are repeated and large ones thinned out.
POWER = 0.7

# Rows of the table of sources that are sent to all tasks; beyond it Spark plans a join.
MOST_SOURCES = 50_000
MOST_COPIES = 400
# Largest mean that is drawn at once: exp(-mean) is still a normal number.
MOST_MEAN = 700


def unit(*parts: Column) -> Column:
    """A number in [0, 1) from 48 bits of the md5 of the parts joined by ``/``; a null part is the text "null"."""
    text = F.concat_ws("/", *(F.coalesce(part.cast("string"), F.lit("null")) for part in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def source_rates(documents: DataFrame, weights: dict[str, float] | None = None, power: float = POWER) -> DataFrame:
    """``source, bytes, rate``: how often a source's documents should occur on average in a mix of the same total size.

    Without ``weights`` a source weighs as much as its bytes to the ``power``. A source that ``weights`` does not
    name weighs nothing. A null source is a source of its own, named by null; a source without bytes gets rate 1.
    """
    sizes = documents.groupBy("source").agg(
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes"))
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(power))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighed = sizes.withColumn("weight", weight)
    total, weights_of_all = weighed.agg(F.sum("bytes"), F.sum("weight")).first()
    if not total or not weights_of_all:
        return weighed.select("source", "bytes", F.lit(1.0).alias("rate"))
    rate = F.lit(total) * F.col("weight") / F.lit(weights_of_all) / F.col("bytes")
    return weighed.select("source", "bytes", F.when(F.col("bytes") == 0, 1.0).otherwise(rate).alias("rate"))


def poisson(chance: Column, mean: Column, most: int = MOST_COPIES) -> Column:
    """The least k whose cumulated Poisson chance exceeds ``chance``: inversion, term by term.

    The state stops growing once it has passed ``chance``. A mean m needs about m + 10 sqrt(m) terms; means so large
    that ``most`` terms are not enough, or that exp(-m) vanishes, should be split by the caller, as ``copies_drawn`` does.
    """
    first = F.exp(-mean)
    start = F.struct(F.lit(0).alias("k"), first.alias("term"), first.alias("sum"))

    def step(state: Column, _: Column) -> Column:
        term = state["term"] * mean / (state["k"] + 1)
        return F.when(state["sum"] > chance, state).otherwise(
            F.struct((state["k"] + 1).alias("k"), term.alias("term"), (state["sum"] + term).alias("sum")))

    terms = F.least(F.lit(most), F.ceil(mean + 10 * F.sqrt(mean) + 20)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda state: state["k"])


def copies_drawn(seed: str, own: Column, mean: Column, largest: float) -> Column:
    """A Poisson variable of any mean up to ``largest``; a mean above ``MOST_MEAN`` is the sum of parts with hashes of their own."""
    bound = min(largest, MOST_MEAN)
    most = max(MOST_COPIES, int(bound + 10 * bound**0.5 + 20))
    whole = poisson(unit(F.lit(seed), own), mean, most)
    if largest <= MOST_MEAN:
        return whole
    parts = F.greatest(F.ceil(mean / MOST_MEAN), F.lit(1)).cast("int")
    drawn = F.aggregate(
        F.sequence(F.lit(1), parts), F.lit(0),
        lambda total, part: total + poisson(unit(F.lit(seed), F.lit("part"), part, own), mean / parts, most))
    return F.when(mean <= MOST_MEAN, whole).otherwise(drawn)


def mixed(documents: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED,
          power: float = POWER) -> DataFrame:
    """``documents`` repeated to the target weights, with ``mix_copies, mix_copy, mix_rate, mix_key``; rows in ``mix_key`` order.

    Columns of these names that the input has are replaced. Equal rows draw the same number; a null id draws by its
    text. Null and empty texts are documents of no bytes. An empty table stays empty.
    """
    rates = source_rates(documents, weights, power)
    small = rates.agg(F.count(F.lit(1)), F.max("rate")).first()
    if small[0] <= MOST_SOURCES:
        rates = F.broadcast(rates)
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")))
    rates = rates.select(F.col("source").alias("rate_source"), F.col("rate").alias("mix_rate"))
    kept = [name for name in documents.columns if name not in {"mix_copies", "mix_copy", "mix_rate", "mix_key", "rate_source"}]
    drawn = (
        documents.select(*kept).join(rates, F.col("source").eqNullSafe(F.col("rate_source"))).drop("rate_source")
        .withColumn("mix_copies", copies_drawn(seed, own, F.col("mix_rate"), small[1] or 0.0)))
    copies = drawn.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    keyed = copies.withColumn("mix_key", unit(F.lit(seed), F.lit("order"), own, F.col("mix_copy")))
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(partitions, "mix_key").sortWithinPartitions("mix_key")
