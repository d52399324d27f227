"""Mixing sources to target weights by a temperature, realised as budgeted permutations of blocks."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartspark.llm.common import SPACE, numbered, whole
from chartspark.sources.storage import materialise

#: Blocks of a source: the first three hexadecimal digits of a hash of the document's key.
BLOCK_DIGITS = 3
#: Points of the exponent tried in one pass over the sources: 15 points are four steps of bisection.
POINTS = 15
ROUNDS = 10
#: The exponent is rounded up to so many decimals, which keeps a repetition limit.
DECIMALS = 6


def words(text: Column) -> Column:
    """Number of words (runs of other characters than white space), which stand for tokens; 0 for NULL."""
    return F.size(F.regexp_extract_all(whole(text), F.lit(f"([^{SPACE}]+)"), F.lit(1))).cast("long")


def source_name(source: Column) -> Column:
    """A text that is different for NULL and any source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def block_of(key: Column, seed: str) -> Column:
    key = F.coalesce(key.cast("string"), F.lit(""))
    return F.substring(F.md5(F.concat(F.lit(seed + "|"), key).cast("binary")), 1, BLOCK_DIGITS)


def temperature(
    totals: DataFrame, max_repeats: float | None = None, entropy: float | None = None, budget: float | None = None
) -> tuple[float, float]:
    """The exponent, and the number of tokens drawn.

    Sources are weighted by their token share to the power of the exponent, from 1 (as they are) to 0 (all alike). With
    ``max_repeats`` the exponent is the smallest one at which no source is drawn more often than that; with ``entropy``
    (in nats) the largest one at which the weights have that entropy; both are met if both are given, the limit first.
    Out of reach, it is 1 or 0. ``budget`` is the number of tokens to draw; without it, as many as it takes to draw
    every source once in full, so that no document is left out.

    Entropy falls and repetition falls as the exponent rises, so both are found by bisection. A pass over the sources
    tries ``POINTS`` exponents and returns their sums in one row; nothing else reaches the driver.
    """
    shares = totals.filter("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    facts = shares.agg(F.sum("t").alias("all"), F.min("t").alias("least"), F.max("t").alias("most")).first()
    if facts["all"] is None:
        return 1.0, 0.0
    all_, least, most = facts["all"], facts["least"] / facts["all"], facts["most"] / facts["all"]

    def sums(points):
        p = F.col("t") / F.lit(all_)
        columns = [F.sum(F.pow(p, F.lit(a))) for a in points] + [F.sum(F.pow(p, F.lit(a)) * F.log(p)) for a in points]
        row = shares.agg(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()
        return list(zip(points, row[: len(points)], row[len(points) :]))

    def drawn(a, z):
        return budget if budget is not None else all_ * z * most ** (1 - a)

    def bisect(enough):
        """The least exponent for which ``enough`` holds, if it holds from somewhere on."""
        low, high = 0.0, 1.0
        if enough(*sums([0.0])[0]):
            return 0.0
        for _ in range(ROUNDS):
            step = (high - low) / (POINTS + 1)
            tried = sums([low + step * (i + 1) for i in range(POINTS)])
            good = [a for a, z, h in tried if enough(a, z, h)]
            high = min(good, default=high)
            low = max((a for a, _, _ in tried if a < high), default=low)
        return high

    def up(a):
        return min(1.0, math.ceil(a * 10**DECIMALS - 1e-4) / 10**DECIMALS)

    exponent = 0.0
    if entropy is not None:
        exponent = max(exponent, up(bisect(lambda a, z, h: math.log(z) - a * h / z <= entropy)))
    if max_repeats is not None:
        limit = math.log(max_repeats) + 1e-12
        exponent = max(
            exponent, up(bisect(lambda a, z, h: math.log(drawn(a, z) / (z * all_)) + (a - 1) * math.log(least) <= limit))
        )
    return exponent, drawn(exponent, sums([exponent])[0][1])


def facts_of(docs: DataFrame, key: str, source: str, text: str, seed: str) -> DataFrame:
    """(row, key, source, name, block, tokens)."""
    return materialise(
        numbered(
            docs,
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            source_name(F.col(source)).alias("name"),
            block_of(F.col(key), seed).alias("block"),
            words(F.col(text)).alias("tokens"),
        )
    )


def block_plan(facts: DataFrame, seed: str, max_repeats=2.0, entropy=None, budget=None) -> DataFrame:
    """(name, block, pass, place, slot): which blocks of which source are drawn, in which pass and where.

    A source whose share of the budget is e times its tokens is drawn floor(e) times in full; the rest is filled with
    blocks in the order of one more permutation, as long as they fit. Every pass has a permutation of its own: the
    blocks in the order of the hash of seed, source, pass and block. ``place`` counts the source's tokens drawn before
    the block, ``slot`` is that as a share of the source's quota: reading all sources in the order of slot keeps their
    proportions all along.
    """
    blocks = materialise(facts.groupBy("name", "block").agg(F.sum("tokens").alias("tokens")))
    totals = blocks.groupBy("name").agg(F.sum("tokens").alias("tokens"))
    exponent, drawn = temperature(totals, max_repeats, entropy, budget)
    all_, z = totals.filter("tokens > 0").agg(
        F.sum("tokens").cast("double").alias("all"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(exponent))).alias("z")
    ).first()
    share = F.pow(F.col("tokens").cast("double"), F.lit(exponent - 1)) * F.lit(drawn / z if z else 1.0)
    quotas = (
        totals.withColumn("repeats", F.when(F.col("tokens") > 0, share).otherwise(1.0))
        .withColumn("whole", F.floor(F.col("repeats") + 1e-9))
        .select(
            "name",
            F.col("tokens").alias("total"),
            "whole",
            F.greatest(F.floor((F.col("repeats") - F.col("whole")) * F.col("tokens")), F.lit(0)).alias("rest"),
        )
    )
    permuted = F.md5(F.concat_ws("|", F.lit(seed), "name", F.col("pass").cast("string"), "block").cast("binary"))
    order = Window.partitionBy("name", "pass").orderBy("permuted", "block")
    passes = (
        blocks.join(quotas, "name")
        .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), "whole")))
        .withColumn("permuted", permuted)
        .withColumn("upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    quota = F.greatest(F.col("whole") * F.col("total") + F.col("rest"), F.lit(1))
    place = F.col("pass") * F.col("total") + F.col("upto") - F.col("tokens")
    return passes.filter((F.col("pass") < F.col("whole")) | ((F.col("rest") > 0) & (F.col("upto") <= F.col("rest")))).select(
        "name", "block", F.col("pass").cast("int").alias("pass"), place.alias("place"), (place / quota).alias("slot")
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    max_repeats: float | None = 2.0,
    entropy: float | None = None,
    budget: float | None = None,
    seed: str = "mix",
) -> DataFrame:
    """The documents drawn, a row for each time: row, key, source, tokens, pass, block, place, slot.

    See :func:`temperature` for the weights and :func:`block_plan` for the draws. A source holds at most 16 ** 3 blocks
    whatever its size, so the windows over blocks are bounded, and a source with a third of all rows is dealt out by
    (source, block). NULL is a source of its own. Documents without words cost nothing and come with their block; a
    source without any words is drawn once. Repeated keys share a block and are drawn alike. An empty table gives an
    empty result.
    """
    facts = facts_of(docs, key, source, text, seed)
    plan = block_plan(facts, seed, max_repeats, entropy, budget)
    return facts.join(plan, ["name", "block"]).select(
        "row", "key", "source", "tokens", "pass", "block", "place", "slot"
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix", **limits):
    """The rows of ``docs`` as often as :func:`mix` draws them, with the columns of ``docs``."""
    plan = block_plan(facts_of(docs, key, source, text, seed), seed, **limits).select(
        F.col("name").alias("_name_"), F.col("block").alias("_block_")
    )
    own = [F.col(c) for c in docs.columns]
    placed = docs.select(
        F.struct(*own).alias("_doc_"), source_name(F.col(source)).alias("_name_"), block_of(F.col(key), seed).alias("_block_")
    )
    return placed.join(plan, ["_name_", "_block_"]).select("_doc_.*")
