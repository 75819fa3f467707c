"""Mixing sources to target weights by temperature.

A source's share p is its part of all tokens (words `[^\\x20\\x09-\\x0D]+`). Weights are p ** a, normalised.
The exponent a in [0, 1] is found by bisection: 1 keeps the shares, 0 makes all sources equal.

* `max_repeats`: the smallest a (flattest mix) for which no source is repeated more than that often when
  every document of every source is taken at least once;
* `target_entropy` (nats): the a whose weights have that entropy, as near as the sources allow.

The budget defaults to the smallest that takes every document at least once; a smaller or larger budget
may be given. A source's budget is its weight of the total, rounded. It is realised as permutations: in
epoch e = 0, 1, ... documents are ordered by the md5 of seed, epoch and id. Its first digits name a
block; blocks are taken in order while the budget lasts, and only the last block is cut by document.
A document is taken if less than the budget stands before it in its epoch, so the last one may overrun.
Running sums are of blocks first and then within each block, so no task orders a whole source; the
number of blocks follows the number of documents.

Nulls: a null source is a source of its own, reported as null; a null text has no tokens; a null id
counts as the id ''. Documents without tokens are taken in each epoch that is complete or reaches them.
Rows that repeat an id are ordered by text. Sources without any tokens are taken once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm.common import stored, whole

MAX_REPEATS = 2.0
STEPS = 40
SEED = 11
BLOCK_ROWS = 2000


def token_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_totals(docs: DataFrame) -> DataFrame:
    """(source, total, n_docs): one row per source, pre-aggregated before the shuffle."""
    return docs.groupBy("source").agg(F.sum("n_tokens").alias("total"), F.count("*").alias("n_docs"))


def _measures(shares: DataFrame, a: float) -> tuple[float, float]:
    """(entropy of the weights, largest number of repeats) for exponent a; sums over the source table."""
    w = F.pow("p", F.lit(a))
    row = shares.agg(F.sum(w), F.sum(w * F.log(w)), F.max(w / F.col("p")), F.min(w / F.col("p"))).first()
    z, wlogw, most, least = row
    entropy = 0.0 if not z else float(_ln(z) - wlogw / z)
    return entropy, 1.0 if not z else most / least


def _ln(x: float) -> float:
    import math

    return math.log(x)


def exponent(shares: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, steps: int = STEPS) -> float:
    """Bisection of the exponent; each step is one sum over the table of sources (source, p)."""

    def too_flat(a: float) -> bool:
        entropy, repeats = _measures(shares, a)
        return entropy > target_entropy if target_entropy is not None else repeats > max_repeats

    if not too_flat(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def plan(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, budget: int | None = None, steps: int = STEPS) -> DataFrame:
    """(source, total, n_docs, weight, budget) from docs with source and n_tokens."""
    totals = stored(source_totals(docs))
    everything = totals.agg(F.sum("total")).first()[0] or 0
    shares = stored(totals.where("total > 0").select("source", (F.col("total") / F.lit(float(everything or 1))).alias("p")))
    a = exponent(shares, max_repeats, target_entropy, steps)
    row = shares.agg(F.sum(F.pow("p", F.lit(a))), F.max(F.pow("p", F.lit(1 - a)))).first()
    z, cover = (row[0] or 1.0), (row[1] or 1.0)
    factor = cover if budget is None else budget / everything / z if everything else 0.0
    p = F.col("total") / F.lit(float(everything or 1))
    w = F.when(F.col("total") > 0, F.pow(p, F.lit(a)))
    own = F.round(w * F.lit(factor) * F.lit(float(everything))).cast("long")
    out = totals.withColumn("weight", F.coalesce(w / F.lit(z), F.lit(0.0)))
    return out.withColumn("budget", F.coalesce(own, F.lit(0)))


def realise(docs: DataFrame, plan: DataFrame, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """docs (with source, doc_id, text and n_tokens) taken by the plan: columns epoch and ahead are added.

    ahead is the number of tokens of the same source and epoch that stand before the document.
    """
    plan = plan.select(F.col("source").alias("_source"), "total", "n_docs", "budget")
    joined = docs.join(plan, docs["source"].eqNullSafe(F.col("_source")))
    epochs = F.when(F.col("total") > 0, F.ceil(F.col("budget") / F.col("total"))).otherwise(F.lit(1))
    copies = joined.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(epochs, F.lit(1)).cast("int") - 1)))
    left = F.when(F.col("total") > 0, F.col("budget") - F.col("epoch") * F.col("total")).otherwise(F.lit(1))
    full = copies.withColumn("_left", left).withColumn("_whole", F.col("_left") >= F.col("total"))
    # A complete epoch takes all of a source's documents: no order is needed to decide, only for `ahead`.
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    blocks = F.greatest(F.ceil(F.col("n_docs") / F.lit(block_rows)), F.lit(1)).cast("long")
    keyed = full.withColumn("_key", key).withColumn("_block", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * blocks / F.lit(float(1 << 32))).cast("long"))
    group = ["_source", "epoch"]
    sums = keyed.groupBy(*group, "_block").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    sums = sums.select(F.col("_source").alias("_s"), F.col("epoch").alias("_e"), F.col("_block").alias("_b"), "_before")
    same = keyed["_source"].eqNullSafe(F.col("_s")) & (keyed["epoch"] == F.col("_e")) & (keyed["_block"] == F.col("_b"))
    placed = keyed.join(sums, same)
    inside = Window.partitionBy(*group, "_block").orderBy("_key", "_text_key").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return placed.withColumn("ahead", ahead).where("ahead < _left or _whole").drop("_source", "total", "n_docs", "budget", "_left", "_whole", "_key", "_block", "_s", "_e", "_b", "_before")


def mix(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, budget: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(order, plan): order has doc_id, source, n_tokens, epoch, ahead and _text_key of every taken copy."""
    rows = docs.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens"), F.xxhash64(whole(F.col("text"))).alias("_text_key"))
    rows = stored(rows)
    weights = stored(plan(rows, max_repeats, target_entropy, budget))
    return realise(rows, weights, seed), weights
