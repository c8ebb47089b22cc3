"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power ``alpha``, normalised:
alpha 1 keeps the shares, alpha 0 makes all sources equal.  ``fit_alpha``
bisects alpha to the target entropy (nats) or to the smallest alpha whose
most repeated source stays within the repetition limit; with both targets the
larger alpha wins, so the limit holds.  Each bisection round evaluates
``PROBES`` values at once in one aggregate over the source table.

The weights are realised as budgeted block permutations.  A row belongs to a
block of its source by hash.  A source's budget (weight x total budget) is
whole epochs plus a rest; every epoch passes the source's blocks in its own
hash permutation, and the last epoch stops where the rest is used up, inside
a block at a hash cut.  Only blocks (about ``BLOCK_TOKENS`` tokens of all
sources together) are put in order per source; rows are ordered only inside
the one block per source where the budget ends.  A source with a third of all
rows is spread over all blocks in every join.

The default budget is the smallest that passes every source at least once, so
nothing is dropped and small sources are repeated.

Defined cases: rows with a null source form a source of their own; null and
blank texts have no tokens, cost nothing and come with every whole epoch;
rows of equal doc_id and text have equal hashes and are taken or left
together; without any token every row comes once; an empty table gives none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from churnlens.llm.common import fresh, stored

BLOCK_TOKENS = 1 << 20
MIN_BLOCKS = 16
PROBES = 16
ROUNDS = 6
#: Of the registered query: a source is passed at most this many times.
MAX_REPEATS = 1.5
SEED = 11


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _keyed(docs: DataFrame) -> list[Column]:
    """source key and permutation hash of a row."""
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source").cast("string"))).alias("mix_key")
    return [key, F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text")).alias("mix_hash")]


def fit_alpha(sources: DataFrame, total: int, budget: float | None, entropy: float | None, max_repeats: float | None) -> float:
    """The exponent; ``sources`` has a column tokens (> 0) per source."""
    p = F.col("tokens") / F.lit(float(total))

    def measures(alphas: list[float]) -> list[tuple[float, float]]:
        """(entropy, repetitions of the most repeated source) of each alpha, in one job."""
        aggs = []
        for i, a in enumerate(alphas):
            w = F.pow(p, F.lit(a))
            aggs += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log(p)).alias(f"s{i}"), F.max(w / p).alias(f"m{i}"), F.min(w / p).alias(f"l{i}")]
        r = sources.agg(*aggs).first()
        out = []
        for i, a in enumerate(alphas):
            z = r[f"z{i}"]
            most = r[f"m{i}"] / r[f"l{i}"] if budget is None else r[f"m{i}"] / z * budget / total
            out.append((math.log(z) - a * r[f"s{i}"] / z, most))
        return out

    def bisect(fits) -> float:
        """Smallest alpha in [0, 1] from which ``fits`` holds (it holds upwards); 1 if it never does."""
        low, high = 0.0, 1.0
        if fits(measures([0.0])[0]):
            return 0.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * k / (PROBES + 1) for k in range(1, PROBES + 1)]
            good = [fits(m) for m in measures(grid)]
            first = good.index(True) if True in good else PROBES
            low, high = (grid[first - 1] if first else low), (grid[first] if first < PROBES else high)
        return high

    wanted = [1.0] if entropy is None and max_repeats is None else []
    if entropy is not None:
        wanted.append(bisect(lambda m: m[0] <= entropy))
    if max_repeats is not None:
        wanted.append(bisect(lambda m: m[1] <= max_repeats))
    return max(wanted)


@dataclass
class Mixture:
    alpha: float
    budget: float
    blocks: int
    #: mix_key, mix_block, n (tokens), whole (epochs), cut (largest hash taken in the last epoch, null: none)
    plan: DataFrame
    #: mix_key, tokens, weight, whole, rest
    sources: DataFrame


def plan_mixture(
    rows: DataFrame, budget: float | None = None, entropy: float | None = None, max_repeats: float | None = None, block_tokens: int = BLOCK_TOKENS
) -> Mixture:
    """The plan for ``rows`` (mix_key, mix_hash, tokens); rows must be cheap to read twice."""
    sources = stored(rows.groupBy("mix_key").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    blocks = max(MIN_BLOCKS, -(-total // block_tokens))
    some = sources.where("tokens > 0")
    alpha = fit_alpha(some, total, budget, entropy, max_repeats) if total else 1.0
    w = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(alpha))
    z, need = some.agg(F.sum(w), F.max(F.col("tokens") / w)).first()
    if budget is None:  # of the smallest budget that passes every source once
        budget = z * need if total else 0.0
    share = F.when(F.col("tokens") > 0, w / F.lit(z or 1.0)).otherwise(0.0)
    goal = share * F.lit(float(budget))
    # within rounding, a whole number of epochs is one
    whole = F.when(F.col("tokens") > 0, F.floor(goal / F.col("tokens") + 1e-9)).otherwise(1).cast("long")
    rest = goal - whole * F.col("tokens")
    sources = sources.select("mix_key", "tokens", share.alias("weight"), whole.alias("whole"), F.when(rest >= 0.5, rest).otherwise(0.0).alias("rest"))
    block = F.pmod(F.col("mix_hash"), F.lit(blocks)).alias("mix_block")
    per = rows.groupBy("mix_key", block).agg(F.sum("tokens").alias("n"))
    per = per.join(sources.select("mix_key", "whole", "rest"), "mix_key")
    order = [F.xxhash64(F.lit(SEED), F.col("whole"), F.col("mix_block")), F.col("mix_block")]
    upto = F.sum("n").over(Window.partitionBy("mix_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    per = stored(per.withColumn("left", F.col("rest") - (upto - F.col("n"))), "mix-blocks")
    # the one block per source where the rest ends: rows in hash order while they fit
    ends = per.where("left > 0 AND left < n").select("mix_key", "mix_block", "left")
    inside = rows.withColumn("mix_block", block).join(ends, ["mix_key", "mix_block"])
    used = F.sum("tokens").over(Window.partitionBy("mix_key", "mix_block").orderBy("mix_hash"))
    cut = inside.withColumn("used", used).where("used <= left").groupBy("mix_key", "mix_block").agg(F.max("mix_hash").alias("at"))
    top = F.lit((1 << 63) - 1)
    plan = per.join(cut, ["mix_key", "mix_block"], "left").select(
        "mix_key", "mix_block", "n", "whole", F.when((F.col("left") >= F.col("n")) & (F.col("left") > 0), top).otherwise(F.col("at")).alias("cut")
    )
    return Mixture(alpha, budget, blocks, stored(plan, "mix-plan"), sources)


def _passes(rows: DataFrame, m: Mixture) -> DataFrame:
    """``rows`` (with mix_key and mix_hash) once per epoch that takes them, with mix_block and epoch."""
    rows = rows.withColumn("mix_block", F.pmod(F.col("mix_hash"), F.lit(m.blocks)))
    j = rows.join(m.plan.select("mix_key", "mix_block", "whole", "cut"), ["mix_key", "mix_block"])
    n = F.col("whole") + F.coalesce((F.col("mix_hash") <= F.col("cut")).cast("long"), F.lit(0))
    return j.withColumn("epoch", F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>")))).drop("whole", "cut")


def mixture_schedule(docs: DataFrame, **targets) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, block_rank (place of the block in its source's epoch), row_hash.

    Reading a source by (epoch, block_rank, row_hash) passes it in its permuted order.
    """
    rows = stored(docs.select("doc_id", "source", *_keyed(docs), count_tokens(F.col("text")).alias("tokens")), "mix-rows")
    m = plan_mixture(rows, **targets)
    passes = _passes(rows, m)
    epochs = m.plan.select("mix_key", "mix_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))).alias("epoch"))
    turn = [F.xxhash64(F.lit(SEED), F.col("epoch"), F.col("mix_block")), F.col("mix_block")]
    rank = epochs.withColumn("block_rank", F.row_number().over(Window.partitionBy("mix_key", "epoch").orderBy(*turn)))
    out = passes.join(rank, ["mix_key", "mix_block", "epoch"])
    return out.select(
        "doc_id", "source", F.col("tokens").alias("n_tokens"), "epoch", F.col("mix_block").alias("block"), "block_rank", F.col("mix_hash").alias("row_hash")
    )


def mix_documents(docs: DataFrame, **targets) -> DataFrame:
    """``docs`` with every row as often as the mixture passes it, columns as they came."""
    rows = stored(docs.select(*_keyed(docs), count_tokens(F.col("text")).alias("tokens")), "mix-rows")
    m = plan_mixture(rows, **targets)
    whole = fresh(docs, "row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), *_keyed(docs))
    return _passes(packed, m).select(f"{whole}.*")
