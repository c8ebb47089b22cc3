"""Quantile thresholds over a whole column, exact or approximate.

``method="exact"`` returns, for each probability ``p``, the element of rank
``max(1, ceil(p * N))`` among the ``N`` non-NULL values (a discrete quantile:
always an actual value).  Two scans find it, and a histogram search follows
where they haven't:

1. one aggregate gives count, min, max and a KLL sketch per value expression.
   On more than ``FAN`` cores sketches are merged in two levels, ``FAN`` groups
   of tasks first, so no task merges those of all others.  The sketch's values around ``p``, as far as its
   rank error goes, bracket the answer;
2. a round cuts each target's bracket [lo, hi] into ``bins`` of equal width and
   counts (bin, rows, min, max), and what lies below the bracket, with one
   ``groupBy``: map-side combine leaves at most ``bins`` rows per task and
   bracket, and the driver reads at most ``bins`` rows per bracket, whatever
   the input's size.  The counts are exact, so they also tell when a sketch has
   missed; the side that it missed is the next bracket then;
3. the bin that holds the rank gives the next bracket, its own min..max.

A bracket's min and max always fall in different bins, so every round parts
values and the search ends when a bracket is one value.  Targets with the same
expression and bracket share a histogram.  Each round scans the input again,
so pass a materialised (written or checkpointed) frame.  NaN is not a value.

``method="approx"`` is plain ``percentile_approx`` (lazy, one pass).  Its
memory per task grows with ``accuracy``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000
DEFAULT_BINS = 4096
SKETCH_K = 1024  # size of a sketch: about 10 KB
FAN = 64

Specs = Mapping[str, tuple[Column, Sequence[float]]]


def _rank(p: float, n: int) -> int:
    return min(n, max(1, math.ceil(p * n)))


def _bin(v: Column, lo: float, hi: float, bins: int) -> Column:
    """0 .. bins - 1 over [lo, hi]; lo falls in the first bin, hi in the last."""
    if math.isinf(lo) or math.isinf(hi):
        return F.when(v == lo, 0).when(v == hi, bins - 1).otherwise(bins // 2)
    half = 0.5 if math.isinf(hi - lo) else 1.0  # a span beyond the largest double
    share = (v * half - F.lit(lo * half)) / F.lit(hi * half - lo * half)
    at = F.floor(share * bins).cast("int")
    return F.when(v == lo, 0).when(v == hi, bins - 1).otherwise(F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)))


def sketch_error(k: int) -> float:
    """Rank error of a KLL sketch of size ``k`` that 99 in 100 sketches keep (the sketch's published fit)."""
    return 2.296 / k**0.9723


def sketch_brackets(src: DataFrame, probs: Sequence[Sequence[float]], k: int, error: float, fan: int | None = None):
    """One row: per column ``v<i>`` count (n), min (lo), max (hi) and the sketch's values ``error`` below and above each of ``probs[i]``."""
    at = range(len(probs))
    names = [f"v{i}" for i in at]
    counts = [f(v).alias(f"{c}_{v}") for v in names for c, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    sketches = [F.kll_sketch_agg_double(v, F.lit(k)).alias(f"s_{v}") for v in names]
    if fan is None:
        fan = FAN if src.sparkSession.sparkContext.defaultParallelism > FAN else 1
    if fan > 1:
        parts = src.groupBy(F.pmod(F.spark_partition_id(), F.lit(fan)).alias("g")).agg(*counts, *sketches)
        sums = [f(f"{c}_{v}").alias(f"{c}_{v}") for v in names for c, f in (("n", F.sum), ("lo", F.min), ("hi", F.max))]
        merged = parts.agg(*sums, *[F.kll_merge_agg_double(F.when(F.col(f"n_{v}") > 0, F.col(f"s_{v}"))).alias(f"s_{v}") for v in names])
    else:
        merged = src.agg(*counts, *sketches)
    out = [F.coalesce(f"n_v{i}", F.lit(0)).alias(f"n{i}") for i in at] + [F.col(f"{c}_v{i}").alias(f"{c}{i}") for i in at for c in ("lo", "hi")]
    for i in at:
        for name, shift in (("below", -error), ("above", error)):
            ranks = F.array(*[F.lit(min(1.0, max(0.0, float(p) + shift))) for p in probs[i]])
            out.append(F.when(F.col(f"n_v{i}") > 0, F.kll_sketch_get_quantile_double(f"s_v{i}", ranks)).alias(f"{name}{i}"))
    return merged.select(*out).first()


def exact_quantiles(df: DataFrame, specs: Specs, bins: int = DEFAULT_BINS, k: int = SKETCH_K, error: float | None = None) -> dict[str, list[float | None]]:
    """Exact discrete quantiles for several value expressions at once."""
    names = list(specs)
    values = [F.nanvl(specs[n][0].cast("double"), F.lit(None).cast("double")) for n in names]
    src = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    probs = [[float(p) for p in specs[n][1]] for n in names]
    first = sketch_brackets(src, probs, k, 1.5 * sketch_error(k) if error is None else error)

    answers: dict[tuple[int, int], float | None] = {}
    # bracket -> its targets: (target, rank inside, or among all values in the first round)
    todo: dict[tuple[int, float, float], list[tuple[tuple[int, int], int]]] = {}

    def place(i: int, lo: float, hi: float, target: tuple[int, int], rank: int) -> None:
        if lo == hi:
            answers[target] = lo
        else:
            todo.setdefault((i, lo, hi), []).append((target, rank))

    for i in range(len(names)):
        n, least, most = (first[f"{c}{i}"] for c in ("n", "lo", "hi"))
        for j, p in enumerate(probs[i]):
            if n == 0:
                answers[i, j] = None
            elif least == most:
                answers[i, j] = least
            else:  # the least and the largest values are exact; a sketch needn't hold them
                lo = least if p <= sketch_error(k) else first[f"below{i}"][j]
                hi = most if p >= 1 - sketch_error(k) else first[f"above{i}"][j]
                todo.setdefault((i, lo, hi), []).append(((i, j), _rank(p, n)))
    whole = True  # ranks are among all values, so what lies below a bracket is counted too
    while todo:
        brackets, todo = list(todo.items()), {}
        hits = []
        for b, ((i, lo, hi), _) in enumerate(brackets):
            v = F.col(f"v{i}")
            hit = F.when(v.between(lo, hi), F.struct(F.lit(b).alias("b"), _bin(v, lo, hi, bins).alias("k"), v.alias("v")))
            hits.append(hit.when(v < lo, F.struct(F.lit(b).alias("b"), F.lit(-1).alias("k"), v.alias("v"))) if whole else hit)
        rows = (
            src.select(F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("x"))
            .groupBy("x.b", "x.k")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
            .collect()
        )
        rows.sort(key=lambda r: (r["b"], r["k"]))
        for b, ((i, _, hi), targets) in enumerate(brackets):
            mine = [r for r in rows if r["b"] == b]
            for target, rank in targets:
                for r in mine:
                    if rank <= r["n"]:
                        place(i, r["lo"], r["hi"], target, rank)
                        break
                    rank -= r["n"]
                else:  # beyond the bracket: the sketch's value was too small
                    place(i, math.nextafter(hi, math.inf), first[f"hi{i}"], target, rank)
        whole = False
    return {n: [answers[i, j] for j in range(len(specs[n][1]))] for i, n in enumerate(names)}


def quantile_thresholds(df: DataFrame, specs: Specs, method: str = "exact", accuracy: int | None = None) -> DataFrame:
    """A one-row frame with one ``array<double>`` column per spec.

    ``specs`` maps output name -> (value expression, probabilities); a
    conditional expression (``F.when(cond, x)``) restricts the input rows.
    The exact frame is an aggregate over ``df``: the search has found where
    each cut lies, the aggregate takes the value from the table.
    """
    if method == "approx":
        acc = accuracy or DEFAULT_ACCURACY
        return df.agg(
            *[F.percentile_approx(e.cast("double"), list(p), acc).alias(n) for n, (e, p) in specs.items()]
        )
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    found = exact_quantiles(df, specs)
    cuts = []
    for n, (e, _) in specs.items():
        v = e.cast("double")
        cuts.append(F.array(*[F.max(F.when(v == F.lit(x), v)) if x is not None else F.lit(None).cast("double") for x in found[n]]).alias(n))
    return df.agg(*cuts)


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every row of ``df`` plus the columns of a one-row frame.

    The one-row frame becomes a single scalar subquery (a struct of its
    columns): Spark runs it once, fails the query if it ever returns more
    than one row, and folds its value into the projection, so no join and no
    per-row work depends on the size of ``one_row``'s input.
    """
    cols = one_row.columns
    scalar = one_row.select(F.struct(*cols).alias("s")).scalar()
    out = df.select("*", scalar.alias("__scalars"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"__scalars.`{c}`").alias(c) for c in cols])
