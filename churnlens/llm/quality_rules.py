"""Quality rules learned as a decision list.

``text_statistics`` turns every whole text into counts and ratios with Spark
functions.  ``learn_rules`` runs sequential covering over a bounded sample of
labelled rows: grow a conjunction of threshold tests that covers low-quality
rows (FOIL gain), prune its last tests on rows held back, keep it if it is
precise there, drop what it covers, repeat.  ``Rule.condition`` emits the
conjunction as a Spark condition; ``verdict`` chains the rules in order into
one conditional expression.

The statistics of a growing step are one aggregate: bins of each statistic are
counted by label, so a step returns at most (statistics x bins) rows whatever
the sample's size, and running sums over the bins give the counts of every
threshold in both directions.

Defined cases: null or blank texts have no words; they fail the base rule
(fewer than 10 words).  Null labels and labels without a document are ignored;
contradicting labels of one doc_id are averaged (low quality if the mean is
under 0.5).  Without labelled rows no rule is learned and every text that
passes the base rule is kept.  Equal gains take the first statistic, then the
smaller threshold.  Repeated rows keep one output row each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from churnlens.llm.common import BLANK_RUN, bounded_sample, split_words, stored

#: Bound on the labelled rows used for fitting (smallest hashes of doc_id first).
MAX_LABELLED = 20_000
N_BINS = 16
MAX_TESTS = 4
MAX_RULES = 8
MIN_COVER = 8
MIN_PRECISION = 0.95

#: Statistics that rules may test; all are ratios, so they mean the same in short and long texts.
TESTED = (
    "symbol_share",
    "bar_share",
    "mark_share",
    "upper_share",
    "digit_share",
    "other_share",
    "mean_word",
    "mean_line",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
)

WINDOW = 5


def _count(text: Column, pattern: str) -> Column:
    """Number of characters of a class."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, the base counts and the tested ratios, one row per document.

    Each step is a projection of its own whose arrays the next refers to more
    than once, so Spark computes an array once per row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hit = F.lit(r"[^\x20\x09-\x0D]")
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(*keep, text.alias("t"), split_words(text).alias("w"), lines.alias("lines"))
    d = d.select(
        *keep,
        "t",
        "lines",
        F.size("w").cast("long").alias("n_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    # hash of the five-word window that starts at each word
    spans = F.transform(
        F.when(F.size("h") >= WINDOW, F.slice("h", F.lit(1), F.size("h") - (WINDOW - 1))).otherwise(F.array().cast("array<bigint>")),
        lambda x, i: F.xxhash64(x, *[F.get(F.col("h"), i + k) for k in range(1, WINDOW)]),
    )
    d = d.select(*keep, "t", "lines", "n_words", "n_distinct", spans.alias("g"))
    twice = F.size(F.array_distinct("g")) < F.size("g")
    ordered = F.when(twice, F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    d = d.select(*keep, "t", "lines", "n_words", "n_distinct", ordered.alias("o"))
    # starts of windows whose hash has an equal neighbour in hash order
    flagged = F.transform(
        "o",
        lambda e, k: F.when((F.get(F.col("o"), k - 1)["x"] == e["x"]) | (F.get(F.col("o"), k + 1)["x"] == e["x"]), e["i"]),
    )
    starts = F.sort_array(F.filter(flagged, lambda i: i.isNotNull()))
    d = d.select(*keep, "t", "lines", "n_words", "n_distinct", starts.alias("s"))
    covered = F.aggregate(
        F.transform("s", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("s"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    d = d.select(
        *keep,
        "n_words",
        "n_distinct",
        F.char_length(F.regexp_replace("t", BLANK_RUN, "")).cast("long").alias("word_chars"),
        _count(F.col("t"), r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _count(F.col("t"), r"\|").alias("n_bars"),
        _count(F.col("t"), r"[!?]").alias("n_marks"),
        _count(F.col("t"), r"\p{Lu}").alias("n_upper"),
        _count(F.col("t"), r"[0-9]").alias("n_digits"),
        _count(F.col("t"), r"[^\p{L}\p{M}0-9\x20\x09-\x0D.,;:!?'\"()#*$%&|<>-]").alias("n_other"),
    )
    stats = F.struct(
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ratio(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        ratio(F.col("n_bars"), F.col("n_words")).alias("bar_share"),
        ratio(F.col("n_marks"), F.col("word_chars")).alias("mark_share"),
        ratio(F.col("n_upper"), F.col("word_chars")).alias("upper_share"),
        ratio(F.col("n_digits"), F.col("word_chars")).alias("digit_share"),
        ratio(F.col("n_other"), F.col("word_chars")).alias("other_share"),
        ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word"),
        ratio(F.col("n_words"), F.col("n_lines")).alias("mean_line"),
        ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        ratio(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"),
        ratio(F.col("n_distinct"), F.col("n_words")).alias("distinct_share"),
    )
    # A one-element generator: Spark pushes a filter on a statistic through plain
    # projections by repeating their expressions, here down to the word split.
    return d.select(*keep, F.inline(F.array(stats)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


@dataclass(frozen=True)
class Test:
    stat: str
    above: bool
    bound: float

    def condition(self) -> Column:
        c = F.col(self.stat)
        return c > self.bound if self.above else c <= self.bound

    def __str__(self) -> str:
        return f"{self.stat} {'>' if self.above else '<='} {self.bound:.6g}"


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]

    def condition(self) -> Column:
        out = F.lit(True)
        for t in self.tests:
            out = out & t.condition()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests))


def _labelled(stats: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    lab = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("low"))
    # the bounded choice is made among label ids, before the join with the statistics
    lab = bounded_sample(lab, "doc_id", bound)
    rows = stats.where(~base_failed()).join(lab, "doc_id")
    return rows.select(*TESTED, "low", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0).alias("held"))


def _counts(rows: DataFrame, edges: dict[str, list[float]]) -> dict[str, list[Row]]:
    """Per statistic: bin, counts by label, smallest and largest value.

    One job; the rows that come back are bounded by statistics x bins.
    """
    bins = []
    for s in TESTED:
        at = F.lit(0)
        for e in edges[s]:
            at = at + (F.col(s) > e).cast("int")
        bins.append(F.struct(F.lit(s).alias("stat"), at.alias("bin"), F.col(s).alias("v")))
    got = (
        rows.select("low", F.explode(F.array(*bins)).alias("b"))
        .groupBy("b.stat", "b.bin")
        .agg(F.count_if("low").alias("low"), F.count_if(~F.col("low")).alias("other"), F.min("b.v").alias("least"), F.max("b.v").alias("most"))
        .collect()
    )
    out: dict[str, list[Row]] = {s: [] for s in TESTED}
    for r in sorted(got, key=lambda r: (r["stat"], r["bin"])):
        out[r["stat"]].append(r)
    return out


def _best_test(counts: dict[str, list[Row]], p0: int, n0: int) -> Test | None:
    """The test with the largest FOIL gain; its bound lies halfway between the values that it parts."""
    base = math.log2(p0 / (p0 + n0))
    best = None
    for s in TESTED:
        low = other = 0
        for r, above_r in zip(counts[s], counts[s][1:]):
            low, other = low + r["low"], other + r["other"]
            for above, p, n in ((False, low, other), (True, p0 - low, n0 - other)):
                if p >= MIN_COVER:
                    gain = p * (math.log2(p / (p + n)) - base)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, Test(s, above, (r["most"] + above_r["least"]) / 2))
    return best and best[1]


def learn_rules(labelled: DataFrame, min_precision: float = MIN_PRECISION) -> list[Rule]:
    """Ordered rules for low quality, from rows with the tested statistics, ``low`` and ``held``."""
    rows = stored(labelled, "quality-labelled")
    qs = [k / N_BINS for k in range(1, N_BINS)] + [0.97, 0.99]
    quant = [F.percentile_approx(F.when(F.col("low") == side, F.col(s)), qs).alias(f"{s}_{side}") for s in TESTED for side in (True, False)]
    row = rows.agg(*quant).first()
    # bins end at quantiles of either class
    edges = {s: sorted({float(v) for side in (True, False) for v in (row[f"{s}_{side}"] or [])}) for s in TESTED}
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        grow, tests = left.where("NOT held"), []
        while len(tests) < MAX_TESTS:
            counts = _counts(grow, edges)
            p0, n0 = (sum(r[k] for r in counts[TESTED[0]]) for k in ("low", "other"))
            if p0 < MIN_COVER or n0 == 0:
                break
            best = _best_test(counts, p0, n0)
            if best is None:
                break
            tests.append(best)
            grow = grow.where(best.condition())
        if not tests:
            break
        # prune: the prefix of the tests that separates the held rows best
        prefixes = [Rule(tuple(tests[: k + 1])) for k in range(len(tests))]
        sums = []
        for k, r in enumerate(prefixes):
            sums += [F.coalesce(F.sum((r.condition() & (F.col("low") == side)).cast("long")), F.lit(0)).alias(f"{'p' if side else 'n'}{k}") for side in (True, False)]
        got = left.where("held").agg(*sums).first()
        score = [((got[f"p{k}"] - got[f"n{k}"]) / max(1, got[f"p{k}"] + got[f"n{k}"]), k) for k in range(len(prefixes))]
        k = max(score, key=lambda x: (x[0], -x[1]))[1]
        p, n = got[f"p{k}"], got[f"n{k}"]
        if p == 0 or p / (p + n) < min_precision:
            break
        rules.append(prefixes[k])
        left = left.where(~prefixes[k].condition())
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Ordered conditional: the name of the first rule that rejects a row, null if none does."""
    out = F.when(F.lit(False), F.lit(""))
    for k, r in enumerate(rules):
        out = out.when(r.condition(), F.lit(f"{k + 1}: {r}"))
    return out.otherwise(F.lit(None).cast("string"))


def judge(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, list[Rule]]:
    """Statistics of every document with base_failed, the rejecting rule and kept; and the learned rules."""
    stats = stored(text_statistics(docs, "doc_id"), "quality-stats")
    rules = learn_rules(_labelled(stats, labels, max_labelled))
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    judged, _ = judge(docs, labels)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base rule and every learned rule, all columns as they came.

    The rules are fitted on statistics of the labelled documents only; the
    filter computes the statistics of every row beside its own columns, so no
    text is shuffled.
    """
    lab = bounded_sample(labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id").distinct(), "doc_id", MAX_LABELLED)
    some = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id", "left_semi")  # MAX_LABELLED ids bound the broadcast
    stats = stored(text_statistics(some, "doc_id"), "quality-stats")
    rules = learn_rules(_labelled(stats, labels, MAX_LABELLED))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = text_statistics(docs.select(row, F.col("text")), "row")
    return judged.where(~base_failed() & verdict(rules).isNull()).select("row.*")
