"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; each model sees the text's
features and the log-odds that the chain gave the categories before it.  In
training these are out-of-fold predictions (``FOLDS`` folds by hash of doc_id),
so a later model learns from probabilities as unsure as they will be on new
texts.

The categories, in chain order:

* ``junk``: labelled quality 0,
* ``toxic``: labelled toxic 1,
* ``severe``: toxic, with a share of marker words (features of high toxic
  log-odds) at or above the median of the toxic sample.

Features are words and word beginnings (4 and 5 letters) of the lower-cased
text, log(1 + count); the ``FEATURES`` with the largest chi-square statistic
against the labels are used.  The models are fitted on a bounded sample: at
most ``PER_CLASS`` rows of each label combination, smallest hash of doc_id
first, weighted back to the frequency of their combination.  Scoring reads
every whole text in one pass without a shuffle.

Defined cases: null and empty texts have no features and get the models'
base rate; null labels, labels without a document and contradicting labels
(averaged, 0.5 counts as 1) don't fail; of rows that repeat a sampled doc_id the
text with the smallest hash is learned from; without toxic and non-toxic labels the
probabilities are 0 and nothing is flagged; equal statistics go by name;
repeated rows give equal rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from churnlens.llm.common import bounded_batches, bounded_sample, stored
from churnlens.llm.linear import Sparse, fit, logit, sigmoid

PER_CLASS = 3000
FEATURES = 1500
LEAST_DOCS = 3
FOLDS = 3
#: Memo of word -> features in a scoring task.
MEMO = 200_000
CATEGORIES = ("junk", "toxic", "severe")

_WORD = re.compile(r"[^\W\d_]+")


def names_of(word: str) -> list[str]:
    """Feature names of a word."""
    return [word, *(f"{word[:k]}*" for k in (4, 5) if len(word) >= k)]


def counted(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


@dataclass
class Chain:
    features: dict[str, int]
    #: per category: weights of the features, of the log-odds of earlier categories, bias
    weights: list[np.ndarray]
    #: least probability of a flagged text, per category
    bounds: list[float]


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    lab = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("junk"), (F.avg("toxic") >= 0.5).alias("toxic"))
    lab = lab.where("junk IS NOT NULL AND toxic IS NOT NULL")
    sizes = {(r["junk"], r["toxic"]): r["count"] for r in lab.groupBy("junk", "toxic").count().collect()}
    parts = None
    for (junk, toxic), n in sorted(sizes.items()):
        one = bounded_sample(lab.where((F.col("junk") == junk) & (F.col("toxic") == toxic)), "doc_id", per_class)
        one = one.withColumn("weight", F.lit(n / min(n, per_class)))
        parts = one if parts is None else parts.unionByName(one)
    if parts is None:
        return docs.select("doc_id", "text", F.lit(False).alias("junk"), F.lit(False).alias("toxic"), F.lit(1.0).alias("weight")).limit(0)
    # at most 4 x PER_CLASS ids, and one text of each
    rows = docs.select("doc_id", "text").join(F.broadcast(parts), "doc_id").withColumn("hashed", F.struct(F.xxhash64("text").alias("hash"), "text"))
    rows = rows.groupBy("doc_id", "junk", "toxic", "weight").agg(F.min("hashed").alias("hashed"))
    return rows.select("doc_id", "hashed.text", "junk", "toxic", "weight")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, documents, junk, toxic) summed over a task's rows."""
    seen: dict[str, list[int]] = {}
    for b in batches:
        for text, junk, toxic in zip(b["text"].to_pylist(), b["junk"].to_pylist(), b["toxic"].to_pylist()):
            for name in {n for w in counted(text) for n in names_of(w)}:
                c = seen.setdefault(name, [0, 0, 0])
                c[0] += 1
                c[1] += junk
                c[2] += toxic
    cols = list(zip(*seen.values())) if seen else [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *[pa.array(c, pa.int64()) for c in cols]], names=["name", "n", "junk", "toxic"])


def _chi(hit: str, total: int, of: int):
    """Chi-square of a feature against a label that ``of`` of ``total`` rows have."""
    a, n = F.col(hit).cast("double"), F.col("n").cast("double")
    want, rest = n * (of / total), n * (1 - of / total)
    return (a - want) ** 2 / want + (a - want) ** 2 / rest


def _choose(sample: DataFrame, size: int) -> dict[str, int]:
    total, junk, toxic = sample.agg(F.count("*"), F.count_if("junk"), F.count_if("toxic")).first()
    if not total:
        return {}
    counts = sample.select("text", "junk", "toxic").mapInArrow(_count_features, "name string, n bigint, junk bigint, toxic bigint")
    counts = counts.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("n", "junk", "toxic")]).where(F.col("n") >= LEAST_DOCS)
    value = F.greatest(*[_chi(c, total, of) for c, of in (("junk", junk), ("toxic", toxic)) if 0 < of < total], F.lit(0.0), F.lit(-1.0))
    rows = counts.orderBy(F.desc(value), "name").limit(size).select("name").collect()  # FEATURES names
    return {r["name"]: i for i, r in enumerate(rows)}


def _vector(text: str | None, known: dict[str, int], memo: dict[str, tuple[int, ...]]) -> tuple[dict[int, float], int]:
    """Feature values and number of words of a text."""
    words = counted(text)
    tally: dict[int, int] = {}
    for w, n in words.items():
        ids = memo.get(w)
        if ids is None:
            ids = tuple(known[x] for x in names_of(w) if x in known)
            if len(memo) >= MEMO:
                memo.clear()
            memo[w] = ids
        for i in ids:
            tally[i] = tally.get(i, 0) + n
    return {i: float(np.log1p(n)) for i, n in tally.items()}, sum(words.values())


def _bound(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best F1 of out-of-fold predictions (weighted), halfway to the next lower prediction."""
    order = np.argsort(-p, kind="stable")
    hit, all_ = np.cumsum((y * weight)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (all_ + (y * weight).sum())
    k = int(f1.argmax())
    q = p[order]
    return float((q[k] + q[k + 1]) / 2 if k + 1 < len(q) else q[k])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, size: int = FEATURES) -> Chain | None:
    bounded_batches(docs.sparkSession)
    sample = stored(_sample(docs, labels, per_class), "toxicity-sample")
    known = _choose(sample, size)
    if not known:
        return None

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, ...]] = {}
        for b in batches:
            got = [_vector(t, known, memo) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"],
                    b["junk"],
                    b["toxic"],
                    b["weight"],
                    pa.array([list(v) for v, _ in got], pa.list_(pa.int32())),
                    pa.array([list(v.values()) for v, _ in got], pa.list_(pa.float64())),
                    pa.array([n for _, n in got], pa.int64()),
                ],
                names=["doc_id", "junk", "toxic", "weight", "ids", "vals", "words"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(vectors, f"doc_id {kind}, junk boolean, toxic boolean, weight double, ids array<int>, vals array<double>, words bigint").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["ids"]))
    x = Sparse.of([dict(zip(r["ids"], r["vals"])) for r in rows], len(known))
    junk, toxic = (np.array([r[c] for r in rows], float) for c in ("junk", "toxic"))
    weight = np.array([r["weight"] for r in rows])
    if toxic.min() == toxic.max():
        return None
    fold = np.array([zlib.crc32(str(r["doc_id"]).encode()) % FOLDS for r in rows])
    # markers: features much more frequent in toxic rows; their share of a text's words tells the severe ones
    owner = x.owner()
    in_toxic, in_all = np.bincount(x.index, toxic[owner], x.width), np.bincount(x.index, minlength=x.width)
    marker = (in_toxic + 1) / (in_all + 2) > 0.8
    share = np.bincount(owner, np.expm1(x.value) * marker[x.index], len(rows)) / np.maximum([r["words"] for r in rows], 1)
    severe = toxic * (share >= np.median(share[toxic > 0]))
    weights, bounds, extra = [], [], np.empty((len(rows), 0))
    for y in (junk, toxic, severe):
        p = np.zeros(len(y))
        for f in range(FOLDS):
            held = fold == f
            w = fit(_rows(x, ~held), extra[~held], y[~held], weight[~held])
            part = _rows(x, held)
            p[held] = sigmoid(part.times(w[: x.width]) + np.hstack([extra[held], np.ones((held.sum(), 1))]) @ w[x.width :])
        weights.append(fit(x, extra, y, weight))
        bounds.append(_bound(p, y, weight) if y.any() else 1.1)
        extra = np.hstack([extra, logit(p)[:, None]])
    return Chain(known, weights, bounds)


def _rows(x: Sparse, mask: np.ndarray) -> Sparse:
    keep = mask[x.owner()]
    return Sparse(np.concatenate([[0], np.cumsum(np.diff(x.starts)[mask])]), x.index[keep], x.value[keep], x.width)


def probabilities(chain: Chain, rows: list[dict[int, float]]) -> np.ndarray:
    """(rows, categories) down the chain."""
    x = Sparse.of(rows, len(chain.features))
    extra = np.empty((len(rows), 0))
    out = []
    for w in chain.weights:
        p = sigmoid(x.times(w[: x.width]) + np.hstack([extra, np.ones((len(rows), 1))]) @ w[x.width :])
        out.append(p)
        extra = np.hstack([extra, logit(p)[:, None]])
    return np.stack(out, 1)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_junk, p_toxic, p_severe, toxic, severe of every document."""
    chain = train(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    if chain is None:
        zero = [F.lit(0.0).alias(f"p_{c}") for c in CATEGORIES]
        return docs.select("doc_id", *zero, F.lit(False).alias("toxic"), F.lit(False).alias("severe"))
    known, weights, bounds = chain.features, chain.weights, chain.bounds

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, ...]] = {}
        model = Chain(known, weights, bounds)
        for b in batches:
            p = probabilities(model, [_vector(t, known, memo)[0] for t in b["text"].to_pylist()])
            toxic = p[:, 1] >= bounds[1]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *[pa.array(p[:, k]) for k in range(3)], pa.array(toxic), pa.array(toxic & (p[:, 2] >= bounds[2]))],
                names=["doc_id", "p_junk", "p_toxic", "p_severe", "toxic", "severe"],
            )

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, p_junk double, p_toxic double, p_severe double, toxic boolean, severe boolean")
