"""Bigram language model in sharded Elias-Fano tries.

Probabilities.  With counts c over the training tokens (N tokens, V distinct):
unigram p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)); bigram p(w|h) = max(c(h,w) - D, 0) / c(h)
for pairs seen at least ``MIN_COUNT`` times (all), plus rest(h) p(w), where rest(h) is the
mass that the pairs leave (1 for an unseen h).  They sum to one over the known
words and one unknown.  A text's score is therefore

    sum log p(w)  +  sum log rest(h)  +  sum over found pairs of gain(h, w),
    gain = log((discounted + rest(h) p(w)) / (rest(h) p(w)))

so every token and every pair can be looked up where its data are.

Placement.  The ``HOT`` most frequent words of a bounded sample, the text's
start and its end are *hot*: a trie of the pairs among them is bounded by
HOT squared and goes to every task as a memory-mapped file.  Any other pair is
kept in the shard of its context, or of its word if the context is hot, so no
shard holds a frequent key and a cold context has all its pairs in one place.

Training: tasks count pairs per bundle of texts, one compressed list per shard;
a shard adds them up and asks other shards, in lists, how often the cold words
occur that its pairs end in.  Scoring: tasks look hot pairs up and send the
others, one list per bundle and shard; the shard's task builds its trie of the
sums, maps it from a temporary file and returns partial sums per text.  No word
or pair passes the disk as a row.  Lists and shards are bounded by
``BUNDLE_CHARS`` and ``SHARD_CHARS``; shards grow with the corpus.

Words are known by their 64-bit hash, second words inside a pair by 48 bits in
training and 32 in the trie (a false match needs an equal hash under one key);
gains are quantised to 4096 levels.

Defined cases: a null text counts as empty and scores its end token; a null
doc_id is a training text; repeated rows are scored each; without training
texts all counts are 0; an empty table gives no rows.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from churnlens.llm.common import bounded_batches, bounded_sample, stored
from churnlens.llm.elias_fano import Trie, from_buffer, to_bytes, trie_image
from churnlens.llm.text_hash import word_hashes, words

#: Bounds the hot trie: at most (HOT + 2) ** 2 pairs, 4.2 million, of 25 bytes on their way through the driver.
HOT = 2048
HOT_SAMPLE = 2000
DISCOUNT = 0.75
MIN_COUNT = 1
BUNDLE_CHARS = 3_000_000
BUNDLE_TEXTS = 60_000
SHARD_CHARS = 200_000_000
MIN_SHARDS = 32
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
_S16, _S32 = np.uint64(16), np.uint64(32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def pack(**arrays: np.ndarray) -> bytes:
    """Integer and float arrays, compressed; byte k of all entries lies together, so that bytes which hardly vary take no room."""
    return zstandard.compress(to_bytes({f"{k}:{a.dtype.str}": np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.ravel() for k, a in arrays.items()}), 1)


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    out = {}
    for head, a in from_buffer(np.frombuffer(zstandard.decompress(blob), np.uint8)).items():
        name, kind = head.split(":")
        size = np.dtype(kind).itemsize
        out[name] = np.ascontiguousarray(a.reshape(size, len(a) // size).T).ravel().view(kind)
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of sorted unsigned numbers, which np.cumsum undoes."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _sums(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _bundles(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """Lists of texts and further columns, of bounded size."""
    rows: list[tuple] = []
    n = 0
    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in ("text", *columns))):
            rows.append(row)
            n += len(row[0] or "")
            if n >= BUNDLE_CHARS or len(rows) >= BUNDLE_TEXTS:
                yield tuple(map(list, zip(*rows)))
                rows, n = [], 0
    if rows:
        yield tuple(map(list, zip(*rows)))


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(word, text number) of every token, the end included."""
    toks = [word_hashes(words(t)) for t in texts]
    w = np.concatenate([x for t in toks for x in (t, [END])]).astype(np.uint64)
    return w, np.repeat(np.arange(len(toks)), [len(t) + 1 for t in toks])


def _place(hot: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of each word among the sorted hot ones, -1 for a cold one."""
    i = np.minimum(np.searchsorted(hot, x), len(hot) - 1)
    return np.where(hot[i] == x, i, -1)


def _before(x: np.ndarray, doc: np.ndarray, first) -> np.ndarray:
    """What stands before each token's ``x``; ``first`` at the start of a text."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1])] = first
    return out


#: Kinds of pairs: cold context and hot word; hot context and cold word; both cold.  The key of the second is the word, else the context.
TO_HOT, FROM_HOT, COLD = 0, 1, 2


class Tokens:
    """The tokens of some texts with what each one follows: hot pairs by number, the others by kind, key and other word.

    A hot other word is given by its number, a cold one by its 48-bit name.
    """

    def __init__(self, texts: list[str | None], hot: np.ndarray) -> None:
        w, self.doc = _words(texts)
        self.hot_word = _place(hot, w)
        self.hot_context = _before(self.hot_word, self.doc, _place(hot, np.array([START]))[0])
        h = _before(w, self.doc, START)
        cold_h, cold_w = self.hot_context < 0, self.hot_word < 0
        self.both = np.nonzero(~cold_h & ~cold_w)[0]
        self.at = [np.nonzero(x)[0] for x in (cold_h & ~cold_w, ~cold_h & cold_w, cold_h & cold_w)]
        self.key = [(w if kind == FROM_HOT else h)[i] for kind, i in enumerate(self.at)]
        self.other = [self.hot_word[self.at[TO_HOT]].astype(np.uint32), self.hot_context[self.at[FROM_HOT]].astype(np.uint32), w[self.at[COLD]] >> _S16]


def _bounds(shards: int) -> np.ndarray:
    """The lowest key of each shard but the first: shards are ranges of equal width of the hash."""
    return np.array([-(-(s << 32) // shards) << 32 for s in range(1, shards)], np.uint64)


def _lists(keys: list[np.ndarray], shards: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray], list[slice]]]:
    """Per shard that has any: its distinct keys and, by kind, how many entries each has and where they are.  Keys are sorted within a kind."""
    own = np.unique(np.concatenate(keys))
    fans = [np.bincount(np.searchsorted(own, k), minlength=len(own)) for k in keys]
    ends = [np.concatenate([[0], np.cumsum(f)]) for f in fans]
    cuts = [0, *np.searchsorted(own, _bounds(shards)).tolist(), len(own)]
    for s in range(shards):
        a, b = cuts[s], cuts[s + 1]
        if b > a:
            yield s, own[a:b], [f[a:b].astype(np.uint32) for f in fans], [slice(int(e[a]), int(e[b])) for e in ends]


def _summed(key: np.ndarray, other: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted (key, other) with their sums of ``n``, or how often they occur."""
    order = np.lexsort((other, key))
    key, other = key[order], other[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (other[1:] != other[:-1])
    first = np.nonzero(new)[0]
    total = np.diff(np.append(first, len(key))) if n is None else np.add.reduceat(n[order], first) if len(first) else n
    return key[first], other[first], total


def _hot_words(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the most frequent words of HOT_SAMPLE texts, with the start and the end."""
    sample = bounded_sample(docs, "doc_id", HOT_SAMPLE).select("text")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (texts,) in _bundles(batches):
            w, n = np.unique(_words(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], names=["w", "n"])

    top = sample.mapInArrow(tally, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(size).collect()
    own = np.array([r["w"] for r in top], np.int64).view(np.uint64)
    return np.unique(np.concatenate([own, [START, END]]).astype(np.uint64))


def _count(hot: np.ndarray, shards: int):
    """Per bundle and shard a list of pairs with counts.  Hot pairs go by their number; hot words' counts, which a list of pairs doesn't tell, go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (texts,) in _bundles(batches):
            t = Tokens(texts, hot)
            sums = [_summed(k, o) for k, o in zip(t.key, t.other)]
            lists = {s: (own, fans, cut) for s, own, fans, cut in _lists([k for k, _, _ in sums], shards)}
            both, both_n = np.unique(t.hot_context[t.both] * len(hot) + t.hot_word[t.both], return_counts=True)
            word, word_n = np.unique(t.hot_word[t.hot_word >= 0], return_counts=True)
            none = (np.zeros(0, np.uint64), [np.zeros(0, np.uint32)] * 3, [slice(0, 0)] * 3)
            rows = []
            for s in range(shards):
                own, fans, cut = lists.get(s, none)
                b, u = both % shards == s, word % shards == s
                if len(own) or b.any() or u.any():
                    parts = {f"{x}{kind}": a[cut[kind]] for kind, (_, o, n) in enumerate(sums) for x, a in (("other", o), ("n", n.astype(np.uint32)))}
                    parts |= {f"fan{kind}": f for kind, f in enumerate(fans)}
                    hots = dict(both=_steps(both[b].astype(np.uint64)), both_n=both_n[b].astype(np.uint32), word=word[u].astype(np.uint32), word_n=word_n[u].astype(np.uint32))
                    rows.append((s, pack(keys=_steps(own), **parts, **hots)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary()))], names=["shard", "blob"])

    return run


#: Per quarter of a shard: words and their pairs, packed; tokens and distinct words; with the last, counts and pairs' mass of hot words and the hot pairs.
SUMS = "shard int, part int, words binary, pairs binary, tokens bigint, distinct bigint, hot_n array<bigint>, hot_used array<double>, hot_pairs binary"
QUARTERS = 4


def _add_up(hot_size: int, shards: int):
    """The sums of sorted shards, as rows of SUMS.  A cold word's count is that of the pairs whose context it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        shard = None

        def flush() -> Iterator[pa.RecordBatch]:
            """A quarter of a shard at a time bounds the arrays."""
            hot_n, used = np.zeros(hot_size, np.int64), np.zeros(hot_size)
            for x in held:
                hot_n[x["word"]] += x["word_n"]
                x["keys"] = _sums(x["keys"])
                for kind in range(3):
                    x[f"end{kind}"] = np.concatenate([[0], np.cumsum(x[f"fan{kind}"], dtype=np.int64)])
            pair, at = np.unique(np.concatenate([_sums(x["both"]) for x in held]), return_inverse=True)
            pair_n = np.bincount(at, np.concatenate([x["both_n"] for x in held]), len(pair)).astype(np.uint64)
            inner = np.array([((shard * QUARTERS + q) << 64) // (shards * QUARTERS) for q in range(1, QUARTERS)], np.uint64)
            cuts = [[0, *np.searchsorted(x["keys"], inner).tolist(), len(x["keys"])] for x in held]
            for q in range(QUARTERS):
                sums = []
                for kind in range(3):
                    keys, others, ns = [], [], []
                    for x, c in zip(held, cuts):
                        a, b = c[q], c[q + 1]
                        z = slice(int(x[f"end{kind}"][a]), int(x[f"end{kind}"][b]))
                        keys.append(np.repeat(x["keys"][a:b], x[f"fan{kind}"][a:b]))
                        others.append(x[f"other{kind}"][z])
                        ns.append(x[f"n{kind}"][z].astype(np.int64))
                    sums.append(_summed(np.concatenate(keys), np.concatenate(others), np.concatenate(ns)))
                own = np.unique(np.concatenate([k for k, _, _ in sums]))
                n, packed = np.zeros(len(own), np.int64), {}
                for kind, (key, other, total) in enumerate(sums):
                    at = np.searchsorted(own, key)
                    if kind != FROM_HOT:
                        n += np.bincount(at, total, len(own)).astype(np.int64)
                    keep = total >= MIN_COUNT
                    at, other, total = at[keep], other[keep], total[keep]
                    if kind == FROM_HOT:
                        used += np.bincount(other, total - DISCOUNT, hot_size)
                    packed |= {f"fan{kind}": np.bincount(at, minlength=len(own)).astype(np.uint32), f"other{kind}": other, f"n{kind}": total.astype(np.uint64)}
                last = q == QUARTERS - 1
                tokens = int(n.sum()) + (int(hot_n.sum()) if last else 0)
                distinct = len(own) + (int((hot_n > 0).sum()) if last else 0)
                row = (shard, q, pack(keys=_steps(own), n=n.astype(np.uint64)), pack(**packed), tokens, distinct)
                row += (hot_n, used, pack(pair=_steps(pair), n=pair_n)) if last else (None, None, None)
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in SUMS.split(", ")])
            held.clear()
            pa.default_memory_pool().release_unused()

        for b in batches:
            for s, blob in zip(b["shard"], b["blob"]):
                if s.as_py() != shard and held:
                    yield from flush()
                shard = s.as_py()
                held.append(unpack(blob.as_py()))
        if held:
            yield from flush()

    return run


class Hot:
    """Counts (of the start: the texts) and rest weights of the hot words."""

    def __init__(self, words: np.ndarray, n: np.ndarray, used: np.ndarray, tokens: int, distinct: int) -> None:
        self.words, self.n, self.tokens, self.distinct = words, n, tokens, distinct
        self.rest = _rest(used, n)

    def gain(self, n: np.ndarray, n_context: np.ndarray, rest: np.ndarray, n_word: np.ndarray) -> np.ndarray:
        low = rest * (n_word + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))
        return np.log10(((n.astype(np.float64) - DISCOUNT) / n_context + low) / low)


def _rest(used: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.maximum(1 - used / np.maximum(n, 1), 1e-12)


class Model:
    """Sums by shard and the counts of the cold words that its pairs end in (stored tables, from which a shard's trie is built where it is asked), the hot words and their trie's image."""

    def __init__(self, hot: Hot, image: bytes, sums: DataFrame, others: DataFrame, shards: int) -> None:
        self.hot, self.image, self.sums, self.others, self.shards = hot, image, sums, others, shards


def _split_names(names: np.ndarray, shards: int) -> list[np.ndarray]:
    """Sorted 48-bit names by shard."""
    return np.split(names, np.searchsorted(names << _S16, _bounds(shards)))


def _ask(shards: int):
    """Per quarter of a shard: the names of the cold words that its pairs end in, one list per shard that counted them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, part, blob in zip(b["shard"], b["part"], b["pairs"]):
                lists = _split_names(np.unique(unpack(blob.as_py())[f"other{COLD}"]), shards)
                rows = [(to, s.as_py(), part.as_py(), pack(names=_steps(x))) for to, x in enumerate(lists) if len(x)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["to", "shard", "part", "blob"])

    return run


def _answer(key, asked: pa.Table, words: pa.Table) -> pa.Table:
    """The counts of each list of names, in its order."""
    known = [unpack(x) for x in words["words"].to_pylist()]
    name = np.concatenate([_sums(x["keys"]) for x in known] or [np.zeros(0, np.uint64)]) >> _S16
    n = np.concatenate([x["n"] for x in known] or [np.zeros(0, np.uint64)])
    order = np.lexsort((n, name))[::-1]  # two words of one 48-bit name: the more frequent one
    name, first = np.unique(name[order], return_index=True)
    n = n[order][first]
    out = []
    for blob in asked["blob"].to_pylist():
        names = _sums(unpack(blob)["names"])
        i = np.minimum(np.searchsorted(name, names), max(len(name) - 1, 0))
        out.append(pack(n=np.where(name[i] == names, n[i], np.uint64(0)) if len(name) else np.zeros(len(names), np.uint64)))
    return pa.table([asked["shard"], asked["part"], asked["to"], pa.array(out, pa.binary())], names=["shard", "part", "to", "blob"])


def _trie_of(hot: Hot, parts: list[tuple[bytes, bytes]], answers: dict[tuple[int, int], bytes], shards: int) -> bytes:
    """Image of the trie of a shard's (words, pairs) by quarter, with the counts that other shards answered by (quarter, shard)."""
    all_keys, all_n, all_rest, all_key, all_other, all_gain = ([np.zeros(0, t)] for t in (np.uint64, np.int64, np.float64, np.uint64, np.uint64, np.float64))
    for part, (words_blob, pairs_blob) in enumerate(parts):
        x, y = unpack(words_blob), unpack(pairs_blob)
        key, n = _sums(x["keys"]), x["n"].astype(np.int64)
        at = [np.repeat(np.arange(len(key)), y[f"fan{kind}"]) for kind in range(3)]
        used = sum(np.bincount(at[kind], y[f"n{kind}"].astype(np.float64) - DISCOUNT, len(key)) for kind in (TO_HOT, COLD))
        rest = _rest(used, n)
        names, where = np.unique(y[f"other{COLD}"], return_inverse=True)
        n_other = np.concatenate([unpack(answers[part, to])["n"] for to, z in enumerate(_split_names(names, shards)) if len(z)] or [np.zeros(0, np.uint64)]).astype(np.int64)
        for kind in range(3):
            i, other, m = at[kind], y[f"other{kind}"], y[f"n{kind}"]
            if kind == TO_HOT:
                gain = hot.gain(m, n[i], rest[i], hot.n[other])
            elif kind == FROM_HOT:
                gain = hot.gain(m, hot.n[other], hot.rest[other], n[i])
            else:
                gain = hot.gain(m, n[i], rest[i], n_other[where])
            short = other >> _S16 if kind == COLD else hot.words[other] >> _S32
            all_key.append(key[i])
            all_other.append(short << np.uint64(1) | np.uint64(kind != FROM_HOT))
            all_gain.append(gain)
        all_keys.append(key)
        all_n.append(n)
        all_rest.append(np.log10(rest))
    return trie_image(*map(np.concatenate, (all_keys, all_n, all_rest, all_key, all_other, all_gain)))


def train(docs: DataFrame, hot_size: int = HOT, shards: int | None = None) -> Model:
    """The model of all rows of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    chars, texts = docs.agg(F.sum(F.char_length("text")), F.count("*")).first()
    shards = shards or max(MIN_SHARDS, -(-(chars or 0) // SHARD_CHARS))
    hot = _hot_words(docs, hot_size)
    lists = docs.select("text").mapInArrow(_count(hot, shards), "shard int, blob binary")
    sums = stored(lists.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_add_up(len(hot), shards), SUMS), "lm-counts")
    asked = sums.select("shard", "part", "pairs").mapInArrow(_ask(shards), "to int, shard int, part int, blob binary")
    others = asked.groupBy("to").cogroup(sums.select("shard", "words").groupBy("shard")).applyInArrow(_answer, "shard int, part int, to int, blob binary")
    others = stored(others, "lm-others")
    tokens, distinct = sums.agg(F.sum("tokens"), F.sum("distinct")).first()
    # HOT + 2 rows, and the hot pairs
    n, used = np.zeros(len(hot), np.int64), np.zeros(len(hot))
    each = sums.where("hot_n IS NOT NULL").select(F.posexplode(F.arrays_zip("hot_n", "hot_used")))
    for r in each.groupBy("pos").agg(F.sum("col.hot_n").alias("n"), F.sum("col.hot_used").alias("used")).collect():
        n[r["pos"]], used[r["pos"]] = r["n"], r["used"]
    n[_place(hot, np.array([START]))[0]] = texts
    blobs = [unpack(r["hot_pairs"]) for r in sums.where("hot_pairs IS NOT NULL").select("hot_pairs").collect()]
    pair = np.concatenate([_sums(x["pair"]) for x in blobs] or [np.zeros(0, np.uint64)]).astype(np.int64)
    m = np.concatenate([x["n"] for x in blobs] or [np.zeros(0, np.uint64)]).astype(np.int64)
    h, w, m = pair[m >= MIN_COUNT] // len(hot), pair[m >= MIN_COUNT] % len(hot), m[m >= MIN_COUNT]
    known = Hot(hot, n, used + np.bincount(h, m - DISCOUNT, len(hot)), tokens or 0, distinct or 0)
    image = trie_image(hot, n, np.log10(known.rest), hot[w], (hot[h] >> _S32) << np.uint64(1), known.gain(m, n[h], known.rest[h], n[w]))
    return Model(known, image, sums, others, shards)


def _mapped(image: bytes) -> Trie:
    """The trie over a memory-mapped temporary file, which has no name any more once it is mapped."""
    with tempfile.NamedTemporaryFile() as f:
        f.write(image)
        f.flush()
        return Trie(np.memmap(f.name, np.uint8, "r"))


#: What a shard's task gets, in this order: its sums by quarter, the counts from other shards, and per bundle what is asked there or was summed up locally.
PARTS, ANSWERS, ASKED = 0, 1, 2


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    bounded_batches(docs.sparkSession)
    hot, image, shards, tokens = model.hot, model.image, model.shards, model.hot.tokens
    scale = np.log10(tokens + 0.5 * (model.hot.distinct + 1))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per bundle a row of sums over hot words and pairs, and a list per shard of what is asked there."""
        trie = _mapped(image)
        task = TaskContext.get().partitionId()
        for number, (texts, ids, held) in enumerate(_bundles(batches, "doc_id", "held_out")):
            t = Tokens(texts, hot.words)
            doc, m = t.doc, len(texts)
            hw, hh = t.hot_word >= 0, t.hot_context >= 0
            c = hot.n[t.hot_word[hw]]
            base = np.bincount(doc[hw], np.log10(c + 0.5) - scale, m)
            known = np.bincount(doc[hw], c > 0, m).astype(np.int64)
            more = np.bincount(doc[hh], np.log10(hot.rest)[t.hot_context[hh]], m)
            pair, where = np.unique(t.hot_word[t.both] * len(hot.words) + t.hot_context[t.both], return_inverse=True)
            gain = trie.gains(pair // len(hot.words), (hot.words[pair % len(hot.words)] >> _S32) << np.uint64(1))
            more += np.bincount(doc[t.both], gain[where], m)
            me = f"{task}-{number}"
            blob = pack(n=np.bincount(doc, minlength=m), known=known, base=base, more=more)
            rows = [(number % shards, me, blob, ids, held)]
            # lists: keys with their number of askers, askers ordered by key and text
            order = [np.argsort(k, kind="stable") for k in t.key]
            asker = [doc[i[o]].astype(np.uint16) for i, o in zip(t.at, order)]
            other = [x[o] for x, o in zip(t.other, order)]
            other[COLD] = (other[COLD] >> _S16).astype(np.uint32)
            for s, own, fans, cut in _lists([k[o] for k, o in zip(t.key, order)], shards):
                parts = {f"{x}{kind}": a[kind][cut[kind]] for kind in range(3) for x, a in (("other", other), ("doc", asker))}
                rows.append((s, me, pack(keys=_steps(own), **parts, **{f"fan{kind}": f for kind, f in enumerate(fans)}), None, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_())))],
                names=["shard", "bundle", "blob", "ids", "held"],
            )

    def look_up(trie: Trie, blob: bytes) -> bytes:
        """Partial sums per text of what one bundle asks."""
        x = unpack(blob)
        at = trie.place(_sums(x["keys"]))
        there = at >= 0
        count, rest = np.zeros(len(at), np.int64), np.zeros(len(at))
        count[there], rest[there] = trie.counts[at[there]], trie.rest[at[there]]
        which = [np.repeat(np.arange(len(at)), x[f"fan{kind}"]) for kind in range(3)]
        texts, slot = np.unique(np.concatenate([x[f"doc{kind}"] for kind in range(3)]), return_inverse=True)
        slot = np.split(slot, np.cumsum([len(w) for w in which])[:-1])
        known, base, more = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
        weight = np.log10(count + 0.5) - scale
        for kind in range(3):
            i, z = which[kind], slot[kind]
            if kind != FROM_HOT:  # every cold token is the context of one pair
                base += np.bincount(z, weight[i], len(texts))
                known += np.bincount(z, count[i] > 0, len(texts)).astype(np.int64)
                more += np.bincount(z, rest[i], len(texts))
            other = x[f"other{kind}"]
            short = (other if kind == COLD else hot.words[other] >> _S32).astype(np.uint64)
            some = np.nonzero(there[i])[0]
            more += np.bincount(z[some], trie.gains(at[i[some]], short[some] << np.uint64(1) | np.uint64(kind != FROM_HOT)), len(texts))
        return pack(texts=texts, known=known.astype(np.uint32), base=base, more=more.astype(np.float32))

    def remote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's trie is built of its first rows; then its lists are answered, and rows of local sums pass through."""
        shard, trie, parts, answers = None, None, [], {}
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                if r["shard"] != shard:
                    shard, trie, parts, answers = r["shard"], None, [], {}
                if r["kind"] == PARTS:
                    parts.append((r["blob"], r["pairs"]))
                elif r["kind"] == ANSWERS:
                    answers[r["part"], r["to"]] = r["blob"]
                else:
                    if r["ids"] is None:
                        if trie is None:
                            trie = _mapped(_trie_of(hot, parts, answers, shards))
                            parts, answers = [], {}
                        r["blob"] = look_up(trie, r["blob"])
                    kinds = (("bundle", pa.string()), ("blob", pa.binary()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())))
                    yield pa.RecordBatch.from_arrays([pa.array([r[c]], k) for c, k in kinds], names=[c for c, _ in kinds])

    def total(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        x = unpack(head["blob"])
        n, known, base, more = x["n"], x["known"].copy(), x["base"].copy(), x["more"].copy()
        for r in rows:
            if r["ids"] is None:
                y = unpack(r["blob"])
                i = y["texts"].astype(np.int64)
                known[i] += y["known"].astype(np.int64)
                base[i] += y["base"]
                more[i] += y["more"]
        return pa.table(
            {
                "doc_id": pa.array(head["ids"], pa.int64()),
                "held_out": pa.array(head["held"], pa.bool_()),
                "n_tokens": pa.array(n.astype(np.int64)),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(n), tokens, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(base + more),
            }
        )

    d = docs.select("text", F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"))
    asked = d.mapInArrow(local, "shard int, bundle string, blob binary, ids array<bigint>, held array<boolean>").withColumn("kind", F.lit(ASKED))
    sums = model.sums.select("shard", "part", F.col("words").alias("blob"), "pairs", F.lit(PARTS).alias("kind"))
    answers = model.others.withColumn("kind", F.lit(ANSWERS))
    rows = sums.unionByName(answers, allowMissingColumns=True).unionByName(asked, allowMissingColumns=True)
    by_shard = rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "part")
    parts = by_shard.mapInArrow(remote, "bundle string, blob binary, ids array<bigint>, held array<boolean>")
    return parts.groupBy("bundle").applyInArrow(
        total, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def score_corpus(docs: DataFrame) -> DataFrame:
    """Every text's score by the model of the texts that aren't held out."""
    d = docs.select("doc_id", "text")
    return score(d, train(d.where(~held_out(F.col("doc_id")))))
