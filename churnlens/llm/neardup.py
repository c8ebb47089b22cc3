"""Near-duplicate documents by a chosen-path similarity join.

A document is the set of its word shingles.  Documents of equal sets form one
class; all further work is on classes.  ``TREES`` independent trees branch the
classes at their roots by ``ROOT_STEP`` minwise tokens each, so that texts which
share a common passage don't meet there, however many they are.  Every node
compares all its classes with one pivot.  If that leaves them in more than one component, a node
of at most ``WHOLE`` classes is compared exhaustively between its components,
which costs less than branching it; else no pair in it can change the result.

A larger open node may hide a pair.  A class of which fewer than ``SETTLED``
roots are small or connected is therefore branched again by ``EXTRA`` trees
with minwise tokens of their own: a node sends a class to ``FAN`` children, each
chosen by ``STEP`` tokens of the level (sets of similarity 0.8 meet in one of
them with 0.77, sets of 0.5 with 0.03), until it is small or connected; after
``DEPTH`` levels what is left of a node is compared exhaustively.  A pair whose
classes both are branched again is missed with less than ``MISSED``; a pair with
a class that isn't, by the roots that settle it.

Pairs must agree in size and in two sketches before they become rows: four bits
of each of ``COORDS`` minwise tokens, and the parities of the set's items in
``64 * PARITIES`` cells.  Cells that differ hold an item of one set only, so
there are no more of them than such items: the second sketch loses no link, and
of a group of copies it leaves few pairs that aren't links.  Pairs are confirmed
on the full sets, which are read for the classes of such pairs only.  At the
roots a class is compared with one pivot first; nodes that this leaves open are
compared with theirs.

Nothing is grouped into one task but small nodes: nodes are counted (combined
map-side) and joined, in blocks where they are large.  A level is one pass over
all trees, and what it finds is written to the shared folder.

Defined cases: null, empty and blank texts have the empty set, are linked with
nothing and are kept.  Rows that repeat a doc_id are one vertex per distinct
set, linked by nothing but similarity; null ids take part and give a class no
name, so a component without any id has a null component_id, and a row is kept
if its id equals the component's (null-safe).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_128_digest

from churnlens.llm.common import batch_rows, fresh, stored
from churnlens.llm.components import components
from churnlens.llm.text_hash import mixed, shingles, word_hashes, words

COORDS = 64
#: One tree keeps a pair of similarity 0.8 together at its root with 0.8 ** 3 = 0.512, and one of 0.05 with 0.0001; 21 small or connected roots miss the first with 3e-7.
TREES, ROOT_STEP = 21, 3
#: A pair of similarity 0.8 may be missed with this, wherever it is.
MISSED = 1e-6
#: So many small or connected roots miss a pair with 0.488 ** 20 = 6e-7.
SETTLED = 20
#: A node of at most WHOLE classes is compared whole: at most WHOLE / 2 sketches a class; of at most LEAF, as one list, above by a join.
LEAF, WHOLE = 64, 2048
STEP, FAN, DEPTH = 8, 8, 2
#: A tree of own tokens parts a pair of similarity 0.8 if at one of its levels no child holds both.
PARTED = 1 - (1 - (1 - 0.8**STEP) ** FAN) ** DEPTH
EXTRA = math.ceil(math.log(MISSED) / math.log(PARTED))
#: Four-bit tokens that may differ: a pair of similarity 0.8 differs in 12 of 64 (deviation 3.1), in more than 30 with 2e-7.
MOST_UNEQUAL = 30
#: 64-bit words of the parity sketch: texts of 150 to 500 shingles pass it from a similarity of 0.77 or so.
PARITIES = 12


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_MULS = _odd(20240601, COORDS)
_OWN_MULS = _odd(20240602, EXTRA * DEPTH * FAN * STEP)
_BLOCK = 200_000
#: Texts of an Arrow batch; classes of a block of a node that is compared whole.
BATCH, BLOCK_ROWS = 200, 2048
#: Bits of the bitmap that tells which texts may be needed: 16 MB.
MOST_BITS = 1 << 27


def minwise(sets: list[np.ndarray], muls: np.ndarray = _MULS) -> np.ndarray:
    """(len(sets), len(muls)) minwise tokens of non-empty sets."""
    out = np.empty((len(sets), len(muls)), np.int32)
    at = 0
    while at < len(sets):
        n, upto = len(sets[at]), at + 1
        while upto < len(sets) and n + len(sets[upto]) <= _BLOCK:
            n, upto = n + len(sets[upto]), upto + 1
        x = np.concatenate(sets[at:upto])
        starts = np.cumsum([0] + [len(s) for s in sets[at : upto - 1]])
        for k, mul in enumerate(muls):
            out[at:upto, k] = np.minimum.reduceat((x * mul) >> np.uint64(32), starts).astype(np.uint32).view(np.int32)
        at = upto
    return out


def _joined(tokens: np.ndarray) -> np.ndarray:
    """One 64-bit hash of the tokens along the last axis."""
    key = np.zeros(tokens.shape[:-1], np.uint64)
    for k in range(tokens.shape[-1]):
        key = mixed(key * _MULS[0] + tokens[..., k].astype(np.uint32))
    return key


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), PARITIES) words: a bit tells whether its cell holds an odd number of the set's items."""
    cells = 64 * PARITIES
    lens = [len(s) for s in sets]
    x = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    cell = ((x >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    held = np.bincount(np.repeat(np.arange(len(sets)), lens) * cells + cell, minlength=len(sets) * cells)
    return np.packbits((held & 1).astype(bool).reshape(len(sets), cells), axis=1).view(np.int64)


#: One bit of each of the COORDS tokens a column, and the words of the parity sketch.
_BITS = ("w0", "w1", "w2", "w3")
_CELLS = tuple(f"p{k}" for k in range(PARITIES))


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(word_hashes(words(t)), size) for t in b["text"].to_pylist()]
            full = [s for s in sets if len(s)]
            sig = minwise(full) if full else np.empty((0, COORDS), np.int32)
            at = np.cumsum([len(s) > 0 for s in sets]) - 1
            top = (_joined(sig[:, : TREES * ROOT_STEP].reshape(-1, TREES, ROOT_STEP)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            roots = [top[i] if len(s) else None for i, s in zip(at, sets)]
            bits = [np.packbits((sig >> k) & 1, axis=1).view(np.int64).ravel() for k in range(4)] + list(parities(full).T)
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"],
                    b["mark"],
                    pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(roots, pa.list_(pa.int32())),
                    *(pa.array([w[i] if len(s) else None for i, s in zip(at, sets)], pa.int64()) for w in bits),
                ],
                names=["doc_id", "mark", "cls", "n", "roots", *_BITS, *_CELLS],
            )

    return run


def _full_sets(size: int):
    """(cls, items) of the texts whose set is the expected class's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(word_hashes(words(t)), size) for t in b["text"].to_pylist()]
            good = [(c, s) for c, s in zip(b["cls"].to_pylist(), sets) if xxh3_128_digest(s.tobytes()) == c]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in good], pa.binary()), pa.array([s.view(np.int64) for _, s in good], pa.list_(pa.int64()))], names=["cls", "items"])

    return run


def _own_paths(size: int):
    """(cls, tree, groups) of the texts whose set is the expected class's: a hash of STEP tokens for each level and child of the EXTRA trees."""
    full = _full_sets(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in full(batches):
            sets = [x.values.to_numpy().view(np.uint64) for x in b["items"]]
            if not sets:
                continue
            key = _joined(minwise(sets, _OWN_MULS).reshape(len(sets) * EXTRA, -1, STEP))
            cls = [c for c in b["cls"].to_pylist() for _ in range(EXTRA)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.binary()), pa.array(np.tile(np.arange(EXTRA, dtype=np.int32), len(sets))), pa.array(list(key.view(np.int64)), pa.list_(pa.int64()))],
                names=["cls", "tree", "groups"],
            )

    return run


def _children(members: DataFrame, level: int) -> DataFrame:
    """(cls, tree, node) of the next level's nodes, from members (cls, tree, node, groups)."""
    mine = F.slice("groups", level * FAN + 1, FAN)
    return members.select("cls", "tree", F.explode(F.transform(mine, lambda key, g: F.xxhash64("node", g, key))).alias("node"))


def _members(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``nodes`` (cls, node, ...) that hold several classes, with what is compared of the classes."""
    several = nodes.groupBy("node").count().where("count > 1").select("node")
    return stored(nodes.join(several, "node").join(classes.select("cls", "n", "bits"), "cls"), "neardup-members")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with component, node size and the node's pivot (any of its classes, another one in each node), of nodes that have at least two components."""
    m = members.join(labels.select(F.col("u").alias("cls"), F.col("v").alias("root")), "cls", "left")
    m = m.withColumn("comp", F.coalesce("root", "cls")).drop("root")
    stat = m.groupBy("node").agg(F.count("*").alias("size"), F.min_by(F.struct(*_ME), F.xxhash64("node", "cls")).alias("pivot"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    return m.join(stat.where("size > 1 AND c0 <> c1").select("node", "size", "pivot"), "node")


_ME = ("cls", "n", "bits", "comp")
_FACTS = ("cls", "node", "n", "bits")


def _may_link(x: Column, y: Column, open_: DataFrame) -> Column:
    """Whether x is of another component than y, and sizes and sketches allow a link; ``open_`` says which sketches there are."""
    differ = lambda w: x["bits"][w].bitwiseXOR(y["bits"][w])
    unequal = functools.reduce(Column.bitwiseOR, map(differ, _BITS))
    sizes = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * 80
    may = sizes & (x["comp"] != y["comp"]) & (F.bit_count(unequal) <= MOST_UNEQUAL)
    if set(_CELLS) <= set(open_.schema["bits"].dataType.names):
        # linked sets of n and m items differ in (n + m) / 9 at most
        cells = sum((F.bit_count(differ(w)) for w in _CELLS[1:]), F.bit_count(differ(_CELLS[0])))
        may = may & (cells * 9 <= x["n"] + y["n"])
    return may


def _first(x: Column, y: Column, open_: DataFrame) -> Column:
    """``_may_link`` for one of the two orders of a pair."""
    return (x["cls"] < y["cls"]) & _may_link(x, y, open_)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))


def _star(open_: DataFrame) -> DataFrame:
    """Candidate (x, y): each node's pivot with its other classes."""
    return open_.select(F.col("pivot").alias("x"), F.struct(*_ME).alias("y")).where(_may_link(F.col("x"), F.col("y"), open_))


def _small(open_: DataFrame) -> DataFrame:
    """Candidates between the components of nodes of at most LEAF classes, each once."""
    lists = open_.where(F.col("size") <= LEAF).groupBy("node").agg(F.collect_list(F.struct(*_ME)).alias("m"))
    two = lists.select("m", F.explode("m").alias("x"))
    return _ends(two.select("x", F.explode(F.filter("m", lambda z: _first(F.col("x"), z, open_))).alias("y"))).distinct()


def _whole(open_: DataFrame) -> DataFrame:
    """Candidates between the components of nodes of at most WHOLE classes."""
    return _small(open_).unionByName(_large(open_.where(F.col("size") <= WHOLE)))


def _large(open_: DataFrame) -> DataFrame:
    """Candidates between the components of larger nodes, block by block: a node is dealt over as many keys as it has pairs of blocks."""
    large = open_.where(F.col("size") > LEAF).select("node", F.struct(*_ME).alias("m"), F.ceil(F.col("size") / BLOCK_ROWS).alias("blocks"))
    large = large.withColumn("own", F.pmod(F.xxhash64("m.cls"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    left = large.select("node", F.col("m").alias("x"), F.col("own").alias("bx"), other.alias("by"))
    right = large.select("node", F.col("m").alias("y"), other.alias("bx"), F.col("own").alias("by"))
    return _ends(left.join(right, ["node", "bx", "by"]).where(_first(F.col("x"), F.col("y"), open_)))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach ``percent`` of similarity."""
    item = lambda k: sets.select(F.col("cls").alias(k), F.col("items").alias(f"i{k}"))
    p = pairs.join(item("a"), "a").join(item("b"), "b")
    p = p.select("a", "b", F.size(F.array_intersect("ia", "ib")).alias("both"), (F.size("ia") + F.size("ib")).alias("total"))
    return p.where(F.col("both") * 100 >= (F.col("total") - F.col("both")) * percent).select("a", "b")


def similar_classes(docs: DataFrame, size: int = 4, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(doc_id, cls, n) of every row, and (u, v): classes linked to a smaller class, with the smallest of the component."""
    if not 80 <= percent <= 100:
        raise ValueError(f"percent must be from 80 to 100, as the size filter and the trees are laid out for: {percent}")
    with batch_rows(docs.sparkSession, BATCH):
        return _similar_classes(docs, size, percent)


def _similar_classes(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    schema = docs.select("doc_id").schema.simpleString()[7:-1]
    texts = docs.select("doc_id", "text", _mark().alias("mark"))
    bits = ", ".join(f"{w} bigint" for w in (*_BITS, *_CELLS))
    sketch = stored(texts.mapInArrow(_sketch(size), f"{schema}, mark bigint, cls binary, n bigint, roots array<int>, {bits}"), "neardup-sketch")
    rep = F.min(F.struct(F.col("doc_id").alias("id"), "mark")).alias("rep")
    first = [F.first(c).alias(c) for c in ("n", "roots", *_BITS, *_CELLS)]
    classes = sketch.where("cls IS NOT NULL").groupBy("cls").agg(rep, *first)
    classes = stored(classes.select("cls", "rep", "n", "roots", F.struct(*_BITS, *_CELLS).alias("bits")), "neardup-classes")

    none = classes.sparkSession.createDataFrame([], "u binary, v binary")
    roots = F.transform("roots", lambda token, tree: F.xxhash64(tree, token))
    members = _members(classes.select("cls", F.explode(roots).alias("node")), classes)
    # copies share pivots: one of them links a class, the others are asked where that leaves a node open
    one = _star(_open(members, none)).groupBy("y.cls").agg(F.min("x.cls").alias("pivot"))
    one = _ends(one.select(F.struct("cls").alias("x"), F.struct(F.col("pivot").alias("cls")).alias("y")))
    labels = _linked(docs, one, classes, none, size, percent)
    again = stored(_open(members, labels), "neardup-open")
    labels = _linked(docs, _ends(_star(again)).unionByName(_small(again)), classes, labels, size, percent)
    # larger nodes are compared after that, so that a group of copies is one component and makes no pairs
    again = stored(_open(again.where(F.col("size") > LEAF).select(*_FACTS), labels), "neardup-open")
    labels = _linked(docs, _large(again.where(F.col("size") <= WHOLE)), classes, labels, size, percent)
    unsettled = again.where(F.col("size") > WHOLE).groupBy("cls").count().where(F.col("count") > TREES - SETTLED)
    hard = stored(unsettled.join(classes, "cls").select("cls", "rep"), "neardup-hard")
    if not hard.isEmpty():
        labels = _branched(docs, hard, classes, labels, size, percent)
    return sketch.select("doc_id", "cls", "n"), labels


def _branched(docs: DataFrame, hard: DataFrame, classes: DataFrame, labels: DataFrame, size: int, percent: int) -> DataFrame:
    """``labels`` with what the EXTRA trees link of the classes ``hard``."""
    paths = _texts(docs, hard).mapInArrow(_own_paths(size), "cls binary, tree int, groups array<bigint>")
    paths = stored(paths.dropDuplicates(["cls", "tree"]), "neardup-paths")
    nodes = _children(paths.withColumn("node", F.col("tree").cast("bigint")), 0)
    wait = None
    for level in range(1, DEPTH + 1):
        members = _members(nodes, classes)
        found = _ends(_star(_open(members, labels)))
        labels = _linked(docs, found if wait is None else found.unionByName(wait), classes, labels, size, percent)
        again = stored(_open(members, labels), "neardup-open")
        wait = _whole(again)
        large = again.where(F.col("size") > WHOLE)
        nodes = _children(large.select("cls", "tree", "node").join(paths, ["cls", "tree"]), level)
    return _linked(docs, wait.unionByName(_large(large)), classes, labels, size, percent)


def _mark() -> Column:
    """Tells the texts of rows apart that share an id, or have none."""
    return F.xxhash64("text")


def _texts(docs: DataFrame, need: DataFrame) -> DataFrame:
    """(cls, text) of the rows named by (cls, rep): one a class, and its copies under the same id.

    An id that many rows share names one of their texts, so a class never reads
    the texts of others (two texts of one hash apart: they are left out later).
    """
    rows = _perhaps(docs.select("doc_id", "text", _mark().alias("mark")), need.select("rep.id", "rep.mark"))
    same = F.col("doc_id").eqNullSafe(F.col("rep.id")) & (F.col("mark") == F.col("rep.mark"))
    return rows.join(need, same).select("cls", "text")


def _perhaps(rows: DataFrame, need: DataFrame) -> DataFrame:
    """``rows`` without most of those whose (doc_id, mark) isn't among ``need`` (id, mark), so that their texts aren't exchanged.

    A bitmap of hashes, of 16 bits a needed row and 16 MB at most, goes to the
    tasks; beyond that more rows pass, never fewer.
    """
    bits = 1 << 15
    while bits < min(16 * need.count(), MOST_BITS):
        bits *= 2
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(bits))
    at = need.select(place("id", "mark").alias("at"))
    maps = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
    bit = F.bitmap_bit_position(place("doc_id", "mark")).cast("int")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = rows.join(F.broadcast(maps), F.bitmap_bucket_number(place("doc_id", "mark")) == F.col("bucket"))
    return joined.where(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), bit % 8)) != 0).select("doc_id", "text", "mark")


def _linked(docs: DataFrame, pairs: DataFrame, classes: DataFrame, labels: DataFrame, size: int, percent: int) -> DataFrame:
    """``labels`` with the candidate ``pairs`` (a, b) that the full sets confirm."""
    pairs = stored(pairs.distinct(), "neardup-pairs")
    if pairs.isEmpty():
        return labels
    # one row's text for each class of a pair
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    # written, so that Spark knows its size and can leave the texts where they are if it is small
    need = stored(ends.join(classes.select("cls", "rep"), "cls"), "neardup-need")
    sets = stored(_texts(docs, need).mapInArrow(_full_sets(size), "cls binary, items array<bigint>"), "neardup-sets")
    found = stored(_confirmed(pairs, sets, percent), "neardup-edges")
    if found.isEmpty():
        return labels
    # the labels so far connect what all links so far connect
    return components(labels.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(found))


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id of the component), kept."""
    rows, links = similar_classes(docs, size, percent)
    # per class first, so that copies meet as one row
    per = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"))
    per = per.join(links.select(F.col("u").alias("cls"), "v"), "cls", "left").withColumn("root", F.coalesce("v", "cls"))
    name = per.groupBy("root").agg(F.min("least").alias("component"))
    named = per.join(name, "root").select("cls", "component")
    # a class of thousands of copies is a hot key of this join only, which adaptive execution splits
    linked = rows.where("cls IS NOT NULL").join(named, "cls").select("doc_id", "n", "component")
    alone = rows.where("cls IS NULL").select("doc_id", "n", F.col("doc_id").alias("component"))
    out = linked.unionByName(alone)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group: the one with the smallest doc_id.  Columns as they came.

    Rows that share a doc_id are one document: they stay if any of them is kept.
    """
    found = near_duplicates(docs.select("doc_id", "text"), size, percent)
    gone = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("NOT kept")
    key = fresh(docs, "gone")
    gone = stored(gone.select(F.col("doc_id").alias(key)), "neardup-gone")
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(key)), "left_anti")
