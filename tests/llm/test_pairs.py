"""Near-duplicates, components and nearest neighbours against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import near_components, table
from pyspark.sql import functions as F

from churnlens.llm import ann_tree, neardup
from churnlens.llm.components import components
from churnlens.llm.queries import QUERIES


def test_components_match_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(80)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root) if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _near(rng, words, share):
    return [rng.choice("abcdefgh") * 3 + str(rng.randint(0, 999)) if rng.random() < share else w for w in words]


def _corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, n = {}, 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 6)):
            docs[n] = " ".join(_near(rng, base, rng.choice((0, 0.01, 0.03, 0.06))))
            n += 1
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for _ in range(40):  # a passage that many documents share
        docs[n] = passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(10, 80)))
        n += 1
    base = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(60):  # a large group of near copies
        docs[n] = " ".join(_near(rng, base, 0.015))
        n += 1
    for t in (None, "", "  \n", "one", "ONE", "two words", "Two  WORDS", "a b c d", "a b c d e"):
        docs[n] = t
        n += 1
    return docs


def _check(spark, docs, **kw):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), **kw).collect()}
    assert got == near_components(docs, **kw)


def test_neardup_matches_all_pairs(spark):
    _check(spark, _corpus(3))


def test_neardup_branches_large_nodes(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 4)
    _check(spark, _corpus(4), size=5)


def test_neardup_compares_what_stays_open(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 4)
    monkeypatch.setattr(neardup, "DEPTH", 1)
    _check(spark, _corpus(5))


@pytest.mark.parametrize("depth", [1, 2])
def test_neardup_branches_nodes_above_whole(spark, monkeypatch, depth):
    again, of = [], neardup._branched
    for name, value in (("LEAF", 4), ("WHOLE", 4), ("DEPTH", depth)):
        monkeypatch.setattr(neardup, name, value)
    monkeypatch.setattr(neardup, "_branched", lambda *a: again.append(a) or of(*a))
    _check(spark, _corpus(6))
    assert again


def test_neardup_compares_middling_nodes_whole(spark, monkeypatch):
    """Groups of some hundred copies need no branches, which make rows of 128 children a class."""
    again = []
    monkeypatch.setattr(neardup, "_branched", lambda *a: again.append(a) or a[3])
    test_neardup_keeps_links_in_large_nodes(spark)
    assert not again


def test_neardup_keeps_links_in_large_nodes(spark):
    """Copies of one text, each at 0.80 to 0.85 of it and less of one another: only the text links them."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(203)]
    docs = {0: " ".join(base)}
    for n in range(1, 401):
        at = rng.randint(0, 1)
        cuts = rng.sample(range(4 + at, 199, 4), 4 + at)  # a changed word changes four of 200 shingles
        docs[n] = " ".join(f"x{n}" + w if i in cuts else w for i, w in enumerate(base))
    rows = neardup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r["component_id"] for r in rows} == {0}


def test_neardup_rejects_percent_it_is_not_made_for(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d f")], "doc_id long, text string")
    for find in (neardup.near_duplicates, neardup.drop_near_duplicates):
        for percent in (60, 101):
            with pytest.raises(ValueError):
                find(docs, percent=percent)


def test_neardup_query(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    rows = QUERIES["op9_minhash_neardup"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == near_components(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_neardup_reads_a_text_a_class_whatever_the_ids(spark, monkeypatch):
    """Near copies without ids, or under one id: as many texts are read as classes are needed."""
    rng, need, read = random.Random(4), [], []
    texts = []
    for g in range(50):
        words = [f"g{g}w{i}" for i in range(120)]
        for _ in range(20):
            w = list(words)
            w[rng.randrange(120)] = f"x{rng.randrange(10**9)}"
            texts.append(" ".join(w))
    df = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(texts)], "doc_id long, text string")
    of = neardup._texts

    def counted(docs, wanted):
        out = of(docs, wanted)
        need.append(wanted.count())
        read.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_texts", counted)
    _, links = neardup.similar_classes(df)
    assert need and read == need
    # all classes of a family are in one component: 20 classes, 19 of them labelled
    assert links.count() == 50 * 19 and links.select("v").distinct().count() == 50


def test_neardup_compares_a_pair_in_one_node(spark):
    """Classes that meet in many nodes make one row a pair, not one a node."""
    row = "(cls binary, n bigint, rep struct<id:bigint,mark:bigint>, bits struct<w0:bigint,w1:bigint,w2:bigint,w3:bigint>, comp binary, node bigint, size bigint)"
    rows = [(bytes([c]), 100, (c, c), (0, 0, 0, 0), bytes([c]), node, 30) for c in range(30) for node in range(20) if c < 10 or node > 15]
    got = neardup._small(spark.createDataFrame(rows, row[1:-1])).collect()
    assert len(got) == 30 * 29 // 2 and len({(bytes(r["a"]), bytes(r["b"])) for r in got}) == len(got)


def test_neardup_copies_that_are_no_links_make_few_pairs(spark, monkeypatch):
    """Copies of one text, two of them at about 0.67: they meet in all nodes, but few pairs become rows."""
    rng, pairs = random.Random(9), []
    base = [f"b{i}" for i in range(203)]
    texts = []
    for n in range(60):
        cuts = rng.sample(range(4, 199, 4), 5)
        texts.append(" ".join(f"x{n}" + w if i in cuts else w for i, w in enumerate(base)))
    of = neardup._confirmed
    monkeypatch.setattr(neardup, "_confirmed", lambda p, *a: pairs.append(p.count()) or of(p, *a))
    rows = neardup.near_duplicates(_numbered(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == near_components(dict(enumerate(texts)))
    assert sum(pairs) < 3 * len(texts)


def test_neardup_parities_lose_no_link():
    """Cells that differ are no more than the items of one set only, for small sets and for large ones."""
    rng = np.random.default_rng(5)
    for n in (1, 7, 150, 500, 5000):
        items = np.unique(rng.integers(0, 2**64, 2 * n, dtype=np.uint64))
        sets = [items[np.sort(rng.permutation(len(items))[: n + k % 3])] for k in range(12)] + [items[:n], items[: max(1, n * 9 // 10)]]
        words = neardup.parities(sets).view(np.uint64)
        for x, a in zip(words, sets):
            for y, b in zip(words, sets):
                assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
    assert neardup.parities([]).shape == (0, neardup.PARITIES)


def test_neardup_roots_part_texts_that_share_a_passage(spark, monkeypatch):
    rng, again = random.Random(6), []
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(160)]) for _ in range(600)]
    monkeypatch.setattr(neardup, "_branched", lambda *a: again.append(a) or a[3])
    assert neardup.near_duplicates(_numbered(spark, texts)).where("kept").count() == 600
    assert not again


def _numbered(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_neardup_exchanges_few_texts_that_are_not_needed(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 7).alias("mark"))
    need = rows.where("(mark = 3 AND doc_id % 50 = 1) OR (doc_id IS NULL AND mark = 2)").select(F.col("doc_id").alias("id"), "mark").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("rows.mark") == F.col("need.mark"))
    wanted = lambda x: x.alias("rows").join(need.alias("need"), same).count()
    passed = neardup._perhaps(rows, need)
    assert passed.columns == rows.columns and wanted(passed) == wanted(rows) and passed.count() < wanted(rows) + 0.1 * 40_000
    assert neardup._perhaps(rows, need.limit(0)).count() == 0


def test_neardup_odd_rows(spark):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (7, "other words are in this text"), (9, None), (None, None), (8, "A B C D E")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = neardup.near_duplicates(df)
    assert out.count() == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in out.collect()} == {(None, 7, False), (7, 7, True), (8, 7, False), (9, 9, True), (None, None, True)}
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_drop_near_duplicates_keeps_columns(spark):
    docs = table(spark, "documents").withColumn("gone", F.lit(1)).withColumn("cls", F.lit("c"))
    out = neardup.drop_near_duplicates(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({c for _, c in near_components(texts, size=5).values()})


def _recall(rows, got, k=20):
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for i, v in enumerate(ids):
        if v % 20:
            continue
        s = (x * x[i]).sum(1)
        s[i] = -np.inf
        best = np.lexsort((ids, -s))[:k]
        mine = sorted(found[v])
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        at = {int(j): n for n, j in enumerate(ids)}
        assert all(abs(m[2] - s[at[m[1]]]) < 1e-12 for m in mine)
        hit += len({m[1] for m in mine} & set(ids[best].tolist()))
        total += len(best)
    return hit / total


def test_nearest_recall(spark):
    rows = table(spark, "embeddings", "/root/testdata/sf0.1").collect()
    got = QUERIES["op3_kmeans_tree"](spark, "/root/testdata/sf0.1").collect()
    assert _recall(rows, got) >= 0.9


def test_nearest_hot_vector_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "BLOCK", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    x[::3] = x[0]  # a third of all rows alike
    df = spark.createDataFrame([(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann_tree.nearest(df, "vec_id % 20 = 0", target=1.0).collect()
    assert _recall(df.collect(), got) >= 0.95
    first = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 60)
    assert [v for _, v in first] == [i for i in range(0, 300, 3) if i != 60][:20]


def test_nearest_repeated_query_rows(spark):
    x = np.random.default_rng(5).normal(size=(200, 8)).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)] + [(0, x[0])] * 3, "vec_id long, embedding array<double>")
    got = ann_tree.nearest(df, "vec_id = 0", target=1.0).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 21))
    assert len({r["vec_id"] for r in got}) == 20


def test_nearest_leaves_bad_vectors_out(spark):
    bad = [None, [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    good = [[1.0, 0.0], [0.5, 0.5], [0.0, 1.0], [-1.0, 0.0]]
    df = spark.createDataFrame([(i * 20, v) for i, v in enumerate(good + bad)] + [(None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann_tree.nearest(df, "vec_id % 20 = 0").collect()}
    assert {q for q, *_ in got} == {0, 20, 40, 60}
    assert {x for x in got if x[0] == 0} == {(0, 1, 20, 0.5), (0, 2, 40, 0.0), (0, 3, 60, -1.0)}
    assert ann_tree.nearest(df.limit(0), "vec_id % 20 = 0").count() == 0


def test_bounded_sample_is_the_smallest_hashes(spark):
    from churnlens.llm.common import bounded_sample

    d = spark.range(20000).withColumnRenamed("id", "k")
    want = [r[0] for r in d.orderBy(F.xxhash64("k", F.lit(0)), "k").limit(50).collect()]
    assert [r[0] for r in bounded_sample(d, "k", 50).collect()] == want
    assert bounded_sample(d.limit(0), "k", 5).count() == 0 and bounded_sample(d.limit(3), "k", 5).count() == 3
