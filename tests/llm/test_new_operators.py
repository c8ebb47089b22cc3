"""Personal data, token alignment and whitening against plain Python twins."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from brute import SF, aligned, base_pii, table
from pyspark.sql import functions as F

from churnlens.llm import pii, secular, token_align, whitening
from churnlens.llm.queries import QUERIES


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# ------------------------------------------------------------- personal data
ODD_PII = [
    None,
    "",
    " \n ",
    "a@b.c d@e.f_g@h.i",
    "x.y@z..w a@b-.-c.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.255 1.1.1.0256",
    "4111 1111-1111 1111 and 4111111111111112 and 41111111111111111111111",
    "+1 (555) 010-9999 +12 +1 2345678 ( +49.30.1234567 +1234567890123456",
    "\U0001f600 é a.b@c.de \U0001f600 10.0.0.1",
    "@" * 2000 + "a" * 3000,
    "1" * 5000,
    "1 " * 5000,
    "a." * 1500 + "@",
    "x@" + "a." * 1500 + "b",
    "1." * 1500,
    "+" * 3000 + "1" + " " * 3000,
    "a-" * 1500 + "1234",
    "+1" + "(" * 2000 + "9",
]


def _check_pii(rows, docs):
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        want = base_pii(docs[r["doc_id"]])
        n = Counter(k for k, _, _ in want)
        assert tuple(r[f"n_{k}"] for k in ("email", "ip", "card", "phone")) == tuple(n[k] for k in ("email", "ip", "card", "phone")), r["doc_id"]
        spans = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), r["doc_id"]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("like_")] == spans


def test_pii_query_matches_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    _check_pii(QUERIES["op11_pii"](spark, SF).collect(), docs)


def test_pii_of_odd_texts(spark):
    docs = dict(enumerate(ODD_PII))
    df = _frame(spark, ODD_PII).withColumn("kind", F.lit(1)).withColumn("start", F.lit("x"))
    _check_pii(pii.pii_report(df).collect(), docs)
    assert pii.pii_report(df.limit(0)).count() == 0


def test_pii_takes_linear_time_on_long_runs(spark):
    """Runs in which a naive pattern rescans from every start, or recurses for every repetition (a plain scan of 10^6 needs hours)."""
    n = 100_000
    texts = ["a." * n + "@", "a" * n + "%", "1" * n, "1 " * n, "1." * n, "x@" + "a." * n, "+" * n, "a-" * n + "1234", "+1" + "(" * n]
    rows = {r["doc_id"]: r for r in pii.pii_report(_frame(spark, texts)).collect()}
    assert [rows[i]["n_email"] for i in range(9)] == [0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert [rows[i]["n_ip"] for i in range(9)] == [0, 0, 0, 0, n // 4, 0, 0, 0, 0]


def test_pii_null_and_repeated_ids_keep_their_rows(spark):
    df = spark.createDataFrame([(None, "a@b.cd"), (None, "a@b.cd"), (3, None), (3, "1.2.3.4")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_email"], r["n_ip"]) for r in pii.pii_report(df).collect())
    assert got == [(0, 1, 0), (0, 1, 0), (3, 0, 0), (3, 0, 1)]


def test_contexts_of_seeds_discover_unseen_identifiers(spark):
    """E-mails seed "write to _ for details"; the account named there is discovered, and through it "my handle is _"."""
    seeds = [f"please write to user{i}@mail.example for details soon" for i in range(8)]
    # eight accounts that no base pattern spells, first seen in the seeds' context, then in one of their own
    unseen = [f"please write to acct-{4000 + i} for details soon\nmy handle is acct-{4000 + i} since spring" for i in range(8)]
    second = ["my handle is zz99881 since spring"]
    clean = ["the year 2024 was fine", "model x5000 sold well", "in 1999 and 2001 we met"]
    texts = seeds + unseen + second + clean
    got = {r["doc_id"]: r for r in pii.pii_report(_frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        like = [s.split(":") for s in got[i]["spans"].split(",") if s.startswith("like_")]
        if t in unseen:
            core = f"acct-{4000 + i - len(seeds)}"
            assert [(k, t[int(a) : int(b)]) for k, a, b in like] == [("like_email", core)] * 2
        elif t in second:
            assert [(k, t[int(a) : int(b)]) for k, a, b in like] == [("like_email", "zz99881")]
        else:
            assert like == [] and got[i]["n_like"] == 0, t
    one = {r["core"] for r in pii.bootstrap(_edges(spark, texts), rounds=1).collect()}
    assert "zz99881" not in one and "acct-4003" in one  # found in the second round only


def _edges(spark, texts):
    units = _frame(spark, texts).select(F.explode(pii._units(F.col("text"))).alias("u")).select("u.*")
    return units.select(F.explode("patterns").alias("pattern"), "core", "kind").distinct()


def test_a_context_of_mixed_kinds_discovers_nothing(spark):
    seeds = [f"seen {x} today there" for x in [f"u{i}@m.example" for i in range(5)] + [f"10.0.0.{i}" for i in range(5)] + ["ref-77889"]]
    assert sum(r["n_like"] for r in pii.pii_report(_frame(spark, seeds)).collect()) == 0


def test_pii_plan_is_native(spark):
    plan = QUERIES["op11_pii"](spark, SF)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# ------------------------------------------------------------- alignment
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{token_align.TOKENIZERS}/{token_align.BYTE_BPE}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{token_align.TOKENIZERS}/{token_align.PIECES}")


ODD_TEXTS = [
    None, "", " ", "  \n\t x", "a", "<|endoftext|> <s> </s> <unk> <0x41>", "has ▁ inside", "\u0001f600 \U0001f469‍\U0001f680 naïve", "\x00 nul",
    "漢字 ภาษา", "w" * 30_000, "don't we'll I'D 12345 !!??", "same text", "same text", "\r\n\x0b\x0c\x85 　x",
]


def test_alignment_query_matches_brute_force(spark, libraries):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    want = aligned(docs, *libraries)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_token_align"](spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("bundle", [1, 5000, token_align.BUNDLE_BYTES])
def test_alignment_of_odd_texts_in_any_bundles(spark, libraries, bundle):
    want = aligned(dict(enumerate(ODD_TEXTS)), *libraries)
    df = _frame(spark, ODD_TEXTS).withColumn("n", F.lit(1)).withColumn("bundle", F.lit("x"))
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in token_align.align_report(df, bundle_bytes=bundle).collect()}
    assert got == want
    assert got[6][:4] == (0, 0, 0, 0) and got[10][0] > 0


def test_alignment_of_no_rows_and_of_null_ids(spark):
    df = spark.createDataFrame([(None, "one two"), (None, "one two"), (7, None)], "doc_id long, text string")
    rows = token_align.align_report(df).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"] > 0, r["count_sum"] == 2 * r["n_links"]) for r in rows) == [(0, True, True), (0, True, True), (7, False, True)]
    assert token_align.align_report(df.limit(0)).count() == 0


def test_aligned_groups_spell_the_text(spark, libraries):
    texts = [t for t in ODD_TEXTS if t]
    a, b = token_align.ByteBpe(f"{token_align.TOKENIZERS}/{token_align.BYTE_BPE}"), token_align.Pieces(f"{token_align.TOKENIZERS}/{token_align.PIECES}")
    for r in token_align.align_texts(_frame(spark, texts)).collect():
        if "▁" in texts[r["doc_id"]]:
            assert r["groups"] == []
            continue
        sides = [[b"".join(x.bytes[i] for i in g[n]) for g in r["groups"]] for x, n in ((a, "a"), (b, "b"))]
        assert sides[0] == sides[1] and b"".join(sides[0]) == (" " + texts[r["doc_id"]]).encode()


def test_coalescing_of_any_intervals():
    starts, ends = np.array([0, 2, 5, 0, 3, 5]), np.array([2, 5, 9, 3, 5, 9])
    assert token_align.coalesce(starts, ends).tolist() == [0, 0, 1, 0, 0, 1]
    a, b = token_align.overlaps(starts[:3], ends[:3], starts[3:], ends[3:])
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (1, 0), (1, 1), (2, 2)]


# ------------------------------------------------------------- whitening
@pytest.mark.parametrize("dim, n, draw", [
    (12, 300, lambda r: r.normal(size=12) * np.arange(1, 13)),
    (6, 200, lambda r: r.integers(-2, 3, size=6).astype(float)),  # many equal eigenvalues on the way
    (5, 60, lambda r: np.array([1.0, 2, 0, 0, 5]) * r.integers(-3, 4)),  # rank one
    (10, 200, lambda r: 10.0 ** r.integers(-6, 6, size=10) * r.normal(size=10)),
    (1, 5, lambda r: r.normal(size=1)),
])
def test_rank_one_updates_follow_the_eigenvalues(dim, n, draw):
    rng = np.random.default_rng(1)
    d, q, m = np.zeros(dim), np.eye(dim), np.zeros((dim, dim))
    for _ in range(n):
        u = draw(rng)
        d, q = secular.update(d, q, u)
        m += np.outer(u, u)
    assert np.allclose(np.linalg.eigvalsh(m), d, atol=1e-11 * max(d[-1], 1e-300), rtol=0)
    assert np.abs(q.T @ q - np.eye(dim)).max() < 1e-11 and np.abs(q * d @ q.T - m).max() < 1e-10 * np.abs(m).max()


def _twin(rows, k=16):
    """{(id, component): (n, deviation, |whitened|)} and explained shares, from one eigh of the exact covariance."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] for _, v in good])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    y = (n * fit - s) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    w = (n * x - s) / n @ u[:, :k] / np.sqrt(e[:k])
    return [i for i, _ in good], n, ((n * x - s) ** 2).sum(1), w, e[:k] / e.sum()


def _check_whitening(got, rows, k=16):
    ids, n, deviation, w, explained = _twin(rows, k)
    assert len(got) == len(ids) * w.shape[1]
    assert {(r["n"]) for r in got} == {n} and all(r["identity_error"] <= 1e-4 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append((r["vec_id"], r["deviation"], r["whitened"]))
        assert abs(r["explained"] - explained[r["component"] - 1]) <= 1e-9
    for c, mine in by.items():
        want = [(i, int(dv), float(v)) for i, dv, v in zip(ids, deviation, w[:, c - 1])]
        sign = 1 if sum(v * max(x[2] for x in mine if x[:2] == (i, dv)) for i, dv, v in want[:1]) >= 0 else -1
        mine, want = sorted(mine), sorted((i, dv, sign * v) for i, dv, v in want)
        assert [m[:2] for m in mine] == [x[:2] for x in want]
        assert np.allclose([m[2] for m in mine], [x[2] for x in want], atol=1e-9)


def test_whitening_query_matches_one_eigh(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "embeddings").collect()]
    _check_whitening(QUERIES["op13_whitening"](spark, SF).collect(), rows)


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=3).astype(np.float32)]) for i in range(40)]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0])]
    rows += [(1, rows[1][1])] * 30 + [(200, [0.0, -0.0, 0.0]), (201, [-0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(0))
    _check_whitening(whitening.whiten(df).collect(), rows, 3)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<float>")).collect() == []  # one distinct vector
    mixed = rows + [(300, [1.0]), (301, [2.0, 3.0]), (302, [3.4e38, 1.0, 1.0])]  # other lengths, an entry beyond a long
    _check_whitening(whitening.whiten(spark.createDataFrame(mixed, "vec_id long, embedding array<float>")).collect(), rows, 3)


def test_a_rank_deficient_fit_has_fewer_components(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 20 and abs(got[0]["explained"] - 1) < 1e-12


def test_exact_sums_and_deviations_of_large_entries(spark):
    big = 1 << 61
    fit = spark.createDataFrame([([big, 1],), ([big, 2],), ([big, 3],), ([big - 5, 4],)], "x array<long>")
    total = whitening.sums(fit)
    assert total == [4 * big - 5, 10]
    gap = whitening._centred(np.array([[big, 1]]), 4, total)
    assert [int(g) for g in gap[0]] == [5, -6] and whitening._deviation(gap).to_pylist() == [61]
    assert whitening._deviation(np.array([[1 << 40, 0]], dtype=object)).to_pylist() == [None]


def test_spectra_combine_as_one(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 50, size=(400, 5)) + whitening.SHIFT
    fit = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(20)
    s = whitening.decompose(fit)
    y = x - x.mean(0)
    assert s.n == 400 and np.allclose(s.mean, x.mean(0) - whitening.SHIFT) and np.allclose(s.d, np.linalg.eigvalsh(y.T @ y), rtol=1e-10)
