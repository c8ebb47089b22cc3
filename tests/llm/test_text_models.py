"""Encoding, language model, toxicity, chat formatting, extraction and mixing."""

from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from brute import bigram_scores, table, viterbi_pieces
from pyspark.sql import functions as F

from churnlens.llm import chat_format, elias_fano, html_extract, mixing, ngram_lm, sp_lattice, toxicity
from churnlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


# ------------------------------------------------------------ pieces

ODD = [None, "", " ", "   ", "\n\n", "a", "  two  spaces ", "é☃\U0001f600\x00 ﷽", "a▁b", "x" * 3000, "the\tthe\r\nthe", "ab" * 40 + "!?" * 40, "</s><unk><0x0A>"]
# words about and beyond the length that is folded at once
ODD += [" " * 1500 + "w", "=" * 1300, "\U0001f600é" * 700, *("".join(random.Random(n).choices("etaoinshr", k=n)) for n in (510, 511, 512, 513, 1023, 1024, 1025, 4000))]


def test_pieces_match_viterbi_and_round_trip(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    model = (*sp_lattice.read_pieces(), sp_lattice.SPACE)
    strings, byte_of = sp_lattice.piece_strings()
    rows = QUERIES["op5_sentencepiece"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        t = docs[r["doc_id"]]
        assert r["round_trip"] and r["n_pieces"] == len(r["ids"])
        assert sp_lattice.decode(r["ids"], strings, byte_of) == t
        if r["doc_id"] % 4 == 0:
            assert r["ids"] == viterbi_pieces(t, *model)


def test_pieces_of_odd_texts(spark):
    model = (*sp_lattice.read_pieces(), sp_lattice.SPACE)
    strings, byte_of = sp_lattice.piece_strings()
    rows = sp_lattice.encode(_frame(spark, ODD + ODD)).collect()
    assert len(rows) == 2 * len(ODD)
    for r in rows:
        t = ODD[r["doc_id"] % len(ODD)]
        assert r["round_trip"] == ("▁" not in (t or "")), t
        assert sp_lattice.decode(r["ids"], strings, byte_of) == (t or "").replace("▁", " ")
        assert r["ids"] == viterbi_pieces(t, *model), t
    assert sp_lattice.encode(_frame(spark, ODD).limit(0)).count() == 0


def test_pieces_decode_as_rows(spark):
    encoded = sp_lattice.encode(_frame(spark, ODD)).withColumn("text", F.lit(1))
    none = spark.createDataFrame([(None, None), (-1, [])], "doc_id long, ids array<int>")
    got = sp_lattice.decode_rows(encoded.select("doc_id", "ids", "text").unionByName(none, allowMissingColumns=True)).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        t = ODD[r["doc_id"]] if (r["doc_id"] or -1) >= 0 else ""
        assert r["text"] == ("" if r["doc_id"] is None else (t or "").replace("▁", " "))
    assert "Python" not in sp_lattice.decode_rows(none)._jdf.queryExecution().executedPlan().toString().replace("PythonMapInArrow", "")


def test_pieces_read_documents_once_and_exchange_no_text(spark):
    got = sp_lattice.encode(table(spark, "documents"))
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    # the numbered texts with the lists of units, the distinct units, the answers
    assert len([x for x in final.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]) == 3
    assert "ReusedExchange" in final


def test_pieces_of_equal_bundles_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(sp_lattice, "BUNDLE_CHARS", 1)  # numbers of the session are kept: a batch a bundle
    rows = [(1, "one two two"), (1, "one two two"), (None, "one two two"), (2, None)] * 3
    frames = [spark.createDataFrame(rows, "doc_id long, text string").coalesce(1) for _ in range(2)]
    got = [tuple(r[:3]) for r in sp_lattice.encode(frames[0].union(frames[1])).collect()]
    n = next(x[1] for x in got if x[0] == 1)
    assert Counter(got) == Counter({(1, n, True): 12, (None, n, True): 6, (2, 0, True): 6})


# ------------------------------------------------------------ language model


@pytest.mark.parametrize("n, universe", [(0, 1), (1, 1), (1, 2**63), (700, 900), (2000, 2**41), (900, 900)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    e = elias_fano.EliasFano(elias_fano.ef_arrays(v, universe))
    assert (e.access(np.arange(n)) == v).all()
    q = np.concatenate([v, rng.integers(0, universe, 200, dtype=np.uint64)])
    there = set(v.tolist())
    for x, i in zip(q.tolist(), e.find(q).tolist()):
        assert (i >= 0) == (x in there) and (i < 0 or v[i] == x)


def test_elias_fano_halves_long_runs(monkeypatch):
    v = np.arange(50_000, dtype=np.uint64) * np.uint64(3) + np.uint64(1 << 40)  # one run of equal high parts
    e = elias_fano.EliasFano(elias_fano.ef_arrays(v, 1 << 63))
    steps = []
    low = elias_fano.EliasFano._low
    monkeypatch.setattr(elias_fano.EliasFano, "_low", lambda self, i: (steps.append(len(i)), low(self, i))[1])
    q = np.concatenate([v, v + np.uint64(1)])
    assert e.find(q).tolist() == [*range(50_000), *[-1] * 50_000]
    assert len(steps) <= 20


def test_lm_lists_keep_their_arrays():
    arrays = {"a": np.arange(5, dtype=np.uint64) << np.uint64(50), "b": np.zeros(0, np.uint32), "c": np.array([1.5, -2.25, np.inf]), "d": np.arange(20, dtype=np.uint16)[::2]}
    got = ngram_lm.unpack(ngram_lm.pack(**arrays))
    assert {k: (a.dtype, a.tolist()) for k, a in got.items()} == {k: (a.dtype, a.tolist()) for k, a in arrays.items()}
    keys = np.array([3, 3, 2**64 - 1], np.uint64)
    assert ngram_lm._sums(ngram_lm._steps(keys)).tolist() == keys.tolist()


def test_lm_training_writes_lists_not_rows(spark, monkeypatch):
    kept = []
    put = ngram_lm.stored
    monkeypatch.setattr(ngram_lm, "stored", lambda df, name: (kept.append(put(df, name)), kept[-1])[1])
    ngram_lm.train(table(spark, "documents").select("doc_id", "text"), shards=3)
    assert kept and all(df.count() <= 4 * 3 * 3 for df in kept)  # quarters of shards, and what they ask of each shard; words and pairs are packed


def _check_lm(rows, docs):
    want = bigram_scores(docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert math.isclose(r["base_score"], w[3], rel_tol=1e-9)
        assert math.isclose(r["score"], w[4], rel_tol=2e-3, abs_tol=1e-2)  # gains are quantised


def test_lm_query(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    _check_lm(QUERIES["op10_ngram_lm"](spark, SF).collect(), docs)


def test_lm_keeps_pairs_seen_once(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    want = bigram_scores(docs, least=1)
    for r in QUERIES["op10_ngram_lm"](spark, SF).collect():
        assert math.isclose(r["score"], want[r["doc_id"]][4], rel_tol=2e-3, abs_tol=1e-2)


def test_lm_cold_pairs_and_bundles(spark, monkeypatch):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    monkeypatch.setattr(ngram_lm, "BUNDLE_CHARS", 20_000)
    d = table(spark, "documents").select("doc_id", "text")
    model = ngram_lm.train(d.where(~ngram_lm.held_out(F.col("doc_id"))), hot_size=5, shards=3)
    _check_lm(ngram_lm.score(d, model).collect(), docs)


def test_lm_odd_rows(spark):
    docs = dict(enumerate([None, "", " \n", "a", "A a a", "a b " * 200, "b a", "\x0b x"]))
    _check_lm(ngram_lm.score_corpus(_frame(spark, docs.values())).collect(), docs)
    assert ngram_lm.score_corpus(_frame(spark, ["a"]).limit(0)).count() == 0
    nothing = ngram_lm.score_corpus(spark.createDataFrame([(6, "a b")], "doc_id long, text string"))  # crc32('6') % 5 is 1: no training text
    _check_lm(nothing.collect(), {6: "a b"}) if nothing.first()["held_out"] else None
    twice = ngram_lm.score_corpus(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id long, text string")).collect()
    assert len(twice) == 3


# ------------------------------------------------------------ toxicity


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, "documents", sf), table(spark, "labels", sf)
    odd = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(2)) == 1
    out = toxicity.classify(docs, labels.where(odd))
    assert out.count() == docs.count()
    j = out.select("doc_id", F.col("toxic").alias("said")).join(labels.where(~odd).select("doc_id", F.col("toxic").alias("is")), "doc_id")
    n = {(r["is"], r["said"]): r["count"] for r in j.groupBy("is", "said").count().collect()}
    assert n[(1, True)] >= 0.9 * (n[(1, True)] + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.02 * n[(0, False)]


def test_toxicity_without_labels_and_odd_rows(spark):
    docs = _frame(spark, [None, "", "a", "a"])
    none = spark.createDataFrame([(None, 1, 1), (0, None, None)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in toxicity.classify(docs, none).drop("doc_id").collect()} == {(0.0, 0.0, 0.0, False, False)}
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    texts = [f"some words here {'scum' if i % 2 else 'fine'} and more" for i in range(40)] + [None, ""]
    got = {r["doc_id"]: r["toxic"] for r in toxicity.classify(_frame(spark, texts), labels).collect()}
    assert all(got[i] == bool(i % 2) for i in range(40)) and len(got) == 42
    assert toxicity.classify(docs.limit(0), labels).count() == 0


# ------------------------------------------------------------ chats


def test_chat_roles_on_held_out_conversations(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    turns = table(spark, "conversations", sf)
    monkeypatch.setattr(chat_format, "SAMPLE", 40)
    model = chat_format.train(turns, 40)
    got = chat_format.recover_turns(chat_format.raw_transcripts(turns), model).collect()
    want = {(r["conv_id"], r["role"], (r["text"] or "").strip()) for r in turns.collect()}
    mine = {(r["conv_id"], r["role"], r["text"]) for r in got}
    assert len(want & mine) >= 0.95 * len(want)
    assert all(r["rendered"] == f"<|{r['role']}|>\n{r['text']}\n<|end|>" for r in got)


def test_chat_blocks_decode_as_one(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for conv in (1, 2):
        for turn in range(150):
            role = ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, " ".join(rng.choice(("yes", "no", "why?", "ok.")) for _ in range(rng.randint(1, 9)))))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = chat_format.train(turns)
    raw = chat_format.raw_transcripts(turns)

    def lines_and_roles():
        out = {}
        for r in sorted(chat_format.recover_turns(raw, model).collect(), key=lambda r: (r["conv_id"], r["block"], r["turn"])):
            out.setdefault(r["conv_id"], []).extend((x, r["role"]) for x in r["text"].split("\n") if x.strip())
        return out

    whole = lines_and_roles()
    monkeypatch.setattr(chat_format, "BLOCK", 7)
    assert lines_and_roles() == whole


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, None, "user", "Hi"), (None, 0, "tool", "x"), (2, 1, "user", "same"), (2, 1, "user", "same"), (3, 0, None, "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit(1))
    got = {(r["conv_id"], r["text"]) for r in chat_format.format_chats(turns).collect()}
    assert got == {(1, "Hi"), (None, "x"), (2, "same")}
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def test_chat_blocks_hold_block_rows(spark, monkeypatch):
    rng = random.Random(6)
    raw = [(None, None, f"{rng.choice(('User: ', 'AI: ', ''))}line {i}\n") for i in range(300)] + [(1, 3, f"Q: why {i}?\n") for i in range(100)] + [(2, 900, "Human: hi\n")]
    raw = spark.createDataFrame(raw, "conv_id long, seq long, text string")
    turns = spark.createDataFrame([(7, None if i % 2 else 5, "user", f"t{i}") for i in range(90)], "conv_id long, turn long, role string, text string")
    fit, seen = chat_format.fit_model, []
    monkeypatch.setattr(chat_format, "fit_model", lambda by: seen.extend(by) or fit(by))
    model = chat_format.train(turns)

    def decoded():
        rows = sorted(chat_format.recover_turns(raw, model).collect(), key=lambda r: (str(r["conv_id"]), r["block"], r["turn"]))
        lines = [(r["conv_id"], x, r["role"]) for r in rows for x in r["text"].split("\n") if x.strip()]
        most = max(Counter((r["conv_id"], r["block"]) for r in rows for x in r["text"].split("\n") if x.strip()).values())
        return lines, most

    whole, _ = decoded()
    monkeypatch.setattr(chat_format, "BLOCK", 16)
    cut, most = decoded()
    assert cut == whole and most <= 16 and len(cut) == 401
    chat_format.train(turns)
    assert len(seen[-1][1]) == 16


# ------------------------------------------------------------ pages


def test_extraction_of_the_pages(spark):
    import html
    import re

    def article(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", inner)
        texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks)
        return "\n".join(t for t in texts if t)

    pages = {r["page_id"]: r["html"] for r in table(spark, "pages", "/root/testdata/sf0.01").collect()}
    rows = QUERIES["op1_html_extract"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


PAGE = """<!doctype html><html><head><title>no</title><style>p{}</style></head><body>
<header><h1>Site</h1><nav><a href="/">Home</a> <a href="/n">News</a></nav></header><div class="cookie-banner">We use cookies here.</div>
<%s><h1>The title</h1><p>First &amp; foremost,\n  some   words&nbsp;here.<p>Second <b>bold</b> text <a href="x">with a link</a> in it.
<aside class="related"><ul><li><a href="/a">Another story</a><li><a href="/b">More of it</a></ul></aside>
<div class="advert">Buy one now, cheap!</div><p>The last paragraph ends.</p></%s>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with this.</p></div></section>
<form action="/s"><label>Your mail</label><input><button>Go</button></form><script>var a = "<p>not text</p>";</script>
<div class="sidebar"><p>Popular things are listed here.</p></div><footer><p>&copy; the owner</p></footer>"""


@pytest.mark.parametrize("tag", ["article", "main", 'div class="content"', 'div id="post-body"'])
def test_extraction_leaves_boilerplate_out(spark, tag):
    pages = [r["html"] for r in table(spark, "pages").limit(100).collect()]
    model = html_extract.train(pages)
    want = "The title\nFirst & foremost, some words here.\nSecond bold text with a link in it.\nThe last paragraph ends."
    assert html_extract.extract(PAGE % (tag, tag.split()[0]), model) == want


@pytest.mark.parametrize(
    "odd",
    ['<svg viewBox="0 0 1 1"/>', "<button>Go", "<select><option>One<option>Two", '<object data="x">', "<div><button>Go</div>", "<button>Go <b>on</b></button>", "<svg><g><path d='m'/></g></svg>", "<noscript><p>no</p></noscript>", "<svg><path d='m'>"],
)
@pytest.mark.parametrize("place", ["<article><p>First.</p>%s<p>Second.</p></article>", "%s<article><p>First.</p><p>Second.</p></article>", "<article><p>First.</p><p>Second.</p>%s</article>"])
def test_parse_keeps_text_after_odd_elements(odd, place):
    page = f"<html><body>{place % odd}<p>After.</p><button>x</button><svg></svg></body></html>"
    assert [n.text for n in html_extract.preorder(html_extract.parse(page)) if n.tag == "#text"] == ["First.", "Second.", "After."]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div>" * 50 + "</section>x " * 100_000, "x " * 99_999 + "x"),
        ("<x-a>" * 40_000 + "<li>a" * 40_000, None),
        ("<a " * 100_000, "<a " * 99_999 + "<a"),
        ("<p>a</p>" + "<a '\"" * 40_000 + '">"', None),
        ("<p>a<b c='> d<p>e", "a<b c='> d\ne"),
        ("a<!" * 100_000, "a<!" * 100_000),
    ],
)
def test_parse_takes_time_in_proportion(page, text):
    begun = time.process_time()
    got = "\n".join(n.text for n in html_extract.preorder(html_extract.parse(page)) if n.tag == "#text")
    assert time.process_time() - begun < 3
    assert text is None or got == text


def test_toxicity_learns_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(50)] + [(2, "other"), (None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert sorted(r["doc_id"] for r in toxicity._sample(docs, labels, 10).collect()) == [1, 2]


def test_extraction_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>only text here, a paragraph</p>"), (4, "u", "<" * 500), (5, "u", "<div>" * 3000 + "deep"), (6, "u", "<!-- open"), (6, "u", "<!-- open")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(3))
    got = html_extract.extract_pages(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert all(r["text"] == "" for r in got if r["page_id"] in (1, 2, 6))
    assert html_extract.extract_pages(df.limit(0)).count() == 0


def test_decoding_is_consistent():
    nodes = html_extract.preorder(html_extract.parse("<div><p>a</p><p>b</p></div>"))
    tags = [n.tag for n in nodes]
    assert tags == ["#root", "div", "p", "#text", "p", "#text"]
    keep = lambda odds: [n.text for n in html_extract.decode(nodes, np.array(odds, float))]
    assert keep([0, 5, 5, 5, 5, 5]) == ["a", "b"]
    assert keep([0, -9, 1, 1, 1, 1]) == []  # what the children gain doesn't make up for their parent
    assert keep([0, -1, 5, 5, -5, 5]) == ["a"]  # what an ancestor keeps doesn't force a child in


# ------------------------------------------------------------ mixing


def _mix_docs(spark):
    rng = random.Random(8)
    rows = [(i, ("big", "mid", "tiny")[0 if i < 600 else 1 if i < 850 else 2], " ".join("w" for _ in range(rng.randint(1, 30)))) for i in range(900)]
    return spark.createDataFrame(rows + [(900, None, "a b"), (901, "big", None), (902, "mid", "")], "doc_id long, source string, text string")


@pytest.mark.parametrize("targets", [{"max_repeats": 2.0}, {"entropy": 1.0}, {"budget": 4000.0, "max_repeats": 1.0}, {"budget": 30000.0, "entropy": 0.9, "max_repeats": 9.0}, {}])
def test_mixture_meets_its_targets(spark, targets):
    docs = _mix_docs(spark)
    rows = docs.select(*mixing._keyed(docs), mixing.count_tokens(F.col("text")).alias("tokens"))
    m = mixing.plan_mixture(rows, **targets)
    src = {r["mix_key"]: r for r in m.sources.collect()}
    total = sum(r["tokens"] for r in src.values())
    z = sum((r["tokens"] / total) ** m.alpha for r in src.values() if r["tokens"])
    w = {k: (r["tokens"] / total) ** m.alpha / z for k, r in src.items() if r["tokens"]}
    for k, x in w.items():
        assert math.isclose(x, src[k]["weight"], rel_tol=1e-9)
    most = max(w[k] * m.budget / src[k]["tokens"] for k in w)
    entropy = -sum(x * math.log(x) for x in w.values())
    if "max_repeats" in targets and m.alpha < 1:
        assert most <= targets["max_repeats"] + 1e-6
    if "entropy" in targets and "max_repeats" not in targets:
        assert entropy <= targets["entropy"] + 1e-6 and (m.alpha == 0 or entropy >= targets["entropy"] - 1e-3)
    out = mixing.mixture_schedule(docs, **targets).collect()
    used = {}
    for r in out:
        used[r["source"]] = used.get(r["source"], 0) + r["n_tokens"]
    for k, x in w.items():
        name = None if k == "-" else k[1:]
        goal = x * m.budget
        assert goal - 31 <= used.get(name, 0) <= goal + 1e-6
    seen = {(r["doc_id"], r["epoch"]) for r in out}
    assert len(seen) == len(out)  # never twice in an epoch
    if "budget" not in targets:
        assert {d for d, _ in seen} == set(range(903))


def test_mixture_epochs_are_permuted(spark):
    docs = _mix_docs(spark).where("source = 'tiny'").unionByName(_mix_docs(spark).where("source = 'big'"))
    out = [r for r in mixing.mixture_schedule(docs, max_repeats=3.0).collect() if r["source"] == "tiny"]
    by = {}
    for r in out:
        by.setdefault(r["epoch"], {})[r["block"]] = r["block_rank"]
    assert len(by) > 1 and by[0] != by[1]


def test_mix_documents_keeps_columns_and_rows(spark):
    docs = _mix_docs(spark).withColumn("row", F.lit(1)).withColumn("mix_key", F.lit("k")).withColumn("epoch", F.lit(None).cast("int"))
    out = mixing.mix_documents(docs, max_repeats=1.5)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert out.select("doc_id").distinct().count() == 903
    assert out.count() == mixing.mixture_schedule(docs, max_repeats=1.5).count()
    assert mixing.mix_documents(docs.limit(0), max_repeats=1.5).count() == 0
