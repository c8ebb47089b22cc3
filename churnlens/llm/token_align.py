"""Cross-tokenizer alignment by interval coalescing.

Each text is encoded twice: a space and the text by a byte-level BPE (A), the
text by a piece model that puts the space in front itself (B).  Both
tokenizations tile the same bytes, so every token is an interval of them.

* All A and B intervals are sorted by start; where a start reaches the running
  maximum of the ends before it (``maximum.accumulate``), a group ends.
* Within the groups every A token is linked with the B tokens it overlaps.
* An id pair's count is the number of documents that hold it linked.  Texts are
  taken in *bundles* of bounded size: a bundle has its distinct pairs once, with
  how many of its documents hold them, and its documents point into that list.
  The pairs are counted over all bundles, each bundle asks for the counts of
  its own pairs, and the documents' sums are made in the bundle.  Links are
  never exchanged, and nothing of the corpus goes through the driver.

Pairs that every bundle holds are hot join keys; bundles are dealt over
``SALTS`` and the counts, which the two vocabularies bound, are repeated.

Defined cases: null and empty texts, and texts whose joined A or B bytes are not
space+text (a text that holds U+2581, say), have no tokens: zeros and an empty
``groups_sha256``.  Null or repeated ids and repeated rows are documents of
their own; an empty table gives no rows; further columns are ignored.  A text
longer than a bundle is a bundle of its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from churnlens.llm.common import batch_rows, stored

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: UTF-8 bytes of texts after which a bundle is closed; tasks over which a hot pair is dealt.
BUNDLE_BYTES, SALTS = 2 << 20, 16


# ------------------------------------------------------------- tokenizers
def _byte_chars() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE -> byte: printable Latin-1 stands for itself, the others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder A from a ``tokenizers`` file: ids of a text, and the bytes of each id.

    Where the file's merges are in the order of their ids, ids are ranks, and
    the same encoding is run by ``tiktoken``, which is faster.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of, special = _byte_chars(), {t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if i not in special}
        self.bytes = [b""] * (1 + max([*vocab.values(), *special]))
        for t, i in vocab.items():
            self.bytes[i] = bytes(of[c] for c in t)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        made = [vocab["".join(p)] for p in pairs]
        split = spec.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
        if plain and made == sorted(made) and len(made) + 256 == len(vocab):
            import tiktoken

            ranks = {self.bytes[i]: i for i in vocab.values()}
            words = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.ids = tiktoken.Encoding("bytes", pat_str=words, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True  # their strings in a text are plain text
            self.ids = lambda text: whole.encode(text, add_special_tokens=False).ids


class Pieces:
    """Encoder B from a ``sentencepiece`` model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids = sp.encode
        self.bytes = [
            bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
            for i in range(sp.get_piece_size())
        ]


# ------------------------------------------------------------- intervals
def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of every interval: groups break where a start reaches the running maximum of the ends before it."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group


def overlaps(sa: np.ndarray, ea: np.ndarray, sb: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all pairs of intervals that share a byte; each side is sorted and disjoint."""
    first, last = np.searchsorted(eb, sa, "right"), np.searchsorted(sb, ea, "left")
    n = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(sa)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Aligner:
    """Aligns one text at a time with tables that are made once a task."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteBpe(a_path), Pieces(b_path)
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        width = len(str(max(len(self.a.bytes), len(self.b.bytes)))) + 1
        top = max(len(self.a.bytes), len(self.b.bytes))
        # decimal id and what follows it, zero padded to one width
        self.decimal = np.array([[f"{i}{sep}".encode() for i in range(top)] for sep in ",|;"], dtype=f"S{width}")

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """A and B ids of a text, or None where it has no tokens."""
        if not text:
            return None
        want = b" " + text.encode()
        out = []
        for side, t in ((self.a, " " + text), (self.b, text)):
            ids = side.ids(t)
            if b"".join(map(side.bytes.__getitem__, ids)) != want:
                return None
            out.append(np.array(ids, np.int64))
        return out[0], out[1]

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Groups of the A and of the B tokens, and the linked positions in A and in B."""
        ea, eb = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        sa, sb = ea - self.sizes[0][a], eb - self.sizes[1][b]
        group = coalesce(np.concatenate([sa, sb]), np.concatenate([ea, eb]))
        return group[: len(a)], group[len(a) :], *overlaps(sa, ea, sb, eb)

    def digest(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, step: int = 1 << 20) -> str:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``."""
        place = np.concatenate([2 * ga, 2 * gb + 1])
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate([a, b])[order]
        follows = np.where(place[1:] == place[:-1], 0, 1 + place[:-1] % 2)  # after a side's last token: | or ;
        h = hashlib.sha256()
        for i in range(0, len(ids) - 1, step):
            f = follows[i : i + step]
            h.update(self.decimal[f, ids[i : i + len(f)]].tobytes().translate(None, b"\0"))
        h.update(str(ids[-1]).encode())
        return h.hexdigest()


# ------------------------------------------------------------- bundles
_DOC = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()), ("groups_sha256", T.StringType()), ("size", T.IntegerType())]
_PAIRS = "array<struct<a:int,b:int,n:int>>"


def _bundle_schema(id_type: T.DataType) -> T.StructType:
    doc = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(n, t) for n, t in _DOC]])
    return T.StructType(
        [
            T.StructField("bundle", T.LongType()),
            T.StructField("docs", T.ArrayType(doc)),
            T.StructField("pairs", T._parse_datatype_string(_PAIRS)),
            T.StructField("at", T.BinaryType()),  # positions in pairs, int32, the documents' one after the other
            T.StructField("times", T.BinaryType()),  # links of the document at that pair, int32
        ]
    )


def _list_of(struct: pa.StructArray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct)


def _bundler(a_path: str, b_path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        task, count = TaskContext.get().partitionId(), 0
        ids, rows, keys, times, held = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal count, held
            every = np.concatenate([*keys, np.empty(0, np.int64)])
            pair, at, n = np.unique(every, return_inverse=True, return_counts=True)
            n_a, n_b, n_g, n_l, sha, size = zip(*rows)
            long, int32 = pa.int64(), pa.int32()
            docs = pa.StructArray.from_arrays(
                [pa.concat_arrays(ids), *[pa.array(x, long) for x in (n_a, n_b, n_g, n_l)], pa.array(sha, pa.string()), pa.array(size, int32)],
                ["doc_id", *[n for n, _ in _DOC]],
            )
            pairs = pa.StructArray.from_arrays([pa.array(x, int32) for x in (pair >> 32, pair & 0xFFFFFFFF, n)], ["a", "b", "n"])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | count], long),
                    _list_of(docs),
                    _list_of(pairs),
                    pa.array([at.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([np.concatenate([*times, np.empty(0, np.int32)]).tobytes()], pa.binary()),
                ],
                ["bundle", "docs", "pairs", "at", "times"],
            )
            count, held = count + 1, 0
            for x in (ids, rows, keys, times):
                x.clear()
            return out

        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                tokens = aligner.tokens(texts[i].as_py())
                ids.append(names.slice(i, 1))
                if tokens is None:
                    rows.append((0, 0, 0, 0, "", 0))
                    held += 64
                else:
                    a, b = tokens
                    ga, gb, la, lb = aligner.align(a, b)
                    pair, n = np.unique(a[la] << 32 | b[lb], return_counts=True)
                    keys.append(pair)
                    times.append(n.astype(np.int32))
                    rows.append((len(a), len(b), int(ga[-1]) + 1, len(la), aligner.digest(a, b, ga, gb), len(pair)))
                    held += int(aligner.sizes[0][a].sum())
                if held >= limit:
                    yield close()
        if rows:
            yield close()

    return run


def _finish(bundle: pa.Table, asked: pa.Table) -> pa.Table:
    """The documents of one bundle with the sums of their links' counts."""
    order = np.argsort(asked.column("pos").to_numpy())
    count, best = asked.column("docs").to_numpy()[order], asked.column("best").to_numpy()[order]
    docs = bundle.column("docs").combine_chunks().flatten()
    at = np.frombuffer(bundle.column("at")[0].as_py(), np.int32)
    times = np.frombuffer(bundle.column("times")[0].as_py(), np.int32).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(docs.field("size").to_numpy())])
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * count[at])]
    n_best, count_sum = (s[ends[1:]] - s[ends[:-1]] for s in sums)
    fields = {n: docs.field(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    fields |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()), "groups_sha256": docs.field("groups_sha256")}
    return pa.table(fields)


def pair_counts(bundles: DataFrame) -> DataFrame:
    """(a, b, docs, best): documents that hold an id pair linked, and whether no other pair of that A id has more."""
    pairs = bundles.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.n").alias("docs"))
    # at most as many rows an A id as B has ids
    return pairs.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def align_report(docs: DataFrame, tokenizers: str = TOKENIZERS, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """One row per document: token, group and link counts, links at their A id's commonest pair, sum of the links' counts, digest."""
    schema = _bundle_schema(docs.schema["doc_id"].dataType)
    make = _bundler(f"{tokenizers}/{BYTE_BPE}", f"{tokenizers}/{PIECES}", bundle_bytes)
    with batch_rows(docs.sparkSession, 200):
        bundles = stored(docs.select("doc_id", "text").mapInArrow(make, schema), "align-bundles")
    counts = stored(pair_counts(bundles), "align-pairs")
    salt = F.pmod(F.col("bundle"), F.lit(SALTS)).cast("int").alias("salt")
    each = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    asks = bundles.select("bundle", salt, F.posexplode("pairs").alias("pos", "p")).select("bundle", "salt", "pos", "p.a", "p.b")
    asked = asks.join(counts.select("*", each).hint("merge"), ["a", "b", "salt"]).select(F.col("bundle").alias("asking"), "pos", "docs", F.col("best").cast("int").alias("best"))
    out = T.StructType([schema["docs"].dataType.elementType["doc_id"]])
    for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        out = out.add(n, T.LongType())
    left = bundles.select("bundle", "docs", "at", "times").groupBy("bundle")
    return left.cogroup(asked.groupBy("asking")).applyInArrow(_finish, out.add("groups_sha256", T.StringType()))


def align_texts(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """doc_id and groups array<struct<a array<int>, b array<int>>>: the ids of both sides, group by group (empty without tokens)."""
    a_path, b_path = f"{tokenizers}/{BYTE_BPE}", f"{tokenizers}/{PIECES}"
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]).add("groups", T._parse_datatype_string("array<struct<a:array<int>,b:array<int>>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, groups = aligner.tokens(batch.column(1)[i].as_py()), []
                if tokens is not None:
                    ga, gb, _, _ = aligner.align(*tokens)
                    cut = [np.split(ids, np.flatnonzero(np.diff(g)) + 1) for ids, g in zip(tokens, (ga, gb))]
                    groups = [{"a": x.tolist(), "b": y.tolist()} for x, y in zip(*cut)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([groups], kind)], ["doc_id", "groups"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
