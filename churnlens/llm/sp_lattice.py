"""SentencePiece encoding and decoding over a relational lattice.

A text is normalised as SentencePiece does (a leading space, spaces written as
U+2581) and cut into *units*: a run of spaces with the letters, or with the
other characters, that follow.  No piece of the vocabulary crosses from
letters to other characters or into a space (``read_pieces`` verifies it), so
the best path of a text is the best paths of its units, joined.

* Documents are bundled (``BUNDLE_CHARS`` characters).  A bundle asks for its
  distinct units, one compressed list per shard (hash of the unit), and keeps
  its texts as unit numbers; both go through one exchange by shard.
* The distinct units of a shard are the words of the lattice: substrings
  up to ``HEAD`` characters are exploded and equi-joined to the piece table
  (a vocabulary file, so its broadcast is bounded; a longer piece is joined by
  its head and then compared); edges are grouped by unit; ``aggregate``
  folds Viterbi over the ends and a second fold walks the back pointers.
* Answers go back per (bundle, shard) to the partition that has the bundle's unit
  numbers, whose pieces are then put together.  No text is read twice or exchanged.

A piece that others spell with a better sum of scores is on no best path;
``useful_pieces`` leaves it out of the table.

No word list is broadcast or collected: memory is bounded by a bundle and by
the units of one shard.  Shards follow ``spark.sql.shuffle.partitions``.

The best path maximises the sum of piece scores; ties prefer the longer last
piece.  A character without a piece costs 10 below the least score and is
written as byte pieces.  A unit longer than ``WINDOW`` code points is folded
window by window, each from the last ends of the one before, so its path is the
best of the whole unit at a cost that grows with its length.  All of its ends
are in one row (some hundred bytes a code point).

Defined cases: null and empty texts have no pieces and decode to the empty
text; U+2581 in a text decodes to a space, everything else round-trips;
repeated rows, null or repeated ids and further columns don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from churnlens.llm.common import bounded_batches
from churnlens.llm.elias_fano import from_buffer, to_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BUNDLE_CHARS = 8_000_000
#: Ends that are folded at a time; at least the longest piece.
WINDOW = 512
#: Substrings are joined up to this length.
HEAD = 5
MIN_SHARDS = 64
#: Documents of an Arrow batch that is returned.
BATCH = 200
_LETTER = r"\p{L}\p{M}"
_UNIT = regex.compile(f"{SPACE}*+(?:[{_LETTER}]++|[^{_LETTER}{SPACE}]++)|{SPACE}++")


@lru_cache(maxsize=2)
def read_pieces(model: str = MODEL) -> tuple[list[tuple[str, int, float]], list[int], float, int]:
    """(piece, id, score) of the ordinary pieces; ids of the 256 byte pieces; score of an unknown character; longest piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, of_byte = [], [0] * 256
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            of_byte[int(p[1:-1], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            if not _UNIT.fullmatch(p):
                raise ValueError(f"piece {p!r} crosses the boundary of two units")
            pieces.append((p, i, sp.get_score(i)))
    return pieces, of_byte, min(s for _, _, s in pieces) - 10.0, max(len(p) for p, _, _ in pieces)


def useful_pieces(pieces: list[tuple[str, int, float]], unknown: float, longest: int) -> list[tuple[str, int, float]]:
    """The pieces that can be on a best path: no split of theirs has a better score."""
    score = {p: s for p, _, s in pieces}

    def best_split(p: str) -> float:
        best = [0.0] + [-np.inf] * len(p)
        for e in range(1, len(p) + 1):
            for z in range(1, min(e, longest, len(p) - 1) + 1):
                s = score.get(p[e - z : e], unknown if z == 1 else -np.inf)
                best[e] = max(best[e], best[e - z] + s)
        return best[-1]

    return [x for x in pieces if len(x[0]) == 1 or best_split(x[0]) <= x[2]]


def tokens(text: str | None) -> list[str]:
    """Parts of a text, each of which stands for a space and itself; further spaces before a part belong to it."""
    if not text:
        return []
    if SPACE in text:
        text = text.replace(SPACE, " ")
    parts = text.split(" ")
    if "" not in parts:
        return parts
    out, run = [], ""
    for x in parts:
        if x:
            out.append(run + x)
            run = ""
        else:
            run += SPACE
    if run:
        out.append(run[1:])
    return out


def units(token: str) -> list[str]:
    if len(token) > 1:  # words of letters, bare or with one mark behind them, need no pattern
        if token.isalpha():
            return [SPACE + token]
        if token[-1] in ".,;:!?" and token[:-1].isalpha():
            return [SPACE + token[:-1], token[-1]]
    return _UNIT.findall(SPACE + token)


def _shard(unit: str, n: int) -> int:
    return xxh64_intdigest(unit.encode("utf-8", "surrogatepass")) % n


def _pack(parts: list[str]) -> bytes:
    # a unit can't be empty, so lengths and joined text part it again
    body = "".join(parts).encode("utf-8", "surrogatepass")
    head = np.array([len(parts), *map(len, parts)], np.uint16 if max(map(len, parts), default=0) < 65536 and len(parts) < 65536 else np.uint32)
    return bytes([head.itemsize]) + zstandard.compress(head.tobytes() + body, 3)


def _unpack(blob: bytes) -> list[str]:
    size = blob[0]
    raw = zstandard.decompress(blob[1:])
    kind = np.uint16 if size == 2 else np.uint32
    n = int(np.frombuffer(raw, kind, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, kind, n, size).astype(np.int64)).tolist()
    body = raw[size * (n + 1) :].decode("utf-8", "surrogatepass")
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list, list[str | None]]]:
    """(bundle id, doc_ids, texts).  The id is a digest of the content: equal bundles ask the same."""
    ids: list = []
    texts: list[str | None] = []
    n = 0

    def flush():
        parts = [(b"-" if t is None else b"=" + t.encode("utf-8", "surrogatepass")) for t in texts]
        return xxh3_128_digest(b"\xff".join(parts)), ids, texts

    for b in batches:
        for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
            ids.append(i)
            texts.append(t)
            n += len(t) if t else 0
            if n >= BUNDLE_CHARS:
                yield flush()
                ids, texts, n = [], [], 0
    if texts:
        yield flush()


def _numbered() -> defaultdict[str, int]:
    """Numbers strings in the order in which they are first asked for."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    return number


def _in_units(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct units of the texts; all texts as unit numbers; how many each text has."""
    token, unit = _numbered(), _numbered()
    rows = []
    for t in texts:
        parts = tokens(t)
        rows.append(np.fromiter(map(token.__getitem__, parts), np.uint32, len(parts)))
    ends = np.cumsum([0, *map(len, rows)])
    row = np.concatenate(rows)
    del rows
    cut = [units(x) for x in token]
    fan = np.fromiter(map(len, cut), np.int64, len(cut))
    parts = np.fromiter((unit[u] for us in cut for u in us), np.uint32, int(fan.sum()))
    del cut
    size = fan[row]
    per_text = np.diff(np.concatenate([[0], np.cumsum(size)])[ends])
    return list(unit), parts[_ranges((np.cumsum(fan) - fan)[row], size)], per_text


def _blob(**arrays: np.ndarray) -> bytes:
    return zstandard.compress(to_bytes(arrays), 1)


def _arrays(blob: bytes) -> dict[str, np.ndarray]:
    return from_buffer(np.frombuffer(zstandard.decompress(blob), np.uint8))


#: Lists of units have no ``part``, answers the shard they are from, and texts a body.
_ROWS = "bundle binary, shard int, part int, units binary, body binary, ids array<bigint>"


def _home(bundle: bytes, numbers: list[int]) -> int:
    """The shard in whose partition a bundle's texts wait for the answers."""
    return numbers[int.from_bytes(bundle[:8]) % len(numbers)]


def _rows(bundles: list[bytes], shards: list[int], parts: list[int | None], units: list[bytes | None], bodies: list[bytes | None], ids: list[list | None]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((bundles, shards, parts, units, bodies, ids), kinds)], names=["bundle", "shard", "part", "units", "body", "ids"])


def _ask(numbers: list[int]):
    """Per bundle a list of distinct units for each shard, and a row of all texts as unit numbers with their doc_ids."""
    shards = len(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle, ids, texts in _bundles(batches):
            names, row, per_text = _in_units(texts)
            spaced = np.array([SPACE in t if t else False for t in texts], bool)
            del texts
            shard = np.fromiter((_shard(u, shards) for u in names), np.uint32, len(names))
            order = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(shards + 1))
            lists = [(numbers[s], _pack([names[i] for i in order[a:b]])) for s, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
            # numbers byte by byte: the high bytes of frequent units, which come first, are mostly 0
            planes = {f"b{k}": (row >> np.uint32(8 * k)).astype(np.uint8) for k in range(4)}
            body = _blob(shard=shard, per_text=per_text, spaced=np.packbits(spaced), **planes)
            n, own = len(lists), _home(bundle, numbers)
            yield _rows([bundle] * (n + 1), [*(s for s, _ in lists), own], [None] * (n + 1), [*(us for _, us in lists), None], [None] * n + [body], [None] * n + [ids])

    return run


def _shard_units(asked: pa.Table) -> list[str]:
    """The distinct units that a shard is asked for, in order."""
    seen: set[str] = set()
    for blob in asked["units"]:
        if blob.is_valid:
            seen.update(_unpack(blob.as_py()))
    return sorted(seen)


def _distinct(asked: pa.Table) -> pa.Table:
    """(shard, k, unit) of one shard: its units with their numbers."""
    us = _shard_units(asked)
    shard = asked["shard"][0].as_py()
    return pa.table({"shard": pa.array([shard] * len(us), pa.int32()), "k": pa.array(range(len(us)), pa.int32()), "unit": pa.array(us, pa.string())})


def _even_numbers(spark: SparkSession, parts: int) -> list[int]:
    """``parts`` numbers that Spark deals to as many partitions, one to each."""
    number = F.col("id").cast("int")
    found = spark.range(parts * 40).groupBy(F.pmod(F.hash(number), F.lit(parts)).alias("part")).agg(F.min(number).alias("number")).collect()
    taken = {r["number"] for r in found}
    spare = (i for i in range(parts * 41) if i not in taken)
    return sorted(taken) + [next(spare) for _ in range(parts - len(taken))]


def best_paths(vocabulary: DataFrame, model: str = MODEL, parts: int = MIN_SHARDS) -> DataFrame:
    """(shard, k, ids) of the units of ``vocabulary`` (shard, k, unit), in ``parts`` partitions by shard."""
    spark = vocabulary.sparkSession
    pieces, of_byte, unknown, longest = read_pieces(model)
    table = [(p[:HEAD], p, len(p), i, float(s)) for p, i, s in useful_pieces(pieces, unknown, longest)]
    table = spark.createDataFrame(table, "head string, piece string, len int, id int, score double")
    # the exchange by shard serves the grouping and the answers
    words = vocabulary.repartition(parts, "shard")
    key = ["shard", "k"]
    base, at, size, n = F.col("base"), F.col("at"), F.col("size"), F.char_length("unit")
    windows = words.select(*key, "unit", F.explode(F.sequence(F.lit(0), n - 1, F.lit(WINDOW))).alias("base"))
    part = F.substring("unit", base + 1, F.lit(WINDOW + longest))
    windows = windows.select(*key, "base", part.alias("part"), (n - base).alias("left"))
    cuts = windows.select(*key, "base", "part", "left", F.explode(F.sequence(F.lit(1), F.least("left", F.lit(WINDOW)))).alias("at"))
    spans = cuts.select(*key, "base", "part", "at", F.explode(F.sequence(F.lit(1), F.least(F.col("left") - at + 1, F.lit(HEAD)))).alias("size"))
    spans = spans.select(*key, "base", "part", "at", "size", F.substring("part", at, size).alias("head"))
    hits = spans.join(F.broadcast(table), "head", "left")
    whole = (F.col("len") == size) | (F.substring("part", at, F.col("len")) == F.col("piece"))
    # single characters always make an edge, so that every end can be reached
    hits = hits.where(whole | ((size == 1) & F.col("id").isNull()))
    size = F.coalesce("len", F.lit(1))
    # a character without a piece: its code point, below 0
    edge = [(base + at + size - 1).alias("end"), F.coalesce("score", F.lit(unknown)).alias("score"), size.alias("size"), F.coalesce("id", -1 - F.ascii("head")).alias("id")]
    lattice = hits.select(*key, F.struct(*edge).alias("edge")).groupBy(*key).agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    # forward, over the edges by end: ``best`` has (score, size, id) of the best path to each end from ``off`` on, ``cur`` that of the
    # end after them, so far; equal scores: the longer piece
    way = "struct<score:double,size:int,id:int>"
    start = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("size"), F.lit(0).alias("id")).cast(way)
    nothing = F.struct(F.array().cast(f"array<array<{way}>>").alias("runs"), F.lit(0).alias("off"), F.array().cast(f"array<{way}>").alias("best"), start.alias("cur"))

    def state(runs: Column, off: Column, best: Column, cur: Column) -> Column:
        return F.struct(runs.alias("runs"), off.alias("off"), best.alias("best"), cur.alias("cur"))

    def reach(s: Column, y: Column) -> Column:
        """``s`` with the edge y, which ends at the current end or at the next."""
        new = y["end"] > s["off"] + F.size(s["best"])
        before = F.get(s["best"], y["end"] - y["size"] - s["off"])["score"]
        score = F.when(new & (y["size"] == 1), s["cur"]["score"]).otherwise(before) + y["score"]
        reached = F.struct(score.alias("score"), y["size"].alias("size"), y["id"].alias("id"))
        grown = F.concat(s["best"], F.array(s["cur"]))
        # a full run is put aside and the next begins with its last ends
        kept = F.slice(grown, F.lit(WINDOW + 1), F.lit(longest))
        turned = state(F.concat(s["runs"], F.array(grown)), s["off"] + WINDOW, kept, reached)
        longer = F.when(F.size(s["best"]) + 1 >= WINDOW + longest, turned).otherwise(state(s["runs"], s["off"], grown, reached))
        return F.when(new, longer).otherwise(state(s["runs"], s["off"], s["best"], F.greatest(s["cur"], reached)))

    folded = lattice.select(*key, F.aggregate("edges", nothing, reach, lambda s: F.concat(s["runs"], F.array(F.concat(s["best"], F.array(s["cur"]))))).alias("runs"))
    last = F.size(F.element_at("runs", -1)) - 1
    folded = folded.select(*key, "runs", ((F.size("runs") - 1) * WINDOW + last).alias("n"))
    # backward: from the last end; an end on the path gives its piece
    none, n = F.array().cast("array<int>"), F.col("n")

    def step(s: Column, x: Column) -> Column:
        on = F.struct((s["end"] - x["size"]).alias("at"), (s["end"] - 1).alias("end"), F.concat(F.array(x["id"]), s["ids"]).alias("ids"))
        off = F.struct(s["at"].alias("at"), (s["end"] - 1).alias("end"), s["ids"].alias("ids"))
        return F.when(s["at"] == s["end"], on).otherwise(off)

    def walk(best: Column, at: Column, end: Column) -> Column:
        return F.aggregate(F.reverse(best), F.struct(at.alias("at"), end.alias("end"), none.alias("ids")), step)

    own = F.transform("runs", lambda r, k: F.slice(r, F.when(k == 0, 2).otherwise(longest + 1), F.lit(WINDOW + longest)))
    walks = F.aggregate(
        F.reverse(own),
        F.array(F.struct(n.alias("at"), n.alias("end"), none.alias("ids"))),
        lambda done, w: F.concat(F.array(walk(w, F.get(done, F.lit(0))["at"], F.get(done, F.lit(0))["end"])), done),
    )
    short = walk(F.slice(F.get("runs", F.lit(0)), F.lit(2), n), n, n)["ids"]
    path = folded.select(*key, F.when(F.size("runs") == 1, short).otherwise(F.flatten(F.transform(walks, lambda w: w["ids"]))).alias("ids"))
    # an unknown character becomes the pieces of its bytes
    byte_ids = F.array(*[F.lit(i) for i in of_byte])

    def spelled(i: Column) -> Column:
        point = -1 - i
        first = lambda mark, shift: F.get(byte_ids, F.shiftright(point, shift) + mark)
        rest = lambda shift: F.get(byte_ids, F.shiftright(point, shift).bitwiseAND(F.lit(63)) + 128)
        long = F.when(point < 0x10000, F.array(first(224, 12), rest(6), rest(0))).otherwise(F.array(first(240, 18), rest(12), rest(6), rest(0)))
        return F.when(point < 0x80, F.array(first(0, 0))).when(point < 0x800, F.array(first(192, 6), rest(0))).otherwise(long)

    all_spelled = F.flatten(F.transform("ids", lambda i: F.when(i >= 0, F.array(i)).otherwise(spelled(i))))
    return path.select(*key, F.when(F.array_min("ids") < 0, all_spelled).otherwise(F.col("ids")).alias("ids"))


def _answer(strings: list[str | None], byte_of: dict[int, int], numbers: list[int]):
    """Answers of one shard: per asking bundle the ids of its units in the order asked, and whether they spell the unit."""
    kind = np.uint16 if len(strings) <= 65536 else np.uint32

    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        names = _shard_units(asked)
        known = known.sort_by("k")
        if known["k"].to_pylist() != list(range(len(names))):
            raise RuntimeError("the documents changed between two reads")
        flat = known["ids"].combine_chunks()
        ids = flat.flatten().to_numpy(zero_copy_only=False).astype(kind)
        ends = np.concatenate([[0], np.cumsum(flat.value_lengths().to_numpy(zero_copy_only=False))]) if len(flat) else np.zeros(1, np.int64)
        place = {u: i for i, u in enumerate(names)}
        same = np.array([_spell(ids[a:b].tolist(), strings, byte_of) == u.replace(SPACE, " ") for u, a, b in zip(names, ends, ends[1:])], bool)
        lists = asked.filter(asked["units"].is_valid())
        bundles, blobs = [], []
        for b, blob in dict(zip(lists["bundle"].to_pylist(), lists["units"].to_pylist())).items():
            at = np.fromiter(map(place.__getitem__, _unpack(blob)), np.int64)
            size = (ends[at + 1] - ends[at]).astype(np.uint32)
            bundles.append(b)
            blobs.append(_blob(size=size if size.max() > 255 else size.astype(np.uint8), same=np.packbits(same[at]), ids=ids[_ranges(ends[at], size)]))
        n = len(bundles)
        part = asked["shard"][0].as_py() if n else None
        return pa.Table.from_batches([_rows(bundles, [_home(b, numbers) for b in bundles], [part] * n, blobs, [None] * n, [None] * n)])

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated index ranges start .. start + size."""
    sizes = sizes.astype(np.int64)
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def decode(ids: list[int], pieces: list[str | None], byte_of: dict[int, int]) -> str:
    """Text of piece ids: pieces joined, runs of byte pieces as UTF-8, the leading space dropped."""
    return _spell(ids, pieces, byte_of)[1:]


def _spell(ids: list[int], pieces: list[str | None], byte_of: dict[int, int]) -> str:
    out, run = [], bytearray()
    for i in ids:
        if i in byte_of:
            run.append(byte_of[i])
            continue
        if run:
            out.append(run.decode("utf-8", "replace"))
            run.clear()
        out.append(pieces[i] or "")
    if run:
        out.append(run.decode("utf-8", "replace"))
    return "".join(out).replace(SPACE, " ")


def decode_rows(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, ids): one pass, no shuffle.

    Null and empty ids give the empty text; bytes that aren't UTF-8 are replaced.
    """
    strings, byte_of = piece_strings(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode(ids or [], strings, byte_of) for ids in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")


def piece_strings(model: str = MODEL) -> tuple[list[str | None], dict[int, int]]:
    pieces, of_byte, _, _ = read_pieces(model)
    strings: list[str | None] = [None] * (max([i for _, i, _ in pieces] + of_byte) + 1)
    for p, i, _ in pieces:
        strings[i] = p
    return strings, {i: b for b, i in enumerate(of_byte)}


_ENCODED = pa.schema({"doc_id": pa.int64(), "n_pieces": pa.int64(), "round_trip": pa.bool_(), "ids": pa.list_(pa.int32())})


def _assemble(numbers: list[int]):
    """The documents of one bundle: the pieces of its units, in the order of its texts.  Without texts the rows are what a shard was asked."""

    def run(rows: pa.Table) -> pa.Table:
        texts = rows.filter(rows["body"].is_valid())
        if not len(texts):
            return _ENCODED.empty_table()
        told = rows.filter(rows["part"].is_valid())
        told = dict(zip(told["part"].to_pylist(), told["units"].to_pylist()))
        body = _arrays(texts["body"][0].as_py())  # equal bundles have equal texts
        # pieces of every unit, from the shards' answers in the order asked
        flat, size, good = [np.empty(0, np.uint16)], [np.empty(0, np.int64)], [np.empty(0, np.uint8)]
        asked = np.bincount(body["shard"], minlength=len(numbers))
        for s in np.nonzero(asked)[0]:
            x = _arrays(told.pop(numbers[s]))
            if len(x["size"]) != asked[s]:
                raise RuntimeError("the documents changed between two reads")
            flat.append(x["ids"])
            size.append(x["size"].astype(np.int64))
            good.append(np.unpackbits(x["same"], count=len(x["size"])))
        flat, size, good = np.concatenate(flat), np.concatenate(size), np.concatenate(good)
        start = np.cumsum(size) - size
        # answers are in the order of shards, units in that of their first place
        at = np.empty(len(size), np.int64)
        at[np.argsort(body["shard"], kind="stable")] = np.arange(len(size))
        row = body["b0"].astype(np.uint32)
        for k in range(1, 4):
            row |= body[f"b{k}"].astype(np.uint32) << np.uint32(8 * k)
        row = at[row]
        units_of = np.concatenate([[0], np.cumsum(body["per_text"])])
        ends = np.concatenate([[0], np.cumsum(size[row])])[units_of]
        values = flat[_ranges(start[row], size[row])].astype(np.int32)
        # every unit spells itself, and the units are the whole text; a space sign in it would come back as a space
        bad = np.concatenate([[0], np.cumsum(good[row] == 0)])[units_of]
        same = (np.diff(bad) == 0) & (np.unpackbits(body["spaced"], count=len(ends) - 1) == 0)
        one = pa.table(
            {
                "n_pieces": pa.array(np.diff(ends)),
                "round_trip": pa.array(same),
                "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values)),
            }
        )
        # in small batches, so that neither side holds a bundle's pieces twice
        return pa.Table.from_batches([b for ids in texts["ids"] for b in one.add_column(0, "doc_id", pa.array(ids.values)).to_batches(BATCH)], _ENCODED)

    return run


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, round_trip (whether decoding gives the text back), ids (piece ids), one row per document.

    Should ``docs`` be read twice (a lost executor's exchange is made again) it must
    give the same rows in the same order, as files do; a difference is an error, never a wrong result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shards = max(MIN_SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbers = _even_numbers(spark, shards)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # exchanged once: what follows has all of its columns, so Spark reuses it
    asked = d.mapInArrow(_ask(numbers), _ROWS).repartition(shards, "shard")
    vocabulary = asked.groupBy("shard").applyInArrow(_distinct, "shard int, k int, unit string")
    known = best_paths(vocabulary, model, shards)
    answers = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_answer(*piece_strings(model), numbers), _ROWS)
    # the texts are where they were dealt, and the answers come to them
    return asked.union(answers.repartition(shards, "shard")).groupBy("shard", "bundle").applyInArrow(_assemble(numbers), "doc_id bigint, n_pieces bigint, round_trip boolean, ids array<int>")
