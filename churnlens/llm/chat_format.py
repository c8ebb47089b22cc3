"""Chat formatting: speaker roles of raw transcripts by a hidden Markov model.

A transcript is an ordered sequence of segments (rows conv_id, seq, text); a
segment's lines are the observations.  Hidden states are (role, first line of
a turn / further line).  A line's features are its speaker marker, a blank
line before it, its length, its last character and its first one.  Viterbi
finds the most likely states, and every recovered turn is rendered in one
canonical form: ``<|role|>\\n`` text ``\\n<|end|>``.

Tables of the model are counted on a bounded sample of conversations with
known roles (``SAMPLE`` conversations, smallest hash of conv_id).

A transcript may be of any length: it is cut into blocks of ``BLOCK`` segments
by their number in it, whatever seq says.  Per block, the best score from every state before it to every state
at its end is a small max-plus matrix; a scan over the matrices of a
transcript gives the states at its block borders, and each block is then
decoded between them, which is exactly the Viterbi path of the whole.  Segments
of long transcripts are numbered by a range partitioning and the counts of its
parts.  Blocks are formed by partitioning and sorting rows, never by a group of a whole
transcript; only transcripts of several blocks take part in the scan.

Defined cases: a null seq counts as -1 (first), a null text as empty, null
conv_ids form one transcript; rows that repeat conv_id, seq and text count
once, other rows of one seq follow in order of their text; a transcript
without any line of text gives no turns; ties prefer the state listed first;
roles other than the three are left out of training; without trainable rows
the counts are those of smoothing alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from churnlens.llm.common import bounded_batches, bounded_sample, stored

ROLES = ("system", "user", "assistant")
#: role r: state 2r begins a turn, 2r + 1 goes on
STATES = 2 * len(ROLES)
SAMPLE = 2000
BLOCK = 256

_SPEAKERS = {
    "system": 0, "instructions": 0, "context": 0, "sys": 0,
    "user": 1, "human": 1, "q": 1, "question": 1, "customer": 1, "instruction": 1, "prompt": 1, "me": 1, "you": 1,
    "assistant": 2, "ai": 2, "a": 2, "answer": 2, "bot": 2, "response": 2, "agent": 2, "model": 2, "gpt": 2,
}
_MARKER = re.compile(r"^\s*(?:<\|\s*([A-Za-z]{1,14})\s*\|>|\[\s*([A-Za-z]{1,14})\s*\]\s*:?|(?:#{1,4}\s*|\*{0,2})([A-Za-z]{1,14})\*{0,2}\s*[:>]\*{0,2})[ \t]*")
_SIZES = (4, 2, 5, 4, 3)


def marker_of(line: str) -> tuple[int, int]:
    """(0 none, 1-3 a role's marker; length of the marker)."""
    m = _MARKER.match(line)
    if not m:
        return 0, 0
    role = _SPEAKERS.get((m[1] or m[2] or m[3]).lower())
    return (0, 0) if role is None else (role + 1, m.end())


def observe(line: str, blank_before: bool) -> tuple[int, ...]:
    """Categorical features of a line."""
    s = line.strip()
    n = len(s)
    last = {"?": 1, ":": 2, ".": 3}.get(s[-1:], 0)
    first = 1 if s[:1] in ("-", "*", "#", "`") or s[:2].rstrip(".").isdigit() else 2 if s[:1].islower() else 0
    return marker_of(line)[0], int(blank_before), (n > 0) + (n > 20) + (n > 60) + (n > 150), last, first


def _lines(texts: list[str | None], blank: bool = True) -> tuple[list[str], list[tuple[int, ...]]]:
    lines = [x for t in texts for x in (t or "").split("\n")]
    seen = []
    for x in lines:
        seen.append(observe(x, blank))
        blank = not x.strip()
    return lines, seen


def _emissions(seen: list[tuple[int, ...]], tables: list[np.ndarray]) -> np.ndarray:
    o = np.array(seen, int).reshape(len(seen), len(_SIZES))
    return sum(t[:, o[:, k]] for k, t in enumerate(tables)).T


def _path(emit: np.ndarray, step: np.ndarray, before: np.ndarray, last: int | None) -> np.ndarray:
    """Viterbi states; ``before`` are the scores of entering each state at the first line."""
    best = before + emit[0]
    back = np.zeros(emit.shape, np.int8)
    for i in range(1, len(emit)):
        s = best[:, None] + step
        back[i] = s.argmax(0)
        best = s.max(0) + emit[i]
    out = np.empty(len(emit), np.int8)
    out[-1] = best.argmax() if last is None else last
    for i in range(len(emit) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def _matrix(emit: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best score to each state at the lines' end: from each state before them, and (last row) from a start."""
    m = np.vstack([step, start]) + emit[0]
    for e in emit[1:]:
        m = (m[:, :, None] + step[None]).max(1) + e
    return m


def fit_model(turns: list[tuple[str, list[tuple[str, str]]]]):
    """Log tables (start, transitions, emissions) from (conversation, [(role, raw segment)])."""
    start, step = np.ones(STATES) * 0.1, np.ones((STATES, STATES)) * 0.1
    tables = [np.ones((STATES, n)) for n in _SIZES]
    for _, segments in turns:
        prev, blank = None, True
        for role, text in segments:
            r = ROLES.index(role)
            for i, line in enumerate(text.split("\n")):
                # the blank line that parts turns ends the turn before it
                if i == 0 or prev is None:
                    s = 2 * r
                else:
                    s = 2 * r + 1
                for t, o in zip(tables, observe(line, blank)):
                    t[s, o] += 1
                if prev is None:
                    start[s] += 1
                else:
                    step[prev, s] += 1
                prev, blank = s, not line.strip()
    log = lambda t: np.log(t / t.sum(-1, keepdims=True))
    return log(start), log(step), [log(t) for t in tables]


# ------------------------------------------------- raw transcripts of a table with roles

#: Ways in which chat logs mark speakers, as (user, assistant, system).
STYLES = (
    ("User: ", "Assistant: ", "System: "),
    ("Human: ", "AI: ", "System: "),
    ("Q: ", "A: ", "Context: "),
    ("<|user|>", "<|assistant|>", "<|system|>"),
    ("### Instruction: ", "### Response: ", "### System: "),
    ("[user] ", "[assistant] ", "[system] "),
    ("", "", ""),
)
#: In ten, markers that a log lacks.
LOST = 2


def raw_segment(conv: object, seq: object, role: str | None, text: str | None) -> str:
    """A turn as a raw log has it: marked in the conversation's style or, now and then, not at all; a blank line follows."""
    style = STYLES[zlib.crc32(f"style {conv}".encode()) % len(STYLES)]
    lost = zlib.crc32(f"lost {conv} {seq}".encode()) % 10 < LOST
    mark = "" if lost or role not in ROLES else style[(2, 0, 1)[ROLES.index(role)]]
    return f"{mark}{text or ''}\n"


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """conv_id, seq, text of the raw logs of a table (conv_id, turn, role, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [raw_segment(*x) for x in zip(*(b[c].to_pylist() for c in ("conv_id", "turn", "role", "text")))]
            yield pa.RecordBatch.from_arrays([b["conv_id"], b["turn"], pa.array(text, pa.string())], names=["conv_id", "seq", "text"])

    kinds = [turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, f"conv_id {kinds[0]}, seq {kinds[1]}, text string")


def train(turns: DataFrame, conversations: int = SAMPLE):
    """The model from raw logs of at most ``conversations`` conversations with known roles."""
    ids = bounded_sample(turns.where("conv_id IS NOT NULL").select("conv_id").distinct(), "conv_id", conversations)
    rows = turns.join(F.broadcast(ids), "conv_id").where(F.col("role").isin(*ROLES)).select("conv_id", "turn", "role", "text")
    # a conversation's first BLOCK turns: bounds the sample whatever a conversation's length; tasks send that many at most
    first = Window.partitionBy("conv_id").orderBy(F.coalesce("turn", F.lit(-1)), F.coalesce("text", F.lit("")), "text", "role")
    rows = rows.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= BLOCK).drop("nth").collect()
    by: dict = {}
    for r in sorted(rows, key=lambda r: (str(r["conv_id"]), -1 if r["turn"] is None else r["turn"], r["text"] or "")):
        by.setdefault(str(r["conv_id"]), []).append((r["role"], raw_segment(r["conv_id"], r["turn"], r["role"], r["text"])))
    return fit_model(list(by.items()))


# ---------------------------------------------------------------- decoding


def _groups(batches: Iterator[pa.RecordBatch], *extra: str) -> Iterator[tuple[tuple, list[str | None], tuple]]:
    """((conv_id, block), texts, extra columns) of rows sorted by them."""
    key, texts, more = None, [], ()
    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in ("conv_id", "block", "text", *extra))):
            if row[:2] != key:
                if key is not None:
                    yield key, texts, more
                key, texts, more = row[:2], [], row[3:]
            texts.append(row[2])
    if key is not None:
        yield key, texts, more


def _blocks(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, seq, text) with the block of their number in the transcript, and whether there are several blocks."""
    same = lambda c: F.col("conv_id").eqNullSafe(F.col(c))
    long = stored(rows.groupBy("conv_id").count().where(F.col("count") > BLOCK).select(F.col("conv_id").alias("long")), "chat-long")
    short = rows.join(long, same("long"), "left_anti").withColumns({"block": F.lit(0).cast("bigint"), "several": F.lit(False)})
    if long.isEmpty():
        return short
    # parts in order of (conv_id, seq, text); ids go on by one within a part
    some = rows.join(long, same("long"), "left_semi")
    some = some.repartitionByRange("conv_id", "seq", F.substring("text", 1, 1000)).sortWithinPartitions("conv_id", "seq", "text")
    some = stored(some.withColumn("id", F.monotonically_increasing_id()), "chat-ids").withColumn("part", F.shiftright("id", 33))
    parts = some.groupBy("conv_id", "part").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    parts = parts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), (before - F.col("least")).alias("shift"))
    some = some.join(parts, same("c") & (F.col("part") == F.col("p")))
    return short.unionByName(some.select("conv_id", "seq", "text", F.floor((F.col("id") + F.col("shift")) / BLOCK).alias("block"), F.lit(True).alias("several")))


def recover_turns(transcripts: DataFrame, model) -> DataFrame:
    """conv_id, block, turn (in the block), role, continued (from the block before), text, rendered."""
    bounded_batches(transcripts.sparkSession)
    start, step, tables = model
    kind = transcripts.schema["conv_id"].dataType.simpleString()
    seq = F.coalesce(F.col("seq").cast("bigint"), F.lit(-1))
    rows = transcripts.select("conv_id", seq.alias("seq"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _blocks(stored(rows.groupBy("conv_id", "seq", "text").agg(F.lit(1).alias("one")).drop("one"), "chat-rows"))
    dealt = lambda d: d.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "seq", "text")
    # transcripts of several blocks: states at the borders
    some = rows.where("several")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, block), texts, _ in _groups(batches):
            m = _matrix(_emissions(_lines(texts)[1], tables), start, step)
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "block": block, "m": m.ravel().tolist()}], pa.schema([("conv_id", key), ("block", pa.int64()), ("m", pa.list_(pa.float64()))]))

    def scan(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        ms = [np.array(x).reshape(STATES + 1, STATES) for x in t["m"].to_pylist()]
        best, back = ms[0][STATES], []
        for m in ms[1:]:
            s = best[:, None] + m[:STATES]
            back.append(s.argmax(0))
            best = s.max(0)
        ends = [int(best.argmax())]
        for b in reversed(back):
            ends.append(int(b[ends[-1]]))
        ends.reverse()
        return pa.table({"conv_id": t["conv_id"], "block": t["block"], "before": pa.array([-1, *ends[:-1]], pa.int32()), "last": pa.array(ends, pa.int32())})

    key = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    borders = dealt(some).mapInArrow(matrices, f"conv_id {kind}, block bigint, m array<double>")
    borders = borders.groupBy("conv_id").applyInArrow(scan, f"conv_id {kind}, block bigint, before int, last int")
    borders = borders.select(F.col("conv_id").alias("c"), F.col("block").alias("k"), "before", "last")
    ready = rows.join(borders, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("k")), "left").drop("c", "k")
    out_type = pa.schema(
        [("conv_id", key), ("block", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("continued", pa.bool_()), ("text", pa.string()), ("rendered", pa.string())]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for (conv, block), texts, (before, last) in _groups(batches, "before", "last"):
            lines, seen = _lines(texts)
            path = _path(_emissions(seen, tables), step, start if before is None or before < 0 else step[before], last)
            turns: list[tuple[str, bool, list[str]]] = []
            for line, s in zip(lines, path.tolist()):
                role = ROLES[s // 2]
                if s % 2 == 0 or not turns or turns[-1][0] != role:
                    turns.append((role, s % 2 == 1, []))
                    line = line[marker_of(line)[1] :]
                turns[-1][2].append(line)
            n = 0
            for role, goes_on, ls in turns:
                text = "\n".join(ls).strip()
                if text:
                    out.append({"conv_id": conv, "block": block, "turn": n, "role": role, "continued": goes_on, "text": text, "rendered": f"<|{role}|>\n{text}\n<|end|>"})
                    n += 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, out_type)
                out = []
        yield pa.RecordBatch.from_pylist(out, out_type)

    schema = f"conv_id {kind}, block bigint, turn int, role string, continued boolean, text string, rendered string"
    return dealt(ready).mapInArrow(decode, schema)


def format_chats(turns: DataFrame) -> DataFrame:
    """Recovered and rendered turns of the raw logs of a table (conv_id, turn, role, text)."""
    return recover_turns(raw_transcripts(turns), train(turns))
