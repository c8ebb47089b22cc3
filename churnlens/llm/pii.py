"""Personal data: base spans, and identifiers that bootstrapped contexts discover.

The four base kinds (email, ip, card, phone) are found by pattern and check in
every whole text.  They seed a bootstrapped extraction of what their patterns
can't spell:

1. A text is cut into *units*: identifier-like runs (an e-mail, a phone, a
   group of digits, or a run with at least four digits).  A unit whose whole
   core passes a base kind's check is a seed of that kind; any other is unseen.
2. Every unit induces three lexical patterns from the words around it in its
   line: the two before, the two after, one of each.
3. Patterns and instances (a unit's core in lower case) form a graph of
   distinct edges.  A pattern's confidence for a kind is the mass of that kind
   among its instances over the mass of all kinds plus one, where an unseen
   instance weighs ``UNSEEN``; an instance's is the noisy-or of its
   high-confidence patterns.  Accepted instances count as mass
   in the next round, so the patterns around them can become confident too.
4. After ``ROUNDS`` rounds every occurrence of an accepted instance that
   overlaps no base span is a finding ``like_<kind>``.

All of it is DataFrame work: ``split`` and ``regexp_extract_all`` give matches
and the text between them, a running sum per row gives offsets, and the rounds
are joins and aggregates over the written edges.  A frequent pattern or
instance is a hot join key; its edges are dealt over ``SALTS`` and the small
scored side is repeated for each.

The base patterns are spelled so that they take linear time and no recursion:
runs are possessive, and a match may start inside a run only where the match
before it ended (an earlier start in the run would have matched the same way).

Defined cases: null text counts as empty and gives no spans; a null or
repeated ``doc_id`` and repeated rows keep one output row each; an empty table
gives no rows; further columns of the input are ignored; equal starts are
listed by kind; parts of an address may have leading zeros.  An instance that
two kinds claim equally goes to the kind listed first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from churnlens.llm.common import split_words, stored

_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL = rf"{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _is_card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(13, 19), F.call_function("luhn_check", d)).otherwise(F.lit(False))


@dataclass(frozen=True)
class Kind:
    """One base kind.  ``probe`` holds for a text in which ``pattern`` can match."""

    name: str
    probe: Callable[[Column], Column]
    pattern: str
    keep: Callable[[Column], Column]
    whole: str  # what a unit of this kind looks like


#: In the order in which spans are listed.
KINDS = (
    Kind("email", lambda t: t.contains("@"), rf"(?:\G|(?<!{_LOCAL})){_EMAIL}", lambda m: F.lit(True), rf"^{_EMAIL}$"),
    Kind(
        "ip",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        r"^[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++$",
    ),
    Kind("card", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), r"[0-9](?:[\x20-]?[0-9])++", _is_card, r"^[0-9](?:[\x20-]?[0-9])++$"),
    Kind("phone", lambda t: t.contains("+"), _PHONE, lambda m: F.length(_digits(m)).between(9, 15), rf"^{_PHONE}$"),
)

RANK = {k.name: i for i, k in enumerate(KINDS)}

_RUN = "[A-Za-z0-9_./:#-]"
#: Identifier-like runs; the last form has at least four digits.
UNIT = rf"(?<!{_LOCAL}){_EMAIL}|{_PHONE}|[0-9](?:[\x20-]?[0-9]){{8,}}+|(?<!{_RUN})(?=(?:[A-Za-z_./:#-]*+[0-9]){{4}}){_RUN}++"
_EDGE = "[_./:#-]*+"

#: Rounds of scoring; least mass of a pattern; confidence of patterns and instances that count.
ROUNDS, LEAST, SURE_PATTERN, SURE_INSTANCE = 3, 4, 0.8, 0.9
#: Weight of an unseen instance against a pattern; tasks over which a hot key is dealt.
UNSEEN, SALTS = 0.1, 16

_SPAN = "array<struct<rank:int,nth:int,before:int,size:int,ok:boolean>>"
_UNIT = "array<struct<nth:int,before:int,size:int,lead:int,trail:int,core:string,kind:string,patterns:array<string>>>"


def _cut(text: Column, pattern: str) -> Column:
    """All matches in order, as structs of the match ``m`` and the text before and after it, up to the next.

    The pieces are zipped to the matches: a lambda that looked into the array
    of pieces would cut the text again for every match.
    """
    between = F.split(text, pattern, -1)  # one piece more than there are matches
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("before"), F.slice(between, 2, F.size(found)).alias("after"))


def _matches(text: Column, k: Kind) -> Column:
    """The raw matches of a kind, each with the length of the text before it."""
    rows = F.transform(
        _cut(text, k.pattern),
        lambda x, i: F.struct(
            F.lit(RANK[k.name]).alias("rank"),
            i.alias("nth"),
            F.char_length(x["before"]).alias("before"),
            F.char_length(x["m"]).alias("size"),
            k.keep(x["m"]).alias("ok"),
        ),
    )
    return F.when(k.probe(text), rows.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def kind_of(core: Column) -> Column:
    """The first base kind whose whole check the text passes, else null."""
    out = None
    for k in KINDS:
        holds = core.rlike(k.whole) & k.keep(core)
        out = F.when(holds, k.name) if out is None else out.when(holds, k.name)
    return out


def _patterns(before: Column, after: Column, first: Column) -> Column:
    """Patterns around a unit from the text before and after it, up to the units next to it.

    ``^`` and ``$`` stand for a line's ends, ``@`` for another unit.
    """
    edge = F.when(first | before.contains("\n"), F.lit("^")).otherwise(F.lit("@"))
    left, right = split_words(F.lower(F.substring_index(before, "\n", -1))), split_words(F.lower(F.substring_index(after, "\n", 1)))
    l1, l2 = F.coalesce(F.try_element_at(left, F.lit(-1)), edge), F.coalesce(F.try_element_at(left, F.lit(-2)), edge)
    r1, r2 = F.coalesce(F.get(right, F.lit(0)), F.lit("$")), F.coalesce(F.get(right, F.lit(1)), F.lit("$"))
    all_ = F.array(F.concat_ws(" ", l2, l1, F.lit("_")), F.concat_ws(" ", F.lit("_"), r1, r2), F.concat_ws(" ", l1, F.lit("_"), r1))
    return F.filter(all_, lambda p: ~p.rlike(r"^(?:[\^@$] )*_(?: [\^@$])*$"))


def _units(text: Column) -> Column:
    def unit(x: Column, i: Column) -> Column:
        m = x["m"]
        lead = F.length(F.regexp_extract(m, f"^{_EDGE}", 0))
        core = F.regexp_replace(F.regexp_replace(m, f"^{_EDGE}", ""), f"(?<![_./:#-]){_EDGE}$", "")
        return F.struct(
            i.alias("nth"),
            F.char_length(x["before"]).alias("before"),
            F.char_length(m).alias("size"),
            lead.alias("lead"),
            (F.char_length(m) - lead - F.char_length(core)).alias("trail"),
            F.lower(core).alias("core"),
            kind_of(core).alias("kind"),
            _patterns(x["before"], x["after"], i == 0).alias("patterns"),
        )

    return F.when(text.rlike("[0-9@]"), F.transform(_cut(text, UNIT), unit).cast(_UNIT)).otherwise(F.array().cast(_UNIT))


def _placed(rows: DataFrame, *by: str) -> DataFrame:
    """start and end (code points) from the running sum of ``before`` and ``size``."""
    w = Window.partitionBy(*by).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("end", F.sum(F.col("before") + F.col("size")).over(w)).withColumn("start", F.col("end") - F.col("size"))


def _dealt(edges: DataFrame, small: DataFrame, key: str, by: str) -> DataFrame:
    """``edges`` joined with ``small`` on ``key``; a hot key's edges are dealt by hash of ``by``."""
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).alias("salt")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt")
    return edges.select("*", salt).join(small.select("*", each).hint("merge"), [key, "salt"]).drop("salt")


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Accepted instances (core, kind, conf) of distinct edges (pattern, core, kind or null)."""
    names = [k.name for k in KINDS]
    counts = [F.count(F.when(F.col("kind") == n, 1)).alias(n) for n in names]
    unknown = F.count(F.when(F.col("kind").isNull(), 1)).alias("n")
    stats = stored(edges.groupBy("pattern").agg(unknown, *counts), "pii-patterns")
    per_kind = F.explode(F.filter(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(n).cast("double").alias("mass")) for n in names]), lambda x: x["mass"] > 0))
    seeds = stats.select("pattern", "n", per_kind.alias("x")).select("pattern", "n", "x.kind", "x.mass")
    unseen = edges.where(F.col("kind").isNull()).select("pattern", "core")
    rank = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, -i)])
    accepted = None
    for _ in range(rounds):
        mass = seeds
        if accepted is not None:
            extra = _dealt(unseen, accepted, "core", "pattern").groupBy("pattern", "kind").agg(F.sum("conf").alias("mass"))
            mass = seeds.unionByName(extra.join(stats.select("pattern", "n"), "pattern"))
        mass = mass.groupBy("pattern", "kind", "n").agg(F.sum("mass").alias("mass"))
        whole = F.sum("mass").over(Window.partitionBy("pattern"))  # a row per kind
        scored = mass.withColumn("conf", F.col("mass") / (whole + UNSEEN * F.col("n") + 1))
        sure = scored.where((F.col("mass") >= LEAST) & (F.col("conf") >= SURE_PATTERN)).select("pattern", "kind", "conf")
        votes = _dealt(unseen, sure, "pattern", "core").groupBy("core", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("conf"))))).alias("conf"))
        best = votes.groupBy("core").agg(F.max(F.struct("conf", rank[F.col("kind")].alias("rank"), "kind")).alias("b")).select("core", "b.kind", "b.conf")
        before, accepted = accepted, stored(best.where(F.col("conf") >= SURE_INSTANCE), "pii-instances")
        if accepted.isEmpty() and (before is None or before.isEmpty()):
            break  # nothing new can follow
    return accepted


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, findings array<struct<rank,start,end,kind>> in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    matches = F.concat(*[_matches(text, k) for k in KINDS])
    cand = stored(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", matches.alias("parts"), _units(text).alias("units")), "pii-parts")
    parts = cand.select("rid", F.explode("parts").alias("p")).select("rid", "p.*")
    base = _placed(parts, "rid", "rank").where("ok").select("rid", "rank", "start", "end")
    units = cand.select("rid", F.explode("units").alias("u")).select("rid", "u.*")
    edges = units.select(F.explode("patterns").alias("pattern"), "core", "kind").distinct()
    accepted = bootstrap(stored(edges, "pii-edges"))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k.name, i + len(KINDS))])
    unseen = _placed(units, "rid").select("rid", F.col("start") + F.col("lead"), F.col("end") - F.col("trail"), "core", "kind").toDF("rid", "start", "end", "core", "known")
    found = _dealt(unseen.where("known IS NULL").drop("known"), accepted.select("core", "kind"), "core", "rid")
    both = base.unionByName(found.select("rid", rank[F.col("kind")].alias("rank"), "start", "end"))
    # overlap with a base span: the furthest base end so far, and the next base start
    is_base = F.col("rank") < len(KINDS)
    w = Window.partitionBy("rid").orderBy("start", F.col("rank").desc())
    base_end = F.max(F.when(is_base, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    base_start = F.min(F.when(is_base, F.col("start"))).over(w.rowsBetween(0, Window.unboundedFollowing))
    marked = both.select("*", base_end.alias("base_end"), base_start.alias("base_start"))
    hidden = ~is_base & (F.coalesce(F.col("base_end") > F.col("start"), F.lit(False)) | F.coalesce(F.col("base_start") < F.col("end"), F.lit(False)))
    names = F.array(*[F.lit(p + k.name) for p in ("", "like_") for k in KINDS])
    row = F.struct("rank", "start", "end", F.get(names, F.col("rank")).alias("kind"))
    lists = marked.where(~hidden).groupBy("rid").agg(F.sort_array(F.collect_list(row)).alias("findings"))
    none = F.array().cast(lists.schema["findings"].dataType)
    return cand.select("rid", "doc_id").join(lists, "rid", "left").select("doc_id", F.coalesce("findings", none).alias("findings"))


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, digest of the base spans, all spans as text, and how many were discovered."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    f = F.col("findings")
    n = lambda i: F.size(F.filter(f, lambda s: s["rank"] == i)).cast("long")
    base = F.filter(f, lambda s: s["rank"] < len(KINDS))
    return find_pii(docs).select(
        "doc_id",
        *[n(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS)],
        F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(f, name), ",").alias("spans"),
        F.size(F.filter(f, lambda s: s["rank"] >= len(KINDS))).cast("long").alias("n_like"),
    )
