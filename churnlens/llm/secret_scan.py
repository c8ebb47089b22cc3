"""Secret scan with multipart credential linking.

Every text is searched for *parts* of credentials: identifiers (access keys,
logins), secrets (assignments, long hex runs, opaque tokens) and endpoints.
The three base kinds (assign, access, hex) are findings by themselves.  The
weak kinds are reported only where complementary parts co-occur in one scope:

* a login needs a secret within ``scope`` code points,
* an opaque token or a short password needs an identifier there,
* an endpoint needs both.

"There" means that the start offsets of the two parts are at most ``scope``
apart.  This interval join is run as an equi-join on (row, offset bucket of
``scope`` code points): a part meets its own bucket and both neighbours.  A
bucket's side is reduced to its smallest and largest offset per role before
the join, which decides the interval predicate exactly, so a text packed with
parts gives one row per bucket and role instead of all pairs.

Offsets come from Spark functions alone: ``split`` gives the text between the
matches, ``regexp_extract_all`` the matches, and a running sum of their
lengths (a window per row and kind) the positions.

Defined cases: null text counts as empty; a null or repeated ``doc_id`` and
repeated rows keep one output row each; an empty table gives no rows; further
columns of the input are ignored by ``find_secrets`` and kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from churnlens.llm.common import fresh, stored

ID, SECRET, ENDPOINT = "id", "secret", "endpoint"


@dataclass(frozen=True)
class Kind:
    """One kind of part.

    ``probe`` must match a text that ``pattern`` matches; it is the cheap test
    that most texts fail.  ``group`` and ``keep`` decide which matches stay.
    """

    name: str
    role: str
    weak: bool
    probe: str
    pattern: str
    group: int
    keep: str  # RLIKE on the group


_VALUE = r"""["']?\x20*[:=]\x20*["']?"""

#: In the order in which equal offsets are listed.
KINDS = (
    Kind(
        "assign",
        SECRET,
        False,
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
        r"(?i:(password|passwd|secret|token|api_?key))" + _VALUE + r"([A-Za-z0-9+/_.=-]+)",
        2,
        r"^.{8}",
    ),
    Kind("access", ID, False, r"AKIA[A-Z0-9]{12}", r"AKIA[A-Z0-9]+", 0, r"^.{16}"),
    Kind("hex", SECRET, False, r"[0-9a-f]{32}", r"[0-9a-f]{32,}", 0, r"^."),
    Kind(
        "login",
        ID,
        True,
        r"(?i:user|login|client|account)[A-Za-z_]{0,8}[\"']?\x20*[:=]",
        r"(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?)" + _VALUE + r"([A-Za-z0-9._@+-]{3,})",
        0,
        r"^.",
    ),
    Kind(
        "short",
        SECRET,
        True,
        r"(?i:pwd|pass|auth|key)[\"']?\x20*[:=]",
        r"(?<![A-Za-z0-9_])(?i:pwd|pass|auth|key)" + _VALUE + r"([A-Za-z0-9+/_.=!@#$%^&*-]{4,})",
        0,
        r"^.",
    ),
    Kind(
        "opaque",
        SECRET,
        True,
        r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24}",
        r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}",
        0,
        r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])",
    ),
    Kind(
        "endpoint",
        ENDPOINT,
        True,
        r"://|(?i:host|endpoint|server)[\"']?\x20*[:=]",
        r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]+|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?""",
        0,
        r"^.",
    ),
)
RANK = {k.name: i for i, k in enumerate(KINDS)}

#: Parts whose starts are at most this many code points apart share a scope.
SCOPE = 400

_PART = "array<struct<kind:string,nth:int,before:int,size:int,ok:boolean>>"


def _candidates(text: Column) -> Column:
    """Array of all raw matches of all kinds with the length of the text before each."""
    return F.concat(*[_matches(text, k) for k in KINDS])


def _matches(text: Column, k: Kind) -> Column:
    between = F.split(text, k.pattern, -1)  # one piece more than there are matches
    whole = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(k.group))
    found = F.zip_with(whole, group, lambda h, v: F.struct(F.char_length(h).alias("size"), v.rlike(k.keep).alias("ok")))
    found = F.zip_with(found, F.slice(between, F.lit(1), F.size(whole)), lambda x, b: F.struct(x["size"].alias("size"), x["ok"].alias("ok"), F.char_length(b).alias("before")))
    rows = F.transform(
        found,
        lambda x, i: F.struct(F.lit(k.name).alias("kind"), i.alias("nth"), x["before"].alias("before"), x["size"].alias("size"), x["ok"].alias("ok")),
    )
    return F.when(text.rlike(k.probe), rows.cast(_PART)).otherwise(F.array().cast(_PART))


def suspicious(text: Column) -> Column:
    """Whether any kind's cheap probe matches (false for null)."""
    return F.coalesce(F.exists(F.array(*[text.rlike(k.probe) for k in KINDS]), lambda x: x), F.lit(False))


def _positions(cand: DataFrame) -> DataFrame:
    """(rid, kind, role, weak, start, end) of the matches that their kind keeps."""
    w = Window.partitionBy("rid", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    parts = cand.select("rid", F.explode("parts").alias("p")).select("rid", "p.*")
    parts = parts.withColumn("end", F.sum(F.col("before") + F.col("size")).over(w))
    role = F.create_map(*[F.lit(x) for k in KINDS for x in (k.name, k.role)])
    weak = F.col("kind").isin([k.name for k in KINDS if k.weak])
    return parts.where("ok").select("rid", "kind", role[F.col("kind")].alias("role"), weak.alias("weak"), (F.col("end") - F.col("size")).alias("start"), "end")


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The findings among ``parts``: base ones, and weak ones whose complements share a scope.

    A weak part that overlaps a base one is the same credential and is dropped.
    """
    bucket = F.floor(F.col("start") / scope)
    # reach: per bucket and role, offsets that decide "within scope" from either side
    reach = parts.groupBy("rid", bucket.alias("bucket"), "role").agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    weak = parts.where("weak")
    asks = weak.select("rid", "kind", "role", "start", "end", F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"))
    near = asks.join(reach.withColumnRenamed("role", "other"), ["rid", "bucket"]).where(
        (F.abs(F.col("lo") - F.col("start")) <= scope) | (F.abs(F.col("hi") - F.col("start")) <= scope)
    )
    linked = near.groupBy("rid", "kind", "role", "start", "end").agg(
        F.bool_or(F.col("other") == ID).alias("with_id"), F.bool_or(F.col("other") == SECRET).alias("with_secret")
    )
    linked = linked.where(
        F.when(F.col("role") == ID, F.col("with_secret")).when(F.col("role") == SECRET, F.col("with_id")).otherwise(F.col("with_id") & F.col("with_secret"))
    ).select("rid", "kind", "start", "end", F.lit(True).alias("weak"))
    both = parts.where("NOT weak").select("rid", "kind", "start", "end", "weak").unionByName(linked)
    # overlap with a base part: the furthest base end so far, and the next base start
    before = Window.partitionBy("rid").orderBy("start", "weak").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("rid").orderBy("start", "weak").rowsBetween(0, Window.unboundedFollowing)
    base = lambda c: F.when(~F.col("weak"), F.col(c))
    marked = both.withColumn("base_end", F.max(base("end")).over(before)).withColumn("base_start", F.min(base("start")).over(after))
    hidden = F.col("weak") & (F.coalesce(F.col("base_end") > F.col("start"), F.lit(False)) | F.coalesce(F.col("base_start") < F.col("end"), F.lit(False)))
    return marked.where(~hidden).select("rid", "kind", "start", "end", "weak")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, findings array<struct<start,rank,end,kind,weak>> in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cand = stored(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", _candidates(text).alias("parts")), "secret-parts")
    rank = F.create_map(*[F.lit(x) for k, i in RANK.items() for x in (k, i)])
    spans = link_parts(_positions(cand), scope).select(
        "rid", F.struct(F.col("start"), rank[F.col("kind")].alias("rank"), F.col("end"), F.col("kind"), F.col("weak")).alias("s")
    )
    found = spans.groupBy("rid").agg(F.sort_array(F.collect_list("s")).alias("findings"))
    none = F.array().cast(found.schema["findings"].dataType)
    return cand.select("rid", "doc_id").join(found, "rid", "left").select("doc_id", F.coalesce("findings", none).alias("findings"))


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, counts per base kind, digest of the base spans, all spans as text."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    f = F.col("findings")
    n = lambda k: F.size(F.filter(f, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return find_secrets(docs, scope).select(
        "doc_id",
        n("assign"),
        n("access"),
        n("hex"),
        F.sha2(F.array_join(F.transform(F.filter(f, lambda s: ~s["weak"]), name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(f, name), ",").alias("spans"),
        F.size(F.filter(f, lambda s: s["weak"])).cast("long").alias("n_weak"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every finding's span replaced by ``mask``; n_chars (if there) follows the new text.

    Texts without a candidate pass straight through; only the others are
    written once (to fix their row ids) and joined with their findings.
    """
    hit = suspicious(F.col("text"))
    cols = docs.columns
    rid = "rid"
    whole, parts = fresh(docs, "row"), fresh(docs, "parts")
    some = docs.where(hit).select(
        F.monotonically_increasing_id().alias(rid), F.struct(*[F.col(f"`{c}`") for c in cols]).alias(whole), _candidates(F.col("text")).alias(parts)
    )
    some = stored(some, "secret-rows")
    spans = link_parts(_positions(some.select(rid, F.col(parts).alias("parts"))), scope)
    w = Window.partitionBy(rid).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    # overlapping findings are masked as one island
    isles = spans.withColumn("reach", F.max("end").over(w)).withColumn("new", F.coalesce((F.col("start") >= F.col("reach")).cast("int"), F.lit(1)))
    w2 = Window.partitionBy(rid).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    isles = isles.withColumn("isle", F.sum("new").over(w2)).groupBy(rid, "isle").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    isles = isles.groupBy(rid).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("isles"))
    j = some.select(rid, whole).join(isles, rid, "left")
    text, cuts = F.col(whole)["text"], F.col("isles")
    kept = F.transform(
        F.sequence(F.lit(0), F.size(cuts)),
        lambda i: F.substring(
            text,
            F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0)).cast("int") + 1,
            (F.coalesce(F.get(cuts, i)["start"], F.char_length(text)) - F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0))).cast("int"),
        ),
    )
    new = F.when(cuts.isNull(), text).otherwise(F.array_join(kept, mask))
    j = j.select(whole, new.alias("masked"))
    out = []
    for c in cols:
        kind = docs.schema[c].dataType
        if c == "text":
            out.append(F.col("masked").alias("text"))
        elif c == "n_chars":
            out.append(F.char_length("masked").cast(kind).alias("n_chars"))
        else:
            out.append(F.col(whole)[c].alias(c))
    return docs.where(~hit).unionByName(j.select(*out))
