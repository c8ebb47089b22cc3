"""Plain Python twins of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def base_counts(t):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = t or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


_ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_secrets(t):
    """(start, rank, end, kind) of the base kinds."""
    t = t or ""
    out = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if m.end() - m.start() >= 32]
    return sorted(out)


def base_digest(t):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base_secrets(t)).encode()).hexdigest()


def shingle_set(t, size=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def near_components(docs, size=4, percent=80):
    """{id: (set size, smallest id of the component)} by comparing all pairs."""
    sets = {i: shingle_set(t, size) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in docs if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                n = len(a & b)
                if n * 100 >= percent * (len(a) + len(b) - n):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in docs}


def viterbi_pieces(text, pieces, of_byte, unknown, longest, space):
    """Ids of the best path over the whole normalised text; ties to the longer last piece."""
    t = space + text.replace(" ", space) if text else ""
    known = {p: (i, s) for p, i, s in pieces}
    best = [(0.0, 0, 0)] + [None] * len(t)
    for e in range(1, len(t) + 1):
        for z in range(1, min(e, longest) + 1):
            hit = known.get(t[e - z : e])
            if hit is None and z > 1:
                continue
            s = best[e - z][0] + (hit[1] if hit else unknown)
            if best[e] is None or s >= best[e][0]:
                best[e] = (s, z, hit[0] if hit else -1)
    out, e = [], len(t)
    while e:
        _, z, i = best[e]
        out[:0] = [i] if i >= 0 else [of_byte[b] for b in t[e - z : e].encode()]
        e -= z
    return out


def bigram_scores(docs, discount=0.75, least=1):
    """{id: (tokens, known, train tokens, base score, score)} with exact gains."""
    toks = {i: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), "end"] for i, t in docs.items()}
    train = [i for i in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    count, pair, context = Counter(), Counter(), Counter()
    for i in train:
        before = ["start", *toks[i][:-1]]
        count.update(toks[i])
        pair.update(zip(before, toks[i]))
        context.update(before)
    total, den = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    used = Counter()
    for (h, _), n in pair.items():
        if n >= least:
            used[h] += n - discount
    out = {}
    for i, t in toks.items():
        base = score = 0.0
        for h, w in zip(["start", *t[:-1]], t):
            p = (count[w] + 0.5) / den
            base += math.log10(p)
            n = pair.get((h, w), 0) if context[h] else 0
            rest = 1 - used[h] / context[h] if context[h] else 1.0
            score += math.log10(((n - discount) / context[h] if n >= least else 0.0) + rest * p)
        out[i] = (len(t), sum(count[w] > 0 for w in t), total, base, score)
    return out


_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_pii(t):
    """(kind, start, end) by kind as listed, then start."""
    out = []
    for kind, pattern in _PII.items():
        for m in re.finditer(pattern, t or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def aligned(docs, tokenizer, pieces):
    """Rows of the alignment contract from the two libraries, by byte offsets."""
    stand_in = {b: b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    for b in range(256):
        if b not in stand_in:
            stand_in[b] = 256 + len(stand_in) - 188
    byte = {chr(c): b for b, c in stand_in.items()}
    rows, holds = {}, Counter()
    for i, t in docs.items():
        rows[i] = None
        if not t:
            continue
        a = tokenizer.encode(" " + t, add_special_tokens=False).ids
        b = pieces.encode(t)
        a_bytes = [bytes(byte[c] for c in tokenizer.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(p[3:-1], 16)]) if re.fullmatch("<0x..>", p) else p.replace("\u2581", " ").encode() for p in map(pieces.id_to_piece, b)]
        if not (b"".join(a_bytes) == b"".join(b_bytes) == (" " + t).encode()):
            continue
        owner = [[k for k, x in enumerate(side) for _ in x] for side in (a_bytes, b_bytes)]
        links = sorted(set(zip(*owner)))
        ends = [set(), set()]
        for side, e in zip((a_bytes, b_bytes), ends):
            n = 0
            for x in side:
                n += len(x)
                e.add(n)
        cuts, groups, at = sorted(ends[0] & ends[1]), [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(ids[k]) for k in dict.fromkeys(own[at:c])) for ids, own in zip((a, b), owner)))
            at = c
        pairs = [(a[x], b[y]) for x, y in links]
        rows[i] = (len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest())
        holds.update(set(pairs))
    top = Counter()
    for (x, _), n in holds.items():
        top[x] = max(top[x], n)
    out = {}
    for i, r in rows.items():
        if r is None:
            out[i] = (0, 0, 0, 0, 0, 0, "")
        else:
            n_a, n_b, n_g, pairs, sha = r
            out[i] = (n_a, n_b, n_g, len(pairs), sum(holds[p] == top[p[0]] for p in pairs), sum(holds[p] for p in pairs), sha)
    return out
