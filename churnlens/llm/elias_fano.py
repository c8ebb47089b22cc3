"""Elias-Fano sequences and a two-level n-gram trie over them, in numpy arrays that can be memory-mapped.

A sorted sequence keeps the low bits of each value packed and the high bits in
unary (bit ``high + i`` is set for element i); a directory with the ones before
each 64-bit word answers select.  ``find`` is a successor search: the high part
names a run of equal high bits between two zeros, the low bits are searched by
halves inside that run.
"""

from __future__ import annotations

import json

import numpy as np

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: position of the k-th one in a byte
_SEL = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _p in enumerate(i for i in range(8) if _b >> i & 1):
        _SEL[_b, _k] = _p
_U = np.uint64


_L8, _H8 = _U(0x0101010101010101), _U(0x8080808080808080)


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th one of each word (which must have it): byte sums, then a table for the byte."""
    with np.errstate(over="ignore"):
        s = word - ((word >> _U(1)) & _U(0x5555555555555555))
        s = (s & _U(0x3333333333333333)) + ((s >> _U(2)) & _U(0x3333333333333333))
        s = ((s + (s >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _L8  # byte i: ones in bytes 0 .. i
        k = k.astype(np.uint64)
        full = ((((k * _L8) | _H8) - s) & _H8) >> _U(7)  # a one for each byte whose sum is at most k
        at = ((full * _L8) >> _U(56)) << _U(3)
        before = (s << _U(8)) >> at & _U(255)
    return (at + _SEL[((word >> at) & _U(255)).astype(np.int64), (k - before).astype(np.int64)]).astype(np.int64)


def ef_arrays(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of the sequence ``values`` (sorted, below ``universe`` <= 2 ** 64)."""
    n = len(values)
    bits = max(0, (universe // max(n, 1)).bit_length() - 1)
    v = values.astype(np.uint64)
    high = (v >> _U(bits)).astype(np.int64) if bits < 64 else np.zeros(n, np.int64)
    at = high + np.arange(n)
    words = int(((universe - 1) >> bits) + n) // 64 + 2 if universe else 2
    unary = np.zeros(words, np.uint64)
    np.bitwise_or.at(unary, at >> 6, _U(1) << (at & 63).astype(np.uint64))
    ones = np.zeros(words, np.int64)
    ones[1:] = np.cumsum(_POP[unary.view(np.uint8)].reshape(-1, 8).sum(1))[:-1]
    low = np.zeros(n * bits // 64 + 2, np.uint64)
    if bits:
        part = v & _U((1 << bits) - 1)
        pos = np.arange(n, dtype=np.int64) * bits
        word, off = pos >> 6, (pos & 63).astype(np.uint64)
        np.bitwise_or.at(low, word, part << off)
        over = off > _U(64 - bits)
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - off[over]))
    return {"unary": unary, "ones": ones.astype(np.uint32) if n < 2**32 else ones, "low": low, "bits": np.array([bits, n], np.int64)}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.unary, self.ones, self.low = arrays["unary"], arrays["ones"], arrays["low"]
        self.bits, self.n = (int(x) for x in arrays["bits"])
        self.zeros = None

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        pos = i.astype(np.int64) * self.bits
        word, off = pos >> 6, (pos & 63).astype(np.uint64)
        got = self.low[word] >> off
        over = off > _U(64 - self.bits)
        got[over] |= self.low[word[over] + 1] << (_U(64) - off[over])
        return got & _U((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values of elements ``i``."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        at = word * 64 + _select_in_word(self.unary[word], (i - self.ones[word].astype(np.int64)))
        return ((at - i).astype(np.uint64) << _U(self.bits)) | self._low(i)

    def _before_zero(self, k: np.ndarray) -> np.ndarray:
        """Number of elements before the k-th zero of the unary part (k >= 0)."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.unary), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(self.zeros, k, side="right") - 1
        at = word * 64 + _select_in_word(~self.unary[word], k - self.zeros[word])
        return at - k

    def find(self, v: np.ndarray) -> np.ndarray:
        """Index of each value, -1 if it isn't there."""
        out = np.full(len(v), -1, np.int64)
        if not (self.n and len(v)):
            return out
        v = v.astype(np.uint64)
        high, low = (v >> _U(self.bits)).astype(np.int64), v & _U((1 << self.bits) - 1)
        start = np.where(high > 0, self._before_zero(np.maximum(high - 1, 0)), 0)
        end = self._before_zero(high)
        todo = np.nonzero(start < end)[0]
        a, b, low = start[todo], end[todo], low[todo]
        while len(todo):  # halves each run: a frequent key's runs are long
            i = (a + b) >> 1
            got = self._low(i)
            same, less = got == low, got < low
            out[todo[same]] = i[same]
            a, b = np.where(less, i + 1, a), np.where(less, b, i)
            go = ~same & (a < b)
            todo, a, b, low = todo[go], a[go], b[go], low[go]
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """A file image: arrays at 8-byte bounds behind a head that names them."""
    spec, at = [], 0
    for name, a in arrays.items():
        spec.append((name, a.dtype.str, len(a), at))
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(spec).encode()
    head += b" " * (-len(head) % 8)
    body = b"".join(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values())
    return np.uint64(len(head)).tobytes() + head + body


def from_buffer(raw: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the arrays in a file image (a uint8 array, memory-mapped or not)."""
    n = int(raw[:8].view(np.uint64)[0])
    base = 8 + n
    return {name: raw[base + at : base + at + np.dtype(kind).itemsize * size].view(kind) for name, kind, size, at in json.loads(raw[8:base].tobytes())}


#: Bits of the second word inside the trie: 32 of its hash and one for the direction.
OTHER_BITS = 33
CODES = 4096


def trie_image(keys: np.ndarray, counts: np.ndarray, rest: np.ndarray, pair_key: np.ndarray, pair_other: np.ndarray, gain: np.ndarray) -> bytes:
    """Trie of sorted distinct ``keys`` (with their counts and log10 rest weights) and pairs (key, other) with gains.

    Every pair's key is among the keys.  Gains are quantised to ``CODES``
    levels, the means of equally wide bins.
    """
    at = np.searchsorted(keys, pair_key)
    value = (at.astype(np.uint64) << _U(OTHER_BITS)) | pair_other.astype(np.uint64)
    order = np.lexsort((-gain, value))
    value, gain, at = value[order], gain[order], at[order]
    first = np.concatenate([[True], value[1:] != value[:-1]]) if len(value) else np.zeros(0, bool)  # equal hashes: the larger gain
    value, gain, at = value[first], gain[first], at[first]
    low, high = (gain.min(), gain.max()) if len(gain) else (0.0, 0.0)
    code = np.minimum((gain - low) * (CODES / max(high - low, 1e-12)), CODES - 1).astype(np.int64)
    levels = np.bincount(code, gain, CODES) / np.maximum(np.bincount(code, minlength=CODES), 1)
    pointers = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(keys)))])
    out = {"keys": keys, "counts": counts.astype(np.int64), "rest": rest.astype(np.float64), "code": code.astype(np.uint16), "levels": levels}
    out |= {f"ptr_{k}": a for k, a in ef_arrays(pointers, int(pointers[-1]) + 1).items()}
    out |= {f"ctx_{k}": a for k, a in ef_arrays(value, max(1, len(keys)) << OTHER_BITS).items()}
    return to_bytes(out)


class Trie:
    def __init__(self, raw: np.ndarray) -> None:
        a = from_buffer(raw)
        self.keys, self.counts, self.rest, self.code, self.levels = (a[k] for k in ("keys", "counts", "rest", "code", "levels"))
        part = lambda p: EliasFano({k[4:]: v for k, v in a.items() if k.startswith(p)})
        self.pointers, self.contexts = part("ptr_"), part("ctx_")

    def place(self, key: np.ndarray) -> np.ndarray:
        """Index of each key, -1 if unknown."""
        if not len(self.keys):
            return np.full(len(key), -1, np.int64)
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, i, -1)

    def fan(self, at: np.ndarray) -> np.ndarray:
        """Number of second words of each known key (0 where ``at`` is -1)."""
        out = np.zeros(len(at), np.int64)
        ok = at >= 0
        i = at[ok]
        out[ok] = (self.pointers.access(i + 1) - self.pointers.access(i)).astype(np.int64) if len(i) else 0
        return out

    def gains(self, at: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Quantised gain of each (key index, other); 0 where there is no such pair."""
        out = np.zeros(len(at))
        ok = np.nonzero(at >= 0)[0]
        i = self.contexts.find((at[ok].astype(np.uint64) << _U(OTHER_BITS)) | other[ok].astype(np.uint64))
        hit = i >= 0
        out[ok[hit]] = self.levels[self.code[i[hit]]]
        return out
