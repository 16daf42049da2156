"""Words of many UTF-8 texts at once, as numpy arrays over their joined bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# The bytes that make words. Letters, digits and all bytes of other alphabets; or all but white space.
_ALNUM = np.zeros(256, bool)
_ALNUM[ord("0") : ord("9") + 1] = _ALNUM[ord("A") : ord("Z") + 1] = _ALNUM[ord("a") : ord("z") + 1] = _ALNUM[0x80:] = True
_DARK = np.ones(256, bool)
_DARK[list(b" \t\n\r\x0b\x0c")] = False
CLASSES = {"alnum": _ALNUM, "dark": _DARK}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words that are hashed at a time.
HASHED = 1 << 19

#: A random 64-bit number for each byte value, and the odd base whose powers tell places in a word apart.
_VALUES = np.random.Generator(np.random.PCG64(20240101)).integers(1, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _BASE)]), dtype=np.uint64)


@dataclass
class Words:
    """Words of consecutive texts: byte range, hash, and the first word of each text (n + 1 numbers)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)


def split(data: np.ndarray, offsets: np.ndarray, kind: str, lower: bool) -> Words:
    """Words of the texts that ``offsets`` cut out of ``data``; equal words have equal 64-bit hashes."""
    inside = CLASSES[kind][data]
    edge = np.zeros(len(data) + 1, bool)  # a word ends where the kind of byte changes, and where a text does
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    if len(starts) == 0:
        return Words(starts, ends, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    lengths = ends - starts
    body = data[inside]
    if lower:
        body = _LOWER[body]
    last = np.cumsum(lengths)  # end of each word in ``body``
    power = powers(int(lengths.max()))
    hashes = np.empty(len(starts), np.uint64)
    a = 0
    with np.errstate(over="ignore"):
        while a < len(starts):  # some words at a time: eight bytes stand for one here
            begin = int(last[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(last, begin + HASHED, "right")))
            end = int(last[b - 1])
            at = last[a:b] - lengths[a:b] - begin
            place = np.arange(end - begin) - np.repeat(at, lengths[a:b])
            hashes[a:b] = np.add.reduceat(_VALUES[body[begin:end]] * power[place], at)
            a = b
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def groups(offsets: np.ndarray, size: int):
    """Ranges of consecutive texts of ``size`` bytes in all (a single longer text aside)."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end
