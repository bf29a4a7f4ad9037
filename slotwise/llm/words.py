"""Words and shingles of whole Arrow batches as 64-bit hashes, without a Python object for each word.

A word is a run of bytes other than space and U+0009 to U+000D. A shingle is five consecutive words; a text of one to
four words has one shingle, all its words. Hashes are a polynomial over the bytes, mixed; they are the same everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
FACTORS = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
STEP_WORDS = np.uint64(0xD1B54A32D192ED03)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def long_hash(x: np.ndarray) -> np.ndarray:
    """What ``xxhash64`` of a bigint column gives: XXH64 of eight bytes with seed 42."""
    u = np.uint64
    one, two, three, four, five = (  # fixed values: the primes of XXH64
        u(0x9E3779B185EBCA87), u(0xC2B2AE3D27D4EB4F), u(0x165667B19E3779F9), u(0x85EBCA77C2B2AE63), u(0x27D4EB2F165667C5))
    turned = lambda v, n: (v << u(n)) | (v >> u(64 - n))
    with np.errstate(over="ignore"):
        h = (u(42) + five + u(8)) ^ (turned(x.astype(np.int64).view(u) * two, 31) * one)
        h = turned(h, 27) * one + four
        h = (h ^ (h >> u(33))) * two
        h = (h ^ (h >> u(29))) * three
    return (h ^ (h >> u(32))).view(np.int64)


@dataclass
class Words:
    """All words of a batch: byte spans in ``data``, hashes, and for each text where its words begin (one more)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray
    offsets: np.ndarray


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words of an Arrow array of strings; a null has none."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    n = len(data)
    space = SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(~space & (cut[:n] | np.r_[True, space[:-1]][:n]))
    ends = np.flatnonzero(~space & (cut[1:] | np.r_[space[1:], True][:n])) + 1
    hashes = np.zeros(len(starts), np.uint64)
    # The powers start anew in each slab, which bounds what is held; a word belongs to the slab it starts in.
    slab = 1 << 19
    for low in range(0, n, slab):
        a, b = np.searchsorted(starts, [low, low + slab])
        if a == b:
            continue
        high = ends[b - 1]
        powers = np.full(high - low + 1, BASE)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        back = np.full(high - low, INVERSE)
        back[:1] = 1
        back = np.cumprod(back, dtype=np.uint64)
        s, e = starts[a:b] - low, ends[a:b] - low
        hashes[a:b] = mixed((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64) * FACTORS[0])
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets), offsets)


def runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``length`` words that stays in one text, and the number of the word it starts with."""
    h, n = words.hashes, len(words.hashes)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n - length + 1, np.uint64)
    for k in range(length):
        total = (total + h[k:n - length + 1 + k]) * FACTORS[k % len(FACTORS)]
        total ^= total >> np.uint64(29)
    left = np.repeat(words.firsts[1:], np.diff(words.firsts)) - np.arange(n)
    fits = np.flatnonzero(left[:n - length + 1] >= length)
    return mixed(total[fits]), fits


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle and the number of the text it belongs to, in order."""
    hashes, at = runs(words, SHINGLE)
    owners = np.searchsorted(words.firsts, at, side="right") - 1
    sizes = np.diff(words.firsts)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        own = []
        for i in short:
            part = words.hashes[words.firsts[i]:words.firsts[i + 1]]
            own.append((part * FACTORS[:len(part)]).sum(dtype=np.uint64) + np.uint64(len(part)))
        owners = np.r_[owners, short]
        hashes = np.r_[hashes, mixed(np.array(own, np.uint64))]
        order = np.argsort(owners, kind="stable")
        owners, hashes = owners[order], hashes[order]
    return hashes, owners


def weighted(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts, ordered by text and hash."""
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.flatnonzero(np.r_[True, (np.diff(owners) != 0) | (hashes[1:] != hashes[:-1])][:len(hashes)])
    return hashes[new], owners[new], np.diff(np.r_[new, len(hashes)])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets of (sorted hashes, counts)."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    shared = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return shared / (total - shared)
