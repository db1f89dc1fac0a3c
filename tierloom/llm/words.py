"""Hashes of words and of runs of words, computed from UTF-8 bytes without making Python strings."""

from __future__ import annotations

import functools

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_RUN = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=None)
def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    """A random number for each byte, A-Z having those of a-z; which bytes are ASCII white space."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
    values[65:91] = values[97:123]
    space = np.zeros(256, dtype=bool)
    space[[32, *range(9, 14)]] = True
    return values, space


_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        size = 1 << (n - 1).bit_length()
        step = np.full(size, _STEP if kind == "up" else _STEP_BACK, dtype=np.uint64)
        step[0] = 1
        have = _powers[kind] = np.multiply.accumulate(step)
    return have[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lowered) and the number of words of each text, texts in order."""
    n_texts = len(offsets) - 1
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    values, space = _byte_values()
    inside = ~space[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[firsts[firsts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * _power("up", len(data)), out=total[1:])
    hashes = mix((total[ends] - total[starts]) * _power("down", len(data))[starts])
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and how many each text has.

    A text of fewer words, but at least one, has one run: the whole of it. A text without words has none.
    """
    ends = np.cumsum(counts)
    starts = ends - counts
    run = [np.uint64(pow(_RUN, k, 2**64)) for k in range(size)]
    n = len(words) - size + 1
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = np.zeros(0, np.uint64)
    if len(short):
        which = np.repeat(np.arange(len(short)), counts[short])
        place = np.arange(len(which)) - np.repeat(np.cumsum(counts[short]) - counts[short], counts[short])
        terms = words[starts[short][which] + place] * np.array(run, np.uint64)[place]
        whole = mix(np.add.reduceat(terms, np.cumsum(counts[short]) - counts[short]) + counts[short].astype(np.uint64))
    n_runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out = np.zeros(int(n_runs.sum()), np.uint64)
    at = np.cumsum(n_runs) - n_runs
    if n > 0:
        every = words[:n] * run[0]
        for k in range(1, size):
            every = every + words[k : k + n] * run[k]
        keep = np.zeros(len(words) + 1, np.int64)
        full = counts >= size
        np.add.at(keep, starts[full], 1)
        np.add.at(keep, ends[full] - size + 1, -1)
        mask = np.cumsum(keep)[:n] > 0
        target = np.ones(len(out), dtype=bool)
        target[at[short]] = False
        out[target] = mix(every[mask])
    out[at[short]] = whole
    return out, n_runs
