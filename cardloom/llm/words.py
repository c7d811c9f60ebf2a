"""Words of whole texts as numpy arrays, for use inside tasks.

A word is a run of bytes other than the six ASCII spaces (0x20, 0x09-0x0D), so
it is the same word in UTF-8 and in code points. Texts are taken from Arrow
without a Python string per word; every word becomes one 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Bytes handled at once; a longer text is cut between two words.
CHUNK = 1 << 21

_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _grow(n: int) -> None:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another and the n + 1 bounds of the
    texts in them. A null text counts as an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(bounds):
        bounds = np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, limit: int = 4 * CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, bytes, bounds)`` of runs of texts of about ``limit`` bytes,
    so that arrays per byte or per word stay small whatever the batch holds."""
    raw, bounds = buffer(texts)
    at = 0
    while at < len(bounds) - 1:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield at, raw[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


def spans(
    raw: np.ndarray, bounds: np.ndarray, outside: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words. A word also ends where its text ends.
    ``outside`` tells for each byte whether it lies between words."""
    inside = ~outside[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = bounds[1:-1]
    cuts = cuts[cuts < len(raw)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    last[before] = inside[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefixes: tuple[int, ...] = ()
) -> np.ndarray | list[np.ndarray]:
    """A 64-bit hash of the bytes from each start to its end. With ``prefixes`` a
    list: these hashes, then for each length those of the words' first bytes."""
    outs = [np.empty(len(starts), U64) for _ in range(1 + len(prefixes))]
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
        stop = int(ends[to - 1])
        _grow(max(CHUNK, stop - begin) + 1)
        total = np.zeros(stop - begin + 1, U64)
        np.cumsum((raw[begin:stop].astype(U64) + U64(1)) * _powers[0][: stop - begin], out=total[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        for out, n in zip(outs, (None, *prefixes)):
            end = e if n is None else np.minimum(e, s + n)
            size = (end - s).astype(U64) << U64(48)
            out[at:to] = mix((total[end] - total[s]) * _powers[1][s] ^ size)
        at = to
    return outs if prefixes else outs[0]


def word_hashes(
    raw: np.ndarray, bounds: np.ndarray, lower: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the n + 1 bounds of the texts among the words.
    ``lower`` folds A-Z, and nothing else, to a-z."""
    if lower:
        raw = LOWER[raw]
    starts, ends = spans(raw, bounds)
    return hashes(raw, starts, ends), np.searchsorted(starts, bounds)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words of one text; of a text with fewer words the
    whole sequence; none without words."""
    k = min(n, len(words))
    if not k:
        return np.zeros(0, U64)
    out = np.full(len(words) - k + 1, mix(np.array([k], U64))[0])
    for i in range(k):
        out = mix(out * U64(0x2545F4914F6CDD1D) + words[i : len(words) - k + 1 + i])
    return out


def text_shingles(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For every text its distinct shingles of lower-cased words, sorted."""
    for _, raw, bounds in slices(texts):
        words, at = word_hashes(raw, bounds, lower=True)
        for a, b in zip(at[:-1], at[1:]):
            yield np.unique(shingles(words[a:b], n))
