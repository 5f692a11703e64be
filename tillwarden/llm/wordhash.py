"""64-bit hashes of the words of many texts at once.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return.  A word's hash is a polynomial in its bytes modulo 2**64, read off prefix sums over the
whole buffer and then mixed; it does not depend on where the word stands.  Work goes by segments
cut at separators, so memory does not grow with the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
SEGMENT = 1 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15 | 3  # odd; base - 1 is twice an odd number
_STEPS = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * U(pow(base, done, 1 << 64))
        done += take
    return out


_POWER = _powers(_BASE, 1 << 16)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), 1 << 16)


def _grow(n: int) -> None:
    global _POWER, _INVERSE
    if len(_POWER) < n:
        _POWER = _powers(_BASE, n)
        _INVERSE = _powers(pow(_BASE, -1, 1 << 64), n)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _segment(data: np.ndarray, lower: bool, prefixes: tuple = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of one buffer.

    With ``prefixes``, hashes have a row for whole words and one for their first so many bytes; a
    word that is no longer than that has its whole hash there.
    """
    n = len(data)
    inside = np.empty(n + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = change[::2], change[1::2]
    if lower:
        data = _LOWER[data]
    _grow(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _POWER[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _INVERSE[starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64))
    if not prefixes:
        return hashes, starts, ends
    rows = [hashes]
    for size in prefixes:
        cut = np.minimum(starts + size, ends)
        part = mix((sums[cut] - sums[starts]) * _INVERSE[starts] - U(size))
        rows.append(np.where(ends - starts > size, part, hashes))
    return np.stack(rows), starts, ends


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about SEGMENT bytes that end at separators; a longer word stays whole."""
    at, n = 0, len(data)
    while at < n:
        end = at + SEGMENT
        while end < n:
            spaces = np.flatnonzero(_IS_SPACE[data[end : end + 4096]])
            if len(spaces):
                end += int(spaces[0])
                break
            end += 4096
        yield at, min(end, n)
        at = min(end, n)


def words(text: bytes, lower: bool = False, prefixes: tuple = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (byte offsets) of every word of one text."""
    data = np.frombuffer(text, dtype=np.uint8)
    if len(data) <= SEGMENT:
        return _segment(data, lower, prefixes)
    parts = [(a, *_segment(data[a:b], lower, prefixes)) for a, b in _cuts(data)]
    return (
        np.concatenate([p[1] for p in parts], axis=-1),
        np.concatenate([p[2] + p[0] for p in parts]),
        np.concatenate([p[3] + p[0] for p in parts]),
    )


def word_batches(
    texts: list[bytes], lower: bool = False, prefixes: tuple = ()
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of runs of texts: first text, last + 1, all hashes, where each text's begin.

    Short texts share one buffer; the offsets have one entry more than the texts.
    """
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < SEGMENT):
            size += len(texts[last]) + 1
            last += 1
        run = texts[first:last]
        if len(run) == 1:
            hashes = words(run[0], lower, prefixes)[0]
            offsets = np.array([0, hashes.shape[-1]])
        else:
            data = np.frombuffer(b" ".join(run), dtype=np.uint8)
            hashes, starts, _ = _segment(data, lower, prefixes)
            begins = np.cumsum([0, *(len(t) + 1 for t in run)])
            offsets = np.searchsorted(starts, begins)
        yield first, last, hashes, offsets
        first = last


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * _STEPS[i]
    return mix(total)


def whole(hashes: np.ndarray) -> np.uint64:
    """Hash of a short word sequence as one, apart from every hash of ``grams``."""
    total = U(0)
    with np.errstate(over="ignore"):
        for i, h in enumerate(hashes.tolist()):
            total = U((int(total) + h * int(_STEPS[i % 64])) & 0xFFFFFFFFFFFFFFFF)
    return mix(np.array([total + U(len(hashes) + 1)], dtype=np.uint64))[0]
