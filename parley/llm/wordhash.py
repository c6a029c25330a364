"""Word hashes of many texts at once, on numpy arrays of their bytes.

A word is a run of bytes other than 0x20 and 0x09-0x0D.  Its hash is a polynomial over random
64-bit values of its bytes, taken from one running sum over the whole block, so the cost is a few
nanoseconds per byte and no Python object is made per word.  ``A-Z`` and ``a-z`` have the same
values, which lower-cases A-Z and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Texts are joined into blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_BASE = int(_rng.integers(1, 2**63, dtype=np.uint64)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power_table(base: int, n: int) -> np.ndarray:
    """``base ** j`` modulo 2**64 for j below ``n``; kept and doubled as longer blocks come."""
    table = _powers[base]
    while len(table) < n:
        step = np.uint64(pow(base, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    _powers[base] = table if len(table) <= 8 * BLOCK_BYTES else table[: 8 * BLOCK_BYTES]
    return table


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """One hash per byte span ``[start, end)`` of ``data``."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTE)[data] * _power_table(_BASE, n + 1)[:n], out=total[1:])
    return mix((total[end] - total[start]) * _power_table(_INVERSE, n + 1)[start])


@dataclass
class Block:
    """Some texts in one byte array; word ``w`` is ``data[start[w]:end[w]]``, text ``t`` has words ``first[t]`` to ``first[t + 1]``."""

    begin: int
    data: np.ndarray
    offset: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def blocks(texts: list[bytes | None]) -> Iterator[Block]:
    """Cut ``texts`` into blocks; a null is an empty text."""
    begin = 0
    while begin < len(texts):
        stop, held = begin, 0
        while stop < len(texts) and (stop == begin or held + len(texts[stop] or b"") <= BLOCK_BYTES):
            held += len(texts[stop] or b"") + 1
            stop += 1
        yield _block(texts[begin:stop], begin)
        begin = stop


def _block(texts: list[bytes | None], begin: int) -> Block:
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    offset = np.concatenate([[0], np.cumsum(lengths)])
    gap = SPACE[data]
    edge = np.flatnonzero(np.diff(gap, prepend=True))
    start, end = edge[0::2], edge[1::2]
    return Block(begin, data, offset, start, end, np.searchsorted(start, offset))


def shingles(block: Block, n: int, words: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``n``-word shingles; fewer words make one shingle, none an empty set."""
    words = span_hashes(block.data, block.start, block.end) if words is None else words
    whole = _combine([words[j : len(words) - n + 1 + j] for j in range(n)], n) if len(words) >= n else words[:0]
    for a, b in zip(block.first[:-1], block.first[1:]):
        if b - a >= n:
            yield distinct(whole[a : b - n + 1])
        elif b > a:
            yield _combine([words[j : j + 1] for j in range(a, b)], b - a)
        else:
            yield words[:0]


def _combine(parts: list[np.ndarray], length: int) -> np.ndarray:
    out = np.full(len(parts[0]), length, np.uint64)
    for part in parts:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values
