"""Hashed word shingles of whole texts.

Words are runs of bytes other than ASCII white space, with A-Z lowered; a
document's set holds its distinct runs of five words, or its whole sequence
where it has fewer.  Hashes have 64 bits.  A word's is a polynomial in its
bytes, read off a running sum over a stretch of text, so no word becomes an
object of its own; a word longer than ``LONG`` bytes has a hash of its whole
bytes instead.  A shingle's hash mixes those of its words in their order.

Memory: texts are read in stretches of bounded length, cut at white space, so
beside the bytes a text takes eight bytes for each of its words and shingles.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
#: Bytes of a stretch; longer words are hashed in another way.
STRETCH = 1 << 18
LONG = 1 << 16
_FACTOR, _MASK = 0x9E3779B97F4A7C15, 2**64 - 1
_INVERSE = pow(_FACTOR, -1, 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))


def _powers(base: int, size: int) -> np.ndarray:
    table, step = np.ones(1, np.uint64), base
    while len(table) < size:
        table = np.concatenate((table, table * np.uint64(step)))
        step = step * step & _MASK
    return table[:size]


_tables: list[np.ndarray] = []


def _up_and_down() -> list[np.ndarray]:
    """Powers of the factor and of its inverse for a stretch and a word."""
    if not _tables:
        _tables.extend(_powers(base, STRETCH + LONG + 2) for base in (_FACTOR, _INVERSE))
    return _tables


def _stretch_hashes(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words of one stretch."""
    import xxhash

    long = np.flatnonzero(ends - starts > LONG)
    if len(long):
        h = np.empty(len(starts), np.uint64)
        short = np.ones(len(starts), bool)
        short[long] = False
        for at in range(0, len(long)):
            h[long[at]] = xxhash.xxh64_intdigest(x[starts[long[at]] : ends[long[at]]].tobytes())
        runs = np.split(np.flatnonzero(short), np.flatnonzero(np.diff(np.flatnonzero(short)) > 1) + 1)
        for run in runs:  # words between long ones
            if len(run):
                h[run] = _stretch_hashes(x, starts[run], ends[run])
        return h
    up, down = _up_and_down()
    begin, end = int(starts[0]), int(ends[-1])
    running = np.zeros(end - begin + 1, np.uint64)
    np.cumsum(_letters[x[begin:end]] * up[: end - begin], out=running[1:])
    s, e = starts - begin, ends - begin
    return mixed((running[e] - running[s]) * down[s] + (e - s).astype(np.uint64))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of the lowered bytes."""
    x = np.frombuffer(data, np.uint8)
    inside = (x != 32) & ((x < 9) | (x > 13))
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    # A stretch holds the words that end in it; so it begins at most one word before its first byte.
    borders = np.searchsorted(ends, np.arange(STRETCH, int(ends[-1]) + STRETCH, STRETCH), "right")
    borders = np.unique(np.concatenate(([0], borders)))
    return starts, np.concatenate([_stretch_hashes(x, starts[a:b], ends[a:b]) for a, b in zip(borders, borders[1:], strict=False)])


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All sets one after another, each sorted, and the offsets of each (one more than texts)."""
    raw = [t.encode() for t in texts]
    data = b"\n".join(raw).lower()
    begin = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    del raw
    starts, h = _word_hashes(data)
    first = np.searchsorted(starts, begin)  # first word of each text, and the end
    del starts
    n_words = np.diff(first)
    width = np.minimum(n_words, WIDTH)
    n = len(h)
    total = np.zeros(max(n - WIDTH + 1, 0), np.uint64)
    for at in range(0, len(total), STRETCH):
        part = total[at : at + STRETCH]
        for k in range(WIDTH):
            part[:] = mixed(part + h[at + k : at + k + len(part)] * np.uint64(2 * k + 3))
    sets = []
    for at, count, w in zip(first.tolist(), n_words.tolist(), width.tolist(), strict=False):
        if w == WIDTH:
            own = np.sort(total[at : at + count - WIDTH + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif w:
            short = np.full(1, w, np.uint64)
            for k in range(w):
                short = mixed(short + h[at + k : at + k + 1] * np.uint64(2 * k + 3))
            sets.append(mixed(short))
        else:
            sets.append(np.empty(0, np.uint64))
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64)))
    return np.concatenate(sets) if sets else np.empty(0, np.uint64), offsets
