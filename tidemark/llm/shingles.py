"""Word shingles of whole texts as 64-bit hashes, vectorised over a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SIZE = 5
#: Bytes of text whose words are hashed together.
_CHUNK = 1 << 19
_RNG = np.random.default_rng(20_011)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 2 * SIZE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GAPS = [bytes([c]) for c in (0x20, *range(0x09, 0x0E))]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)]) for b in (_BASE, inverse))


_POWER, _INVERSE = _powers(_CHUNK + 2)


def _words(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of ``buffer``, which begins and ends with white space."""
    data = np.frombuffer(buffer, np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    # one word beyond a chunk has powers of its own
    power, inverse = (_POWER, _INVERSE) if len(data) <= len(_POWER) else _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    return start, _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut at white space into pieces of at most a chunk, but for longer words."""
    at = 0
    while len(text) - at > _CHUNK:
        gap = max(text.rfind(c, at, at + _CHUNK) for c in _GAPS)
        if gap <= at:
            gap = min((k for c in _GAPS if (k := text.find(c, at + _CHUNK)) >= 0), default=len(text) - 1)
        yield text[at : gap + 1]
        at = gap + 1
    yield text[at:]


def _grams(word: np.ndarray) -> np.ndarray:
    """A hash for each run of ``SIZE`` words."""
    grams = np.zeros(max(0, len(word) - SIZE + 1), np.uint64)
    for k in range(SIZE if len(grams) else 0):
        grams += word[k : k + len(grams)] * _PLACE[k]
    return _mix(grams)


def _short(word: np.ndarray) -> np.ndarray:
    """The one hash of fewer words than a shingle has."""
    n = len(word)
    whole = (word * _PLACE[SIZE : SIZE + n]).sum(dtype=np.uint64, keepdims=True)
    return _mix(whole + _PLACE[-1:] * np.full(1, n, np.uint64)) if n else np.zeros(0, np.uint64)


def _chunk(texts: list[bytes]) -> list[np.ndarray]:
    start, word = _words(b"\n" + b"\n".join(texts) + b"\n")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.searchsorted(start, np.r_[1, 1 + np.cumsum(lengths + 1)])
    grams = _grams(word)
    return [
        np.unique(grams[a : b - SIZE + 1]) if b - a >= SIZE else _short(word[a:b])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    ]


def _long(text: bytes) -> np.ndarray:
    word = np.concatenate([_words(b"\n" + piece + b"\n")[1] for piece in _pieces(text)])
    return np.unique(_grams(word)) if len(word) >= SIZE else _short(word)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order. A text with
    fewer words than a shingle is one shingle; one without words has none."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower touches A-Z only
        if held and size + len(data) + len(held) >= _CHUNK:
            yield from _chunk(held)
            held, size = [], 0
        if len(data) >= _CHUNK - 1:
            yield _long(data)
            continue
        held.append(data)
        size += len(data)
    if held:
        yield from _chunk(held)
