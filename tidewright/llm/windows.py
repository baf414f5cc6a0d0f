"""Batches of texts in runs of bounded size, and rolling hashes of their word windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hash a worker remembers; it starts afresh beyond, which only costs time.
REMEMBERED = 1 << 18


class WordHashes(dict):
    """64-bit hashes of words, computed once per worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def words_of(text: str) -> list[bytes]:
    """The words as UTF-8: bytes are split at space and U+0009 to U+000D only."""
    return text.encode("utf-8", "surrogatepass").split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that any of their bits may be used."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(texts: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the text) of every window of `width` words, in order.

    The hash is Rabin-Karp's: a polynomial in the word hashes modulo 2 ** 64, then scrambled.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(sizes.sum())
    flat = np.fromiter((_HASHES[w] for ws in texts for w in ws), np.uint64, total)
    if total < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rolled = flat[: total - width + 1].copy()
    for k in range(1, width):
        rolled *= BASE
        rolled += flat[k : total - width + 1 + k]
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[: total - width + 1] == owner[width - 1 :]
    return mixed(rolled[inside]), owner[: total - width + 1][inside]


def word_slices(texts: Iterable[str], most: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Runs of texts, split into words, with about `most` words together, and where each run starts.

    Only one run is held in words at a time; one longer text makes a run of its own.
    """
    start, total, run = 0, 0, []
    for i, text in enumerate(texts):
        own = words_of(text)
        if total and total + len(own) > most:
            yield start, run
            start, total, run = i, 0, []
        run.append(own)
        total += len(own)
    if run:
        yield start, run


def slices(texts: list[str], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `chars` together, so that memory does not follow the batch size."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values as byte planes; planes of zeros at the top are left out."""
    planes = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    used = max([k + 1 for k in range(8) if planes[k].any()], default=0)
    return bytes([used]) + np.ascontiguousarray(planes[:used]).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[: data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)
