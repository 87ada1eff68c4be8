"""Vectorised hashing of the words of a text, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession

SEGMENT = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Bytes that part words: space and 0x09 to 0x0D. All others belong to words.
BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Everything but ASCII letters, ASCII digits and the bytes of other letters.
PUNCTUATION = ~np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])

_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the bytes of the Arrow batches sent to Python, so that long texts make small batches."""
    if int(spark.conf.get(_BATCH_BYTES).rstrip("b")) > 1 << 22:
        spark.conf.set(_BATCH_BYTES, str(1 << 22))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class _Powers:
    """Powers of the multiplier and of its inverse, modulo 2**64, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SEGMENT, 2 * len(self.up))
            factors = np.full(size, _MULTIPLIER, np.uint64)
            inverse = np.full(size, pow(_MULTIPLIER, -1, 2**64), np.uint64)
            factors[0] = inverse[0] = 1
            self.up, self.down = np.cumprod(factors, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def _segments(data: bytes, parts: np.ndarray) -> Iterator[np.ndarray]:
    """The bytes in pieces of about ``SEGMENT`` that never cut a word."""
    codes = np.frombuffer(data, np.uint8)
    start = 0
    while start < len(codes):
        end = start + SEGMENT
        while end < len(codes):
            gaps = np.flatnonzero(parts[codes[end : end + SEGMENT]])
            if len(gaps):
                end += int(gaps[0])
                break
            end += SEGMENT
        yield codes[start:end]
        start = end


def word_hashes(text: str | None, parts: np.ndarray = BLANKS) -> np.ndarray:
    """A 64-bit hash of each word of the text in order, A-Z taken as a-z; empty for null or wordless texts.

    The hash of a word is a sum of byte codes times powers of an odd number, so prefix sums give all words of a
    segment at once.
    """
    found = []
    for codes in _segments((text or "").encode("utf-8", "surrogatepass"), parts):
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = ~parts[codes]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        up, down = _POWERS.upto(len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_CODES[codes] * up[: len(codes)], out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * down[starts]))
    return np.concatenate(found) if found else np.empty(0, np.uint64)
