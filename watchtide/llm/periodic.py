"""Stretches of a text that repeat a period of words at least three times, found by block convolution.

Words become numbers. At each dyadic scale ``L`` the text is cut into blocks of ``L`` words. A run of period ``p`` with
``L <= p < 2 * L`` holds one of them whole, together with the same words ``p`` further on, so the block has a
zero-mismatch occurrence in the window that follows it. An exact integer transform of the sum of squared differences
finds all such occurrences of all blocks of a scale. Their distances are seeds: each is extended to both sides as far
as words that distance apart are equal, all seeds at once, by hashes of prefixes; what is reported is compared word by
word.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from watchtide.llm.convolution import squared_differences
from watchtide.llm.words import bounded_batches, mixed

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
#: Numbers in one transform, unless a single block needs more.
_CELLS = 1 << 18
_BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class RunRule:
    """A run has at least ``least`` words and at least ``times`` periods; ``times`` is 3 or more."""

    least: int = 24
    times: int = 3

    def __post_init__(self) -> None:
        if self.times < 3 or self.least < 1:
            raise ValueError("runs repeat their period at least three times")

    def first_block(self) -> int:
        """The longest block that every run of a period below twice its length must hold, with its occurrence."""
        length = 1
        while all(4 * length - 1 + p <= max(self.least, self.times * p) for p in range(1, 4 * length)):
            length *= 2
        return length


class _Prefixes:
    """Hashes of all prefixes of a word sequence, to compare its parts at once."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        self.powers = np.full(self.size + 1, _BASE, np.uint64)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * self.powers[:-1], out=self.sums[1:])

    def _same(self, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
        moved = (self.sums[first + length] - self.sums[first]) * self.powers[second - first]
        return moved == self.sums[second + length] - self.sums[second]

    def _longest(self, at_most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros_like(at_most), at_most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = same(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low

    def stretch(self, at: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the stretches around ``at`` in which words ``distance`` apart are equal."""
        after = self._longest(self.size - at - distance, lambda n: self._same(at, at + distance, n))
        before = self._longest(at, lambda n: self._same(at - n, at + distance - n, n))
        return at - before, at + distance + after


def _gaps(codes: np.ndarray) -> np.ndarray:
    """How far on each word comes again; more than any distance for the last of its kind."""
    order = np.argsort(codes, kind="stable")
    gaps = np.full(len(codes), 1 << 62, np.int64)
    again = codes[order[1:]] == codes[order[:-1]]
    gaps[order[:-1][again]] = np.diff(order)[again]
    return gaps


def _occurrences(codes: np.ndarray, starts: np.ndarray, length: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances from ``nearest`` to ``2 * length - 1`` at which blocks of ``length`` words come again, and the first
    of each row of neighbouring blocks that do."""
    found = []
    padded = np.concatenate([codes, np.zeros(3 * length, np.int64)])
    for i in range(0, len(starts), max(1, _CELLS // (4 * length))):
        some = starts[i : i + max(1, _CELLS // (4 * length))]
        blocks, windows = (padded[some[:, None] + np.arange(n)] for n in (length, 3 * length - 1))
        zero = squared_differences(blocks, windows)[:, nearest:] == 0
        block, distance = np.nonzero(zero)
        found.append((some[block], distance + nearest))
    at, distance = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    # Neighbouring blocks with one distance lie in one stretch; the first of them stands for it.
    leads = np.concatenate([[True], (np.diff(distance) != 0) | (np.diff(at) != length)]) if len(at) else np.empty(0, bool)
    leads &= at + distance + length <= len(codes)
    return at[leads], distance[leads]


def _checked(codes: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The stretch itself where its words agree; where hashes were wrong, the longest part of it that does."""
    same = codes[start : end - period] == codes[start + period : end]
    if same.all():
        return start, end
    odd = np.flatnonzero(~same)
    edges = np.concatenate([[-1], odd, [len(same)]])
    widest = int(np.argmax(np.diff(edges)))
    return start + int(edges[widest]) + 1, start + int(edges[widest + 1]) + period


def periodic_runs(codes: np.ndarray, rule: RunRule = RunRule()) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs of a sequence of numbers, by start, then period.

    A run is a maximal stretch with smallest period ``period`` of at least ``rule.least`` words and ``rule.times``
    periods. A stretch is found by every multiple of its period that fits; the least is its own.
    """
    codes = np.asarray(codes, np.int64)
    n, length = len(codes), rule.first_block()
    if n < max(rule.least, rule.times):
        return np.empty((0, 3), np.int64)
    gaps = _gaps(codes)
    blocks = n // length
    # The farthest that a word of a block has to go to be found again: a block that comes again has it within reach.
    farthest = gaps[: blocks * length].reshape(blocks, length).max(axis=1)
    nearest, prefixes = 1, None
    found = np.empty((0, 3), np.int64)
    while nearest * rule.times <= n and len(farthest):
        starts = np.flatnonzero(farthest < 2 * length) * length
        if len(found) and len(starts):
            # Inside a run of a shorter period a block comes again at multiples of that period only.
            reach = np.zeros(n + 1, np.int64)
            np.maximum.at(reach, found[:, 0], found[:, 1])
            starts = starts[np.maximum.accumulate(reach)[starts] < np.minimum(starts + 3 * length - 1, n)]
        if len(starts):
            at, distance = _occurrences(codes, starts, length, nearest)
            if len(at):
                prefixes = prefixes or _Prefixes(codes)
                start, end = prefixes.stretch(at, distance)
                long = end - start >= np.maximum(rule.least, rule.times * distance)
                found = np.concatenate([found, np.unique(np.column_stack([start, end, distance])[long], axis=0)])
        nearest = 2 * length
        length *= 2
        farthest = farthest[: len(farthest) // 2 * 2].reshape(-1, 2).max(axis=1)
    periods: dict[tuple[int, int], list[int]] = {}
    for start, end, period in found[np.argsort(found[:, 2], kind="stable")].tolist():
        periods.setdefault((start, end), []).append(period)
    runs: dict[tuple[int, int], int] = {}
    for (start, end), tried in periods.items():
        for period in tried:
            checked = _checked(codes, start, end, period)
            if checked[1] - checked[0] >= max(rule.least, rule.times * period):
                runs[checked] = min(period, runs.get(checked, period))
            if checked == (start, end):
                break
    rows = sorted((start, period, end - start) for (start, end), period in runs.items())
    return np.array([(start, size, period) for start, period, size in rows], np.int64).reshape(-1, 3)


def word_runs(text: str | None, rule: RunRule = RunRule()) -> tuple[np.ndarray, str]:
    """The runs of a text's words, and the text without the repeats: what is left of its words, joined by a space."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    numbers: dict[bytes, int] = defaultdict(count(1).__next__)
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    runs = periodic_runs(codes, rule)
    if len(runs):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    return runs, b" ".join(words).decode("utf-8", "surrogatepass")


def with_runs(docs: DataFrame, text: str | Column = "text", rule: RunRule = RunRule()) -> DataFrame:
    """``docs`` with ``runs``, structs ``(start, length, period)`` by start, then period, and ``collapsed``.

    Words are what blanks (space and 0x09 to 0x0D) part, numbered from 0. ``collapsed`` holds the words that no run
    contains after its first period, joined by one space. Null, empty and wordless texts have no runs and an empty
    ``collapsed``. Rows are handled one by one, so repeated rows and ids give equal results, and nothing is shuffled;
    columns of the two names give way, others are left alone.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(f"runs {RUNS}, collapsed string")
    def found(texts: pa.Array) -> pa.Array:
        results = [word_runs(t, rule) for t in texts.to_pylist()]
        rows = np.concatenate([np.empty((0, 3), np.int64), *[runs for runs, _ in results]])
        offsets = np.concatenate([[0], np.cumsum([len(runs) for runs, _ in results])]).astype(np.int32)
        structs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], names=["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(offsets), structs)
        return pa.StructArray.from_arrays([lists, pa.array([c for _, c in results], pa.string())], names=["runs", "collapsed"])

    given = docs[text] if isinstance(text, str) else text
    kept = F.struct(*[docs[c] for c in docs.columns if c not in ("runs", "collapsed")])
    return docs.select(kept.alias("kept"), found(given).alias("found")).select("kept.*", "found.*")
