"""Benchmark passages in documents, in whatever order their parts come, by greedy string tiling.

1. Rolling Karp-Rabin hashes of ``seed`` neighbouring words are taken of benchmark items and documents; an item of fewer
   words has one hash of its whole length, and documents are hashed at each such length that occurs. A bitmap of
   fixed size, made of the items' hashes, sorts out nearly all hashes of the documents where they are read; a join
   decides on the rest.
2. Seeds that follow each other in an item and in a document run together into matches. The longest match is marked as
   a tile, what it covers is taken from the others, and so on until no match of ``seed`` words is left.
3. An item is contained in a document when tiles cover a share of its words. Moved sentences still make tiles.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from watchtide.llm.bitmap import gathered_bitmap, in_bitmap
from watchtide.llm.words import PUNCTUATION, bounded_batches, mixed, word_hashes
from watchtide.storage import stored

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Tiling:
    """Words of the shortest tile, share of an item that must be covered, words of the shortest item (one or two words
    are an everyday phrase, and every text that has it would count as contaminated), and size of the bitmap."""

    seed: int = 5
    coverage: float = 0.5
    shortest: int = 3
    bitmap_bits: int = 1 << 23


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of every ``width`` neighbouring words, from prefix sums modulo 2**64; none if there are fewer."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    hashes = np.zeros(count, np.uint64)
    for i in range(width):
        hashes = hashes * _BASE + words[i : i + count]
    return mixed(hashes)


def tiles(pairs: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(document word, item word, length)`` from the places of shared seeds.

    Longest first; of equal ones the first in the item, then in the document. No word of either side is in two tiles.
    """
    runs: list[tuple[int, int, int]] = []
    for d, i in sorted(set(pairs), key=lambda p: (p[0] - p[1], p[1])):
        if runs and runs[-1][0] - runs[-1][1] == d - i and runs[-1][1] + runs[-1][2] - width + 1 == i:
            runs[-1] = (*runs[-1][:2], runs[-1][2] + 1)
        else:
            runs.append((d, i, width))
    heap = [(-n, i, d) for d, i, n in runs]
    heapq.heapify(heap)
    used_d: set[int] = set()
    used_i: set[int] = set()
    found = []
    while heap:
        n, i, d = heapq.heappop(heap)
        free = [d + k not in used_d and i + k not in used_i for k in range(-n)]
        if all(free):
            found.append((d, i, -n))
            used_d.update(range(d, d - n))
            used_i.update(range(i, i - n))
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= width:
                    heapq.heappush(heap, (start - k, i + start, d + start))
                start = None
    return sorted(found)


def _seeds(items: DataFrame, rule: Tiling) -> DataFrame:
    """``(item, words, at, seed)`` of every item that is long enough; a seed is as long as the item where that is shorter."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [word_hashes(t, PUNCTUATION) for t in batch["text"]]
            seeds = [rolling(w, min(rule.seed, max(rule.shortest, len(w)))).view(np.int64) for w in words]
            yield pd.DataFrame({"item": batch["item"], "words": [len(w) for w in words], "seeds": seeds})

    rows = items.mapInPandas(of, f"item {items.schema['item'].dataType.simpleString()}, words int, seeds array<bigint>")
    return rows.select("item", "words", F.posexplode("seeds").alias("at", "seed"))


def _hits(texts: DataFrame, bitmap: np.ndarray, widths: list[int]) -> DataFrame:
    """``(id, version, width, at, seed)`` of the document seeds, of any of the widths, that the bitmap lets pass."""
    bits = 64 * len(bitmap)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, version, text in zip(batch["id"], batch["version"], batch["text"]):
                words = word_hashes(text, PUNCTUATION)
                for width in widths:
                    seeds = rolling(words, width).view(np.int64)
                    at = np.flatnonzero(in_bitmap(bitmap, np.mod(seeds, bits)))
                    if len(at):
                        rows.append((key, version, width, at, seeds[at]))
            yield pd.DataFrame(rows, columns=["id", "version", "width", "at", "seed"])

    kind = texts.schema["id"].dataType.simpleString()
    rows = texts.mapInPandas(of, f"id {kind}, version bigint, width int, at array<bigint>, seed array<bigint>")
    hit = rows.select("id", "version", "width", F.explode(F.arrays_zip("at", "seed")).alias("hit"))
    return hit.select("id", "version", "width", F.col("hit.at").cast("int").alias("at"), F.col("hit.seed").alias("seed"))


def contained_items(docs: DataFrame, items: DataFrame, rule: Tiling = Tiling(), id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(id, version, item, item_words, covered, coverage, longest, tiles)`` of every document that contains an item.

    Words are runs of letters and digits, A-Z taken as a-z. ``version`` is the hash of the text, which tells rows of
    one id apart; equal rows count once. Null or empty texts and items, and items of fewer
    than ``rule.shortest`` words, match nothing; an item of fewer words than a seed is contained where all its words
    follow each other; rows without an id are documents like others. Items that share an id and a length count as one. Empty
    tables give no rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    seeds = stored(_seeds(items.select(items[item_id].alias("item"), items[item_text].alias("text")), rule).distinct(), "seeds")
    bitmap = gathered_bitmap(seeds.select(F.pmod("seed", F.lit(rule.bitmap_bits)).alias("mark")), rule.bitmap_bits)
    texts = docs.select(docs[id].alias("id"), F.xxhash64(docs[text]).alias("version"), docs[text].alias("text"))
    width = F.least("words", F.lit(rule.seed))
    # There are as many widths as a seed has words at most.
    widths = sorted(r[0] for r in seeds.select(width).distinct().collect())
    hits = _hits(texts, bitmap, widths)
    places = seeds.select("seed", "item", "words", F.col("at").alias("item_at"), width.alias("width"))
    place, short = F.struct("at", "item_at"), F.col("words") < rule.seed
    # A short item lies in its first place as a whole, so its other places are not gathered.
    grouped = hits.join(places, ["seed", "width"]).groupBy("id", "version", "item", "words").agg(F.collect_set(F.when(~short, place)).alias("pairs"), F.min(F.when(short, place)).alias("first"))
    pairs = grouped.select("id", "version", "item", "words", F.when(short, F.array("first")).otherwise(F.col("pairs")).alias("pairs"))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [tiles([(p["at"], p["item_at"]) for p in pairs], min(rule.seed, n)) for pairs, n in zip(batch["pairs"], batch["words"])]
            out = batch[["id", "version", "item", "words"]].copy()
            out["covered"] = [sum(t[2] for t in f) for f in found]
            out["tiles"] = [[{"doc_at": d, "item_at": i, "length": n} for d, i, n in f] for f in found]
            yield out

    kinds = [docs.schema[id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()]
    tiled = pairs.mapInPandas(of, f"id {kinds[0]}, version bigint, item {kinds[1]}, words int, covered int, tiles array<struct<doc_at:int,item_at:int,length:int>>")
    return tiled.withColumn("coverage", F.col("covered") / F.col("words")).filter(F.col("coverage") >= rule.coverage)


def decontaminated(docs: DataFrame, items: DataFrame, rule: Tiling = Tiling(), id: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """The rows of ``docs``, all columns, whose text contains no benchmark item."""
    found = stored(contained_items(docs, items, rule, id, text, **names).select("id", "version").distinct(), "contained")
    same = docs[id].eqNullSafe(found["id"]) & (F.xxhash64(docs[text]) == found["version"])
    return docs.join(found, same, "left_anti")
