"""Documents drawn by how much they resemble a target: hashed features, importance weights, exact selection.

1. Runs of words are hashed into a fixed number of buckets, counted over all documents and over the target. The log
   ratio of a bucket's shares is its gain, and the mean gain of a document's features its weight.
2. A hash of the id gives every document its own draw, added to the weight: the highest sums are a sample without
   replacement in proportion to the weights, alike in every run.
3. The cut is found without sorting what is cut off. Every partition names the median of its remaining keys; their
   median, weighted by the sizes of the partitions, has a guaranteed share of all keys on either side, one of which is
   discarded. When few are left, they are sorted and the exact key of the cut is known.
4. Only the winners are sorted and numbered.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from watchtide.llm.words import SEGMENT, bounded_batches
from watchtide.storage import stored

#: Bytes of words, A-Z already in lower case: digits, letters and all beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xFF]")
_IN_PART = (1 << 33) - 1
_ORDER = ("score", "none", "id", "row")
_NEW = ("n_words", "n_features", "weight", "score", "rank")


@dataclass(frozen=True)
class Resampling:
    """Share to draw, of documents of at least ``least_words``; features of 1 to ``grams`` words in ``buckets``.

    ``seed`` names the draw. ``settle`` is how many keys may be left when the selection ends with a sort.
    """

    percent: int = 25
    least_words: int = 20
    grams: int = 2
    buckets: int = 10_000
    seed: int = 7
    settle: int = 4096


def _word_lists(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + SEGMENT)
        end = gap.start() if gap else len(data)
        yield _WORD.findall(data, start, end)
        start = end


def features(text: str | None, rule: Resampling) -> Iterator[tuple[int, np.ndarray]]:
    """Of each part of a text, the number of its words and the buckets of the features that end in it."""
    tail: list[bytes] = []
    for new in _word_lists(text):
        words = tail + new
        spaced = [b" " + w for w in words]
        codes = list(map(crc32, words))
        found = codes[len(tail) :]
        for n in range(1, rule.grams):
            codes = list(map(crc32, spaced[n:], codes))
            found += codes[max(len(tail) - n, 0) :]
        yield len(new), np.array(found, np.int64) % rule.buckets
        tail = words[len(words) - rule.grams + 1 :] if rule.grams > 1 else []


def _counts(texts: DataFrame, rule: Resampling) -> np.ndarray:
    """How many features of all ``text`` rows lie in each bucket; every task adds its own up before they meet."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(rule.buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, buckets in features(text, rule):
                    counts += np.bincount(buckets, minlength=rule.buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    sums = texts.mapInArrow(of, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(rule.buckets, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def gains(all_counts: np.ndarray, target_counts: np.ndarray, rule: Resampling) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in the target and in all, one count added to every bucket."""
    whole, target = (float(c.sum()) + rule.buckets for c in (all_counts, target_counts))
    ratios = ((float(t) + 1) * whole / ((float(s) + 1) * target) for s, t in zip(all_counts.tolist(), target_counts.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _weighted(text: Column, gain: np.ndarray, rule: Resampling) -> Column:
    @F.arrow_udf("n_words bigint, n_features bigint, weight bigint")
    def weigh(texts: pa.Array) -> pa.Array:
        rows = np.zeros((3, len(texts)), np.int64)
        for i, text in enumerate(texts.to_pylist()):
            for words, buckets in features(text, rule):
                rows[:, i] += (words, len(buckets), gain[buckets].sum())
        rows[2] //= np.maximum(rows[1], 1)
        return pa.StructArray.from_arrays([pa.array(r) for r in rows], names=["n_words", "n_features", "weight"])

    return weigh(text)


def _draw(id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw, from the first 32 bits of a hash of the id. A null id reads as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def _key(values=None, types: dict[str, str] | None = None) -> Column:
    """The place of a row in the order: high scores, then ids, nulls last, then rows. Of a given row, as literals."""
    cell = lambda n: F.col(n) if values is None else F.lit(values[n]).cast(types[n])
    return F.struct((-cell("score")).alias("score"), *[cell(n).alias(n) for n in _ORDER[1:]])


def _medians(keys: DataFrame) -> DataFrame:
    """One row per partition that has rows: its median key, and ``rows``, how many it has."""
    by = [("score", "descending"), ("none", "ascending"), ("id", "ascending"), ("row", "ascending")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if held is not None and held.num_rows:
            order = pc.sort_indices(held, sort_keys=by)
            median = held.take(order.slice((held.num_rows - 1) // 2, 1))
            yield from median.append_column("rows", pa.array([held.num_rows], pa.int64())).combine_chunks().to_batches()

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema)
    return keys.mapInArrow(of, f"{types}, rows bigint")


def _pivot(keys: DataFrame) -> Row:
    """The median of the partitions' medians, weighted by their sizes. One row per partition is all that meets."""
    so_far = Window.orderBy(_key()).rowsBetween(Window.unboundedPreceding, 0)
    summed = _medians(keys).withColumns({"so_far": F.sum("rows").over(so_far), "all": F.sum("rows").over(Window.partitionBy())})
    return summed.filter(2 * F.col("so_far") >= F.col("all")).orderBy("so_far").first()


def cut_key(keys: DataFrame, place: int, rows: int, settle: int) -> Row:
    """The key at ``place`` (from 1) in the order of ``keys (score, none, id, row)``, which are ``rows`` different ones.

    Each round keeps the keys on one side of a pivot that has at least about a quarter of them on either side. When
    less than a quarter of what was last written is left, it is written anew, so all rounds together read no more than
    a few times the keys.
    """
    types = {f.name: f.dataType.simpleString() for f in keys.schema}
    written = rows
    while rows > max(settle, 1):
        pivot = _pivot(keys)
        here = _key(pivot, types)
        first = keys.filter(_key() <= here).count()
        if first == place:
            return pivot
        keys = keys.filter(_key() < here if first > place else _key() > here)
        place, rows = (place, first - 1) if first > place else (place - first, rows - first)
        if 4 * rows < written:
            keys, written = stored(keys, "keys"), rows
    return keys.orderBy(_key()).offset(place - 1).first()


def _numbered(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank``, from 1 in their order: sorted in ranges, ranges numbered side by side."""
    order = [F.desc("score"), *_ORDER[1:]]
    ranged = winners.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "winners")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit(_IN_PART))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("part")).agg((F.max(within) + 1).alias("rows"))
    sizes = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return placed.join(sizes, part == sizes["part"]).withColumn("rank", F.col("before") + within + 1)


def resampled(docs: DataFrame, target: DataFrame, rule: Resampling = Resampling(), id: str = "doc_id", text: str = "text", target_text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` of all ``docs`` (all when None) with ``n_words, n_features, weight, score, rank``.

    Words are runs of letters, digits and all beyond ASCII, A-Z taken as a-z. ``rank`` numbers the drawn documents from
    1 by score, highest first, ties by id, null ids last; it is null for those not drawn. Of the documents with at
    least ``rule.least_words`` words, ``rule.percent`` in a hundred are drawn, rounded down. Null and wordless texts
    have no features and weight 0. Every row is a document of its own: rows of one id share a draw, equal rows are told
    apart by where they are stored. An empty target makes all gains follow the documents alone; empty ``docs`` give no
    rows. Columns of the new names give way.
    """
    bounded_batches(docs.sparkSession)
    gain = gains(_counts(docs.select(text), rule), _counts(target.select(target_text), rule), rule)
    kept = [docs[c] for c in (docs.columns if keep is None else keep) if c not in _NEW]
    scored = docs.select(F.struct(*kept).alias("kept") if kept else F.lit(None).alias("kept"), docs[id].alias("id"), _weighted(docs[text], gain, rule).alias("found"))
    scored = scored.select("kept", "id", F.col("id").isNull().alias("none"), "found.*", F.monotonically_increasing_id().alias("row"))
    scored = stored(scored.withColumn("score", F.col("weight") + _draw(F.col("id"), rule.seed)), "scored")
    able = F.col("n_words") >= rule.least_words
    rows = scored.filter(able).count()
    place = rule.percent * rows // 100
    new = ["n_words", "n_features", "weight", "score"]
    out = lambda df, rank: df.select(*(["kept.*"] if kept else []), *new, rank.cast("bigint").alias("rank"))
    if not place:
        return out(scored, F.lit(None))
    keys = scored.filter(able).select(*_ORDER)
    cut = cut_key(keys, place, rows, rule.settle)
    won = able & (_key() <= _key(cut, {f.name: f.dataType.simpleString() for f in keys.schema}))
    return out(_numbered(scored.filter(won)), F.col("rank")).unionByName(out(scored.filter(~won), F.lit(None)))


def drawn(docs: DataFrame, target: DataFrame, rule: Resampling = Resampling(), **names: str) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns but those that the new names take."""
    return resampled(docs, target, rule, **names).filter("rank is not null").drop(*_NEW)
