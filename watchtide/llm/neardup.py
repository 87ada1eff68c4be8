"""Near-duplicate documents by MinHash bands, odd sketches and an exact check of the word shingles.

1. Every text becomes the set of its distinct word shingles, as 64-bit hashes. Texts with equal sets are one *node*
   from here on, so a group of exact copies costs one row.
2. A node gets ``hashes`` MinHash samples. Bands of ``rows`` samples name its *buckets*; the samples are also folded
   into an odd sketch: a bitmap in which each sample flips one bit.
3. In every bucket all nodes are compared with the least one, the leader. The bits in which two odd sketches differ
   estimate the similarity; pairs well below the threshold go, and the others are decided on their full sets.
4. Links make components. A bucket whose members still lie in several components is compared in full, block by block:
   sketches first, then full sets of the rows that have a candidate left, each pair in the first bucket it shares
   only. Tasks write links, never pairs.

Two sets of similarity 0.8 share no bucket with probability (1 - 0.8**5)**36 = 6e-7; higher ones less. Longer bands
would leave more of such pairs out, shorter ones would bring unlike texts together, whose number grows as the square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from watchtide.llm.bitmap import gathered_bitmap, in_bitmap
from watchtide.llm.components import components
from watchtide.llm.words import bounded_batches, mixed, word_hashes
from watchtide.storage import stored

_CHUNK = 512
_SKETCH_LONGS = 8
_SKETCH = [f"s{i}" for i in range(_SKETCH_LONGS)]
_TASK = ["bucket", "low", "high"]


@dataclass(frozen=True)
class NearDup:
    """What counts as near: word ``shingle`` length and similarity in percent, and the shape of the search."""

    shingle: int = 5
    percent: int = 80
    bands: int = 36
    rows: int = 5
    slack: float = 0.22
    block_rows: int = 512
    block_shingles: int = 1 << 20
    bitmap_bits: int = 1 << 24

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def furthest(self) -> int:
        """Differing sketch bits that are still compatible with the threshold, ``slack`` of similarity allowed.

        Each of the hashes * (1 - J) differing samples flips two of n bits, so n/2 * (1 - exp(-4 hashes (1 - J) / n))
        differ on average.
        """
        n = 64 * _SKETCH_LONGS
        return round(n / 2 * (1 - math.exp(-4 * self.hashes * (1 - self.percent / 100 + self.slack) / n)))


def shingle_set(text: str | None, length: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of all words together when there are fewer than ``length``."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(length, len(words))
    count = len(words) - width + 1
    hashes = np.zeros(count, np.uint64)
    for i in range(width):
        hashes = mixed(hashes + words[i : i + count])
    hashes.sort()
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def minhash(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash samples of a set that is not empty."""
    values, by = (shingles >> np.uint64(32)).astype(np.uint32), _multipliers(n)
    least = np.full(n, 2**32 - 1, np.uint32)
    for i in range(0, len(values), _CHUNK):
        np.minimum(least, (values[i : i + _CHUNK, None] * by).min(0), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Bitmap of 512 bits: each sample flips the bit that its value and its number choose."""
    numbers = np.arange(len(samples), dtype=np.uint64) << np.uint64(32)
    bits = mixed(samples.astype(np.uint64) | numbers) >> np.uint64(64 - 9)
    flips = np.bincount(bits.astype(np.int64), minlength=64 * _SKETCH_LONGS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _signatures(rule: NearDup, kind: str):
    band = np.arange(rule.bands, dtype=np.uint64)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, version, text in zip(batch["id"], batch["version"], batch["text"]):
                shingles = shingle_set(text, rule.shingle)
                if not len(shingles):
                    rows.append((key, version, 0, None, None, *[None] * _SKETCH_LONGS))
                    continue
                samples = minhash(shingles, rule.hashes)
                buckets = band.copy()
                for i in range(rule.rows):
                    buckets = mixed(buckets + samples[i :: rule.rows])
                name = xxhash.xxh3_128_digest(shingles.tobytes())
                rows.append((key, version, len(shingles), name, buckets.view(np.int64), *odd_sketch(samples).tolist()))
            yield pd.DataFrame(rows, columns=["id", "version", "n", "name", "buckets", *_SKETCH])

    return of, f"id {kind}, version bigint, n bigint, name binary, buckets array<bigint>, " + ", ".join(f"{s} bigint" for s in _SKETCH)


def _sets(texts: DataFrame, wanted: DataFrame, rule: NearDup) -> DataFrame:
    """``(node, shingles)``: the full sets of the texts whose ids are ``wanted``, and of few others.

    Texts are never shuffled: a bitmap of fixed size, made of the wanted ids, picks them where they are read. Those
    that it lets pass by chance find no partner in the joins that follow.
    """
    bits = rule.bitmap_bits
    mark = F.pmod(F.xxhash64("id"), F.lit(bits))
    bitmap = gathered_bitmap(wanted.select(mark.alias("mark")), bits)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[in_bitmap(bitmap, batch["mark"].to_numpy())]
            sets = [shingle_set(t, rule.shingle).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"node": batch["id"].to_numpy(), "shingles": sets})

    kind = texts.schema["id"].dataType.simpleString()
    return texts.filter("id is not null").withColumn("mark", mark).mapInPandas(of, f"node {kind}, shingles binary")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the similarity of two sorted sets reaches the threshold."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _star_links(pairs: DataFrame, sets: DataFrame, rule: NearDup) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets reach the threshold."""
    kind = pairs.schema["u"].dataType.simpleString()
    with_sets = pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v").join(
        sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u"
    )

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint64) for x in batch[c]] for c in "ab")
            yield batch.loc[[_linked(x, y, rule.percent) for x, y in zip(a, b)], ["u", "v"]]

    return with_sets.select("u", "v", "a", "b").mapInPandas(of, f"u {kind}, v {kind}")


def _apart(a: str, b: str):
    """Sketch bits in which two rows differ."""
    return sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in _SKETCH[1:]), F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))))


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of rows sorted by task that hold whole tasks, with where each task starts and the end of the last."""
    rest = None
    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        keys = frame[_TASK].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])[: len(keys)])
        if len(starts) > 1:
            yield frame.iloc[: starts[-1]], starts
        rest = frame.iloc[starts[-1] :] if len(starts) else None
    if rest is not None:
        yield rest, np.array([0, len(rest)])


def _candidates(frame: pd.DataFrame, starts: np.ndarray, rule: NearDup) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(task, row, others)``: rows of the other block that a row's sketch leaves and that share no earlier bucket."""
    sketches = frame[_SKETCH].to_numpy(np.int64).view(np.uint64)  # bits of signed numbers are counted without the sign
    buckets = np.stack(frame["buckets"].to_numpy())
    bands, sizes, parts = frame["band"].to_numpy(), frame["n"].to_numpy(), pd.factorize(frame["component"])[0]
    in_low, one_block = (frame["block"] == frame["low"]).to_numpy(), (frame["low"] == frame["high"]).to_numpy()
    for task, (start, end) in enumerate(zip(starts[:-1], starts[1:])):
        rows = np.arange(start, end)
        low, high = rows[in_low[start:end]], rows[~in_low[start:end]]
        for i in low:
            others = low[low > i] if one_block[start] else high
            others = others[parts[others] != parts[i]]
            near = np.bitwise_count(sketches[others] ^ sketches[i]).sum(1, dtype=np.int64) <= rule.furthest
            near &= 100 * np.minimum(sizes[others], sizes[i]) >= rule.percent * np.maximum(sizes[others], sizes[i])
            others = others[near]
            if len(others):
                others = others[(buckets[others] == buckets[i]).argmax(1) == bands[start]]
            if len(others):
                yield task, i, others


def _with_candidates(rule: NearDup):
    """The rows that have a candidate."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in _whole_groups(batches):
            kept = np.zeros(len(frame), bool)
            for _, i, others in _candidates(frame, starts, rule):
                kept[i] = kept[others] = True
            yield frame[kept]

    return of


def _block_links(rule: NearDup):
    """Links between components, from rows with their sets: a forest per task at most."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in _whole_groups(batches):
            sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
            nodes, root = frame["node"].to_numpy(), pd.factorize(frame["component"])[0]
            parent: dict[tuple[int, int], tuple[int, int]] = {}

            def top(x):
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            links = []
            for task, i, others in _candidates(frame, starts, rule):
                for j in others:
                    x, y = top((task, root[i])), top((task, root[j]))
                    if x != y and _linked(sets[i], sets[j], rule.percent):
                        parent[x] = y
                        links.append((nodes[i], nodes[j]))
            yield pd.DataFrame(links, columns=["u", "v"])

    return of


def _by_task(rows: DataFrame) -> DataFrame:
    """Rows of a task side by side. Tasks cost time rather than bytes, so the partitions are not joined by size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *_TASK).sortWithinPartitions(*_TASK)


def _late_links(members: DataFrame, labels: DataFrame, features: DataFrame, texts: DataFrame, rule: NearDup) -> DataFrame:
    """Links that the leaders missed, from buckets whose other members lie in several components."""
    kind = members.schema["node"].dataType.simpleString()
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
    # The largest known part of a bucket is that of its leader; its members need no comparison with each other.
    led = labels.select(F.col("node").alias("leader"), F.col("root").alias("leader_root"))
    labelled = labelled.join(led, "leader", "left").withColumn("major", F.col("component") == F.coalesce("leader_root", "leader"))
    per_bucket = (
        labelled.filter("node <> leader")
        .groupBy("bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .filter("least < most")
        .select("bucket")
    )
    open_members = stored(labelled.filter("node <> leader").join(per_bucket, "bucket", "left_semi").select("bucket", "node", "component", "major"), "open")
    rows = open_members.join(features.select("node", "n", "buckets", *_SKETCH), "node")
    blocks = rows.groupBy("bucket", "major").agg(
        F.ceil(F.greatest(F.count("*") / rule.block_rows, F.sum("n") / rule.block_shingles)).alias("blocks")
    )
    counts = blocks.groupBy("bucket").agg(
        F.coalesce(F.max(F.when(F.col("major"), F.col("blocks"))), F.lit(0)).alias("majors"),
        F.coalesce(F.max(F.when(~F.col("major"), F.col("blocks"))), F.lit(0)).alias("minors"),
    )
    # Minor blocks are numbered from 0 and meet all blocks; major blocks follow and meet minor ones only.
    dealt = rows.join(counts, "bucket").withColumn(
        "block",
        F.when(F.col("major"), F.col("minors") + F.pmod(F.xxhash64("node"), F.col("majors"))).otherwise(F.pmod(F.xxhash64("node"), F.col("minors"))),
    )
    partners = F.when(F.col("major"), F.sequence(F.lit(0).cast("bigint"), F.col("minors") - 1)).otherwise(
        F.sequence(F.lit(0).cast("bigint"), F.col("minors") + F.col("majors") - 1)
    )
    tasks = dealt.filter("minors > 0").withColumn("other", F.explode(partners)).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other"), "band": F.array_position("buckets", F.col("bucket")) - 1}
    )
    bare = tasks.select(*_TASK, "block", "band", "node", "component", "n", "buckets", *_SKETCH)
    # Sets are fetched for the rows that still have a candidate, and for no other.
    near = stored(_by_task(bare).mapInPandas(_with_candidates(rule), bare.schema), "candidates")
    sets = _sets(texts, near.select(F.col("node").alias("id")), rule)
    return _by_task(near.join(sets, "node")).mapInPandas(_block_links(rule), f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, rule: NearDup = NearDup(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles``, ``component_id``, ``kept`` and ``text_hash`` to tell texts apart.

    Linked are texts whose shingle sets overlap to at least ``rule.percent`` of their union; ``component_id`` is the
    least id that can be reached over links, and ``kept`` marks the rows that bear it. Null texts, and texts without
    words, have 0 shingles and are linked with nothing. Rows that share an id are each judged by their own text, and
    links of one hold for all. Rows without an id have no component and are kept; they link nothing. Other columns,
    whatever their names, are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    of, schema = _signatures(rule, docs.schema[id].dataType.simpleString())
    signatures = stored(texts.withColumn("version", F.xxhash64("text")).mapInPandas(of, schema), "signatures")
    named = signatures.filter("id is not null and n > 0")
    nodes = named.groupBy("name").agg(F.min("id").alias("node"))
    features = stored(
        named.join(nodes.withColumnRenamed("node", "id"), ["name", "id"], "left_semi").select(F.col("id").alias("node"), "n", "buckets", *_SKETCH).distinct(),
        "features",
    )
    buckets = features.select("node", F.explode("buckets").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last").drop("last")
    members = stored(buckets.join(leaders, "bucket"), "members")
    pairs = members.filter("leader < node").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    narrow = features.select("node", "n", *_SKETCH)
    near = (
        pairs.join(narrow.alias("a"), F.col("u") == F.col("a.node"))
        .join(narrow.alias("b"), F.col("v") == F.col("b.node"))
        .filter(100 * F.least("a.n", "b.n") >= rule.percent * F.greatest("a.n", "b.n"))
        .filter(_apart("a", "b") <= rule.furthest)
        .select("u", "v")
    )
    near = stored(near, "pairs")
    wanted = near.select(F.col("u").alias("id")).union(near.select(F.col("v").alias("id")))
    links = _star_links(near, _sets(texts, wanted, rule), rule)
    stars = components(links)
    late = _late_links(members, stars, features, texts, rule)
    roots = components(stars.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(late))
    placed = nodes.join(roots, "node", "left").select("name", F.coalesce("root", "node").alias("component"))
    found = signatures.select("id", "version", "n", "name").join(placed, "name", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        F.col("version").alias("text_hash"),
    )


def deduplicated(docs: DataFrame, rule: NearDup = NearDup(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_duplicates`` keeps; of rows with one id and text only one.

    Rows without an id all stay.
    """
    found = stored(near_duplicates(docs, rule, id, text).select(F.col(id).alias("_id"), F.col("text_hash").alias("_hash"), "kept"), "classes")
    same = (docs[id] == F.col("_id")) & (F.xxhash64(docs[text]) == F.col("_hash"))
    kept = docs.join(found.filter("not kept").distinct(), same, "left_anti")
    again = stored(found.filter("kept and _id is not null").groupBy("_id", "_hash").count().filter("count > 1").select("_id", "_hash"), "again")
    if again.isEmpty():
        return kept
    once = docs.join(again, same, "left_semi").withColumn("_hash", F.xxhash64(docs[text])).dropDuplicates([id, "_hash"]).select(*docs.columns)
    return kept.join(again, same, "left_anti").unionByName(once)
