from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from watchtide.llm import prefix
from watchtide.llm.mixing import Mix, mixed, repeated
from watchtide.llm.sharding import Leaf, grown, planned, with_shards, with_slots

SCHEMA = "doc_id long, text string, source string, shard string, _key int"


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(9)
    rows = [(i, " ".join(["wörd"] * draw.randrange(0, 60)), draw.choice(["a", "a", "a", "b", "é", None]), "own", i) for i in range(3000)]
    rows += [(None, None, None, "own", 1), (7, "again", "a", "own", 2), (7, "again", "a", "own", 2), (10**6, "x " * 30_000, "b", "own", 3)]
    return spark.createDataFrame(rows, SCHEMA)


def descend(key, tree):
    """The shard of a key, level by level, in plain Python."""
    path, level = "", list(tree)
    for depth in range(3):
        children = defaultdict(float)
        for leaf in level:
            children["/".join([leaf.region, leaf.rack, str(leaf.shard)][: depth + 1])] += leaf.weight

        def draw(child):
            u = (int(hashlib.md5(f"{'' if key is None else key}/{child}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / children[child]

        path = min(sorted(c for c in children if children[c] > 0), key=draw)
        level = [x for x in level if "/".join([x.region, x.rack, str(x.shard)]).startswith(path)]
    return int(path.rsplit("/")[-1])


def test_shards(spark, docs, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_ROWS", 100)
    tree = planned(16)
    rows = with_slots(with_shards(docs, tree, grown(tree))).collect()
    assert len(rows) == 3004 and rows[0].asDict().keys() >= {"doc_id", "text", "source", "_key", "slot"}
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.shard == descend(r.doc_id, tree) and r.grown_shard == descend(r.doc_id, grown(tree))
        assert r.grown_shard in (r.shard, 16)
    for shard in range(16):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    counts = Counter(r.shard for r in rows)
    assert len(counts) == 16 and max(counts.values()) < 1.4 * min(counts.values())
    assert 100 < sum(r.grown_shard == 16 for r in rows) < 260


def test_movement_stays_in_the_changed_subtree(docs):
    tree = planned(16)
    heavier = tuple(Leaf(x.shard, x.region, x.rack, 3.0) if x.shard == 5 else x for x in tree)
    moved = [(r.shard, r.grown_shard) for r in with_shards(docs, tree, heavier).collect() if r.shard != r.grown_shard]
    assert moved and {to // 8 for _, to in moved} == {0}
    assert {to // 4 for of, to in moved if of // 8 == 0} == {1}
    assert {to for of, to in moved if of // 4 == 1} == {5}
    emptied = tuple(Leaf(x.shard, x.region, x.rack, 0.0) if x.shard == 5 else x for x in tree)
    assert {r.grown_shard for r in with_shards(docs, tree, emptied).collect()} == set(range(16)) - {5}


def test_bad_trees_and_empty_table(spark, docs):
    for bad in ((), (Leaf(0, "a", "b", 0.0),), (Leaf(0, "a", "b", float("nan")),)):
        with pytest.raises(ValueError):
            with_shards(docs, bad)
    assert with_slots(with_shards(docs.limit(0), planned(16))).collect() == []
    assert {r.shard for r in with_shards(docs, (Leaf(4, "a", "b"),)).collect()} == {4}


def levels(sizes, weights, percent=1.0, passes=3):
    """Targets by sharing what is over the limit again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()) * percent, set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > passes * sizes[s]}
        for s in full or open_:
            target[s] = passes * sizes[s] if full else share[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    return target


@pytest.mark.parametrize("weights", [(5.0, 2.0, 1.0), (1.0,), (0.1, 30.0)])
def test_mix_meets_its_targets(docs, monkeypatch, weights):
    monkeypatch.setattr(prefix, "BUCKET_ROWS", 100)
    rows = mixed(docs, Mix(weights=weights)).collect()
    assert len(rows) == 3004 and set(docs.columns) < set(rows[0].asDict())
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    target = levels(sizes, weights)
    for s in sizes:
        assert {r.source_size for r in rows if r.source == s} == {sizes[s]}
        assert all(abs(r.target - target[s]) < 1e-6 * sum(sizes.values()) for r in rows if r.source == s)
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    again = mixed(docs, Mix(weights=weights)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_whole_documents(docs):
    rows = mixed(docs, Mix(whole=True)).collect()
    assert all(r.taken == r.copies * r.size and r.copies <= 3 for r in rows)
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
    largest = max(r.size for r in rows)
    assert all(abs(taken[r.source] - r.target) <= largest for r in rows)
    copies = repeated(docs, Mix(whole=True))
    assert copies.columns == docs.columns
    assert Counter(map(tuple, copies.collect())) == Counter({k: n for k, n in _times(rows, docs.columns).items() if n})


def _times(rows, columns):
    times = Counter()
    for r in rows:
        times[tuple(r[c] for c in columns)] += r.copies
    return times


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixed(empty).collect() == [] and repeated(empty, Mix(whole=True)).collect() == []
    wordless = spark.createDataFrame([(1, None, "a", "", 0), (2, " ", None, "", 0)], SCHEMA)
    assert [(r.size, r.taken, r.target) for r in mixed(wordless).collect()] == [(0, 0, 0.0)] * 2
    assert repeated(wordless, Mix(whole=True)).count() == 2
