from __future__ import annotations

import random

import numpy as np
import pytest

from watchtide.llm.components import components
from watchtide.llm.neardup import NearDup, deduplicated, minhash, near_duplicates, odd_sketch, shingle_set
from watchtide.llm.words import BLANKS, word_hashes
import watchtide.llm.words as words


def plain(rows, shingle, percent=80):
    """Component of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        k = min(shingle, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)), key=lambda t: rows[t][0])
                root[y] = x
    return {rows[i][0]: (len(s), rows[top(i)][0]) for i, s in enumerate(sets)}


def check(spark, rows, rule):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, rule).collect()}
    assert got == plain(rows, rule.shingle, rule.percent)


def families(seed, groups, copies, length, edits):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(groups):
        base = [draw.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            text = base[:]
            for _ in range(draw.randrange(edits)):
                text[draw.randrange(length)] = draw.choice(vocabulary)
            rows.append((draw.randrange(10**9), " ".join(text)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("shingle, edits", [(2, 12), (5, 5)])
def test_random_families(spark, shingle, edits):
    check(spark, families(1, 8, 12, 120, edits), NearDup(shingle=shingle))


def test_one_hot_family_in_small_blocks(spark):
    """A group whose members are near the threshold: most links are found in the blocks, not by leaders."""
    check(spark, families(2, 1, 150, 100, 22), NearDup(shingle=2, block_rows=16))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one "), (6, "one two"), (7, "ONE\vTWO"), (8, "É two"), (9, "é two"), (-3, "one two")]
    check(spark, rows, NearDup(shingle=2))
    long = " ".join(f"t{i}" for i in range(60_000))
    check(spark, [(1, long), (2, long + " end"), (3, long[:1000])], NearDup())


def test_repeated_rows_null_ids_and_own_columns(spark):
    rows = [(5, "a b c d", 1), (5, "a b c d", 2), (5, "x y z q", 3), (2, "a b c d", 4), (None, "a b c d", 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumnRenamed("n", "node")
    got = near_duplicates(df, NearDup(shingle=2)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(2, 2), (5, 2), (5, 2), (5, 5)]
    assert [r.kept for r in got if r.doc_id is None] == [True, True]
    kept = deduplicated(df, NearDup(shingle=2))
    assert kept.columns == df.columns and sorted(r.node for r in kept.collect()) == [3, 4, 5, 6]
    twice = spark.createDataFrame([(1, "p q r s t u", 1)] * 3, "doc_id long, text string, x long")
    assert deduplicated(twice).count() == 1
    assert near_duplicates(df.limit(0)).collect() == [] and deduplicated(df.limit(0)).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 7), (101, 100), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_sketch_distance_follows_similarity():
    rule = NearDup()
    draw = np.random.default_rng(4)
    for share, near in ((0.9, True), (0.8, True), (0.2, False)):
        distances = []
        for _ in range(60):
            both = draw.integers(0, 2**64, int(1000 * share), dtype=np.uint64)
            own = [draw.integers(0, 2**64, int(1000 * (1 - share) / 2), dtype=np.uint64) for _ in range(2)]
            a, b = (odd_sketch(minhash(np.concatenate([both, o]), rule.hashes)) for o in own)
            distances.append(int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
        assert (max(distances) <= rule.furthest) if near else (min(distances) > rule.furthest)


def test_word_hashes_are_the_words(monkeypatch):
    text = "The cat\tTHE\x0bcat\r\nÉa éa \x1cx y" + " zz" * 1000
    expected = text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    hashes = word_hashes(text)
    assert len(hashes) == len(expected) and len(set(hashes.tolist())) == len(set(expected))
    monkeypatch.setattr(words, "SEGMENT", 5)
    assert (word_hashes(text, BLANKS) == hashes).all()
    assert len(shingle_set("a b", 5)) == 1 and len(shingle_set(None, 5)) == 0
