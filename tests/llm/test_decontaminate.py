from __future__ import annotations

import itertools
import random

import pytest

from watchtide.llm.decontaminate import Tiling, contained_items, decontaminated, tiles
from watchtide.llm.queries import op5_benchmark_decontamination


def plain_tiles(doc, item, width):
    """Greedy string tiling as it is defined: the longest free match, again and again."""
    used_d, used_i, found = set(), set(), []
    while True:
        best = None
        for i, d in itertools.product(range(len(item)), range(len(doc))):
            n = 0
            while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and d + n not in used_d and i + n not in used_i:
                n += 1
            if n >= width and (best is None or n > best[2]):
                best = (d, i, n)
        if best is None:
            return sorted(found)
        found.append(best)
        used_d.update(range(best[0], best[0] + best[2]))
        used_i.update(range(best[1], best[1] + best[2]))


def seeds(doc, item, width):
    return [
        (d, i) for d in range(len(doc) - width + 1) for i in range(len(item) - width + 1) if doc[d : d + width] == item[i : i + width]
    ]


@pytest.mark.parametrize("letters, width", [("ab", 2), ("abc", 3), ("abcdefgh", 2)])
def test_tiles_equal_the_definition(letters, width):
    draw = random.Random(6)
    for _ in range(150):
        doc, item = ([draw.choice(letters) for _ in range(draw.randrange(25))] for _ in range(2))
        assert tiles(seeds(doc, item, width), width) == plain_tiles(doc, item, width)


ITEM = "one two three four five six seven eight. nine ten eleven twelve thirteen fourteen fifteen sixteen"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, "too short here"), (3, None), (4, ""), (5, "a a a a a a a a a a"), (None, "item without an id but with words")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, items, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item string")
    return {(r.id, r.item): r for r in contained_items(docs, items).collect()}


def test_moved_and_partial_passages(spark, items):
    first, second = ITEM.split(". ")
    texts = [
        f"before {ITEM} after",
        f"{second}, then {first}!",
        first.upper(),
        " ".join(ITEM.split()[:7]),
        f"{first[:18]} x {first[18:]}",
        "a " * 5000,
        "item without\nan id, BUT with: words",
        None,
        "",
        "too short here",
        "filler " * 60_000 + ITEM,
    ]
    got = found(spark, items, texts)
    assert set(got) == {(0, 1), (1, 1), (2, 1), (5, 5), (6, None), (9, 2), (10, 1)}
    assert [got[k].coverage for k in ((0, 1), (1, 1), (2, 1), (5, 5))] == [1.0, 1.0, 0.5, 1.0]
    assert len(got[1, 1].tiles) == 2 and got[10, 1].tiles[0].doc_at == 60_000


def test_items_shorter_than_a_seed(spark):
    """They have to be there word by word, in one piece; one or two words are no passage; many places are one tile."""
    items = spark.createDataFrame([(1, "Blue, green red"), (2, "blue green"), (3, "w x y z"), (4, "again again again"), (5, "p q r s t")], "item_id long, text string")
    texts = ["so blue green RED it is", "blue then green red", "w x y", "v w x y z", "again " * 3000, "blue green", "p q r s", "p q r s t u"]
    got = found(spark, items, texts)
    assert set(got) == {(0, 1), (3, 3), (4, 4), (7, 5)}
    assert all(r.coverage == 1.0 and len(r.tiles) == 1 for r in got.values())
    assert got[4, 4].tiles[0].doc_at == 0
    longer = {(r.id, r.item) for r in contained_items(spark.createDataFrame([(0, "blue green")], "doc_id long, text string"), items, Tiling(shortest=1)).collect()}
    assert longer == {(0, 2)}


def test_rows_leave_or_stay(spark, items):
    docs = spark.createDataFrame(
        [(1, ITEM, 1), (1, "clean", 2), (None, ITEM, 3), (None, None, 4), (2, "clean", 5), (2, "clean", 5)], "doc_id long, text string, version int"
    )
    kept = decontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.version for r in kept.collect()) == [2, 4, 5, 5]
    assert decontaminated(docs.limit(0), items).collect() == []
    assert decontaminated(docs, items.limit(0)).count() == 6


def test_bitmap_only_saves_work(spark, items):
    docs = spark.createDataFrame([(i, ITEM if i % 2 else f"{i} other words stand here") for i in range(20)], "doc_id long, text string")
    for bits in (64, 1 << 16):
        assert sorted(r.id for r in contained_items(docs, items, Tiling(bitmap_bits=bits)).collect()) == list(range(1, 20, 2))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    words = lambda t: "".join(c.lower() if c.isascii() and c.isalnum() else c if ord(c) > 127 else " " for c in t or "").split()
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    expected = {}
    for (d, doc), (i, item) in itertools.product(docs.items(), items.items()):
        grams = {tuple(item[k : k + 5]) for k in range(len(item) - 4)}
        near = [k for k in range(len(doc) - 4) if tuple(doc[k : k + 5]) in grams]
        if near:
            part = doc[near[0] : near[-1] + 5]
            covered = sum(t[2] for t in plain_tiles(part, item, 5))
            if covered >= 0.5 * len(item):
                expected[d, i] = covered
    assert expected and {(r.doc_id, r.item_id): r.covered for r in op5_benchmark_decontamination(spark, sf).collect()} == expected
