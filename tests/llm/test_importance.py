from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from watchtide.llm import importance, queries
from watchtide.llm.importance import Resampling, cut_key, drawn, features, resampled

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def named(text, grams):
    words = WORDS.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, rule):
    """``id: [(n_features, weight, score, rank)]`` by the definition."""
    bucket = lambda f: zlib.crc32(f.encode()) % rule.buckets
    split = [(i, *named(t, rule.grams)) for i, t in docs]
    s = Counter(bucket(f) for _, _, fs in split for f in fs)
    t = Counter(bucket(f) for text in target for f in named(text, rule.grams)[1])
    whole, aim = sum(s.values()) + rule.buckets, sum(t.values()) + rule.buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * whole / ((s[b] + 1) * aim)))
    rows = []
    for key, words, found in split:
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{rule.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= rule.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(r): n for n, r in enumerate(able[: rule.percent * len(able) // 100], 1)}
    return Counter((r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in rows)


def corpus(seed=3, count=400):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)] + ["Ünï", "ÜNÏ", "中文", "x_y", "A'b"]
    rows = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(0, 60)))) for i in range(count)]
    # A third of the rows is one row, repeated.
    rows += [(10_000, "same words again and again " * 8)] * (count // 2)
    return rows + [(None, None), (None, "null id " * 30), (20_000, ""), (20_001, "\x00\n-"), (20_002, "one"), (20_003, "deep words " * 60_000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "own") for i, t in rows], "doc_id long, text string, rank int, kept string").repartition(6)


@pytest.mark.parametrize("rule", [Resampling(settle=1), Resampling(percent=60, least_words=1, grams=3, buckets=64, seed=1), Resampling(grams=1), Resampling(percent=100), Resampling(percent=0)])
def test_draw_is_that_of_the_definition(spark, rule):
    rows = corpus()
    target = ["w1 w2 w3", None, "W1 w2 again", "words again"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampled(frame(spark, rows), goal, rule)
    assert found.columns == ["doc_id", "text", "kept", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()) == plain(rows, target, rule)


def test_long_texts_in_parts(monkeypatch):
    text = "".join(random.Random(1).choices("aB é-", k=900))
    for grams in (1, 2, 3):
        rule = Resampling(grams=grams)
        monkeypatch.setattr(importance, "SEGMENT", 1 << 18)
        whole = sorted(x for _, b in features(text, rule) for x in b.tolist())
        monkeypatch.setattr(importance, "SEGMENT", 7)
        parts = list(features(text, rule))
        assert len(parts) > 50 and sorted(x for _, b in parts for x in b.tolist()) == whole
        assert len(whole) == len(named(text, grams)[1]) and sum(n for n, _ in parts) == len(named(text, grams)[0])


@pytest.mark.parametrize("settle", [1, 50])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_every_place_is_found(spark, settle, kind):
    draw = random.Random(settle)
    rows = [(draw.randrange(5), None if i % 40 == 0 else draw.randrange(30), i) for i in range(300)]
    keys = spark.createDataFrame(rows, "score long, id long, row long").withColumn("id", F.col("id").cast(kind))
    keys = keys.select("score", F.col("id").isNull().alias("none"), "id", "row").repartition(7)
    text = lambda v: v if kind == "long" or v is None else str(v)
    order = sorted(((s, text(i), n) for s, i, n in rows), key=lambda r: (-r[0], r[1] is None, r[1] or text(0), r[2]))
    for place in (1, 120, 300):
        cut = cut_key(keys, place, 300, settle)
        assert (cut.score, cut.id, cut.row) == order[place - 1]


def test_pivot_leaves_a_quarter_on_either_side(spark):
    skewed = spark.range(0, 4000, 1, 16).select((F.col("id") * F.col("id")).alias("score"), F.lit(False).alias("none"), "id", F.col("id").alias("row"))
    pivot = importance._pivot(skewed)
    above = skewed.filter(F.col("score") > pivot.score).count()
    assert 1000 <= above <= 3000


def test_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, corpus(count=40))
    assert resampled(none, some).collect() == [] and drawn(none, none).collect() == []
    alone = resampled(some, none)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in alone.collect()) == plain(corpus(count=40), [], Resampling())
    kept = drawn(some, none)
    assert kept.columns == ["doc_id", "text", "kept"] and kept.count() == alone.filter("rank is not null").count()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs, goal = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    found = queries.op13_resampling(spark, sf)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, found.collect())) == plain(docs, [t for _, t in goal], Resampling())
