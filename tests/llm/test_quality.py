from __future__ import annotations

import zlib

import numpy as np
import pytest
import zstandard

from watchtide.llm.quality import Learning, difference, fit, with_scores
from watchtide.llm.queries import op2_quality_classifier

SF, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op2_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [(rows[x.doc_id].score, x.quality) for x in labels if rows[x.doc_id].held_out]
    bad, good = ([s for s, q in held if q == v] for v in (0, 1))
    ranked = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    right = sum((s >= 0.5) == bool(q) for s, q in held) / len(held)
    assert ranked > 0.99 and right > 0.98


def test_labels_and_keys_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = [r.score for r in with_scores(docs.select("text"), model).orderBy("text").collect()]
    assert scores == [r.score for r in with_scores(docs, model).orderBy("text").collect()]


@pytest.fixture
def tiny(spark):
    docs = spark.createDataFrame(
        [(i, ("good words of prose number %d. " % i) * 20 if i % 2 else "XX!! %% " * 50, 9.0) for i in range(40)]
        + [(None, "no id", 0.0), (100, None, 0.0), (101, "", 0.0), (102, "long " * 50_000, 0.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(1, 1), (3, 0), (3, 1), (None, 1), (5, None), (100, 1), (999, 0)], "doc_id long, quality int"
    )
    return docs, labels


def test_edges(spark, tiny):
    docs, labels = tiny
    rows = with_scores(docs, fit(docs, labels)).collect()
    assert len(rows) == 44 and all(0 <= r.score <= 1 for r in rows)
    assert [r.predicted for r in rows if r.doc_id is not None and r.doc_id < 40] == [i % 2 for i in range(40)]
    assert {r.score for r in rows if not r.text} == {next(r.score for r in rows if r.text == "")}


def test_without_labels(spark, tiny):
    docs, labels = tiny
    assert {r.score for r in with_scores(docs, fit(docs, labels.limit(0))).collect()} == {0.5}
    only_good = with_scores(docs, fit(docs, labels.filter("quality = 1"))).collect()
    assert len({r.score for r in only_good}) == 1 and only_good[0].predicted == 1
    assert with_scores(docs.limit(0), fit(docs.limit(0), labels)).collect() == []


def test_every_chunk_counts():
    good, bad = b"plain words of a good text " * 20, b"!! $$ ?? ## " * 20
    rule = Learning()
    start = "plain words of a good text " * 40
    values = [difference(start + tail, good, bad, rule.chunk, rule.level) for tail in ("", "!! $$ ?? ## " * 9000)]
    assert values[0] > 0 > values[1] and difference(None, good, bad, 10, 3) == difference("", good, bad, 10, 3) == 0.0


def test_repeated_ids_learn_one_text(spark, tiny):
    docs, labels = tiny
    again = docs.unionByName(docs.filter("doc_id < 40").selectExpr("doc_id", "'zz ' || text AS text", "score"))
    assert fit(again.repartition(5), labels) == fit(docs, labels)


def test_equals_the_plain_method(spark):
    """Dictionaries, differences and the curve made again without the library, over a whole table."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    crc = {d: zlib.crc32(str(d).encode()) for d in docs}
    known_ids = {v: [d for d in docs if labels.get(d) == v and crc[d] % 3 != 1] for v in (0, 1)}
    learnt = {v: sorted((d for d in ids if 0 < len((docs[d] or "").encode()) <= 1 << 15), key=crc.get) for v, ids in known_ids.items()}
    coders = {}
    for value, ids in learnt.items():
        data = [docs[d].encode() for d in ids[::2]]
        pieces = [t[i : i + 512] for t in data for i in range(0, len(t), 512)]
        known = zstandard.ZstdCompressionDict(zstandard.train_dictionary(1 << 18, pieces).as_bytes())
        known.precompute_compress(level=3)
        coders[value] = zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False)

    def gap(text):
        data = (text or "").encode()
        sums = [sum(len(coders[v].compress(data[i : i + 512])) for i in range(0, len(data), 512)) for v in (0, 1)]
        return (sums[0] - sums[1]) / max(len(data), 1)

    x = np.array([gap(docs[d]) for v in (0, 1) for d in learnt[v][1::2]])
    y = np.array([v for v in (0, 1) for _ in learnt[v][1::2]])
    share = len(known_ids[1]) / (len(known_ids[0]) + len(known_ids[1]))
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum()) * len(y)
    z, line = (x - x.mean()) / x.std(), np.zeros(2)
    for _ in range(40_000):
        off = weight * (1 / (1 + np.exp(-(line[0] * z + line[1]))) - y)
        line -= 4 / len(y) * np.array([off @ z + line[0], off.sum()])
    rows = op2_quality_classifier(spark, SMALL).collect()
    plain = np.array([1 / (1 + np.exp(-(line[0] * (gap(docs[r.doc_id]) - x.mean()) / x.std() + line[1]))) for r in rows])
    assert len(rows) == len(docs) and np.abs(plain - np.array([r.score for r in rows])).max() < 1e-5
