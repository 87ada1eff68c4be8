from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from test_neardup import plain
from watchtide.llm.decontaminate import contained_items
from watchtide.llm.mixing import Mix, mixed
from watchtide.llm.quality import fit, with_scores
from watchtide.storage import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage gets and what it returns."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "step")
        found.append((docs, out))
        docs = out
    return found


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_and_columns(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "sharding",
    ]
    for given, out in steps[:-1]:
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] == given.columns


def test_quality(spark, steps):
    given, out = steps[0]
    model = fit(given, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in with_scores(given, model).collect() if r.score >= 0.5}
    assert rows(out) == Counter(tuple(r) for r in given.collect() if r.doc_id in good) and 0 < len(good) < given.count()


def test_near_dedup(steps):
    given, out = steps[1]
    classes = plain([(r.doc_id, r.text) for r in given.collect()], 5)
    assert rows(out) == Counter(tuple(r) for r in given.collect() if classes[r.doc_id][0] == 0 or classes[r.doc_id][1] == r.doc_id)
    assert out.count() < given.count()


def test_decontamination(spark, steps):
    given, out = steps[2]
    leaks = {r.id for r in contained_items(given, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert rows(out) == Counter(tuple(r) for r in given.collect() if r.doc_id not in leaks)


def test_mixing(steps):
    given, out = steps[3]
    copies = {r.doc_id: r.copies for r in mixed(given, Mix(whole=True)).collect()}
    assert rows(out) == Counter({tuple(r): copies[r.doc_id] for r in given.collect() if copies[r.doc_id]})


def test_sharding(steps):
    given, out = steps[4]
    assert rows(out.select(*given.columns)) == rows(given)
    for shard in range(16):
        slots = sorted(r.slot for r in out.filter(f"shard = {shard}").collect())
        assert slots == list(range(len(slots)))


def test_run_is_the_stages_one_after_the_other(spark, steps):
    assert rows(corpus_pipeline.run(spark, SF).drop("slot")) == rows(steps[-1][1].drop("slot"))


def test_hostile_rows(spark, tmp_path):
    """Nulls everywhere, empty and long texts, repeated rows, and columns that the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, slot long, _row int, score double"
    hostile = [(None, None, None, None, None, None, None, None, None), (1, "", "en", "a", 0, 1, 1, 1, 1.0), (2, "w " * 90_000, "en", None, 1, 1, 1, 1, 1.0)]
    hostile += [(3, "Some quiet words of a text that reads well enough.", "en", "a", 1, 1, 1, 1, 1.0)] * 3
    for table in (hostile, []):
        docs = spark.createDataFrame(table, schema)
        for _, stage in corpus_pipeline.STAGES:
            before = docs
            docs = stored(stage(spark, docs, SF), "hostile")
            assert set(before.columns) <= set(docs.columns) | {"size", "slot"}
        assert docs.count() <= 3 * len(table)
