from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from watchtide.sources.batches import batch_summary, pack_batches, tasks_per_lane


def greedy(records, max_rows, max_bytes):
    """The packing rule in its plainest form."""
    batches, held = [], []
    for record in records:
        candidate = held + [record]
        if held and (len(candidate) > max_rows or len(("[" + ",".join(candidate) + "]").encode()) > max_bytes):
            batches.append(held)
            held = [record]
        else:
            held = candidate
    return batches + [held] if held else batches


@pytest.mark.parametrize(("max_rows", "max_bytes", "chunk"), [(25, 900_000, 10_000), (7, 400, 64), (1, 200, 10), (100, 300, 33)])
def test_one_lane_is_the_greedy_sequence(spark, max_rows, max_bytes, chunk):
    random.seed(max_rows)
    rows = [(f"f-{i:05d}", "é" * random.randint(0, 60)) for i in range(500)]
    df = spark.createDataFrame(rows, "Id STRING, Title STRING").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        packed = pack_batches(df, max_rows, max_bytes).orderBy("batch_no").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts = [json.dumps({"Id": i, "Title": t}, ensure_ascii=False, separators=(",", ":")) for i, t in rows]
    assert [p.records for p in packed] == greedy(texts, max_rows, max_bytes)
    for p in packed:
        assert p.rows == len(p.records) <= max_rows
        assert p.bytes == len(("[" + ",".join(p.records) + "]").encode()) <= max_bytes


def test_lanes_keep_every_record_and_split_a_hot_key(spark):
    df = spark.range(3000).selectExpr("'same' AS Id", "cast(id AS STRING) AS Title")
    packed = pack_batches(df, lanes=4).collect()
    assert sum(p.rows for p in packed) == 3000
    per_lane = {}
    for p in packed:
        per_lane[p.lane] = per_lane.get(p.lane, 0) + p.rows
    assert len(per_lane) == 4 and max(per_lane.values()) < 1000
    totals = batch_summary(pack_batches(df, lanes=4)).first()
    assert (totals.batches_sent, totals.records_sent) == (len(packed), 3000)


def test_limits(spark):
    df = spark.createDataFrame([("a", "x" * 100)], "Id STRING, Title STRING")
    for rows, size in ((0, 100), (1, 2)):
        with pytest.raises(ValueError, match="positive"):
            pack_batches(df, rows, size)
    with pytest.raises(PySparkException, match="single record"):
        pack_batches(df, 25, 50).collect()
    exact = len('[{"Id":"a","Title":"' + "x" * 100 + '"}]')
    assert pack_batches(df, 25, exact).first().bytes == exact
    assert batch_summary(pack_batches(df.filter("false"))).first().asDict() == {"batches_sent": 0, "records_sent": 0}


def test_a_lane_of_many_records_is_shared_by_tasks(spark):
    """What a task reads is bounded: the lanes stay, each packed by several tasks, and no number comes twice."""
    assert [tasks_per_lane(n, 6) for n in (0, 1_500_000, 1_500_001, 36_000_000)] == [1, 1, 2, 24]
    df = spark.range(3000).selectExpr("'same' AS Id", "cast(id AS STRING) AS Title")
    packed = pack_batches(df, lanes=4, lane_tasks=3)
    per_task = packed.groupBy(F.spark_partition_id().alias("task"), "lane").agg(F.sum("rows").alias("records")).collect()
    assert len(per_task) == 12 and {t.lane for t in per_task} == {0, 1, 2, 3} and max(t.records for t in per_task) < 300
    rows = packed.collect()
    assert len({(p.lane, p.batch_no) for p in rows}) == len(rows)
    assert {p.batch_no >> 32 for p in rows} == {0, 1, 2} and all(p.rows <= 25 for p in rows)
    assert sorted(json.loads(r)["Title"] for p in rows for r in p.records) == sorted(str(i) for i in range(3000))
    with pytest.raises(ValueError, match="share"):
        pack_batches(df, lane_tasks=2)
